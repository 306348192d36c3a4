"""Incremental load as a stream, into the bronze table and ledger of the batch load.

The stream is of files, not of rows: its source lists the landing folder and opens
nothing, its checkpoint remembers what it has handed over, and each micro-batch goes
through the same load as a batch run. So every format streams, and headers may drift.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylake.plans.bronze import ENDINGS, load_files, utc_now
from quarrylake.sources.files import pending, read_ledger
from quarrylake.spec import Lake, Source

# Fixed value: the columns of Spark's binary file source, of which the content is never read here.
LISTED = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_available(
    spark: SparkSession, lake: Lake, source: Source, columns: Sequence[str] = (), files_per_batch: int = 10_000
) -> int:
    """Load all files not seen before into bronze, in bounded batches, and stop; returns their number.

    A micro-batch that is replayed, or that meets files which a batch load has taken,
    loads what the ledger does not name and nothing else. `columns` are there in
    bronze whether or not a file carries them.
    """
    wanted = Source(**{**vars(source), "declared": (*source.declared, *[c for c in columns if c not in source.declared])})
    known = Lake(lake.root, {**lake.sources, source.name: wanted}, lake.references)
    loaded = []

    def load(files: DataFrame, number: int) -> None:
        session = files.sparkSession
        fresh = pending(files.where("length > 0"), read_ledger(session, known.ledger(source.name)))
        entries = fresh.orderBy("modified", "path").collect()  # files_per_batch at most
        loaded.append(load_files(session, known, source.name, entries, utc_now(), "stream"))

    try:
        listing = (
            spark.readStream.format("binaryFile").schema(LISTED)
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", ENDINGS[source.format])
            .option("maxFilesPerTrigger", files_per_batch)
            .load(lake.landing(source.name))
        )
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    query = (
        listing.select("path", "length", F.col("modificationTime").alias("modified"))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", lake.at("_checkpoints", source.name))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(loaded)
