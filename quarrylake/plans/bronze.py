"""Raw files to bronze: only files not seen before, all-text columns, provenance.

Batch and stream share one bronze table and one ledger per source. A batch of files is
read, written to a folder of its own, and then committed: the ledger names its files and
its columns. Bronze is only read through the ledger, so a run that dies before its
commit leaves no trace, and the read schema comes from the ledger, not from footers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from datetime import datetime, timezone
from itertools import islice

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylake.functions.columns import quoted, sorted_columns, with_declared
from quarrylake.sources.files import committed_columns, last_commit, list_files, pending, read_ledger, record, require
from quarrylake.sources.readers import read_csv, read_source
from quarrylake.sources.tables import stamp, staged, write_table
from quarrylake.spec import Lake, Source

# The file name ending of each format.
ENDINGS = {"csv": "*.csv", "ndjson": "*.json", "document": "*.json", "xml": "*.xml"}

FILES_PER_BATCH = 100_000
ENTRY = "path string, length bigint, modified timestamp"


def utc_now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


def batch_name(entries: Sequence[Row], prefix: str = "files") -> str:
    """A name that the same files always get, so a batch that runs again replaces itself."""
    text = "\n".join(sorted(f"{e['path']} {e['length']}" for e in entries))
    return f"{prefix}-{hashlib.sha256(text.encode()).hexdigest()[:20]}"


def row_identity(columns: Sequence[str]) -> Column:
    """What a row is told by later: its file and everything it held when it was read."""
    return F.md5(F.to_json(F.struct(*[quoted(c) for c in sorted(columns)])))


def ingest(rows: DataFrame, source: Source, bronze: str, batch: str, moment: str) -> list[str]:
    """Stamp a batch of rows and write it to its own folder of the bronze table; returns its columns.

    Rows are stamped where they are written: the digests would make up much of the shuffle.
    """
    dealt = rows.hint("rebalance", *source.keys)
    named = dealt.withColumn("_row_id", row_identity(rows.columns))
    stamped = stamp(named, source.system, F.lit(moment).cast("timestamp"))
    write_table(stamped, f"{bronze}/batch={batch}", source.keys, dealt=True)
    return [c for c in stamped.columns if c not in source.keys]


def load_files(spark: SparkSession, lake: Lake, name: str, entries: Sequence[Row], moment: str, prefix: str = "files") -> int:
    """Read, write and commit one batch of files, in this order; returns how many there were."""
    if not entries:
        return 0
    source, batch = lake.sources[name], batch_name(entries, prefix)
    rows = read_source(spark, sorted(e["path"] for e in entries), source)
    columns = ingest(rows, source, lake.bronze(name), batch, moment)
    taken = spark.createDataFrame([tuple(e[c] for c in ("path", "length", "modified")) for e in entries], ENTRY)
    record(taken, lake.ledger(name), batch, columns)
    return len(entries)


def load_new(spark: SparkSession, lake: Lake, name: str, files_per_batch: int = FILES_PER_BATCH) -> int:
    """Load all files of a source that the ledger does not name; returns their number.

    The landing folder is listed once, and the waiting files, oldest first, are stored;
    the driver holds one batch of their names at a time. All of them carry one moment.
    """
    loaded, moment = 0, utc_now()
    for entries in _batches(_waiting(spark, lake, name), files_per_batch):
        loaded += load_files(spark, lake, name, entries, moment)
    return loaded


def _waiting(spark: SparkSession, lake: Lake, name: str) -> DataFrame | None:
    try:
        found = list_files(spark, lake.landing(name), ENDINGS[lake.sources[name].format])
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    waiting = pending(found, read_ledger(spark, lake.ledger(name)))
    return staged(waiting.select("path", "length", "modified").orderBy("modified", "path"), f"{lake.ledger(name)}-waiting")


def _batches(waiting: DataFrame | None, size: int) -> Iterator[list[Row]]:
    if waiting is None:
        return
    rows = waiting.orderBy("modified", "path").toLocalIterator()
    while entries := list(islice(rows, size)):
        yield entries


def read_bronze(spark: SparkSession, lake: Lake, name: str, batches: Sequence[str] | None = None) -> DataFrame | None:
    """The committed batches of a source, or some of them, columns of all batches united;
    None when nothing was loaded. A reference is its newest batch alone.

    The ledger says which columns there are: no footer is opened before the scan.
    """
    ledger = read_ledger(spark, lake.ledger(name))
    columns = committed_columns(ledger)
    if not columns:
        return None
    keys = () if name in lake.references else lake.sources[name].keys
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    table = with_declared(spark.read.schema(schema).parquet(lake.bronze(name)), ["batch", *keys])
    if name in lake.references:
        batches = [last_commit(ledger)["batch"]]
    if batches is not None:
        return table.where(F.col("batch").isin(list(batches))).drop("batch")
    return table.join(ledger.select("batch").distinct(), "batch", "left_semi").drop("batch")


def committed_batches(spark: SparkSession, lake: Lake, name: str) -> list[str]:
    """The names of the batches that count: all of a source, the newest of a reference."""
    ledger = read_ledger(spark, lake.ledger(name))
    if name in lake.references:
        newest = last_commit(ledger)
        return [newest["batch"]] if newest else []
    return sorted(r["batch"] for r in ledger.select("batch").distinct().collect())


def load_references(spark: SparkSession, lake: Lake) -> list[str]:
    """Load every reference file that changed since it was last loaded; returns their names.

    A missing file fails before anything is written. Files of the same length and
    change time are not opened; those that were only touched are known by their digest. A
    changed one becomes a batch of its own, and the newest batch is the reference.
    """
    found: dict[str, list[Row]] = {}
    for name in lake.references:
        try:
            found[name] = list_files(spark, lake.landing(name)).collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    require({name: entries for name, entries in found.items() if entries}, list(lake.references))
    changed, moment = [], F.lit(utc_now()).cast("timestamp")
    for name, entries in found.items():
        ledger = read_ledger(spark, lake.ledger(name))
        last = last_commit(ledger)
        if last:
            known = ledger.where(F.col("batch") == last["batch"]).select("path", "length", "modified").collect()
            if set(known) == set(entries):
                continue
        content = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(lake.landing(name))
        digests = content.where("length > 0").agg(F.sort_array(F.collect_list(F.sha2("content", 256))).alias("all"))
        digest = digests.select(F.sha2(F.array_join("all", "").cast("binary"), 256)).first()[0]
        if last and last["digest"] == digest:
            continue
        rows = sorted_columns(read_csv(spark, lake.landing(name)))
        stamped = stamp(rows.withColumn("_row_id", row_identity(rows.columns)), lake.references[name].system, moment)
        batch = f"reference-{digest[:20]}"
        write_table(stamped, f"{lake.bronze(name)}/batch={batch}")
        record(spark.createDataFrame(entries, ENTRY), lake.ledger(name), batch, stamped.columns, digest)
        changed.append(name)
    return changed
