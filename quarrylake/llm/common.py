"""What the corpus operators share: stored steps, word patterns, null-safe group keys."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylake.session import scratch_path

# The six ASCII blanks that part words (Java pattern), and their complement.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a step to the shared folder and read it back: its lineage is cut, and a
    lost executor costs a re-read. Files carry their size, so Spark broadcasts the
    step in later joins only where it is below the session's bound."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps now.

    It acts on what the JVM has collected; a driver with little garbage would
    otherwise keep the files of every step until the job ends.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def words_of(text: Column) -> Column:
    """The words of a text, parted by ASCII blanks; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def key_of(*columns: Column) -> Column:
    """One text that is equal just where all columns are equal, nulls included."""
    parts = [F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.concat_ws("/", *parts)


def map_rows(df: DataFrame, each: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Arrow batches in, Arrow batches out, partition by partition."""
    return df.mapInArrow(each, schema)


def batch(schema: pa.Schema, columns: dict[str, object]) -> pa.RecordBatch:
    """A record batch of the schema from lists or arrays by name."""
    arrays = []
    for field in schema:
        values = columns[field.name]
        arrays.append(values if isinstance(values, pa.Array) else pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
