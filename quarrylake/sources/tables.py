"""Reading and writing the lake's Parquet tables."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylake.session import shared_folder


def read_table(spark: SparkSession, path: str, merge: bool = False) -> DataFrame:
    """A Parquet table; `merge` unites the columns of all files when they drifted."""
    return spark.read.option("mergeSchema", str(merge).lower()).parquet(path)


def stamp(df: DataFrame, system: str, ingested: Column) -> DataFrame:
    """Add the load's one moment, as ISO text, and the delivering system."""
    written = F.date_format(ingested, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return df.withColumns({"_ingest_ts": written, "_source_system": F.lit(system)})


def write_table(df: DataFrame, path: str, layout: Sequence[str] = (), mode: str = "overwrite", dealt: bool = False) -> None:
    """Write Parquet, whole or by folder.

    With a layout only the folders that occur in `df` are replaced. Rebalancing
    by the layout columns gives each folder few files and still spreads a
    folder that holds much of the table over several tasks; `dealt` tells that
    the rows come in this way already.
    """
    if layout and not dealt:
        df = df.hint("rebalance", *layout)
    writer = df.write.mode(mode).option("compression", "snappy").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*layout) if layout else writer).parquet(path)


def replace_table(df: DataFrame, path: str, layout: Sequence[str] = ()) -> None:
    """Write a table that was computed whole: folders that no longer occur go."""
    if layout:
        df = df.hint("rebalance", *layout)
    writer = df.write.mode("overwrite").option("compression", "snappy").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*layout) if layout else writer).parquet(path)


def folder_name(key: str, value: object) -> str:
    """The folder Spark writes a value's rows to."""
    if value is None:
        return f"{key}=__HIVE_DEFAULT_PARTITION__"
    special = set("\"#%'*/:=?\\{[]^\x7f") | {chr(i) for i in range(1, 32)}
    return f"{key}=" + "".join(f"%{ord(c):02X}" if c in special else c for c in str(value))


def empty_folder(like: DataFrame, path: str, key: str, value: object) -> None:
    """Leave no row in one folder of a laid-out table."""
    like.drop(key).limit(0).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{folder_name(key, value)}")


def append_rejects(rejected: DataFrame, path: str) -> None:
    """Add rejects to a quarantine table, laid out by the day they were rejected."""
    write_table(rejected, path, ["reject_date"], mode="append")


def staged(df: DataFrame, owner: str) -> DataFrame:
    """Write a result once to the shared scratch folder and read it from there.

    Two sinks of one plan then share its shuffles, and a lost executor costs a
    re-read instead of a recomputation. The next run of the same owner
    replaces the staged rows, so scratch holds one copy per owner.
    """
    name = hashlib.sha256(owner.encode()).hexdigest()[:16]
    path = f"{shared_folder(df.sparkSession)}/staged-{name}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
