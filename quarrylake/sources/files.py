"""File inventory as a DataFrame: which files there are, and what their folders say."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylake.functions.text import path_key

# What is loaded: every batch is one folder, written at its commit, with its files, the
# columns its rows have, and the moment of the commit.
LEDGER_SCHEMA = (
    "path string, length bigint, modified timestamp, columns array<string>, digest string, committed timestamp, batch string"
)


def list_files(spark: SparkSession, base: str, pattern: str = "*") -> DataFrame:
    """Path, length and change time of the non-empty files below `base`; no file is opened."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(base)
    )
    return listing.select("path", "length", F.col("modificationTime").alias("modified")).where("length > 0")


def with_path_keys(files: DataFrame, keys: Sequence[str], path: str = "path") -> DataFrame:
    """Add each folder key of the path as a text column."""
    return files.withColumns({k: path_key(F.col(path), k) for k in keys})


def key_inventory(files: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct folder keys, with the number of files under each."""
    return with_path_keys(files, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("files"))


def bind(table: DataFrame, **values: object) -> DataFrame:
    """One partition of a laid-out table; the scan is pruned to its folder."""
    for key, value in values.items():
        table = table.where(F.col(key) == F.lit(value))
    return table


def first_key(files: DataFrame, base: str = "") -> DataFrame:
    """Name and value of the first folder key of each file, below `base` where it is given."""
    found = r"/([^/=]+)=([^/]+)"
    # Listed paths carry a scheme; the base may not.
    root = base.rstrip("/").split("://")[-1].removeprefix("file:")
    below = F.substring(F.col("path"), F.locate(root, F.col("path")) + len(root), F.length("path")) if root else F.col("path")
    return files.select(F.regexp_extract(below, found, 1).alias("key"), F.regexp_extract(below, found, 2).alias("value"), "path")


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """Files already loaded; empty before the first load."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def pending(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files not loaded yet, one by one, so that a late file of an old folder is found too."""
    return files.join(ledger.select("path"), "path", "left_anti")


def record(files: DataFrame, ledger: str, batch: str, columns: Sequence[str] = (), digest: str | None = None) -> None:
    """Write a batch's files, and the columns of its rows, to the ledger; this is the commit of the batch.

    It is one file in a folder of the batch's name, so it is there whole or not at
    all, and a batch that commits again replaces its own entry only.
    """
    entries = files.select(
        "path", "length", "modified", F.array(*map(F.lit, columns)).cast("array<string>").alias("columns"),
        F.lit(digest).cast("string").alias("digest"), F.current_timestamp().alias("committed"),
    )
    entries.coalesce(1).write.mode("overwrite").parquet(f"{ledger}/batch={batch}")


def committed_columns(ledger: DataFrame) -> list[str]:
    """Every column that a committed batch has, by name."""
    return sorted(r["column"] for r in ledger.select(F.explode("columns").alias("column")).distinct().collect())


def last_commit(ledger: DataFrame) -> dict[str, object] | None:
    """The newest commit: its moment, batch and digest."""
    newest = F.max(F.struct("committed", "batch", "digest")).alias("newest")
    found = ledger.agg(newest).first()["newest"]
    return found.asDict() if found is not None else None


def require(found: Mapping[str, DataFrame], needed: Sequence[str]) -> None:
    missing = sorted(set(needed) - set(found))
    if missing:
        raise FileNotFoundError(f"reference files are missing: {', '.join(missing)}")
