"""Change-driven cleaning: only the folders that new rows touch are rewritten.

A table that is laid out by folder is cleaned per group of rows that share `Delta.key`:
its survivor, its rejects and its folder depend on no other row of the table. So a run
takes the groups that new batches name, or whose parents came or went; reads their raw
rows, both new ones and those behind the rows that stand in table or quarantine now
(rows that lost before cannot win later); cleans them; and replaces the folders the
groups were in and those they are in now. The result is that of a full rebuild.

What a table was made from is a small commit log: the batches, and the versions of the
tables it looks things up in. Keys that came or went are kept per version for the
tables that depend on them.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylake.functions.text import path_key
from quarrylake.operators.quality import REASON, Parted, describe_rejects
from quarrylake.sources.tables import empty_folder, read_table, replace_table, staged, write_table
from quarrylake.spec import LAYOUT, Lake

COMMIT = "version int, batches array<string>, parents map<string,int>, whole boolean"
SEEN = "_row_id string, _first timestamp"

# Above so many folders a list of them no longer prunes a scan; the scan is then filtered row by row.
MOST_FOLDERS = 10_000


class Delta(NamedTuple):
    """How a table is refreshed: the raw column whose rows belong together, and the parents
    that matter by which keys they hold, with the cleaned column that names them."""

    key: str
    members: dict[str, str] = {}


# What a cleaned row depends on besides its own group.
DELTAS = {
    "weather": Delta("city_id"),
    "rides": Delta("ride_id"),
    "payments": Delta("payment_id", {"rides": "ride_id"}),
    "telemetry": Delta("event_id", {"vehicles": "vehicle_id"}),
}
# The key by which other tables hold rows of these.
MEMBER_KEYS = {"rides": "ride_id", "vehicles": "vehicle_id"}


class Commit(NamedTuple):
    version: int
    batches: frozenset[str]
    parents: dict[str, int]


def _absent(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return read_table(spark, path)
    except AnalysisException as missing:
        if not _absent(missing):
            raise
        return None


def log_of(lake: Lake, table: str) -> str:
    return lake.at("_ledger", "silver", table)


def commits(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    try:
        return spark.read.schema(COMMIT).parquet(log_of(lake, table))
    except AnalysisException as missing:
        if not _absent(missing):
            raise
        return spark.createDataFrame([], COMMIT)


def last_commit(spark: SparkSession, lake: Lake, table: str) -> Commit | None:
    newest = commits(spark, lake, table).orderBy(F.desc("version")).limit(1).collect()
    return Commit(newest[0]["version"], frozenset(newest[0]["batches"]), newest[0]["parents"]) if newest else None


def commit(spark: SparkSession, lake: Lake, table: str, made: Commit, whole: bool) -> None:
    row = [(made.version, sorted(made.batches), made.parents, whole)]
    spark.createDataFrame(row, COMMIT).coalesce(1).write.mode("append").parquet(log_of(lake, table))


def changes_at(lake: Lake, table: str, version: int) -> str:
    return lake.at("_changes", table, f"version={version}")


def parent_changes(spark: SparkSession, lake: Lake, parent: str, since: int, until: int) -> DataFrame | None:
    """The keys of a parent that came or went after `since`; None where that is not known."""
    if parent not in MEMBER_KEYS:
        return None
    found = [stored_table(spark, changes_at(lake, parent, v)) for v in range(since + 1, until + 1)]
    if any(f is None for f in found):
        return None
    keys = spark.createDataFrame([], f"{MEMBER_KEYS[parent]} string")
    for f in found:
        keys = keys.unionByName(f)
    return keys.distinct()


def came_or_went(before: DataFrame | None, after: DataFrame, key: str) -> DataFrame:
    """The keys that only one of two tables holds; each side sends a key once per task."""
    side = lambda df, name: df.where(F.col(key).isNotNull()).select(key).distinct().withColumn("_in", F.lit(name))
    sides = side(after, 1) if before is None else side(before, 0).unionByName(side(after, 1))
    return sides.groupBy(key).agg(F.count(F.lit(1)).alias("_sides")).where("_sides = 1").select(key)


def note_changes(lake: Lake, table: str, version: int, before: DataFrame | None, after: DataFrame) -> None:
    """Keep the keys that came or went, ahead of the change itself. A run that died after
    this and runs again adds to them: a key too many only costs its dependants a look."""
    if table in MEMBER_KEYS:
        came_or_went(before, after, MEMBER_KEYS[table]).write.mode("append").parquet(changes_at(lake, table, version))


def first_seen(described: DataFrame, path: str) -> DataFrame:
    """Rejects, staged, with the moment their row was first rejected, however its columns have grown since.

    The moments stand in a table of their own, by the identity a row got when it was
    ingested. It is only ever added to, so no replaced quarantine takes them along.
    """
    if "_row_id" not in described.columns:
        return staged(described, path)
    spark = described.sparkSession
    try:
        known = spark.read.schema(SEEN).parquet(path).groupBy("_row_id").agg(F.min("_first").alias("_first"))
        dated = described.join(known, "_row_id", "left")
    except AnalysisException as missing:
        if not _absent(missing):
            raise
        dated = described.withColumn("_first", F.lit(None).cast("timestamp"))
    dated = staged(dated.withColumn("_reject_ts", F.coalesce("_first", "_reject_ts")), path)
    fresh = dated.where(F.col("_first").isNull() & F.col("_row_id").isNotNull()).select("_row_id", F.col("_reject_ts").alias("_first"))
    fresh.distinct().write.mode("append").parquet(path)
    return dated.withColumn("reject_date", F.to_date("_reject_ts")).select(*described.columns)


def seen_at(lake: Lake, table: str) -> str:
    return lake.at("_first_seen", table)


def replace_whole(spark: SparkSession, parted: Parted, lake: Lake, table: str, version: int) -> None:
    """Replace table and quarantine by the two sides of one plan, which is run once."""
    both = staged(parted.both(), lake.silver(table))
    kept = both.where(F.col(REASON).isNull()).select(*parted.kept.columns)
    rejected = both.where(F.col(REASON).isNotNull()).select(*parted.rejected.columns)
    described = first_seen(describe_rejects(rejected, table), seen_at(lake, table))
    note_changes(lake, table, version, stored_table(spark, lake.silver(table)), kept)
    # The quarantine may hold rows in clear that the table blanks from now on: it goes first.
    replace_table(described, lake.quarantine(table), ["reject_date"])
    replace_table(kept, lake.silver(table), LAYOUT.get(table, ()))


def in_folders(df: DataFrame, folder: str, values: Sequence[object]) -> Column:
    """Whether a row lies in one of the folders; a short list prunes the scan."""
    some = [v for v in values if v is not None]
    test = F.col(folder).isin(some) if some else F.lit(False)
    return (test | F.col(folder).isNull()) if None in values else test


def folders_of(rows: DataFrame, folder: str) -> list[object]:
    return [r[0] for r in rows.select(folder).distinct().collect()]


def replace_folders(path: str, old: DataFrame | None, gone: DataFrame, key: str, fresh: DataFrame, folder: str) -> None:
    """Rewrite the folders in which rows of the groups `gone` stand or `fresh` rows will.

    Every other row of those folders is written back, every other folder is left alone.
    """
    if old is None:
        replace_table(fresh, path, [folder])
        return
    standing = old.join(gone, key, "left_semi")
    before, after = folders_of(standing, folder), folders_of(fresh, folder)
    touched = list(dict.fromkeys([*before, *after]))
    stay = old.where(in_folders(old, folder, touched)).join(gone, key, "left_anti")
    whole = staged(stay.unionByName(fresh, allowMissingColumns=True), path)
    write_table(whole, path, [folder])
    filled = set(folders_of(whole, folder))
    for value in [v for v in before if v not in filled]:
        empty_folder(whole, path, folder, value)


def files_of(rows: DataFrame | None, gone: DataFrame, key: str) -> DataFrame | None:
    """The files behind the rows of the groups that stand in a table now."""
    return None if rows is None else rows.join(gone, key, "left_semi").select("_source_file").distinct()


def refresh(
    spark: SparkSession, lake: Lake, table: str, clean, parents: Sequence[DataFrame], raw: DataFrame, new: DataFrame,
    moved: dict[str, DataFrame], version: int,
) -> bool:
    """Bring table and quarantine up to date for the groups in `new` rows and those that
    hold the `moved` keys of a parent. Where the columns have grown it does nothing and
    says so: every folder must get them.
    """
    key, folder = DELTAS[table].key, LAYOUT[table][0]
    kept, rejected = stored_table(spark, lake.silver(table)), stored_table(spark, lake.quarantine(table))
    planned = clean(raw.limit(0), *parents)  # for its columns alone
    if kept is None or set(planned.kept.columns) != set(kept.columns):
        return False
    named = [new.where(F.col(key).isNotNull()).select(key)]
    for parent, keys in moved.items():
        column = DELTAS[table].members[parent]
        named += [t.join(keys, column, "left_semi").where(F.col(key).isNotNull()).select(key) for t in (kept, rejected) if t is not None]
    groups = named[0]
    for more in named[1:]:
        groups = groups.unionByName(more)
    groups = staged(groups.distinct(), f"{lake.silver(table)}-groups")
    files = new.select("_source_file").distinct()
    for standing in (files_of(kept, groups, key), files_of(rejected, groups, key)):
        files = files if standing is None else files.unionByName(standing)
    files = staged(files.distinct(), f"{lake.silver(table)}-files")
    grouped = pruned(raw, lake, table, files).join(files, "_source_file", "left_semi").join(groups, key, "left_semi")
    candidates = grouped.unionByName(new.where(F.col(key).isNull()), allowMissingColumns=True)
    parted = clean(candidates, *parents)
    both = staged(parted.both(), f"{lake.silver(table)}-fresh")
    fresh = both.where(F.col(REASON).isNull()).select(*parted.kept.columns)
    refused = both.where(F.col(REASON).isNotNull()).select(*parted.rejected.columns)
    described = first_seen(describe_rejects(refused, table), seen_at(lake, table))
    note_changes(lake, table, version, kept.join(groups, key, "left_semi"), fresh)
    replace_folders(lake.quarantine(table), rejected, groups, key, described, "reject_date")
    replace_folders(lake.silver(table), kept, groups, key, fresh, folder)
    return True


def pruned(raw: DataFrame, lake: Lake, table: str, files: DataFrame) -> DataFrame:
    """The raw rows in the bronze folders that hold the files; the folder is in a file's path."""
    for folder in lake.sources[table].keys[:1]:
        values = [r[0] for r in files.select(path_key(F.col("_source_file"), folder)).distinct().limit(MOST_FOLDERS + 1).collect()]
        if len(values) <= MOST_FOLDERS and None not in values:
            kind = raw.schema[folder].dataType
            return raw.where(F.col(folder).isin([F.lit(v).cast(kind) for v in values]))
    return raw
