"""Duplicate removal with a survivor that does not depend on the run."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylake.operators.skew import HotKeys

PROVENANCE = ("_ingest_ts", "_source_file", "_source_system", "_row_id")


def total_order(df: DataFrame, keys: Sequence[str], *first: Column) -> list[Column]:
    """`first`, then provenance, then every other column: rows that still tie are equal."""
    provenance = [c for c in PROVENANCE if c in df.columns]
    others = [c for c in df.columns if c not in keys and c not in provenance]
    return [*first, *[F.col(c) for c in (*provenance, *others)]]


def keep_one(df: DataFrame, keys: Sequence[str], *order: Column, nulls_apart: bool = False, hot: HotKeys | None = None) -> DataFrame:
    """The first row of each key under `order`, ties broken by all other columns.

    Rank-equals-one is planned as a group limit on both sides of the shuffle:
    each task sends at most one row per key, so a hot key stays small. With
    `nulls_apart` a null in the key is no value that rows could share: such rows
    are duplicates only where they are equal in every column.

    Where most keys have few rows, a task has little to thin out and would sort, and
    spill, all its rows for it. Pass the hot keys of such a table, none too: rows of
    other keys are then sorted once, where the shuffle brings them together.
    """
    keyless = reduce(or_, [F.col(k).isNull() for k in keys])
    own = F.when(keyless, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    parts = [*keys, "_own"] if nulls_apart else [*keys]
    ranking = Window.partitionBy(*parts).orderBy(*total_order(df, keys, *order))

    def first(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_rank", F.row_number().over(ranking)).where("_rank = 1").select(*[F.col(f"`{c}`") for c in df.columns])

    apart = df.withColumn("_own", own) if nulls_apart else df
    if hot is None:
        return first(apart)
    if not hot:
        return first(apart.repartition(*parts))
    return first(hot.others(apart, keys).repartition(*parts)).unionByName(first(hot.rows_of(apart, keys)))


def keep_latest(df: DataFrame, keys: Sequence[str], moment: str, nulls_apart: bool = False, hot: HotKeys | None = None) -> DataFrame:
    """The newest row of each key; rows without a moment count as oldest."""
    return keep_one(df, keys, F.col(moment).desc_nulls_last(), nulls_apart=nulls_apart, hot=hot)


def distinct_records(df: DataFrame, ignore: Sequence[str] = PROVENANCE) -> DataFrame:
    """One row per distinct record, where the ignored columns do not make a difference.

    The survivor carries the smallest provenance. Equal rows are combined
    before the shuffle.
    """
    extra = [c for c in ignore if c in df.columns]
    record = [c for c in df.columns if c not in extra]
    if not extra:
        return df.dropDuplicates()
    grouped = df.groupBy(*record).agg(F.min(F.struct(*extra)).alias("_origin"))
    origin = [F.col(f"_origin.{c}").alias(c) for c in extra]
    return grouped.select(*record, *origin).select(*df.columns)
