"""Lookups and membership tests against reference data, without collecting values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylake.operators.dedupe import keep_one
from quarrylake.operators.skew import HotKeys, join_unique

FLAG = "_matched"


def _in_order(joined: DataFrame, columns: Sequence[str]) -> DataFrame:
    return joined.select(*columns)


def mark_members(
    df: DataFrame, key: str, members: DataFrame, flag: str = FLAG, member_key: str | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add a True/False column telling whether `key` occurs among the members.

    Only the distinct, non-null member keys are joined, so rows never fan out
    and a null key is False. Catalyst broadcasts the members when their size
    allows it. Pass the hot keys of `df` when both sides are large.
    """
    known = (
        members.select(F.col(member_key or key).alias(key))
        .where(F.col(key).isNotNull())
        .distinct()
        .withColumn(flag, F.lit(True))
    )
    marked = join_unique(df, known, [key], hot)
    return _in_order(marked.withColumn(flag, F.coalesce(flag, F.lit(False))), [*df.columns, flag])


def add_attributes(
    df: DataFrame, key: str, reference: DataFrame, attributes: Sequence[str], hot: HotKeys | None = None,
    unique: bool = False,
) -> DataFrame:
    """Left outer lookup of reference attributes; rows without a match get nulls.

    A reference that lists a key more than once counts with one of its rows, so
    rows never fan out. `unique` vouches that it lists each key once, as a dimension
    does, and spares the look.
    """
    wanted = reference.select(key, *attributes).where(F.col(key).isNotNull())
    if not unique:
        wanted = keep_one(wanted, [key])
    return _in_order(join_unique(df, wanted, [key], hot), [*df.columns, *attributes])


def keep_members(df: DataFrame, key: str, members: DataFrame) -> DataFrame:
    """Rows whose key occurs among the members."""
    return _in_order(df.join(members.select(key), key, "left_semi"), df.columns)


def keep_strangers(df: DataFrame, key: str, members: DataFrame) -> DataFrame:
    """Rows whose key does not occur among the members; a null key never does."""
    return _in_order(df.join(members.select(key), key, "left_anti"), df.columns)
