"""Reject rules: tag each row with its first failed rule, then part the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylake.functions.columns import quoted, unreadable
from quarrylake.operators.lookup import FLAG, mark_members
from quarrylake.operators.skew import HotKeys

REASON = "_reject_reason"
RAW = "_raw"
UNREAD = "_corrupt_record"  # the reader's copy of text it could not parse

# The reasons written to quarantine.
ORPHAN_OPERATOR = "invalid_fk_operator"
ORPHAN_RIDE = "Invalid ride_id"
NO_TIMES = "Missing Start_ts and End_ts"
REVERSED_TIMES = "Impossible End and Start Timestamps"
UNKNOWN_COUNTRY = "Unknown country"
UNREADABLE = "Unreadable value"
NO_KEY = "Missing key"


class Rule(NamedTuple):
    reason: str
    broken: Column


class Parted(NamedTuple):
    """The good rows, and the rejected rows with their reason.

    `tagged` holds both in one plan where the two sides differ by nothing but
    the reason; a job that needs both should run that plan once.
    """

    kept: DataFrame
    rejected: DataFrame
    tagged: DataFrame | None = None

    def both(self) -> DataFrame:
        if self.tagged is not None:
            return self.tagged
        return self.kept.unionByName(self.rejected, allowMissingColumns=True)


def tag(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the reason of the first broken rule, null on good rows; an unknown test is not broken."""
    reasons = [F.when(rule.broken, F.lit(rule.reason)) for rule in rules]
    earlier = [F.col(REASON)] if REASON in df.columns else []
    return df.withColumn(REASON, F.coalesce(*earlier, *reasons, F.lit(None).cast("string")))


APART = "_apart"


def rejects_apart(tagged: DataFrame) -> DataFrame:
    """Add a column that is null on good rows and a number of its own on every reject.

    As one more key of a duplicate rule it keeps all rejects, so that good rows are
    thinned out inside the one plan that holds both sides.
    """
    return tagged.withColumn(APART, F.when(F.col(REASON).isNotNull(), F.monotonically_increasing_id()))


def part(tagged: DataFrame) -> Parted:
    """Every row lands on exactly one side."""
    kept = tagged.where(F.col(REASON).isNull()).drop(REASON, RAW, UNREAD)
    return Parted(kept, tagged.where(F.col(REASON).isNotNull()), tagged)


def tag_orphans(
    df: DataFrame, key: str, parents: DataFrame, reason: str, hot: HotKeys | None = None
) -> DataFrame:
    """Tag the rows whose foreign key, null included, has no parent."""
    marked = mark_members(df, key, parents, FLAG, hot=hot)
    return tag(marked, [Rule(reason, ~F.col(FLAG))]).drop(FLAG)


def tag_keyless(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Tag the rows without a key, such as lines that could not be read."""
    return tag(df, [Rule(NO_KEY, F.col(k).isNull()) for k in keys])


def tag_unreadable(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Tag the rows where a typed column's text does not fit; `_raw` keeps them as they came,
    and so it does for rows that were found unreadable before."""
    bad = unreadable(df, types)
    known = F.coalesce(F.col(REASON) == UNREADABLE, F.lit(False)) if REASON in df.columns else F.lit(False)
    raw = F.when(bad | known, F.to_json(F.struct(*[quoted(c) for c in df.columns if c != REASON])))
    return tag(df.withColumn(RAW, raw), [Rule(UNREADABLE, bad)])


def describe_rejects(rejected: DataFrame, table: str, at: Column | None = None) -> DataFrame:
    """Add the reject time, the table's name and the day the quarantine is laid out by."""
    moment = F.current_timestamp() if at is None else at
    described = rejected.withColumns({"_reject_ts": moment, "_table": F.lit(table)})
    return described.withColumn("reject_date", F.to_date("_reject_ts"))
