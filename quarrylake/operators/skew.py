"""Finding and splitting keys that hold a large share of a table.

A key is looked for by its 64-bit hash, so one code path serves text, numbers,
composite keys and null. What counts as hot only steers the plan: every
operator here returns the same rows whichever keys are called hot.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylake.session import scratch_path

# A key below this many rows fits one task; it is never split.
HOT_ROWS = 5_000_000
# A list of up to this many hot keys is broadcast (8 MB); a longer one is joined like any table.
SHORT_LIST = 1_000_000


@dataclass(frozen=True)
class HotKeys:
    """The hot keys' hashes as a stored table `h`, their number, and the rows they hold."""

    found: DataFrame | None
    keys: int
    rows: int

    def __bool__(self) -> bool:
        return self.keys > 0

    def _list(self) -> DataFrame:
        return F.broadcast(self.found) if self.keys <= SHORT_LIST else self.found

    def rows_of(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The rows of hot keys."""
        return df.join(self._list(), key_hash(keys) == F.col("h"), "left_semi")

    def others(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """All other rows."""
        return df.join(self._list(), key_hash(keys) == F.col("h"), "left_anti")


NONE_HOT = HotKeys(None, 0, 0)


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def find_hot(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> HotKeys:
    """All keys with at least `hot_rows` rows.

    Rows are counted per hash, combined map-side, so a hot key is one row per
    task. The bar is a number of rows, whatever the table's size, and the list
    stays a table of its own; the driver only learns its length. This is a job
    of its own: pass the stored table the keys come from, not a result with
    shuffles in it. A table of fewer rows than a hot key needs is only counted,
    which Parquet answers from its footers.
    """
    if df.count() < hot_rows:
        return NONE_HOT
    counts = df.groupBy(key_hash(keys).alias("h")).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= hot_rows)
    path = scratch_path(df.sparkSession, "hot-keys")
    counts.write.parquet(path)
    found = df.sparkSession.read.schema("h bigint, rows bigint").parquet(path)
    total = found.agg(F.count("h").alias("keys"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()
    return HotKeys(found.select("h"), total["keys"], total["rows"])


def join_unique(
    left: DataFrame, right: DataFrame, keys: Sequence[str], hot: HotKeys | None = None
) -> DataFrame:
    """Left outer join to a side that holds each key at most once.

    Rows of hot keys are never shuffled: they meet the right rows of those keys,
    of which there are no more than hot keys, by broadcast; all other rows take
    the ordinary join.
    """
    keys = list(keys)
    if not hot:
        return left.join(right, keys, "left")
    few = hot.rows_of(right, keys)
    spread = hot.others(left, keys).join(right, keys, "left")
    local = hot.rows_of(left, keys).join(F.broadcast(few) if hot.keys <= SHORT_LIST else few, keys, "left")
    return spread.unionByName(local)
