"""Type-2 history: from full snapshots or from a change log with deletes.

A version opens when the tracked state differs from the one before and ends
where the next version opens. One shuffle and one sort by entity serve both
window passes. Entities too large for a task are cut along time into chunks
of equal depth and stored with what each chunk says of its rows; one summary of a
row per chunk then settles what depends on the neighbouring chunks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylake.functions.keys import hashed
from quarrylake.operators.dedupe import keep_one
from quarrylake.operators.skew import HOT_ROWS, HotKeys, find_hot
from quarrylake.session import scratch_path

# The end of an open version, and the letters of a change log.
OPEN_END = "9999-12-31 00:00:00"
INSERT, UPDATE, DELETE = "I", "U", "D"


@dataclass(frozen=True)
class History:
    """How a table becomes history: entity, time column, tracked columns, key name."""

    entity: str
    moment: str
    tracked: tuple[str, ...]
    surrogate: str
    op: str | None = None
    state_hash: str | None = None


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp")


def _as_number(df: DataFrame, moment: str) -> Column:
    """The time column as a double that never falls as time rises; null sorts first."""
    kind = dict(df.dtypes)[moment]
    value = F.col(moment).cast("timestamp") if kind in ("date", "timestamp_ntz") else F.col(moment)
    return F.coalesce(value.cast("double"), F.lit(float("-inf")))


def cut_along_time(df: DataFrame, moment: str, chunks: int) -> DataFrame:
    """Add `_chunk`, the number of the equal-depth slice of time a row falls in.

    Slices are cut over all rows together, so no entity has more rows in a
    slice than the slice holds. Rows of equal time share a slice.
    """
    timed = df.withColumn("_at", _as_number(df, moment))
    shares = [i / chunks for i in range(1, chunks)]
    cuts = timed.where(F.col("_at") > float("-inf")).agg(
        F.percentile_approx("_at", shares, 4 * chunks).alias("cuts")
    ).first()["cuts"]
    edges = [float("-inf"), *sorted(set(cuts or [])), float("inf")]
    if len(edges) < 3:
        return timed.withColumn("_chunk", F.lit(0.0)).drop("_at")
    cutter = Bucketizer(splits=edges, inputCol="_at", outputCol="_chunk", handleInvalid="keep")
    return cutter.transform(timed).drop("_at")


def _ghost(op: str, last_turn: Column) -> Column:
    """An update that comes after a delete: only an insert brings an entity back."""
    return F.coalesce((F.col(op) == UPDATE) & (last_turn == DELETE), F.lit(False))


def _turn(op: str) -> Column:
    return F.when(F.col(op).isin(INSERT, DELETE), F.col(op))


def _state(spec: History) -> Column:
    """What a change is judged by; all deletes look alike and differ from any live state."""
    live = F.struct(*[F.col(c) for c in spec.tracked])
    if spec.op is None:
        return F.struct(F.lit(True).alias("alive"), live.alias("live"))
    alive = F.coalesce(F.col(spec.op) != DELETE, F.lit(True))
    return F.struct(alive.alias("alive"), F.when(alive, live).alias("live"))


def _start(spec: History) -> Column:
    return F.col(spec.moment).cast("timestamp")


def _versions(df: DataFrame, spec: History) -> DataFrame:
    """Versions of entities that fit one task.

    The rows are repartitioned first and widened after, so that the shuffle
    carries the table's own columns only; both windows reuse it.
    """
    w = Window.partitionBy(spec.entity).orderBy(spec.moment)
    rows = df.repartition(F.col(spec.entity))
    if spec.op is not None:
        so_far = w.rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumn("_turn", F.last(_turn(spec.op), ignorenulls=True).over(so_far))
        rows = rows.where(~_ghost(spec.op, F.col("_turn"))).drop("_turn")
    opened = rows.withColumn("_state", _state(spec)).withColumn("_before", F.lag("_state").over(w))
    opened = opened.where(~F.col("_state").eqNullSafe(F.col("_before"))).drop("_before")
    opened = opened.withColumn("valid_from_ts", _start(spec))
    return opened.withColumn("valid_to_ts", F.coalesce(F.lead("valid_from_ts").over(w), open_end()))


def _passed(df: DataFrame, spec: History) -> DataFrame:
    """Stored rows of chunked entities with what their own chunk says about them.

    An update ahead of its chunk's first insert or delete is loose: whether it is a ghost
    is up to earlier chunks. So heads and changes are told twice, among all rows of the
    chunk and among the firm ones.
    """
    w = Window.partitionBy("_key", "_chunk").orderBy(spec.moment)
    rows = df.withColumn("_key", F.struct(spec.entity)).repartition("_key", "_chunk")
    loose = F.lit(False)
    if spec.op is not None:
        so_far = w.rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumn("_turn", F.last(_turn(spec.op), ignorenulls=True).over(so_far))
        rows = rows.where(~_ghost(spec.op, F.col("_turn")))
        loose = F.coalesce((F.col(spec.op) == UPDATE) & F.col("_turn").isNull(), F.lit(False))
    state = _state(spec)
    rows = rows.withColumn("_loose", loose).withColumns({"_head_any": F.row_number().over(w) == 1, "_before": F.lag(state).over(w)})
    marks = {"_changed_any": ~F.col("_head_any") & ~state.eqNullSafe(F.col("_before"))}
    if spec.op is not None:
        earlier = w.rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("_firm_before", F.last(F.when(~F.col("_loose"), state), ignorenulls=True).over(earlier))
        marks["_head_firm"] = ~F.col("_loose") & F.col("_firm_before").isNull()
        marks["_changed_firm"] = ~F.col("_loose") & F.col("_firm_before").isNotNull() & ~state.eqNullSafe(F.col("_firm_before"))
    rows = rows.withColumns(marks).drop("_before", "_firm_before")
    path = scratch_path(df.sparkSession, "history-chunks")
    rows.write.parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def _chunk_edges(rows: DataFrame, spec: History) -> DataFrame:
    """Per entity and chunk: whether its loose rows are ghosts, whether its first row opens
    a version, and when the next chunk's first version opens. One row per chunk is
    summed up from the rows; the rest is over those."""
    state, start = _state(spec), _start(spec)
    sides = {"any": F.lit(True), "firm": ~F.col("_loose")} if spec.op is not None else {"any": F.lit(True)}
    sums = []
    for side, own in sides.items():
        at = F.when(own, F.struct(spec.moment))
        sums += [
            F.min_by(state, at).alias(f"_first_{side}"), F.max_by(state, at).alias(f"_last_{side}"),
            F.min(F.when(own, start)).alias(f"_first_at_{side}"), F.min(F.when(F.col(f"_changed_{side}"), start)).alias(f"_inner_at_{side}"),
        ]
    if spec.op is not None:
        sums.append(F.max_by("_turn", F.struct(spec.moment)).alias("_end_turn"))
    chunks = rows.groupBy("_key", "_chunk").agg(*sums)
    along = Window.partitionBy("_key").orderBy("_chunk")
    before, later = along.rowsBetween(Window.unboundedPreceding, -1), along.rowsBetween(1, Window.unboundedFollowing)
    firm = F.lit(False)
    if spec.op is not None:
        firm = F.coalesce(F.last("_end_turn", ignorenulls=True).over(before) == DELETE, F.lit(False))
    chunks = chunks.withColumn("_firm", firm)

    def chosen(name: str) -> Column:
        return F.when(F.col("_firm"), F.col(f"{name}_firm")).otherwise(F.col(f"{name}_any")) if spec.op is not None else F.col(f"{name}_any")

    chunks = chunks.select("_key", "_chunk", "_firm", *[chosen(n).alias(n) for n in ("_first", "_last", "_first_at", "_inner_at")])
    opens = F.col("_first").isNotNull() & ~F.col("_first").eqNullSafe(F.last("_last", ignorenulls=True).over(before))
    chunks = chunks.withColumn("_head_opens", opens)
    opens_at = F.when(F.col("_head_opens"), F.col("_first_at")).otherwise(F.col("_inner_at"))
    next_at = F.first("_opens_at", ignorenulls=True).over(later).alias("_next_at")
    return chunks.withColumn("_opens_at", opens_at).select("_key", "_chunk", "_firm", "_head_opens", next_at)


def _versions_by_chunk(df: DataFrame, spec: History) -> DataFrame:
    """Versions of entities cut along time; the result is that of `_versions`.

    The rows are read and shuffled once and stored with their chunk's view of them; one
    summary of a row per chunk then decides.
    """
    rows = _passed(df, spec)
    marked = rows.join(_chunk_edges(rows, spec), ["_key", "_chunk"])
    head, changed = F.col("_head_any"), F.col("_changed_any")
    if spec.op is not None:
        head = F.when(F.col("_firm"), F.col("_head_firm")).otherwise(head)
        changed = F.when(F.col("_firm"), F.col("_changed_firm")).otherwise(changed)
    opened = marked.where(F.when(head, F.col("_head_opens")).otherwise(changed))
    opened = opened.withColumns({"_state": _state(spec), "valid_from_ts": _start(spec)})
    w = Window.partitionBy("_key", "_chunk").orderBy(spec.moment)
    ends = F.coalesce(F.lead("valid_from_ts").over(w), F.col("_next_at"), open_end())
    return opened.select(*[F.col(f"`{c}`") for c in df.columns if c != "_chunk"], "_state", "valid_from_ts", ends.alias("valid_to_ts"))


def build_history(
    df: DataFrame, spec: History, ties: Sequence[Column] | None = None, hot: HotKeys | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Versions with `[valid_from_ts, valid_to_ts)`, `is_current` and a hashed key in front.

    An entity must have one row per moment; pass `ties` to keep, of rows that
    share a moment, the first under that order. With an `op` column deletes
    close a version but are not versions themselves. Unless `hot` is given,
    the entities of more than `hot_rows` rows are looked for in `df`.
    """
    if hot is None:
        hot = find_hot(df, [spec.entity], hot_rows)
    if ties is not None:
        df = keep_one(df, [spec.entity, spec.moment], *ties)
    columns = df.columns
    if hot:
        chunks = max(2, -(-hot.rows // hot_rows))
        large = cut_along_time(hot.rows_of(df, [spec.entity]), spec.moment, chunks)
        versions = _versions(hot.others(df, [spec.entity]), spec).unionByName(_versions_by_chunk(large, spec))
    else:
        versions = _versions(df, spec)

    if spec.op is not None:
        versions = versions.where(F.col("_state.alive"))
    if spec.state_hash:
        versions = versions.withColumn(spec.state_hash, hashed(*[F.col(c) for c in spec.tracked]))
        columns = [*columns, spec.state_hash]
    versions = versions.withColumns(
        {
            "is_current": F.col("valid_to_ts") == open_end(),
            spec.surrogate: hashed(F.col(spec.entity), F.col("valid_from_ts")),
        }
    )
    return versions.select(spec.surrogate, *columns, "valid_from_ts", "valid_to_ts", "is_current")
