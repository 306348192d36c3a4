"""Dimensions and version history over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylake.functions.columns import key_first
from quarrylake.operators.dedupe import keep_latest
from quarrylake.operators.dimensions import (
    calendar, date_dimension, days_spanned, enumerated_dimension, junk_dimension, keyed, second_of_day,
    time_dimension, with_unknown_member,
)
from quarrylake.operators.history import History, build_history
from quarrylake.operators.lookup import add_attributes
from quarrylake.operators.skew import HOT_ROWS, find_hot
from quarrylake.plans import gold
from quarrylake.queries.registry import query, table, time_text
from quarrylake.spec import Reference


@query("""
SELECT sha256(CAST(n_nationkey AS VARCHAR)) AS nations_sk, n_nationkey, n_name FROM nation
UNION ALL SELECT '-1', NULL, NULL
""")
def scd1_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return gold.reference(nations, Reference("nations", "Atlas", "nation.csv", "n_nationkey", 1))


@query("""
SELECT sha256(concat_ws('|', CAST(o_custkey AS VARCHAR), CAST(CAST(o_orderdate AS DATE) AS VARCHAR))) AS terms_sk,
       o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS valid_from, min(o_orderpriority) AS o_orderpriority
FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)
UNION ALL SELECT '-1', NULL, NULL, NULL
""")
def scd2_reference_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that brings its own validity: the key covers id and start."""
    terms = table(spark, sf_dir, "orders").select(
        "o_custkey", F.col("o_orderdate").cast("date").alias("valid_from"), "o_orderpriority"
    )
    dim = gold.reference(terms, Reference("terms", "Shop", "terms.csv", "o_custkey", 2))
    return dim.withColumn("valid_from", F.col("valid_from").cast("string"))


SNAPSHOT = History("user_id", "day", ("event_type",), "user_sk", state_hash="state_hash")

SNAPSHOT_SQL = """
WITH daily AS (
  SELECT user_id, CAST(ts AS DATE) AS day, event_type FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id) AS r FROM events)
  WHERE r = 1),
hashed AS (SELECT *, sha256(coalesce(event_type, '~')) AS state_hash FROM daily),
marked AS (SELECT *, lag(state_hash) OVER (PARTITION BY user_id ORDER BY day) AS before FROM hashed),
opened AS (SELECT * FROM marked WHERE before IS DISTINCT FROM state_hash),
closed AS (
  SELECT *, strftime(day, '%Y-%m-%d %H:%M:%S') AS f,
         coalesce(strftime(lead(day) OVER (PARTITION BY user_id ORDER BY day), '%Y-%m-%d %H:%M:%S'),
                  '9999-12-31 00:00:00') AS t
  FROM opened)
SELECT sha256(concat_ws('|', CAST(user_id AS VARCHAR), f)) AS user_sk, user_id, event_type, state_hash,
       f || '.000000' AS valid_from_ts, t || '.000000' AS valid_to_ts, t = '9999-12-31 00:00:00' AS is_current
FROM closed
UNION ALL SELECT '-1', NULL, NULL, NULL, NULL, NULL, NULL
"""


def _times_as_text(dim: DataFrame) -> DataFrame:
    return dim.withColumns({c: time_text(F.col(c)) for c in ("valid_from_ts", "valid_to_ts")})


def _daily_state_history(spark: SparkSession, sf_dir: str, hot_rows: int) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "user_id", F.col("ts").cast("date").alias("day"), "ts", "event_id", "event_type"
    )
    hot = find_hot(events, ["user_id"], hot_rows)
    snapshots = keep_latest(events, ["user_id", "day"], "ts").select("user_id", "day", "event_type")
    history = build_history(snapshots, SNAPSHOT, hot=hot, hot_rows=hot_rows).drop("day")
    return _times_as_text(with_unknown_member(history, SNAPSHOT.surrogate))


@query(SNAPSHOT_SQL)
def scd2_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History from one full row per entity and day."""
    return _daily_state_history(spark, sf_dir, HOT_ROWS)


@query(SNAPSHOT_SQL)
def scd2_snapshot_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history where users of 70 events or more are cut along time."""
    return _daily_state_history(spark, sf_dir, 70)


CHANGES = History("user_id", "ts", ("grade",), "user_sk", op="op")

CHANGES_SQL = """
WITH log AS (
  SELECT user_id, ts, event_id, CASE event_type WHEN 'error' THEN 'D' WHEN 'signup' THEN 'I' ELSE 'U' END AS op,
         CASE WHEN value < 5 THEN 'low' WHEN value < 20 THEN 'mid' ELSE 'high' END AS grade
  FROM events),
gated AS (
  SELECT *, last_value(CASE WHEN op <> 'U' THEN op END IGNORE NULLS) OVER (
      PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS turn FROM log),
seen AS (SELECT * FROM gated WHERE NOT (op = 'U' AND turn IS NOT DISTINCT FROM 'D')),
stated AS (SELECT *, CASE WHEN op = 'D' THEN 'gone' ELSE grade END AS state FROM seen),
marked AS (SELECT *, lag(state) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM stated),
opened AS (SELECT * FROM marked WHERE before IS DISTINCT FROM state),
closed AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS until FROM opened)
SELECT sha256(concat_ws('|', CAST(user_id AS VARCHAR), CAST(ts AS VARCHAR))) AS user_sk, user_id, event_id, op, grade,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS valid_from_ts,
       coalesce(strftime(until, '%Y-%m-%d %H:%M:%S.%f'), '9999-12-31 00:00:00.000000') AS valid_to_ts,
       until IS NULL AS is_current
FROM closed WHERE op <> 'D'
UNION ALL SELECT '-1', NULL, NULL, NULL, NULL, NULL, NULL, NULL
"""


def _change_history(spark: SparkSession, sf_dir: str, hot_rows: int) -> DataFrame:
    op = F.when(F.col("event_type") == "error", "D").when(F.col("event_type") == "signup", "I").otherwise("U")
    grade = F.when(F.col("value") < 5, "low").when(F.col("value") < 20, "mid").otherwise("high")
    log = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", op.alias("op"), grade.alias("grade"))
    history = build_history(log, CHANGES, hot_rows=hot_rows).drop("ts")
    return _times_as_text(with_unknown_member(history, CHANGES.surrogate))


@query(CHANGES_SQL)
def scd2_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History from a change log: deletes close a version, and only an insert opens the next."""
    return _change_history(spark, sf_dir, HOT_ROWS)


@query(CHANGES_SQL)
def scd2_changes_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history where users of 75 events or more are cut along time."""
    return _change_history(spark, sf_dir, 75)


@query("""
SELECT r_name AS region_sk, r_regionkey, upper(r_name) AS label FROM region
UNION ALL SELECT '-1', NULL, NULL
""")
def unknown_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region").select(
        "r_regionkey", F.upper("r_name").alias("label"), F.col("r_name").alias("region_sk")
    )
    return with_unknown_member(key_first(regions, "region_sk"), "region_sk")


@query("""
WITH bounds AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders),
days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds)
SELECT sha256(CAST(d AS VARCHAR)) AS date_sk, CAST(d AS VARCHAR) AS date, CAST(month(d) AS INT) AS month,
       CAST(year(d) AS INT) AS year, CAST(day(d) AS INT) AS day, CAST(isodow(d) - 1 AS INT) AS day_week,
       isodow(d) >= 6 AS is_weekend
FROM days
UNION ALL SELECT '-1', NULL, NULL, NULL, NULL, NULL, NULL
""")
def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calendar from the first to the last day of the orders."""
    dim = date_dimension(days_spanned(table(spark, sf_dir, "orders"), "o_orderdate"))
    return dim.withColumn("date", F.col("date").cast("string"))


@query("""
SELECT l_orderkey, l_linenumber, CAST(isodow(l_shipdate) - 1 AS INT) AS day_week, isodow(l_shipdate) >= 6 AS is_weekend
FROM lineitem
""")
def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar attributes computed on the rows of a large table."""
    lines = table(spark, sf_dir, "lineitem").withColumn("ship_day", F.col("l_shipdate").cast("date"))
    return calendar(lines, "ship_day").select("l_orderkey", "l_linenumber", "day_week", "is_weekend")


@query("""
SELECT event_id, sha256('1970-01-01 ' || strftime(ts, '%H:%M:%S')) AS time_sk FROM events
""")
def time_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's member of the time-of-day dimension."""
    events = table(spark, sf_dir, "events").select("event_id", second_of_day(F.col("ts")).alias("time"))
    return add_attributes(events, "time", time_dimension(spark), ["time_sk"], unique=True).select("event_id", "time_sk")


@query("""
SELECT sha256(coalesce(v, '~')) AS priority_sk, v AS priority FROM (
  SELECT DISTINCT CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_orderpriority END AS v FROM orders)
UNION ALL SELECT '-1', NULL
""")
def enum_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One member per distinct value, null included."""
    priority = F.when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_orderpriority")).alias("priority")
    return enumerated_dimension(table(spark, sf_dir, "orders").select(priority), "priority", "priority_sk")


@query("""
WITH a AS (SELECT DISTINCT o_orderstatus AS s FROM orders), b AS (SELECT DISTINCT o_orderpriority AS p FROM orders),
c AS (SELECT DISTINCT o_totalprice > 250000 AS x FROM orders),
d AS (SELECT DISTINCT CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN year(o_orderdate) END AS y FROM orders)
SELECT sha256(concat_ws('|', s, p, CAST(x AS VARCHAR), coalesce(CAST(y AS VARCHAR), '~'))) AS context_sk,
       s AS status, p AS priority, x AS is_big, CAST(y AS INT) AS since
FROM a CROSS JOIN b CROSS JOIN c CROSS JOIN d
UNION ALL SELECT '-1', NULL, NULL, NULL, NULL
""")
def junk_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every combination of four enumerations, one of them with a null."""
    day = F.col("o_orderdate")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
        (F.col("o_totalprice") > 250000).alias("is_big"),
        F.when(day >= F.lit("1998-01-01").cast("timestamp"), F.year(day)).alias("since"),
    )
    return junk_dimension(orders, ["status", "priority", "is_big", "since"], "context_sk")


@query("""
SELECT DISTINCT sha256(concat_ws('|', event_type, CAST(CAST(ts AS DATE) AS VARCHAR))) AS day_sk, event_type,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS date
FROM events
UNION ALL SELECT '-1', NULL, NULL
""")
def daily_composite_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key over a place and a day."""
    days = table(spark, sf_dir, "events").select("event_type", F.col("ts").cast("date").cast("string").alias("date"))
    return with_unknown_member(keyed(days.distinct(), "day_sk", "event_type", "date"), "day_sk")
