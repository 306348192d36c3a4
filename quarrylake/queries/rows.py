"""Column clean-up, lookups, rejects and duplicates over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylake.functions import amounts, text, times
from quarrylake.functions.columns import blank_where, cast_columns, flatten, unreadable
from quarrylake.operators.dedupe import distinct_records, keep_latest, keep_one
from quarrylake.operators.lookup import add_attributes, keep_members, keep_strangers, mark_members
from quarrylake.operators.quality import (
    NO_TIMES, ORPHAN_OPERATOR, REASON, REVERSED_TIMES, UNREADABLE, Rule, describe_rejects, part, tag, tag_orphans,
)
from quarrylake.operators.skew import HOT_ROWS, find_hot
from quarrylake.plans.silver import redact_deleted
from quarrylake.queries.registry import query, table, time_text


@query("""
SELECT event_id, json_extract_string(props, '$.k') AS detail_k, CAST(user_id AS VARCHAR) AS detail_by_user_id,
       '[' || user_id || ',' || event_id || ']' AS detail_ids
FROM events
""")
def flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested structs become `parent_child` text columns; a list becomes JSON text."""
    detail = F.struct(
        F.from_json("props", "k long").getField("k").alias("k"),
        F.struct("user_id").alias("by"),
        F.array("user_id", "event_id").alias("ids"),
    )
    nested = table(spark, sf_dir, "events").select("event_id", detail.alias("detail"))
    return flatten(nested).withColumn("event_id", F.col("event_id").cast("bigint"))


@query("""
SELECT s_suppkey, CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS balance, s_acctbal < 0 AS is_bad,
       s_acctbal >= 5000 AS is_rich, s_nationkey AS nation
FROM supplier
""")
def typed_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text cast to types; what does not fit is null and reported."""
    balance = F.col("s_acctbal")
    raw = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.when(balance < 0, "n/a").otherwise(balance.cast("string")).alias("balance"),
        (balance >= 5000).cast("string").alias("is_rich"),
        F.col("s_nationkey").cast("string").alias("nation"),
    )
    types = {"balance": "double", "is_rich": "boolean", "nation": "int"}
    return cast_columns(raw.withColumn("is_bad", unreadable(raw, types)), types)


SPELLING = """CASE c_nationkey WHEN 0 THEN 'ES' WHEN 1 THEN 'Spain' WHEN 2 THEN 'esp' WHEN 3 THEN 'FR'
    WHEN 4 THEN 'France' WHEN 5 THEN 'fra' WHEN 6 THEN 'SE' WHEN 7 THEN 'Sweden' WHEN 8 THEN 'SWE'
    WHEN 9 THEN 'PT' WHEN 10 THEN 'Portugal' WHEN 11 THEN NULL ELSE 'Atlantis' END"""


@query("""
SELECT c_custkey, CASE WHEN c_nationkey < 3 THEN 'ES' WHEN c_nationkey < 6 THEN 'FR'
       WHEN c_nationkey < 9 THEN 'SE' WHEN c_nationkey < 11 THEN 'PT' END AS country
FROM customer
""")
def canonical_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return customers.select("c_custkey", text.country_code(F.expr(SPELLING)).alias("country"))


@query("""
SELECT event_id, strftime(CASE event_type
    WHEN 'view' THEN date_trunc('millisecond', ts)
    WHEN 'click' THEN CASE WHEN value < 100 THEN date_trunc('second', ts) END
    WHEN 'signup' THEN ts
    WHEN 'purchase' THEN CASE WHEN value < 100 THEN date_trunc('minute', ts) END
    END, '%Y-%m-%d %H:%M:%S.%f') AS moment
FROM events
""")
def mixed_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments written in four forms and as garbage, with a zone per row that may be missing."""
    ts = F.col("ts")
    zone = F.when(F.col("value") < 5, "Europe/Madrid").when(F.col("value") < 100, "Europe/Helsinki")
    local = F.from_utc_timestamp(ts, zone)
    written = (
        F.when(F.col("event_type") == "view", F.unix_millis(ts).cast("string"))
        .when(F.col("event_type") == "click", F.date_format(local, "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("event_type") == "signup",
              F.concat(F.date_format(ts + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00")))
        .when(F.col("event_type") == "purchase", F.date_format(local, "dd/MM/yyyy HH:mm"))
        .otherwise("31/13/2026 11:56")
    )
    # a missing zone leaves no local text to write, so write it in UTC and let the parser miss the zone
    in_utc = F.when(F.col("event_type") == "click", F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.date_format(ts, "dd/MM/yyyy HH:mm")
    )
    events = table(spark, sf_dir, "events").select("event_id", F.coalesce(written, in_utc).alias("t"), zone.alias("zone"))
    return events.select("event_id", time_text(times.instant(F.col("t"), F.col("zone"))).alias("moment"))


@query("""
SELECT c_custkey, lower(c_name) || '@mail.com' AS email,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN 'Dear ' || upper(substr(c_mktsegment, 1, 1))
            || lower(substr(c_mktsegment, 2)) END AS technician,
       CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS promo_code
FROM customer
""")
def text_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-mails, person names and empty text."""
    segment = F.col("c_mktsegment")
    name = F.when(segment == "BUILDING", "  UnKnown ").otherwise(F.concat(F.lit(" dEAR "), segment, F.lit("  ")))
    email = F.concat(F.lit("  "), F.upper("c_name"), F.lit("@Mail.COM "))
    promo = F.when(F.col("c_acctbal") < 0, "").otherwise(segment)
    return table(spark, sf_dir, "customer").select(
        "c_custkey", text.email_address(email).alias("email"), text.person_name(name).alias("technician"),
        text.empty_to_null(promo).alias("promo_code"),
    )


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN NULL
       ELSE l_extendedprice END AS distance_m
FROM lineitem
""")
def unit_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances written in metres, in kilometres, with a wrong sign, and not at all readable."""
    price = F.col("l_extendedprice")
    written = (
        F.when((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N"), "far")
        .when(F.col("l_returnflag") == "A",
              F.concat((price.cast("decimal(14,2)") / 1000).cast("decimal(14,5)").cast("string"), F.lit("km")))
        .when(F.col("l_returnflag") == "R", F.concat(F.lit("-"), price.cast("string")))
        .otherwise(price.cast("string"))
    )
    lines = table(spark, sf_dir, "lineitem").withColumn("distance", written)
    return lines.select("l_orderkey", "l_linenumber", amounts.metres(F.col("distance")).alias("distance_m"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 0.088::DOUBLE ELSE o_totalprice END AS euros
FROM orders
""")
def currency_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    currency = F.expr("CASE o_orderstatus WHEN 'F' THEN 'SEK' WHEN 'O' THEN 'EUR' END")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", amounts.in_euros(F.col("o_totalprice"), currency).alias("euros")
    )


@query("""
WITH m AS (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS minor FROM orders)
SELECT o_orderkey, CAST(minor AS DECIMAL(18,0)) * 0.01 :: DOUBLE AS amount,
       CASE WHEN o_orderstatus = 'F' THEN CAST(((minor * 88 + 500) // 1000) AS DOUBLE) / 100
            ELSE CAST(minor AS DOUBLE) / 100 END AS amount_euros
FROM m
""".replace("CAST(minor AS DECIMAL(18,0)) * 0.01 :: DOUBLE", "CAST(minor AS DOUBLE) / 100"))
def minor_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cents to decimals, and to euros rounded half up."""
    amount = amounts.from_minor_units(F.round(F.col("o_totalprice") * 100).cast("bigint"))
    currency = F.when(F.col("o_orderstatus") == "F", "SEK")
    euros = amounts.in_euros(amount, currency).try_cast("decimal(10,2)")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", amount.cast("double").alias("amount"), euros.cast("double").alias("amount_euros")
    )


@query("""
SELECT event_id, CAST(round(CASE WHEN value > 1 THEN value / 100 ELSE value END, 4) AS DOUBLE) AS share
FROM events
""")
def fraction_harmonise(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = amounts.as_fraction(F.col("value").cast("decimal(10,4)"))
    return table(spark, sf_dir, "events").select("event_id", share.cast("double").alias("share"))


@query("""
SELECT event_id, CASE WHEN NOT (lat = 0 AND lon = 0) THEN lat END AS lat,
       CASE WHEN NOT (lat = 0 AND lon = 0) THEN lon END AS lon
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 0 ELSE value END AS lat,
             CASE WHEN value < 10 THEN 0 ELSE value END AS lon FROM events)
""")
def null_island(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat, lon = F.col("lat"), F.col("lon")
    value = F.col("value")
    events = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") == "error", 0.0).otherwise(value).alias("lat"),
        F.when(value < 10, 0.0).otherwise(value).alias("lon"),
    )
    return events.select(
        "event_id", amounts.off_null_island(lat, lat, lon).alias("lat"),
        amounts.off_null_island(lon, lat, lon).alias("lon"),
    )


@query("""
SELECT event_id, event_type = 'error' AS open_ride,
       CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS DOUBLE)
            WHEN event_type <> 'error' THEN CAST(floor(value) AS DOUBLE) + 0.25 END AS duration_s
FROM events
""")
def duration_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measured seconds where there are some, else the span, and nothing for an open interval."""
    seconds = F.floor("value").cast("int")
    span = F.make_dt_interval(secs=(F.floor("value") + F.lit(0.25)).cast("decimal(18,6)"))
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "ts",
        F.when(F.col("event_type") != "error", F.col("ts") + span).alias("end_ts"),
        F.when(F.col("event_type") == "purchase", seconds).alias("measured"),
    )
    return events.select(
        "event_id", times.is_open(F.col("end_ts")).alias("open_ride"),
        times.duration(F.col("measured"), F.col("ts"), F.col("end_ts")).alias("duration_s"),
    )


@query("""
SELECT o_orderkey, coalesce(o_orderstatus = 'F' AND o_totalprice >= 50000, FALSE) AS is_successful,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS payment_date
FROM orders
""")
def status_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A status as True or False, a missing one as False; the day of a moment."""
    status = F.when(F.col("o_totalprice") >= 50000, F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", text.is_value(status, "F").alias("is_successful"),
        times.day_of(F.col("o_orderdate")).cast("string").alias("payment_date"),
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority, o_orderstatus
FROM orders
""")
def conditional_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    return blank_where(orders, F.col("o_orderstatus") == "F", ["o_orderkey", "o_orderstatus"])


@query("""
SELECT c.c_custkey, n.n_name AS zone
FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) n ON c.c_nationkey = n.n_nationkey
""")
def lookup_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A left lookup with misses."""
    nations = table(spark, sf_dir, "nation").where("n_regionkey <> 0")
    zones = nations.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("zone"))
    return add_attributes(table(spark, sf_dir, "customer"), "c_nationkey", zones, ["zone"]).select("c_custkey", "zone")


def _in_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    return customers.select(F.col("c_custkey").alias("o_custkey"))


ORPHAN_SQL = "{not_}EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal >= 0)"


@query(f"""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders o WHERE {ORPHAN_SQL.format(not_='')}
""")
def fk_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that have a parent, by semi join."""
    kept = keep_members(table(spark, sf_dir, "orders"), "o_custkey", _in_credit(spark, sf_dir))
    return kept.select("o_orderkey", "o_custkey", "o_totalprice")


@query(f"""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders o WHERE {ORPHAN_SQL.format(not_='NOT ')}
""")
def fk_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that have none, by anti join."""
    strangers = keep_strangers(table(spark, sf_dir, "orders"), "o_custkey", _in_credit(spark, sf_dir))
    return strangers.select("o_orderkey", "o_custkey", "o_totalprice")


FK_SPLIT_SQL = f"""
SELECT o_orderkey, o_custkey, CASE WHEN {ORPHAN_SQL.format(not_='NOT ')} THEN 'invalid_fk_operator' END AS _reject_reason
FROM orders o
"""


def _fk_split(spark: SparkSession, sf_dir: str, hot_rows: int) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    hot = find_hot(orders, ["o_custkey"], hot_rows)
    tagged = tag_orphans(orders, "o_custkey", _in_credit(spark, sf_dir), ORPHAN_OPERATOR, hot)
    return part(tagged).both()


@query(FK_SPLIT_SQL)
def fk_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides of the foreign-key rule: together they are the whole table."""
    return _fk_split(spark, sf_dir, HOT_ROWS)


@query(FK_SPLIT_SQL)
def fk_split_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rule where customers of ten orders or more count as hot and are not shuffled."""
    return _fk_split(spark, sf_dir, 10)


@query("""
SELECT event_id, CASE WHEN event_type = 'view' THEN strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%f')
       WHEN event_type = 'click' THEN strftime(make_timestamp(event_id * 1000), '%Y-%m-%d %H:%M:%S.%f') END AS moment,
       CASE WHEN event_type NOT IN ('view', 'click') THEN 'Unreadable value' END AS _reject_reason
FROM events
""")
def epoch_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch milliseconds of any length: moments, and rejects where no timestamp holds them."""
    kind = F.col("event_type")
    written = (
        F.when(kind == "view", F.unix_millis("ts").cast("string"))
        .when(kind == "click", F.lpad(F.col("event_id").cast("string"), 19, "0"))
        .when(kind == "signup", F.concat(F.unix_millis("ts").cast("string"), F.lit("000000")))
        .otherwise(F.concat(F.lit("9" * 20), F.col("event_id").cast("string")))
    )
    events = table(spark, sf_dir, "events").select("event_id", written.alias("written"))
    tagged = tag(events, [Rule(UNREADABLE, times.beyond_timestamps(F.col("written")))])
    return tagged.select("event_id", time_text(times.instant(F.col("written"), F.lit("UTC"))).alias("moment"), REASON)


@query("""
SELECT event_id, CASE WHEN event_type = 'error' AND value < 10 THEN 'Missing Start_ts and End_ts'
       WHEN event_type = 'purchase' AND value > 20 THEN 'Impossible End and Start Timestamps' END AS _reject_reason,
       CASE WHEN (event_type = 'error' AND value < 10) OR (event_type = 'purchase' AND value > 20)
            THEN 'events' END AS _table,
       CASE WHEN (event_type = 'error' AND value < 10) OR (event_type = 'purchase' AND value > 20)
            THEN '2026-04-02' END AS reject_date
FROM events
""")
def validity_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows tagged with the first rule they break; kept and rejected are the whole table."""
    gone = (F.col("event_type") == "error") & (F.col("value") < 10)
    back = (F.col("event_type") == "purchase") & (F.col("value") > 20)
    events = table(spark, sf_dir, "events").select(
        "event_id", F.when(~gone, F.col("ts")).alias("start_ts"),
        F.when(~gone, F.when(back, F.col("ts") - F.expr("INTERVAL 1 HOUR")).otherwise(F.col("ts"))).alias("end_ts"),
    )
    start, end = F.col("start_ts"), F.col("end_ts")
    rules = [Rule(NO_TIMES, start.isNull() & end.isNull()), Rule(REVERSED_TIMES, start > end)]
    both = describe_rejects(part(tag(events, rules)).both(), "events", F.lit("2026-04-02 08:00:00").cast("timestamp"))
    rejected = F.col(REASON).isNotNull()
    return both.select(
        "event_id", REASON, F.when(rejected, F.col("_table")).alias("_table"),
        F.when(rejected, F.col("reject_date").cast("string")).alias("reject_date"),
    )


MEMBER_SQL = """
SELECT event_id, user_id, EXISTS (SELECT 1 FROM events p WHERE p.user_id = e.user_id
       AND p.event_type = 'purchase' AND p.value > 50) AS is_registered
FROM events e
"""


def _big_spenders(spark: SparkSession, sf_dir: str, hot_rows: int) -> DataFrame:
    events = table(spark, sf_dir, "events")
    spenders = events.where("event_type = 'purchase' AND value > 50")
    hot = find_hot(events, ["user_id"], hot_rows)
    return mark_members(events, "user_id", spenders, "is_registered", hot=hot).select(
        "event_id", "user_id", "is_registered"
    )


@query(MEMBER_SQL)
def membership_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a row's key occurs in another table, without collecting that table."""
    return _big_spenders(spark, sf_dir, HOT_ROWS)


@query(MEMBER_SQL)
def membership_flag_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same flag where users of seventy events or more count as hot."""
    return _big_spenders(spark, sf_dir, 70)


@query("""
WITH gone AS (SELECT DISTINCT o_custkey FROM orders
              WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND o_totalprice < 100000)
SELECT o_orderkey, o.o_custkey, CASE WHEN g.o_custkey IS NULL THEN o_totalprice END AS o_totalprice,
       CASE WHEN g.o_custkey IS NULL THEN o_orderpriority END AS o_orderpriority, g.o_custkey IS NOT NULL AS _gone
FROM orders o LEFT JOIN gone g ON o.o_custkey = g.o_custkey
""")
def redact_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of a deleted customer are blanked, earlier ones too."""
    deleted = (
        (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") < 100000)
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority",
        F.when(deleted, "D").otherwise("U").alias("op"),
    )
    hot = find_hot(table(spark, sf_dir, "orders"), ["o_custkey"])
    return redact_deleted(orders, "o_custkey", "op", ("o_orderkey", "o_custkey"), hot).drop("op")


@query("""
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id) AS r FROM events)
WHERE r = 1
""")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = keep_latest(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts")
    return latest.select("user_id", "event_type", "event_id", "value")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, min(o) AS _source_file FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, 'first' AS o FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, 'again' FROM lineitem WHERE l_returnflag = 'R')
GROUP BY ALL
""")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole records delivered twice; where they came from makes no difference."""
    lines = table(spark, sf_dir, "lineitem")
    record = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    first = lines.select(*record, F.lit("first").alias("_source_file"))
    again = lines.where("l_returnflag = 'R'").select(*record, F.lit("again").alias("_source_file"))
    return distinct_records(first.unionByName(again))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS r
  FROM lineitem) WHERE r = 1
""")
def one_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that share a key; the survivor is the same in every run."""
    lines = keep_one(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
