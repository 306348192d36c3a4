"""Loads that come again: what a second run finds, rewrites and keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrylake.functions.text import path_key
from quarrylake.operators.quality import REASON, describe_rejects
from quarrylake.plans.bronze import load_new, load_references, read_bronze
from quarrylake.plans.run import run_silver
from quarrylake.queries.registry import query, table
from quarrylake.session import scratch_path
from quarrylake.sources.files import list_files, read_ledger
from quarrylake.sources.readers import CORRUPT, FILE, RESCUED, declared_documents, declared_ndjson, read_source, read_text
from quarrylake.sources.tables import read_table
from quarrylake.spec import SOURCES, Lake, Reference, Source
from quarrylake.streaming.ingest import ingest_available

ORDERS = Source("orders", "Shop", "csv", "orders", ("o_orderpriority",))


def _lake(spark: SparkSession, *sources: Source, references: tuple[Reference, ...] = ()) -> Lake:
    return Lake(scratch_path(spark, "lake"), {s.name: s for s in sources}, {r.name: r for r in references})


def _land(rows: DataFrame, lake: Lake, name: str, *keys: str) -> None:
    rows.write.mode("append").option("header", "true").partitionBy(*keys).csv(lake.landing(name))


@query("""
SELECT o_orderkey, o_totalprice, o_orderpriority, 0 AS files_found_again FROM orders
""")
def stream_batch_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files loaded by a stream and by batch loads in turns, every one of them once."""
    lake = _lake(spark, ORDERS)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    again = 0
    for status in ("F", "O", "P"):
        _land(orders.where(F.col("o_orderstatus") == status).drop("o_orderstatus"), lake, "orders", "o_orderpriority")
        if status == "O":
            load_new(spark, lake, "orders")
            again += ingest_available(spark, lake, ORDERS)
        else:
            ingest_available(spark, lake, ORDERS)
            again += load_new(spark, lake, "orders")
    return read_bronze(spark, lake, "orders").select(
        F.col("o_orderkey").cast("bigint"), F.col("o_totalprice").cast("double"), "o_orderpriority", F.lit(again).alias("files_found_again")
    )


RIDES = SOURCES["rides"]


def _rides(orders: DataFrame, later: int, *more) -> DataFrame:
    """Orders as rides of the month of their date, `later` months on; a month is one folder of the cleaned table."""
    day = F.date_format(F.add_months(F.trunc(F.col("o_orderdate").cast("date"), "month"), later), "yyyy-MM-dd")
    at = lambda clock: F.concat(day, F.lit(f"T{clock}:00Z"))
    return orders.select(
        F.concat(F.lit("R-"), F.col("o_orderkey").cast("string")).alias("ride_id"), at("10:00").alias("start_ts"),
        F.when((F.col("o_orderstatus") == "P"), at("09:00")).otherwise(at("11:00")).alias("end_ts"),
        F.date_format(F.col("o_orderdate") + F.make_interval(months=F.lit(later)), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"),
        F.lit("100").alias("distance_m"), F.lit("60").alias("duration_s"), F.col("o_totalprice").cast("string").alias("fare_amount"),
        F.lit("EUR").alias("currency"), F.lit("false").alias("is_test"), *[F.lit("1.5").alias(c) for c in ("start_lat", "start_lon", "end_lat", "end_lon")],
        F.col("o_orderpriority").alias("unlock_channel"), F.lit("ended").alias("end_reason"), *more, F.lit(f"load-{later}").alias("dt"),
    )


# Fixed for these queries: what the first run had not seen, and what of it was a first delivery.
MOVED = "o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '1997-10-01'"


@query(f"""
WITH months AS (SELECT o_orderkey, o_orderstatus, {MOVED} AS moved, CAST(date_trunc('month', o_orderdate) AS DATE) AS day FROM orders),
now AS (SELECT o_orderkey, CAST(CASE WHEN moved THEN day + INTERVAL 2 MONTH ELSE day END AS DATE) AS day FROM months WHERE o_orderstatus <> 'P'),
touched AS (SELECT day FROM months WHERE moved AND o_orderstatus <> 'P' UNION SELECT CAST(day + INTERVAL 2 MONTH AS DATE) FROM months WHERE moved AND o_orderstatus <> 'P')
SELECT 'R-' || o_orderkey AS ride_id, CAST(day AS VARCHAR) AS ride_date, day IN (SELECT day FROM touched) AS rewritten, TRUE AS as_rebuilt FROM now
""")
def rerun_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second delivery moves some rides to other days: only the days they leave and
    reach are rewritten, and the table is what a full rebuild gives."""
    lake = _lake(spark, RIDES)
    orders = table(spark, sf_dir, "orders")
    _land(_rides(orders, 0), lake, "rides", "dt")
    load_new(spark, lake, "rides")
    run_silver(spark, lake)
    before = list_files(spark, lake.silver("rides"), "*.parquet").select("path").collect()
    _land(_rides(orders.where(MOVED), 2), lake, "rides", "dt")
    load_new(spark, lake, "rides")
    run_silver(spark, lake)
    shown = ["ride_id", F.col("ride_date").cast("string").alias("ride_date"), "fare_amount"]
    rides = read_table(spark, lake.silver("rides")).select(*shown)
    files = list_files(spark, lake.silver("rides"), "*.parquet").select("path")
    old = spark.createDataFrame(before, "path string")
    fresh = files.join(old, "path", "left_anti").select(F.regexp_extract("path", "ride_date=([^/]+)/", 1).alias("ride_date")).distinct()
    kept = _stored(rides.join(fresh.withColumn("rewritten", F.lit(True)), "ride_date", "left"), spark)
    run_silver(spark, lake, whole=True)
    rebuilt = read_table(spark, lake.silver("rides")).select(*shown).withColumn("as_rebuilt", F.lit(True))
    both = kept.join(rebuilt, ["ride_id", "ride_date", "fare_amount"], "full")
    return both.select("ride_id", "ride_date", F.coalesce("rewritten", F.lit(False)).alias("rewritten"), F.coalesce("as_rebuilt", F.lit(False)).alias("as_rebuilt"))


def _stored(df: DataFrame, spark: SparkSession) -> DataFrame:
    path = scratch_path(spark, "step")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@query(f"""
SELECT 'R-' || o_orderkey AS ride_id, 'Impossible End and Start Timestamps' AS _reject_reason, NOT ({MOVED}) AS first_time_kept,
       CASE WHEN {MOVED} THEN 'rain' END AS weather
FROM orders WHERE o_orderstatus = 'P'
""")
def rerun_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of a first run keep their time when a second one brings a new column."""
    lake = _lake(spark, RIDES)
    orders = table(spark, sf_dir, "orders")
    _land(_rides(orders.where(~F.expr(MOVED)), 0), lake, "rides", "dt")
    load_new(spark, lake, "rides")
    run_silver(spark, lake)
    first = _stored(read_table(spark, lake.quarantine("rides")).select("ride_id", F.col("_reject_ts").alias("_at")), spark)
    _land(_rides(orders.where(MOVED), 2, F.lit("rain").alias("weather")), lake, "rides", "dt")
    load_new(spark, lake, "rides")
    run_silver(spark, lake)
    now = read_table(spark, lake.quarantine("rides")).join(first, "ride_id", "left")
    return now.select("ride_id", REASON, F.coalesce(F.col("_at") == F.col("_reject_ts"), F.lit(False)).alias("first_time_kept"), "weather")


NATIONS = (Reference("cities", "Maps", "cities.csv", "n_nationkey", 1), Reference("operators", "Operators", "operators.csv", "r_regionkey", 1))


def _land_reference(rows: DataFrame, lake: Lake, name: str) -> None:
    rows.coalesce(1).write.mode("overwrite").option("header", "true").csv(lake.landing(name))


@query("""
SELECT 'cities' AS reference, n_nationkey AS id, lower(n_name) AS name, 2 AS loads FROM nation
UNION ALL SELECT 'operators', r_regionkey, r_name, 1 FROM region
""")
def rerun_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference files are loaded again where their content changed, and only there."""
    lake = _lake(spark, references=NATIONS)
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    loads = {r.name: 0 for r in NATIONS}
    contents = [nations, nations, nations.withColumn("n_name", F.lower("n_name"))]
    for content in contents:
        _land_reference(content, lake, "cities")
        _land_reference(regions, lake, "operators")
        for name in load_references(spark, lake):
            loads[name] += 1
    read = lambda name, key, text: read_bronze(spark, lake, name).select(
        F.lit(name).alias("reference"), F.col(key).cast("int").alias("id"), F.col(text).alias("name"), F.lit(loads[name]).alias("loads"))
    return read("cities", "n_nationkey", "n_name").unionByName(read("operators", "r_regionkey", "r_name"))


@query("""
SELECT r_regionkey, r_name, 'operators' AS missing_first, 0 AS batches_before FROM region
""")
def missing_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing reference file fails a load before anything is written; once it is there, all load."""
    lake = _lake(spark, references=NATIONS)
    _land_reference(table(spark, sf_dir, "nation"), lake, "cities")
    missing = ""
    try:
        load_references(spark, lake)
    except FileNotFoundError as error:
        missing = str(error).split(": ")[-1]
    batches = read_ledger(spark, lake.ledger("cities")).select("batch").distinct().count()
    _land_reference(table(spark, sf_dir, "region"), lake, "operators")
    load_references(spark, lake)
    return read_bronze(spark, lake, "operators").select(
        F.col("r_regionkey").cast("int"), "r_name", F.lit(missing).alias("missing_first"), F.lit(batches).alias("batches_before")
    )


FLEET = Source("vehicles", "Fleet", "document", "vehicles", ("snapshot_date",), root="vehicles", fields=("vehicle_id", "battery.wh", "status"))


@query("""
SELECT 'V-' || c_custkey AS vehicle_id, 'nation-' || c_nationkey AS snapshot_date, CAST(c_nationkey * 10 AS VARCHAR) AS battery_wh,
       CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment END AS status,
       CASE WHEN c_nationkey % 3 = 0 THEN '{"colour":"red"}' END AS rescued
FROM customer
""")
def document_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents over many lines with their rows under `vehicles`, an undeclared field in some."""
    path = scratch_path(spark, "vehicles")
    nation = F.col("c_nationkey")
    record = F.struct(
        F.concat(F.lit("V-"), F.col("c_custkey").cast("string")).alias("vehicle_id"), F.struct((nation * 10).alias("wh")).alias("battery"),
        F.when(nation % 2 == 0, F.col("c_mktsegment")).alias("status"), F.when(nation % 3 == 0, F.lit("red")).alias("colour"),
    )
    lines = F.array_join(F.collect_list(F.to_json(record)), ",\n    ")  # a nation's customers are one document here
    document = F.concat(F.lit('{\n  "taken": "now",\n  "vehicles": [\n    '), lines, F.lit("\n  ]\n}"))
    folder = F.concat(F.lit("nation-"), nation.cast("string")).alias("snapshot_date")
    table(spark, sf_dir, "customer").groupBy(folder).agg(document.alias("value")).write.partitionBy("snapshot_date").text(path)
    return read_source(spark, path, FLEET).select("vehicle_id", "snapshot_date", "battery_wh", "status", F.col(RESCUED).alias("rescued"))


@query("""
SELECT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS o_orderkey,
       CASE o_orderstatus WHEN 'O' THEN '{"records": [{"o_orderkey": ' || o_orderkey WHEN 'P' THEN '{"other": ' || o_orderkey || '}' END AS unread
FROM orders WHERE o_orderpriority <> '5-LOW'
""")
def bad_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut-off documents and ones without the array are kept as text; empty ones give no row."""
    key = F.col("o_orderkey").cast("string")
    status = F.col("o_orderstatus")
    value = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit('{"records": []}'))
        .when(status == "O", F.concat(F.lit('{"records": [{"o_orderkey": '), key))
        .when(status == "P", F.concat(F.lit('{"other": '), key, F.lit("}")))
        .otherwise(F.concat(F.lit('{"records": [{"o_orderkey": '), key, F.lit("}]}")))
    )
    path = scratch_path(spark, "documents")
    table(spark, sf_dir, "orders").select(value.alias("value")).write.text(path)
    rows = declared_documents(spark, path, "records", ("o_orderkey",), one_per_line=True)
    return rows.select(F.col("o_orderkey").cast("bigint"), F.col(CORRUPT).alias("unread"))


@query("""
SELECT CASE WHEN event_type NOT IN ('error', 'view') THEN event_id END AS event_id,
       CASE WHEN event_type NOT IN ('error', 'view') AND value >= 50 THEN '{"late":"' || event_type || '"}' END AS rescued,
       CASE event_type WHEN 'error' THEN '{"event_id": ' || event_id WHEN 'view' THEN 'line ' || event_id END AS unread
FROM events
""")
def bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken lines are kept as text beside the good ones, blank lines are nothing, and a field nobody declared is rescued."""
    key, kind = F.col("event_id").cast("string"), F.col("event_type")
    late = F.when(F.col("value") >= 50, F.concat(F.lit(', "late": "'), kind, F.lit('"'))).otherwise(F.lit(""))
    value = (
        F.when(kind == "error", F.concat(F.lit('{"event_id": '), key))
        .when(kind == "view", F.concat(F.lit("line "), key))
        .otherwise(F.concat(F.lit('{"event_id": '), key, late, F.lit("}\n  ")))
    )
    path = scratch_path(spark, "lines")
    table(spark, sf_dir, "events").select(value.alias("value")).write.text(path)
    rows = declared_ndjson(spark, path, ("event_id",))
    return rows.select(F.col("event_id").cast("bigint"), F.col(RESCUED).alias("rescued"), F.col(CORRUPT).alias("unread"))


@query("""
SELECT c_mktsegment, length(string_agg(c_name, chr(10) ORDER BY c_custkey)) + 1 AS characters,
       md5(string_agg(c_name, chr(10) ORDER BY c_custkey) || chr(10)) AS digest
FROM customer GROUP BY c_mktsegment
""")
def whole_file_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files read whole, as one text each."""
    path = scratch_path(spark, "texts")
    names = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "c_name"))), lambda r: r["c_name"]), "\n")
    table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(names.alias("value")).write.partitionBy("c_mktsegment").text(path)
    texts = read_text(spark, path)
    return texts.select(path_key(F.col(FILE), "c_mktsegment").alias("c_mktsegment"), F.length("value").cast("bigint").alias("characters"), F.md5(F.encode("value", "UTF-8")).alias("digest"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS load, TRUE AS is_now, TRUE AS rejected_now FROM orders
""")
def load_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One moment per load, taken from the clock in UTC, and a reject's from the clock of its run."""
    lake = _lake(spark, ORDERS)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", (F.col("o_orderstatus") == "F").alias("first"))
    begun = spark.range(1).select(F.current_timestamp().alias("at")).first()["at"]
    for first in (True, False):
        _land(orders.where(F.col("first") == first).drop("first"), lake, "orders", "o_orderpriority")
        load_new(spark, lake, "orders", files_per_batch=3)
    rows = read_bronze(spark, lake, "orders").withColumn("at", F.col("_ingest_ts").cast("timestamp"))
    moments = rows.groupBy("at").agg(F.count(F.lit(1)).alias("rows"))
    # one row per load
    load = moments.select("at", F.count(F.lit(1)).over(Window.orderBy("at")).cast("int").alias("load"))
    within = (F.col("at") >= F.lit(begun)) & (F.col("at") <= F.current_timestamp())
    described = describe_rejects(rows.join(load, "at"), "orders")
    rejected = (F.col("_reject_ts") >= F.col("at")) & (F.col("_reject_ts") <= F.current_timestamp())
    return described.select(F.col("o_orderkey").cast("bigint"), "load", within.alias("is_now"), rejected.alias("rejected_now"))
