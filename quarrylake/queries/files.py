"""Sources and sinks: the given tables are written as raw files and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylake.functions.columns import union_by_name
from quarrylake.functions.text import city_of_file, path_key
from quarrylake.operators.quality import describe_rejects
from quarrylake.plans.bronze import ENDINGS, load_new, read_bronze
from quarrylake.queries.registry import query, table
from quarrylake.session import scratch_path
from quarrylake.sources.files import bind, first_key, key_inventory, list_files, pending, record, read_ledger
from quarrylake.sources.readers import declared_documents, declared_xml, read_csv, read_source
from quarrylake.sources.tables import append_rejects, read_table, stamp, write_table
from quarrylake.spec import Lake, Source
from quarrylake.streaming.ingest import ingest_available

CRM = Source("customers", "Crm", "csv", "customers", ("c_mktsegment",))
ORDERS = Source("orders", "Shop", "csv", "orders", ("o_orderpriority",))


def _customers_as_csv(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "customers")
    customers = table(spark, sf_dir, "customer")
    customers.write.option("header", "true").partitionBy("c_mktsegment").csv(path)
    return path


@query("""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
""")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files in key folders, read as text and typed."""
    rows = read_source(spark, _customers_as_csv(spark, sf_dir), CRM)
    return rows.select(
        F.col("c_custkey").cast("bigint"), "c_name", F.col("c_nationkey").cast("int"),
        F.col("c_acctbal").cast("double"), "c_mktsegment",
    )


@query("""
SELECT o_orderkey,
       CASE WHEN o_orderdate < TIMESTAMP '1998-06-01' THEN o_custkey END AS o_custkey,
       o_totalprice,
       CASE WHEN o_orderdate >= TIMESTAMP '1998-06-01' THEN o_orderpriority END AS o_orderpriority
FROM orders
""")
def csv_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries with different columns in a different order, matched by name."""
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "drift")
    is_early = F.col("o_orderdate") < F.lit("1998-06-01").cast("timestamp")
    early = orders.where(is_early).select("o_orderkey", "o_custkey", "o_totalprice")
    late = orders.where(~is_early).select("o_totalprice", "o_orderpriority", "o_orderkey")
    early.write.option("header", "true").csv(f"{path}/delivery=1")
    late.write.option("header", "true").csv(f"{path}/delivery=2")
    return read_csv(spark, path).select(
        F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"),
        F.col("o_totalprice").cast("double"), "o_orderpriority",
    )


@query("""
SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k
FROM events
""")
def ndjson_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with a nested object, flattened to `props_k`."""
    path = scratch_path(spark, "ndjson")
    events = table(spark, sf_dir, "events").withColumn("props", F.from_json("props", "k long"))
    events.write.partitionBy("event_type").json(path)
    source = Source("events", "Web", "ndjson", "events", ("event_type",), fields=("event_id", "ts", "user_id", "value", "props.k"))
    return read_source(spark, path, source).select(
        F.col("event_id").cast("bigint"), F.col("user_id").cast("bigint"), "event_type",
        F.col("props_k").cast("bigint"),
    )


def _order_documents(spark: SparkSession, sf_dir: str) -> str:
    """One document per order and line: an envelope, and an array of two amounts."""
    path = scratch_path(spark, "documents")
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    amounts = [
        F.struct(key.alias("o_orderkey"), F.lit("gross").alias("kind"), price.alias("amount"),
                 F.lit("till").alias("source"), F.struct(F.lit("EUR").alias("code")).alias("currency")),
        F.struct(key.alias("o_orderkey"), F.lit("half").alias("kind"), (price / 2).alias("amount"),
                 F.lit("till").alias("source"), F.struct(F.lit("EUR").alias("code")).alias("currency")),
    ]
    documents = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("status"), F.lit("envelope").alias("source"),
        F.array(*amounts).alias("records"),
    )
    documents.write.json(path)
    return path


ORDER_FIELDS = ("o_orderkey", "kind", "amount", "source", "currency.code")

DOCUMENT_SQL = """
SELECT o_orderkey, 'gross' AS kind, o_totalprice AS amount, 'till' AS source, 'EUR' AS currency_code {extra}
FROM orders
UNION ALL
SELECT o_orderkey, 'half', o_totalprice / 2, 'till', 'EUR' {extra} FROM orders
"""


@query(DOCUMENT_SQL.format(extra=""))
def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows inside documents; the envelope is dropped."""
    rows = declared_documents(spark, _order_documents(spark, sf_dir), "records", ORDER_FIELDS, one_per_line=True)
    return rows.select(
        F.col("o_orderkey").cast("bigint"), "kind", F.col("amount").cast("double"), "source", "currency_code"
    )


@query(DOCUMENT_SQL.format(extra=", o_orderstatus AS status"))
def document_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The envelope repeated on each row; `source` of the element wins."""
    fields = (*ORDER_FIELDS, "status")
    rows = declared_documents(spark, _order_documents(spark, sf_dir), "records", fields, envelope=True, one_per_line=True)
    return rows.select(
        F.col("o_orderkey").cast("bigint"), "kind", F.col("amount").cast("double"), "source",
        "currency_code", "status",
    )


@query("""
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, 'EUR' AS balance_currency,
       c_mktsegment AS segment
FROM customer
""")
def xml_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """XML rows with attributes, child attributes and a repeated child, whose last one counts."""
    path = scratch_path(spark, "xml")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("_id"), F.col("c_name").alias("name"),
        F.struct(F.col("c_acctbal").alias("_VALUE"), F.lit("EUR").alias("_currency")).alias("balance"),
        F.array(F.lit("none"), F.col("c_mktsegment")).alias("segment"),
    )
    customers.write.format("xml").option("rootTag", "events").option("rowTag", "event").save(path)
    return declared_xml(spark, path, "event", ("@id", "name", "balance", "balance.@currency", "segment")).select(
        F.col("id").cast("bigint"), "name", F.col("balance").cast("double"), "balance_currency", "segment"
    )


@query("""
SELECT l_orderkey, l_linenumber, l_quantity,
       CASE WHEN l_returnflag = 'R' THEN l_extendedprice END AS l_extendedprice,
       CASE WHEN l_returnflag <> 'R' THEN l_discount END AS l_discount
FROM lineitem
""")
def parquet_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two Parquet deliveries whose columns drifted, united by name."""
    lines = table(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "merge")
    returned = F.col("l_returnflag") == "R"
    common = ["l_orderkey", "l_linenumber", "l_quantity"]
    lines.where(returned).select(*common, "l_extendedprice").write.parquet(f"{path}/delivery=1")
    lines.where(~returned).select("l_discount", *common).write.parquet(f"{path}/delivery=2")
    return read_table(spark, path, merge=True).select(*common, "l_extendedprice", "l_discount")


def _events_by_type_and_day(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "events")
    events = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    write_table(events, path, ["event_type", "day"])
    return path


@query("""
SELECT DISTINCT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, TRUE AS has_files FROM events
""")
def partition_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folder keys of a laid-out table, from its file list alone."""
    files = list_files(spark, _events_by_type_and_day(spark, sf_dir), "*.parquet")
    return key_inventory(files, ["event_type", "day"]).select(
        "event_type", "day", (F.col("files") > 0).alias("has_files")
    )


@query("""
SELECT DISTINCT 'event_type' AS key, event_type AS value FROM events
""")
def first_path_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name and value of the first folder key of each file."""
    base = _events_by_type_and_day(spark, sf_dir)
    return first_key(list_files(spark, base, "*.parquet"), base).select("key", "value").distinct()


@query("""
SELECT event_id, user_id, value, event_type FROM events WHERE event_type = 'purchase'
""")
def bound_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder of a laid-out table; only its files are read."""
    laid_out = read_table(spark, _events_by_type_and_day(spark, sf_dir))
    return bind(laid_out, event_type="purchase").select("event_id", "user_id", "value", "event_type")


@query("""
SELECT o_orderkey, 'CTY-' || o_orderstatus AS city_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS dt
FROM orders
""")
def path_key_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City from a file's name and day from its folder."""
    day = F.col("o_orderdate").cast("date").cast("string")
    path = F.concat(
        F.lit("file:/lake/landing/rides/dt="), day, F.lit("/rides_CTY-"), "o_orderstatus",
        F.lit("_"), day, F.lit(".csv"),
    )
    orders = table(spark, sf_dir, "orders").withColumn("path", path)
    return orders.select(
        "o_orderkey", city_of_file(F.col("path")).alias("city_id"), path_key(F.col("path"), "dt").alias("dt")
    )


@query("""
SELECT c_custkey, c_mktsegment AS source_segment, 'Crm' AS _source_system,
       '2026-04-02T03:04:05.000006+00:00' AS _ingest_ts
FROM customer
""")
def provenance_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw row names its file, its load and its system."""
    rows = read_source(spark, _customers_as_csv(spark, sf_dir), CRM)
    stamped = stamp(rows, CRM.system, F.lit("2026-04-02 03:04:05.000006").cast("timestamp"))
    return stamped.select(
        F.col("c_custkey").cast("bigint"), path_key(F.col("_source_file"), "c_mktsegment").alias("source_segment"),
        "_source_system", "_ingest_ts",
    )


@query("""
SELECT event_id, CASE WHEN event_type = 'view' THEN value END AS value,
       CASE WHEN event_type <> 'view' THEN props END AS props
FROM events
""")
def ragged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union by name of frames with different columns."""
    events = table(spark, sf_dir, "events")
    views = events.where("event_type = 'view'").select("event_id", "value")
    return union_by_name(views, events.where("event_type <> 'view'").select("props", "event_id")).select(
        "event_id", "value", "props"
    )


@query("""
SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderstatus = 'F'
""")
def overwritten_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced as a whole: nothing of the first write is left."""
    path = scratch_path(spark, "replaced")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    write_table(orders.drop("o_orderstatus"), path)
    finished = orders.where("o_orderstatus = 'F'")
    write_table(finished.select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice")), path)
    return read_table(spark, path)


@query("""
SELECT event_id, user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
       CASE WHEN CAST(ts AS DATE) = DATE '2024-01-02' THEN value * 2 ELSE value END AS value
FROM events
""")
def partitioned_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table laid out by day; a second write replaces one day and leaves the others."""
    path = scratch_path(spark, "by-day")
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "value", F.col("ts").cast("date").alias("day")
    )
    write_table(events, path, ["day"])
    corrected = events.where("day = DATE '2024-01-02'").withColumn("value", F.col("value") * 2)
    write_table(corrected, path, ["day"])
    return read_table(spark, path).select(
        "event_id", "user_id", F.col("day").cast("string").alias("day"), "value"
    )


@query("""
SELECT event_id, 'Too cheap' AS _reject_reason, 'events' AS _table,
       CASE WHEN event_type = 'error' THEN '2026-04-02' ELSE '2026-04-03' END AS reject_date
FROM events WHERE value < 10
""")
def quarantine_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of two runs, added to one quarantine table."""
    path = scratch_path(spark, "quarantine")
    cheap = table(spark, sf_dir, "events").where("value < 10").select(
        "event_id", "event_type", F.lit("Too cheap").alias("_reject_reason")
    )
    first, second = cheap.where("event_type = 'error'"), cheap.where("event_type <> 'error'")
    for rejected, at in ((first, "2026-04-02 08:00:00"), (second, "2026-04-03 08:00:00")):
        append_rejects(describe_rejects(rejected, "events", F.lit(at).cast("timestamp")), path)
    return read_table(spark, path).select(
        "event_id", "_reject_reason", "_table", F.col("reject_date").cast("string").alias("reject_date")
    )


def _land_orders(spark: SparkSession, sf_dir: str, lake: Lake, late: bool) -> None:
    """Early orders first; late ones come as new files of the same folders."""
    is_late = F.col("o_orderdate") >= F.lit("1998-06-01").cast("timestamp")
    orders = table(spark, sf_dir, "orders").where(is_late if late else ~is_late)
    delivered = orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    writer = delivered.write.mode("append").option("header", "true")
    writer.partitionBy("o_orderpriority").csv(lake.landing("orders"))


@query("""
SELECT o_orderkey, o_totalprice, o_orderpriority, 'Shop' AS _source_system FROM orders
""")
def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads: early files, late files of the same folders, and nothing new."""
    lake = Lake(scratch_path(spark, "lake"), sources={"orders": ORDERS}, references={})
    for late in (False, True):
        _land_orders(spark, sf_dir, lake, late)
        load_new(spark, lake, "orders")
    load_new(spark, lake, "orders")
    return read_bronze(spark, lake, "orders").select(
        F.col("o_orderkey").cast("bigint"), F.col("o_totalprice").cast("double"), "o_orderpriority",
        "_source_system",
    )


@query("""
SELECT DISTINCT o_orderpriority, TRUE AS is_pending FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-06-01'
""")
def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files the ledger does not name, after the early ones were recorded."""
    lake = Lake(scratch_path(spark, "lake"), sources={"orders": ORDERS}, references={})
    ending = ENDINGS[ORDERS.format]
    _land_orders(spark, sf_dir, lake, late=False)
    record(list_files(spark, lake.landing("orders"), ending), lake.ledger("orders"), "first")
    _land_orders(spark, sf_dir, lake, late=True)
    waiting = pending(list_files(spark, lake.landing("orders"), ending), read_ledger(spark, lake.ledger("orders")))
    return key_inventory(waiting, ["o_orderpriority"]).select(
        "o_orderpriority", (F.col("files") > 0).alias("is_pending")
    )


@query("""
SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders
""")
def stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same loads as a stream that takes what is there and stops."""
    lake = Lake(scratch_path(spark, "lake"), sources={"orders": ORDERS}, references={})
    columns = ["o_orderkey", "o_totalprice"]
    for late in (False, True):
        _land_orders(spark, sf_dir, lake, late)
        ingest_available(spark, lake, ORDERS, columns)
    ingest_available(spark, lake, ORDERS, columns)
    return read_bronze(spark, lake, "orders").select(
        F.col("o_orderkey").cast("bigint"), F.col("o_totalprice").cast("double"), "o_orderpriority"
    )
