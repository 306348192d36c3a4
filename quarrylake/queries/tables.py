"""The cleaned tables and their dimensions, over raw tables shaped from the given ones.

`RAW` holds, per source, the projection that gives a given table the source's
columns and flaws. It is SQL that both engines read, so query and twin start
from the same raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylake.operators.quality import REASON, Parted
from quarrylake.operators.skew import find_hot
from quarrylake.plans import gold, silver
from quarrylake.queries.registry import query, table, time_text
from quarrylake.spec import REFERENCES

DAY = "substr(CAST({c} AS STRING), 1, 10)"
ORDER_DAY = DAY.format(c="o_orderdate")
SHIP_DAY = DAY.format(c="l_shipdate")

RAW = {
    "cities": """
SELECT 'CTY-' || CAST(n_nationkey AS STRING) AS city_id, n_name AS city_name,
       CASE n_regionkey WHEN 0 THEN 'ES' WHEN 1 THEN 'fra' WHEN 2 THEN 'SWE' WHEN 3 THEN 'Portugal'
            ELSE 'Atlantis' END AS country,
       CASE n_regionkey WHEN 0 THEN 'Europe/Madrid' WHEN 1 THEN 'Europe/Paris' WHEN 2 THEN 'Europe/Stockholm'
            ELSE 'Europe/Lisbon' END AS timezone,
       CAST(n_nationkey AS STRING) || '.5' AS centre_lat, '-' || CAST(n_nationkey AS STRING) || '.25' AS centre_lon,
       CASE WHEN n_nationkey = 7 THEN 'many' ELSE CAST(n_nationkey * 100 AS STRING) END AS population_k
FROM {nation}""",
    "operators": """
SELECT 'OP-' || CAST(s_suppkey AS STRING) AS operator_id, s_name AS operator_name,
       CASE WHEN s_acctbal < 0 THEN 'all' ELSE CAST(s_nationkey AS STRING) || '.46' END AS revenue_share_pct,
       '2023-03-01' AS active_from
FROM {supplier}""",
    "plans": """
SELECT 'PLAN-' || CAST(p_partkey AS STRING) AS plan_id, p_name AS plan_name,
       CASE WHEN p_type = 'SMALL' THEN 'one' ELSE CAST(p_size AS STRING) END AS version,
       CAST(p_size AS STRING) || '.126' AS unlock_fee_eur, '0.24' AS per_minute_eur, '' AS monthly_fee_eur,
       '2023-03-01' AS valid_from,
       CASE WHEN p_size < 10 THEN '2026-05-31' WHEN p_size < 20 THEN 'soon' END AS valid_to
FROM {part}""",
    "zones": """
SELECT 'ZN-' || CAST(p_partkey AS STRING) AS zone_id, p_name AS zone_name,
       CAST(p_size AS STRING) || '.25' AS centroid_lat, '-' || CAST(p_size AS STRING) || '.5' AS centroid_lon,
       CASE WHEN p_type = 'ECONOMY' THEN 'true' WHEN p_type = 'LARGE' THEN 'perhaps' ELSE 'false' END AS is_current,
       CAST(p_size AS STRING) || '.254' AS area_km2, CAST(p_size AS STRING) AS parking_capacity,
       'never' AS valid_from, '2026-05-31' AS valid_to
FROM {part}""",
    "weather": f"""
SELECT 'CTY-' || o_orderstatus AS city_id, {ORDER_DAY} AS date, substr({ORDER_DAY}, 1, 7) AS period,
       CAST(o_totalprice AS STRING) AS tmax_c, '-1.5' AS tmin_c, '' AS wind_kph,
       CASE WHEN o_orderpriority = '2-HIGH' THEN 'rain' ELSE '0.5' END AS precip_mm
FROM {{orders}}""",
    "riders": f"""
WITH o AS (SELECT 'RD-' || CAST(o_custkey AS STRING) AS rider_id,
       CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND o_totalprice < 100000 THEN 'D'
            WHEN o_orderstatus = 'O' THEN 'I' ELSE 'U' END AS op,
       {ORDER_DAY} || 'T08:00:00Z' AS op_ts,
       'OP-' || CAST(CAST(floor(o_totalprice / 6000) AS BIGINT) AS STRING) AS operator_id,
       ' User' || CAST(o_custkey AS STRING) || '@Mail.COM ' AS email,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'esp' WHEN '2-HIGH' THEN 'FR' WHEN '3-MEDIUM' THEN 'Sweden'
            WHEN '5-LOW' THEN 'Atlantis' END AS country,
       {ORDER_DAY} AS signup_date, 'PLAN-' || o_orderstatus AS plan_id,
       CASE WHEN o_orderstatus = 'F' THEN 'true' WHEN o_totalprice > 450000 THEN 'maybe' ELSE 'false' END AS marketing_consent,
       CASE WHEN o_orderstatus = 'P' THEN 'deleted' ELSE 'active' END AS account_status,
       '19' || substr({ORDER_DAY}, 9, 2) AS birth_year, 'CTY-' || o_orderstatus AS home_city_id
    FROM {{orders}})
SELECT *, '2026-04-02' AS dt, '2026-04-02' AS _ingest_ts, 'riders-1.csv' AS _source_file, 'Rider-Service' AS _source_system
FROM o
UNION ALL
SELECT *, '2026-04-03', '2026-04-03', 'riders-2.csv', 'Rider-Service' FROM o WHERE account_status = 'deleted'""",
    "vehicles": f"""
SELECT 'VH-' || CAST(l_partkey AS STRING) AS vehicle_id, {SHIP_DAY} AS snapshot_date,
       'OP-' || CAST(l_suppkey AS STRING) AS operator_id,
       CASE WHEN l_tax > 0.07 THEN 'flat' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS battery_wh,
       '25.5' AS top_speed_kph, CAST(l_extendedprice AS STRING) AS odometer_km, '2025-01-01' AS purchase_date,
       l_returnflag AS firmware_version, 'CTY-1' AS home_city_id, 'QR' AS qr_code,
       CASE WHEN l_discount < 0.05 THEN l_linestatus END AS model, 'scooter' AS vehicle_type,
       'Acme' AS manufacturer, l_linestatus AS status,
       'f-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS _source_file
FROM {{lineitem}}""",
    "maintenance": f"""
SELECT 'M-' || CAST(o_custkey AS STRING) || '-' || o_orderstatus AS id, 'VH-' || CAST(o_custkey AS STRING) AS vehicle_ref,
       {ORDER_DAY} || 'T08:00:00Z' AS assigned_at, {ORDER_DAY} || 'T09:30:00+02:00' AS reported_at,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'later' ELSE {ORDER_DAY} END AS repaired_at,
       '' AS returned_to_service_at, CAST(o_totalprice AS STRING) AS labour_cost,
       CASE o_orderpriority WHEN '1-URGENT' THEN ' UNKNOWN ' ELSE '  jane DOE ' END AS technician,
       'f-' || CAST(o_orderkey AS STRING) AS _source_file
FROM {{orders}}""",
    "rides": f"""
SELECT 'R-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS ride_id,
       'lake/rides/dt=' || {SHIP_DAY} || '/rides_CTY-' || CAST(CAST(l_quantity AS INT) AS STRING) || '_' || {SHIP_DAY} || '.csv'
           AS _source_file,
       CASE WHEN l_linenumber = 5 THEN 'n/a' WHEN l_returnflag = 'A' THEN CAST({{millis}} AS STRING)
            WHEN l_returnflag = 'N' THEN {SHIP_DAY} || ' 12:30:00'
            ELSE substr({SHIP_DAY}, 9, 2) || '/' || substr({SHIP_DAY}, 6, 2) || '/' || substr({SHIP_DAY}, 1, 4) || ' 12:30' END
           AS start_ts,
       CASE WHEN l_linenumber = 5 OR l_linenumber = 6 THEN ''
            WHEN l_tax > 0.06 THEN '1994-01-01T00:00:00Z' ELSE {SHIP_DAY} || 'T18:00:00+02:00' END AS end_ts,
       {SHIP_DAY} || 'T23:00:00Z' AS updated_at,
       CASE WHEN l_linestatus = 'O' THEN '0.35km' ELSE '-' || CAST(l_extendedprice AS STRING) END AS distance_m,
       CASE WHEN l_returnflag = 'A' THEN '' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS duration_s,
       CAST(l_extendedprice AS STRING) AS fare_amount, CASE WHEN l_linestatus = 'O' THEN 'SEK' ELSE 'EUR' END AS currency,
       '1.5' AS start_lat, '2.5' AS start_lon, CASE WHEN l_linenumber = 7 THEN 'west' ELSE '3.5' END AS end_lat, CASE WHEN l_linenumber < 7 THEN '4.5' ELSE '' END AS end_lon,
       CASE WHEN l_tax = 0 AND l_discount = 0 THEN 'perhaps' WHEN l_tax < 0.02 THEN 'true' ELSE 'false' END AS is_test,
       CASE WHEN l_discount > 0.05 THEN 'SPRING' ELSE '' END AS promo_code,
       l_returnflag AS unlock_channel, l_linestatus AS end_reason, CAST(l_suppkey AS STRING) AS rider_id
FROM {{lineitem}}""",
    "payments": f"""
SELECT 'P-' || CAST(l_orderkey AS STRING) || '-' || l_returnflag AS payment_id,
       'R-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS external_ref,
       CASE WHEN l_tax = 0 AND l_discount = 0 THEN 'free'
            ELSE CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING) END AS amount_minor,
       CASE WHEN l_linestatus = 'O' THEN 'SEK' ELSE 'EUR' END AS currency,
       CASE WHEN l_tax > 0.06 THEN 'bad' ELSE {SHIP_DAY} || 'T10:00:00Z' END AS captured_at,
       CASE WHEN l_discount > 0.05 THEN 'charge' WHEN l_discount > 0.02 THEN 'refund' END AS type,
       CASE WHEN l_linenumber < 5 THEN 'captured' ELSE 'failed' END AS status,
       CASE WHEN l_linenumber < 6 THEN 'card-' || l_linestatus END AS method, 'SE' AS customer_country,
       'f-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS _source_file
FROM {{lineitem}}""",
    "telemetry": """
SELECT 'ev_' || CAST(event_id AS STRING) AS event_id, 'VH-' || CAST(user_id AS STRING) AS vehicle_id,
       CASE event_type WHEN 'view' THEN CAST({event_millis} AS STRING)
            WHEN 'click' THEN substr(CAST(ts AS STRING), 1, 19) WHEN 'error' THEN 'n/a'
            ELSE replace(CAST(ts AS STRING), ' ', 'T') || 'Z' END AS ts,
       CASE event_type WHEN 'view' THEN 'CTY-0' WHEN 'click' THEN 'CTY-2' WHEN 'signup' THEN 'CTY-99' ELSE 'CTY-4' END AS city,
       CASE WHEN value < 5 THEN '0.0' ELSE '41.5' END AS lat, CASE WHEN value < 10 THEN '0' ELSE '-8.5' END AS lon,
       CAST(value AS STRING) AS speed_kph, CASE WHEN value < 100 THEN CAST(value AS STRING) END AS battery,
       CASE WHEN event_type = 'purchase' AND value > 50 THEN 'open' ELSE 'true' END AS is_locked, origin AS _source_file
FROM (SELECT *, 'a' AS origin FROM {events} UNION ALL SELECT *, 'b' FROM {events} WHERE event_type = 'click') sent""",
}

# What the two engines spell differently.
SPARK_WORDS = {"{millis}": "unix_millis(l_shipdate)", "{event_millis}": "unix_millis(ts)"}
DUCK_WORDS = {"{millis}": "epoch_us(l_shipdate) // 1000", "{event_millis}": "epoch_us(ts) // 1000"}
BASES = ("nation", "supplier", "part", "orders", "lineitem", "events")


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = RAW[name]
    for word, spelling in SPARK_WORDS.items():
        text = text.replace(word, spelling)
    used = {b: table(spark, sf_dir, b) for b in BASES if f"{{{b}}}" in text}
    return spark.sql(text, **used)


def raw_sql(name: str) -> str:
    text = RAW[name]
    for word, spelling in DUCK_WORDS.items():
        text = text.replace(word, spelling)
    for base in BASES:
        text = text.replace(f"{{{base}}}", base)
    return f"({text})"


def both_sides(parted: Parted, *columns: str) -> DataFrame:
    """Kept and rejected rows in one frame, with times, dates and decimals as plain values."""
    df = parted.both().select(*columns, REASON)
    kinds = dict(df.dtypes)
    return df.select(*[_plain(c, kinds[c]) for c in df.columns])


def _plain(name: str, kind: str):
    if kind == "timestamp":
        return time_text(F.col(name)).alias(name)
    if kind == "date":
        return F.col(name).cast("string").alias(name)
    if kind.startswith("decimal"):
        return F.col(name).cast("double").alias(name)
    return F.col(name)


def plain_columns(df: DataFrame) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.select(*[_plain(c, kinds[c]) for c in df.columns])


def unreadable_sql(**types: str) -> str:
    tests = [f"coalesce(trim({c}) <> '' AND TRY_CAST({c} AS {t}) IS NULL, FALSE)" for c, t in types.items()]
    return "(" + " OR ".join(tests) + ")"


def stamp_sql(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"


COUNTRY_SQL = """CASE WHEN country IN ('ES', 'Spain', 'esp') THEN 'ES' WHEN country IN ('FR', 'France', 'fra') THEN 'FR'
    WHEN country IN ('SE', 'Sweden', 'SWE') THEN 'SE' WHEN country IN ('PT', 'Portugal', 'prt') THEN 'PT' END"""


@query(f"""
SELECT city_id, city_name, {COUNTRY_SQL} AS country, CAST(centre_lat AS DOUBLE) AS centre_lat,
       CAST(centre_lon AS DOUBLE) AS centre_lon, TRY_CAST(population_k AS INT) AS population_k,
       CASE WHEN {unreadable_sql(population_k='INT')} THEN 'Unreadable value'
            WHEN country = 'Atlantis' THEN 'Unknown country' END AS _reject_reason
FROM {raw_sql('cities')}
""")
def silver_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    parted = silver.cities(raw(spark, sf_dir, "cities"))
    return both_sides(parted, "city_id", "city_name", "country", "centre_lat", "centre_lon", "population_k")


@query(f"""
SELECT operator_id, CAST(TRY_CAST(revenue_share_pct AS DECIMAL(10,1)) AS DOUBLE) AS revenue_share_pct, active_from,
       CASE WHEN revenue_share_pct = 'all' THEN 'Unreadable value' END AS _reject_reason
FROM {raw_sql('operators')}
""")
def silver_operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    parted = silver.operators(raw(spark, sf_dir, "operators"))
    return both_sides(parted, "operator_id", "revenue_share_pct", "active_from")


@query(f"""
SELECT plan_id, TRY_CAST(version AS INT) AS version,
       CAST(CAST(unlock_fee_eur AS DECIMAL(10,2)) AS DOUBLE) AS unlock_fee_eur, 0.24::DOUBLE AS per_minute_eur,
       CAST(NULL AS DOUBLE) AS monthly_fee_eur, valid_from, CAST(TRY_CAST(valid_to AS DATE) AS VARCHAR) AS valid_to,
       CASE WHEN version = 'one' THEN 'Unreadable value' END AS _reject_reason
FROM {raw_sql('plans')}
""")
def silver_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    parted = silver.plans(raw(spark, sf_dir, "plans"))
    return both_sides(parted, "plan_id", "version", "unlock_fee_eur", "per_minute_eur", "monthly_fee_eur",
                      "valid_from", "valid_to")


@query(f"""
SELECT zone_id, CAST(centroid_lat AS DOUBLE) AS centroid_lat, CAST(centroid_lon AS DOUBLE) AS centroid_lon,
       TRY_CAST(is_current AS BOOLEAN) AS is_current, CAST(CAST(area_km2 AS DECIMAL(10,2)) AS DOUBLE) AS area_km2,
       CAST(parking_capacity AS INT) AS parking_capacity, CAST(NULL AS VARCHAR) AS valid_from, valid_to,
       CASE WHEN is_current = 'perhaps' THEN 'Unreadable value' END AS _reject_reason
FROM {raw_sql('zones')}
""")
def silver_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    parted = silver.zones(raw(spark, sf_dir, "zones"))
    return both_sides(parted, "zone_id", "centroid_lat", "centroid_lon", "is_current", "area_km2",
                      "parking_capacity", "valid_from", "valid_to")


# One row of each city and day.
WEATHER_SQL = f"""(SELECT * FROM {raw_sql('weather')}
QUALIFY row_number() OVER (PARTITION BY city_id, date ORDER BY period, tmax_c, tmin_c, wind_kph, precip_mm) = 1)"""


@query(f"""
SELECT city_id, city_id AS city, date, period || '-01' AS period, CAST(tmax_c AS DOUBLE) AS tmax_c,
       CAST(tmin_c AS DOUBLE) AS tmin_c, TRY_CAST(precip_mm AS DOUBLE) AS precip_mm, CAST(NULL AS DOUBLE) AS wind_kph,
       CASE WHEN precip_mm = 'rain' THEN 'Unreadable value' END AS _reject_reason
FROM {WEATHER_SQL}
""")
def silver_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    parted = silver.weather(raw(spark, sf_dir, "weather"))
    return both_sides(parted, "city_id", "city", "date", "period", "tmax_c", "tmin_c", "precip_mm", "wind_kph")


def _operators_in_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").where("s_acctbal >= 0").select(
        F.concat(F.lit("OP-"), F.col("s_suppkey").cast("string")).alias("operator_id")
    )


OPERATORS_SQL = "(SELECT 'OP-' || s_suppkey FROM supplier WHERE s_acctbal >= 0)"

RIDERS_SQL = f"""
WITH raw AS {raw_sql('riders')},
tagged AS (
  SELECT *, CASE WHEN operator_id NOT IN {OPERATORS_SQL} THEN 'invalid_fk_operator'
                 WHEN {unreadable_sql(marketing_consent='BOOLEAN')} THEN 'Unreadable value'
                 WHEN country = 'Atlantis' THEN 'Unknown country' END AS reason,
         rider_id IN (SELECT rider_id FROM raw WHERE op = 'D') AS gone
  FROM raw),
clean AS (
  SELECT rider_id, op, CAST(replace(op_ts, 'Z', '') AS TIMESTAMP) AS op_ts, reason, dt,
         CASE WHEN NOT gone THEN operator_id END AS operator_id,
         CASE WHEN gone THEN 'REDACTED' ELSE lower(trim(email)) END AS email,
         CASE WHEN NOT gone THEN {COUNTRY_SQL} END AS country, CASE WHEN NOT gone THEN signup_date END AS signup_date,
         CASE WHEN NOT gone THEN plan_id END AS plan_id,
         CASE WHEN NOT gone THEN TRY_CAST(marketing_consent AS BOOLEAN) END AS marketing_consent,
         NOT gone AND account_status = 'active' AS is_active,
         CASE WHEN NOT gone THEN CAST(birth_year AS INT) END AS birth_year,
         CASE WHEN NOT gone THEN home_city_id END AS home_city_id
  FROM tagged),
kept AS (SELECT DISTINCT * EXCLUDE (dt, reason) FROM clean WHERE reason IS NULL)"""


def _riders(spark: SparkSession, sf_dir: str) -> Parted:
    return silver.riders(raw(spark, sf_dir, "riders"), _operators_in_credit(spark, sf_dir))


@query(f"""{RIDERS_SQL}
SELECT *  REPLACE ({stamp_sql('op_ts')} AS op_ts), NULL AS _reject_reason FROM kept
UNION ALL BY NAME
SELECT * EXCLUDE (dt, reason) REPLACE ({stamp_sql('op_ts')} AS op_ts), reason AS _reject_reason FROM clean
WHERE reason IS NOT NULL
""")
def silver_riders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of riders: orphans, unknown countries and unreadable rows out, deleted riders blanked."""
    return both_sides(
        _riders(spark, sf_dir), "rider_id", "op", "op_ts", "operator_id", "email", "country", "signup_date",
        "plan_id", "marketing_consent", "is_active", "birth_year", "home_city_id",
    )


VEHICLES_SQL = f"""
WITH tagged AS (
  SELECT *, CASE WHEN operator_id NOT IN {OPERATORS_SQL} THEN 'invalid_fk_operator'
                 WHEN battery_wh = 'flat' THEN 'Unreadable value' END AS reason FROM {raw_sql('vehicles')}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY vehicle_id, snapshot_date
      ORDER BY _source_file, operator_id, CAST(battery_wh AS INT), CAST(odometer_km AS DOUBLE), firmware_version,
               model NULLS FIRST, status) AS r
  FROM tagged WHERE reason IS NULL),
kept AS (SELECT * FROM ranked WHERE r = 1)"""

VEHICLE_COLUMNS = """vehicle_id, snapshot_date, operator_id, TRY_CAST(battery_wh AS INT) AS battery_wh,
       CAST(odometer_km AS DOUBLE) AS odometer_km, firmware_version, model, status"""


def _vehicles(spark: SparkSession, sf_dir: str) -> Parted:
    return silver.vehicles(raw(spark, sf_dir, "vehicles"), _operators_in_credit(spark, sf_dir))


@query(f"""{VEHICLES_SQL}
SELECT {VEHICLE_COLUMNS}, NULL AS _reject_reason FROM kept
UNION ALL SELECT {VEHICLE_COLUMNS}, reason FROM tagged WHERE reason IS NOT NULL
""")
def silver_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return both_sides(_vehicles(spark, sf_dir), "vehicle_id", "snapshot_date", "operator_id", "battery_wh",
                      "odometer_km", "firmware_version", "model", "status")


@query(f"""
WITH tagged AS (SELECT *, repaired_at = 'later' AS bad FROM {raw_sql('maintenance')}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY _source_file) AS r FROM tagged)
SELECT id, vehicle_ref AS vehicle_id, {stamp_sql("CAST(substr(assigned_at, 1, 10) || ' 08:00:00' AS TIMESTAMP)")} AS assigned_at,
       {stamp_sql("CAST(substr(reported_at, 1, 10) || ' 07:30:00' AS TIMESTAMP)")} AS reported_at,
       {stamp_sql('TRY_CAST(repaired_at AS TIMESTAMP)')} AS repaired_at, CAST(NULL AS VARCHAR) AS returned_to_service_at,
       CAST(CAST(labour_cost AS DECIMAL(10,2)) AS DOUBLE) AS labour_cost,
       CASE WHEN technician LIKE '%jane%' THEN 'Jane Doe' END AS technician,
       substr(assigned_at, 1, 10) AS maintenance_date, CASE WHEN bad THEN 'Unreadable value' END AS _reject_reason
FROM ranked WHERE r = 1
""")
def silver_maintenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    parted = silver.maintenance(raw(spark, sf_dir, "maintenance"))
    return both_sides(parted, "id", "vehicle_id", "assigned_at", "reported_at", "repaired_at",
                      "returned_to_service_at", "labour_cost", "technician", "maintenance_date")


def zoned_sql(local: str) -> str:
    return f"timezone('UTC', timezone(timezone, {local}))"


RIDES_SQL = f"""
WITH places AS {raw_sql('cities')},
raw AS (
  SELECT *, regexp_extract(_source_file, 'rides_([^_/]+)_', 1) AS city_id,
         CASE WHEN is_test = 'perhaps' THEN 'Unreadable value' END AS reason,
         regexp_extract(_source_file, 'dt=([^/]+)', 1) AS day,
         TRY_CAST(duration_s AS INT) AS seconds, CAST(fare_amount AS DOUBLE) AS fare
  FROM {raw_sql('rides')}),
zoned AS (SELECT raw.*, p.timezone FROM raw LEFT JOIN places p USING (city_id)),
timed AS (
  SELECT * REPLACE (CAST(day || ' 23:00:00' AS TIMESTAMP) AS updated_at) FROM zoned),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY ride_id ORDER BY updated_at DESC NULLS LAST, _source_file,
      start_ts, end_ts, distance_m, duration_s, fare_amount, currency, end_lat, is_test,
      CASE WHEN promo_code <> '' THEN promo_code END NULLS FIRST, unlock_channel, end_reason, rider_id) AS r
  FROM timed),
parsed AS (
  SELECT * REPLACE (
    CASE WHEN regexp_matches(start_ts, '^[0-9]+$') THEN make_timestamp(CAST(start_ts AS BIGINT) * 1000)
         WHEN start_ts LIKE '__/__/%' OR start_ts LIKE '%12:30:00' THEN {zoned_sql("CAST(day || ' 12:30:00' AS TIMESTAMP)")} END AS start_ts,
    CASE WHEN end_ts LIKE '%Z' THEN TIMESTAMP '1994-01-01' WHEN end_ts <> '' THEN CAST(day || ' 16:00:00' AS TIMESTAMP) END AS end_ts)
  FROM ranked WHERE r = 1),
clean AS (
  SELECT ride_id, city_id, timezone, start_ts, end_ts, updated_at,
         CASE WHEN distance_m LIKE '%km' THEN 350.0 ELSE abs(CAST(distance_m AS DOUBLE)) END AS distance_m,
         end_ts IS NULL AS open_ride, CAST(start_ts AS DATE) AS ride_date,
         coalesce(CAST(seconds AS DOUBLE), (epoch_us(end_ts) - epoch_us(start_ts)) / 1000000.0::DOUBLE) AS duration_s,
         CASE WHEN currency = 'SEK' THEN fare * 0.088::DOUBLE ELSE fare END AS fare_amount_euros,
         TRY_CAST(is_test AS BOOLEAN) AS is_test, CASE WHEN promo_code <> '' THEN promo_code END AS promo_code,
         unlock_channel, end_reason,
         CASE WHEN reason IS NOT NULL THEN reason
              WHEN start_ts IS NULL AND end_ts IS NULL THEN 'Missing Start_ts and End_ts'
              WHEN start_ts > end_ts THEN 'Impossible End and Start Timestamps' END AS _reject_reason
  FROM parsed)"""


def _rides(spark: SparkSession, sf_dir: str) -> Parted:
    return silver.rides(raw(spark, sf_dir, "rides"), raw(spark, sf_dir, "cities"))


@query(f"""{RIDES_SQL}
SELECT * REPLACE ({stamp_sql('start_ts')} AS start_ts, {stamp_sql('end_ts')} AS end_ts,
    {stamp_sql('updated_at')} AS updated_at, CAST(ride_date AS VARCHAR) AS ride_date,
    CAST(distance_m AS DOUBLE) AS distance_m)
FROM clean
""")
def silver_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides: per-row zones, newest state, both reject rules, metres, seconds, euros."""
    return both_sides(
        _rides(spark, sf_dir), "ride_id", "city_id", "timezone", "start_ts", "end_ts", "updated_at", "distance_m",
        "open_ride", "ride_date", "duration_s", "fare_amount_euros", "is_test", "promo_code", "unlock_channel",
        "end_reason",
    )


PAYMENTS_SQL = f"""
WITH raw AS {raw_sql('payments')},
known AS (SELECT DISTINCT 'R-' || l_orderkey || '-' || l_linenumber AS ride_id FROM lineitem WHERE l_returnflag <> 'N'),
ranked AS (
  SELECT *, TRY_CAST(amount_minor AS BIGINT) AS minor, row_number() OVER (PARTITION BY payment_id
      ORDER BY _source_file, external_ref, amount_minor, currency, captured_at, type NULLS FIRST, status,
               method NULLS FIRST) AS r
  FROM raw),
clean AS (
  SELECT payment_id, external_ref AS ride_id, minor AS amount_minor, CAST(minor AS DOUBLE) / 100 AS amount,
         CASE WHEN currency = 'SEK' THEN CAST(((minor * 88 + 500) // 1000) AS DOUBLE) / 100
              ELSE CAST(minor AS DOUBLE) / 100 END AS amount_euros,
         CASE WHEN captured_at <> 'bad' THEN substr(captured_at, 1, 10) END AS payment_date,
         coalesce(type = 'charge', FALSE) AS is_charge, status = 'captured' AS is_successful, method,
         CASE WHEN amount_minor = 'free' THEN 'Unreadable value'
              WHEN external_ref NOT IN (SELECT ride_id FROM known) THEN 'Invalid ride_id' END AS _reject_reason
  FROM ranked WHERE r = 1)"""


def _payments(spark: SparkSession, sf_dir: str) -> Parted:
    rides = table(spark, sf_dir, "lineitem").where("l_returnflag <> 'N'").select(
        F.expr("'R-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)").alias("ride_id")
    )
    return silver.payments(raw(spark, sf_dir, "payments"), rides)


@query(f"{PAYMENTS_SQL} SELECT * FROM clean")
def silver_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments: one per id, exact euros, orphans of rides out."""
    return both_sides(_payments(spark, sf_dir), "payment_id", "ride_id", "amount_minor", "amount", "amount_euros",
                      "payment_date", "is_charge", "is_successful", "method")


@query(f"""
WITH places AS {raw_sql('cities')},
ranked AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY _source_file) AS r FROM {raw_sql('telemetry')}),
zoned AS (SELECT t.*, p.timezone FROM ranked t LEFT JOIN places p ON t.city = p.city_id WHERE r = 1),
timed AS (
  SELECT * REPLACE (CASE WHEN regexp_matches(ts, '^[0-9]+$') THEN make_timestamp(CAST(ts AS BIGINT) * 1000)
         WHEN ts LIKE '%Z' THEN CAST(replace(ts, 'Z', '') AS TIMESTAMP)
         ELSE {zoned_sql('TRY_CAST(ts AS TIMESTAMP)')} END AS ts) FROM zoned)
SELECT event_id, {stamp_sql('ts')} AS ts, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, city,
       vehicle_id IN (SELECT 'VH-' || c_custkey FROM customer WHERE c_acctbal >= 0) AS is_registered_vehicle,
       CASE WHEN lat = '0.0' AND lon = '0' THEN NULL ELSE CAST(lat AS DOUBLE) END AS lat,
       CASE WHEN lat = '0.0' AND lon = '0' THEN NULL ELSE CAST(lon AS DOUBLE) END AS lon,
       CAST(speed_kph AS DOUBLE) AS speed_kph,
       CAST(round(CASE WHEN CAST(battery AS DECIMAL(10,4)) > 1 THEN CAST(battery AS DOUBLE) / 100
            ELSE CAST(battery AS DOUBLE) END, 4) AS DOUBLE) AS battery,
       TRY_CAST(is_locked AS BOOLEAN) AS is_locked,
       CASE WHEN is_locked = 'open' THEN 'Unreadable value' END AS _reject_reason
FROM timed
""")
def silver_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry: one row per event, city-local times in UTC, battery on one scale, known vehicles flagged."""
    registered = table(spark, sf_dir, "customer").where("c_acctbal >= 0").select(
        F.concat(F.lit("VH-"), F.col("c_custkey").cast("string")).alias("vehicle_id")
    )
    parted = silver.telemetry(raw(spark, sf_dir, "telemetry"), registered, raw(spark, sf_dir, "cities"))
    return both_sides(parted, "event_id", "ts", "event_date", "city", "is_registered_vehicle", "lat", "lon",
                      "speed_kph", "battery", "is_locked")


@query(f"""
SELECT sha256(city_id) AS cities_sk, city_id, city_name FROM {raw_sql('cities')}
WHERE country <> 'Atlantis' AND population_k <> 'many'
UNION ALL SELECT '-1', NULL, NULL
""")
def gold_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = silver.cities(raw(spark, sf_dir, "cities")).kept
    return gold.reference(kept, REFERENCES["cities"]).select("cities_sk", "city_id", "city_name")


@query(f"""
SELECT sha256(concat_ws('|', plan_id, '2023-03-01')) AS plans_sk, plan_id FROM {raw_sql('plans')} WHERE version <> 'one'
UNION ALL SELECT '-1', NULL
""")
def gold_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = silver.plans(raw(spark, sf_dir, "plans")).kept
    return gold.reference(kept, REFERENCES["plans"]).select("plans_sk", "plan_id")


@query(f"""
SELECT sha256(operator_id) AS operators_sk, operator_id, operator_name, CAST(CAST(revenue_share_pct AS DECIMAL(10,1)) AS DOUBLE) AS revenue_share_pct
FROM {raw_sql('operators')} WHERE revenue_share_pct <> 'all'
UNION ALL SELECT '-1', NULL, NULL, NULL
""")
def gold_operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = silver.operators(raw(spark, sf_dir, "operators")).kept
    return plain_columns(gold.reference(kept, REFERENCES["operators"]).select("operators_sk", "operator_id", "operator_name", "revenue_share_pct"))


@query(f"""
SELECT sha256(zone_id || '|~') AS zones_sk, zone_id, zone_name, CAST(NULL AS VARCHAR) AS valid_from, valid_to
FROM {raw_sql('zones')} WHERE is_current <> 'perhaps'
UNION ALL SELECT '-1', NULL, NULL, NULL, NULL
""")
def gold_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned zones, keyed by id and start of validity; none of these starts is a date."""
    kept = silver.zones(raw(spark, sf_dir, "zones")).kept
    return plain_columns(gold.reference(kept, REFERENCES["zones"]).select("zones_sk", "zone_id", "zone_name", "valid_from", "valid_to"))


@query(f"""{VEHICLES_SQL},
hashed AS (
  SELECT vehicle_id, CAST(snapshot_date AS TIMESTAMP) AS f, operator_id, sha256(concat_ws('|', firmware_version, 'CTY-1', 'QR',
      coalesce(model, '~'), battery_wh, operator_id, 'scooter', '25.5', 'Acme', status, '2025-01-01')) AS state_hash
  FROM kept),
marked AS (SELECT *, lag(state_hash) OVER (PARTITION BY vehicle_id ORDER BY f) AS before FROM hashed),
opened AS (SELECT * FROM marked WHERE before IS DISTINCT FROM state_hash),
closed AS (SELECT *, lead(f) OVER (PARTITION BY vehicle_id ORDER BY f) AS t FROM opened)
SELECT sha256(concat_ws('|', vehicle_id, CAST(f AS VARCHAR))) AS vehicle_sk, vehicle_id, operator_id, state_hash,
       {stamp_sql('f')} AS valid_from_ts, coalesce({stamp_sql('t')}, '9999-12-31 00:00:00.000000') AS valid_to_ts,
       t IS NULL AS is_current
FROM closed UNION ALL SELECT '-1', NULL, NULL, NULL, NULL, NULL, NULL
""")
def gold_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle history from daily snapshots."""
    hot = find_hot(raw(spark, sf_dir, "vehicles"), ["vehicle_id"])
    dim = gold.vehicles(_vehicles(spark, sf_dir).kept, hot=hot)
    return plain_columns(dim.select("vehicle_sk", "vehicle_id", "operator_id", "state_hash", "valid_from_ts",
                                    "valid_to_ts", "is_current"))


@query(f"""{RIDERS_SQL},
single AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY rider_id, op_ts ORDER BY CASE op WHEN 'D' THEN 0 WHEN 'U' THEN 1 ELSE 2 END,
      operator_id NULLS FIRST, email, home_city_id NULLS FIRST, country NULLS FIRST, signup_date NULLS FIRST,
      plan_id NULLS FIRST, marketing_consent NULLS FIRST, birth_year NULLS FIRST, is_active) AS r
  FROM kept) WHERE r = 1),
gated AS (SELECT *, last_value(CASE WHEN op <> 'U' THEN op END IGNORE NULLS) OVER (
    PARTITION BY rider_id ORDER BY op_ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS turn FROM single),
stated AS (SELECT *, CASE WHEN op = 'D' THEN 'gone' ELSE concat_ws('|', coalesce(country, '~'),
    coalesce(CAST(marketing_consent AS VARCHAR), '~'), coalesce(plan_id, '~'), coalesce(operator_id, '~'),
    coalesce(home_city_id, '~')) END AS state
  FROM gated WHERE NOT (op = 'U' AND turn IS NOT DISTINCT FROM 'D')),
marked AS (SELECT *, lag(state) OVER (PARTITION BY rider_id ORDER BY op_ts) AS before FROM stated),
opened AS (SELECT * FROM marked WHERE before IS DISTINCT FROM state),
closed AS (SELECT *, lead(op_ts) OVER (PARTITION BY rider_id ORDER BY op_ts) AS t FROM opened)
SELECT sha256(concat_ws('|', rider_id, CAST(op_ts AS VARCHAR))) AS riders_sk, rider_id, email, country, plan_id,
       {stamp_sql('op_ts')} AS valid_from_ts, coalesce({stamp_sql('t')}, '9999-12-31 00:00:00.000000') AS valid_to_ts,
       t IS NULL AS is_current
FROM closed WHERE op <> 'D' UNION ALL SELECT '-1', NULL, NULL, NULL, NULL, NULL, NULL, NULL
""")
def gold_riders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rider history from the change log."""
    columns = ["rider_id", "op", "op_ts", "operator_id", "email", "home_city_id", "country", "signup_date", "plan_id",
               "marketing_consent", "birth_year", "is_active"]
    hot = find_hot(raw(spark, sf_dir, "riders"), ["rider_id"])
    dim = gold.riders(_riders(spark, sf_dir).kept.select(*columns), hot=hot)
    return plain_columns(dim.select("riders_sk", "rider_id", "email", "country", "plan_id", "valid_from_ts",
                                    "valid_to_ts", "is_current"))


@query(f"""{PAYMENTS_SQL}
SELECT DISTINCT sha256(coalesce(method, '~')) AS payment_method_sk, method FROM clean WHERE _reject_reason IS NULL
UNION ALL SELECT '-1', NULL
""")
def gold_payment_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.payment_method(_payments(spark, sf_dir).kept)


@query(f"""
SELECT sha256(concat_ws('|', city_id, date)) AS weather_day_sk, city_id, date, CAST(tmax_c AS DOUBLE) AS tmax_c
FROM {WEATHER_SQL} WHERE precip_mm <> 'rain'
UNION ALL SELECT '-1', NULL, NULL, NULL
""")
def gold_weather_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = gold.weather_day(silver.weather(raw(spark, sf_dir, "weather")).kept)
    return plain_columns(dim.select("weather_day_sk", "city_id", "date", "tmax_c"))


@query(f"""{RIDES_SQL},
good AS (SELECT *, promo_code IS NOT NULL AS is_promo FROM clean WHERE _reject_reason IS NULL)
SELECT sha256(concat_ws('|', u, e, CAST(p AS VARCHAR), CAST(t AS VARCHAR))) AS ride_context_sk, u AS unlock_channel,
       e AS end_reason, p AS is_promo, t AS is_test
FROM (SELECT DISTINCT unlock_channel AS u FROM good) CROSS JOIN (SELECT DISTINCT end_reason AS e FROM good)
CROSS JOIN (SELECT DISTINCT is_promo AS p FROM good) CROSS JOIN (SELECT DISTINCT is_test AS t FROM good)
UNION ALL SELECT '-1', NULL, NULL, NULL, NULL
""")
def gold_ride_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.ride_context(_rides(spark, sf_dir).kept)
