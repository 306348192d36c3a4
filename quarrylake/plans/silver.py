"""Typed, cleaned and deduplicated tables.

Each function takes the raw text tables it needs and returns the kept and the
rejected rows. Duplicates go first where rows are told by a key of their own, on the
raw text, so that only the rows that stay are parsed; riders and vehicles are tagged and
cast before, as their rejects are kept beside their survivors. Nothing here reads or writes; the one job started is the probe
for hot keys, over the raw key column, before a join of two large tables or the sort
that finds a key's newest row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylake.functions import amounts, text, times
from quarrylake.functions.columns import blank_where, cast_columns, with_declared
from quarrylake.operators.dedupe import PROVENANCE, distinct_records, keep_latest, keep_one
from quarrylake.operators.lookup import add_attributes, mark_members
from quarrylake.operators.quality import (
    APART, NO_TIMES, ORPHAN_OPERATOR, ORPHAN_RIDE, RAW, REASON, REVERSED_TIMES, UNKNOWN_COUNTRY,
    UNREADABLE, Parted, Rule, part, rejects_apart, tag, tag_keyless, tag_orphans, tag_unreadable,
)
from quarrylake.operators.skew import HOT_ROWS, HotKeys, find_hot
from quarrylake.spec import LENIENT, TYPES


def typed(raw: DataFrame, table: str) -> DataFrame:
    """Cast a table's columns, tagging the rows with text that should fit and does not."""
    types = TYPES[table]
    strict = {c: t for c, t in types.items() if c not in LENIENT.get(table, ())}
    cleaned = cast_columns(tag_unreadable(raw, strict), types)
    if "_ingest_ts" in cleaned.columns:
        cleaned = cleaned.withColumn("_ingest_ts", F.col("_ingest_ts").try_cast("timestamp"))
    return cleaned


def tag_country(df: DataFrame) -> DataFrame:
    """Replace the country's spelling by its code; a spelling nobody knows is tagged."""
    unknown = F.col("country").isNotNull() & text.country_code(F.col("country")).isNull()
    return tag(df, [Rule(UNKNOWN_COUNTRY, unknown)]).withColumn("country", text.country_code(F.col("country")))


def cities(raw: DataFrame) -> Parted:
    return part(tag_country(typed(raw, "cities")))


def operators(raw: DataFrame) -> Parted:
    return part(typed(raw, "operators"))


def plans(raw: DataFrame) -> Parted:
    return part(typed(raw, "plans"))


def zones(raw: DataFrame) -> Parted:
    return part(typed(raw, "zones"))


def redact_deleted(
    df: DataFrame, entity: str, op: str, keep: tuple[str, ...], hot: HotKeys | None = None,
    log: DataFrame | None = None,
) -> DataFrame:
    """Blank every row of an entity that was ever deleted, but for the columns in `keep`.

    The deletes are read from `log`, if given: the stored table that `df` was made from.
    """
    gone = (df if log is None else log).where(F.col(op) == "D").select(entity)
    marked = mark_members(df, entity, gone, "_gone", hot=hot)
    return blank_where(marked, F.col("_gone"), [*keep, "_gone"])


def riders(raw: DataFrame, known_operators: DataFrame, hot_rows: int = HOT_ROWS) -> Parted:
    tagged = tag_orphans(raw, "operator_id", known_operators, ORPHAN_OPERATOR)
    clean = tag_country(typed(tagged, "riders_cdc"))
    clean = redact_deleted(clean, "rider_id", "op", ("rider_id", "email", "op", "op_ts", REASON),
                           find_hot(raw, ["rider_id"], hot_rows), log=raw)
    clean = clean.withColumns(
        {
            "email": F.when(F.col("_gone"), text.REDACTED).otherwise(text.email_address(F.col("email"))),
            "is_active": text.is_value(F.col("account_status"), "active"),
            "riders_event_date": F.when(F.col(REASON).isNotNull(), F.col("op_ts")),
        }
    ).drop("_gone")
    once = distinct_records(rejects_apart(clean), ignore=(*PROVENANCE, "dt")).drop(APART)
    parted = part(once)
    return parted._replace(kept=parted.kept.drop("riders_event_date"))


def vehicles(raw: DataFrame, known_operators: DataFrame) -> Parted:
    tagged = tag_orphans(raw, "operator_id", known_operators, ORPHAN_OPERATOR)
    clean = rejects_apart(typed(tagged, "vehicles"))
    return part(keep_one(clean, ["vehicle_id", "snapshot_date", APART]).drop(APART))


def maintenance(raw: DataFrame, hot_rows: int = HOT_ROWS) -> Parted:
    once = keep_one(raw, ["id"], nulls_apart=True, hot=find_hot(raw, ["id"], hot_rows))
    clean = typed(tag_keyless(once, ["id"]), "maintenance").withColumnRenamed("vehicle_ref", "vehicle_id")
    return part(
        clean.withColumns(
            {
                "maintenance_date": times.day_of(F.col("assigned_at")),
                "technician": text.person_name(F.col("technician")),
            }
        )
    )


def weather(raw: DataFrame) -> Parted:
    """The newest delivery of each city and day."""
    newest = keep_one(raw, ["city_id", "date"], *[F.col(c).desc() for c in ("_ingest_ts",) if c in raw.columns], nulls_apart=True)
    return part(typed(tag_keyless(newest, ["city_id", "date"]), "weather").withColumn("city", F.col("city_id")))


def rides(raw: DataFrame, known_cities: DataFrame, hot_rows: int = HOT_ROWS) -> Parted:
    """The newest state of each ride, with instants, metres, seconds and euros."""
    hot = find_hot(raw, ["ride_id"], hot_rows)
    raw = with_declared(raw, ["promo_code"]).withColumns(
        {
            "promo_code": text.empty_to_null(F.col("promo_code")),
            "city_id": text.city_of_file(F.col("_source_file")),
        }
    )
    zone = F.col("timezone")
    zoned = add_attributes(raw, "city_id", known_cities, ["timezone"])
    zoned = tag(zoned, [Rule(UNREADABLE, times.beyond_timestamps(F.col(c))) for c in ("updated_at", "start_ts", "end_ts")])
    zoned = zoned.withColumn("updated_at", times.instant(F.col("updated_at"), zone))
    newest = keep_latest(zoned, ["ride_id"], "updated_at", nulls_apart=True, hot=hot)
    clean = typed(tag_keyless(newest, ["ride_id"]), "rides")
    clean = clean.withColumns({c: times.instant(F.col(c), zone) for c in ("start_ts", "end_ts")})
    start, end = F.col("start_ts"), F.col("end_ts")
    clean = clean.withColumns(
        {
            "distance_m": amounts.metres(F.col("distance_m")),
            "open_ride": times.is_open(end),
            "ride_date": times.day_of(start),
            "duration_s": times.duration(F.col("duration_s"), start, end),
            "fare_amount_euros": amounts.in_euros(F.col("fare_amount"), F.col("currency")),
        }
    )
    rules = [Rule(NO_TIMES, start.isNull() & end.isNull()), Rule(REVERSED_TIMES, start > end)]
    return part(tag(clean, rules))


def payments(raw: DataFrame, known_rides: DataFrame, hot_rows: int = HOT_ROWS) -> Parted:
    """One row per payment, in euros, for rides that exist."""
    hot = find_hot(raw, ["external_ref"], hot_rows)
    once = keep_one(raw, ["payment_id"], nulls_apart=True, hot=find_hot(raw, ["payment_id"], hot_rows))
    clean = typed(tag_keyless(once, ["payment_id"]), "payments")
    clean = clean.withColumnRenamed("external_ref", "ride_id").withColumn(
        "amount", amounts.from_minor_units(F.col("amount_minor"))
    )
    lost = F.col("amount_minor").isNotNull() & F.col("amount").isNull()
    clean = tag(clean, [Rule(UNREADABLE, lost)]).withColumns(
        {
            "amount_euros": amounts.in_euros(F.col("amount"), F.col("currency")).try_cast("decimal(10,2)"),
            "payment_date": times.day_of(F.col("captured_at")),
            "is_charge": text.is_value(F.col("type"), "charge"),
            "is_successful": text.is_value(F.col("status"), "captured"),
        }
    )
    parted = part(tag_orphans(clean, "ride_id", known_rides, ORPHAN_RIDE, hot))
    return parted._replace(kept=parted.kept.drop("customer_country"))


def telemetry(
    raw: DataFrame, known_vehicles: DataFrame, known_cities: DataFrame, hot_rows: int = HOT_ROWS
) -> Parted:
    """One row per event, in UTC and on the 0-1 battery scale; unregistered vehicles are flagged."""
    once = tag_keyless(keep_one(raw, ["event_id"], nulls_apart=True, hot=find_hot(raw, ["event_id"], hot_rows)), ["event_id"])
    clean = typed(tag(once, [Rule(UNREADABLE, times.beyond_timestamps(F.col("ts")))]), "telemetry")
    zones_of = known_cities.select(F.col("city_id").alias("city"), "timezone")
    clean = add_attributes(clean, "city", zones_of, ["timezone"])
    clean = mark_members(clean, "vehicle_id", known_vehicles, "is_registered_vehicle",
                         hot=find_hot(raw, ["vehicle_id"], hot_rows))
    written, zone = F.col("ts"), F.col("timezone")
    lat, lon = F.col("lat"), F.col("lon")
    clean = clean.withColumns(
        {
            "ts": F.coalesce(times.instant(written, zone), times.wall_clock(written, zone)),
            "lat": amounts.off_null_island(lat, lat, lon),
            "lon": amounts.off_null_island(lon, lat, lon),
            "battery": amounts.as_fraction(F.col("battery")),
        }
    ).withColumn("event_date", times.day_of(F.col("ts")))
    return part(clean.drop("timezone"))
