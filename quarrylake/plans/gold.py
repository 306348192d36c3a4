"""Dimensions over the cleaned tables. Every one has an unknown member."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylake.operators.dedupe import keep_one
from quarrylake.operators.dimensions import (
    FIRST_DAY, LAST_DAY, date_dimension, days_between, enumerated_dimension, junk_dimension, keyed,
    time_dimension, with_unknown_member,
)
from quarrylake.operators.history import build_history
from quarrylake.operators.skew import HOT_ROWS, HotKeys
from quarrylake.spec import RIDE_CONTEXT, RIDER_HISTORY, VEHICLE_HISTORY, Reference


def reference(table: DataFrame, ref: Reference) -> DataFrame:
    """Key on the id, or on id and start of validity where the source keeps versions."""
    parts = [ref.key] if ref.scd_type == 1 else [ref.key, "valid_from"]
    surrogate = f"{ref.name}_sk"
    return with_unknown_member(keyed(keep_one(table, parts), surrogate, *parts), surrogate)


def vehicles(snapshots: DataFrame, hot_rows: int = HOT_ROWS, hot: HotKeys | None = None) -> DataFrame:
    history = build_history(snapshots, VEHICLE_HISTORY, hot=hot, hot_rows=hot_rows)
    return with_unknown_member(history, VEHICLE_HISTORY.surrogate)


def riders(changes: DataFrame, hot_rows: int = HOT_ROWS, hot: HotKeys | None = None) -> DataFrame:
    """Of changes at the same moment, a delete counts before an update, and that before an insert."""
    rank = F.when(F.col("op") == "D", 0).when(F.col("op") == "U", 1).otherwise(2)
    history = build_history(changes, RIDER_HISTORY, ties=[rank], hot=hot, hot_rows=hot_rows)
    return with_unknown_member(history, RIDER_HISTORY.surrogate)


def dates(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    return date_dimension(days_between(spark, first, last))


def time_of_day(spark: SparkSession) -> DataFrame:
    return time_dimension(spark)


def payment_method(payments: DataFrame) -> DataFrame:
    return enumerated_dimension(payments, "method", "payment_method_sk")


def weather_day(weather: DataFrame) -> DataFrame:
    return with_unknown_member(keyed(keep_one(weather, ["city_id", "date"]), "weather_day_sk", "city_id", "date"), "weather_day_sk")


def ride_context(rides: DataFrame) -> DataFrame:
    flagged = rides.withColumn("is_promo", F.col("promo_code").isNotNull())
    return junk_dimension(flagged, list(RIDE_CONTEXT), "ride_context_sk")


