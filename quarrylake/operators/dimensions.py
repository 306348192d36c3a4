"""Dimension building blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylake.functions.columns import key_first
from quarrylake.functions.keys import UNKNOWN_KEY, hashed

# The days the calendar covers unless told otherwise.
FIRST_DAY, LAST_DAY = "2026-01-01", "2026-12-31"


def with_unknown_member(dim: DataFrame, surrogate: str) -> DataFrame:
    """Append the member that facts without a match point to."""
    unknown = dim.sparkSession.range(1).select(F.lit(UNKNOWN_KEY).alias(surrogate))
    return dim.unionByName(unknown, allowMissingColumns=True)


def keyed(dim: DataFrame, surrogate: str, *parts: str) -> DataFrame:
    """Put a hashed key over the given columns in front."""
    return key_first(dim.withColumn(surrogate, hashed(*[F.col(p) for p in parts])), surrogate)


def calendar(days: DataFrame, day: str = "date") -> DataFrame:
    """Calendar attributes of a column of days; weeks start on Monday, which is 0."""
    d = F.col(day)
    return days.withColumns(
        {
            "month": F.month(d),
            "year": F.year(d),
            "day": F.day(d),
            "day_week": F.weekday(d),
            "is_weekend": F.weekday(d) >= 5,
        }
    )


def days_between(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    bounds = spark.range(1).select(F.lit(first).cast("date").alias("a"), F.lit(last).cast("date").alias("b"))
    return bounds.select(F.explode(F.sequence("a", "b")).alias("date"))


def days_spanned(df: DataFrame, moment: str) -> DataFrame:
    """Every day from the first to the last moment of a table."""
    day = F.col(moment).cast("date")
    bounds = df.agg(F.min(day).alias("a"), F.max(day).alias("b"))
    return bounds.select(F.explode(F.sequence("a", "b")).alias("date"))


def date_dimension(days: DataFrame) -> DataFrame:
    return with_unknown_member(keyed(calendar(days), "date_sk", "date"), "date_sk")


def second_of_day(moment: Column) -> Column:
    """The moment's time of day, as that second of 1970-01-01."""
    seconds = F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)
    return F.timestamp_seconds(seconds)


def time_dimension(spark: SparkSession) -> DataFrame:
    """One row per second of the day."""
    seconds = spark.range(24 * 60 * 60).select(F.timestamp_seconds("id").alias("time"))
    return with_unknown_member(keyed(seconds, "time_sk", "time"), "time_sk")


def enumerated_dimension(df: DataFrame, column: str, surrogate: str) -> DataFrame:
    """One member per distinct value; null is a value."""
    values = df.select(column).distinct()
    return with_unknown_member(keyed(values, surrogate, column), surrogate)


def combinations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every combination of the values that occur in each column.

    The table is read once, for the combinations it holds, combined map-side; each
    value set is a distinct over one column of these. Their product is what a junk
    dimension is; it is planned as joins without a key, so its rows are made on all
    tasks and have no bound.
    """
    # Dealt again, the combinations stay a step of their own that all value sets share.
    held = df.select(*columns).distinct().repartition(*columns)
    first, *others = [held.select(c).distinct() for c in columns]
    for values in others:
        first = first.crossJoin(values)
    return first


def junk_dimension(df: DataFrame, columns: Sequence[str], surrogate: str) -> DataFrame:
    return with_unknown_member(keyed(combinations(df, columns), surrogate, *columns), surrogate)
