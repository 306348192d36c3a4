"""The registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylake.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

TEXT_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL twin if there is one."""
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; its zone-less timestamps are read as UTC instants."""
    df = prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    moments = {c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"}
    return df.withColumns(moments) if moments else df


def time_text(moment: Column) -> Column:
    """A moment as text, so that results compare alike in any engine."""
    return F.date_format(moment, TEXT_TIME)
