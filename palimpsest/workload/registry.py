"""Registered queries and, where SQL can say the same, their oracle on the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with its oracle."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day_text(column) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def time_text(column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def iso(column) -> Column:
    """ISO text with microseconds, the form that marks are compared in."""
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def cents(column) -> Column:
    """Whole cents, so that sums do not depend on the order of addition."""
    return F.round(F.col(column) * 100).cast("bigint")


def millionths(column) -> Column:
    return F.round(column * 1000000).cast("bigint")


def bronze_record(rows: DataFrame, schema: T.StructType, values: dict[str, Column], *keep: str) -> DataFrame:
    """Rows in a feed's bronze shape: ``values`` by path, NULL for every other field."""

    def build(kind: T.DataType, path: str) -> Column:
        if path in values:
            return values[path].cast(kind)
        if isinstance(kind, T.StructType):
            return F.struct(*[build(f.dataType, f"{path}.{f.name}").alias(f.name) for f in kind.fields])
        return F.lit(None).cast(kind)

    return rows.select(*[build(f.dataType, f.name).alias(f.name) for f in schema.fields], *keep)


# One version per user and day: the day is the batch, loaded at the next midnight.
VERSIONS_SQL = """
versions AS (
  SELECT event_id, user_id, event_type, value, props, CAST(ts AS DATE) AS batch,
         CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS TIMESTAMP) AS loaded_at
  FROM events
  QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id ORDER BY event_id) = 1
)"""
