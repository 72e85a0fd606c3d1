"""Queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(t)``, where ``t`` reads tables, under ``name``."""

    def add(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


class Tables:
    """Reads tables of one scale; timestamps are read in UTC."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")

    def __getattr__(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    @property
    def ev(self) -> DataFrame:
        """Events with integer time and value."""
        return with_ticks(self.events)


def with_ticks(events: DataFrame) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return events.select(
        "event_id", "user_id", "event_type", "value",
        F.unix_micros(ts).alias("us"),
        F.unix_millis(ts).alias("tick"),
        F.round(F.col("value") * 100).cast("long").alias("cents"),
    )


#: the same columns for the oracle
EV = """ev AS (
  SELECT event_id, user_id, event_type, value, epoch_us(ts) AS us, epoch_us(ts) // 1000 AS tick,
         CAST(round(value * 100) AS BIGINT) AS cents FROM events)"""
