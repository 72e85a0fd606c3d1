"""Intermediate tables in the shared folder, and connected components over links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import workspace


#: whether shuffle files go at the end of a query; else they stay until the driver happens to collect its garbage
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there, so a lost executor
    costs only what it was working on, and what it shuffled goes at once. The folder goes when the program ends."""
    spark = df.sparkSession
    path, before = workspace(spark, name), spark.conf.get(CLEAN, None)
    spark.conf.set(CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEAN)
        else:
            spark.conf.set(CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``: the smallest node that it reaches.

    Alternating stars: every node first points its larger neighbours, then its smaller ones, at the
    smallest node it sees. The links of one round are a table; only two figures reach the driver.
    """
    edges = saved(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a").alias("x"), F.col("m")), F.struct(F.col("b").alias("x"), F.col("m")))).alias("e"))
            .select(F.col("e.x").alias("a"), F.col("e.m").alias("b")).where("a != b").distinct())
        edges = saved(small, "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    ends = edges.groupBy("a").agg(F.min("b").alias("component"))
    return (ends.select(F.col("a").alias("node"), "component")
            .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
