"""Generated columns and ranges, and the text report sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.ordered import names


def range_generate(spark: SparkSession, n: int, parts: int | None = None) -> DataFrame:
    """(id, v = 4·id) for id in 0..n-1 in ``parts`` equal segments; 64-bit, so it does not wrap."""
    return spark.range(0, n, 1, parts).select("id", (F.col("id") * 4).alias("v"))


def range_values(df: DataFrame, seq: str) -> DataFrame:
    """(id, v = 4·id) for the numbers in a column."""
    return df.select(F.col(seq).cast("long").alias("id"), (F.col(seq).cast("long") * 4).alias("v"))


def range_verify(df: DataFrame) -> DataFrame:
    """How many values there are and how many differ from 4·id."""
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("v") != F.col("id") * 4, 1)).alias("mismatches"),
    )


def segment_progress(df: DataFrame, seq: str, n: int, parts: int) -> DataFrame:
    """Rows done and per cent per segment and 10 % step; the last segment takes any remainder."""
    size = -(-n // parts)
    segment = F.floor(F.col(seq) / size).cast("long")
    here = F.least(F.lit(size), F.lit(n) - segment * size)
    step = F.floor((F.col(seq) - segment * size) * 10 / here).cast("long")
    counted = (
        df.select(segment.alias("segment"), step.alias("step"), here.alias("segment_rows"))
        .groupBy("segment", "step", "segment_rows").agg(F.count(F.lit(1)).alias("rows"))
    )
    return counted.withColumn("percent", (F.col("step") + 1) * 10)


def _drawn(key, seed: int) -> Column:
    """60 bits of the MD5 of the keys (as text, null as nothing) and the seed, joined by ``|``."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in names(key)]
    digest = F.md5(F.concat_ws("|", *parts, F.lit(str(seed))).cast("binary"))
    return F.conv(F.left(digest, F.lit(15)), 16, 10).cast("long")


def bounded_uniform(df: DataFrame, key, lo: int, hi: int, seed: int = 42, name: str = "u") -> DataFrame:
    """A uniform integer in lo..hi that depends only on the key, so a retried task repeats it."""
    return df.withColumn(name, _drawn(key, seed) % F.lit(hi - lo + 1) + F.lit(lo))


def bounded_decimal(df: DataFrame, key, seed: int = 42, name: str = "u") -> DataFrame:
    """A value in -50.0..50.0 in steps of 0.1."""
    return df.withColumn(name, (_drawn(key, seed) % 1001 - 500) / 10)


def hex_text(c) -> Column:
    return F.lower(F.hex(F.col(c) if isinstance(c, str) else c))


def render_report(df: DataFrame, templates: Sequence[tuple[str, Sequence[Column | str]]],
                  keep: Sequence[str] = ()) -> DataFrame:
    """One text line per row and template: (keep..., line_no, line)."""
    lines = F.array(*[
        F.format_string(fmt, *[F.col(c) if isinstance(c, str) else c for c in cols])
        for fmt, cols in templates
    ])
    return df.select(*keep, F.posexplode(lines).alias("line_no", "line"))


def write_report(lines: DataFrame, path: str) -> None:
    lines.select("line").write.mode("errorifexists").text(path)
