"""Sampled signals: smoothing, thresholds, peaks, rates, crossings, pulse widths."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import band_filter
from ..plans import ordered as od
from .sorting import cap_first

#: 32-bit tick counters wrap here
WRAP = 4294967296
_CHUNK = 100_000


def moving_mean(df: DataFrame, frame, idx, value: str, half: int = 2, name: str = "smooth",
                split: od.Split | None = None, max_rows: int | None = None) -> DataFrame:
    """Centred mean over 2·half+1 samples, fewer at the ends of a frame."""
    split = split or od.measure(df, frame, idx, max_rows)
    keys, order = list(split.keys), list(split.order)
    if split.cuts is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-half, half)
        return df.withColumn(name, F.avg(value).over(w))
    # a large frame is cut into chunks by position; edge rows are lent to the next chunk
    size = max(max_rows or _CHUNK, 2 * half + 1)
    placed = od.scan(df, keys, order, split, _rn=od.row_number())
    home = F.floor((F.col("_rn") - 1) / size).cast("long")
    at = (F.col("_rn") - 1) % size
    lent = F.array_compact(F.array(
        home, F.when(at < half, home - 1), F.when(at >= size - half, home + 1)
    ))
    spread = placed.withColumn("_home", home).withColumn("_chunk", F.explode(lent))
    w = Window.partitionBy(*keys, "_chunk").orderBy("_rn").rowsBetween(-half, half)
    smooth = spread.withColumn(name, F.avg(value).over(w))
    return smooth.filter(F.col("_chunk") == F.col("_home")).select(*df.columns, name)


def threshold_binary(df: DataFrame, frame, idx, value: str, frac: float = 0.7, name: str = "bit",
                     **opts) -> DataFrame:
    """1 where a value reaches ``frac`` of the largest of its frame, else 0."""
    topped = od.scan(df, frame, idx, _top=od.whole_max(value), **opts)
    return topped.withColumn(
        name, F.when(F.col(value) >= F.lit(frac) * F.col("_top"), 1).otherwise(0)
    ).drop("_top")


def saturating_peaks(df: DataFrame, key, order, value: str, full_scale, **opts) -> DataFrame:
    """``is_peak``: at full scale and above the sample before; ``is_fall``: zero after non-zero."""
    seen = od.scan(df, key, order, _prev=od.lag(value), **opts)
    v, p = F.col(value), F.col("_prev")
    return seen.withColumns({
        "is_peak": F.coalesce((v == F.lit(full_scale)) & (v > p), F.lit(False)),
        "is_fall": F.coalesce((v == 0) & (p != 0), F.lit(False)),
    }).drop("_prev")


def rate_per_minute(df: DataFrame, key, order, ts: str, value: str, full_scale,
                    frame: int = 500, ticks_per_second: int = 1000, **opts) -> DataFrame:
    """Peaks per minute for every ``frame`` consecutive samples of a key.

    The first sample of a frame has nothing before it and is never a peak.
    """
    seen = od.scan(df, key, order, _rn=od.row_number(), _prev=od.lag(value), **opts)
    v = F.col(value)
    peak = (v == F.lit(full_scale)) & (v > F.col("_prev")) & ((F.col("_rn") - 1) % frame != 0)
    framed = seen.withColumn("frame_id", F.floor((F.col("_rn") - 1) / frame).cast("long"))
    out = framed.groupBy(*od.names(key), "frame_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(peak, 1)).alias("peaks"),
        (F.max(ts) - F.min(ts)).alias("elapsed"),
    )
    per_tick = F.try_divide(F.col("peaks").cast("double"), F.col("elapsed").cast("double"))
    return out.withColumn("per_minute", per_tick * ticks_per_second * 60)


def level_crossings(df: DataFrame, key, order, x: str, y: str, level: float = 0.0,
                    fn: Callable[[Column], Column] | None = None, **opts) -> DataFrame:
    """Where consecutive samples lie on both sides of ``level``; the place by the secant through them.

    ``fn`` may transform y first (a function of one variable whose roots are sought).
    """
    f = (F.col(y) if fn is None else fn(F.col(y))) - F.lit(level)
    seen = od.scan(df.withColumn("_f", f), key, order, _px=od.lag(x), _pf=od.lag("_f"), **opts)
    f, pf = F.col("_f"), F.col("_pf")
    crossed = seen.filter(f * pf < 0)
    at = F.col(x) - f * (F.col(x) - F.col("_px")) / (f - pf)
    return crossed.withColumns({
        "x_cross": at,
        "direction": F.when(f > 0, "up").otherwise("down"),
    }).drop("_f", "_px", "_pf")


def pulse_widths(df: DataFrame, key, ts: str, tie=None, order=None, wrap: int = WRAP, **opts) -> DataFrame:
    """The first edge of each pair with ``width``: edges taken two by two, a wrapped counter unwrapped.

    Edges follow ``order`` (default: their time; give a sequence where the counter wraps).
    """
    by = od.names(order) or [ts] + od.names(tie)
    paired = od.scan(df, key, by, _rn=od.row_number(), _next=od.lead(ts), **opts)
    kept = paired.filter((F.col("_rn") % 2 == 1) & F.col("_next").isNotNull())
    return kept.withColumn("width", F.pmod(F.col("_next") - F.col(ts), F.lit(wrap))).drop("_rn", "_next")


def pulse_histogram(df: DataFrame, key, ts: str, lo: int, hi: int | None = None, cap: int | None = None,
                    tie=None, order=None, wrap: int = WRAP, **opts) -> DataFrame:
    """(key, bucket, width, count) of all widths within the band of each key, or of the first ``cap``."""
    by = od.names(order) or [ts] + od.names(tie)
    widths = pulse_widths(df, key, ts, tie, order, wrap, **opts)
    accepted = band_filter(widths, "width", lo, hi)
    if cap is not None:
        accepted = cap_first(accepted, key, by, cap)
    return (
        accepted.groupBy(*od.names(key), "width")
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("bucket", F.col("width") - F.lit(lo))
    )
