"""Sampled signals: embeddings as frames, event values as readings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import signal as sg
from ..plans import ordered as od
from .registry import EV, query

SAMPLES = """
samples AS (SELECT vec_id, unnest(range(len(embedding))) AS idx, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
"""
SMOOTH = f"""
{SAMPLES}, smooth AS (SELECT vec_id, idx, v,
  avg(v) OVER (PARTITION BY vec_id ORDER BY idx ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS smooth FROM samples)
"""


def samples(t):
    return t.embeddings.select("vec_id", F.posexplode("embedding").alias("idx", "v")).select(
        "vec_id", F.col("idx").cast("long").alias("idx"), F.col("v").cast("double").alias("v")
    )


# The samples of a frame come from one array, so a frame is never large.
FRAME = od.whole("vec_id", "idx")


@query("w1_moving_mean", f"WITH {SMOOTH} SELECT vec_id, idx, round(smooth, 7) AS smooth FROM smooth")
def moving_mean(t):
    out = sg.moving_mean(samples(t), "vec_id", "idx", "v", split=FRAME)
    return out.select("vec_id", "idx", F.round("smooth", 7).alias("smooth"))


SERIES = f"""
WITH {EV} SELECT event_id, round(avg(cents) OVER (PARTITION BY event_type ORDER BY us, event_id
  ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS smooth FROM ev
"""


@query("w1_moving_mean_series", SERIES)
def moving_mean_series(t):
    out = sg.moving_mean(t.ev, "event_type", ["us", "event_id"], "cents")
    return out.select("event_id", F.round("smooth", 6).alias("smooth"))


@query("w1_moving_mean_cut", SERIES)
def moving_mean_cut(t):
    """Long frames cut into chunks that lend each other their edge rows."""
    out = sg.moving_mean(t.ev, "event_type", ["us", "event_id"], "cents", max_rows=400)
    return out.select("event_id", F.round("smooth", 6).alias("smooth"))


@query("w4_threshold_binary", f"""
WITH {SMOOTH} SELECT vec_id, idx,
  CASE WHEN smooth >= 0.7e0 * max(smooth) OVER (PARTITION BY vec_id) THEN 1 ELSE 0 END AS bit FROM smooth
""")
def threshold_binary(t):
    smooth = sg.moving_mean(samples(t), "vec_id", "idx", "v", split=FRAME)
    return sg.threshold_binary(smooth, "vec_id", "idx", "smooth", split=FRAME).select("vec_id", "idx", "bit")


BITS = f"""
WITH {EV} SELECT event_id,
  CASE WHEN cents >= 0.7e0 * max(cents) OVER (PARTITION BY event_type) THEN 1 ELSE 0 END AS bit FROM ev
"""


@query("w4_threshold_binary_cut", BITS)
def threshold_binary_cut(t):
    return sg.threshold_binary(t.ev, "event_type", ["us", "event_id"], "cents", max_rows=400).select(
        "event_id", "bit"
    )


# Event values as a 14-bit reading that saturates at both ends.
ADC_SQL = "CASE WHEN cents >= 500 THEN 16383 WHEN cents < 200 THEN 0 ELSE cents END"


def readings(t):
    c = F.col("cents")
    return t.ev.withColumn("adc", F.when(c >= 500, 16383).when(c < 200, 0).otherwise(c))


@query("f4_saturating_peaks", f"""
WITH {EV}, a AS (SELECT event_id, user_id, us, {ADC_SQL} AS adc FROM ev),
p AS (SELECT *, lag(adc) OVER (PARTITION BY user_id ORDER BY us, event_id) AS prev FROM a)
SELECT event_id, coalesce(adc = 16383 AND adc > prev, false) AS is_peak,
  coalesce(adc = 0 AND prev <> 0, false) AS is_fall FROM p
""")
def saturating_peaks(t):
    out = sg.saturating_peaks(readings(t), "user_id", ["us", "event_id"], "adc", 16383)
    return out.select("event_id", "is_peak", "is_fall")


RATE = f"""
WITH {EV}, a AS (SELECT event_type, us, tick, event_id, {ADC_SQL} AS adc FROM ev),
p AS (SELECT *, lag(adc) OVER w AS prev, row_number() OVER w - 1 AS place FROM a
      WINDOW w AS (PARTITION BY event_type ORDER BY us, event_id))
SELECT event_type, place // 500 AS frame_id, count(*) AS n,
  count(*) FILTER (adc = 16383 AND adc > prev AND place % 500 <> 0) AS peaks, max(tick) - min(tick) AS elapsed,
  round(CASE WHEN max(tick) > min(tick) THEN count(*) FILTER (adc = 16383 AND adc > prev AND place % 500 <> 0)
    / CAST(max(tick) - min(tick) AS DOUBLE) * 1000 * 60 END, 9) AS per_minute
FROM p GROUP BY event_type, place // 500
"""


def rate(t, **opts):
    out = sg.rate_per_minute(readings(t), "event_type", ["us", "event_id"], "tick", "adc", 16383, **opts)
    return out.withColumn("per_minute", F.round("per_minute", 9))


@query("a7_rate_per_minute", RATE)
def rate_per_minute(t):
    return rate(t)


@query("a7_rate_per_minute_cut", RATE)
def rate_per_minute_cut(t):
    return rate(t, max_rows=300)


CROSSINGS = f"""
WITH {EV}, p AS (SELECT event_id, user_id, (tick - 1704067200000)::DOUBLE AS x, (cents - 500)::DOUBLE AS f,
  lag((tick - 1704067200000)::DOUBLE) OVER w AS px, lag((cents - 500)::DOUBLE) OVER w AS pf
  FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))
SELECT event_id, user_id, x - f * (x - px) / (f - pf) AS x_cross,
  CASE WHEN f > 0 THEN 'up' ELSE 'down' END AS direction FROM p WHERE f * pf < 0
"""


def crossings(t, **opts):
    df = t.ev.withColumn("x", (F.col("tick") - 1704067200000).cast("double")).withColumn(
        "y", F.col("cents").cast("double"))
    out = sg.level_crossings(df, "user_id", ["us", "event_id"], "x", "y", 500.0, **opts)
    return out.select("event_id", "user_id", "x_cross", "direction")


@query("w8_level_crossings", CROSSINGS)
def level_crossings(t):
    return crossings(t)


@query("w8_level_crossings_function", CROSSINGS.replace("(cents - 500)::DOUBLE", "(cents * 2 - 1000)::DOUBLE"))
def level_crossings_function(t):
    """The roots of a caller's function of the reading."""
    return crossings(t, fn=lambda y: y * 2 - 500)


PULSES = f"""
WITH {EV}, p AS (SELECT user_id, us, event_id, tick // 3600000 AS hour, row_number() OVER w AS rn,
    lead(tick // 3600000) OVER w AS nxt FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
d AS (SELECT user_id, us, event_id, nxt - hour AS width FROM p WHERE rn % 2 = 1 AND nxt IS NOT NULL),
b AS (SELECT user_id, width FROM d WHERE width BETWEEN 2 AND 40)
SELECT user_id, width, width - 2 AS bucket, count(*) AS count FROM b GROUP BY user_id, width
"""


def pulses(t, **opts):
    df = t.ev.withColumn("hour", F.floor(F.col("tick") / 3600000))
    return sg.pulse_histogram(df, "user_id", "hour", 2, 40, order=["us", "event_id"], **opts)


@query("a1_pulse_histogram", PULSES)
def pulse_histogram(t):
    return pulses(t)


@query("a1_pulse_histogram_cut", PULSES)
def pulse_histogram_cut(t):
    """The same with the events of a user cut into segments."""
    return pulses(t, max_rows=40)
