"""Time the headline queries and the comparisons with the published figures.

Prints one JSON line. ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from pulsegrid.functions.scalars import poly_eval
from pulsegrid.operators.fit import linear_fit
from pulsegrid.queries import QUERIES
from pulsegrid.queries.scalars import QUARTIC
from pulsegrid.session import clean_up, local_session, workspace
from pulsegrid.sources import generate as gen
from pulsegrid.sources import text as tx

HEADLINE = [
    "a1_pulse_histogram", "a2_linear_fit", "a2_linear_fit_points", "a3_poly_fit", "a4_fit_quality",
    "a5_server_report", "a6_queue_report", "a7_rate_per_minute", "a9_qn_error", "a11_balance_audit",
    "calibration_sweep", "f4_saturating_peaks", "j1_positional_join", "j2_param_sweep", "j3_word_hits",
    "j4_fifo_match", "j5_snapshot", "p2_correct", "p5_poly_text", "s1_read_points", "s2_tokenize",
    "s3_validate_matrices", "s6_parse_timing_log", "t1_periodic_metrics", "t3_debounce", "t4_frames",
    "t5_assemble_lines", "t6_state_machine", "w1_moving_mean", "w2_depth_over_time", "w4_threshold_binary",
    "w8_level_crossings",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeats: int = 2) -> float:
    best = None
    for _ in range(repeats):
        start = time.perf_counter()
        fn()
        took = time.perf_counter() - start
        best = took if best is None else min(best, took)
    return round(best, 4)


def published(spark, sf_dir: str) -> dict[str, dict[str, float]]:
    out = {}

    def compare(name: str, items: int, seconds: float, reference: float) -> None:
        out[name] = {"sec": seconds, "items_per_sec": round(items / seconds),
                     "reference_items_per_sec": round(reference)}

    n = 1_067_458_560
    compare("range_fill_and_verify", n, timed(lambda: gen.range_verify(gen.range_generate(spark, n, 64)).collect(), 1),
            n / 10)
    n = 100_000_000
    x = spark.range(n).select((F.col("id") * 1e-7).alias("x"))
    compare("poly_eval", n, timed(lambda: x.select(F.sum(poly_eval(QUARTIC, "x"))).collect(), 1), 1 / 5.5e-9)

    # lines and points: the line items ten times over, from text files; a cached table of points
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.concat_ws(" ", "l_quantity", "l_extendedprice").alias("line"), F.explode(F.sequence(F.lit(1), F.lit(10)))
    ).select("line")
    path = workspace(spark, "bench-points")
    lines.repartition(32).write.text(path)
    n = lines.count()
    compare("read_points", n, timed(lambda: run(tx.read_points(spark, path)[0])), 5000 / 2.167e-3)
    n = 50_000_000
    points = spark.range(n).select((F.col("id") % 1000).cast("double").alias("x"), (F.col("id") % 977 * 1.3).alias("y"))
    points = points.cache()
    points.count()
    compare("line_fit", n, timed(lambda: linear_fit(points, "x", "y").collect()), 5000 / 4.5e-6)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    times = {name: timed(lambda q=QUERIES[name]: run(q(spark, sf_dir))) for name in HEADLINE}
    compared = published(spark, sf_dir)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "published": compared, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }), flush=True)
    clean_up()
    spark.stop()


if __name__ == "__main__":
    main()
