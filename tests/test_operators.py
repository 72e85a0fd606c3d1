"""Small hand fixtures and properties of the batch operators."""

import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import fixedpoint as qn
from pulsegrid.functions import scalars as sc
from pulsegrid.operators import fit, joins, search, sorting
from pulsegrid.operators import queueing as qu
from pulsegrid.operators import signal as sg
from pulsegrid.plans import ordered as od


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def floats(*values):
    return F.array(*[F.lit(float(v)) for v in values])


# ----------------------------------------------------------------------------- scalars


def test_polynomial_value(spark):
    assert round(one(spark, sc.poly_eval([4.4, -3.3, 2.2, -1.1, 6.0], F.lit(7.7))), 6) == 14088.74714
    assert round(one(spark, sc.poly_eval(floats(4.4, -3.3, 2.2, -1.1, 6.0), F.lit(7.7))), 6) == 14088.74714


def test_derivatives(spark):
    assert one(spark, sc.poly_deriv(floats(1, 2, 1, 2))) == [3, 4, 1]
    assert one(spark, sc.poly_deriv(floats(1, 2, 1, 2), 2)) == [6, 4]
    assert one(spark, sc.poly_deriv(floats(5))) == [0]


def test_roots(spark):
    r = one(spark, sc.quadratic_roots(F.lit(1), F.lit(0), F.lit(1)))
    assert (r["r0"]["im"], r["r1"]["im"]) == (1, -1)
    r = one(spark, sc.quadratic_roots(F.lit(2), F.lit(-6), F.lit(4)))
    assert (r["r0"]["re"], r["r1"]["re"]) == (2, 1)
    assert one(spark, sc.quadratic_roots(F.lit(0), F.lit(1), F.lit(1))) is None


@pytest.mark.parametrize("value,text", [
    (1.0, "1"), (-395.213, "-395.213"), (1e6, "1e+06"), (999999.4, "999999"), (999999.6, "1e+06"),
    (0.0001, "0.0001"), (0.00034, "0.00034"), (3.4e-7, "3.4e-07"), (123456.7, "123457"), (0.0, "0"),
    (-0.000358309, "-0.000358309"), (1.5e300, "1.5e+300"), (100000.0, "100000"),
])
def test_number_text(spark, value, text):
    assert one(spark, sc.number_text(F.lit(value))) == text


def test_polynomial_text(spark):
    assert one(spark, sc.poly_text(floats(1, 0, 1))) == "1x^2 + 1x^0"
    assert one(spark, sc.poly_text(floats(16, 70, -169, -580, 75))) == "16x^4 + 70x^3 - 169x^2 - 580x^1 + 75x^0"
    assert one(spark, sc.fit_text(floats(0.823035, 1.26393))) == "0.823035 + 1.26393x"
    assert one(spark, sc.fit_text(floats(-2, 0, 3))) == "-2 + 3x^2"
    assert one(spark, sc.fit_text(floats(0, 0))) == "0"


def test_correction_rounds_away_from_zero(spark):
    df = spark.createDataFrame([(10,), (-3,)], "real int")
    got = sc.correct(df, "real", 0, 0, 2.5).collect()
    assert [r["corrected"] for r in got] == [7, -6]
    assert sc.correct(df, "real", 0, 0, -2.5).first()["corrected"] == 13


def test_units_and_labels(spark):
    row = sc.adc_to_temp(spark.createDataFrame([(4915,)], "adc int"), "adc").first()
    assert round(row["celsius"], 2) == 25.0 and round(row["fahrenheit"], 1) == 77.0
    assert one(spark, sc.tick_to_clock(F.lit(0))) == "09:00"
    assert one(spark, sc.tick_to_clock(F.lit(42000))) == "16:00"
    assert one(spark, sc.tick_to_clock(F.lit(100 * 60 * 20))) == "29:00"
    assert one(spark, sc.code_label(F.lit("2"))) == "Blue"
    assert one(spark, sc.code_label(F.lit("x"))) == "Invalid Input"
    assert one(spark, sc.busy_label(F.lit(True), F.lit(True))) == "Busy"
    assert [one(spark, sc.clamp(F.lit(v), 0, 5)) for v in (-1, 3, 9)] == [0, 3, 5]


def test_packed(spark):
    df = spark.createDataFrame([(0x25,), (0x40,), (0x82,), (0xA0,), (0xC0,), (0x00,)], "byte int")
    got = [(r["op"], r["operand"]) for r in sc.decode_packed(df, "byte").collect()]
    assert got == [("MOV", 5), ("WAIT", 0), ("LOOP", 2), ("END_LOOP", 0), ("error", 0), ("RECIPE_END", 0)]


def test_fixed_point(spark):
    df = spark.createDataFrame([(-1.5, 0.75)], "x double, y double").select(
        qn.qn_encode("x", 8).alias("a"), qn.qn_encode("y", 8).alias("b"))
    row = df.select("a", "b", qn.qn_mul("a", "b", 8).alias("m"), qn.qn_div("a", "b", 8).alias("d"),
                    qn.qn_decode("a", 8).alias("x")).first()
    assert tuple(row) == (-384, 192, -288, -512, -1.5)


def test_band_limits(spark):
    df = spark.createDataFrame([(949,), (950,), (1050,), (1051,)], "d int")
    assert [r["d"] for r in sc.band_filter(df, "d", 950).collect()] == [950, 1050]
    with pytest.raises(ValueError):
        sc.band_filter(df, "d", 20)


# ----------------------------------------------------------------------------- fits


def test_fit_of_equal_x_is_null(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 3.0), ("b", 0.0, 1.0), ("b", 2.0, 5.0)],
                               "k string, x double, y double")
    got = {r["k"]: (r["a"], r["b"]) for r in fit.linear_fit(df, "x", "y", "k").collect()}
    assert got == {"a": (None, None), "b": (2.0, 1.0)}
    poly = {r["k"]: r["coefs"] for r in fit.poly_fit(df, "x", "y", 1, "k").collect()}
    assert poly["a"] is None and [round(c, 9) for c in poly["b"]] == [1, 2]


def test_cubic_is_recovered_far_from_zero(spark):
    df = spark.range(1000, 1400).select(F.col("id").cast("double").alias("x")).withColumn(
        "y", sc.poly_eval([1e-3, -2.0, 3.0, 4.0], "x"))
    c = fit.poly_fit(df, "x", "y", 3).first()["coefs"]
    back = spark.range(1).select(sc.poly_eval([float(v) for v in reversed(c)], F.lit(1200.0)).alias("v")).first()["v"]
    assert abs(back - (1e-3 * 1200**3 - 2 * 1200**2 + 3 * 1200 + 4)) < 1e-3
    assert abs(c[3] - 1e-3) < 1e-9


def test_calibration_takes_the_error_off(spark):
    df = spark.range(81, 400).select(F.col("id").cast("int").alias("ideal"),
                                     (F.col("id") * 1.2 + 30).cast("int").alias("real"))
    worst = fit.calibrate(df, "ideal", "real").agg(F.max(F.abs(F.col("corrected") - F.col("ideal")))).first()[0]
    assert worst <= 1


def test_complex_value(spark):
    v = one(spark, sc.poly_eval_complex(floats(1, 0, 1), F.lit(0.0), F.lit(1.0)))
    assert (v["re"], v["im"]) == (0, 0)


def test_large_cap(spark):
    df = spark.range(5000).select(F.lit("k").alias("k"), "id").repartition(4)
    assert sorted(r["id"] for r in sorting.cap_first(df, "k", "id", 1500).collect()) == list(range(1500))


def test_fit_quality(spark):
    df = spark.createDataFrame([(10.0, 11.0), (20.0, 20.0), (40.0, 38.0)], "i double, r double")
    q = fit.fit_quality(df, "i", "r").first()
    assert (q["max_pct"], q["min_pct"], q["max_err"], round(q["residual_norm"], 6)) == (10, 0, 2, 2.236068)
    assert round(q["r2"], 6) == round(1 - 5 / 466.6666667, 6)


# ----------------------------------------------------------------------------- signals


def test_pulse_wrap_and_band(spark):
    edges = [4294967000, 700, 1000, 2010, 3000, 9000]  # one pair wraps, one is out of the band
    df = spark.createDataFrame([("k", i, e) for i, e in enumerate(edges)], "k string, seq long, ts long")
    got = sg.pulse_histogram(df, "k", "ts", 950, order="seq").orderBy("bucket").collect()
    assert [(r["bucket"], r["width"], r["count"]) for r in got] == [(46, 996, 1), (60, 1010, 1)]


def test_histogram_counts_all_unless_told(spark):
    df = spark.range(6000).select(F.lit("k").alias("k"), (F.col("id") * 1000).alias("ts"))
    assert sg.pulse_histogram(df, "k", "ts", 950).agg(F.sum("count")).first()[0] == 3000
    assert sg.pulse_histogram(df, "k", "ts", 950, cap=1000).agg(F.sum("count")).first()[0] == 1000


@pytest.mark.parametrize("apart", [1e2, 1e4, 1e6])
def test_poly_fit_of_distant_groups(spark, apart):
    rows = [(g, g * apart + i / 10, (i / 10) ** 2) for g in range(3) for i in range(200)]
    df = spark.createDataFrame([*rows, (9, 1.0, 1.0), (9, 1.0, 2.0)], "g int, x double, y double")
    got = {r["g"]: r["coefs"] for r in fit.poly_fit(df, "x", "y", 2, "g").collect()}
    assert got.pop(9) is None and len(got) == 3
    for g, c in got.items():
        x = g * apart + 7
        assert abs(c[0] + c[1] * x + c[2] * x * x - 49) < 1e-9 * max(apart, 1e3) ** 2 / 1e3


def test_fifo_with_null_queue_and_a_key_named_k(spark):
    a = spark.createDataFrame([(None, 1), (None, 4), ("q", 2)], "k string, ts long")
    s = spark.createDataFrame([(None, 3), (None, 9), ("q", 5)], "k string, ts long")
    got = joins.fifo_match(a, s, "k", "ts", position="nth").orderBy("started").collect()
    assert [(r["k"], r["nth"], r["wait"]) for r in got] == [(None, 1, 2), ("q", 1, 3), (None, 2, 5)]


def test_snapshot_with_null_key_and_span(spark):
    df = spark.createDataFrame([(None, 1000, 1), ("a", 4000, 1), ("a", 7000, 1), ("a", 20000, 1)], "k string, ts long, d int")
    got = joins.snapshot(df, "k", "ts", 3000, sums={"depth": F.col("d")}, span=(6000, 9000))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [
        (None, 6000, 1), (None, 9000, 1), ("a", 6000, 1), ("a", 9000, 2)]))
    got = joins.snapshot(df.filter("ts < 5000"), "k", "ts", 3000, sums={"depth": F.col("d")}).collect()
    assert {(r["k"], r["tick"], r["depth"]) for r in got} == {(None, 3000, 1), (None, 6000, 1), ("a", 6000, 1)}


def test_smoothing_edges(spark):
    df = spark.createDataFrame([("f", i, float(v)) for i, v in enumerate([1, 2, 6, 3, 8, 4])],
                               "f string, idx long, v double")
    for rows in (None, 2):
        got = sg.moving_mean(df, "f", "idx", "v", max_rows=rows).orderBy("idx").collect()
        assert [r["smooth"] for r in got] == [3, 3, 4, 4.6, 5.25, 5]
    bits = sg.threshold_binary(df, "f", "idx", "v").orderBy("idx").collect()
    assert [r["bit"] for r in bits] == [0, 0, 1, 0, 1, 0]


def test_peaks_and_rate(spark):
    values = [0, 16383, 16383, 0, 0, 16383, 16383, 16383]
    df = spark.createDataFrame([("s", i, i * 1000, v) for i, v in enumerate(values)],
                               "k string, seq long, ts long, v int")
    p = sg.saturating_peaks(df, "k", "seq", "v", 16383).orderBy("seq").collect()
    assert [r["is_peak"] for r in p] == [False, True, False, False, False, True, False, False]
    assert [r["is_fall"] for r in p] == [False, False, False, True, False, False, False, False]
    rate = sg.rate_per_minute(df, "k", "seq", "ts", "v", 16383, frame=5).orderBy("frame_id").collect()
    assert [(r["n"], r["peaks"], r["elapsed"], r["per_minute"]) for r in rate] == [(5, 1, 4000, 15.0), (3, 0, 2000, 0.0)]


# ----------------------------------------------------------------------------- queues and joins


def test_queue_day(spark):
    arrivals = spark.createDataFrame([("q", 1, 0), ("q", 2, 10), ("q", 3, 250)], "queue string, id long, ts long")
    starts = spark.createDataFrame([("q", 1, 100), ("q", 2, 400), ("q", 3, 500)], "queue string, id long, ts long")
    ends = spark.createDataFrame([("q", 1, 300), ("q", 2, 480), ("q", 3, 900)], "queue string, id long, ts long")
    matched = joins.fifo_match(arrivals, starts, "queue", "ts", "id")
    assert [r["wait"] for r in matched.orderBy("k").collect()] == [100, 390, 250]
    depth = qu.depth_over_time(arrivals, ends, "queue", "ts", "id")
    assert [r["depth"] for r in depth.orderBy("ts").collect()] == [1, 2, 3, 2, 1, 0]
    report = qu.queue_report(matched, depth, "queue").first()
    assert tuple(report) == ("q", 3, 2, 3, 3)
    for limit in (None, 2):
        assert tuple(qu.queue_day(arrivals, starts, ends, "queue", "ts", "id", max_rows=limit).first()) == ("q", 3, 2, 3, 3)
    none = arrivals.filter("false")
    assert qu.queue_day(none, starts, none, "queue", "ts", "id").count() == 0
    waiting = arrivals.withColumn("queue", F.lit(None).cast("string"))
    assert tuple(qu.queue_day(waiting, none, none, "queue", "ts", "id").first()) == (None, 0, None, None, 3)


def test_peak_of_a_running_sum(spark):
    """In segments and whole: also where the peak lies in an earlier segment, and where all sums are negative."""
    rnd = random.Random(11)
    rows = [(k, i, rnd.choice([-3, -1, 2] if k == "down" else [-2, 1, 1, None])) for k in ("down", "up") for i in range(300)]
    df = spark.createDataFrame(rows, "k string, i long, v int").repartition(3)
    want, total, best = {}, {}, {}
    for k, i, v in rows:
        total[k] = total.get(k, 0) + (v or 0)
        best[k] = max(best.get(k, total[k]), total[k])
        want[k, i] = (total[k], best[k])
    for limit in (None, 40):
        out = od.scan(df, "k", "i", max_rows=limit, s=od.running_sum("v"), p=od.running_peak("v"))
        assert {(r["k"], r["i"]): (r["s"], r["p"]) for r in out.collect()} == want


def test_snapshot_work_grows_with_events(spark):
    """Two events a million ticks apart: one row each until the report, which has all ticks."""
    df = spark.createDataFrame([("a", 1, 1), ("a", 3_000_000_000, 1), ("b", 6001, 5)], "k string, ts long, d int")
    out = joins.snapshot(df, "k", "ts", 3000, sums={"depth": F.col("d")})
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r["k"]: tuple(r)[1:] for r in out.groupBy("k").agg(
        F.count("*"), F.min("tick"), F.max("tick"), F.countDistinct("tick"), F.sum("depth")).collect()}
    assert got == {"a": (1_000_000, 3000, 3_000_000_000, 1_000_000, 1_000_001),
                   "b": (999_998, 9000, 3_000_000_000, 999_998, 4_999_990)}
    assert joins.snapshot(df.filter("false"), "k", "ts", 3000, sums={"depth": F.col("d")}).count() == 0


def test_server_report(spark):
    services = spark.createDataFrame([(1, 100, 500), (1, 900, 1300), (2, 50, 250)], "server int, start long, end long")
    breaks = spark.createDataFrame([(1, 500, 700), (1, 1300, 1900)], "server int, start long, end long")
    got = {r["server"]: r for r in qu.server_report(services, breaks, "server").collect()}
    assert (got[1]["served"], got[1]["avg_service"], got[1]["max_service"]) == (2, 4, 4)
    assert (got[1]["avg_idle"], got[1]["ref_idle_div"], got[1]["max_idle"]) == (2, 2, 4)
    assert (got[1]["breaks"], got[1]["avg_break"], got[1]["longest_break"], got[1]["shortest_break"]) == (2, "4", 6, "2")
    assert (got[2]["avg_break"], got[2]["shortest_break"]) == ("none",) * 2


def test_depth_is_never_negative(spark):
    rnd = random.Random(4)
    rows = [("hot" if rnd.random() < .6 else "x", i, rnd.randint(0, 300), rnd.randint(0, 60)) for i in range(400)]
    df = spark.createDataFrame(rows, "q string, id long, ts long, stay long").repartition(3)
    gone = df.select("q", "id", (F.col("ts") + F.col("stay")).alias("ts"))
    for limit in (30, None):
        out = qu.depth_over_time(df, gone, "q", "ts", "id", max_rows=limit)
        low = out.agg(F.min("depth").alias("low"), F.sum("delta").alias("left")).first()
        assert (low["low"], low["left"]) == (0, 0)


def test_sessions_and_stopwatch(spark):
    rows = [("k", t, kind) for t, kind in [(1, "stop"), (2, "start"), (5, "start"), (9, "stop"), (10, "stop"), (20, "start")]]
    df = spark.createDataFrame(rows, "k string, ts long, kind string")
    s = qu.timer_sessions(df, "k", "ts", "kind").first()
    assert tuple(s) == ("k", 4, 1, 1, 2, True)
    assert [r["elapsed"] for r in qu.stopwatch(df, "k", "ts").orderBy("start").collect()] == [1, 4, 10]


def test_positional_join_pads(spark):
    a = spark.createDataFrame([(i, f"a{i}") for i in range(5)], "i long, a string")
    b = spark.createDataFrame([(i, f"b{i}") for i in range(3)], "j long, b string")
    for limit in (None, 2):
        got = joins.positional_join(a, b, "i", "j", max_rows=limit).orderBy("k").collect()
        assert [(r["a"], r["b"]) for r in got] == [("a0", "b0"), ("a1", "b1"), ("a2", "b2"), ("a3", None), ("a4", None)]
    with pytest.raises(ValueError):
        joins.positional_join(a, a, "i", "i")


def test_snapshot_without_key(spark):
    df = spark.createDataFrame([(5, 1), (2999, 1), (3000, -1), (3001, 1), (9100, -1)], "ts long, d int")
    got = joins.snapshot(df, [], "ts", 3000, sums={"depth": F.col("d")}).orderBy("tick").collect()
    assert [(r["tick"], r["depth"]) for r in got] == [(3000, 1), (6000, 2), (9000, 2), (12000, 1)]


def test_search(spark):
    corpus = spark.createDataFrame([(1, "space"), (2, "cake"), (3, "space"), (4, "w" * 300)], "seq long, word string")
    assert search.find_exact(corpus, "word", "space", "seq").first()["seq"] == 1
    assert search.find_exact(corpus, "word", "xyzzy", "seq").count() == 0
    long = "w" * 256 + "tail"  # as long as a word of the corpus up to there
    assert search.find_exact(corpus, "word", long, "seq").count() == 0
    assert search.find_exact(corpus, "word", "w" * 300, "seq").count() == 1
    asked = spark.createDataFrame([("space",), ("xyzzy",), ("space",), (long,)], "word string")
    hits = {r["word"]: r["found"] for r in search.word_hits(corpus, asked).collect()}
    assert hits == {"space": True, "xyzzy": False, long: False}
    assert {r["word"] for r in search.occurring(corpus, asked).collect()} == {w for w, f in hits.items() if f}
    assert {r["word"] for r in search.missing(corpus, asked).collect()} == {w for w, f in hits.items() if not f}


def test_sorts(spark):
    rnd = random.Random(9)
    rows = [(rnd.randint(0, 3), rnd.randint(-9, 9)) for _ in range(60)]
    df = spark.createDataFrame(rows, "mag int, ang int").repartition(3)
    assert [tuple(r) for r in sorting.sort_by(df, ["mag", "ang"]).collect()] == sorted(rows)
    by_size = [r["ang"] for r in sorting.sort_by(df, "ang", absolute=["ang"]).collect()]
    assert [abs(v) for v in by_size] == sorted((abs(v) for _, v in rows), reverse=True)
    ends = sorting.head_tail(spark.range(10), "id", 3).collect()
    assert sorted((r["side"], r["id"]) for r in ends) == [("first", 0), ("first", 1), ("first", 2),
                                                         ("last", 7), ("last", 8), ("last", 9)]


def test_audit(spark):
    rows = [("p1", "open"), ("p1", "close"), ("p2", "open"), ("p3", "close"), ("p2", "open")]
    got = qu.balance_audit(spark.createDataFrame(rows, "ptr string, kind string"), "ptr", "kind")
    assert {r["ptr"]: r["balance"] for r in got.collect()} == {"p2": 2, "p3": -1}
