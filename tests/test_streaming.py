"""A stream over several files gives what the batch operator gives."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import states as st
from pulsegrid.plans import folds
from pulsegrid.streaming import stateful as ss


@pytest.fixture()
def feed(spark, tmp_path):
    """Write rows as files in arrival order and stream them two files at a time."""

    def make(rows, schema, parts=4):
        folder = tmp_path / "feed"
        step = -(-len(rows) // parts)
        for i in range(parts):
            part = spark.createDataFrame(rows[i * step:(i + 1) * step], schema)
            part.coalesce(1).write.mode("append").parquet(str(folder))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
        return spark.read.schema(schema).parquet(str(folder)), stream

    return make


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_debounce(feed):
    rnd = random.Random(1)
    rows = sorted((rnd.randint(0, 3000), i, rnd.choice("ab")) for i in range(200))
    batch, stream = feed(rows, "ts long, id long, k string")
    same(ss.run_to_table(ss.debounce(stream, "k", "ts", 50, 0, "id"), "t"),
         st.debounce(batch, "k", "ts", 50, 0, "id"))


def test_machine(feed):
    rnd = random.Random(2)
    rows = [(i, rnd.choice("ab"), rnd.choice(["continued", "paused", "servo_at_position"])) for i in range(90)]
    batch, stream = feed(rows, "seq long, k string, event string")
    same(ss.run_to_table(ss.state_machine(stream, "k", "seq", "event"), "t"),
         st.state_machine(batch, "k", "seq", "event"))


def test_lines(feed):
    rnd = random.Random(3)
    rows = [(i, rnd.choice("ab"), rnd.choice("xyz\b\n")) for i in range(150)]
    batch, stream = feed(rows, "seq long, k string, ch string")
    same(ss.run_to_table(ss.assemble_lines(stream, "k", "seq", "ch", 4), "t"),
         st.assemble_lines(batch, "k", "seq", "ch", 4))


def test_frames(feed):
    values = [-1, 1, 2, -2, -3, 7, -4, 5, 6, 7, -2, -1, -1, 4, 4, 4, 4, -2]
    batch, stream = feed([(i, "c", v) for i, v in enumerate(values)], "seq long, k string, v long")
    need = {-2: 3, -4: 0}
    got = ss.run_to_table(ss.frames(stream, "k", "seq", "v", min_samples=need), "t")
    arrays = st.frame_arrays(st.frames(batch, "k", "seq", "v", min_samples=need), "k", "v")
    same(got.select("frame_id", "samples"), arrays.select("frame_id", "samples"))


def test_final_report_and_collect(feed):
    rows = [(t, "q", d) for t, d in [(1, 0), (5, 2), (11, 1), (14, 0), (15, 0)]]
    batch, stream = feed(rows, "ts long, k string, depth long")
    got = ss.run_to_table(ss.final_report(stream, "k", "ts", "depth", 10), "t").collect()
    assert [r["ts"] for r in got] == [14]
    assert st.final_report(batch, "ts", "depth", 10, "k").first()["report_ts"] == 14
    same(ss.run_to_table(ss.collect_n(stream, "k", "ts", 3), "t"), st.collect_n(batch, "k", "ts", 3))


def test_totals_and_windows(spark, feed):
    rows = [(f"2024-01-01 00:00:{s:02d}", s % 3, s) for s in range(50)]
    batch, stream = feed(rows, "ts string, server long, took long")
    same(ss.run_updates(ss.running_totals(stream, "server", "took"), "server", "t"),
         ss.running_totals(batch, "server", "took"))
    timed = [d.withColumn("ts", F.col("ts").cast("timestamp")) for d in (batch, stream)]
    want = ss.periodic_metrics(timed[0], "ts", "3 seconds", "1 second", n=F.count(F.lit(1)))
    got = ss.run_to_table(ss.periodic_metrics(timed[1], "ts", "3 seconds", "1 second", n=F.count(F.lit(1))), "t")
    same(got, want)
    assert got.late_rows == 0


def test_late_rows_are_counted(spark, feed):
    rows = [("2024-01-01 00:00:50", 1), ("2024-01-01 00:00:01", 2)]
    _, stream = feed(rows, "ts string, n long", parts=2)
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    one = ss.run_to_table(ss.periodic_metrics(timed, "ts", "3 seconds", "1 second", n=F.count(F.lit(1))), "t")
    assert one.count() + one.late_rows == 2


def test_unordered_files_one_per_batch(spark, feed):
    rnd = random.Random(8)
    rows = [(rnd.randint(0, 9000), i, rnd.choice("abc"), rnd.choice(["continued", "paused", "servo_at_position"]))
            for i in range(400)]
    rnd.shuffle(rows)
    batch, stream = feed(rows, "ts long, id long, k string, event string")
    order = ["ts", "id"]
    same(ss.run_to_table(ss.debounce(stream, "k", "ts", 300, 0, "id"), "t"), st.debounce(batch, "k", "ts", 300, 0, "id"))
    same(ss.run_to_table(ss.state_machine(stream, "k", order, "event"), "t"), st.state_machine(batch, "k", order, "event"))
    same(ss.run_to_table(ss.collect_n(stream, "k", order, 7), "t"), st.collect_n(batch, "k", order, 7))


def test_report_by_timer(feed):
    rows = [(3, "q", 1), (8, "q", 0), (9, "p", 1)]
    _, stream = feed(rows, "ts long, k string, depth long", parts=2)
    got = ss.run_to_table(ss.final_report(stream, "k", "ts", "depth", 10), "t").collect()
    assert [(r["k"], r["ts"]) for r in got] == [("q", 10)]


def test_table_as_folder(spark, tmp_path):
    spark.range(40).repartition(4).write.parquet(str(tmp_path / "t.parquet"))
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "u.parquet"))
    for name, n in (("t", 40), ("u", 5)):
        stream = ss.table_stream(spark, str(tmp_path), name, spark.range(1).schema)
        assert ss.run_to_table(stream, "t").count() == n


def test_a_large_key_is_cut_and_waits_in_no_state(spark, feed, monkeypatch):
    """With rows in any order no key's rows meet in a state, and a key over the limit is cut."""
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 9000), i, "a" if i % 3 else rnd.choice("bc"), rnd.choice([-1, -2, -3, -4, 1, 2, 3, None]),
             rnd.choice("xyz\b\n"), rnd.choice(["continued", "paused", None]), rnd.randint(0, 2)) for i in range(400)]
    rows.append((None, 400, "a", 1, "x", "paused", 0))
    rnd.shuffle(rows)
    batch, stream = feed(rows, "ts long, id long, k string, v long, ch string, event string, depth long")
    batch, order, cut = batch.filter("ts is not null"), ["ts", "id"], []
    real = folds.segmented
    monkeypatch.setattr(folds, "segmented", lambda *a: cut.append(1) or real(*a))
    spark.conf.set("pulsegrid.window.maxRows", "30")
    try:
        for one, want in (
                (ss.debounce(stream, "k", "ts", 300, 0, "id"), st.debounce(batch, "k", "ts", 300, 0, "id")),
                (ss.state_machine(stream, "k", order, "event"), st.state_machine(batch, "k", order, "event")),
                (ss.assemble_lines(stream, "k", order, "ch", 4), st.assemble_lines(batch, "k", order, "ch", 4))):
            cut.clear()
            got = ss.run_to_table(one, "t")
            assert cut and got.late_rows == 0 and got.dtypes == one.dtypes
            same(got, want)
        same(ss.run_to_table(ss.collect_n(stream, "k", order, 7), "t"), st.collect_n(batch, "k", order, 7))
        got = ss.run_to_table(ss.final_report(stream, "k", "ts", "depth", 4000, "id"), "t")
        want = st.final_report(batch, "ts", "depth", 4000, "k", "id").withColumnRenamed("report_ts", "ts")
        same(got, want)
        one = ss.frames(stream, "k", order, "v", min_samples={-2: 2, -4: 0})
        got = ss.run_to_table(one, "t")
        assert got.dtypes == one.dtypes
        fold, sent = ss.FrameFold("v", (-1, -3), (-2, -4), {-2: 2, -4: 0}), []
        for k in "abc":
            values = [r[3] for r in sorted(r for r in rows if r[0] is not None and r[2] == k)]
            _, extra, _ = fold.walk([pa.array(values, pa.int64())], np.zeros(1, int), [fold.initial()])
            sent += [(k, *x) for x in zip(*extra)]
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, sent)) and any(not x[3] for x in sent)
    finally:
        spark.conf.unset("pulsegrid.window.maxRows")


def test_an_empty_feed(spark, tmp_path):
    spark.createDataFrame([], "ts long, k string, event string").write.parquet(str(tmp_path / "none"))
    stream = spark.readStream.schema("ts long, k string, event string").parquet(str(tmp_path / "none"))
    assert ss.run_to_table(ss.state_machine(stream, "k", "ts", "event"), "t").count() == 0


def test_two_million_rows_of_a_key_wait(spark, tmp_path):
    """All rows of a hot key lie within the lateness and come in any order; they wait in chunks, a part is handled at a time."""
    folder = str(tmp_path / "hot")
    n = 2_000_000
    spark.range(n).select(((F.col("id") * 7919) % n).alias("ts"), F.lit("hot").alias("k")).repartition(2).write.parquet(folder)
    live = spark.readStream.schema("ts long, k string").option("maxFilesPerTrigger", 1).parquet(folder)
    got = ss.run_to_table(ss.debounce(live, "k", "ts", 1000, 0, lateness=n), "t")
    assert [r["ts"] for r in got.orderBy("ts").collect()] == list(range(1000, n, 1000)) and got.late_rows == 0


def test_waiting_rows_are_kept_exactly(feed):
    """Null keys, repeated times, whole numbers beyond 2**53 beside nulls, and more chunks than one."""
    rnd = random.Random(5)
    rows = [(i // 2, rnd.choice(["a", None]), rnd.choice([2**60 + i, None, -2, -1])) for i in range(120)]
    batch, stream = feed(rows, "seq long, k string, v long")
    old, ss.CHUNK = ss.CHUNK, 3
    try:
        live = ss.run_to_table(ss.collect_n(stream, "k", ["seq", "v"], 20, lateness=40), "t")
        assert live.late_rows == 0
        same(live, st.collect_n(batch, "k", ["seq", "v"], 20))
    finally:
        ss.CHUNK = old


def test_a_report_at_closing_time_waits_for_earlier_rows(feed):
    """A queue that is empty at closing time reports then, but not while rows before it still wait."""
    rows = [(1, "q", 0), (3, "q", 2), (90, "q", 1), (12, "q", 0), (95, "q", 0), (5, None, 0), (400, "z", 1), (2000, "z", 0)]
    batch, stream = feed(rows, "ts long, k string, depth long", parts=8)
    live = ss.run_to_table(ss.final_report(stream, "k", "ts", "depth", 50, lateness=100), "t")
    assert live.late_rows == 0
    want = st.final_report(batch, "ts", "depth", 50, "k").withColumnRenamed("report_ts", "ts")
    assert {tuple(r) for r in live.collect()} == {tuple(r) for r in want.select("k", "ts").collect() if r["ts"] is not None}


@pytest.mark.parametrize("buckets", ["1", "7"])
def test_many_keys_share_a_bucket(spark, feed, buckets):
    """A bucket is one row group of the state: a key's fold goes on from part to part whatever keys are beside it."""
    rnd = random.Random(6)
    rows = [(i, i % 5, rnd.choice(["a", "b", None, "c"]), rnd.choice([-1, -2, -3, -4, 1, 2, 3, None]),
             rnd.choice("xyz\b\n"), rnd.choice(["continued", "paused", None])) for i in range(300)]
    batch, stream = feed(rows, "ts long, id long, k string, v long, ch string, event string")
    order, late = ["ts", "id"], 100
    spark.conf.set(ss.BUCKETS, buckets)
    try:
        for live, want in (
                (ss.debounce(stream, "k", "ts", 9, 0, "id", late), st.debounce(batch, "k", "ts", 9, 0, "id")),
                (ss.state_machine(stream, "k", order, "event", lateness=late), st.state_machine(batch, "k", order, "event")),
                (ss.assemble_lines(stream, "k", order, "ch", 4, late), st.assemble_lines(batch, "k", order, "ch", 4)),
                (ss.collect_n(stream, "k", order, 7, late), st.collect_n(batch, "k", order, 7))):
            got = ss.run_to_table(live, "t")
            assert got.late_rows == 0
            same(got, want)
        got = ss.run_to_table(ss.frames(stream, "k", order, "v", min_samples={-2: 2, -4: 0}, lateness=late), "t")
        same(got, ss.run_to_table(ss.frames(stream, "k", order, "v", min_samples={-2: 2, -4: 0}), "t"))
    finally:
        spark.conf.unset(ss.BUCKETS)


def test_a_report_keeps_no_rows_and_takes_them_in_any_order(spark, feed):
    rnd = random.Random(4)
    rows = [(rnd.randint(0, 900), i, rnd.choice("pq"), rnd.choice([0, 0, 1, 2])) for i in range(300)]
    rows += [(950, 300, "late", 2), (20, 301, "open", 1), (960, 302, "none", 1), (990, 303, "none", 0)]
    batch, stream = feed(rows, "ts long, id long, k string, depth long")
    got = ss.run_to_table(ss.final_report(stream, "k", "ts", "depth", 450, "id", lateness=1000), "t")
    same(got, st.final_report(batch, "ts", "depth", 450, "k", "id").withColumnRenamed("report_ts", "ts"))


def test_a_slice_of_a_feed_is_few_micro_batches(spark):
    """A feed of many small files comes in as many micro-batches as one of few files."""
    from pulsegrid.queries import states

    rows = spark.range(0, 6000, 1, 40).select("id")
    live, late = states.feed(rows, "id")
    seen = []
    ss.each_batch(live, lambda batch, number: seen.append(batch.count()))
    assert sum(seen) == 6000 and states.SLICES <= len(seen) <= 4 * states.SLICES and late == 1000
