"""Stateful operators: small fixtures, and cut keys against whole keys."""

import json
import random
import time

import numpy as np
import pyarrow as pa
import pytest

from pulsegrid.operators import states as st
from pulsegrid.plans import ordered as od


def brute_debounce(rows, gap, start):
    kept, last = [], dict()
    for k, t, i in sorted(rows, key=lambda r: (r[1], r[2])):
        prev = last.get(k, start)
        if prev is None or t - prev >= gap:
            kept.append(i)
            last[k] = t
    return sorted(kept)


def test_debounce_fixture(spark):
    df = spark.createDataFrame([("b", 50), ("b", 150), ("b", 200), ("b", 260)], "k string, ts long")
    got = st.debounce(df, "k", "ts", 100, initial_last=0)
    assert sorted(r["ts"] for r in got.collect()) == [150, 260]


@pytest.mark.parametrize("gap,start", [(7, None), (7, 0), (40, None), (300, 5)])
def test_debounce_cut_equals_brute_force(spark, gap, start):
    rnd = random.Random(gap)
    rows = [("hot" if rnd.random() < .6 else rnd.choice("ab"), rnd.randint(0, 900), i) for i in range(700)]
    df = spark.createDataFrame(rows, "k string, ts long, id long").repartition(3)
    for rows_per_task in (20, 10_000):
        got = st.debounce(df, "k", "ts", gap, start, tie="id", max_rows=rows_per_task)
        assert sorted(r["id"] for r in got.collect()) == brute_debounce(rows, gap, start)


def test_machine_fixture(spark):
    df = spark.createDataFrame([("s", 1, "continued"), ("s", 2, "paused"), ("s", 3, "recipe_restarted"),
                                ("s", 4, "wait_completed")], "k string, seq long, event string")
    got = st.state_machine(df, "k", "seq", "event").orderBy("seq").collect()
    assert [r["to"] for r in got] == ["moving", "paused", "moving", "moving"]
    assert got[0]["from"] == "paused"


def test_machine_cut_equals_whole(spark):
    rnd = random.Random(1)
    events = sorted({e for _, e in st.SERVO_TRANSITIONS}) + ["noise"]
    rows = [(rnd.choice(["hot", "hot", "x"]), i, rnd.choice(events)) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, seq long, event string").repartition(3)
    whole = st.state_machine(df, "k", "seq", "event", split=od.whole("k", "seq"))
    cut = st.state_machine(df, "k", "seq", "event", max_rows=30)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.collect()))


def brute_lines(chars, cap):
    out, typed = [], []
    for c in chars:
        if c in "\r\n":
            out.append("".join(typed))
            typed = []
        elif c == "\b":
            typed = typed[:-1]
        elif len(typed) < cap:
            typed.append(c)
    return out


def test_line_fixture(spark):
    df = spark.createDataFrame([("p", i, c) for i, c in enumerate("ab\bc\n")], "k string, seq long, ch string")
    assert [r["line"] for r in st.assemble_lines(df, "k", "seq", "ch").collect()] == ["ac"]


def test_full_lines_and_nulls_are_counted(spark):
    keys = [*"x" * 100, "\n", "a", None, "\n"]
    df = spark.createDataFrame([("p", i, c) for i, c in enumerate(keys)], "k string, seq long, ch string")
    for rows in (7, None):
        got = st.assemble_lines(df, "k", "seq", "ch", max_rows=rows).orderBy("line_no").collect()
        assert [(len(r["line"]), r["dropped"]) for r in got] == [(80, 20), (1, 1)]


def test_debounce_leaves_out_events_without_time(spark):
    df = spark.createDataFrame([("b", 50), ("b", None), ("b", 260)], "k string, ts long")
    for first in (None, 0):
        got = [r["ts"] for r in st.debounce(df, "k", "ts", 100, first).collect()]
        assert got == ([50, 260] if first is None else [260])


def test_report_at_closing_time(spark):
    df = spark.createDataFrame([("early", 3, 1), ("early", 8, 0), ("late", 9, 1), ("late", 12, 0), ("after", 11, 1),
                                ("never", 2, 1)], "q string, ts long, depth int")
    got = {r["q"]: r["report_ts"] for r in st.final_report(df, "ts", "depth", 10, "q").collect()}
    assert got == {"early": 10, "late": 12, "after": 10}


@pytest.mark.parametrize("eol", [0.0, 0.02, 0.2])
def test_lines_cut_equals_brute_force(spark, eol):
    rnd = random.Random(int(eol * 100))
    text = "".join("\n" if rnd.random() < eol else rnd.choice("abcdé\b\b") for _ in range(500)) + "\r"
    df = spark.createDataFrame([("k", i, c) for i, c in enumerate(text)], "k string, seq long, ch string")
    for rows_per_task in (25, 10_000):
        got = st.assemble_lines(df.repartition(3), "k", "seq", "ch", 10, max_rows=rows_per_task)
        lines = [r["line"] for r in sorted(got.collect(), key=lambda r: r["line_no"])]
        assert lines == brute_lines(text, 10)


@pytest.mark.parametrize("n,sent", [(126, False), (127, True), (128, True)])
def test_frame_limit(spark, n, sent):
    values = [-1, 5, -1] + list(range(n)) + [-2, 9, -3] + [4, 4] + [-4]
    df = spark.createDataFrame([("c", i, v) for i, v in enumerate(values)], "k string, seq long, v int")
    got = st.frames(df, "k", "seq", "v", min_samples={-2: 127, -4: 0}, max_rows=40)
    arrays = st.frame_arrays(got, "k", "v").orderBy("frame_id").collect()
    expect = ([list(range(n))] if sent else []) + [[4, 4]]
    assert [r["samples"] for r in arrays] == expect
    chunks = st.frame_arrays(got, "k", "v", chunk=50).collect()
    assert sum(len(r["samples"]) for r in chunks) == sum(map(len, expect))


def test_cap_first_is_exact(spark):
    rnd = random.Random(2)
    rows = [("hot" if rnd.random() < .7 else "x", i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, seq long").repartition(4)
    got = sorted(map(tuple, st.collect_n(df, "k", "seq", 40).collect()))
    expect = sorted([r for r in rows if r[0] == "hot"][:40] + [r for r in rows if r[0] == "x"][:40])
    assert got == expect


def test_machine_equals_a_plain_loop():
    """Lanes, group starts at every place, unknown and null events."""
    rnd = random.Random(4)
    fold = st.MachineFold("event", st.SERVO_TRANSITIONS, "paused")
    events = [rnd.choice([*fold.events, "noise", None]) for _ in range(1003)]
    for starts in ([0], [0, 1, 2, 15, 16, 17, 500], list(range(0, 1003, 5))):
        states = [rnd.choice(fold.states) for _ in starts]
        rows, (before, after), last = fold.walk([pa.array(events)], np.array(starts), states)
        want, now, begin = [], None, dict(zip(starts, states))
        for i, e in enumerate(events):
            now = begin.get(i, now)
            then = st.SERVO_TRANSITIONS.get((now, e), now)
            want.append((now, then))
            now = then
        assert rows is None and list(zip(before.to_pylist(), after.to_pylist())) == want and last == now
    digest = fold.seal(fold.feed([pa.array(events[400:])], fold.feed([pa.array(events[:400])], fold.blank())))
    for state in fold.states:
        assert fold.step(state, json.loads(json.dumps(digest))) == fold.walk([pa.array(events)], np.zeros(1, int), [state])[2]


@pytest.mark.parametrize("gap", [0, 1, 13, 5000])
def test_debounce_digest_equals_the_walk(gap):
    rnd = random.Random(gap)
    for kind in (int, float):
        fold = st.DebounceFold("t", gap, None)
        times = sorted(kind(rnd.randint(100, 2000)) for _ in range(400))
        parts = [times[:7], times[7:8], times[8:300], times[300:]]
        digest = fold.blank()
        for part in parts:
            digest = fold.feed([pa.array(part + [None])], digest)
        sealed = json.loads(json.dumps(fold.seal(digest)))
        for state in [None, *map(kind, range(-20 - gap, 100, 7)), *map(kind, range(95, 105))]:
            if state is None or state <= times[0]:
                assert fold.step(state, sealed) == fold.walk([pa.array(times)], np.zeros(1, int), [state])[2]


def test_debounce_digest_of_millions_of_events_in_one_gap():
    """Regular events of one gap, and irregular ones over many: small digests, in little time."""
    for gap, times in ((10**9, np.arange(4_000_000)),
                       (50_000, np.cumsum(np.random.default_rng(1).integers(0, 5, 4_000_000)))):
        fold = st.DebounceFold("t", gap, None)
        digest, begun = fold.blank(), time.perf_counter()
        for lo in range(0, len(times), 10_000):
            digest = fold.feed([pa.array(times[lo:lo + 10_000])], digest)
        sealed = fold.seal(digest)
        assert len(json.dumps(sealed)) < 64_000 and time.perf_counter() - begun < 30
        for state in (None, -gap + 3, -5):
            last = state
            for lo in range(0, len(times), 1_000_000):
                last = fold.walk([pa.array(times[lo:lo + 1_000_000])], np.zeros(1, int), [last])[2]
            assert fold.step(state, sealed) == last


@pytest.mark.parametrize("rows_per_task", [3, 10_000])
def test_lines_from_pieces_of_text(spark, rows_per_task):
    """Pieces of any length give the lines that their single characters give."""
    rnd = random.Random(rows_per_task)
    text = "".join(rnd.choice(["ab", "\n", "\b", "\b\b\b", "é日", "x" * 12, "\r\n"]) for _ in range(300)) + "\n"
    cuts = sorted(rnd.sample(range(len(text)), 40))
    pieces = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
    df = spark.createDataFrame([("k", i, c) for i, c in enumerate(pieces)] + [("e", 1, ""), ("e", 2, None), ("e", 3, "\n")],
                               "k string, seq long, ch string").repartition(3)
    got = st.assemble_lines(df, "k", "seq", "ch", 10, max_rows=rows_per_task).collect()
    assert [r["line"] for r in sorted(got, key=lambda r: r["line_no"]) if r["k"] == "k"] == brute_lines(text, 10)
    assert [(r["seq"], r["line"], r["dropped"]) for r in got if r["k"] == "e"] == [(3, "", 1)]


def test_long_texts_are_folded_in_steps(monkeypatch):
    """A batch of long texts goes through in pieces of bounded bytes, with the lines of one piece."""
    from pulsegrid.plans import folds

    texts = ["ab\n" * 50, None, "c" * 900, "\n", "x\b\n" * 40] * 20
    keys = [i // 7 for i in range(len(texts))]
    fold, schema = st.LineFold("ch", 5), pa.schema([("k", pa.int64()), ("line_no", pa.int64()), ("line", pa.string()), ("dropped", pa.int64())])
    batch = pa.RecordBatch.from_pydict({"k": keys, "ch": pa.array(texts, pa.string())})

    def run():
        out = list(folds._walker(fold, ["k"], ["k"], schema, False)(iter([batch.slice(0, 0), batch])))
        return out, pa.Table.from_batches(out).to_pylist()

    whole = run()[1]
    monkeypatch.setattr(folds, "STEP_BYTES", 500)
    out, rows = run()
    assert rows == whole and len(out) > 20
    assert max(len(x) for x in (b.column("line") for b in out)) <= 250
