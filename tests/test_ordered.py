"""The split path of an ordered scan must give what the plain window gives."""

import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.plans import ordered as od


def _rows(seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(900):
        key = "hot" if rnd.random() < 0.5 else rnd.choice(["a", "b", None])
        ts = 7 if rnd.random() < 0.3 else rnd.randint(0, 400)  # heavy ties on ts
        rows.append((key, ts, i, rnd.choice([None, rnd.randint(-5, 5)])))
    return rows


def _specs():
    return dict(
        rn=od.row_number(),
        total=od.running_sum("v"),
        top=od.running_max("v"),
        low=od.running_min("v"),
        held=od.last_value("v"),
        prev=od.lag("v"),
        prev_ts=od.lag("ts", -1),
        nxt=od.lead("v"),
        nxt_ts=od.lead("ts"),
        upcoming=od.next_value("v"),
        most=od.whole_max("v"),
        least=od.whole_min("id"),
    )


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("max_rows", [1, 17, 100])
def test_split_equals_plain(spark, keys, max_rows):
    df = spark.createDataFrame(_rows(3), "k string, ts long, id long, v int").repartition(5)
    plain = od.scan(df, keys, ["ts", "id"], od.whole(keys, ["ts", "id"]), **_specs())
    split = od.measure(df, keys, ["ts", "id"], max_rows)
    assert split.cuts is not None
    cut = od.scan(df, keys, ["ts", "id"], split, **_specs())
    assert cut.columns == plain.columns
    order = lambda r: r["id"]
    assert sorted(cut.collect(), key=order) == sorted(plain.collect(), key=order)


def test_segments_are_bounded_and_ordered(spark):
    df = spark.createDataFrame(_rows(5), "k string, ts long, id long, v int")
    split = od.measure(df, ["k"], ["ts", "id"], 40)
    cut = od.segmented(df, split)
    sizes = cut.filter("k = 'hot'").groupBy("_seg").count().collect()
    assert len(sizes) > 5
    assert max(r["count"] for r in sizes) <= 120
    ends = (
        cut.filter("k = 'hot'").groupBy("_seg")
        .agg(F.min(F.struct("ts", "id")).alias("lo"), F.max(F.struct("ts", "id")).alias("hi"))
        .orderBy("_seg").collect()
    )
    assert all(a["hi"] < b["lo"] for a, b in zip(ends, ends[1:]))


def test_two_step_lookup(spark, monkeypatch):
    """Many cuts per key are found block by block."""
    monkeypatch.setattr(od, "_BLOCK", 4)
    for keys in (["k"], []):
        df = spark.createDataFrame(_rows(7), "k string, ts long, id long, v int")
        split = od.measure(df, keys, ["ts", "id"], 12)
        assert split.most > 16
        got = od.scan(df, keys, ["ts", "id"], split, rn=od.row_number(), nxt=od.lead("v"))
        want = od.scan(df, keys, ["ts", "id"], od.whole(keys, ["ts", "id"]), rn=od.row_number(), nxt=od.lead("v"))
        assert sorted(got.collect(), key=lambda r: r["id"]) == sorted(want.collect(), key=lambda r: r["id"])
        sizes = od.segmented(df, split, "inner").groupBy(*keys, od.SEG).count()
        assert sizes.agg(F.max("count")).first()[0] <= 60


def test_given_sizes(spark):
    df = spark.createDataFrame(_rows(5), "k string, ts long, id long, v int")
    sizes = spark.createDataFrame([("hot", 900), ("a", 3)], "k string, _n long")
    split = od.measure(df, "k", ["ts", "id"], 100, sizes)
    assert [r["_h0"] for r in split.cuts.collect()] == ["hot"]


def test_small_keys_are_left_whole(spark):
    df = spark.createDataFrame(_rows(5), "k string, ts long, id long, v int")
    assert od.measure(df, ["k"], ["ts", "id"], 10_000).cuts is None
