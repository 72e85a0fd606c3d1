"""Token counts, substrings, Jaccard groups, decontamination: against plain versions on hostile tables."""

import gc
import glob
import hashlib
import os
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import decontaminate, jaccard, substrings, tokens
from pulsegrid.llm.registry import RANKS
from pulsegrid.session import workspace

from .data import FOLDER, groups, hits, hostile, none, prose, shingles, without


def plain(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# ----------------------------------------------------------------------------- tokens


def brute_tokens(text, rule):
    """Tokens of every line, token by token."""
    enc = tokens.Encoder(tokens.load(RANKS), tokens.PATTERN).encoding
    lines = [x for x in text.encode().split(b"\n")]
    lines = [x + b"\n" for x in lines[:-1]] + ([lines[-1]] if lines[-1] else [])
    stops = np.cumsum([len(x) for x in lines])
    got, crossing, at = [0.0] * len(lines), [0] * len(lines), 0
    for t in enc.encode_ordinary(text):
        size = len(enc.decode_single_token_bytes(t))
        parts = {}
        for p in range(at, at + size):
            line = int(np.searchsorted(stops, p, side="right"))
            parts[line] = parts.get(line, 0) + 1
        at += size
        if rule == "share":
            for line, n in parts.items():
                got[line] += n / size
        else:
            got[min(parts) if rule == "first" else max(parts, key=lambda x: (parts[x], -x))] += 1
        if len(parts) > 1:
            for line in parts:
                crossing[line] += 1
    return got, crossing


@pytest.mark.parametrize("rule", tokens.RULES)
def test_tokens_of_lines(spark, rule):
    text = "a b\n\n\n\n  c d e\n日本\n \n" + prose(1, 30) + "\n\nend"
    df = spark.createDataFrame([(1, text), (2, ""), (3, None), (None, "x\n")], "doc_id long, text string")
    got = tokens.attributed(df, tokens.load(RANKS), rule=rule).collect()
    want, crossing = brute_tokens(text, rule)
    mine = sorted(((int(r["section"]), r["n_tokens"], r["n_crossing"]) for r in got if r["doc_id"] == 1))
    assert [c for _, _, c in mine] == crossing
    assert np.allclose([t for _, t, _ in mine], want)
    assert sum(crossing) > 0 and {r["doc_id"] for r in got} == {1, None}


def test_tokens_of_fields_and_outside(spark):
    df = spark.createDataFrame([(1, "hello there", None, "friend")], "k int, a string, b string, c string")
    joined = tokens.joined_fields(df, "k", ["a", "b", "c"])
    assert joined.first()["text"] == "hello there\nfriend"
    got = {r["section"]: r for r in tokens.attributed(joined, tokens.load(RANKS), "k", sections="sections").collect()}
    assert set(got) == {"a", "c", None} and got["a"]["n_bytes"] == 11 and got[None]["n_tokens"] == 1


def test_line_sections_are_the_default(spark):
    df = hostile(spark).where("length(text) < 5000").withColumn("s", tokens.line_sections(F.col("text")))
    ranks = tokens.load(RANKS)
    with_column = tokens.attributed(df, ranks, sections="s").where("n_bytes > 0").collect()
    assert sorted(map(str, with_column)) == sorted(map(str, tokens.attributed(df, ranks).collect()))


def test_tokens_of_nothing(spark):
    assert tokens.attributed(none(spark), tokens.load(RANKS)).count() == 0
    with pytest.raises(ValueError):
        tokens.attributed(none(spark), b"", rule="odd")


# ----------------------------------------------------------------------------- substrings


@pytest.mark.parametrize("frequent", [None, 2])
def test_substrings(spark, monkeypatch, frequent):
    if frequent:  # every shared anchor's strings travel alone, few are sorted at a time
        monkeypatch.setattr(substrings, "FREQUENT", frequent)
        monkeypatch.setattr(substrings, "SHARE", 0)
        monkeypatch.setattr(substrings, "SORTED_BYTES", 500)
    a = prose(1, 120)
    extra = [(20, "new start " + a[100:400] + " other end " + a[500:549]), (21, a[500:550] + "!"), (22, "z" * 300),
             (23, "z" * 49), (24, "z" * 50), (25, a[:60] * 3), (0, a[300:360])]
    df = hostile(spark, extra).where("length(text) < 5000 or text is null")
    got = substrings.without_repeats(df).collect()
    want = without(plain(df))
    assert sorted(((r["doc_id"] or -1, bytes(r["kept"]), r["n_spans"]) for r in got)) == sorted(
        ((i or -1, k, n) for i, k, n in want))
    for r in got:
        assert r["kept_sha256"] == hashlib.sha256(r["kept"]).hexdigest()
        assert r["n_bytes"] - r["n_removed"] == len(r["kept"])
    assert any(r["n_removed"] for r in got)


def test_buckets_are_equal_strings():
    data = np.frombuffer((b"abcabcab" * 30 + b"xyz") * 2, np.uint8)
    for depth in (1, 7, 8, 20, 50):
        bucket = substrings.refine(data, depth)
        seen = {}
        for p in range(len(data) - depth + 1):
            assert seen.setdefault(data[p:p + depth].tobytes(), bucket[p]) == bucket[p]
        assert len(set(seen.values())) == len(seen)


def test_substrings_of_long_texts_and_nothing(spark):
    long = prose(2, 30_000)
    df = spark.createDataFrame([(1, long), (2, "x" * 600_000), (3, "x" * 300_000 + long[1000:5000])], "doc_id long, text string")
    got = {r["doc_id"]: r for r in substrings.without_repeats(df).collect()}
    assert [got[i]["n_removed"] for i in (1, 2, 3)] == [0, 0, 304_000]
    assert substrings.without_repeats(none(spark)).count() == 0


def test_prints_of_rows():
    rng = np.random.default_rng(5)
    value = [np.sort(rng.integers(0, 1 << bits, size, dtype=np.uint64)) for bits, size in ((40, 50), (63, 3), (5, 0), (5, 90), (1, 4))]
    row = np.repeat(np.arange(5), [len(x) for x in value])
    back = substrings.unpacked(substrings.packed(np.concatenate(value), row, 5))
    assert np.array_equal(back[0], np.concatenate(value)) and np.array_equal(back[1], row)
    assert [len(x) for x in substrings.unpacked(substrings.packed(np.zeros(0, np.uint64), np.zeros(0, np.int64), 0))] == [0, 0]


def test_prints_that_several_documents_have():
    held = {7: [1, 4, 9, 9, 30], 8: [2, 4, 9, 50, 50, 50], 9: [5, 50], 10: [6]}  # twice: several documents, thrice: frequent
    row = np.repeat(np.arange(4), [len(x) for x in held.values()])
    prints = substrings.packed(np.concatenate([np.array(x, np.uint64) for x in held.values()]), row, 4)
    got = substrings.agreed(pa.table({"bucket": [0] * 4, "group": list(held), "prints": prints}))
    value, of = substrings.unpacked(got["shared"].combine_chunks())
    assert {g: value[of == k].tolist() for k, g in enumerate(got["group"].to_pylist())} == {7: [4, 9], 8: [4, 9, 50, 50], 9: [50, 50]}


def shuffled(df):
    """Bytes that the last run of ``df`` has written for its exchanges."""
    done, total, open_ = set(), 0, [df._jdf.queryExecution().executedPlan()]
    while open_:
        node = open_.pop()
        kind = node.getClass().getSimpleName()
        below = (node.executedPlan() if kind == "AdaptiveSparkPlanExec" else node.plan() if kind.endswith("QueryStageExec") else
                 None if kind == "ReusedExchangeExec" else node)
        if below is None:
            continue
        if below is not node:
            open_.append(below)
        elif node.id() not in done:
            done.add(node.id())
            if kind == "ShuffleExchangeExec":
                total += node.metrics().apply("shuffleBytesWritten").value()
            open_.extend(node.children().apply(k) for k in range(node.children().size()))
    return total


def test_anchors_of_one_document_do_not_travel(spark):
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(33, 127, 4000, dtype=np.uint8)).decode() for _ in range(500)]
    texts[400] = texts[400][:1000] + texts[7][2000:2300] + texts[400][1000:]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = substrings.without_repeats(df)
    assert {r["doc_id"]: r["n_removed"] for r in out.collect() if r["n_removed"]} == {400: 300}
    assert shuffled(out) < 1.5 * sum(map(len, texts))


def test_rows_that_are_alike_and_long_texts_in_one_group(spark):
    long = prose(8, 60_000)
    rows = [(3, long)] * 4 + [(3, long[:500])] + [(1, long[70_000:90_000]), (None, long), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = substrings.without_repeats(df).collect()
    want = without(plain(df))
    assert sorted((r["doc_id"] or -1, bytes(r["kept"]), r["n_spans"]) for r in got) == sorted((i or -1, k, n) for i, k, n in want)


# ----------------------------------------------------------------------------- Jaccard groups


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80), (1, 50), (2, 100)])
def test_groups(spark, n, percent):
    base = prose(7, 100).split()
    extra = []
    for k in range(30):  # a chain of copies that drift apart
        base[3 * k % 100] = f"drift{k}"
        extra.append((100 + k, " ".join(base)))
    extra += [(200 + k, prose(8, 20) + " " + prose(300 + k, 3 + k)) for k in range(20)]
    df = hostile(spark, extra)
    got = jaccard.jaccard_groups(df, n=n, percent=percent).collect()
    docs = plain(df)
    want = groups(docs, n, percent)
    assert len(got) == len(docs)
    for r in got:
        assert r["component_id"] == want.get(r["doc_id"])
    assert sorted((r["doc_id"] or -1, r["n_shingles"]) for r in got) == sorted((i or -1, len(shingles(t, n))) for i, t in docs)


def test_groups_of_nothing(spark):
    assert jaccard.jaccard_groups(none(spark)).count() == 0


def test_groups_of_copies_under_keys_of_several_texts(spark):
    extra = [(20 + k, prose(40, 80)) for k in range(20)] + [(60 + k, prose(40, 80) + f" end{k}") for k in range(5)]
    df = hostile(spark, [*extra, (20, prose(41, 80)), (70, prose(41, 80)), (61, prose(41, 80))])
    got = jaccard.jaccard_groups(df, n=5, percent=80).collect()
    want = groups(plain(df), 5, 80)
    assert sorted((r["doc_id"], r["component_id"]) for r in got if r["doc_id"] is not None) == sorted(
        (i, want[i]) for i, _ in plain(df) if i is not None)
    assert want[70] == want[64] == 20 == want[39]


def test_lists_hold_a_set_once():
    at = [jaccard.packed(50, 3, flags) for flags in (0, 0, jaccard.KNOWN, 0, 0, jaccard.KNOWN, 0, 0)]
    rows = list(zip([1, 1, 1, 2, 2, 3, 4, 4], [7, 7, 7, 7, 7, 8, 8, 9], at))
    for cut in range(len(rows) + 1):
        parts = [pa.RecordBatch.from_pylist([dict(zip(("list", "doc", "at"), r)) for r in x], pa.schema(
            [(c, pa.int64()) for c in ("list", "doc", "at")])) for x in (rows[:cut], rows[cut:])]
        out = [tuple(r.values()) for b in jaccard._shared(parts) for r in b.to_pylist()]
        # copies of one set alone (list 2) don't make a list; what shares it elsewhere (KNOWN) does
        assert out == [(1, 7, 50, 3), (3, 8, 50, 3), (4, 8, 50, 3), (4, 9, 50, 3)]


def disk(spark):
    """Bytes of shuffle files, and of intermediate sets."""
    shuffled = [p for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
                for p in glob.glob(f"{d}/*/shuffle_*.data")]
    held = glob.glob(workspace(spark, "x").removeprefix("file:").rpartition("/")[0] + "/sets-*/*.parquet")
    return tuple(sum(os.path.getsize(p) for p in x if os.path.exists(p)) for x in (shuffled, held))


def test_groups_leave_little_on_disk(spark):
    texts = [(2 * k + j, prose(1000 + k, 400) + f" end{j}") for k in range(300) for j in range(2)]
    size = sum(len(t) for _, t in texts)
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    gc.collect()
    before = disk(spark)
    got = jaccard.jaccard_groups(df, n=5, percent=80)
    time.sleep(2)  # files go in the background
    after = disk(spark)
    assert after[0] - before[0] < 0.2 * size and after[1] - before[1] < size
    assert got.where("component_id = doc_id - doc_id % 2").count() == len(texts)


def test_levels_leave_no_pair_out():
    for percent in (50, 80, 90, 100):
        begin, differ, blocks = jaccard.levels(percent, 400)
        for a in range(1, 300):
            for b in range(a, a * 100 // percent + 1):
                x, y = (int(np.searchsorted(begin, v, side="right")) - 1 for v in (a, b))
                assert y - x <= 1 and (a + b) * (100 - percent) // (100 + percent) <= differ[x] < blocks[x]


# ----------------------------------------------------------------------------- decontamination


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, doc int, window string")


ITEMS = [(1, prose(1, 120)[200:500], 1, None), (2, "one", None, ""), (3, "a b c", 1, "x"), (4, None, 1, "x"), (5, "", 1, "x"),
         (None, prose(3, 40), 1, "x"), (6, prose(2, 30_000)[4000:4400], 1, "x"), (6, "other " + prose(4, 12), 1, "x"),
         (7, "ΑΣ Β", 1, "x"), (8, prose(1, 120)[200:500], 1, "x")]


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_contamination(spark, broadcast_rows):
    df = hostile(spark, [(30, "A, b; C. d"), (31, "b c a b"), (32, "xéone")])
    got = decontaminate.contaminated(df, bench(spark, ITEMS), broadcast_rows=broadcast_rows).collect()
    want = sorted((str(i), *hits(t, [x[:2] for x in ITEMS])) for i, t in plain(df))
    sha = lambda items: hashlib.sha256(",".join(items).encode()).hexdigest()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
                  for r in got) == sorted((i, w, h, len(x), sha(x), h > 0) for i, w, h, x in want)
    assert sum(r["contaminated"] for r in got) >= 6
    kept = decontaminate.clean(df, bench(spark, ITEMS))
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(i for i, _, h, _ in want if not h)


def test_contamination_of_and_by_nothing(spark):
    items = bench(spark, ITEMS)
    assert decontaminate.contaminated(none(spark), items).count() == 0
    df = hostile(spark)
    assert not any(r["contaminated"] for r in decontaminate.contaminated(df, items.limit(0)).collect())
    assert decontaminate.clean(df, items.limit(0)).count() == df.count()


def test_native_plan(spark):
    read = lambda t: spark.read.parquet(f"{FOLDER}/{t}.parquet")
    text = decontaminate.contaminated(read("documents"), read("benchmark"))._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text
