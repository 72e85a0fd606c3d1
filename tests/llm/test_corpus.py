"""Language-model scores, hard negatives and source divergence on hostile rows, against plain versions."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import automaton, divergence, negatives

from .data import hostile, none, prose

LETTERS = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lowered(text):
    return (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))


# ------------------------------------------------------------------ language model


def plain_model(texts, order, mass):
    """Counts of n-grams, tokens, and p(last token of an n-gram | the others) by recursion."""
    counts = Counter(w[max(0, i - k + 1):i + 1] for w in texts for i in range(len(w)) for k in range(1, min(order, i + 1) + 1))
    words = {g for g in counts if len(g) == 1 and g != (b"<",)}
    n, v = sum(counts[g] for g in words), len(words)

    def p(gram):
        if len(gram) == 1:
            return (counts[gram] + 1) / (n + v + 1)
        return (counts[gram] + mass * p(gram[1:])) / (counts[gram[:-1]] + mass)

    return counts, n, p


def plain_scores(rows, learns, order, mass):
    """(tokens, known, base, score) of each text."""
    texts = [(b"<", *lowered(t).split(), b">") for t in rows]
    counts, n, p = plain_model([w for w, held in zip(texts, learns) if held], order, mass)
    return n, [(len(w) - 1, sum(counts[(x,)] > 0 for x in w[1:]), sum(math.log10(p((x,))) for x in w[1:]),
                sum(math.log10(p(w[max(0, i - order + 1):i + 1])) for i in range(1, len(w)))) for w in texts]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_of_hostile_rows(spark, order):
    docs = hostile(spark, [(100 + i, prose(i % 5, 20 + i)) for i in range(20)] + [(200, " ".join(["one"] * 700))])
    learns = F.col("doc_id") % 3 != 0
    got = automaton.scored(docs.withColumn("label", F.lit(1)), learns, order=order, mass=5.0, part_bytes=50_000, slice_grams=9_000)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    n, want = plain_scores([t for _, t in rows], [i is not None and i % 3 != 0 for i, _ in rows], order, 5.0)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 5), round(r.score, 5), r.train_tokens)
                 for r in got.collect())
    want = sorted((i is None, i or 0, *w[:2], round(w[2], 5), round(w[3], 5), n) for (i, _), w in zip(rows, want))
    assert got == want


def test_weights_of_a_state_sum_to_one(spark):
    """Every context's probabilities, the unknown word included; the operator gives the same ones."""
    train = ["a b a c", "b b a", "", "a b b c d a b"]
    _, _, p = plain_model([(b"<", *t.encode().split(), b">") for t in train], 3, 2.0)
    tokens = [b"a", b"b", b"c", b"d", b">", b"unknown"]
    for context in [(), (b"a",), (b"<",), (b"a", b"b"), (b"<", b"a"), (b"d", b"d"), (b"unknown", b"b")]:
        assert sum(p((*context, w)) for w in tokens) == pytest.approx(1)
    asked = train + ["a b a", "a b unknown", "d d d", "unknown b c"]
    docs = spark.createDataFrame([(i, t, i < 4) for i, t in enumerate(asked)], "doc_id long, text string, t boolean")
    score = {r.doc_id: r.score for r in automaton.scored(docs, F.col("t"), mass=2.0).collect()}
    _, want = plain_scores(asked, [i < 4 for i in range(8)], 3, 2.0)
    assert [score[i] for i in range(8)] == pytest.approx([w[3] for w in want])


def test_scores_without_rows_or_learning(spark):
    assert automaton.scored(none(spark), F.lit(True)).collect() == []
    rows = automaton.scored(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), F.lit(None).cast("boolean")).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.score, r.train_tokens) for r in rows) == [(1, 3, 0, 0.0, 0), (2, 1, 0, 0.0, 0)]


def test_held_out_documents_gain_from_the_model(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{(i + k * k) % 13} x{(i + k * k) % 13}" for k in range(200))) for i in range(40)],
                                 "doc_id long, text string")
    rows = automaton.scored(docs, F.col("doc_id") % 4 != 0).where("doc_id % 4 = 0").collect()
    assert rows and all(r.score > r.base_score for r in rows)


# ------------------------------------------------------------------ hard negatives


def plain_negatives(rows, positives=5, negatives=10):
    vectors = {}
    for key, vector, label in rows:
        if key is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        row = (str(label), [math.floor(256 * x) for x in vector])
        vectors[key] = min(vectors.get(key, row), row)
    out = []
    for a, (label, v) in vectors.items():
        if a % 100:
            continue
        score = {k: sum(x * y for x, y in zip(v, w)) for k, (_, w) in vectors.items()}
        same = sorted((-score[k], k) for k, (x, _) in vectors.items() if x == label and k != a)[:positives]
        for s, p in same:
            s = -s
            rest = sorted((-score[k], k) for k, (x, _) in vectors.items()
                          if x != label and 30 * s <= 100 * score[k] <= 90 * s)[:negatives]
            out += [(a, p, rank, k, s, -t) for rank, (t, k) in enumerate(rest, 1)]
    return sorted(out)


def rows_of_vectors(n, dim=24, seed=3):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    rows = [(i, [c + r.gauss(0, .7) for c in centres[r.randrange(6)]], r.randrange(4)) for i in range(n)]
    rows += [(n + i, rows[7][1], i % 3) for i in range(60)]  # one very common vector
    rows += [(700, None, 1), (701, [], 1), (702, [None] * dim, 2), (703, [float("nan")] * dim, 1), (704, [float("inf")] * dim, 1),
             (None, rows[0][1], 1), (705, rows[0][1], None), (800, [0.0] * dim, 1), (900, [-x for x in rows[0][1]], 0),
             (5, rows[9][1], 3), (5, rows[9][1], 3), (901, rows[3][1][:5], 2), (1000, [1e-9] * dim, 3)]
    return rows


@pytest.mark.parametrize("block,group", [(20_000, 1_000), (60, 2)])
def test_negatives_of_hostile_rows(spark, block, group):
    rows = rows_of_vectors(500)
    table = spark.createDataFrame([(*r, 1, "x", 0) for r in rows],
                                  "vec_id long, embedding array<double>, label int, score int, id string, block int").repartition(4)
    got = negatives.hard_negatives(table, lambda key: key % 100 == 0, block_rows=block, group_queries=group)
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows)


def test_negatives_of_an_empty_table(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert negatives.hard_negatives(table, lambda key: key % 100 == 0).collect() == []


def test_lists_lose_no_row_above_their_threshold():
    r = np.random.default_rng(5)
    for scale in (0.2, 1.0, 5.0):
        vectors = np.floor(r.standard_normal((300, 19)) * 40 * scale * r.random(19)).astype(np.int64)
        lists = negatives.Lists(vectors, np.arange(300), np.zeros(300))
        query = vectors[0]
        rest = negatives.suffix_norms(query[None])[0]
        scores = vectors @ query
        for level in (0.9, 0.5, 0.2, 0.0):
            lists.enter(level * lists.largest)
            least = math.ceil(level * lists.largest * rest[0])
            found = lists.reach(query, rest, lists.rows[0], least)
            assert set(np.flatnonzero(scores >= least)) <= set(found)
        lists.enter(0.5 * lists.largest)
        assert sum(map(len, lists.rows)) < vectors.size / 2  # what the bound covers has no entries


# ------------------------------------------------------------------ source divergence


def plain_audit(rows, least, top=50):
    docs = [(a or "", b or "", LETTERS.findall(lowered(t))) for a, b, t in rows]
    held, counts, groups = Counter(), defaultdict(Counter), defaultdict(set)
    for lang, source, words in docs:
        groups[lang].add(source)
        held.update((lang, w) for w in set(words))
        counts[lang, source].update(words)
    out = []
    for lang, sources in groups.items():
        kept = sorted(w for a, w in held if a == lang and held[a, w] >= least)

        def shares(count):
            total = sum(count[w] for w in kept) + 5 * len(kept)
            return {w: 1 + 10**9 * (count[w] + 5) // total for w in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = sorted((-sum(abs(p[s][w] - p[o][w]) for w in kept), o.encode()) for o in sources if o != s)
            over = sorted((q[w] - p[s][w], w) for w in kept if counts[lang, s][w] and p[s][w] > q[w])[:top]
            for part, found in (("pair", pairs), ("term", over)):
                out += [(lang, s, part, item.decode(), -f, rank) for rank, (f, item) in enumerate(found, 1)]
    return sorted(out)


def audited_rows():
    r = random.Random(8)
    words = "alpha Beta gamma δέλτα épsilon zeta ß日本 theta".split()
    rows = [(r.choice(["en", "de", None]), r.choice([None, "", "a", "b", "ü", "z1"]), " ".join(
        r.choice(words) + r.choice(["", ",", "1x", "_"]) for _ in range(r.randrange(60)))) for _ in range(300)]
    return rows + [("en", "empty", None), ("fr", "only", ""), ("fr", "other", "  12 \n"), ("it", "one", "uno " * 5),
                   ("en", "long", "x" * 200_000 + " alpha" * 30_000)]


@pytest.mark.parametrize("groups,terms", [(64, 8192), (2, 3)])
def test_divergence_of_hostile_rows(spark, monkeypatch, groups, terms):
    monkeypatch.setattr(divergence, "GROUPS", groups)
    monkeypatch.setattr(divergence, "TERMS", terms)
    rows = audited_rows()
    docs = spark.createDataFrame([(i, *r, 1, "x", 0) for i, r in enumerate(rows)],
                                 "doc_id long, lang string, source string, text string, n int, term string, g int").repartition(3)
    got = divergence.audit(docs, least=20, top=4)
    assert sorted(map(tuple, got.select("lang", "source", "part", "item", "value", "rank").collect())) == plain_audit(rows, 20, 4)


def test_divergence_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence.audit(docs).collect() == []
