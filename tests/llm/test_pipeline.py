"""The pipeline against plain versions of its stages, each on its own input."""

from collections import Counter

import corpus_pipeline
from pulsegrid.llm import lines, pieces, surrogates
from pulsegrid.llm.registry import SURROGATE_KEY, VOCABULARY
from pulsegrid.llm.tables import saved

from .data import FOLDER, groups, hits, hostile


def rows(df, columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, ins = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        ins[name] = docs
        docs = saved(stage(spark, docs, FOLDER), name)
        assert docs.columns == (columns if name != "token_ids" else ["doc_id", "ids", "n_ids"])
    ins["end"] = docs
    texts = {n: [(r["doc_id"], r["text"]) for r in d.collect()] for n, d in ins.items() if n != "end"}

    model = lines.train(ins["quality"], spark.read.parquet(f"{FOLDER}/labels.parquet"))
    good = {r["doc_id"] for r in lines.scored(ins["quality"], model).collect() if r["score"] >= 0.7}
    assert {i for i, _ in texts["near_copies"]} == good and len(good) < len(texts["quality"])

    first = groups(texts["near_copies"], 5, 80)
    assert {i for i, _ in texts["benchmark_free"]} == set(first.values()) and len(set(first.values())) < len(first)

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    free = {i for i, t in texts["benchmark_free"] if not hits(t, items)[1]}
    assert {i for i, _ in texts["without_pii"]} == free and len(free) < len(texts["benchmark_free"])

    s = surrogates.Surrogates(SURROGATE_KEY)
    want = Counter((i, surrogates.replaced(t, s)[0]) for i, t in texts["without_pii"])
    assert rows(ins["token_ids"], ("doc_id", "text")) == want
    assert all(r["n_chars"] == len(r["text"]) for r in ins["token_ids"].collect())

    codec = pieces.Pieces(pieces.load(VOCABULARY))
    assert Counter((r["doc_id"], codec.decode(r["ids"])) for r in docs.collect()) == want
    assert rows(corpus_pipeline.run(spark, FOLDER), ("doc_id", "n_ids")) == rows(docs, ("doc_id", "n_ids"))


def test_hostile_rows(spark):
    docs = hostile(spark).select("doc_id", "text", "doc", "print", "n").withColumnRenamed("n", "n_chars")
    for k, source in enumerate((docs, docs.limit(0))):
        now = source
        for name, stage in corpus_pipeline.STAGES:
            now = saved(stage(spark, now, FOLDER), name)
        assert (now.count() == 0) == (k == 1)
