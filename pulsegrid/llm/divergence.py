"""How far the sources of a language are from each other, in a cube of blocks.

Groups are the sources of each language. The work of comparing all groups of a language over all its terms is a
cube: groups along two axes, terms along the third. It is cut into cells of ``GROUPS`` x ``GROUPS`` groups and about
``TERMS`` terms. A slice (group block, term block) is packed once and replicated to the cells that need it; each cell
sums its differences, and one aggregation adds them along the term axis. A cell's size is fixed, so no language,
source or term is one task's work.

Terms are counted inside tasks first, one row per term of a step with its sources, so a frequent term sends one row
a step. The threshold is met on exact strings and exact counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import LOWER, arrow_step, byte_view
from .tables import saved

#: groups on a side of a cell, terms along it, bytes of text that are counted together
GROUPS, TERMS, STEP = 64, 8192, 8_000_000

#: bytes that terms are made of: letters, and all of other scripts
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True


def terms_of(data: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts, lower-cased, and the number of the text of each."""
    inside = LETTER[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    opens = ends[:-1][ends[:-1] < len(data)]
    first[opens] = inside[opens]
    start = np.flatnonzero(first)
    letters = np.concatenate([[0], np.cumsum(inside)])  # a term's letters follow one another without the rest
    offsets = np.append(letters[start], letters[-1])
    owner = np.searchsorted(ends, start, side="right") - 1
    terms = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets.astype(np.int64)),
                                             pa.py_buffer(LOWER[data[inside]]))
    return terms, owner


def _counted(batch: pa.RecordBatch) -> pa.Table:
    """One row per (language, term) of a step: documents, and occurrences by source."""
    lang, source = (pc.fill_null(batch.column(i), "").dictionary_encode() for i in (0, 1))
    terms, owner = terms_of(*byte_view(batch.column(2)))
    coded = terms.dictionary_encode()
    size, sources = max(len(coded.dictionary), 1), max(len(source.dictionary), 1)
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    of_lang, of_source = (c.indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in (lang, source))
    held, times = np.unique(owner * size + code, return_counts=True)  # a term of a document, once
    doc, term = held // size, held % size
    key, at = np.unique((of_lang[doc] * size + term) * sources + of_source[doc], return_inverse=True)
    times, docs = np.bincount(at, times, len(key)).astype(np.int64), np.bincount(at, minlength=len(key))
    row, first = np.unique(key // sources, return_index=True)
    cuts = np.append(first, len(key)).astype(np.int32)
    by = pa.StructArray.from_arrays([source.dictionary.take(pa.array(key % sources)), pa.array(times)], ["source", "n"])
    if not len(row):
        return pa.table({"lang": [], "term": []})
    return pa.table({
        "lang": lang.dictionary.take(pa.array(row // size)),
        "term": coded.dictionary.take(pa.array(row % size)).cast(pa.string()),
        "docs": np.add.reduceat(docs, first), "n": np.add.reduceat(times, first),
        "by": pa.ListArray.from_arrays(pa.array(cuts), by)})


def share(n: str, total: str, terms: str) -> F.Column:
    """1 + floor(10**9 * (n + 5) / (total + 5 * terms)) in whole numbers; of no use where there is no term."""
    return F.expr(f"1 + (1000000000BD * ({n} + 5)) div ({total} + 5 * greatest({terms}, 1))")


def _dense(slices: pa.Table, row: int) -> tuple[np.ndarray, np.ndarray]:
    """The groups of one slice, and their shares as a matrix over the terms of the block."""
    names, empty, group, term, p = (slices.column(c).chunk(0)[row].values.to_numpy(zero_copy_only=False)
                                    for c in ("groups", "empty", "group", "term", "p"))
    out = np.repeat(empty[:, None], slices.column("terms")[row].as_py(), axis=1)
    out[np.searchsorted(names, group), term] = p
    return names, out


def _cell(slices: pa.Table) -> pa.Table:
    """Sums of differences between all groups of two blocks over one block of terms."""
    slices = slices.combine_chunks().sort_by([("left", "descending")])
    slices = slices.combine_chunks()
    x, a = _dense(slices, 0)
    y, b = _dense(slices, slices.num_rows - 1)  # a block against itself comes once
    total = np.stack([np.abs(b - row).sum(axis=1) for row in a]).ravel()
    x, y = np.repeat(x, len(b)), np.tile(y, len(a))
    keep = x < y
    lang = pa.repeat(slices.column("lang")[0], int(keep.sum()))
    return pa.table({"lang": lang, "x": x[keep], "y": y[keep], "part": total[keep]})


def term_counts(docs: DataFrame, least: int = 30, text: str = "text", lang: str = "lang", source: str = "source",
                ) -> DataFrame:
    """(lang, source, term, n, n_lang): occurrences of every term that at least ``least`` documents of the language
    hold, by source, and in the language."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
                       F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
                       F.col(text).cast("string").alias("text"))
    held = saved(rows.mapInArrow(
        arrow_step(_counted, "text", STEP),
        "lang string, term string, docs long, n long, by array<struct<source:string,n:long>>"), "terms")
    kept = held.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang")).where(
        F.col("docs") >= least).select("lang", "term", "n_lang")
    return (held.select("lang", "term", "by").join(kept, ["lang", "term"])
            .select("lang", "term", "n_lang", F.inline("by"))
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.first("n_lang").alias("n_lang")))


def audit(docs: DataFrame, least: int = 30, top: int = 50, text: str = "text", lang: str = "lang",
          source: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank) for every source of every language.

    Each term that ``least`` documents of a language hold has in each source the share
    ``p = 1 + floor(10**9 * (n + 5) / (N + 5 * V))`` of its occurrences. Part ``pair``: to each other source, the sum
    of the differences of all shares. Part ``term``: the ``top`` terms whose share exceeds that of the language most.

    Null texts, languages and sources are empty ones; a document without terms still makes its source a group, whose
    shares are all those of zero occurrences. A language without kept terms has pairs of value 0 and no term rows.
    Keys are not used, so repeated rows count each. Other columns are ignored.
    """
    counts = saved(term_counts(docs, least, text, lang, source), "counts")
    pairs = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
                        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source")).distinct()
    terms = counts.groupBy("lang", "term").agg(F.first("n_lang").alias("n_lang"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("total_lang"))
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source"))
    groups = saved(pairs.join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
                   .na.fill(0, ["total", "v", "total_lang"]).withColumn("g", number.cast("long"))
                   .withColumn("block", F.expr(f"(g - 1) div {GROUPS}"))
                   .withColumn("depth", F.expr(f"greatest((v + {TERMS - 1}) div {TERMS}, 1)")), "groups")

    # terms of a block are numbered, so a slice is a matrix
    axis = langs.select("lang", F.expr(f"(v + {TERMS - 1}) div {TERMS}").alias("depth"))
    placed = terms.join(axis, "lang").withColumn("tb", F.pmod(F.xxhash64("term"), "depth"))
    placed = saved(placed.withColumn("t", (F.row_number().over(Window.partitionBy("lang", "tb").orderBy("term")) - 1))
                   .select("lang", "term", "tb", "t"), "axis")
    width = placed.groupBy("lang", "tb").agg(F.count("*").alias("terms"))

    shares = counts.join(groups.drop("depth"), ["lang", "source"]).withColumn("p", share("n", "total", "v"))
    packed = (shares.join(placed, ["lang", "term"]).groupBy("lang", "block", "tb")
              .agg(F.collect_list(F.struct(F.col("g").alias("group"), F.col("t").alias("term"), "p")).alias("e"))
              .select("lang", "block", "tb", *[F.col(f"e.{c}").alias(c) for c in ("group", "term", "p")]))
    zero = share("0", "total", "v")
    sides = groups.groupBy("lang", "block", "depth").agg(
        F.array_sort(F.collect_list(F.struct("g", zero.alias("p")))).alias("s"))
    last = groups.groupBy("lang").agg(F.max("block").alias("last"))
    none = F.array().cast("array<long>")
    slices = (sides.select("lang", "block", F.col("s.g").alias("groups"), F.col("s.p").alias("empty"),
                           F.explode(F.sequence(F.lit(0).cast("long"), F.col("depth") - 1)).alias("tb"))
              .join(width, ["lang", "tb"], "left").join(packed, ["lang", "block", "tb"], "left").join(last, "lang")
              .withColumn("terms", F.coalesce("terms", F.lit(0)))
              .withColumn("group", F.coalesce("group", none)).withColumn("p", F.coalesce("p", none))
              .withColumn("term", F.coalesce("term", F.array().cast("array<int>"))))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("last")))
    cells = (slices.withColumn("other", other)
             .select("lang", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "tb",
                     (F.col("block") <= F.col("other")).alias("left"), "groups", "empty", "terms", "group", "term", "p"))
    parts = cells.groupBy("lang", "a", "b", "tb").applyInArrow(_cell, "lang string, x long, y long, part long")
    apart = parts.groupBy("lang", "x", "y").agg(F.sum("part").alias("value"))
    both = apart.unionByName(apart.select("lang", F.col("y").alias("x"), F.col("x").alias("y"), "value"))
    names = groups.select("lang", "g", "source")
    pair = (both.join(names.withColumnRenamed("g", "x"), ["lang", "x"])
            .join(names.select("lang", F.col("g").alias("y"), F.col("source").alias("item")), ["lang", "y"])
            .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    over = (shares.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                          (F.col("p") - share("n_lang", "total_lang", "v")).alias("value"))
            .where("value > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
    return pair.withColumn("rank", F.row_number().over(order)).unionByName(over)
