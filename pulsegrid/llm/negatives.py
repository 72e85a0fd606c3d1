"""Hard negatives by threshold joins over inverted lists that leave out what a norm bound covers.

Vectors are whole numbers. Dimensions are taken in one order, those of the largest spread first. For a threshold a
row's inverted entries end where the norm of its remaining dimensions (its suffix) falls below the threshold: all
that the suffix can add to a product with a query is bounded by the product of the two suffix norms. A query walks
the lists in that order, adds up partial scores, drops rows whose partial score and remaining norms cannot reach
the threshold, and finishes the others exactly. It begins with a high threshold and lowers it until its window is
full, or down to the score that it needs at least.

Rows are dealt to blocks, queries to groups; a task holds one block and one group. Each group first visits one block,
and what it finds there is the least that the other blocks must reach. Blocks and groups have a bounded size, also
those of a frequent label.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import saved

#: thresholds as shares of the largest product that a query can have in a block
LEVELS = (0.7, 0.5, 0.4, 0.3, 0.2, 0.1)
#: dimensions between two prunings
STRIDE = 8
#: scaled components stay below this, so percentages of sums of products fit in 64 bits
LARGEST = 1 << 22
NO_FLOOR = -(1 << 62)


def suffix_norms(vectors: np.ndarray) -> np.ndarray:
    """Norm of each row from a column to its end, rounded up; one more column of zeros."""
    squares = vectors.astype(np.float64) ** 2
    out = np.zeros((len(vectors), vectors.shape[1] + 1))
    out[:, :-1] = np.sqrt(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]) * (1 + 1e-9)
    return out


class Lists:
    """Inverted lists of a block of vectors, their columns in the order of the walk."""

    def __init__(self, vectors: np.ndarray, keys: np.ndarray, labels: np.ndarray):
        self.vectors, self.keys, self.labels = vectors, keys, labels
        self.rest = suffix_norms(vectors)
        self.largest = float(self.rest[:, 0].max(initial=0))

    def enter(self, bound: float) -> None:
        """Enter each row under its dimensions, from the first to where its suffix norm falls below ``bound``."""
        held = self.rest[:, :-1] >= bound
        self.ends = held.sum(axis=1)
        self.rows = [np.flatnonzero(column) for column in held.T]
        self.values = [self.vectors[rows, d] for d, rows in enumerate(self.rows)]

    def reach(self, query: np.ndarray, rest: np.ndarray, alive: np.ndarray, least: int) -> np.ndarray:
        """Those of the entered rows ``alive`` whose product with ``query`` may be ``least``: none that is gets lost."""
        total = np.zeros(len(self.vectors), np.int64)
        low = least - 1 - abs(least) * 1e-12  # beyond what the sum below is rounded by
        for d, (rows, values) in enumerate(zip(self.rows, self.values)):
            if query[d]:
                total[rows] += query[d] * values
            if d % STRIDE == STRIDE - 1 or d == len(self.rows) - 1:
                lacks = np.minimum(self.ends[alive], d + 1)  # the first column that the sum is without
                alive = alive[total[alive] + self.rest[alive, lacks] * rest[lacks] >= low]
        return alive


def _fill(lists: Lists, queries: list[tuple], k: int, other_labels: bool) -> Iterator[tuple]:
    """(query, window, keys, scores) of the first ``k`` rows of each window, thresholds lowered until it is full."""
    waiting = [(query, vector, label, suffix_norms(vector[None])[0], list(windows))
               for query, vector, label, windows in queries]
    for level in (*LEVELS, 0.0, None):
        if not waiting:
            break
        if level is not None:  # the last round has the entries of 0: all
            lists.enter(level * lists.largest)
        later = []
        for query, vector, label, rest, windows in waiting:
            least = min(w["lo"] for w in windows)
            at = least if level is None else max(least, int(level * lists.largest * rest[0]) + 1)
            if at <= max(w["hi"] for w in windows):
                among = lists.rows[0]
                among = among[lists.labels[among] != label] if other_labels else among[lists.keys[among] != query]
                found = lists.reach(vector, rest, among, at)
                scores = lists.vectors[found] @ vector
                open_ = []
                for w in windows:
                    inside = np.flatnonzero((scores >= max(at, w["lo"])) & (scores <= w["hi"]))
                    if len(inside) < k and at > w["lo"]:
                        open_.append(w)
                        continue
                    keys = lists.keys[found[inside]]
                    first = np.lexsort((keys, -scores[inside]))[:k]
                    yield query, w["of"], keys[first], scores[inside][first]
                windows = open_
            if windows:
                later.append((query, vector, label, rest, windows))
        waiting = later


def _matrix(column: pa.ChunkedArray, order: np.ndarray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(-1, len(order))[:, order]


def _visit(k: int, other_labels: bool, order: np.ndarray):
    """What a group of queries finds in one block."""

    def work(entries: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if entries.num_rows and queries.num_rows:
            keys = entries.column("id").to_numpy()
            names, labels = np.unique(np.array(entries.column("label").to_pylist(), object), return_inverse=True)
            code = {name: i for i, name in enumerate(names)}
            vectors = _matrix(entries.column("vec"), order)
            asked = list(zip(queries.column("id").to_pylist(), _matrix(queries.column("vec"), order),
                             [code.get(x, -1) for x in queries.column("label").to_pylist()],
                             queries.column("windows").to_pylist()))
            if other_labels:
                found = list(_fill(Lists(vectors, keys, labels), asked, k, True))
            else:
                for label in sorted({q[2] for q in asked} - {-1}):
                    own = np.flatnonzero(labels == label)
                    lists = Lists(vectors[own], keys[own], labels[own])
                    found += _fill(lists, [q for q in asked if q[2] == label], k, False)
        size = [len(f[2]) for f in found]
        whole = [np.concatenate([np.zeros(0, np.int64), *[f[i] for f in found]]) for i in (2, 3)]
        return pa.table({"query": np.repeat(np.array([f[0] for f in found], np.int64), size),
                         "of": np.repeat(np.array([f[1] for f in found], np.int64), size),
                         "id": whole[0].astype(np.int64), "score": whole[1].astype(np.int64)})

    return work


def scaled_rows(vectors: DataFrame, key: str, column: str, label: str, scale: int) -> DataFrame:
    """(id, label, vec): one row per key that takes part, components as whole numbers ``floor(scale * x)``."""
    whole = F.transform(F.col(column).cast("array<double>"), lambda x: F.floor(x * float(scale)))
    small = F.forall("vec", lambda x: F.coalesce(x.between(-LARGEST + 1, LARGEST - 1), F.lit(False)))
    finite = F.forall(F.col(column).cast("array<double>"),
                      lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = vectors.where(finite).select(F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"),
                                        whole.alias("vec"))
    return (rows.where("id is not null and label is not null").where(small)
            .select("id", "label", F.col("vec").cast("array<int>").alias("vec"))
            .groupBy("id").agg(F.min(F.struct("label", "vec")).alias("r")).select("id", "r.label", "r.vec"))


def hard_negatives(vectors: DataFrame, anchors, key: str = "vec_id", column: str = "embedding", label: str = "label",
                   positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
                   block_rows: int = 20_000, group_queries: int = 1_000) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are products of the vectors ``floor(scale * x)``, ties go to the smaller key. Anchors are the rows for
    whose key the condition ``anchors`` holds; an anchor's positives are its first ``positives`` other rows of its
    label. For each, the first ``negatives`` rows of other labels whose score is ``low`` to ``high`` percent of the
    positive's; none, where that is an empty range.

    Rows take no part without a key, label or vector, or with a component that is null, not finite or, scaled, 2**22
    or more. Shorter vectors end in zeros. Of several rows of one key that with the smallest label and vector counts.
    Other columns are ignored. The order of dimensions is that of 1,000 rows; it decides nothing but the time taken.
    """
    rows = saved(scaled_rows(vectors, key, column, label, scale), "rows")
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("dim"),
                    F.count(F.when(anchors(F.col("id")), 1)).alias("asked")).first()
    dim, blocks, groups = max(size.dim or 1, 1), max(-(-size.n // block_rows), 1), max(-(-size.asked // group_queries), 1)
    rows = rows.withColumn("vec", F.concat("vec", F.array_repeat(F.lit(0), F.lit(dim) - F.size("vec"))))
    some = rows.orderBy(F.xxhash64("id")).select("vec").limit(1_000).toPandas().vec
    spread = np.stack(some.to_numpy()).astype(float).var(axis=0) if len(some) else np.zeros(dim)
    order = np.argsort(-spread, kind="stable")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    every = F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))

    def visited(queries: DataFrame, k: int, other_labels: bool, first: bool) -> DataFrame:
        """The group's first block, or all others."""
        here = F.pmod(F.col("group"), F.lit(blocks)) == F.col("block")
        here = here if first else ~here
        held = rows.withColumn("group", F.explode(every)).where(here)
        asked = (queries.withColumn("group", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(groups)))
                 .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
                 .where(here))
        by = ["group", "block"]
        return saved(held.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(
            _visit(k, other_labels, order), "query long, of long, id long, score long"), "found")

    def filled(queries: DataFrame, k: int, other_labels: bool) -> DataFrame:
        """(query, of, id, score, rank): the first ``k`` rows of each window ``of`` of the queries."""
        rank = F.row_number().over(Window.partitionBy("query", "of").orderBy(F.desc("score"), "id"))
        begun = visited(queries, k, other_labels, True)
        if blocks == 1:
            return begun.withColumn("rank", rank)
        least = begun.withColumn("rank", rank).where(F.col("rank") == k).select(
            F.col("query").alias("id"), "of", F.col("score").alias("least"))
        known = least.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("of", "least"))).alias("least"))
        raised = F.transform("windows", lambda w: F.struct(
            w["of"].alias("of"), F.greatest(w["lo"], F.col("least")[w["of"]]).alias("lo"), w["hi"].alias("hi")))
        then = saved(queries.join(known, "id", "left").withColumn("windows", raised).drop("least"), "asked")
        return begun.unionByName(visited(then, k, other_labels, False)).withColumn("rank", rank).where(F.col("rank") <= k)

    def window(of, lo, hi):
        return F.struct(F.col(of).alias("of"), lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))

    asked = rows.where(anchors(F.col("id"))).select("id", "label", "vec")
    first = filled(asked.withColumn("windows", F.array(window("id", F.lit(NO_FLOOR), F.lit(-NO_FLOOR)))), positives, False)
    first = saved(first.select(F.col("query").alias("anchor_id"), F.col("id").alias("positive_id"),
                               F.col("score").alias("positive_score")), "positives")
    bounds = first.where("positive_score >= 0").select(F.col("anchor_id").alias("id"), window(
        "positive_id", F.expr(f"({low} * positive_score + 99) div 100"), F.expr(f"({high} * positive_score) div 100")
    ).alias("w"))
    windows = bounds.groupBy("id").agg(F.collect_list("w").alias("windows"))
    found = filled(saved(asked.join(windows, "id"), "asked"), negatives, True)
    return (found.select(F.col("query").alias("anchor_id"), F.col("of").alias("positive_id"), "rank",
                         F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(first, ["anchor_id", "positive_id"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
