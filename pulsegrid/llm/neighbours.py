"""Nearest vectors by a few stable projections, a kd-tree over them and a chi-square stopping test.

Vectors are projected on ``projections`` Gaussian directions. For two vectors at distance d the squared
distance of their projections is d² times a chi-square variable, so once the best ``k`` found lie within d, a
vector whose projection is further away than d² times the ``stop`` quantile belongs to the nearest ones with a
chance of at most 1 - ``stop``. A kd-tree fitted on a bounded sample cuts the projected space into leaves;
every vector is put into its leaf. A query first takes its own leaf, which bounds d, and then all leaves that
the test does not rule out. In a leaf, vectors are verified in order of their projected distance until the test
holds. Equal vectors are one entry with their smallest keys, and large leaves and query groups are cut into
blocks, so a very common vector or leaf is no single task.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import saved


def chi_square_quantile(share: float, freedom: int) -> float:
    """Quantile for an even number of degrees of freedom, by bisection of the closed form."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        x = (low + high) / 2
        part, term = 0.0, math.exp(-x / 2)
        for i in range(freedom // 2):
            part += term
            term *= x / 2 / (i + 1)
        low, high = (x, high) if 1 - part < share else (low, x)
    return high


class Tree:
    """A kd-tree over projected points: node i has the children 2i and 2i + 1."""

    def __init__(self, points: np.ndarray, depth: int, directions: np.ndarray):
        self.depth, self.directions = depth, directions
        self.axis = np.zeros(1 << depth, np.int32)
        self.cut = np.zeros(1 << depth)
        members = {1: np.arange(len(points))}
        for node in range(1, 1 << depth):
            own = members.pop(node)
            if len(own):
                self.axis[node] = np.argmax(np.ptp(points[own], axis=0))
                self.cut[node] = np.median(points[own, self.axis[node]])
            above = points[own, self.axis[node]] > self.cut[node]
            members[2 * node], members[2 * node + 1] = own[~above], own[above]

    def project(self, vectors: np.ndarray) -> np.ndarray:
        return vectors.astype(np.float64) @ self.directions

    def leaf(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), np.int64)
        rows = np.arange(len(points))
        for _ in range(self.depth):
            node = 2 * node + (points[rows, self.axis[node]] > self.cut[node])
        return node


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _search(k: int, limit: float, directions: np.ndarray):
    """Candidates of the queries of a block among its vectors."""

    def work(entries: pa.Table, queries: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = ([], [], [])
        if entries.num_rows and queries.num_rows:
            vectors = _matrix(entries.column("vec").combine_chunks()).astype(np.float64)
            keys = entries.column("ids").combine_chunks()
            cuts, flat = keys.offsets.to_numpy(), keys.values.to_numpy()
            points = vectors @ directions
            asked = _matrix(queries.column("vec").combine_chunks()).astype(np.float64)
            for query, bound, q, p in zip(queries.column("query").to_pylist(), queries.column("bound").to_pylist(),
                                          asked, asked @ directions):
                far = ((points - p) ** 2).sum(axis=1)
                order = np.argsort(far, kind="stable")
                score, key = np.zeros(0), np.zeros(0, np.int64)
                at = 0
                while at < len(order):
                    now = order[at:at + 64]
                    if math.isfinite(bound):
                        now = now[far[now] <= bound * bound * limit]
                        if not len(now):
                            break
                    new = np.sqrt(((vectors[now] - q) ** 2).sum(axis=1))
                    held = [flat[cuts[i]:cuts[i + 1]] for i in now]
                    key = np.concatenate([key, *held])
                    score = np.concatenate([score, np.repeat(new, [len(h) for h in held])])
                    best = key != query
                    key, score = key[best], score[best]
                    best = np.lexsort((key, score))[:k]
                    key, score = key[best], score[best]
                    if len(key) == k:
                        bound = min(bound, score[-1])
                    at += 64
                found[0].append(np.full(len(key), query))
                found[1].append(key)
                found[2].append(score)
        whole = [np.concatenate(f) if f else np.zeros(0) for f in found]
        return pa.table({"query_id": whole[0].astype(np.int64), "vec_id": whole[1].astype(np.int64),
                         "score": whole[2].astype(np.float64)})

    return work


def nearest(vectors: DataFrame, queries, key: str = "vec_id", column: str = "embedding", k: int = 10,
            projections: int = 8, stop: float = 0.97, sample: int = 50_000, leaf_rows: int = 2_000,
            block_rows: int = 4_000, seed: int = 11) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of ``vectors`` for which the condition ``queries`` on its
    key holds, its ``k`` nearest other rows by Euclidean distance in double precision, ties to the smaller key.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without a key or
    of another length than most. A key should occur once; of equal (key, vector) rows one counts. The tree is
    fitted on at most ``sample`` vectors, every vector is indexed. Other columns are ignored.
    """
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<float>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where("id is not null and vec is not null").where(finite & F.exists("vec", lambda x: x != 0)).distinct()
    length = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if length is None:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"),
                           F.lit(0.0).alias("score")).limit(0)
    dim = length.n
    rows = rows.where(F.size("vec") == dim)

    # equal vectors: one entry with the smallest keys (one more than asked, for the query's own)
    ahead = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    entries = saved(rows.withColumn("n", ahead).where(F.col("n") <= k + 1)
                    .groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")), "entries")
    total = entries.count()
    directions = np.random.default_rng(seed).standard_normal((dim, projections))
    some = entries.orderBy(F.xxhash64(F.col("ids")[0])).select("vec").limit(sample).toPandas()
    points = np.stack(some.vec.to_numpy()).astype(np.float64) @ directions
    depth = max(0, min(math.ceil(math.log2(max(total / leaf_rows, 1))), int(math.log2(max(len(points) / 16, 1)))))
    tree = Tree(points, depth, directions)

    def placed(batches):
        for batch in batches:
            if batch.num_rows:
                at = tree.project(_matrix(batch.column("vec")))
                columns = [pa.array(tree.leaf(at)), pa.array(list(at), pa.list_(pa.float64())), *batch.columns]
                yield pa.RecordBatch.from_arrays(columns, ["leaf", "point", *batch.schema.names])

    index = entries.mapInArrow(placed, "leaf long, point array<double>, vec array<float>, ids array<long>")
    index = saved(index, "index")
    box = [f(F.col("point")[i]).alias(f"{n}{i}") for i in range(projections) for n, f in (("low", F.min), ("high", F.max))]
    leaves = index.groupBy("leaf").agg(F.count("*").alias("n"), *box).collect()  # at most 2 ** depth rows
    low = np.array([[r[f"low{i}"] for i in range(projections)] for r in leaves])
    high = np.array([[r[f"high{i}"] for i in range(projections)] for r in leaves])
    name = np.array([r.leaf for r in leaves])
    blocks = np.array([-(-r.n // block_rows) for r in leaves])
    sizes = vectors.sparkSession.createDataFrame([(int(a), int(b)) for a, b in zip(name, blocks)], "leaf long, blocks long")
    index = (index.join(F.broadcast(sizes), "leaf")  # one row per leaf
             .withColumn("block", F.pmod(F.xxhash64(F.col("ids")[0]), "blocks")).select("leaf", "block", "vec", "ids"))
    limit = chi_square_quantile(stop, projections)

    def visits(first: bool):
        def work(batches):
            for batch in batches:
                at = tree.project(_matrix(batch.column("vec"))) if batch.num_rows else np.zeros((0, projections))
                own, bound = tree.leaf(at), batch.column("bound").to_numpy()
                source, leaf, block = [], [], []
                for i in range(len(at)):
                    gap = np.maximum(np.maximum(low - at[i], at[i] - high), 0)
                    take = (name == own[i]) if first else (name != own[i]) & (
                        (gap ** 2).sum(axis=1) <= bound[i] * bound[i] * limit)
                    for j in np.flatnonzero(take):
                        source += [i] * blocks[j]
                        leaf += [name[j]] * blocks[j]
                        block += range(blocks[j])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf, pa.int64()), pa.array(block, pa.int64()),
                     *[c.take(pa.array(source, pa.int64())) for c in (batch.column("query"), batch.column("vec"),
                                                                       batch.column("bound"))]],
                    ["leaf", "block", "query", "vec", "bound"])

        return work

    def searched(asked: DataFrame, first: bool) -> DataFrame:
        way = asked.mapInArrow(visits(first), "leaf long, block long, query long, vec array<float>, bound double")
        load = way.groupBy("leaf", "block").agg(F.ceil(F.count("*") / block_rows).alias("parts"))
        way = way.join(load, ["leaf", "block"]).withColumn("part", F.pmod(F.xxhash64("query"), "parts")).drop("parts")
        held = index.join(load, ["leaf", "block"]).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        by = ["leaf", "block", "part"]
        return saved(held.select(*by, "vec", "ids").groupBy(*by).cogroup(way.groupBy(*by)).applyInArrow(
            _search(k, limit, directions), "query_id long, vec_id long, score double"), "found")

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    asked = rows.where(queries(F.col("id"))).select(F.col("id").alias("query"), "vec", F.lit(float("inf")).alias("bound"))
    own = searched(asked, True)
    near = own.withColumn("rank", rank).where(F.col("rank") == k).select(F.col("query_id").alias("query"), "score")
    asked = asked.drop("bound").join(near, "query", "left").select(
        "query", "vec", F.coalesce("score", F.lit(float("inf"))).alias("bound"))
    found = own.unionByName(searched(asked, False)).distinct()
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
