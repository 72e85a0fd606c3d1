"""Exact n-gram Jaccard join over block index lists, and the groups that its links form.

A set is its shingles in one global order (that of their hashes). The order is cut into position blocks,
so many that two similar sets must agree in a whole block; an index list holds the sets that share one
block. Entries of a list carry the size of their set and the position at which the block begins in it:
entries whose sizes or positions already force too large a difference are skipped without a look at the
sets. The answers of a set are derived from those of the set it resembles most: sets found similar to a
list's first one form a group, and only entries of different groups are compared again.

What is kept and shuffled for that stays small: a set is named by its digest, so equal sets are one without
a join, and what travels to the comparison is compressed text (the hashes of its shingles take several
times as much and do not compress).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import STEP_BYTES, arrow_step, byte_view, mix, shingle_sets
from .tables import components, saved


def levels(percent: int, largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size classes: where each begins, how many shingles two similar sets may differ in if the smaller
    set is of that class, and the number of position blocks. Similar sets are of one class or of two
    that follow each other."""
    begin = [1]
    while begin[-1] <= largest:
        begin.append(max(begin[-1] + 1, (begin[-1] - 1) * 100 // percent + 1))
    begin.append(max(begin[-1] + 1, (begin[-1] - 1) * 100 // percent + 1))
    start = np.array(begin, np.int64)
    small = start[1:] - 1
    differ = (small + small * 100 // percent) * (100 - percent) // (100 + percent)
    # some blocks more than the difference, for blocks in which a set has no shingle
    spare = np.where(differ > 0, np.ceil((differ + 1) * 1.5 * np.exp(-start[:-1] / (differ + 1))) + 1, 0)
    return start[:-1], differ, differ + 1 + spare.astype(np.int64)


def set_digests(value: np.ndarray, of: np.ndarray, rows: int) -> tuple[np.ndarray, list[bytes | None]]:
    """Size and 128-bit digest of each row's set."""
    cuts = np.searchsorted(of, np.arange(rows + 1))
    plain = value.tobytes()
    return np.diff(cuts), [hashlib.blake2b(plain[8 * a:8 * b], digest_size=16).digest() if b > a else None
                           for a, b in zip(cuts[:-1], cuts[1:])]


def set_names(digest: list[bytes | None]) -> np.ndarray:
    """63 bits of each digest, by which the index names a set."""
    return np.array([int.from_bytes(d[:8], "little") >> 1 if d else 0 for d in digest], np.int64)


def _squeezed(batch: pa.RecordBatch) -> pa.Table:
    """Texts as compressed bytes after their length."""
    codec = pa.Codec("zstd")
    data, ends = byte_view(batch.column(1))
    plain = data.tobytes()
    return pa.table({"doc": batch.column(0), "text": pa.array(
        [int(b - a).to_bytes(5, "little") + codec.compress(plain[a:b], asbytes=True) for a, b in zip(ends[:-1], ends[1:])],
        pa.binary())})


def _plain(column: pa.Array) -> pa.Array:
    """The texts that ``_squeezed`` made smaller."""
    codec = pa.Codec("zstd")
    return pa.array([codec.decompress(held[5:], int.from_bytes(held[:5], "little"), asbytes=True)
                     for held in column.to_pylist()], pa.large_binary())


def _blocks(value, of, size, level, begin, differ, blocks):
    """Keys, owners, sizes and first positions of the non-empty blocks of each set at its ``level``."""
    parts = blocks[level][of].astype(np.uint64)
    with np.errstate(over="ignore"):
        block = ((value >> np.uint64(32)) * parts) >> np.uint64(32)
        new = np.ones(len(value), bool)
        new[1:] = (of[1:] != of[:-1]) | (block[1:] != block[:-1])
        at = np.flatnonzero(new)
        held = np.add.reduceat(mix(value, 11), at) if len(at) else np.zeros(0, np.uint64)
        own = of[at]
        place = level[own].astype(np.uint64) * np.uint64(1 << 32) + block[at]
        key = mix(held ^ mix(place, 12), 13)
    first = np.searchsorted(of, np.arange(len(size)))
    key, own, rank = [key], [own], [at - first[own]]
    # a set with too few non-empty blocks also enters the lists of its empty ones
    filled = np.bincount(own[0], minlength=len(size))
    for i in np.flatnonzero((size > 0) & (filled <= differ[level])):
        mine = block[first[i]:first[i] + size[i]]
        empty = np.setdiff1d(np.arange(blocks[level[i]], dtype=np.uint64), mine)
        if len(empty):
            spot = np.uint64(level[i]) * np.uint64(1 << 32) + empty
            key.append(mix(mix(spot, 12), 14))
            own.append(np.full(len(empty), i))
            rank.append(np.searchsorted(mine, empty))
    return np.concatenate(key), np.concatenate(own), np.concatenate(rank)


#: an entry: list (48 bits are enough, sets that meet by chance are told apart later), set, and packed the set's size, the block's first position, and two flags
ENTRY = "list long, doc long, at long"
#: other sets of the step are in the list; one of them, smaller, goes to the list's task for all of them
KNOWN, AWAY = 1, 2


def packed(size, rank, flags):
    return (size << 33) | (rank << 2) | flags


def _entries(n: int, percent: int):
    """Index entries. Of equal sets in a step the first enters; of entries in one list of a step only the smallest
    needs to be sent to the list's task, as all are known to share it."""

    def work(batch: pa.RecordBatch) -> pa.Table | None:
        value, of = shingle_sets(*byte_view(batch.column(1)), n)
        size, digest = set_digests(value, of, batch.num_rows)
        doc = set_names(digest)
        seen: dict[bytes, int] = {}
        for i in np.lexsort((doc, size)):
            if digest[i] is not None:
                seen.setdefault(digest[i], i)
        keep = np.zeros(len(doc), bool)
        keep[list(seen.values())] = True
        if not keep.any():
            return None
        value, of = value[keep[of]], of[keep[of]]
        size = np.where(keep, size, 0)
        begin, differ, blocks = levels(percent, int(size.max()))
        level = np.maximum(np.searchsorted(begin, size, side="right") - 1, 0)
        key, own, rank = _blocks(value, of, size, level, begin, differ, blocks)
        lower = level[of] > 0
        below = _blocks(value[lower], of[lower], np.where(level > 0, size, 0), np.maximum(level - 1, 0),
                        begin, differ, blocks)
        key, own, rank = (np.concatenate(x) for x in zip((key, own, rank), below))
        key >>= np.uint64(16)
        order = np.lexsort((doc[own], size[own], key))
        first = np.ones(len(key), bool)
        first[1:] = key[order][1:] != key[order][:-1]
        shared = ~first
        shared[:-1] |= ~first[1:]
        flags = np.empty(len(key), np.int64)
        flags[order] = np.where(shared, KNOWN, 0) + np.where(first, 0, AWAY)
        # by set, so that what neighbouring rows share is compressed away
        order = np.argsort(own, kind="stable")
        own = own[order]
        return pa.table({"list": key[order].view(np.int64), "doc": doc[own],
                         "at": packed(size[own].astype(np.int64), rank[order].astype(np.int64), flags[order])})

    return arrow_step(work, "text")


def _shared(batches):
    """Of entries sorted by list and set: one of each set, of lists with more than one."""
    held = None  # the last entry so far, and whether it is to go out

    def rows(key, doc, at):
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(doc), pa.array((at >> 31).astype(np.int32)),
                                           pa.array((at & 0x7FFFFFFF).astype(np.int32))], ["list", "doc", "size", "rank"])

    for batch in batches:
        if not batch.num_rows:
            continue
        key, doc, at = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("list", "doc", "at"))
        at, known = at >> 2, (at & KNOWN) > 0
        if held is not None:
            key, doc, at, known = (np.concatenate([h, v]) for h, v in zip(held, (key, doc, at, known)))
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        key, doc, at, out = key[first], doc[first], at[first], np.logical_or.reduceat(known, first)
        same = key[1:] == key[:-1]
        out[1:] |= same
        out[:-1] |= same
        held = key[-1:], doc[-1:], at[-1:], out[-1:]
        yield rows(*(x[:-1][out[:-1]] for x in (key, doc, at)))
    if held is not None:
        yield rows(*(x[held[3]] for x in held[:3]))


#: 64-bit words of a parity sketch
WORDS = 16
#: bytes of compressed text that one step works on at a time
SQUEEZED_BYTES = STEP_BYTES // 3


def _sets(n: int):
    """Names of sets, their texts, and their parity sketches: a bit flips for every shingle that falls on it, so two
    sketches never differ in more bits than their sets differ in shingles."""

    def work(batch: pa.RecordBatch) -> pa.Table:
        value, of = shingle_sets(*byte_view(_plain(batch.column(1))), n)
        spot = (mix(value, 21) % np.uint64(64 * WORDS)).astype(np.int64)
        bits = (np.bincount(of * (64 * WORDS) + spot, minlength=batch.num_rows * 64 * WORDS) & 1).astype(np.uint8)
        held = np.packbits(bits.reshape(batch.num_rows, WORDS, 64), axis=2).view(np.int64)[:, :, 0]
        return pa.table({"doc": set_names(set_digests(value, of, batch.num_rows)[1]), "text": batch.column(1)} | {
            f"s{i}": np.ascontiguousarray(held[:, i]) for i in range(WORDS)})

    return arrow_step(work, "text", SQUEEZED_BYTES)


def _similar(n: int, percent: int):
    """Of pairs with their texts those whose sets are similar enough; a text that comes again is cut up once."""

    def sets(column):
        coded = column.dictionary_encode()
        value, of = shingle_sets(*byte_view(_plain(coded.dictionary)), n)
        cuts = np.searchsorted(of, np.arange(len(coded.dictionary) + 1))
        return [value[cuts[i]:cuts[i + 1]] for i in coded.indices.to_pylist()]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        good = []
        for a, b in zip(sets(batch.column("of_a")), sets(batch.column("of_b"))):
            common = len(np.intersect1d(a, b, assume_unique=True))
            good.append(100 * common >= percent * (len(a) + len(b) - common))
        return batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return arrow_step(work, "of_a", SQUEEZED_BYTES)


def _verified(sets: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """Of ``pairs(a, b)`` those whose sets are similar enough."""
    one, two = (sets.select(F.col("doc").alias(c), F.col("text").alias(f"of_{c}")) for c in "ab")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "of_a", "of_b").mapInArrow(
        _similar(n, percent), "a long, b long")


def jaccard_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 3,
                   percent: int = 90) -> DataFrame:
    """One row per row of ``docs``: its key, ``n_shingles`` and ``component_id``.

    Two documents link when 100 * |A and B| >= ``percent`` * |A or B| over their sets of ``n``-word
    shingles (A-Z lower-cased, words between ASCII white space); ``component_id`` is the smallest key
    reachable by links. A null or empty text has no shingle and links with nothing. Rows that share a key
    are one document with several texts; a row without a key has no component. Other columns are ignored.
    """
    docs = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    whole = docs.mapInArrow(_described(n), "doc long, n_shingles long, digest binary, id long")
    same = whole.where("digest is not null and doc is not null").groupBy("digest").agg(F.min("doc").alias("rep"))
    known = saved(whole.join(same, "digest", "left").select("doc", "n_shingles", "rep", "id"), "sets")
    present = docs.where("doc is not null")
    names = known.where("rep is not null").select(F.col("id").alias("doc"), "rep").distinct()

    # equal sets have one name, so copies of a text stand for each other from here on; ``doc`` is that name
    entries = present.mapInArrow(_entries(n, percent), ENTRY)
    away = F.col("at").bitwiseAND(AWAY) != 0
    shared = saved(entries.repartition(F.when(away, F.xxhash64("doc")).otherwise(F.col("list")))
                   .sortWithinPartitions("list", F.shiftright("at", 2), "doc")
                   .mapInArrow(_shared, "list long, doc long, size int, rank int"), "lists")
    # the set that shares most with others leads a list; every set is compared with one such leader
    long = shared.groupBy("list").agg(F.count("*").alias("n"), F.min("doc").alias("low"), F.max("doc").alias("high"))
    central = shared.join(long.where("low < high").select("list", "n"), "list").groupBy("doc").agg(F.sum("n").alias("weight"))
    # the sets that share a list at all: their texts are fetched once
    wanted = names.join(central, "doc").select(F.col("rep").alias("doc"))
    sets = saved(present.select("doc", "text").mapInArrow(arrow_step(_squeezed, "text"), "doc long, text binary")
                 .join(wanted, "doc", "left_semi").mapInArrow(
        _sets(n), f"doc long, text binary, {', '.join(f's{i} long' for i in range(WORDS))}"), "sets")
    leads = (shared.join(central, "doc").groupBy("list")
             .agg(F.max(F.struct("weight", -F.col("doc"))).alias("lead"), F.count("*").alias("n")).where("n > 1")
             .select("list", "lead.weight", (-F.col("lead.col2")).alias("leader")))
    best = (shared.join(leads, "list").where("doc != leader").groupBy("doc", "leader")
            .agg(F.count("*").alias("lists"), F.max("weight").alias("weight"))
            .groupBy("doc").agg(F.max_by("leader", F.struct("lists", "weight", "leader")).alias("leader")))
    pairs = best.select(F.least("doc", "leader").alias("a"), F.greatest("doc", "leader").alias("b")).distinct()
    ends = [names.select(F.col("doc").alias(c), F.col("rep").alias(f"rep_{c}")) for c in "ab"]

    def linked(pairs: DataFrame) -> DataFrame:
        similar = _verified(sets, saved(pairs, "pairs"), n, percent).join(ends[0], "a").join(ends[1], "b")
        return saved(similar.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")), "links")

    links = linked(pairs)
    rep = known.where("rep is not null").select("doc", "rep").distinct()
    twice = rep.groupBy("doc").agg(F.min("rep").alias("b"), F.max("rep").alias("top")).where("b != top")
    links = links.unionByName(rep.join(twice, "doc").select(F.col("rep").alias("a"), "b").where("a != b"))

    group = components(links)
    of = names.join(group, F.col("rep") == F.col("node"), "left").select("doc", F.coalesce("component", "rep").alias("of"))
    seen = shared.join(of, "doc").select("list", "doc", "size", "rank", "of")
    mixed = seen.groupBy("list").agg(F.min("of").alias("low"), F.max("of").alias("high")).where("low < high")
    seen = saved(seen.join(mixed.select("list"), "list", "left_semi"), "mixed")
    seen = seen.join(sets.drop("text"), "doc")
    columns = ["doc", "size", "rank", "of", *(f"s{i}" for i in range(WORDS))]
    x, y = (seen.select("list", *[F.col(c).alias(f"{c}_{s}") for c in columns]) for s in "ab")
    differ = F.floor((F.col("size_a") + F.col("size_b")) * (100 - percent) / (100 + percent))
    apart = (F.abs(F.col("rank_a") - F.col("rank_b"))
             + F.abs(F.col("size_a") - F.col("rank_a") - F.col("size_b") + F.col("rank_b")))
    unlike = sum(F.bit_count(F.col(f"s{i}_a").bitwiseXOR(F.col(f"s{i}_b"))) for i in range(WORDS))
    other = (x.join(y, (x["list"] == y["list"]) & (F.col("doc_a") < F.col("doc_b")) & (F.col("of_a") != F.col("of_b"))
                    & (apart <= differ) & (unlike <= differ))
             .select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b")).distinct())
    more = linked(other)
    if not more.isEmpty():
        group = components(links.unionByName(more))
    out = known.join(group, F.col("rep") == F.col("node"), "left")
    return out.select(F.col("doc").alias(key), "n_shingles",
                      F.when(F.col("doc").isNotNull(), F.coalesce("component", "rep", "doc")).alias("component_id"))


def _described(n: int):
    def work(batch: pa.RecordBatch) -> pa.Table:
        value, of = shingle_sets(*byte_view(batch.column(1)), n)
        size, digest = set_digests(value, of, batch.num_rows)
        return pa.table({"doc": batch.column(0), "n_shingles": size.astype(np.int64),
                         "digest": pa.array(digest, pa.binary()), "id": set_names(digest)})

    return arrow_step(work, "text")
