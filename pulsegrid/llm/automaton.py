"""Language-model scores from a weighted backoff automaton.

States are the contexts (up to ``order`` - 1 tokens) that the learning texts hold, arcs their n-grams, and every
state has a failure arc to its longest shorter context. With ``C`` the count of an n-gram and ``h'`` the context h
without its first token, an arc weighs the logarithm of

    p(w | h) = (C(hw) + mass * p(w | h')) / (C(h) + mass),

a failure arc that of ``mass / (C(h) + mass)``; at the root a token weighs ``(C(w) + 1) / (N + V + 1)``. The weights
of a state sum to one over all tokens. A text is read once from left to right: the state takes the arc of the next
token, after as many failure arcs as it needs, and the weights add up.

The automaton of the whole corpus is nowhere held at once. Texts are gathered into parts of some megabytes; a part
sends the hashes of its distinct n-grams, packed, to the slices of the hash space. A slice adds up the counts of all
parts and answers each with the corpus counts of what it sent. From these a part builds its automaton: the states and
arcs that its own texts can reach, with the weights of the whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import arrow_step, byte_view, mix, space_words, steps, word_hashes
from .tables import saved

#: bytes of text of a part (a longer text is a part), distinct n-grams of a slice, tokens that a lane reads
PART_BYTES, SLICE, LANE = 5_000_000, 2_000_000, 256
#: hashes of the two tokens that are no words; words never have them but by a clash of 64 bits
BEGIN, END = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9E6C63D0876A9A47)


def planes(values: np.ndarray) -> bytes:
    """Whole numbers as their bytes, all lowest bytes first: leading zeros lie together and compress well."""
    return zlib.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T), 1)


def from_planes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(size, -1).T).view(kind).ravel()


def rises(values: np.ndarray) -> bytes:
    """Ascending hashes as the steps between them."""
    return planes(np.diff(values, prepend=np.uint64(0)))


def from_rises(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, np.uint64), dtype=np.uint64)


def tokenized(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each with its begin and end, and where each text begins in them."""
    start, end, owner = space_words(data, ends)
    words = np.bincount(owner, minlength=len(ends) - 1)
    first = np.concatenate([[0], np.cumsum(words + 2)])
    out = np.empty(first[-1], np.uint64)
    out[first[:-1]], out[first[1:] - 1] = BEGIN, END
    out[np.arange(len(start)) + 2 * owner + 1] = word_hashes(data, start, end)
    return out, first


def grams(tokens: np.ndarray, first: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: where n-grams of one text end, and their hashes. Those of more than one token have 56 bits,
    in the upper bytes."""
    place = np.arange(len(tokens)) - np.repeat(first[:-1], np.diff(first))
    value = tokens
    yield np.arange(len(tokens)), tokens
    for k in range(2, order + 1):
        value = np.concatenate([tokens[:1], mix(value[:-1], k) + tokens[1:]])
        ends = np.flatnonzero(place >= k - 1)
        yield ends, mix(value[ends], 1) & np.uint64(0xFFFFFFFFFFFFFF00)


def _parts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Texts to parts: (part, keys, learns, lengths, vocabulary, tokens)."""
    held: list[tuple] = []
    bytes_held, number = 0, 0

    def packed() -> pa.RecordBatch:
        nonlocal number
        words, code = np.unique(np.concatenate([h[2] for h in held]), return_inverse=True)
        part = (TaskContext.get().partitionId() << 32) + number
        number += 1
        keys = pa.concat_arrays([h[0] for h in held])
        learns = pa.concat_arrays([h[1] for h in held])
        lengths = np.concatenate([h[3] for h in held]).astype(np.int64)
        taught = int(lengths[np.array(learns.to_pylist(), bool)].sum() - pc.sum(learns, min_count=0).as_py())
        one = [pa.array([0, len(keys)], pa.int32())]
        return pa.RecordBatch.from_arrays(
            [pa.array([part]), pa.array([taught]), pa.array([len(code)]), pa.ListArray.from_arrays(*one, keys), pa.ListArray.from_arrays(*one, learns),
             pa.array([planes(lengths)]), pa.array([rises(words)]), pa.array([planes(code.astype(np.uint32))])],
            ["part", "taught", "held", "keys", "learns", "lengths", "vocabulary", "tokens"])

    for batch in batches:
        for piece in steps(batch, "text"):
            data, ends = byte_view(piece.column("text"))
            tokens, first = tokenized(data, ends)
            held.append((piece.column("key"), piece.column("learns"), tokens, np.diff(first)))
            bytes_held += len(data) + 64 * piece.num_rows
            if bytes_held >= size:
                yield packed()
                held, bytes_held = [], 0
    if held:
        yield packed()


def _unpacked(part: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of a part, where its texts begin, and which of them teach."""
    tokens = from_rises(part["vocabulary"])[from_planes(part["tokens"], np.uint32)]
    first = np.concatenate([[0], np.cumsum(from_planes(part["lengths"], np.int64))])
    return tokens, first, np.array(part["learns"], bool)


def _slice_edges(slices: int) -> np.ndarray:
    """The last hash of every slice but the last."""
    return np.array([((i << 64) // slices) - 1 for i in range(1, slices)], np.uint64)


def _asked(order: int, slices: int):
    """The distinct n-grams of each part and their counts in its learning texts, by slice and order."""
    edges = _slice_edges(slices)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part = batch.slice(row, 1).to_pylist()[0]
                tokens, first, learns = _unpacked(part)
                teaches = np.repeat(learns, np.diff(first))
                for k, (ends, hashes) in enumerate(grams(tokens, first, order), 1):
                    # few texts do not teach: all are counted by one sort, and those few taken off
                    known, count = np.unique(hashes, return_counts=True)
                    other, times = np.unique(hashes[~teaches[ends]], return_counts=True)
                    count[np.searchsorted(known, other)] -= times
                    count = count.astype(np.uint32)
                    cut = [0, *np.searchsorted(known, edges, side="right"), len(known)]
                    at = [i for i in range(slices) if cut[i + 1] > cut[i]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(at, pa.int32()), pa.array([k] * len(at), pa.int32()), pa.array([part["part"]] * len(at), pa.int64()),
                         pa.array([rises(known[cut[i]:cut[i + 1]]) for i in at], pa.binary()),
                         pa.array([planes(count[cut[i]:cut[i + 1]]) for i in at], pa.binary())],
                        ["slice", "order", "part", "hashes", "counts"])

    return run


def _answered(rows: pa.Table) -> pa.Table:
    """Corpus counts of the n-grams of one slice and order, to each part in the order in which it asked."""
    hashes = [from_rises(h.as_py()) for h in rows.column("hashes")]
    size = np.cumsum([0, *map(len, hashes)])
    flat = np.concatenate(hashes)
    counts = np.concatenate([from_planes(c.as_py(), np.uint32) for c in rows.column("counts")]).astype(np.int64)
    order = np.argsort(flat, kind="stable")
    opens = np.ones(len(flat), bool)
    opens[1:] = flat[order][1:] != flat[order][:-1]
    start = np.flatnonzero(opens)
    total = np.add.reduceat(counts[order], start)
    out = np.empty(len(flat), np.int64)
    out[order] = np.repeat(total, np.diff(np.append(start, len(flat))))
    words = 0
    if rows.column("order")[0].as_py() == 1:  # the begin is no token of the text
        words = int((total[flat[order][start] != BEGIN] > 0).sum())
    known = [words] + [0] * (rows.num_rows - 1)
    return pa.table({"part": rows.column("part"), "order": rows.column("order"), "slice": rows.column("slice"),
                     "totals": pa.array([planes(out[a:b]) for a, b in zip(size, size[1:])], pa.binary()),
                     "words": pa.array(known, pa.int64())})


class Automaton:
    """States and arcs that the tokens of a part can reach. State 0 is the root."""

    def __init__(self, tokens: np.ndarray, first: np.ndarray, totals: list[np.ndarray], mass: float, n: int, v: int):
        self.order, size = len(totals), len(tokens)
        #: the arc of each token out of a state of each depth; -1: there is none
        self.arcs = np.full((self.order, size), -1, np.int32)
        self.count = np.zeros(size, np.int64)  # of each token, in the learning texts
        weight, target, back, fail, depth = [], [], [np.zeros(1)], [np.zeros(1, np.int32)], [np.zeros(1, np.int8)]
        arcs, states = 0, 1
        shorter_of = np.zeros(size, np.int32)  # which n-gram of the order before ends at a token
        shorter_p = shorter_state = shorter_count = np.zeros(0)
        for k, (ends, hashes) in enumerate(grams(tokens, first, self.order), 1):
            _, at, of = np.unique(hashes, return_index=True, return_inverse=True)
            del hashes
            count, at, of = totals[k - 1], ends[at], of.astype(np.int32)  # at: a place of each n-gram
            real = count > 0
            if k == 1:
                p = (count + 1) / (n + v + 1)
                self.count[ends] = count[of]
                held = np.ones(len(at), bool)
                suffix = np.zeros(len(at), np.int32)
            else:
                rest = shorter_of[at]
                p = (count + mass * shorter_p[rest]) / (shorter_count[shorter_of[at - 1]] + mass)
                held = real
                suffix = shorter_state[rest]
            del at
            arc = np.where(held, arcs + np.cumsum(held) - 1, -1).astype(np.int32)
            state = suffix
            if k < self.order:  # n-grams that a text goes on from are states
                state = np.where(real, states + np.cumsum(real) - 1, suffix).astype(np.int32)
                back.append(np.log10(mass / (count[real] + mass)))
                fail.append(suffix[real])
                depth.append(np.full(int(real.sum()), k, np.int8))
                states += int(real.sum())
            weight.append(np.log10(p[held]))
            target.append(state[held])
            arcs += int(held.sum())
            self.arcs[k - 1, ends] = arc[of]
            shorter_p, shorter_state, shorter_count = p, state, count
            shorter_of[ends] = of
        self.weight, self.target = np.concatenate(weight), np.concatenate(target)
        self.back, self.fail, self.depth = map(np.concatenate, (back, fail, depth))

    def read(self, first: np.ndarray, lane: int = LANE) -> np.ndarray:
        """Weight of each text, read from left to right.

        Texts are cut into lanes that run side by side. A lane begins at the root ``order`` - 1 tokens before its own
        and counts from its own on: the state depends on no more than these.
        """
        length = np.diff(first)
        lanes = -(-length // lane)
        text = np.repeat(np.arange(len(length)), lanes)
        cut = (np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)) * lane
        own = first[text] + cut
        end = np.minimum(own + lane, first[text + 1])
        at = np.maximum(own - self.order + 1, first[text])
        counted = np.maximum(own, first[text] + 1)  # the begin of a text has no weight
        state, total, arcs = np.zeros(len(text), np.int32), np.zeros(len(text)), self.arcs
        live = np.arange(len(text))
        while len(live):
            here, now = at[live], state[live]
            gain = np.zeros(len(live))
            arc = arcs[self.depth[now], here]
            stuck = np.flatnonzero(arc < 0)
            while len(stuck):
                gain[stuck] += self.back[now[stuck]]
                now[stuck] = self.fail[now[stuck]]
                arc[stuck] = arcs[self.depth[now[stuck]], here[stuck]]
                stuck = stuck[arc[stuck] < 0]
            gain += self.weight[arc]
            total[live] += np.where(here >= counted[live], gain, 0.0)
            state[live] = self.target[arc]
            at[live] += 1
            live = live[at[live] < end[live]]
        return np.bincount(text, total, len(length))


def _scored(order: int, mass: float, n: int, v: int):
    def work(parts: pa.Table, answers: pa.Table) -> pa.Table:
        part = parts.to_pylist()[0]
        tokens, first, _ = _unpacked(part)
        answers = answers.combine_chunks().sort_by([("order", "ascending"), ("slice", "ascending")])
        packed, orders = answers.column("totals").to_pylist(), answers.column("order").to_pylist()
        totals = [np.concatenate([np.zeros(0, np.int64), *[from_planes(t, np.int64) for t, o in zip(packed, orders) if o == k]])
                  for k in range(1, order + 1)]
        machine = Automaton(tokens, first, totals, mass, n, v)
        inner = np.ones(len(tokens), bool)
        inner[first[:-1]] = False
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))[inner]
        count = machine.count[inner]
        return pa.table({
            "key": parts.column("keys").combine_chunks().flatten(), "n_tokens": np.diff(first) - 1,
            "n_known": np.bincount(text, count > 0, len(first) - 1).astype(np.int64),
            "base_score": np.bincount(text, np.log10((count + 1) / (n + v + 1)), len(first) - 1),
            "score": machine.read(first)})

    return work


def scored(docs: DataFrame, learns, key: str = "doc_id", text: str = "text", order: int = 3, mass: float = 1000.0,
           part_bytes: int = PART_BYTES, slice_grams: int = SLICE) -> DataFrame:
    """``key``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row of ``docs``.

    The model counts the rows for which the condition ``learns`` holds (null: it does not). Words are split at
    ASCII white space, A-Z lower-cased; an end follows them and counts as a token. ``base_score`` is the sum of
    ``log10((C + 1) / (N + V + 1))`` over the tokens, ``score`` that of the automaton. Null texts are empty ones and
    consist of their end; without a row to learn from all tokens are unknown and weigh nothing. Each row is scored
    and counts by itself, also rows that share a key or a text, or have none. Other columns are ignored.

    N-grams of more than one token are told apart by 56 bits of hash, words by 64.
    """
    kind = dict(docs.select(F.col(key).alias("key")).dtypes)["key"]
    rows = docs.select(F.col(key).alias("key"), F.coalesce(learns, F.lit(False)).alias("learns"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    arrow_step(lambda batch: None, "text")  # wide rows travel in smaller batches
    parts = saved(rows.mapInArrow(
        lambda batches: _parts(batches, part_bytes),
        f"part long, taught long, held long, keys array<{kind}>, learns array<boolean>, lengths binary, "
        "vocabulary binary, tokens binary"), "parts")
    size = parts.agg(F.sum("taught").alias("taught"), F.sum("held").alias("held")).first()
    n, slices = size.taught or 0, max(-(-(size.held or 0) * order // slice_grams), 1)
    answers = saved(
        parts.mapInArrow(_asked(order, slices), "slice int, order int, part long, hashes binary, counts binary")
        .groupBy("slice", "order").applyInArrow(_answered, "part long, order int, slice int, totals binary, words long"),
        "counts")
    v = answers.agg(F.sum("words")).first()[0] or 0
    out = parts.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
        _scored(order, mass, n, v), f"key {kind}, n_tokens long, n_known long, base_score double, score double")
    return out.select(F.col("key").alias(key), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                      "base_score", "score")
