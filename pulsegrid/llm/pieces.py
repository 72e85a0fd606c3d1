"""SentencePiece encoding and decoding by a streaming Viterbi over the lattice of pieces.

The best segmentation is the one with the largest sum of piece scores; characters without a piece become
byte pieces. Boundaries are visited from left to right. Only those that a piece can still reach are kept, at
most the longest piece ahead; whenever all paths that survive meet in one boundary, the ids up to it are
settled and their backpointers go. Blanks always settle: no piece of the vocabulary runs from a letter over a
blank. A run between such boundaries has the same ids everywhere, so short runs are done
many at once and remembered.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import arrow_step

#: runs of up to this many characters are remembered, and this many of them
SHORT, REMEMBERED = 40, 100_000
BLANK = "▁"


class Pieces:
    """Encoder and decoder of the vocabulary in a SentencePiece model file's bytes."""

    def __init__(self, model: bytes):
        vocabulary = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(vocabulary.get_piece_size())
        byte = {i: int(vocabulary.id_to_piece(i)[3:5], 16) for i in ids if vocabulary.is_byte(i)}
        plain = {vocabulary.id_to_piece(i).replace(BLANK, " "): i for i in ids if i not in byte
                 and not (vocabulary.is_control(i) or vocabulary.is_unknown(i) or vocabulary.is_unused(i))}
        self.score = [vocabulary.get_score(i) for i in ids]
        self.byte_score = min(self.score[i] for i in plain.values()) - 10
        self.bytes = {v: k for k, v in byte.items()}
        self.decoded = [bytes([byte[i]]) if i in byte else b"" for i in ids]
        for piece, i in plain.items():
            self.decoded[i] = piece.encode()
        self.longest = max(map(len, plain))
        # every beginning of a piece, with the piece's id if it is one
        self.begins: dict[str, int] = {}
        for piece in plain:
            for k in range(1, len(piece)):
                self.begins.setdefault(piece[:k], -1)
        self.begins |= plain
        joined = {c for p in plain if len(p) > 1 for c in p}
        crossed = any(re.search("[^ ] ", p) for p in plain)
        alone = "".join(c for c in "\n\t\r" if c not in joined)
        self.runs = re.compile(rf"[{alone}]| *[^ {alone}]+| +" if alone else " *[^ ]+| +") if not crossed else None
        self.known: dict[str, bytes] = {}
        self._tables(plain)

    def _tables(self, plain: dict[str, int]) -> None:
        """The beginnings of pieces as a table of next states, for characters that are pieces themselves."""
        letters = sorted(c for c in plain if len(c) == 1 and ord(c) < 0x250)
        self.code = np.zeros(0x251, np.int16)
        self.code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        state = {"": 0}
        for begin in self.begins:
            if all(ord(c) < 0x250 and self.code[ord(c)] for c in begin):
                state[begin] = len(state)
        dead = len(state)
        self.after = np.full((dead + 1, len(letters) + 1), dead, np.uint16 if dead < 1 << 16 else np.int32)
        self.piece = np.full(dead + 1, -1, np.int32)
        self.gain = np.full(dead + 1, -np.inf)
        for begin, at in state.items():
            if begin:
                self.after[state[begin[:-1]], self.code[ord(begin[-1])]] = at
                if self.begins[begin] >= 0:
                    self.piece[at], self.gain[at] = self.begins[begin], self.score[self.begins[begin]]

    def _together(self, runs: list[str], length: int) -> list[str]:
        """Ids of many short runs of one length at once, by the same recursion; returns those it cannot do."""
        points = np.frombuffer("".join(runs).encode("utf-32-le"), np.uint32).reshape(-1, length)
        codes = self.code[np.minimum(points, 0x250)]
        able = (codes > 0).all(axis=1)
        rest = [runs[i] for i in np.flatnonzero(~able)]
        codes, rows = codes[able].T, np.flatnonzero(able)
        n = len(rows)
        if not n:
            return rest
        best = np.full((length + 1, n), -np.inf)
        best[0] = 0
        start, last = np.zeros((length + 1, n), np.int8), np.zeros((length + 1, n), np.int32)
        for i in range(length):
            at = np.zeros(n, np.int32)
            for j in range(i, min(length, i + self.longest)):
                at = self.after[at, codes[j]]
                cost = best[i] + self.gain[at]
                better = np.flatnonzero(cost > best[j + 1])
                if len(better):
                    best[j + 1, better] = cost[better]
                    start[j + 1, better] = i
                    last[j + 1, better] = self.piece[at[better]]
        spot, columns, each = np.full(n, length), [], np.arange(n)
        while spot.any():
            columns.append(np.where(spot > 0, last[spot, each], -1))
            spot = np.where(spot > 0, start[spot, each], 0)
        table = np.stack(columns[::-1], axis=1)
        kept = table >= 0
        plain, ends = table[kept].tobytes(), (4 * np.cumsum(kept.sum(axis=1))).tolist()
        begin = 0
        for row, end in zip(rows.tolist(), ends):
            self.known[runs[row]] = plain[begin:end]
            begin = end
        return rest

    def _learn(self, runs: set[str]) -> None:
        """Remember the ids of runs that are not known."""
        by_length: dict[int, list[str]] = {}
        for run in runs:
            if len(run) <= SHORT:
                by_length.setdefault(len(run), []).append(run)
        for length, same in by_length.items():
            for run in self._together(same, length):
                self.known[run] = self._alone(run)

    def stream(self, text: str) -> Iterator[list[int]]:
        """Ids of ``text`` as they are settled."""
        begins, score, n = self.begins, self.score, len(text)
        best: dict[int, float] = {0: 0.0}
        back: dict[int, tuple[int, int]] = {}
        settled, far, wait = 0, 0, 2 * self.longest
        for i in range(n):
            here = best.pop(i)
            if text[i:i + 1] not in begins or begins[text[i]] < 0:
                cost = here + self.byte_score * len(text[i].encode())
                if i + 1 not in best or cost > best[i + 1]:
                    best[i + 1], back[i + 1] = cost, (i, -1)
                far = max(far, i + 1)
            for j in range(i + 1, min(i + self.longest, n) + 1):
                found = begins.get(text[i:j])
                if found is None:
                    break
                if found >= 0:
                    cost = here + score[found]
                    if j not in best or cost > best[j]:
                        best[j], back[j] = cost, (i, found)
                    far = max(far, j)
            meet = settled
            if far == i + 1:
                meet = i + 1
            elif i - settled >= wait:
                meet = self._meeting(best, back, settled)
                wait *= 2  # as long as they do not meet, ask less and less often
            if meet > settled:
                yield self._path(text, back, settled, meet)
                for k in range(settled + 1, meet + 1):
                    back.pop(k, None)
                settled, wait = meet, 2 * self.longest

    @staticmethod
    def _meeting(best, back, settled: int) -> int:
        """The last boundary that the paths to all open boundaries share."""
        common: set[int] | None = None
        for at in best:
            path = set()
            while at > settled:
                at = back[at][0]
                path.add(at)
            common = path if common is None else common & path
        return max(common or {settled})

    def _path(self, text: str, back, start: int, end: int) -> list[int]:
        out: list[int] = []
        while end > start:
            begin, piece = back[end]
            out += [piece] if piece >= 0 else [self.bytes[b] for b in reversed(text[begin:end].encode())]
            end = begin
        return out[::-1]

    def _alone(self, run: str) -> bytes:
        return np.array([i for part in self.stream(run) for i in part], np.int32).tobytes()

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; a blank is put before it, as the vocabulary expects. An empty text has none."""
        split = [(self.runs.findall(" " + t) if self.runs else [" " + t]) if t else [] for t in texts]
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        self._learn({r for runs in split for r in runs}.difference(known))
        return [np.frombuffer(b"".join([known[r] if r in known else self._alone(r) for r in runs]), np.int32)
                for runs in split]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids) -> str:
        return b"".join(map(self.decoded.__getitem__, np.asarray(ids).tolist())).decode()[1:]


def load(path: str) -> bytes:
    """The model file's bytes, read on the driver (under a megabyte) and sent with the tasks."""
    with open(path, "rb") as file:
        return file.read()


def _held(model: bytes) -> Pieces:
    """One encoder per Python worker."""
    global _pieces
    key = hashlib.sha256(model).hexdigest()
    if "_pieces" not in globals() or _pieces[0] != key:
        _pieces = (key, Pieces(model))
    return _pieces[1]


def encoded(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``ids`` and ``n_ids`` of every row of ``docs``; a null or empty text has no ids. Other columns
    are ignored."""
    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def work(batch: pa.RecordBatch) -> pa.Table:
        pieces = _held(model)
        ids = pieces.encode_all([t or "" for t in batch.column(1).to_pylist()])
        ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
        return pa.table({"key": batch.column(0), "ids": pa.ListArray.from_arrays(ends, np.concatenate(ids)),
                         "n_ids": np.diff(ends).astype(np.int64)})

    kind = dict(source.dtypes)["key"]
    return (source.mapInArrow(arrow_step(work, "text"), f"key {kind}, ids array<int>, n_ids long")
            .withColumnRenamed("key", key))


def decoded(rows: DataFrame, model: bytes, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and the ``text`` that the ids of each row stand for; null ids give an empty text."""
    source = rows.select(F.col(key).alias("key"), F.col(ids).cast("array<int>").alias("ids"))

    def work(batches):
        for batch in batches:
            pieces = _held(model)
            text = [pieces.decode(i or []) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], ["key", "text"])

    kind = dict(source.dtypes)["key"]
    return source.mapInArrow(work, f"key {kind}, text string").withColumnRenamed("key", key)


def round_trips(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, ``n_bytes``, ``n_ids``, ``ids_sha256`` (of the ids as little-endian 32-bit numbers) and
    whether decoding gives the text back."""
    source = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def work(batch: pa.RecordBatch) -> pa.Table:
        pieces = _held(model)
        texts = batch.column(1).to_pylist()
        ids = pieces.encode_all(texts)
        return pa.table({
            "key": batch.column(0), "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()),
            "n_ids": pa.array([len(i) for i in ids], pa.int64()),
            "ids_sha256": [hashlib.sha256(i.astype("<i4").tobytes()).hexdigest() for i in ids],
            "round_trip": [pieces.decode(i) == t for i, t in zip(ids, texts)]})

    kind = dict(source.dtypes)["key"]
    return (source.mapInArrow(arrow_step(work, "text"),
                              f"key {kind}, n_bytes long, n_ids long, ids_sha256 string, round_trip boolean")
            .withColumnRenamed("key", key))
