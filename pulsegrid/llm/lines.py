"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's features are shares of kinds of characters, word lengths and repeats, its
own and those of the lines before and after it. Forward-backward gives each line its probability of being
good; weighted by length they make the document's share of good text, which a logistic step turns into a
score. Labels are of documents: a line of a good document is taken as good, and in a bad document the lines
that the model of good ones recognises are taken back as good before the last fit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import SPACE, arrow_step, byte_view, mix, space_words, steps, word_hashes

# kinds of bytes
_KIND = np.zeros(256, np.uint8)
for _n, _members in enumerate((range(97, 123), range(65, 91), range(48, 58), b" \t\r\x0b\x0c", b".,;:'\"-()?",
                               b"!", b"|", b"#$%&*", b"<>{}[]=/\\_@^~`+"), 1):
    _KIND[list(_members)] = _n
_KIND[128:] = 10
KINDS = 11
OWN = KINDS + 6
WIDTH = 3 * OWN + 2


def line_spans(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every line that holds more than white space."""
    breaks = np.flatnonzero(data == 10)
    opens = ends[:-1][ends[1:] > ends[:-1]]
    start = np.union1d(opens, breaks[breaks + 1 < len(data)] + 1) if len(data) else opens
    owner = np.searchsorted(ends, start, side="right") - 1
    stops = np.concatenate([breaks, [len(data)]])
    end = np.minimum(stops[np.searchsorted(stops, start)], ends[owner + 1])
    full = np.concatenate([[0], np.cumsum(~SPACE[data])])
    keep = full[end] > full[start]
    return start[keep], end[keep], owner[keep]


def _again(of: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Which elements repeat an earlier equal value of the same owner."""
    order = np.lexsort((value, of))
    same = np.zeros(len(of), bool)
    same[1:] = (value[order][1:] == value[order][:-1]) & (of[order][1:] == of[order][:-1])
    out = np.zeros(len(of), bool)
    out[order] = same
    return out


def line_features(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own features of each line, its length in bytes, and its text's number."""
    start, end, owner = line_spans(data, ends)
    size = (end - start).astype(np.float64)
    out = np.zeros((len(start), OWN), np.float32)
    if not len(start):
        return out, size, owner
    kind = _KIND[data]
    for k in range(KINDS):
        at = np.concatenate([[0], np.cumsum(kind == k, dtype=np.int64)])
        out[:, k] = (at[end] - at[start]) / size
    first, last, _ = space_words(data, ends)
    line = np.searchsorted(start, first, side="right") - 1
    count = np.maximum(np.bincount(line, minlength=len(start)), 1)
    hashes = word_hashes(data, first, last)
    long = last - first
    out[:, KINDS] = np.log1p(size) / 8
    out[:, KINDS + 1] = np.bincount(line, long, len(start)) / count / 10
    out[:, KINDS + 2] = np.bincount(line, long > 20, len(start)) / count
    out[:, KINDS + 3] = np.bincount(line, _again(line, hashes), len(start)) / count
    out[:, KINDS + 4] = np.bincount(line, _again(owner[line], hashes), len(start)) / count
    out[:, KINDS + 5] = _again(owner, mix(word_hashes(data, start, end)))
    return out, size, owner


def with_neighbours(own: np.ndarray, of: np.ndarray) -> np.ndarray:
    """A line's features, those of the lines beside it in its text (zero where there is none), whether it is
    alone, and a constant."""
    x = np.zeros((len(own), WIDTH), np.float32)
    x[:, :OWN] = own
    if len(own) > 1:
        same = of[1:] == of[:-1]
        x[1:, OWN:2 * OWN][same] = own[:-1][same]
        x[:-1, 2 * OWN:3 * OWN][same] = own[1:][same]
        x[1:, -2] += same
        x[:-1, -2] += same
    x[:, -1] = 1
    return x


def _order(of: np.ndarray) -> list[np.ndarray]:
    """Lines by their place in their text: the first lines of all texts, the second ones, ..."""
    if not len(of):
        return []
    new = np.concatenate([[True], of[1:] != of[:-1]])
    begin = np.flatnonzero(new)
    place = np.arange(len(of)) - begin[np.cumsum(new) - 1]
    order = np.argsort(place, kind="stable")
    return np.split(order, np.cumsum(np.bincount(place))[:-1])


def forward_backward(odds: np.ndarray, moves: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log odds of good against bad from the lines up to each line, from the lines after it, and the
    probability of good. ``moves[i, j]`` is the weight of a line in state j after one in state i."""
    ahead, behind = odds.astype(np.float64).copy(), np.zeros(len(odds))
    turns = _order(of)
    join = np.logaddexp
    for now in turns[1:]:
        a = ahead[now - 1]
        ahead[now] += join(a + moves[1, 1], moves[0, 1]) - join(a + moves[1, 0], moves[0, 0])
    for now in reversed(turns[1:]):
        b = odds[now] + behind[now]
        behind[now - 1] = join(moves[1, 1] + b, moves[1, 0]) - join(moves[0, 1] + b, moves[0, 0])
    return ahead, behind, 1 / (1 + np.exp(-(ahead + behind)))


@dataclass
class LineModel:
    """Weights of the features, of the moves between states, and of the step from share to score."""

    weights: np.ndarray
    moves: np.ndarray
    scale: float = 1.0
    offset: float = 0.0

    def shares(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: length-weighted share of good text (0.5 without lines), lines, lines that are bad."""
        own, size, of = line_features(data, ends)
        return self.summed(with_neighbours(own, of), size, of, len(ends) - 1)

    def summed(self, x: np.ndarray, size: np.ndarray, of: np.ndarray, rows: int):
        good = forward_backward(x @ self.weights, self.moves, of)[2]
        total = np.bincount(of, size, rows)
        share = np.where(total > 0, np.bincount(of, size * good, rows) / np.maximum(total, 1), 0.5)
        return share, np.bincount(of, minlength=rows), np.bincount(of, good < 0.5, rows).astype(np.int64)

    def score(self, share: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale * share + self.offset)))


def _fit_chain(x, of, y, weight, rounds=150, rate=0.1, decay=1e-4):
    """Gradient ascent (Adam) on the likelihood of line labels ``y``."""
    model = np.zeros(WIDTH + 4)
    one, two = np.zeros_like(model), np.zeros_like(model)
    pair = np.flatnonzero(of[1:] == of[:-1])
    for step in range(1, rounds + 1):
        odds, moves = x @ model[:WIDTH], model[WIDTH:].reshape(2, 2)
        ahead, behind, good = forward_backward(odds, moves, of)
        grad = np.zeros_like(model)
        grad[:WIDTH] = x.T @ (weight * (y - good))
        if len(pair):
            left, right = ahead[pair], odds[pair + 1] + behind[pair + 1]
            joint = np.stack([moves[i, j] + i * left + j * right for i in (0, 1) for j in (0, 1)])
            joint = np.exp(joint - np.logaddexp.reduce(joint, axis=0))
            real = y[pair].astype(int) * 2 + y[pair + 1].astype(int)
            for k in range(4):
                grad[WIDTH + k] = ((real == k) - joint[k]) @ weight[pair]
        grad = grad / weight.sum() - decay * model
        one, two = 0.9 * one + 0.1 * grad, 0.999 * two + 0.001 * grad**2
        model = model + rate * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.999**step)) + 1e-8)
    return model[:WIDTH], model[WIDTH:].reshape(2, 2)


def fit(texts: list[str], quality: np.ndarray, prior: float) -> LineModel:
    """Fit on whole labelled texts; ``prior`` is the share of good ones among all labelled rows."""
    parts, first = [], 0
    for piece in steps(pa.record_batch({"text": pa.array(texts, pa.string())}), "text"):
        own, size, of = line_features(*byte_view(piece.column(0)))
        parts.append((with_neighbours(own, of), size, of + first))
        first += piece.num_rows
    x, size, of = (np.concatenate(p) for p in zip(*parts))
    doc = quality.astype(float)
    share = max(min(doc.mean(), 0.999), 0.001)
    even = np.where(doc > 0, 0.5 / share, 0.5 / (1 - share))
    y = doc[of]
    weights, moves = _fit_chain(x, of, y, even[of])
    good = forward_backward(x @ weights, moves, of)[2]
    # lines of bad documents that look good are good; the worst line of a bad document stays bad
    worst = np.full(len(texts), 2.0)
    np.minimum.at(worst, of, good)
    y = np.where((doc[of] == 0) & (good > 0.5) & (good > worst[of]), 1.0, y)
    model = LineModel(*_fit_chain(x, of, y, even[of]))
    value = model.summed(x, size, of, len(texts))[0]
    real = np.where(doc > 0, prior / share, (1 - prior) / (1 - share))
    z = np.zeros(2)
    f = np.stack([value, np.ones_like(value)], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-(f @ z)))
        slope = f.T @ (real * (doc - p)) - 1e-3 * z
        curve = (f * (real * p * (1 - p))[:, None]).T @ f + 1e-3 * np.eye(2)
        z = z + np.clip(np.linalg.solve(curve, slope), -5, 5)
    model.scale, model.offset = float(z[0]), float(z[1])
    return model


def held_out(key: str = "doc_id"):
    """Rows that no label may be learnt from."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          sample_docs: int = 1000, sample_bytes: int = 50_000) -> LineModel:
    """Fit on labelled rows outside the held-out quarter: of each class at most ``sample_docs`` documents of
    at most ``sample_bytes`` bytes, those whose key has the smallest hash. Without any, every score is 0.5."""
    rows = (labels.select(F.col(key).alias("doc"), F.col(label).cast("int").alias("y"))
            .where(F.col("doc").isNotNull() & F.col("y").isin(0, 1)).distinct().where(~held_out("doc")))
    prior = rows.agg(F.avg("y")).first()[0]
    if prior is None:
        return LineModel(np.zeros(WIDTH, np.float32), np.zeros((2, 2)), 0.0)
    texts = docs.select(F.col(key).alias("doc"), F.col(text).cast("string").alias("text")).where(
        F.octet_length("text") <= sample_bytes)
    found = []
    for y in (0, 1):
        # twice as many keys as documents, for those without a text of that length
        some = rows.where(F.col("y") == y).orderBy(F.xxhash64("doc"), "doc").limit(2 * sample_docs)
        found += (texts.join(F.broadcast(some), "doc").orderBy(F.xxhash64("doc"), "doc", "text").limit(sample_docs)
                  .select("text", "y").collect())
    if not found:
        return LineModel(np.zeros(WIDTH, np.float32), np.zeros((2, 2)), 0.0)
    return fit([r.text for r in found], np.array([r.y for r in found]), float(prior))


def scored(docs: DataFrame, model: LineModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``score`` (0 to 1), ``n_lines`` and ``n_bad_lines`` of every row of ``docs``. A null or empty
    text has no line; its share of good text counts as one half."""

    def work(batch: pa.RecordBatch) -> pa.Table:
        share, lines, bad = model.shares(*byte_view(batch.column(1)))
        return pa.table({"key": batch.column(0), "score": model.score(share), "n_lines": lines, "n_bad_lines": bad})

    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = dict(source.dtypes)["key"]
    return (source.mapInArrow(arrow_step(work, "text"), f"key {kind}, score double, n_lines long, n_bad_lines long")
            .withColumnRenamed("key", key))


def keep_good(docs: DataFrame, model: LineModel, text: str = "text", least: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``least``, with all their columns."""
    schema = docs.schema

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(batch.schema.get_field_index(text))
        return batch.filter(pa.array(model.score(model.shares(*byte_view(column))[0]) >= least))

    return docs.mapInArrow(arrow_step(work, text), schema)
