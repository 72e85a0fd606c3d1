"""Token counts of fields and sections from one encoding of the whole document.

A document is encoded once. Tokens of a byte-level vocabulary are the document's bytes cut into runs, so their
ends are a running sum of their lengths, and an interval join inside the document maps them to sections. A
token over the border of two sections goes by one of three rules: ``largest`` (the section with most of its
bytes, the earlier one if equal), ``first`` (the section of its first byte that lies in one), ``share`` (to each
in proportion to its bytes).
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import arrow_step

#: fixed value: how the byte-level vocabularies cut text into words
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("largest", "first", "share")
#: runs of white space that are too long for the encoder's pattern
_LONG_BLANK = regex.compile(r"\p{White_Space}{10000,}")


class Encoder:
    """Encoder of a vocabulary in rank format (base64 token and id on each line)."""

    def __init__(self, ranks: bytes, pattern: str):
        held = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=held, special_tokens={})
        self.length = np.zeros(max(held.values()) + 1, np.int64)
        for token, i in held.items():
            self.length[i] = len(token)

    def ids(self, text: str) -> list[int]:
        """Token ids. The pattern takes a run of white space but for its last character as one word (all of it at
        the end), so a long run is encoded as that word, apart from the texts before and after it."""
        out: list[int] = []
        at = 0
        for run in _LONG_BLANK.finditer(text):
            stop = run.end() - (run.end() < len(text))
            out += self.encoding.encode_ordinary(text[at:run.start()])
            out += self.encoding._encode_single_piece(text[run.start():stop])
            at = stop
        return out + self.encoding.encode_ordinary(text[at:] if at else text)

    def ends(self, text: str) -> np.ndarray:
        """Byte offset at which each token of ``text`` ends."""
        return np.cumsum(self.length[np.array(self.ids(text), np.int64)])


def _held(ranks: bytes, pattern: str) -> Encoder:
    """One encoder per Python worker."""
    global _encoder
    key = hashlib.sha256(ranks + pattern.encode()).hexdigest()
    if "_encoder" not in globals() or _encoder[0] != key:
        _encoder = (key, Encoder(ranks, pattern))
    return _encoder[1]


def load(path: str) -> bytes:
    """The vocabulary file's bytes, read on the driver (under a megabyte) and sent with the tasks."""
    with open(path, "rb") as file:
        return file.read()


def allocate(ends: np.ndarray, start: np.ndarray, stop: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Tokens of each section, tokens in it that reach beyond it into another one, and tokens in no section.
    Sections are disjoint and in order."""
    begin = np.concatenate([[0], ends[:-1]])
    first = np.searchsorted(stop, begin, side="right")
    last = np.searchsorted(start, ends, side="left") - 1
    count = np.maximum(last - first + 1, 0)
    token = np.repeat(np.arange(len(ends)), count)
    section = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - first, count)
    overlap = np.minimum(ends[token], stop[section]) - np.maximum(begin[token], start[section])
    kept = overlap > 0  # an empty section holds nothing
    token, section, overlap = token[kept], section[kept], overlap[kept]
    hits = np.bincount(token, minlength=len(ends))
    crossing = np.bincount(section[hits[token] > 1], minlength=len(start))
    if rule == "share":
        total = np.bincount(token, overlap, len(ends))
        weight = np.bincount(section, overlap / total[token], len(start))
    else:
        order = np.lexsort((section, -overlap, token)) if rule == "largest" else np.lexsort((section, token))
        chosen = section[order][np.concatenate([[True], np.diff(token[order]) > 0])] if len(token) else section
        weight = np.bincount(chosen, minlength=len(start)).astype(float)
    return weight, crossing, int((hits == 0).sum())


def line_sections(text: Column) -> Column:
    """Every line with the line break that ends it, as (name, start, stop) in bytes; nothing for no text."""
    lines = F.split(text, "\n")
    sizes = F.transform(lines, lambda x, i: F.octet_length(x) + F.when(i < F.size(lines) - 1, 1).otherwise(0))
    stops = F.aggregate(sizes, F.array().cast("array<int>"), lambda held, x: F.concat(
        held, F.array(F.coalesce(F.try_element_at(held, F.lit(-1)), F.lit(0)) + x)))
    return F.transform(stops, lambda x, i: F.struct(i.cast("string").alias("name"), (x - sizes[i]).alias("start"), x.alias("stop")))


def joined_fields(rows: DataFrame, key: str, columns: list[str], between: str = "\n") -> DataFrame:
    """(key, text, sections): several columns as one text, with a section for each that is not null."""
    parts = F.filter(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns]),
                     lambda p: p["value"].isNotNull())
    gap = len(between.encode())
    before = F.transform(parts, lambda p, i: F.aggregate(
        F.slice(parts, 1, i), F.lit(0), lambda n, q: n + F.octet_length(q["value"]) + gap))
    return rows.select(F.col(key), F.array_join(F.transform(parts, lambda p: p["value"]), between).alias("text"),
                       F.transform(parts, lambda p, i: F.struct(
                           p["name"].alias("name"), before[i].alias("start"),
                           (before[i] + F.octet_length(p["value"])).alias("stop"))).alias("sections"))


def attributed(docs: DataFrame, ranks: bytes, key: str = "doc_id", text: str = "text", sections: str | None = None,
               rule: str = "largest", pattern: str = PATTERN) -> DataFrame:
    """(key, section, n_bytes, n_tokens, n_crossing) for every section of every row of ``docs``.

    ``sections`` names a column of (name, start, stop) in bytes, disjoint and in order; by default every line
    with its line break is one, numbered from 0. ``n_tokens`` counts tokens by ``rule``; ``n_crossing`` those that
    reach into another section. Tokens in no section are counted in a row with a null section. A null or empty
    text has no sections and no rows. Other columns are ignored.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {', '.join(RULES)}")
    columns = [F.col(key).alias("key"), F.col(text).cast("string").alias("text")]
    if sections is not None:
        columns.append(F.col(sections).cast("array<struct<name: string, start: int, stop: int>>").alias("sections"))
    source = docs.select(*columns)

    def work(batch: pa.RecordBatch) -> pa.Table:
        encoder = _held(ranks, pattern)
        row, name, size, tokens, crossing = [], [], [], [], []
        given = batch.column(2).to_pylist() if sections is not None else None
        for i, t in enumerate(batch.column(1).to_pylist()):
            if not t:
                continue
            if given is None:
                plain = np.frombuffer(t.encode(), np.uint8)
                stop = np.flatnonzero(plain == 10) + 1
                if not len(stop) or stop[-1] < len(plain):
                    stop = np.append(stop, len(plain))
                start = np.concatenate([[0], stop[:-1]])
                names = list(map(str, range(len(stop))))
            else:
                held = [s for s in given[i] or [] if s is not None]
                start, stop = (np.array([s[c] for s in held], np.int64) for c in ("start", "stop"))
                names = [s["name"] for s in held]
            weight, cross, outside = allocate(encoder.ends(t), start, stop, rule)
            if outside:
                start, stop = np.append(start, 0), np.append(stop, 0)
                weight, cross, names = np.append(weight, outside), np.append(cross, 0), [*names, None]
            row.append(np.full(len(start), i))
            name += names
            size.append(stop - start)
            tokens.append(weight)
            crossing.append(cross)
        if not name:
            return pa.table({"key": batch.column(0).slice(0, 0)})
        join = np.concatenate
        return pa.table({"key": batch.column(0).take(pa.array(join(row))), "section": pa.array(name, pa.string()),
                         "n_bytes": join(size).astype(np.int64), "n_tokens": join(tokens).astype(np.float64),
                         "n_crossing": join(crossing).astype(np.int64)})

    kind = dict(source.dtypes)["key"]
    return (source.mapInArrow(arrow_step(work, "text"), f"key {kind}, section string, n_bytes long, n_tokens double, n_crossing long")
            .withColumnRenamed("key", key))
