"""Removal of repeated byte strings by bucket-pointer refinement.

A byte goes if some string of ``n`` bytes over it also starts in a document with a smaller key. Four steps
find those strings without moving every suffix:

1. Texts are cut at content-defined places. A piece (with the bytes that its last strings reach into) that a
   smaller document holds too is removed as a whole; only the first document's copy is searched further.
2. Every string of ``n`` bytes has one anchor: its ``GRAM`` bytes with the smallest hash, where those that are very
   frequent in the corpus come last: so a string that only borders on a common line takes its anchor outside of
   it. Consecutive strings with one anchor are one stretch. Texts are dealt into groups of about ``GROUP_BYTES``; a group
   sends short prints of its anchors, sorted and as differences, and gets back those that several documents hold.
   Only the stretches of these travel.
3. Stretches of one anchor meet in one task. There all their suffixes are sorted by bucket-pointer
   refinement: the first buckets are q-grams, and each round sorts by the pair of a suffix's own bucket and
   the bucket of the suffix as many bytes later, so the pointers of one round double the depth of the next.
   Suffixes that share a bucket at depth ``n`` are equal, and all but the smallest document's go.
4. The removed spans meet the texts again.

Equal stretches and pieces of one step are settled in that step, so a passage that very many documents share
sends one row per step; where an anchor lies in a quarter of the texts of a group, its strings travel one by one,
keyed by their content.
"""

from __future__ import annotations

import hashlib

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import _BASE, _BYTE, _INVERSE, arrow_step, byte_view, mix, powers, steps
from .tables import saved

GRAM = 16
#: mean and largest bytes of a piece
PIECE, LONGEST = 512, 1 << 18
#: an anchor in so many documents of one group, and in so large a share of its texts, has its strings travel
#: one by one; with a smaller share the stretches of an anchor are one task's work
FREQUENT, SHARE = 64, 0.25
#: bytes of text of a group: most groups are one step
GROUP_BYTES = 750_000
#: bytes of text whose anchors are held against each other at a time
BUCKET_BYTES = 16_000_000
#: bits of an anchor's print beyond those that number the anchors: one in 2 ** SPARE meets another by chance, and its
#: stretch travels for nothing
SPARE = 8
#: grams that occur as often as this share of the documents are taken as anchors last; how many of them, at most,
#: and bits of the table that marks them
COMMON, MOST, TABLE = 0.02, 100_000, 22
#: bytes of text whose anchors are taken at a time
CACHED_BYTES = 64_000
#: bytes of stretches that are sorted at a time
SORTED_BYTES = 100_000


_TABLES: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    if n > 1 << 20:
        return powers(base, n)
    if int(base) not in _TABLES:
        _TABLES[int(base)] = powers(base, 1 << 20)
    return _TABLES[int(base)][:n]


class _Rolling:
    """Hashes of any stretch of a byte array."""

    def __init__(self, data: np.ndarray):
        with np.errstate(over="ignore"):
            self.total = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), out=self.total[1:])
        self.inverse = _powers(_INVERSE, len(data) + 1)

    def grams(self, k: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.total[k:] - self.total[:-k]) * self.inverse[:len(self.total) - k], k)

    def of(self, start, end) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.total[end] - self.total[start]) * self.inverse[start] ^ mix((end - start).astype(np.uint64)), 5)


    def again(self, start, n: int) -> np.ndarray:
        """A second hash, independent of the first, of the ``n`` bytes from each start."""
        with np.errstate(over="ignore"):
            half = n // 2
            one, two = self.of(start, start + half), self.of(start + half, start + n)
            return mix(one * np.uint64(0xD6E8FEB86659FD93) ^ mix(two, 17), 18)


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... for every start and length, one after another."""
    total = int(length.sum())
    ends = np.cumsum(length)
    return np.arange(total) - np.repeat(ends - length - start, length)


def _pieces(n: int):
    """Pieces of texts: place, digest, doc, print, span (start and length packed), and whether a smaller document
    of the step holds the same piece."""

    def work(batch: pa.RecordBatch) -> pa.Table:
        doc, seal = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        data, ends = byte_view(batch.column(2))
        cut = np.zeros(len(data) + 1, bool)
        if len(data) > GRAM:
            cut[:len(data) - GRAM + 1] = (_Rolling(data).grams(GRAM) >> np.uint64(20)) % np.uint64(PIECE) == 0
        cut[ends[:-1]] = True
        start = np.flatnonzero(cut[:len(data)])
        long = np.diff(np.append(start, len(data))) // LONGEST
        if long.any():
            start = np.union1d(start, np.repeat(start, long) + _ranges(np.ones(len(long), np.int64), long) * LONGEST)
        of = np.searchsorted(ends, start, side="right") - 1
        stop = np.minimum(np.append(start[1:], len(data)), ends[of + 1])
        reach = np.minimum(stop + n - 1, ends[of + 1])
        keep = reach - start >= n
        start, of, reach = start[keep], of[keep], reach[keep]
        plain = data.tobytes()
        digest = [hashlib.blake2b(plain[a:b], digest_size=16).digest() for a, b in zip(start.tolist(), reach.tolist())]
        least: dict[bytes, int] = {}
        for d, k in zip(digest, doc[of].tolist()):
            least[d] = min(least.get(d, k), k)
        gone = np.array([k > least[d] for d, k in zip(digest, doc[of].tolist())], bool)
        key = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
        at = start - ends[of]
        return pa.table({
            "place": np.where(gone, mix(doc[of].view(np.uint64)).view(np.int64), key[:, 0]), "d1": key[:, 0],
            "d2": key[:, 1], "doc": doc[of], "print": seal[of], "span": at << 20 | (reach - start), "gone": gone})

    return arrow_step(work, "text")


def _owned(batches):
    """Of pieces sorted by digest and document: gone unless of the digest's first document."""
    key, owner = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        d1, d2, doc = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("d1", "d2", "doc"))
        gone = batch.column("gone").to_numpy(zero_copy_only=False)
        new = np.ones(len(doc), bool)
        new[1:] = (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])
        least = doc[np.flatnonzero(new)[np.cumsum(new) - 1]]
        if key == (d1[0], d2[0]):
            least = np.where(np.cumsum(new) == 1, owner, least)
        key, owner = (d1[-1], d2[-1]), least[-1]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("print"), batch.column("span"), pa.array(gone | (doc > least))],
            ["doc", "print", "span", "gone"])


def _counted(batch: pa.RecordBatch) -> pa.Table | None:
    """Grams that are frequent in a step, and how often they occur in it."""
    data, _ = byte_view(batch.column(0))
    if len(data) < GRAM:
        return None
    grams = np.sort(_Rolling(data).grams(GRAM))
    at = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
    count = np.diff(np.append(at, len(grams)))
    often = count >= max(4, COMMON * batch.num_rows)
    return pa.table({"gram": grams[at[often]].view(np.int64), "n": count[often].astype(np.int64)})


def common_grams(docs: DataFrame, total: int) -> np.ndarray:
    """A table by the first ``TABLE`` bits of a gram's hash: whether a gram that occurs as often as ``COMMON`` of
    all ``total`` documents begins so. At most ``MOST`` grams reach the driver. It decides which anchors are taken, not
    which strings are found."""
    rows = (docs.select("text").mapInArrow(arrow_step(_counted, "text"), "gram long, n long").groupBy("gram")
            .agg(F.sum("n").alias("n")).where(F.col("n") >= max(4, COMMON * total)).orderBy(F.desc("n"), "gram").limit(MOST))
    table = np.zeros(1 << TABLE, bool)
    held = np.array([r.gram for r in rows.select("gram").collect()], np.int64).view(np.uint64)
    table[(held >> np.uint64(64 - TABLE)).astype(np.int64)] = True
    return np.packbits(table)


def _own(doc: np.ndarray, seal: np.ndarray, held: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Which span of ``held`` is of which text: the text's number and the span, ordered by text."""
    of, print_, span = (held.column(c).to_numpy() for c in ("doc", "print", "span"))
    order = np.lexsort((span, print_, of))
    of, print_, span = of[order], print_[order], span[order]
    if len(of):  # rows that are alike say the same
        new = np.append(True, (of[1:] != of[:-1]) | (print_[1:] != print_[:-1]) | (span[1:] != span[:-1]))
        of, print_, span = of[new], print_[new], span[new]
    every, prints = np.concatenate([doc, of]), np.concatenate([seal, print_])
    order = np.lexsort((prints, every))
    ident = np.empty(len(every), np.int64)
    ident[order] = np.cumsum(np.append(False, (np.diff(every[order]) != 0) | (np.diff(prints[order]) != 0))[:len(every)])
    texts, spans = ident[:len(doc)], ident[len(doc):]
    first, last = (np.searchsorted(spans, texts, side) for side in ("left", "right"))
    return np.repeat(np.arange(len(doc)), last - first), span[_ranges(first, last - first)]


def _steps(texts: pa.Table, held: pa.Table, nameless: bool = False) -> Iterator[tuple]:
    """A group's texts in steps: key (as it came), print, bytes and their ends, and the spans in ``held`` of these
    texts. Those without a key only if ``nameless``, and without spans."""
    held = held.filter(held.column("doc").is_valid())
    for whole in texts.select(["doc", "print", "text"]).to_batches():
        if not nameless:
            whole = whole.filter(whole.column("doc").is_valid())
        for batch in steps(whole, "text"):
            doc, named = batch.column("doc"), batch.column("doc").is_valid().to_numpy(zero_copy_only=False)
            seal = batch.column("print").to_numpy()
            at = np.flatnonzero(named)
            own, span = _own(doc.drop_null().to_numpy(), seal[at], held)
            yield doc, seal, *byte_view(batch.column("text")), at[own], span


def _anchored(data, ends, own, span, n: int, common: np.ndarray) -> list[np.ndarray]:
    """Stretches of strings with one anchor, outside of the pieces (text's number, ascending, and start and length
    packed) that are gone: text's number, start, number of strings, anchor hash. A few texts at a time, so that the
    arrays fit the processor's cache."""
    out, first = [], 0
    while first < len(ends) - 1:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + CACHED_BYTES, side="right")) - 1)
        a, b = np.searchsorted(own, [first, last])
        of, start, count, anchor = _anchored_few(
            data[ends[first]:ends[last]], ends[first:last + 1] - ends[first], own[a:b] - first, span[a:b], n, common)
        out.append((of + first, start + ends[first], count, anchor))
        first = last
    return [np.concatenate(x) for x in zip(*out)]


def _anchored_few(data, ends, own, span, n: int, common: np.ndarray):
    if len(data) < n:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    edge = np.zeros(len(data) + 1, np.int32)
    fits = np.diff(ends) >= n
    np.add.at(edge, ends[:-1][fits], 1)
    np.add.at(edge, ends[1:][fits] - n + 1, -1)
    start = (span >> 20) + ends[own]
    np.add.at(edge, start, -1)
    np.add.at(edge, start + (span & 0xFFFFF) - n + 1, 1)
    at = np.flatnonzero(np.cumsum(edge, dtype=np.int32) > 0)
    grams = _Rolling(data).grams(GRAM)
    place = (grams >> np.uint64(64 - TABLE)).astype(np.int64)
    last_choice = (common[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1).astype(np.uint64)
    low = (last_choice << np.uint64(63)) | (grams << np.uint64(TABLE) >> np.uint64(33) << np.uint64(32))
    low |= np.arange(len(grams), dtype=np.uint64)
    width, reach = n - GRAM + 1, 1
    while 2 * reach <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < width:
        low = np.minimum(low[:reach - width], low[width - reach:])
    anchor = (low[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) > 1) | (anchor[1:] != anchor[:-1])  # no string starts at the end of a text
    first = np.flatnonzero(new)
    start = at[first]
    return (np.searchsorted(ends, start, side="right") - 1, start, np.diff(np.append(first, len(at))),
            grams[anchor[first]])


def _print(anchor: np.ndarray, bits: int) -> np.ndarray:
    return mix(anchor, 9) >> np.uint64(64 - bits)


def packed(value: np.ndarray, row: np.ndarray, rows: int) -> pa.Array:
    """Ascending numbers of each row as bytes: differences, seven bits a byte, the last byte of each below 128."""
    first = np.append(True, row[1:] != row[:-1])[:len(row)]
    step = np.where(first, value, value - np.append(value[:1], value[:-1])).astype(np.uint64)
    size = np.ones(len(step), np.int64)
    for k in range(7, 64, 7):
        size += step >> np.uint64(k) > 0
    begin = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        there = size > k
        out[begin[there] + k] = (step[there] >> np.uint64(7 * k) & np.uint64(127)) | ((size[there] > k + 1).astype(np.uint64) << np.uint64(7))
    cuts = np.append(0, np.cumsum(np.bincount(row, size, rows).astype(np.int64)))
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(cuts.astype(np.int32).tobytes()), pa.py_buffer(out.tobytes())])


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of ``packed``, and the row of each."""
    data, ends = byte_view(column)
    stop = np.flatnonzero(data < 128)
    begin = np.append(0, stop + 1)[:len(stop)]
    step = np.zeros(len(stop), np.uint64)
    for k in range(int((stop - begin).max(initial=-1)) + 1):
        there = stop - begin >= k
        step[there] |= (data[begin[there] + k] & 127).astype(np.uint64) << np.uint64(7 * k)
    row = np.searchsorted(ends, stop, side="right") - 1
    value = np.cumsum(step, dtype=np.uint64)
    first = np.searchsorted(row, row, side="left")
    return value - value[first] + step[first], row


PRINTS, SHARED = "bucket long, group long, prints binary", "group long, shared binary"


def _prints(n: int, common: np.ndarray, bits: int, shift: int):
    """Prints of a group's anchors by ranges of prints: once if of one document, twice if of several, three times if
    the anchor is frequent."""

    def work(texts: pa.Table, gone: pa.Table) -> pa.Table:
        key, who, count = [], [], 0
        for doc, _, data, ends, own, span in _steps(texts, gone):
            of, _, _, anchor = _anchored(data, ends, own, span, n, common)
            key.append(_print(anchor, bits))
            who.append(doc.to_numpy()[of])
            count += len(doc)
        key, who = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (key, who))
        order = np.lexsort((who, key))
        key, who = key[order].astype(np.uint64), who[order]
        head = np.append(True, key[1:] != key[:-1])[:len(key)]
        other = head | np.append(True, who[1:] != who[:-1])[:len(key)]
        docs = np.bincount(np.cumsum(head) - 1, other).astype(np.int64) if len(key) else np.zeros(0, np.int64)
        key = np.repeat(key[head], np.where(docs >= max(FREQUENT, SHARE * count), 3, np.minimum(docs, 2)))
        bucket, row = np.unique((key >> np.uint64(shift)).astype(np.int64), return_inverse=True)
        group = texts.column("group")[0].as_py() if count else 0
        return pa.table({"bucket": bucket, "group": np.full(len(bucket), group), "prints": packed(key, row, len(bucket))})

    return work


def agreed(held: pa.Table) -> pa.Table:
    """For each group those of its prints that several documents have, those of frequent anchors twice."""
    value, row = unpacked(held.column("prints").combine_chunks())
    first = np.append(True, (value[1:] != value[:-1]) | (row[1:] != row[:-1]))[:len(value)]
    at = np.flatnonzero(first)
    times = np.diff(np.append(at, len(value)))
    value, row = value[at], row[at]
    order = np.argsort(value, kind="stable")
    head = np.append(True, np.diff(value[order]) != 0)[:len(value)]
    run = np.empty(len(value), np.int64)
    run[order] = np.cumsum(head) - 1
    several = np.bincount(run, times)[run] > 1
    often = np.zeros(len(value), bool)
    often[run[times > 2]] = True
    keep = np.where(several, 1 + often[run], 0)
    value, row = np.repeat(value, keep), np.repeat(row, keep)
    rows, row = np.unique(row, return_inverse=True)
    return pa.table({"group": held.column("group").to_numpy()[rows], "shared": packed(value, row, len(rows))})


ROW = "place long, doc long, print long, span long, bytes binary"


def _stretches(n: int, common: np.ndarray, bits: int):
    """Bytes of the stretches of shared anchors of a group. Of equal stretches in a step only the smallest document's
    travels; the others are spans to remove already (without bytes)."""

    def step(doc, seal, data, ends, gone_of, gone_span, shared, often_too) -> pa.Table | None:
        own, start, count, anchor = _anchored(data, ends, gone_of, gone_span, n, common)
        key = _print(anchor, bits)
        at = np.minimum(np.searchsorted(shared, key), len(shared) - 1)
        held = shared[at] == key
        own, start, count, place, often = (x[held] for x in (own, start, count, anchor.view(np.int64), often_too[at]))
        if not len(own):
            return None
        doc = doc.to_numpy()
        rolling = _Rolling(data)
        if often.any():  # single strings, keyed by content
            alone = _ranges(start[often], count[often])
            own = np.concatenate([own[~often], np.repeat(own[often], count[often])])
            start = np.concatenate([start[~often], alone])
            place = np.concatenate([place[~often], rolling.of(alone, alone + n).view(np.int64)])
            count = np.concatenate([count[~often], np.ones(len(alone), np.int64)])
            often = np.arange(len(start)) >= len(start) - len(alone)
        end = start + count + n - 1
        who = doc[own]
        held = rolling.of(start, end)
        order = np.lexsort((who, held))
        size = end - start
        head = np.ones(len(held), bool)
        head[1:] = (held[order][1:] != held[order][:-1]) | (size[order][1:] != size[order][:-1])
        first = np.empty(len(held), np.int64)
        first[order] = order[np.flatnonzero(head)[np.cumsum(head) - 1]]
        same = np.logical_and.reduceat(data[_ranges(start, size)] == data[_ranges(start[first], size)],
                                       np.cumsum(size) - size)
        gone = same & (who > who[first])
        # settled strings that follow each other are one span
        chain = gone[1:] & gone[:-1] & often[1:] & often[:-1] & (own[1:] == own[:-1]) & (np.diff(start) == 1)
        opens = np.append(True, ~chain)
        run = np.cumsum(opens) - 1
        size = np.where(gone & often, np.bincount(run)[run] + n - 1, size)
        own, start, place, who, gone, often, size = (x[opens] for x in (own, start, place, who, gone, often, size))
        # what travels: nothing if gone, a digest of a single string, else the bytes
        sent = np.where(gone, 0, np.where(often, 8, size))
        cuts = np.concatenate([[0], np.cumsum(sent)])
        text = np.empty(cuts[-1], np.uint8)
        plain, short = ~gone & ~often, ~gone & often
        text[_ranges(cuts[:-1][plain], size[plain])] = data[_ranges(start[plain], size[plain])]
        text[_ranges(cuts[:-1][short], np.full(short.sum(), 8))] = rolling.again(start[short], n).view(np.uint8)
        bytes_ = pa.Array.from_buffers(pa.binary(), len(start), [
            pa.array(~gone).buffers()[1], pa.py_buffer(cuts.astype(np.int32).tobytes()), pa.py_buffer(text.tobytes())])
        return pa.table({
            "place": np.where(gone, mix(who.view(np.uint64), 1).view(np.int64), place), "doc": who, "print": seal[own],
            "span": (start - ends[own]) << 20 | size, "bytes": bytes_})

    def work(texts: pa.Table, held: pa.Table) -> pa.Table:
        kept = held.column("shared").combine_chunks().drop_null()
        shared, times = np.unique(unpacked(kept)[0], return_counts=True)
        out = []
        if len(shared):
            out = [step(*texts_, shared, times > 1) for texts_ in _steps(texts, held)]
        out = [x for x in out if x is not None]
        return pa.concat_tables(out) if out else pa.schema(
            [(c, pa.int64()) for c in ("place", "doc", "print", "span")] + [("bytes", pa.binary())]).empty_table()

    return work


def refine(data: np.ndarray, depth: int, at: np.ndarray | None = None) -> np.ndarray:
    """Bucket of the suffixes of ``data`` from ``at`` (without it: of every one) at ``depth``; those nearer to the end
    are not to be used. Equal buckets mean that the next ``depth`` bytes are equal.

    A round goes into the open buckets only, those with several suffixes, and only for suffixes that a later
    round uses or points to."""
    depths = [min(8, depth)]
    while depths[-1] < depth:
        depths.append(min(2 * depths[-1], depth))
    used = np.zeros(max(len(data) - depths[0] + 1, 0), bool)
    used[slice(max(len(data) - depth + 1, 0)) if at is None else at] = True
    rounds = [used]
    for less, more in zip(depths[-2::-1], depths[:0:-1]):
        used = rounds[-1].copy()
        used[more - less:] |= rounds[-1][:less - more]
        rounds.append(used)
    place = np.flatnonzero(rounds.pop())
    value = np.zeros(len(place), np.uint64)
    for k in range(depths[0]):
        value = (value << np.uint64(8)) | data[place + k]
    bucket, top = np.zeros(len(used), np.int64), 0
    for less, more in zip([0, *depths], depths):
        if less:
            place = place[rounds.pop()[place]]
            value = bucket[place] * top + bucket[place + more - less]
        order = np.argsort(value)
        ranked = value[order]
        head = np.append(True, ranked[1:] != ranked[:-1])[:len(ranked)]
        place = place[order]
        bucket[place] = top + np.cumsum(head) - 1
        top += len(place)
        # a suffix alone in its bucket stays so, and its bucket's number is its own
        place = np.sort(place[~(head & np.append(head[1:], True)[:len(head)])])
    return bucket


def _settled(n: int):
    def spans(rows: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        table = pa.Table.from_batches(rows).combine_chunks()
        place, doc, seal, span = (table.column(c).to_numpy() for c in ("place", "doc", "print", "span"))
        data, ends = byte_view(table.column("bytes").chunk(0))
        size = np.diff(ends)
        # single strings of frequent anchors by digest, all others by their bytes
        row, at, equal = [], [], []
        short = np.flatnonzero(size == 8)
        if len(short):
            digest = data[_ranges(ends[short], np.full(len(short), 8))].view(np.uint64)
            pair = np.stack([place[short].view(np.uint64), digest], axis=1)
            equal.append(np.unique(pair, axis=0, return_inverse=True)[1].reshape(-1))
            row.append(short)
            at.append(np.zeros(len(short), np.int64))
        if len(short) < len(size):
            long = np.flatnonzero(size != 8)
            strings = size[long] - n + 1
            begin = _ranges(ends[long], strings)
            bucket = refine(data, n, begin)
            row.append(np.repeat(long, strings))
            at.append(begin - np.repeat(ends[long], strings))
            equal.append(bucket[begin] + (int(equal[0].max()) + 1 if equal else 0))
        row, at, equal = (np.concatenate(x) for x in (row, at, equal))
        least = np.full(int(equal.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, equal, doc[row])
        gone = doc[row] > least[equal]
        row, at = row[gone], at[gone]
        if not len(row):
            return None
        head = np.ones(len(row), bool)
        head[1:] = (row[1:] != row[:-1]) | (np.diff(at) > 1)
        one = np.flatnonzero(head)
        last = np.append(one[1:], len(row)) - 1
        own = row[one]
        start = (span[own] >> 20) + at[one]
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[own]), pa.array(seal[own]), pa.array(start << 20 | (at[last] - at[one] + n))],
            ["doc", "print", "span"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            ready = batch.filter(batch.column("bytes").is_null())
            if ready.num_rows:
                yield ready.select(["doc", "print", "span"])
            batch = batch.filter(batch.column("bytes").is_valid())
            while batch.num_rows:
                # up to the size, and then to the end of the place
                place = batch.column("place").to_numpy(zero_copy_only=False)
                lengths = byte_view(batch.column("bytes"))[1][1:]
                cut = int(np.searchsorted(lengths, SORTED_BYTES - size, side="right"))
                if cut >= len(place):
                    held.append(batch)
                    size += int(lengths[-1])
                    break
                open_place = place[cut - 1] if cut else held[-1].column("place")[-1].as_py() if held else place[0]
                more = np.flatnonzero(place[cut:] != open_place)
                if not len(more):
                    held.append(batch)
                    size += int(lengths[-1])
                    break
                cut += int(more[0])
                out = spans([*held, batch.slice(0, cut)])
                if out is not None:
                    yield out
                held, size, batch = [], 0, batch.slice(cut)
        if held:
            out = spans(held)
            if out is not None:
                yield out

    return run


def _kept(texts: pa.Table, spans: pa.Table) -> pa.Table:
    out = {"doc": [], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
    for doc, _, data, ends, own, span in _steps(texts, spans, nameless=True):
        first, last = span >> 20, (span >> 20) + (span & 0xFFFFF)
        cuts = np.searchsorted(own, np.arange(len(doc) + 1))
        for i in range(len(doc)):
            text = data[ends[i]:ends[i + 1]]
            if cuts[i + 1] > cuts[i]:
                edge = np.zeros(len(text) + 1, np.int64)
                np.add.at(edge, first[cuts[i]:cuts[i + 1]], 1)
                np.add.at(edge, last[cuts[i]:cuts[i + 1]], -1)
                gone = np.cumsum(edge)[:-1] > 0
                kept = text[~gone].tobytes()
                runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            else:
                kept, runs = text.tobytes(), 0
            out["n_bytes"].append(len(text))
            out["n_removed"].append(len(text) - len(kept))
            out["n_spans"].append(runs)
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["kept"].append(kept)
        out["doc"].extend(doc.to_pylist())
    return pa.table(out, schema=pa.schema(
        [(c, pa.int64()) for c in ("doc", "n_bytes", "n_removed", "n_spans")] + [("kept_sha256", pa.string()), ("kept", pa.binary())]))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 50) -> DataFrame:
    """One row per row of ``docs``: key, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs),
    ``kept_sha256`` and ``kept`` (the remaining bytes).

    Strings never cross documents and are judged on the input. A null text is empty. Rows that share a key do
    not count as smaller for each other. A row with a null key keeps all its bytes and removes nothing from
    others. Other columns are ignored.
    """
    docs = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    docs = docs.select("doc", F.xxhash64("text").alias("print"), "text")
    total, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    common = common_grams(docs, total)
    # an anchor lies about every 18 bytes
    bits = (size // 16).bit_length() + SPARE
    shift = bits - (size // BUCKET_BYTES).bit_length()

    group = F.pmod(F.xxhash64("doc", "print"), F.lit(size // GROUP_BYTES + 1)).alias("group")
    texts = docs.select(group, "doc", "print", "text").groupBy("group")  # one shuffle of the texts for all three steps
    gone = (docs.where("doc is not null").mapInArrow(_pieces(n), "place long, d1 long, d2 long, doc long, print long, span long, gone boolean")
            .repartition("place").sortWithinPartitions("d1", "d2", "doc")
            .mapInArrow(_owned, "doc long, print long, span long, gone boolean"))
    gone = saved(gone.where("gone").select("doc", "print", "span"), "pieces").select(group, "doc", "print", "span")
    shared = (texts.cogroup(gone.groupBy("group")).applyInArrow(_prints(n, common, bits, shift), PRINTS)
              .groupBy("bucket").applyInArrow(agreed, SHARED))
    held = gone.unionByName(shared, allowMissingColumns=True)
    found = (texts.cogroup(held.groupBy("group")).applyInArrow(_stretches(n, common, bits), ROW)
             .repartition("place").sortWithinPartitions("place")
             .mapInArrow(_settled(n), "doc long, print long, span long"))
    spans = found.select(group, "doc", "print", "span").unionByName(gone)
    out = texts.cogroup(spans.groupBy("group")).applyInArrow(
        _kept, "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.withColumnRenamed("doc", key)
