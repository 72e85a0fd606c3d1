"""Operators that carry state from event to event (batch form).

Debounce, marker-delimited frames, line assembly, keyed state machines, the
final report and bounded collection. ``streaming.stateful`` has the same
operators on streams.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import folds
from ..plans import ordered as od
from .sorting import cap_first

# ----------------------------------------------------------------------------- debounce


class DebounceFold(folds.Fold):
    """State: the time of the last accepted event, or None.

    In a batch every event points to the first one at least a gap later; the pointers, doubled until all have ended,
    tell which events a start leads to. A digest keeps where every possible first accepted event of the segment leads.
    """

    def __init__(self, ts: str, min_gap: int, initial_last: int | None):
        self.inputs = (ts,)
        self.min_gap = min_gap
        self.start = initial_last

    def initial(self):
        return self.start

    def _pointers(self, times: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """For each event the first one of its run at least a gap later; ``len(times)``: there is none."""
        n = len(times)
        ends = np.append(starts[1:], n)
        starts, ends = starts[starts < ends], ends[starts < ends]
        of = np.repeat(np.arange(len(starts)), ends - starts)
        # one axis for all runs, each beyond the reach of the one before
        width = (times[ends - 1] - times[starts]).astype(np.float64) + self.min_gap + 1
        if times.dtype.kind == "i" and width.sum() < 1 << 62:
            shift = np.cumsum(width.astype(np.int64)) - width.astype(np.int64) - times[starts]
            line = times + shift[of]
            at = np.searchsorted(line, line + self.min_gap)
        else:
            at = np.concatenate([np.zeros(0, np.int64), *[lo + np.searchsorted(times[lo:hi], times[lo:hi] + self.min_gap)
                                                          for lo, hi in zip(starts.tolist(), ends.tolist())]])
        at = np.maximum(at, np.arange(1, n + 1))  # a gap of zero goes on to the next
        at[at >= ends[of]] = n
        return np.append(at, n)

    def runs(self, cols, starts, states):
        valid = cols[0].is_valid().to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(valid)
        times = cols[0].filter(pa.array(valid)).to_numpy(zero_copy_only=False)
        cuts = np.searchsorted(rows, starts)  # where each run begins among the events with a time
        ends = np.append(cuts[1:], len(rows))
        pointers = self._pointers(times, cuts)
        first = [lo if state is None else lo + int(np.searchsorted(times[lo:hi], state + self.min_gap))
                 for lo, hi, state in zip(cuts.tolist(), ends.tolist(), states)]
        reached = np.array([at for at, hi in zip(first, ends.tolist()) if at < hi], np.int64)
        doubled = [pointers]
        while (doubled[-1][:-1] < len(times)).any():
            doubled.append(doubled[-1][doubled[-1]])
        for jump in reversed(doubled):
            reached = np.concatenate([reached, jump[reached]])
            reached = reached[reached < len(times)]
        kept = np.sort(reached)
        last = np.searchsorted(kept, ends) - 1
        after = [times[kept[at]].item() if at >= 0 and kept[at] >= lo else state
                 for at, lo, state in zip(last.tolist(), cuts.tolist(), states)]
        return rows[kept], [], after

    def blank(self):
        return {"first": None, "open": True, "entries": [], "ends": np.zeros(0), "of": []}

    def feed(self, cols, digest):
        times = cols[0].drop_null().to_numpy(zero_copy_only=False)
        if not len(times):
            return digest
        pointers = self._pointers(times, np.zeros(1, np.int64))
        last = np.where(pointers[:-1] < len(times), pointers[:-1], np.arange(len(times)))
        while True:  # the end of each event's chain in this batch
            further = last[last]
            if (further == last).all():
                break
            last = further
        first = times[0] if digest["first"] is None else digest["first"]
        ends, of, entries, open_ = digest["ends"], digest["of"], digest["entries"], digest["open"]
        if len(ends):
            at = np.searchsorted(times, ends + self.min_gap)
            moved = np.append(times[last], 0)[np.minimum(at, len(times))]
            ends = np.where(at < len(times), moved, ends)
        if open_:
            # up to the first event that no state before the segment can hold back
            new = np.unique(times)
            new = new[:np.searchsorted(new, first + self.min_gap) + 1]
            if entries:
                new = new[new > entries[-1][-1]]
            if len(new):
                open_ = bool(new[-1] < first + self.min_gap)
                of = [*of, np.arange(len(ends), len(ends) + len(new))]
                entries = [*entries, new]
                ends = np.concatenate([ends, times[last[np.searchsorted(times, new)]]])
        if not open_ and len(ends) > 1:  # chains that have met stay together
            ends, at = np.unique(ends, return_inverse=True)
            of = [at[np.concatenate(of)]]
        return {"first": first, "open": open_, "entries": entries, "ends": ends, "of": of}

    def seal(self, digest):
        if not digest["entries"]:
            return [None, None]
        entries, exits = np.concatenate(digest["entries"]), digest["ends"][np.concatenate(digest["of"])]
        # one entry, the last, for each stretch with the same exit
        keep = np.append(exits[1:] != exits[:-1], True)
        entries, exits = entries[keep], exits[keep]
        if entries.dtype.kind != "i":
            return [entries.tolist(), exits.tolist()]
        own = bool((entries == exits).all())
        return [folds.packed(entries), None if own else folds.packed(exits)]

    def step(self, state, sealed):
        entries, exits = (folds.unpacked(x) if isinstance(x, str) else x for x in sealed)
        if entries is None:
            return state
        exits = entries if exits is None else exits
        at = 0 if state is None else int(np.searchsorted(entries, state + self.min_gap))
        return np.asarray(exits[at]).item() if at < len(entries) else state


def debounce(df: DataFrame, key, ts: str, min_gap: int, initial_last: int | None = None,
             tie: str | None = None, **opts) -> DataFrame:
    """Keep an event only if it is ``min_gap`` ticks after the last *kept* one of its key. An event without a
    time is not kept."""
    order = [ts] + od.names(tie)
    return folds.run_fold(df, key, order, DebounceFold(ts, min_gap, initial_last),
                          list(df.columns), **opts)


# ----------------------------------------------------------------------------- state machine

# States and events of the motion controller and its transitions.
SERVO_TRANSITIONS: dict[tuple[str, str], str] = {
    ("at_position", "left"): "moving",
    ("at_position", "right"): "moving",
    ("at_position", "paused"): "paused",
    ("at_position", "continued"): "moving",
    ("at_position", "recipe_restarted"): "moving",
    ("at_position", "recipe_ended"): "recipe_ended",
    ("moving", "servo_at_position"): "at_position",
    ("moving", "error_detected"): "error",
    ("moving", "paused"): "paused",
    ("moving", "recipe_paused"): "paused",
    ("paused", "continued"): "moving",
    ("paused", "recipe_restarted"): "moving",
    ("error", "continued"): "moving",
    ("error", "recipe_restarted"): "moving",
    ("recipe_ended", "continued"): "moving",
    ("recipe_ended", "recipe_restarted"): "moving",
    ("recipe_ended", "recipe_paused"): "paused",
    ("waiting", "wait_completed"): "moving",
    ("waiting", "paused"): "paused",
    ("looping", "end_loop"): "moving",
    ("looping", "paused"): "paused",
}


#: events that a lane of a batch holds
LANE = 16


class MachineFold(folds.Fold):
    """State: the machine's state.

    Every event is a map from states to states, and maps compose. A batch is cut into lanes; each lane's map tells
    the state in which the next lane begins, and then all lanes run side by side. A digest is the map of a segment.
    """

    def __init__(self, event: str, transitions: Mapping[tuple[str, str], str], initial: str):
        self.inputs = (event,)
        self.extra = (T.StructField("from", T.StringType()), T.StructField("to", T.StringType()))
        self.start = initial
        self.states = sorted({initial, *(s for s, _ in transitions), *transitions.values()})
        self.events = sorted({e for _, e in transitions})
        number = {s: i for i, s in enumerate(self.states)}
        #: a row per event, the last one for those that change nothing
        self.maps = np.tile(np.arange(len(self.states), dtype=np.int32), (len(self.events) + 1, 1))
        for (state, event_), to in transitions.items():
            self.maps[self.events.index(event_), number[state]] = number[to]

    def initial(self):
        return self.start

    def _lanes(self, column: pa.Array) -> np.ndarray:
        """The number of each row's map, lanes along the second axis, filled up with the last."""
        at = pc.fill_null(pc.index_in(column, pa.array(self.events, column.type)), len(self.events))
        lanes = np.full((-(-len(column) // LANE), LANE), len(self.events), np.int32)
        lanes.ravel()[:len(column)] = at.to_numpy(zero_copy_only=False)
        return np.ascontiguousarray(lanes.T)

    def _composed(self, lanes: np.ndarray, given: np.ndarray | None = None) -> np.ndarray:
        """The map of each lane. ``given``: the state that a row begins in whatever came before, or -1."""
        total = np.tile(np.arange(len(self.states), dtype=np.int32), (lanes.shape[1], 1))
        for j, events in enumerate(lanes):
            if given is not None and (given[j] >= 0).any():
                total = np.where((given[j] >= 0)[:, None], given[j][:, None], total)
            total = self.maps[events[:, None], total]
        return total

    def runs(self, cols, starts, states):
        n = len(cols[0])
        lanes = self._lanes(cols[0])
        given = np.full((lanes.shape[1], LANE), -1, np.int32)
        given.ravel()[starts] = [self.states.index(s) for s in states]
        given = np.ascontiguousarray(given.T)
        state, begins = 0, []
        for lane in self._composed(lanes, given).tolist():
            begins.append(state)
            state = lane[state]
        now = np.array(begins, np.int32)
        before, after = np.empty_like(lanes), np.empty_like(lanes)
        for j, events in enumerate(lanes):
            before[j] = np.where(given[j] >= 0, given[j], now)
            after[j] = now = self.maps[events, before[j]]
        names = pa.array(self.states)
        out = [pa.DictionaryArray.from_arrays(pa.array(x.T.ravel()[:n]), names).cast(pa.string()) for x in (before, after)]
        last = np.append(starts[1:], n) - 1
        return None, out, [self.states[s] for s in after[last % LANE, last // LANE].tolist()]

    def blank(self):
        return list(range(len(self.states)))

    def feed(self, cols, digest):
        for lane in self._composed(self._lanes(cols[0])).tolist():
            digest = [lane[s] for s in digest]
        return digest

    def seal(self, digest):
        return [self.states[s] for s in digest]

    def step(self, state, sealed):
        return sealed[self.states.index(state)]


def state_machine(df: DataFrame, key, order, event: str,
                  transitions: Mapping[tuple[str, str], str] = SERVO_TRANSITIONS,
                  initial: str = "paused", **opts) -> DataFrame:
    """Each event with the state before and after it; unknown (state, event) pairs change nothing."""
    return folds.run_fold(df, key, order, MachineFold(event, transitions, initial),
                          list(df.columns), **opts)


# ----------------------------------------------------------------------------- line assembly


#: line ends, runs of backspaces, runs of other characters
_KEYS = re.compile("[\r\n]|\x08+|[^\x08\r\n]+")


class LineFold(folds.Fold):
    """State: [lines sent so far, the text typed so far, characters dropped from it].

    A row holds one character or many. It is taken as line ends, runs of backspaces and runs of text.
    """

    def __init__(self, ch: str, max_len: int):
        self.inputs = (ch,)
        self.extra = (T.StructField("line_no", T.LongType()), T.StructField("line", T.StringType()),
                      T.StructField("dropped", T.LongType()))
        self.max_len = max_len

    def initial(self):
        return [0, "", 0]

    def _type(self, chunk: str | None, state: list, send) -> list:
        sent, typed, dropped = state
        if chunk is None:
            return [sent, typed, dropped + 1]
        for key in _KEYS.findall(chunk):
            if key == "\n" or key == "\r":
                send(sent, typed, dropped)
                sent, typed, dropped = sent + 1, "", 0
            elif key[0] == "\b":
                typed = typed[:-len(key)]
            else:
                room = self.max_len - len(typed)
                typed, dropped = typed + key[:room], dropped + max(len(key) - room, 0)
        return [sent, typed, dropped]

    def runs(self, cols, starts, states):
        chunks = cols[0].to_pylist()
        rows: list[int] = []
        out: list[tuple] = []
        after: list[list] = []
        for lo, hi, state in zip(starts.tolist(), [*starts[1:].tolist(), len(chunks)], states):
            for i in range(lo, hi):
                held = len(out)
                state = self._type(chunks[i], state, lambda *line: out.append(line))
                rows.extend([i] * (len(out) - held))
            after.append(state)
        return np.array(rows, np.int64), [list(x) for x in zip(*out)] or [[], [], []], after

    # Until the first line end, what a segment does to the incoming text depends only
    # on its length, so one lane per length 0..max_len is followed. ``keep`` is how much
    # of the incoming text survives.
    def blank(self):
        n = self.max_len + 1
        return {
            "sent": 0,
            "state": None,
            "size": np.arange(n),
            "keep": np.arange(n),
            "dropped": np.zeros(n, dtype=np.int64),
            "text": np.full((n, self.max_len), "", dtype=object),
        }

    def feed(self, cols, d):
        cap, sent = self.max_len, []
        for chunk in cols[0].to_pylist():
            if d["state"] is None:
                end = re.search("[\r\n]", chunk or "")
                chunk, rest = (chunk, None) if end is None else (chunk[:end.start()], chunk[end.end():])
                if chunk is None:
                    d["dropped"] += 1
                for key in _KEYS.findall(chunk or ""):
                    if key[0] == "\b":
                        d["size"] = np.maximum(d["size"] - len(key), 0)
                        d["keep"] = np.minimum(d["keep"], d["size"])
                        continue
                    for c in key[:cap]:
                        room = np.nonzero(d["size"] < cap)[0]
                        if not len(room):
                            break
                        d["text"][room, d["size"][room]] = c
                        d["size"][room] += 1
                        d["dropped"][room] -= 1
                    d["dropped"] += len(key)
                if end is not None:
                    d["sent"], d["state"] = 1, [0, "", 0]
                chunk = rest
                if end is None:
                    continue
            d["state"] = self._type(chunk, d["state"], lambda *line: sent.append(1))
        return d

    def seal(self, d):
        if d["state"] is not None:
            return {"sent": d["sent"] + d["state"][0], "typed": d["state"][1], "dropped": d["state"][2]}
        lanes = [
            [int(k), "".join(row[int(k):int(s)]), int(lost)]
            for k, s, row, lost in zip(d["keep"], d["size"], d["text"], d["dropped"])
        ]
        return {"sent": 0, "lanes": lanes}

    def step(self, state, sealed):
        sent, typed, dropped = state
        if "typed" in sealed:
            return [sent + sealed["sent"], sealed["typed"], sealed["dropped"]]
        keep, suffix, lost = sealed["lanes"][len(typed)]
        return [sent, typed[:keep] + suffix, dropped + lost]


def assemble_lines(df: DataFrame, key, order, ch: str, max_len: int = 80, **opts) -> DataFrame:
    """Lines from typed text, a character or a piece of any length per row: characters append up to ``max_len``,
    backspace deletes, CR or LF sends.

    Returns the key and order columns of the row with the sending character, ``line_no``, ``line`` and ``dropped``,
    the number of characters that found the line full. A null row is one character that is dropped.
    """
    passed = list(dict.fromkeys(od.names(key) + od.names(order)))
    return folds.run_fold(df, key, order, LineFold(ch, max_len), passed, **opts)


# ----------------------------------------------------------------------------- frames


def frames(df: DataFrame, key, order, value: str, opens=(-1, -3), closes=(-2, -4),
           min_samples: Mapping[int, int] | int = 127, split=None,
           max_rows: int | None = None) -> DataFrame:
    """Samples between an opening and a closing marker, one row per sample.

    An opening marker restarts the frame; a closing marker sends it if it has at
    least ``min_samples`` samples and starts over. ``min_samples`` may differ by
    closing marker; the sender's second channel always sends: ``{-2: 127, -4: 0}``.
    Returns (key, frame_id, idx, value, close, n_samples), ``frame_id`` counting markers seen.
    No frame is gathered, so one that never closes costs no more than its rows.
    """
    split = split or od.measure(df, key, order, max_rows)
    keys, order = list(split.keys), list(split.order)
    marker = F.col(value).isin(*opens, *closes)
    numbered = od.scan(df, keys, order, split, _rn=od.row_number(),
                       _seen=od.running_sum(F.when(marker, 1)))
    # a frame lies between two markers: each sample looks back to one and ahead to the other
    between = od.scan(numbered, keys, order, split,
                      _back=od.last_value(F.when(marker, F.col("_rn"))),
                      _ahead=od.next_value(F.when(marker, F.struct(F.col("_rn").alias("rn"), F.col(value).alias("v")))))
    start = F.coalesce("_back", F.lit(0))
    n_samples = F.col("_ahead.rn") - start - 1
    if isinstance(min_samples, Mapping):
        need = F.lit(0)
        for mark, least in min_samples.items():
            need = F.when(F.col("_ahead.v") == mark, least).otherwise(need)
    else:
        need = F.lit(min_samples)
    sent = ~marker & F.col("_ahead.v").isin(*closes) & (n_samples >= need)
    return between.filter(sent).select(
        *keys, F.col("_seen").alias("frame_id"), (F.col("_rn") - start - 1).alias("idx"), F.col(value),
        F.col("_ahead.v").alias("close"), n_samples.alias("n_samples"),
    )


def frame_arrays(framed: DataFrame, key, value: str, chunk: int = 65536) -> DataFrame:
    """Frames as arrays. A frame longer than ``chunk`` samples takes several rows."""
    part = F.floor(F.col("idx") / chunk).cast("long")
    packed = F.array_sort(F.collect_list(F.struct("idx", F.col(value).alias("v"))))
    return (
        framed.withColumn("chunk", part)
        .groupBy(*od.names(key), "frame_id", "chunk")
        .agg(packed.alias("_p"))
        .withColumn("samples", F.transform("_p", lambda s: s["v"]))
        .drop("_p")
    )


# ----------------------------------------------------------------------------- closing report


def final_report(df: DataFrame, ts: str, depth: str, close: int, key=None, tie=None) -> DataFrame:
    """One row (per key): the first moment at or after ``close`` with nobody left in the queue.

    ``df`` holds the depth after each event. A queue whose last event up to ``close`` left it empty, or that had
    none, reports at ``close``; one that never empties has no row. ``tie`` orders events of one moment.
    """
    last = F.max_by(depth, F.when(F.col(ts) <= close, F.struct(ts, *od.names(tie))))
    after = F.min(F.when((F.col(ts) > close) & (F.col(depth) == 0), F.col(ts)))
    report = F.when(F.coalesce(last, F.lit(0)) == 0, F.lit(close).cast("long")).otherwise(after)
    return df.groupBy(*od.names(key)).agg(report.alias("report_ts")).filter("report_ts is not null")


def collect_n(df: DataFrame, key, order, n: int, accept: Column | None = None) -> DataFrame:
    """The first ``n`` accepted rows of every key."""
    return cap_first(df if accept is None else df.filter(accept), key, order, n)
