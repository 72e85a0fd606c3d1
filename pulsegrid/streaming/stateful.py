"""The stateful operators on streams.

A stream uses the same folds as the batch operators. Rows are put in the order of their events, whatever
files and micro-batches they arrive in: the rows of a bucket of keys wait in its state, in parts of time and chunks of rows, until the
watermark has passed a part (no earlier row can come then), a timer wakes the bucket for that, and only then the fold sees it. ``lateness``
says how far rows may be out of order; later ones are dropped by Spark and counted. A run over a finished input
ends with a closing row far in the future, which moves the watermark past everything.

In any order nothing is due before the input ends. Then no row waits in a state: ``run_to_table`` appends each
micro-batch to a table in the shared folder and runs the batch operator, which cuts large keys, over it at the end.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Callable, Iterator, Mapping
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type as arrow_type
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators import states as batch_states
from ..operators.states import SERVO_TRANSITIONS, DebounceFold, LineFold, MachineFold
from ..plans import ordered as od
from ..plans.folds import Fold
from ..plans.ordered import names
from ..session import workspace

#: event times are milliseconds after this one, so that orders from 0 on lie after the first watermark
ORIGIN = 10**12
#: the closing row, and how far rows may be out of order unless said otherwise: any order of a finished input
CLOSING, ANY_ORDER = 9 * 10**12, 4 * 10**12
#: the watermark of the closing row is no smaller; all events lie before it
LAST = CLOSING - ANY_ORDER
#: rows in one value of a key's waiting rows
CHUNK = 50_000
#: states of many values need a store that keeps them apart
PARTITIONS = "spark.sql.shuffle.partitions"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def event_time(stream: DataFrame, ts: str) -> DataFrame:
    """``ts`` as a timestamp with time zone, which watermarks need (session zone UTC)."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp"))


def closing_rows(stream: DataFrame) -> tuple[DataFrame, str]:
    """``stream`` together with a folder that holds nothing until the input has ended."""
    spark = stream.sparkSession
    end = workspace(spark, "closing")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema])
    spark.createDataFrame([], schema).write.parquet(end)
    return stream.unionByName(spark.readStream.schema(schema).parquet(end)), end


#: buckets that the keys of a stream are dealt into; a session with far more keys sets more
BUCKETS = "pulsegrid.stream.buckets"
_NAN = float("nan")


def _key(values) -> tuple:
    """Key values that can be told apart as Spark does."""
    return tuple(_NAN if v != v else tuple(v) if isinstance(v, list) else bytes(v) if isinstance(v, bytearray) else v
                 for v in values)


def _rank(value) -> tuple:
    """Nulls first, then numbers, then what is none."""
    return value is not None, value != value, value


class _InOrder(StatefulProcessor):
    """Keeps a bucket's rows until the watermark has passed them, then hands them to ``process`` in event order.

    Rows wait in parts, an eighth of the lateness each, and a part in chunks of at most CHUNK rows: values of a map
    state of their own. A new row adds a chunk and reads none. Every part has a timer at its end; then only its chunks
    are read, sorted, handled and removed. So a task holds one part of a bucket, and no value grows with the lateness.
    The other state is how many chunks each open part has, and what ``process`` carries of each key in the bucket. A
    bucket costs a call or two a part and micro-batch, however many keys are in it.
    """

    def __init__(self, keys: list[int], order: list[int], lateness: int, process):
        self.keys, self.order, self.process = keys, order, process
        self.width = max(1, lateness // 8)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "s string")
        self.carried = handle.getValueState("carried", "s binary")
        self.held = handle.getMapState("held", "part long, chunk long", "rows binary")

    def _ends(self, part: int) -> int:
        return min((part + 1) * self.width, LAST)

    def _parts(self) -> dict[int, int]:
        """The number of chunks of each open part."""
        return {int(p): n for p, n in json.loads(self.open.get()[0]).items()} if self.open.exists() else {}

    def _keep(self, parts: dict[int, int], part: int, rows: list[tuple]) -> None:
        if part not in parts:
            self.handle.registerTimer(self._ends(part))
        parts[part] = parts.get(part, 0) + 1
        self.held.updateValue((part, parts[part]), (pickle.dumps(rows),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        parts, fresh = None, {}
        for row in rows:
            if row[-1]:
                continue
            if parts is None:
                parts = self._parts()
            part = row[-3] // self.width
            waiting = fresh.get(part)
            if waiting is None:
                waiting = fresh[part] = []
            waiting.append(row[:-4])
            if len(waiting) == CHUNK:
                self._keep(parts, part, fresh.pop(part))
        for part, waiting in fresh.items():
            self._keep(parts, part, waiting)
        if parts is not None:
            self.open.update((json.dumps(parts),))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        parts = self._parts()
        due = sorted(p for p in parts if self._ends(p) <= mark)
        if not due:  # another timer of this micro-batch has handled the part
            return
        states = {_key(k): v for k, v in pickle.loads(self.carried.get()[0])} if self.carried.exists() else {}
        for p in due:
            chunks = [(p, n + 1) for n in range(parts.pop(p))]
            rows = [r for c in chunks for r in pickle.loads(self.held.getValue(c)[0])]
            for c in chunks:
                self.held.removeKey(c)
            for i in reversed(self.order):
                plain = not any(r[i] is None or r[i] != r[i] for r in rows)
                rows.sort(key=itemgetter(i) if plain else lambda r, i=i: _rank(r[i]))
            of: dict[tuple, list] = {}
            for r in rows:
                of.setdefault(_key(r[i] for i in self.keys), []).append(r)
            yield from self.process(of, states)
        self.carried.update((pickle.dumps(list(states.items())),))
        self.open.update((json.dumps(parts),))

    def close(self) -> None:
        pass


def _timed(stream: DataFrame, keys: list[str], order: str, need: list[str], lateness: int) -> tuple[DataFrame, str]:
    """The rows with their event time as ``_ms`` and ``_at``, under a watermark, and with ``_bucket``, a number of
    their key; and the folder of the closing row, whose ``_end`` is true."""
    at = F.col(order)
    if isinstance(stream.schema[order].dataType, (T.TimestampType, T.TimestampNTZType)):
        at = F.unix_millis(at.cast("timestamp"))
    ms = at.cast("long") + ORIGIN
    buckets = int(stream.sparkSession.conf.get(BUCKETS, "256"))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)) if keys else F.lit(0).cast("long")
    stream = stream.select(*need, bucket.alias("_bucket"), ms.alias("_ms"), F.timestamp_millis(ms).alias("_at"),
                           F.lit(False).alias("_end"))
    stream, end = closing_rows(stream.filter("_at is not null"))
    return stream.withWatermark("_at", f"{lateness} milliseconds"), end


def _at_end(result: DataFrame, stream: DataFrame, need: list[str], order: str, lateness: int, whole,
            trim=None) -> DataFrame:
    """``result`` that ``run_to_table`` gets by ``whole(table)`` over all rows if they may come in any order. ``trim``
    leaves the rows of a micro-batch that ``whole`` can still need."""
    if lateness >= ANY_ORDER:
        result.source = stream.select(*need).filter(F.col(order).isNotNull())
        result.whole, result.trim = whole, trim
    return result


def stream_fold(stream: DataFrame, keys, order, fold: Fold, passed: list[str], lateness: int = ANY_ORDER) -> DataFrame:
    """A fold per key over a stream, in the order of events. The first order column is the event time (a time,
    or a number from -10**12 to 4 * 10**12); rows without it are left out. Keys are dealt into ``BUCKETS`` buckets. State
    per bucket: the fold's of each key, and the rows of the last ``lateness`` (milliseconds, or units of the number), in
    chunks; a task holds an eighth of them."""
    keys, order = names(keys), names(order)
    need = list(dict.fromkeys(keys + order + list(fold.inputs) + passed))
    out = T.StructType([stream.schema[c] for c in passed] + list(fold.extra))
    kinds = [arrow_type(stream.schema[c].dataType) for c in fold.inputs]
    inputs, kept = [need.index(c) for c in fold.inputs], [need.index(c) for c in passed]
    named = Row(*out.names)

    def process(of: dict[tuple, list], states: dict) -> Iterator[Row]:
        rows = [r for some in of.values() for r in some]
        starts = np.cumsum([0, *map(len, of.values())])[:-1]
        cols = [pa.array([r[i] for r in rows], kind, from_pandas=True) for i, kind in zip(inputs, kinds)]
        at, extra, after = fold.runs(cols, starts, [states[k] if k in states else fold.initial() for k in of])
        states.update(zip(of, after))
        extra = [x.to_pylist() if isinstance(x, pa.Array) else x for x in extra]
        sent = rows if at is None else [rows[i] for i in at.tolist()]
        for row, *more in zip(sent, *extra):
            yield named(*[row[i] for i in kept], *more)

    timed, end = _timed(stream, keys, order[0], need, lateness)
    result = timed.groupBy("_bucket").transformWithState(
        _InOrder([need.index(k) for k in keys], [need.index(c) for c in order], lateness, process), out, "Append", "EventTime")
    result.closing, result.provider = end, ROCKS
    return result


def debounce(stream: DataFrame, key, ts: str, min_gap: int, initial_last: int | None = None,
             tie: str | None = None, lateness: int = ANY_ORDER) -> DataFrame:
    out = stream_fold(stream, key, [ts] + names(tie), DebounceFold(ts, min_gap, initial_last), stream.columns, lateness)
    return _at_end(out, stream, stream.columns, ts, lateness,
                   lambda table: batch_states.debounce(table, key, ts, min_gap, initial_last, tie))


def state_machine(stream: DataFrame, key, order, event: str,
                  transitions: Mapping[tuple[str, str], str] = SERVO_TRANSITIONS,
                  initial: str = "paused", lateness: int = ANY_ORDER) -> DataFrame:
    out = stream_fold(stream, key, order, MachineFold(event, transitions, initial), stream.columns, lateness)
    return _at_end(out, stream, stream.columns, names(order)[0], lateness,
                   lambda table: batch_states.state_machine(table, key, order, event, transitions, initial))


def assemble_lines(stream: DataFrame, key, order, ch: str, max_len: int = 80, lateness: int = ANY_ORDER) -> DataFrame:
    need = list(dict.fromkeys(names(key) + names(order)))
    out = stream_fold(stream, key, order, LineFold(ch, max_len), need, lateness)
    return _at_end(out, stream, list(dict.fromkeys([*need, ch])), names(order)[0], lateness,
                   lambda table: batch_states.assemble_lines(table, key, order, ch, max_len))


class FrameFold(Fold):
    """State: [markers seen, samples since the last marker]. A sent frame is one array."""

    def __init__(self, value: str, opens, closes, min_samples: Mapping[int, int] | int):
        self.inputs = (value,)
        self.extra = (
            T.StructField("frame_id", T.LongType()),
            T.StructField("close", T.LongType()),
            T.StructField("samples", T.ArrayType(T.LongType())),
        )
        self.opens, self.closes, self.need = set(opens), set(closes), min_samples

    def initial(self):
        return [0, []]

    def _least(self, mark: int) -> int:
        return self.need.get(mark, 0) if isinstance(self.need, Mapping) else self.need

    def runs(self, cols, starts, states):
        marks = np.flatnonzero(pc.is_in(cols[0], pa.array([*self.opens, *self.closes], cols[0].type)).to_numpy(zero_copy_only=False))
        ends = np.append(starts[1:], len(cols[0]))
        cuts, marks, values = np.searchsorted(marks, [starts, ends]).T.tolist(), marks.tolist(), cols[0].to_pylist()
        rows, out, after = [], [], []
        for lo, hi, (first, last), (seen, samples) in zip(starts.tolist(), ends.tolist(), cuts, states):
            for at in marks[first:last]:
                mark, samples = values[at], samples + values[lo:at]
                if mark in self.closes and len(samples) >= self._least(mark):
                    rows.append(at)
                    out.append((seen, mark, samples))
                seen, samples, lo = seen + 1, [], at + 1
            after.append([seen, samples + values[lo:hi]])
        return np.array(rows, np.int64), [list(x) for x in zip(*out)] or [[], [], []], after


def frames(stream: DataFrame, key, order, value: str, opens=(-1, -3), closes=(-2, -4),
           min_samples: Mapping[int, int] | int = 127, lateness: int = ANY_ORDER) -> DataFrame:
    """(key, frame_id, close, samples) when the closing marker of a frame arrives. A frame is one array."""
    fold, keys, along = FrameFold(value, opens, closes, min_samples), names(key), names(order)

    def whole(table: DataFrame) -> DataFrame:
        split = od.measure(table, keys, along)
        marker = F.coalesce(F.col(value).isin(*opens, *closes), F.lit(False))
        numbered = od.scan(table, keys, along, split, _rn=od.row_number(),
                           _seen=od.running_sum(F.when(marker, 1).otherwise(0)))
        # rows of frames that nothing closes go before any frame is gathered
        ahead = od.scan(numbered, keys, along, split, _close=od.next_value(F.when(marker, F.col(value))))
        samples = F.array_sort(F.collect_list(F.when(~marker, F.struct("_rn", F.col(value).cast("long").alias("v")))))
        sent = ahead.filter(F.col("_close").isin(*closes)).withColumn(
            "frame_id", (F.col("_seen") - F.when(marker, 1).otherwise(0)).cast("long")).groupBy(*keys, "frame_id").agg(
            F.max("_close").cast("long").alias("close"), F.transform(samples, lambda x: x["v"]).alias("samples"))
        least = F.lit(0 if isinstance(min_samples, Mapping) else min_samples)
        for mark, n in min_samples.items() if isinstance(min_samples, Mapping) else ():
            least = F.when(F.col("close") == mark, n).otherwise(least)
        return sent.filter(F.size("samples") >= least)

    return _at_end(stream_fold(stream, key, order, fold, keys, lateness), stream,
                   list(dict.fromkeys([*keys, *along, value])), along[0], lateness, whole)


class _Closing(StatefulProcessor):
    """The report of a queue. No row waits: state per queue is the last event up to ``close``, the first moment after it
    with nobody left, and whether it has reported. A timer wakes the queue at ``close``, another one at that moment."""

    def __init__(self, order: list[int], depth: int, keys: int, close: int, named):
        self.order, self.depth, self.keys, self.close_, self.named = order, depth, keys, close, named

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "s binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        at, ties, depth, close = self.order[0], self.order[1:], self.depth, self.close_
        began = fresh = self.known.exists()
        last, empty, given = pickle.loads(self.known.get()[0]) if began else (None, None, False)
        was = empty
        for row in rows:
            if row[-1]:
                continue
            fresh = True
            if given:
                continue
            ts = row[at]
            if ts > close:
                if row[depth] == 0 and (empty is None or ts < empty):
                    empty = ts
            elif last is None or ts >= last[0][0]:
                order = ts, *[_rank(row[i]) for i in ties]
                if last is None or order >= last[0]:
                    last = order, row[depth]
        if fresh:  # a queue that only the closing row has is none
            if not began:
                self.handle.registerTimer(close + ORIGIN)
            if empty != was:
                self.handle.registerTimer(empty + ORIGIN)
            self.known.update((pickle.dumps((last, empty, given)),))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        last, empty, given = pickle.loads(self.known.get()[0])
        passed = timerValues.getCurrentWatermarkInMs() - ORIGIN
        if given or passed < self.close_:
            return
        report = self.close_ if last is None or not last[1] else empty if empty is not None and empty <= passed else None
        if report is not None:
            self.known.update((pickle.dumps((None, None, True)),))
            yield self.named(*key[:self.keys], report)

    def close(self) -> None:
        pass


def final_report(stream: DataFrame, key, ts: str, depth: str, close: int, tie=None,
                 lateness: int = ANY_ORDER) -> DataFrame:
    """(key, ts): one row per key, the first moment at or after ``close`` with an empty queue. A queue that is
    empty at ``close`` reports when the watermark passes it, by a timer, if no event comes."""
    keys, order = names(key), [ts] + names(tie)
    out = T.StructType([stream.schema[c] for c in keys] + [T.StructField(ts, T.LongType())])
    need = list(dict.fromkeys(keys + order + [depth]))
    timed, end = _timed(stream, keys, ts, need, lateness)
    result = timed.groupBy(*(keys or ["_bucket"])).transformWithState(
        _Closing([need.index(c) for c in order], need.index(depth), len(keys), close, Row(*out.names)), out, "Append", "EventTime")
    result.closing, result.provider = end, ROCKS
    return _at_end(
        result, stream, need, ts, lateness,
        lambda table: batch_states.final_report(table, ts, depth, close, keys, tie).withColumnRenamed("report_ts", ts))


class CountFold(Fold):
    """State: rows accepted so far."""

    def __init__(self, order: str, n: int):
        self.inputs = (order,)
        self.n = n

    def initial(self):
        return 0

    def runs(self, cols, starts, states):
        size = np.diff(np.append(starts, len(cols[0])))
        take = np.minimum(size, self.n - np.array(states))
        rows = [np.arange(lo, lo + n) for lo, n in zip(starts.tolist(), take.tolist())]
        return np.concatenate(rows), [], (np.array(states) + take).tolist()


def collect_n(stream: DataFrame, key, order, n: int, lateness: int = ANY_ORDER) -> DataFrame:
    """The first ``n`` rows of every key along ``order``, then nothing more from it."""
    def first(table: DataFrame) -> DataFrame:
        return batch_states.collect_n(table, key, order, n)

    return _at_end(stream_fold(stream, key, order, CountFold(names(order)[0], n), stream.columns, lateness), stream, stream.columns,
                   names(order)[0], lateness, first, first)


# ----------------------------------------------------------------------------- aggregates


def periodic_metrics(stream: DataFrame, ts: str, every: str, watermark: str, keys=None, **aggs) -> DataFrame:
    """Tumbling metrics every ``every``; rows later than ``watermark`` are dropped by Spark and counted
    (``late_rows`` of the table that ``run_to_table`` gives). At the end of a finished input all windows close."""
    timed = event_time(stream, ts)
    end = None
    if stream.isStreaming:
        timed, end = closing_rows(timed)
        timed = timed.withWatermark(ts, watermark)
    grouped = timed.groupBy(F.window(ts, every), *names(keys)).agg(
        *[c.alias(n) for n, c in aggs.items()]
    )
    out = grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *names(keys), *aggs,
    )
    if end is not None:
        out.closing, out.closing_time = end, ts
    return out


def running_totals(stream: DataFrame, server, duration: str) -> DataFrame:
    """Customers served, total and longest service per server, updated with every event."""
    return stream.groupBy(*names(server)).agg(
        F.count(F.lit(1)).alias("served"),
        F.sum(duration).alias("total_service"),
        F.max(duration).alias("max_service"),
    )


# ----------------------------------------------------------------------------- running


def table_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType,
                 bytes_per_trigger: int = 512 << 20) -> DataFrame:
    """A stream over the files of one table, which is a file or a folder of part files.

    Each micro-batch takes at most about ``bytes_per_trigger``.
    """
    path = f"{folder}/{name}.parquet"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(schema).option("maxBytesPerTrigger", bytes_per_trigger)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def run_to_table(stream: DataFrame, purpose: str) -> DataFrame:
    """Run an append stream over all available input into a table in the shared folder, and read it. ``late_rows``
    of the table is the number of rows that came after their watermark."""
    spark = stream.sparkSession
    if getattr(stream, "whole", None) is not None:
        return _run_whole(stream, purpose)
    out = workspace(spark, purpose)
    late = 0

    def run() -> None:
        nonlocal late
        usual, parts = spark.conf.get(PROVIDER), spark.conf.get(PARTITIONS)
        if getattr(stream, "provider", None) is not None:
            # a store is opened and committed in every micro-batch: no more of them than tasks run at a time
            spark.conf.set(PROVIDER, stream.provider)
            spark.conf.set(PARTITIONS, min(int(parts), max(2, spark.sparkContext.defaultParallelism)))
        try:
            query = (
                stream.writeStream.format("parquet").outputMode("append")
                .option("path", f"{out}/data").option("checkpointLocation", f"{out}/progress")
                .trigger(availableNow=True).start()
            )
            query.awaitTermination()
        finally:
            spark.conf.set(PROVIDER, usual)
            spark.conf.set(PARTITIONS, parts)
        late += sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])

    run()
    end = getattr(stream, "closing", None)
    if end is not None:
        time = getattr(stream, "closing_time", "_at")
        held = spark.read.parquet(end)
        row = held.sparkSession.range(1).select(*[
            F.timestamp_millis(F.lit(CLOSING)).alias(f.name) if f.name == time
            else F.lit(True).alias(f.name) if f.name == "_end" else F.lit(None).cast(f.dataType).alias(f.name)
            for f in held.schema])
        row.write.mode("append").parquet(end)
        run()
    table = spark.read.schema(stream.schema).parquet(f"{out}/data")
    table.late_rows = late
    return table


def _run_whole(stream: DataFrame, purpose: str) -> DataFrame:
    """All rows of the source as a table, each micro-batch under its own number, then the batch operator over it."""
    spark, source = stream.sparkSession, stream.source
    rows = f"{workspace(spark, purpose)}/rows"
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in source.schema])
    spark.createDataFrame([], schema).write.parquet(f"{rows}/_batch=-1")

    def store(batch: DataFrame, batch_id: int) -> None:
        (batch if stream.trim is None else stream.trim(batch)).write.mode("overwrite").parquet(f"{rows}/_batch={batch_id}")

    each_batch(source, store, purpose=purpose)
    table = stream.whole(spark.read.schema(schema).parquet(rows).select(*schema.names)).select(*stream.columns)
    table.late_rows = 0
    return table


def each_batch(stream: DataFrame, handler: Callable[[DataFrame, int], None], mode: str = "append",
               purpose: str = "each-batch") -> None:
    """Call ``handler(batch, batch_id)`` for every micro-batch until the input is used up."""
    spark = stream.sparkSession
    query = (
        stream.writeStream.outputMode(mode).foreachBatch(handler)
        .option("checkpointLocation", f"{workspace(spark, purpose)}/progress")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def run_updates(stream: DataFrame, keys, purpose: str) -> DataFrame:
    """Run an update-mode stream; the newest version of every key.

    Each micro-batch writes its updates under its own number, so a repeated batch
    overwrites itself.
    """
    spark = stream.sparkSession
    out = workspace(spark, purpose)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/data/batch={batch_id}")

    each_batch(stream, store, "update", purpose)
    schema = T.StructType(stream.schema.fields + [T.StructField("batch", T.LongType())])
    versions = spark.read.schema(schema).parquet(f"{out}/data")
    rest = [c for c in stream.columns if c not in names(keys)]
    newest = versions.groupBy(*names(keys)).agg(F.max_by(F.struct(*rest), "batch").alias("_v"))
    return newest.select(*names(keys), "_v.*")
