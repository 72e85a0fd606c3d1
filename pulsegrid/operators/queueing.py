"""Queue and server metrics, stopwatches, sessions and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import ordered as od


def depth_over_time(arrivals: DataFrame, departures: DataFrame, queue, ts: str, tie=None,
                    split: od.Split | None = None, max_rows: int | None = None) -> DataFrame:
    """(queue, ts, tie, delta, depth, peak): people in a queue after every arrival or departure.

    At equal times arrivals come first, so the depth counts someone who leaves at once.
    """
    keys, ties = od.names(queue), od.names(tie)
    cols = [*keys, ts, *ties]
    events = (
        arrivals.select(*cols).withColumn("delta", F.lit(1))
        .unionByName(departures.select(*cols).withColumn("delta", F.lit(-1)))
        .withColumn("_later", F.when(F.col("delta") < 0, 1).otherwise(0))
    )
    order = [ts, "_later", *ties]
    return od.scan(events, keys, order, split, max_rows, depth=od.running_sum("delta"),
                   peak=od.running_peak("delta")).drop("_later")


def idle_gaps(df: DataFrame, server, start: str, end: str, day_start: int = 0, tie=None, **opts) -> DataFrame:
    """Time a server waited before each service; the first gap starts with the day."""
    seen = od.scan(df, server, [start] + od.names(tie), _prev=od.lag(end, day_start), **opts)
    return seen.withColumn("idle", F.col(start) - F.col("_prev")).drop("_prev")


def _whole_minutes(total: Column, n: Column) -> Column:
    """Mean as whole ticks, then whole minutes of 100 ticks; null for n = 0."""
    return _div(_div(total, F.nullif(n, F.lit(0))), F.lit(100))


def _div(a: Column, b: Column) -> Column:
    """Whole-number division, exact for every long."""
    return F.call_function("div", a, b)


def server_report(services: DataFrame, breaks: DataFrame, server: str, start: str = "start",
                  end: str = "end", day_start: int = 0, tie=None, n_servers: int | None = None,
                  **opts) -> DataFrame:
    """One row per server: customers, service, idle and break times in whole minutes.

    ``avg_idle`` is the mean gap; ``ref_idle_div`` divides the idle total by the number
    of servers, as the printed report does. Break texts say so when there were none.
    """
    gaps = idle_gaps(services, server, start, end, day_start, tie, **opts)
    work = gaps.groupBy(server).agg(
        F.count(F.lit(1)).alias("served"),
        F.sum(F.col(end) - F.col(start)).alias("_service"),
        F.max(F.col(end) - F.col(start)).alias("_longest_service"),
        F.sum("idle").alias("_idle"),
        F.max("idle").alias("_longest_idle"),
    )
    rest = breaks.groupBy(server).agg(
        F.count(F.lit(1)).alias("breaks"),
        F.sum(F.col(end) - F.col(start)).alias("_break"),
        F.max(F.col(end) - F.col(start)).alias("_longest_break"),
        F.min(F.col(end) - F.col(start)).alias("_shortest_break"),
    )
    both = work.join(rest, server, "full_outer").na.fill(
        0, ["served", "_service", "_longest_service", "_idle", "_longest_idle", "breaks", "_break",
            "_longest_break"]
    )
    if n_servers is None:
        # the rows of ``both`` are the servers; counting them reuses its shuffles
        servers = both.agg(F.count(F.lit(1)).alias("c")).scalar()
    else:
        servers = F.lit(n_servers)

    def minutes(c: str) -> Column:
        return _div(F.col(c), F.lit(100))

    none = F.lit("none")
    avg_break = _whole_minutes(F.col("_break"), F.col("breaks"))
    return both.select(
        server,
        "served",
        _whole_minutes(F.col("_service"), F.col("served")).alias("avg_service"),
        minutes("_longest_service").alias("max_service"),
        _whole_minutes(F.col("_idle"), F.col("served")).alias("avg_idle"),
        _whole_minutes(F.col("_idle"), servers).alias("ref_idle_div"),
        minutes("_longest_idle").alias("max_idle"),
        "breaks",
        F.when(F.col("breaks") > 0, avg_break.cast("string")).otherwise(none).alias("avg_break"),
        minutes("_longest_break").alias("longest_break"),
        F.when(F.col("breaks") > 0, minutes("_shortest_break").cast("string")).otherwise(none)
        .alias("shortest_break"),
    )


def queue_report(matched: DataFrame, depth: DataFrame, queue: str) -> DataFrame:
    """Per queue: served, mean and longest wait in whole minutes, and the greatest depth."""
    waits = matched.groupBy(queue).agg(
        F.count(F.lit(1)).alias("served"),
        F.sum("wait").alias("_total"),
        F.max("wait").alias("_longest"),
    )
    deepest = depth.groupBy(queue).agg(F.max("depth").alias("max_depth"))
    return waits.join(deepest, queue, "full_outer").select(
        queue,
        F.coalesce("served", F.lit(0)).alias("served"),
        _whole_minutes(F.col("_total"), F.col("served")).alias("avg_wait"),
        _div(F.col("_longest"), F.lit(100)).alias("max_wait"),
        "max_depth",
    )


def queue_day(arrivals: DataFrame, starts: DataFrame, departures: DataFrame, queue, ts: str, tie=None,
              max_rows: int | None = None) -> DataFrame:
    """``queue_report`` from the events themselves, in one ordered pass: (queue, served, avg_wait, max_wait, max_depth).

    All events of a queue are measured and sorted once, arrivals first at equal times. That pass numbers arrivals and
    starts and keeps the depth; the k-th arrival and the k-th start then meet as one group, without a join. A queue that
    nobody came to or left is not reported; a null queue is a queue like any other.
    """
    keys, ties = od.names(queue), od.names(tie)
    cols = [*keys, ts, *ties]
    events = arrivals.select(*cols, F.lit(0).alias("_kind"))
    for kind, side in ((1, starts), (2, departures)):
        events = events.unionByName(side.select(*cols, F.lit(kind).alias("_kind")))
    came, started = F.col("_kind") == 0, F.col("_kind") == 1
    seen = od.scan(
        events, keys, [ts, "_kind", *ties], max_rows=max_rows,
        _a=od.running_sum(came.cast("int")), _s=od.running_sum(started.cast("int")),
        _depth=od.running_sum(F.when(came, 1).when(started, 0).otherwise(-1)))
    # departures have no turn: their group is folded to one row in every task before it moves
    turns = seen.withColumn("_k", F.when(came, F.col("_a")).when(started, F.col("_s"))).groupBy(*keys, "_k").agg(
        (F.max(came) & F.max(started)).alias("_both"),
        (F.max(F.when(started, F.col(ts))) - F.max(F.when(came, F.col(ts)))).alias("_wait"),
        F.max(F.when(~started, F.col("_depth"))).alias("_deep"),
    )
    return turns.groupBy(*keys).agg(
        F.count(F.when(F.col("_both"), 1)).alias("served"),
        F.sum(F.when(F.col("_both"), F.col("_wait"))).alias("_total"),
        F.max(F.when(F.col("_both"), F.col("_wait"))).alias("_longest"),
        F.max("_deep").alias("max_depth"),
    ).filter("max_depth is not null").select(
        *keys, "served", _whole_minutes(F.col("_total"), F.col("served")).alias("avg_wait"),
        _div(F.col("_longest"), F.lit(100)).alias("max_wait"), "max_depth")


def stopwatch(df: DataFrame, key, ts: str, tie=None, **opts) -> DataFrame:
    """Alternate presses start and stop the watch: (key, start, stop, elapsed)."""
    seen = od.scan(df, key, [ts] + od.names(tie), _rn=od.row_number(), stop=od.lead(ts), **opts)
    closed = seen.filter((F.col("_rn") % 2 == 1) & F.col("stop").isNotNull())
    return closed.select(
        *od.names(key), F.col(ts).alias("start"), "stop", (F.col("stop") - F.col(ts)).alias("elapsed")
    )


def timer_sessions(df: DataFrame, key, ts: str, kind: str, tie=None, start: str = "start",
                   stop: str = "stop", **opts) -> DataFrame:
    """Time between starts and stops per key. Starting a running timer restarts it and is an error;
    stopping a stopped one is an error."""
    used = df.filter(F.col(kind).isin(start, stop))
    seen = od.scan(used, key, [ts] + od.names(tie), _kind=od.lag(kind), _from=od.lag(ts), **opts)
    running = F.coalesce(F.col("_kind") == start, F.lit(False))
    is_stop = F.col(kind) == stop
    good = is_stop & running
    return seen.groupBy(*od.names(key)).agg(
        F.sum(F.when(good, F.col(ts) - F.col("_from")).otherwise(0)).alias("elapsed"),
        F.count(F.when(good, 1)).alias("sessions"),
        F.count(F.when(~is_stop & running, 1)).alias("start_errors"),
        F.count(F.when(is_stop & ~running, 1)).alias("stop_errors"),
        (F.max_by(kind, F.struct(ts, *od.names(tie))) == start).alias("running"),
    )


def running_extremes(df: DataFrame, key, order, value: str, **opts) -> DataFrame:
    """The largest and smallest value seen so far."""
    return od.scan(df, key, order, running_max=od.running_max(value),
                   running_min=od.running_min(value), **opts)


def balance_audit(df: DataFrame, key, kind: str, opens: str = "open", closes: str = "close") -> DataFrame:
    """Keys whose opens and closes do not balance, and by how much."""
    c = F.col(kind)
    return (
        df.filter(c.isin(opens, closes))
        .groupBy(*od.names(key))
        .agg(F.sum(F.when(c == opens, 1).otherwise(-1)).alias("balance"), F.count(F.lit(1)).alias("events"))
        .filter(F.col("balance") != 0)
    )


def opcode_counts(decoded: DataFrame) -> DataFrame:
    return decoded.groupBy("op").agg(F.count(F.lit(1)).alias("n"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))
