"""Joins by position, by label and by snapshot."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import ordered as od

_TICKS_PER_BLOCK = 4096


def positional_join(a: DataFrame, b: DataFrame, order_a, order_b, key=None,
                    how: str = "full_outer", max_rows: int | None = None) -> DataFrame:
    """Row k of ``a`` beside row k of ``b`` (within ``key``); the shorter side is padded with nulls.

    The join key holds the position, so even one key alone spreads over all tasks.
    Non-key columns must differ in name.
    """
    keys = od.names(key)
    clash = (set(a.columns) & set(b.columns)) - set(keys)
    if clash:
        raise ValueError(f"rename {sorted(clash)} on one side first")
    left = od.scan(a, keys, order_a, k=od.row_number(), max_rows=max_rows)
    right = od.scan(b, keys, order_b, k=od.row_number(), max_rows=max_rows)
    right = right.select(
        *[F.col(c).alias(f"_r_{c}") for c in keys], F.col("k").alias("_rk"),
        *[c for c in b.columns if c not in keys],
    )
    cond = F.col("k") == F.col("_rk")
    for c in keys:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(right, cond, how).select(
        *[F.coalesce(c, f"_r_{c}").alias(c) for c in keys],
        F.coalesce("k", "_rk").alias("k"),
        *[c for c in [*a.columns, *b.columns] if c not in keys],
    )


def fifo_match(arrivals: DataFrame, services: DataFrame, queue, ts: str, tie=None,
               max_rows: int | None = None, position: str = "k") -> DataFrame:
    """The k-th arrival of a queue with its k-th service start: (queue, k, arrived, started, wait).

    A null queue is a queue like any other. ``position`` names the column k.
    """
    keys, order = od.names(queue), [ts] + od.names(tie)

    def side(df: DataFrame, name: str) -> DataFrame:
        return od.scan(df, keys, order, _k=od.row_number(), max_rows=max_rows).select(
            *[F.col(c).alias(f"_{name}_{i}") for i, c in enumerate(keys)],
            F.col("_k").alias(f"_{name}_k"), F.col(ts).alias(name)
        )

    same = F.col("_arrived_k") == F.col("_started_k")
    for i in range(len(keys)):
        same = same & F.col(f"_arrived_{i}").eqNullSafe(F.col(f"_started_{i}"))
    return side(arrivals, "arrived").join(side(services, "started"), same).select(
        *[F.col(f"_arrived_{i}").alias(c) for i, c in enumerate(keys)],
        F.col("_arrived_k").alias(position), "arrived", "started",
        (F.col("started") - F.col("arrived")).alias("wait"),
    )


def snapshot(events: DataFrame, key, ts: str, every: int = 3000,
             sums: Mapping[str, Column] | None = None,
             latest: Mapping[str, Column] | None = None, tie=None,
             span: tuple[int, int] | None = None) -> DataFrame:
    """State as of every ``every`` ticks: running ``sums`` and the ``latest`` values so far.

    A key is reported from the tick of its first event on, up to the last tick of all keys. ``span``
    (first and last tick) limits the report; events before it count in its first tick. Events are
    condensed to one row per key and tick before the shuffle; such a row holds its state until the next
    one, and only at the end is each written out for the ticks in between. So all work before the report
    grows with events, however many quiet ticks lie between them. A null key is a key like any other.
    """
    keys = od.names(key)
    sums, latest = dict(sums or {}), dict(latest or {})
    tick = (F.ceil(F.col(ts) / every) * every).cast("long")
    position = F.struct(ts, *od.names(tie))
    events = events.filter(F.col(ts).isNotNull())
    if span is not None:
        tick = F.greatest(tick, F.lit(span[0]).cast("long"))
        events = events.filter(F.col(ts) <= span[1])
    condensed = events.withColumn("tick", tick).groupBy(*keys, "tick").agg(
        *[F.sum(c).alias(f"_i_{n}") for n, c in sums.items()],
        *[F.max_by(c, F.when(c.isNotNull(), position)).alias(f"_i_{n}") for n, c in latest.items()],
    )
    if span is None:
        ends = events.agg(F.min(tick).alias("lo"), F.max(tick).alias("hi")).first()
        span = (ends["lo"] or 0, ends["hi"] or 0)
    lo, hi = span
    split = od.whole(keys, "tick") if (hi - lo) // every < od.DEFAULT_MAX_ROWS else None
    states = od.scan(
        condensed, keys, "tick", split, _next=od.lead("tick", hi + every),
        **{n: od.running_sum(f"_i_{n}") for n in sums},
        **{n: od.last_value(f"_i_{n}") for n in latest},
    )
    # a long quiet stretch is written out in blocks of ticks, so that no array is longer than a block
    last = F.col("_next") - every
    block = every * _TICKS_PER_BLOCK
    held = states.filter(F.col("tick") <= hi).withColumn(
        "_first", F.explode(F.sequence("tick", last, F.lit(block).cast("long"))))
    ticks = F.sequence("_first", F.least(F.col("_first") + (block - every), last), F.lit(every).cast("long"))
    return held.select(*keys, F.explode(ticks).alias("tick"), *sums, *latest)


def label_join(df: DataFrame, code: str, labels: DataFrame, default: str | None = None,
               label_code: str = "code", label: str = "label") -> DataFrame:
    """The label of a code from a table of labels, or ``default``.

    No broadcast is forced: Spark broadcasts the table when it is small enough.
    """
    table = labels.select(F.col(label_code).alias("_code"), F.col(label).alias("_label"))
    joined = df.join(table, F.col(code) == F.col("_code"), "left")
    return joined.withColumn(label, F.coalesce("_label", F.lit(default))).drop("_code", "_label")
