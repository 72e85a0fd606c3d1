"""Sorting, first/last rows, caps, and stacking of runs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.ordered import names, row_number, scan


def sort_by(df: DataFrame, keys, absolute: Sequence[str] = (), descending: Sequence[str] = ()) -> DataFrame:
    """Total order by ``keys``; keys in ``absolute`` compare by size, largest first.

    A hash of the row comes last, so that rows with one very frequent key value
    spread over several tasks and ties come out the same every time.
    """
    by: list[Column] = []
    for k in names(keys):
        if k in absolute:
            by.append(F.abs(k).desc())
        else:
            by.append(F.col(k).desc() if k in descending else F.col(k).asc())
    return df.orderBy(*by, F.xxhash64(*df.columns))


def sort_array_with(values, compare: Callable[[Column, Column], Column]) -> Column:
    """An array sorted by a caller's comparator: negative, zero or positive as in C."""
    return F.array_sort(values, compare)


def larger_first(a: Column, b: Column) -> Column:
    """By absolute value, largest first; equal sizes in rising order."""
    return (
        F.when(F.abs(a) > F.abs(b), -1).when(F.abs(a) < F.abs(b), 1)
        .when(a < b, -1).when(a > b, 1).otherwise(0)
    )


def sort_array_by_size(values) -> Column:
    return sort_array_with(values, larger_first)


def head_tail(df: DataFrame, order, n: int = 6) -> DataFrame:
    """The first and last ``n`` rows with ``side`` and ``place``; each side is a top-n, not a sort."""
    order = names(order)
    first = df.orderBy(*[F.col(c).asc() for c in order]).limit(n)
    last = df.orderBy(*[F.col(c).desc() for c in order]).limit(n)
    return first.withColumn("side", F.lit("first")).unionByName(
        last.withColumn("side", F.lit("last"))
    )


#: up to this many rows per key Spark trims every task's rows before it moves them
_TRIMMED = 1000


def cap_first(df: DataFrame, key, order, n: int, salts: int = 64) -> DataFrame:
    """The first ``n`` rows of each key along ``order``.

    Two rounds: the first ``n`` of each (key, salt), then of each key. Spark also
    trims to ``n`` before each shuffle, so a key with a third of all rows never
    meets in one task. For a large ``n`` the rows are numbered by an ordered scan.
    """
    keys, order = names(key), names(order)
    if n > _TRIMMED:
        return scan(df, keys, order, _rank=row_number()).filter(F.col("_rank") <= n).drop("_rank")
    by = [F.col(c) for c in order]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    inner = Window.partitionBy(*keys, "_salt").orderBy(*by)
    outer = Window.partitionBy(*keys).orderBy(*by)
    few = salted.withColumn("_rank", F.row_number().over(inner)).filter(F.col("_rank") <= n)
    kept = few.withColumn("_rank", F.row_number().over(outer)).filter(F.col("_rank") <= n)
    return kept.drop("_salt", "_rank")


def concat_runs(dfs: Sequence[DataFrame], labels: Sequence[str]) -> DataFrame:
    """Stack the outputs of several runs; ``source`` says which run a row came from."""
    tagged = [d.withColumn("source", F.lit(label)) for d, label in zip(dfs, labels, strict=True)]
    return reduce(lambda a, b: a.unionByName(b), tagged)
