"""Ordered scans per key that stay parallel when one key is very large.

A plain Spark window sends every row of a key to one task. That is right for
ordinary keys and hopeless for a key that holds a third of the table. Here the
row count per key is measured first:

* no key above ``max_rows``  -> one ordinary window, one shuffle, one sort;
* otherwise the large keys are cut, in order, into segments of about
  ``max_rows`` rows. Rows are shuffled by (key, segment), the window runs inside
  a segment, and what earlier segments contribute (a count, a sum, an extreme,
  the last row) comes from one small summary row per segment.

Both ways give the same rows. Segments follow from fixed cut values held in the
plan, so a lost executor recomputes the same segments.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: rows one task may take for one key; session setting ``pulsegrid.window.maxRows``
DEFAULT_MAX_ROWS = 4_000_000
#: at most this many keys are cut; every key left whole is then no larger than
#: max(max_rows, table rows / MAX_HOT_KEYS)
MAX_HOT_KEYS = 2048
#: at most about this many segments in all, so summaries stay small
MAX_SEGMENTS = 16384
_SAMPLE_PER_SEGMENT = 16
#: cuts are looked up in two steps of at most about this many
_BLOCK = 128

SEG = "_seg"


def names(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


@dataclass(frozen=True)
class Split:
    """Where large keys are cut, and the most cuts of a key. ``cuts`` is None when no key needs it."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    cuts: DataFrame | None = None
    most: int = 0


def whole(keys, order) -> Split:
    """For groups whose size is bounded by construction (the elements of one array)."""
    return Split(tuple(names(keys)), tuple(names(order)))


def measure(df: DataFrame, keys, order, max_rows: int | None = None,
            sizes: DataFrame | None = None) -> Split:
    """Count rows per key and choose cut values for the keys above ``max_rows``.

    ``order`` must tell the rows of a key apart. What reaches the driver is
    bounded: MAX_HOT_KEYS counts and about MAX_SEGMENTS cut values, placed by a
    sample of 16 rows per segment. ``sizes`` (the keys and ``_n``) may give the
    counts when there is a cheaper way to them than counting ``df``.
    """
    keys, order = names(keys), names(order)
    spark = df.sparkSession
    if max_rows is None:
        max_rows = int(spark.conf.get("pulsegrid.window.maxRows", str(DEFAULT_MAX_ROWS)))
    if sizes is None:
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    counts = sizes.filter(F.col("_n") > max_rows)
    if keys:
        counts = counts.orderBy(F.col("_n").desc()).limit(MAX_HOT_KEYS)
    hot = counts.collect()
    if not hot:
        return Split(tuple(keys), tuple(order))

    per_segment = max(max_rows, sum(r["_n"] for r in hot) // MAX_SEGMENTS)
    types = {f.name: f.dataType for f in df.schema.fields}
    hot_schema = T.StructType(
        [T.StructField(f"_h{i}", types[k]) for i, k in enumerate(keys)]
        + [T.StructField("_parts", T.LongType()), T.StructField("_every", T.LongType())]
    )
    rows = []
    for r in hot:
        parts = -(-r["_n"] // per_segment)
        every = max(1, r["_n"] // (parts * _SAMPLE_PER_SEGMENT))
        rows.append(tuple(r[k] for k in keys) + (parts, every))
    hot_df = spark.createDataFrame(rows, hot_schema)

    sampled = _attach(df.select(*dict.fromkeys(keys + order)), hot_df, keys, "_h", "inner")
    picked = sampled.filter(F.pmod(F.xxhash64(*order), F.col("_every")) == 0)
    sorted_sample = F.array_sort(F.collect_list(_value(order)))
    cuts = (
        picked.groupBy(*keys, "_parts")
        .agg(sorted_sample.alias("_s"))
        .withColumn(
            "_cuts",
            F.expr(
                "array_distinct(transform(filter(sequence(1, _parts), i -> i < _parts and size(_s) > 0),"
                " i -> element_at(_s, cast(greatest(1, (i * size(_s)) div _parts) as int))))"
            ),
        )
        .select(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)], "_cuts")
    )
    found = cuts.collect()
    most = max((len(r["_cuts"]) for r in found), default=0)
    return Split(tuple(keys), tuple(order), spark.createDataFrame(found, cuts.schema), most)


def _attach(df: DataFrame, side: DataFrame, keys: Sequence[str], prefix: str, how: str,
            extra: Column | None = None) -> DataFrame:
    """Join a side of bounded size on (null-safe) keys, or on nothing when there are none."""
    cond = extra
    for i, k in enumerate(keys):
        c = df[k].eqNullSafe(side[f"{prefix}{i}"])
        cond = c if cond is None else cond & c
    if cond is None:
        # one group: a one-row side, read as scalar subqueries
        return df.select("*", *[side.select(c).scalar().alias(c) for c in side.columns])
    joined = df.join(F.broadcast(side), cond, how)
    return joined.drop(*[f"{prefix}{i}" for i in range(len(keys))])


def _value(order: Sequence[str]) -> Column:
    """What rows are compared by: the order column, or all of them together."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(c) for c in order])


def segmented(df: DataFrame, split: Split, how: str = "left") -> DataFrame:
    """``df`` with ``_seg``: the segment of a row of a cut key, null for other keys.

    ``how='inner'`` leaves only the rows of cut keys.
    """
    if split.cuts is None:
        return df.withColumn(SEG, F.lit(None).cast("int"))
    hashed = [f"_h{i}" for i in range(len(split.keys))]
    if split.most <= _BLOCK:
        out = _attach(df, split.cuts, split.keys, "_h", how).withColumn("_v", _value(split.order))
        out, seg = _below(out, "_cuts", split.most)
        seg = F.when(F.col("_cuts").isNotNull(), seg)
        return out.withColumn(SEG, seg).select(*df.columns, SEG)
    # many cuts: find the block by the last cut of each, then the place within the block,
    # so that no row ever carries more than a block of cuts
    ends = split.cuts.select(
        *hashed, F.filter("_cuts", lambda c, i: (i + 1) % _BLOCK == 0).alias("_ends")
    )
    blocks = split.cuts.select(
        *hashed,
        F.posexplode(F.expr(
            f"transform(sequence(0, size(_cuts) div {_BLOCK}), b -> slice(_cuts, b * {_BLOCK} + 1, {_BLOCK}))"
        )).alias("_hb", "_cuts"),
    )
    out = _attach(df, ends, split.keys, "_h", how).withColumn("_v", _value(split.order))
    out, block = _below(out, "_ends", split.most // _BLOCK)
    block = F.when(F.col("_ends").isNotNull(), block)
    out = out.withColumn("_block", block).select(*df.columns, "_v", "_block")
    out = _attach(out, blocks, split.keys, "_h", "left", out["_block"] == blocks["_hb"])
    out, inside = _below(out, "_cuts", _BLOCK)
    return out.withColumn(SEG, F.col("_block") * _BLOCK + inside).select(*df.columns, SEG)


def _below(df: DataFrame, cuts: str, most: int) -> tuple[DataFrame, Column]:
    """How many of the sorted ``cuts`` lie below ``_v``: binary search, one projection per step."""
    at = F.lit(0)
    for i in reversed(range(max(1, most).bit_length())):
        step = F.when(F.get(cuts, at + F.lit((1 << i) - 1)) < F.col("_v"), 1 << i).otherwise(0)
        df = df.withColumn(f"_at_{cuts}{i}", at + step)
        at = F.col(f"_at_{cuts}{i}")
    return df, at


# --------------------------------------------------------------------------- specs


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass(frozen=True)
class Spec:
    """One output of a scan: a window form, and its summary and carry over segments."""

    kind: str
    value: Column | None = None
    default: Column | None = None

    def local(self, w, back, inner: str) -> Column:
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        if self.kind == "peak":
            return F.max(inner).over(upto)
        if self.kind == "row_number":
            return F.row_number().over(w).cast("long")
        if self.kind == "sum":
            return F.sum(F.coalesce(self.value, F.lit(0))).over(upto)
        if self.kind == "max":
            return F.max(self.value).over(upto)
        if self.kind == "min":
            return F.min(self.value).over(upto)
        if self.kind == "last":
            return F.last(self.value, ignorenulls=True).over(upto)
        if self.kind == "next":
            return F.last(self.value, ignorenulls=True).over(
                back.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        if self.kind in ("whole_max", "whole_min"):
            everything = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            return (F.max if self.kind == "whole_max" else F.min)(self.value).over(everything)
        if self.kind == "lag":
            return F.lag(F.struct(self.value.alias("v"))).over(w)
        return F.lead(F.struct(self.value.alias("v"))).over(w)

    def summary(self, position: Column, inner: str) -> Column:
        if self.kind == "peak":
            return F.struct(F.sum(F.coalesce(self.value, F.lit(0))).alias("total"), F.max(inner).alias("top"))
        if self.kind == "row_number":
            return F.count(F.lit(1))
        if self.kind == "sum":
            return F.sum(F.coalesce(self.value, F.lit(0)))
        if self.kind in ("max", "whole_max"):
            return F.max(self.value)
        if self.kind in ("min", "whole_min"):
            return F.min(self.value)
        if self.kind == "last":
            return F.max_by(self.value, F.when(self.value.isNotNull(), position))
        if self.kind == "next":
            return F.min_by(self.value, F.when(self.value.isNotNull(), position))
        if self.kind == "lag":
            return F.max_by(F.struct(self.value.alias("v")), position)
        return F.min_by(F.struct(self.value.alias("v")), position)

    def carry(self, column: str, w, back, inner: str) -> Column:
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        if self.kind == "peak":
            return F.struct(F.col(inner).alias("base"), F.max(F.col(inner) + F.col(column)["top"]).over(before).alias("top"))
        if self.kind == "next":
            return F.last(column, ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1))
        if self.kind in ("row_number", "sum"):
            return F.sum(column).over(before)
        if self.kind == "max":
            return F.max(column).over(before)
        if self.kind == "min":
            return F.min(column).over(before)
        if self.kind == "last":
            return F.last(column, ignorenulls=True).over(before)
        if self.kind in ("whole_max", "whole_min"):
            everything = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            return (F.max if self.kind == "whole_max" else F.min)(column).over(everything)
        return (F.lag if self.kind == "lag" else F.lead)(column).over(w)

    def merge(self, local: Column, carried: Column | None) -> Column:
        if self.kind in ("lag", "lead"):
            found = local if carried is None else F.coalesce(local, carried)
            if self.default is None:
                return found["v"]
            return F.when(found.isNull(), self.default).otherwise(found["v"])
        if carried is None:
            return local
        if self.kind in ("row_number", "sum"):
            return local + F.coalesce(carried, F.lit(0))
        if self.kind == "peak":
            return F.greatest(local + F.coalesce(carried["base"], F.lit(0)), carried["top"])
        if self.kind == "max":
            return F.greatest(local, carried)
        if self.kind == "min":
            return F.least(local, carried)
        if self.kind in ("whole_max", "whole_min"):
            return F.coalesce(carried, local)
        return F.coalesce(local, carried)


def row_number() -> Spec:
    return Spec("row_number")


def running_sum(value) -> Spec:
    return Spec("sum", _col(value))


def running_max(value) -> Spec:
    return Spec("max", _col(value))


def running_min(value) -> Spec:
    return Spec("min", _col(value))


def running_peak(value) -> Spec:
    """The largest running sum of ``value`` so far. What a segment adds is its sum and its own peak."""
    return Spec("peak", _col(value))


def last_value(value) -> Spec:
    """The latest non-null value up to and including the row."""
    return Spec("last", _col(value))


def whole_max(value) -> Spec:
    """The largest value of the whole key."""
    return Spec("whole_max", _col(value))


def whole_min(value) -> Spec:
    return Spec("whole_min", _col(value))


def next_value(value) -> Spec:
    """The nearest non-null value from the row onwards."""
    return Spec("next", _col(value))


def lag(value, default=None) -> Spec:
    return Spec("lag", _col(value), None if default is None else F.lit(default))


def lead(value, default=None) -> Spec:
    return Spec("lead", _col(value), None if default is None else F.lit(default))


def scan(df: DataFrame, keys, order, split: Split | None = None,
         max_rows: int | None = None, **specs: Spec) -> DataFrame:
    """``df`` with one column per spec, computed along ``order`` within ``keys``."""
    if split is None:
        split = measure(df, keys, order, max_rows)
    keys, order = list(split.keys), list(split.order)
    by = [F.col(c) for c in order]
    peaks = {n: s.value for n, s in specs.items() if s.kind == "peak"}

    def summed(rows: DataFrame, w) -> DataFrame:
        """With the running sums that peaks are taken of; the window above them needs no sort of its own."""
        return rows.withColumns({f"_p_{n}": running_sum(v).local(w, w, "") for n, v in peaks.items()}) if peaks else rows

    if split.cuts is None:
        w = Window.partitionBy(*keys).orderBy(*by)
        back = Window.partitionBy(*keys).orderBy(*[c.desc() for c in by])
        return summed(df, w).select(
            *df.columns, *[s.merge(s.local(w, back, f"_p_{n}"), None).alias(n) for n, s in specs.items()])

    w = Window.partitionBy(*keys, SEG).orderBy(*by)
    back = Window.partitionBy(*keys, SEG).orderBy(*[c.desc() for c in by])
    local = summed(segmented(df, split), w).select(
        *df.columns, SEG, *[s.local(w, back, f"_p_{n}").alias(f"_l_{n}") for n, s in specs.items()])

    position = F.struct(*by)
    parts = (
        summed(segmented(df, split, "inner"), w)
        .groupBy(*keys, SEG)
        .agg(*[s.summary(position, f"_p_{n}").alias(f"_s_{n}") for n, s in specs.items()])
    )
    # one row per segment: at most MAX_SEGMENTS + MAX_HOT_KEYS rows in all
    along = Window.partitionBy(*keys).orderBy(SEG)
    against = Window.partitionBy(*keys).orderBy(F.col(SEG).desc())
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    for n in peaks:
        parts = parts.withColumn(f"_b_{n}", F.coalesce(F.sum(F.col(f"_s_{n}")["total"]).over(before), F.lit(0)))
    carried = parts.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(SEG).alias("_kseg"),
        *[s.carry(f"_s_{n}", along, against, f"_b_{n}").alias(f"_c_{n}") for n, s in specs.items()],
    )
    joined = _attach(local, carried, keys, "_k", "left", local[SEG] == carried["_kseg"])
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[s.merge(F.col(f"_l_{n}"), F.col(f"_c_{n}")).alias(n) for n, s in specs.items()],
    )
