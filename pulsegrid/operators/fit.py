"""Least-squares fits, fit quality and the calibration sweep."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from math import comb
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixedpoint import qn_decode, qn_encode
from ..functions.scalars import CALIBRATION_SETS, correction, poly_eval
from ..plans.ordered import names


def linear_fit(df: DataFrame, x: str, y: str, keys=None) -> DataFrame:
    """``y = a·x + b`` per group in one aggregation; null where all x are equal."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    # the slope has its own running moments; for the mean, through which the line goes, plain sums will do
    fitted = df.groupBy(*names(keys)).agg(
        F.regr_slope(y, x).alias("a"),
        F.sum(F.when(both, F.col(x).cast("double"))).alias("_x"),
        F.sum(F.when(both, F.col(y).cast("double"))).alias("_y"),
        F.count(F.when(both, 1)).alias("n"),
    )
    return fitted.select(*names(keys), "a", ((F.col("_y") - F.col("a") * F.col("_x")) / F.nullif("n", F.lit(0))).alias("b"), "n")


def poly_fit(df: DataFrame, x: str, y: str, order: int, keys=None,
             center: float | None = None, scale: float | None = None) -> DataFrame:
    """Polynomial of ``order`` by normal equations: (keys, coefs lowest power first, n).

    Executors sum powers of x and y·powers in one aggregation; only one row of sums
    per group goes on to the small solve. Powers are taken of (x - center) / scale,
    the mean and deviation of each group's own x unless given. ``coefs`` is null only
    for a group with too few different x.
    """
    keys = names(keys)
    pairs = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    if center is None or scale is None:
        measured = pairs.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
            F.avg(x).alias("_c"), F.stddev_pop(x).alias("_s"))
        if keys:
            same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
            pairs = pairs.join(measured, same).drop(*[f"_k{i}" for i in range(len(keys))])
        else:
            m = measured.first()
            pairs = pairs.withColumns({"_c": F.lit(m["_c"]).cast("double"), "_s": F.lit(m["_s"]).cast("double")})
    mid = F.coalesce("_c", F.lit(0.0)) if center is None else F.lit(float(center))
    spread = F.coalesce(F.nullif("_s", F.lit(0.0)), F.lit(1.0)) if scale is None else F.lit(float(scale))
    t = (F.col(x) - mid) / spread
    v = F.col(y).cast("double")
    powers = [F.lit(1.0)]
    for _ in range(2 * order):
        powers.append(powers[-1] * t)
    sums = pairs.groupBy(*keys).agg(
        F.array(*[F.sum(p) for p in powers]).alias("_sx"),
        F.array(*[F.sum(v * p) for p in powers[: order + 1]]).alias("_sxy"),
        F.count(F.lit(1)).alias("n"), F.min(mid).alias("_mid"), F.min(spread).alias("_spread"),
    )
    schema = T.StructType(
        [sums.schema[k] for k in keys]
        + [T.StructField("coefs", T.ArrayType(T.DoubleType())), T.StructField("n", T.LongType())]
    )
    size = order + 1

    def back(center: float, scale: float) -> np.ndarray:
        """From powers of (x - center) / scale to powers of x."""
        out = np.zeros((size, size))
        for p in range(size):
            for q in range(p + 1):
                out[q, p] = comb(p, q) * (-center) ** (p - q) / scale**p
        return out

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for sx, sxy, center, scale in zip(*(batch.column(c).to_pylist() for c in ("_sx", "_sxy", "_mid", "_spread"))):
                gram = np.array([[sx[i + j] for j in range(size)] for i in range(size)]) if sx[0] else None
                if gram is None or np.linalg.matrix_rank(gram) < size:
                    out.append(None)
                else:
                    out.append(list(back(center, scale) @ np.linalg.solve(gram, np.array(sxy))))
            arrays = [batch.column(k) for k in keys]
            arrays += [pa.array(out, pa.list_(pa.float64())), batch.column("n")]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema.fields])

    return sums.mapInArrow(solve, schema)


def fit_quality(df: DataFrame, ideal: str, real: str, keys=None) -> DataFrame:
    """How far ``real`` is from ``ideal``: per-cent error, error, residual norm, R², correlation."""
    e = F.col(real) - F.col(ideal)
    pe = F.try_divide(e * 100.0, F.col(ideal))
    return (
        df.groupBy(*names(keys))
        .agg(
            F.max(F.abs(pe)).alias("max_pct"),
            F.min(F.abs(pe)).alias("min_pct"),
            F.avg(pe).alias("mean_pct"),
            F.max(F.abs(e)).alias("max_err"),
            F.min(F.abs(e)).alias("min_err"),
            F.avg(e).alias("mean_err"),
            F.sum(e * e).alias("_sse"),
            F.regr_syy(F.col(ideal), F.col(real)).alias("_sst"),
            F.corr(ideal, real).alias("pearson"),
            F.count(F.lit(1)).alias("n"),
        )
        .withColumn("residual_norm", F.sqrt("_sse"))
        .withColumn("r2", 1 - F.try_divide(F.col("_sse"), F.col("_sst")))
        .drop("_sse", "_sst")
    )


def param_sweep(df: DataFrame, params: Sequence[Sequence], columns: Sequence[str]) -> DataFrame:
    """Every row with every parameter set. The sets ride along as one constant array."""
    sets = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, p, strict=True)]) for p in params])
    return df.withColumn("_p", F.explode(sets)).select(*df.columns, "_p.*")


def calibration_sweep(df: DataFrame, ideal: str, real: str, sets=CALIBRATION_SETS) -> DataFrame:
    """Correct every reading with every coefficient set and rate each set."""
    swept = param_sweep(df.select(ideal, real), sets, ["variant", "a2", "a1", "a0"])
    fixed = swept.withColumn("corrected", correction(real, F.col("a2"), F.col("a1"), F.col("a0")))
    return fit_quality(fixed, ideal, "corrected", "variant")


def calibrate(df: DataFrame, ideal: str, real: str, order: int = 2, name: str = "corrected") -> DataFrame:
    """Fit the error ``real - ideal`` as a polynomial of ``real`` and take it off each reading.

    The fit is one row, read by the correction as a scalar.
    """
    errors = df.select(F.col(real).cast("double").alias("_r"), (F.col(real) - F.col(ideal)).alias("_e"))
    high_first = F.reverse("coefs")
    fitted = poly_fit(errors, "_r", "_e", order).select(high_first.alias("c")).scalar()
    error = F.col("_err")
    whole = F.when(error >= 0, (error + 0.5).cast("int")).otherwise((error - 0.5).cast("int"))
    return (
        df.withColumn("_c", fitted)
        .withColumn("_err", poly_eval("_c", real))
        .withColumn(name, F.col(real) - whole)
        .drop("_c", "_err")
    )


def qn_error(df: DataFrame, x: str, ns: Sequence[int]) -> DataFrame:
    """Per-cent error of a value quantised to n fractional bits, for each n."""
    swept = param_sweep(df.select(x), [(n,) for n in ns], ["qn"])
    q = swept.withColumn("_q", qn_encode(x, "qn")).withColumn("_d", qn_decode("_q", "qn"))
    pct = F.try_divide((F.col("_d") - F.col(x)) * 100.0, F.col(x))
    return q.groupBy("qn").agg(F.max(F.abs(pct)).alias("max_pct"), F.avg(pct).alias("mean_pct"))
