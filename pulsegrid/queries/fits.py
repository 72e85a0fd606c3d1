"""Fits, fit quality, sweeps and fixed-point error."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as sc
from ..operators import fit
from ..sources import text as tx
from .registry import query


@query("a2_linear_fit", """
SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS a,
  round(regr_intercept(l_extendedprice, l_quantity), 3) AS b, regr_count(l_extendedprice, l_quantity)::BIGINT AS n
FROM lineitem GROUP BY l_returnflag
""")
def linear_fit(t):
    out = fit.linear_fit(t.lineitem, "l_quantity", "l_extendedprice", "l_returnflag")
    return out.select("l_returnflag", F.round("a", 4).alias("a"), F.round("b", 3).alias("b"), "n")


@query("a2_linear_fit_points", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS a,
  round(regr_intercept(l_extendedprice, l_quantity), 3) AS b, regr_count(l_extendedprice, l_quantity)::BIGINT AS n
FROM lineitem
""")
def linear_fit_points(t):
    """Text points read and fitted in one go."""
    lines = t.lineitem.select(F.concat_ws(" ", "l_quantity", "l_extendedprice").alias("line"))
    # rejected lines have no x and y, and a fit leaves them out
    out = fit.linear_fit(tx.parse_points(lines), "x", "y")
    return out.select(F.round("a", 4).alias("a"), F.round("b", 3).alias("b"), "n")


# Quadratic by Cramer's rule on powers of (x - 25), then moved back to powers of x.
QUADRATIC = """
WITH s AS (
  SELECT l_returnflag, count(*)::DOUBLE AS s0, sum(t) AS s1, sum(t*t) AS s2, sum(t*t*t) AS s3, sum(t*t*t*t) AS s4,
         sum(y) AS v0, sum(t*y) AS v1, sum(t*t*y) AS v2, count(*) AS n
  FROM (SELECT l_returnflag, l_quantity - 25 AS t, l_extendedprice AS y FROM lineitem) GROUP BY l_returnflag),
d AS (SELECT *, s0*(s2*s4-s3*s3) - s1*(s1*s4-s2*s3) + s2*(s1*s3-s2*s2) AS det FROM s),
z AS (SELECT l_returnflag, n,
  (v0*(s2*s4-s3*s3) - s1*(v1*s4-v2*s3) + s2*(v1*s3-v2*s2)) / det AS z0,
  (s0*(v1*s4-v2*s3) - v0*(s1*s4-s2*s3) + s2*(s1*v2-s2*v1)) / det AS z1,
  (s0*(s2*v2-s3*v1) - s1*(s1*v2-s2*v1) + v0*(s1*s3-s2*s2)) / det AS z2 FROM d)
SELECT l_returnflag, n, round(z0 - 25*z1 + 625*z2, 3) AS c0, round(z1 - 50*z2, 4) AS c1, round(z2, 5) AS c2 FROM z
"""


@query("a3_poly_fit", QUADRATIC)
def poly_fit(t):
    out = fit.poly_fit(t.lineitem, "l_quantity", "l_extendedprice", 2, "l_returnflag")
    c = F.col("coefs")
    return out.select("l_returnflag", "n", F.round(c[0], 3).alias("c0"), F.round(c[1], 4).alias("c1"),
                      F.round(c[2], 5).alias("c2"))


@query("a3_poly_fit_far", """
SELECT l_linenumber, count(*) AS n, round(2 * 25 * 25 + 3e0, 2) AS at_25 FROM lineitem GROUP BY l_linenumber
""")
def poly_fit_far(t):
    """Groups ten thousand apart: y = 2u² + 3 over u = quantity, with x = u + 10000 · line number."""
    u, far = F.col("l_quantity"), F.col("l_linenumber") * 10000
    df = t.lineitem.select("l_linenumber", (u + far).alias("x"), (2 * u * u + 3).alias("y"))
    out = fit.poly_fit(df, "x", "y", 2, "l_linenumber")
    x, c = F.col("l_linenumber") * 10000 + 25.0, F.col("coefs")
    return out.select("l_linenumber", "n", F.round(c[0] + c[1] * x + c[2] * x * x, 2).alias("at_25"))


@query("a3_poly_fit_line", """
SELECT l_shipdate < TIMESTAMP '1998-01-01' AS early, count(*) AS n,
  round(regr_intercept(l_extendedprice, l_quantity), 3) AS c0, round(regr_slope(l_extendedprice, l_quantity), 4) AS c1
FROM lineitem GROUP BY 1
""")
def poly_fit_line(t):
    """Order one is the straight line."""
    df = t.lineitem.withColumn("early", F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    out = fit.poly_fit(df, "l_quantity", "l_extendedprice", 1, "early")
    c = F.col("coefs")
    return out.select("early", "n", F.round(c[0], 3).alias("c0"), F.round(c[1], 4).alias("c1"))


QUALITY = """
  round(max(abs(e * 100.0e0 / ideal)), 6) AS max_pct, round(min(abs(e * 100.0e0 / ideal)), 6) AS min_pct,
  round(avg(e * 100.0e0 / ideal), 6) AS mean_pct, round(max(abs(e)), 4) AS max_err, round(min(abs(e)), 4) AS min_err,
  round(avg(e), 5) AS mean_err, round(sqrt(sum(e * e)), 2) AS residual_norm,
  round(1 - sum(e * e) / regr_syy(ideal, fixed), 8) AS r2, round(corr(ideal, fixed), 8) AS pearson, count(*) AS n
"""


def rounded(df, *keep):
    digits = {"max_pct": 6, "min_pct": 6, "mean_pct": 6, "max_err": 4, "min_err": 4, "mean_err": 5,
              "residual_norm": 2, "r2": 8, "pearson": 8}
    return df.select(*keep, *[F.round(c, d).alias(c) for c, d in digits.items()], "n")


@query("a4_fit_quality", f"""
WITH f AS (SELECT l_returnflag, l_extendedprice AS ideal, l_extendedprice * (1 - l_discount) AS fixed,
  l_extendedprice * (1 - l_discount) - l_extendedprice AS e FROM lineitem)
SELECT l_returnflag, {QUALITY} FROM f GROUP BY l_returnflag
""")
def fit_quality(t):
    df = t.lineitem.withColumn("fixed", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return rounded(fit.fit_quality(df, "l_extendedprice", "fixed", "l_returnflag"), "l_returnflag")


SETS = """
sets(variant, a2, a1, a0) AS (VALUES (1, -0.000358309e0, 1.24539e0, -395.213e0), (2, -0.0003e0, 1.2e0, -390e0),
  (3, -0.00036e0, 1.25e0, -396e0), (4, -0.00037e0, 1.26e0, -397e0), (5, -0.00038e0, 1.27e0, -398e0),
  (6, -0.00039e0, 1.28e0, -399e0), (7, -0.0004e0, 1.29e0, -400e0), (8, -0.00041e0, 1.3e0, -401e0)),
r AS (SELECT variant, a2, a1, a0, p_partkey, CAST(trunc(p_retailprice) AS INTEGER) AS real,
  CAST(trunc(p_retailprice) AS INTEGER) - p_size - 100 AS ideal FROM part, sets),
s1 AS (SELECT *, CAST(CAST(a2 AS FLOAT) * CAST(real AS FLOAT) AS DOUBLE) + a1 AS d FROM r),
s2 AS (SELECT *, CAST(CAST(CAST(d AS FLOAT) * CAST(real AS FLOAT) AS DOUBLE) + a0 AS FLOAT) AS res FROM s1),
swept AS (SELECT variant, p_partkey, ideal,
  real - CAST(trunc(CAST(res AS DOUBLE) + CASE WHEN res >= 0 THEN 0.5e0 ELSE -0.5e0 END) AS INTEGER) AS fixed FROM s2)
"""


def readings(t):
    real = F.col("p_retailprice").cast("int")
    return t.part.select("p_partkey", real.alias("real"), (real - F.col("p_size") - 100).alias("ideal"))


@query("j2_param_sweep", f"WITH {SETS} SELECT p_partkey, variant, fixed AS corrected FROM swept")
def param_sweep(t):
    swept = fit.param_sweep(readings(t), sc.CALIBRATION_SETS, ["variant", "a2", "a1", "a0"])
    fixed = sc.correction("real", F.col("a2"), F.col("a1"), F.col("a0"))
    return swept.select("p_partkey", "variant", fixed.alias("corrected"))


@query("calibration_sweep", f"""
WITH {SETS}, f AS (SELECT *, fixed - ideal AS e FROM swept) SELECT variant, {QUALITY} FROM f GROUP BY variant
""")
def calibration_sweep(t):
    """Readings, all coefficient sets, correction and quality as one plan."""
    return rounded(fit.calibration_sweep(readings(t), "ideal", "real"), "variant")


@query("calibration_fit", """
WITH r AS (SELECT p_partkey, CAST(trunc(p_retailprice) AS INTEGER) AS real,
    CAST(trunc(p_retailprice * 0.9e0) AS INTEGER) - 50 + p_size % 5 AS ideal FROM part),
s AS (SELECT count(*)::DOUBLE AS s0, sum(t) AS s1, sum(t*t) AS s2, sum(t*t*t) AS s3, sum(t*t*t*t) AS s4,
         sum(y) AS v0, sum(t*y) AS v1, sum(t*t*y) AS v2
  FROM (SELECT (real - 1000) / 50.0e0 AS t, (real - ideal)::DOUBLE AS y FROM r)),
d AS (SELECT *, s0*(s2*s4-s3*s3) - s1*(s1*s4-s2*s3) + s2*(s1*s3-s2*s2) AS det FROM s),
z AS (SELECT (v0*(s2*s4-s3*s3) - s1*(v1*s4-v2*s3) + s2*(v1*s3-v2*s2)) / det AS z0,
  (s0*(v1*s4-v2*s3) - v0*(s1*s4-s2*s3) + s2*(s1*v2-s2*v1)) / det AS z1,
  (s0*(s2*v2-s3*v1) - s1*(s1*v2-s2*v1) + v0*(s1*s3-s2*s2)) / det AS z2 FROM d),
e AS (SELECT p_partkey, real, ideal, z0 + z1 * ((real - 1000) / 50.0e0) + z2 * ((real - 1000) / 50.0e0) ** 2 AS err FROM r, z)
SELECT p_partkey, real, ideal, real - CAST(trunc(err + CASE WHEN err >= 0 THEN 0.5e0 ELSE -0.5e0 END) AS INTEGER) AS corrected FROM e
""")
def calibration_fit(t):
    """Coefficients from a fit instead of a table."""
    df = t.part.select("p_partkey", F.col("p_retailprice").cast("int").alias("real"),
                       ((F.col("p_retailprice") * 0.9).cast("int") - 50 + F.col("p_size") % 5).alias("ideal"))
    return fit.calibrate(df, "ideal", "real")


@query("a9_qn_error", """
WITH s AS (SELECT qn, x, CAST(trunc(x * (1::BIGINT << qn)) AS BIGINT) / CAST(1::BIGINT << qn AS DOUBLE) AS d
  FROM (SELECT l_quantity / 7 AS x FROM lineitem), (SELECT unnest([20, 21, 22, 23, 24]) AS qn))
SELECT qn, round(max(abs((d - x) * 100.0e0 / x)) * 1e6, 4) AS max_ppm, round(avg((d - x) * 100.0e0 / x) * 1e6, 4) AS mean_ppm
FROM s GROUP BY qn
""")
def qn_error(t):
    out = fit.qn_error(t.lineitem.select((F.col("l_quantity") / 7).alias("x")), "x", [20, 21, 22, 23, 24])
    return out.select("qn", F.round(F.col("max_pct") * 1e6, 4).alias("max_ppm"),
                      F.round(F.col("mean_pct") * 1e6, 4).alias("mean_ppm"))
