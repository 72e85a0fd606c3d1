"""Scalar functions, filters, sorts and stacking."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixedpoint as qn
from ..functions import scalars as sc
from ..operators import joins, sorting
from ..operators import queueing as qu
from .registry import EV, query

# The polynomial whose value at 7.7 is 14088.74714.
QUARTIC = [4.4, -3.3, 2.2, -1.1, 6.0]


@query("p1_poly_eval", """
SELECT p_partkey,
  round((((4.4e0 * p_size + -3.3e0) * p_size + 2.2e0) * p_size + -1.1e0) * p_size + 6.0e0, 4) AS y,
  round(((0.0e0 * 1.5e0 + p_size) * 1.5e0 + 3.0e0) * 1.5e0 + p_retailprice, 4) AS z
FROM part
""")
def poly_eval(t):
    """Constant coefficients at a column, and a column of coefficients at a constant."""
    coefs = F.array(F.col("p_size").cast("double"), F.lit(3.0), F.col("p_retailprice"))
    return t.part.select(
        "p_partkey",
        F.round(sc.poly_eval(QUARTIC, "p_size"), 4).alias("y"),
        F.round(sc.poly_eval(coefs, F.lit(1.5)), 4).alias("z"),
    )


@query("p1_poly_eval_complex", """
WITH h AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS a, p_retailprice AS c FROM part),
s AS (SELECT *, a * 1.5e0 + -2.0e0 AS r1, a * 0.5e0 AS i1 FROM h)
SELECT p_partkey, r1 * 1.5e0 - i1 * 0.5e0 + c AS re, r1 * 0.5e0 + i1 * 1.5e0 AS im FROM s
""")
def poly_eval_complex(t):
    """size·z² - 2z + price at 1.5 + 0.5i."""
    coefs = F.array(F.col("p_size").cast("double"), F.lit(-2.0), F.col("p_retailprice"))
    value = sc.poly_eval_complex(coefs, F.lit(1.5), F.lit(0.5))
    return t.part.select("p_partkey", value.alias("v")).select("p_partkey", "v.re", "v.im")


@query("p2_correct", """
WITH r AS (SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice / 25) AS INTEGER) AS real FROM lineitem),
s1 AS (SELECT *, CAST(CAST(-0.000358309e0 AS FLOAT) * CAST(real AS FLOAT) AS DOUBLE) + 1.24539e0 AS d FROM r),
s2 AS (SELECT *, CAST(CAST(CAST(d AS FLOAT) * CAST(real AS FLOAT) AS DOUBLE) + -395.213e0 AS FLOAT) AS res FROM s1)
SELECT l_orderkey, l_linenumber, real,
  real - CAST(trunc(CAST(res AS DOUBLE) + CASE WHEN res >= 0 THEN 0.5e0 ELSE -0.5e0 END) AS INTEGER) AS corrected
FROM s2
""")
def correct(t):
    """Single-precision steps, as the original readings were corrected."""
    real = (F.col("l_extendedprice") / 25).cast("int")
    df = t.lineitem.select("l_orderkey", "l_linenumber", real.alias("real"))
    return sc.correct(df, "real", *sc.CALIBRATION_SETS[0][1:])


@query("p3_poly_deriv", """
SELECT p_partkey, 3.0e0 * p_size AS d1_2, -4.0e0 AS d1_1, p_retailprice AS d1_0,
       6.0e0 * p_size AS d2_1, -4.0e0 AS d2_0 FROM part
""")
def poly_deriv(t):
    """Of size·x³ - 2x² + price·x + 7."""
    coefs = F.array(F.col("p_size").cast("double"), F.lit(-2.0), F.col("p_retailprice"), F.lit(7.0))
    d1, d2 = sc.poly_deriv(coefs), sc.poly_deriv(coefs, 2)
    return t.part.select(
        "p_partkey", d1[0].alias("d1_2"), d1[1].alias("d1_1"), d1[2].alias("d1_0"),
        d2[0].alias("d2_1"), d2[1].alias("d2_0"),
    )


@query("p4_quadratic_roots", """
WITH p AS (SELECT p_partkey, CAST(p_size - 25 AS DOUBLE) AS a, CAST(p_partkey % 17 - 8 AS DOUBLE) AS b,
                  CAST(p_size % 7 - 3 AS DOUBLE) AS c FROM part),
d AS (SELECT *, b * b - 4 * a * c AS disc, sqrt(abs(b * b - 4 * a * c)) AS s FROM p)
SELECT p_partkey,
  CASE WHEN a <> 0 THEN round(CASE WHEN disc >= 0 THEN -b + s ELSE -b END / (2 * a), 9) + 0.0e0 END AS re0,
  CASE WHEN a <> 0 THEN round(CASE WHEN disc >= 0 THEN 0.0e0 ELSE s END / (2 * a), 9) + 0.0e0 END AS im0,
  CASE WHEN a <> 0 THEN round(CASE WHEN disc >= 0 THEN -b - s ELSE -b END / (2 * a), 9) + 0.0e0 END AS re1,
  CASE WHEN a <> 0 THEN round(CASE WHEN disc >= 0 THEN 0.0e0 ELSE -s END / (2 * a), 9) + 0.0e0 END AS im1
FROM d
""")
def quadratic_roots(t):
    roots = sc.quadratic_roots(F.col("p_size") - 25, F.col("p_partkey") % 17 - 8, F.col("p_size") % 7 - 3)
    df = t.part.select("p_partkey", roots.alias("r"))
    return df.select("p_partkey", *[
        (F.round(F.col(f"r.r{i}.{part}"), 9) + F.lit(0.0)).alias(f"{part}{i}")
        for i in (0, 1) for part in ("re", "im")
    ])


@query("p5_poly_text", """
WITH p AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS a, CAST(p_size % 5 - 2 AS DOUBLE) AS b,
                  p_retailprice AS c, (p_partkey % 9 - 4) * 12345.678e0 AS d FROM part)
SELECT p_partkey,
  printf('%gx^3', a)
    || CASE WHEN b = 0 THEN '' WHEN b < 0 THEN printf(' - %gx^2', -b) ELSE printf(' + %gx^2', b) END
    || CASE WHEN c = 0 THEN '' ELSE printf(' + %gx^1', c) END
    || CASE WHEN d = 0 THEN '' WHEN d < 0 THEN printf(' - %gx^0', -d) ELSE printf(' + %gx^0', d) END AS poly,
  printf('%g', a)
    || CASE WHEN b = 0 THEN '' WHEN b < 0 THEN printf(' - %gx', -b) ELSE printf(' + %gx', b) END
    || printf(' + %gx^2', c)
    || CASE WHEN d = 0 THEN '' WHEN d < 0 THEN printf(' - %gx^3', -d) ELSE printf(' + %gx^3', d) END AS fit
FROM p
""")
def poly_text(t):
    coefs = F.array(F.col("p_size").cast("double"), (F.col("p_size") % 5 - 2).cast("double"),
                    F.col("p_retailprice"), (F.col("p_partkey") % 9 - 4) * F.lit(12345.678))
    return t.part.select("p_partkey", sc.poly_text(coefs).alias("poly"), sc.fit_text(coefs).alias("fit"))


@query("p6_adc_to_temp", """
WITH a AS (SELECT o_orderkey, o_custkey * 11 % 16384 AS adc FROM orders)
SELECT o_orderkey, adc, adc * 2.5e0 / 16384.0e0 AS volts, (adc * 2.5e0 / 16384.0e0 - 0.5e0) * 100.0e0 AS celsius,
  (adc * 2.5e0 / 16384.0e0 - 0.5e0) * 100.0e0 * 9.0e0 / 5.0e0 + 32.0e0 AS fahrenheit, adc * 1.609e0 AS km FROM a
""")
def adc_to_temp(t):
    adc = t.orders.select("o_orderkey", (F.col("o_custkey") * 11 % 16384).alias("adc"))
    return sc.adc_to_temp(adc, "adc").withColumn("km", sc.miles_to_km("adc"))


@query("p7_tick_to_clock", f"""
WITH {EV} SELECT event_id, printf('%02d:%02d', 9 + (tick % 200000) // 6000, ((tick % 200000) // 100) % 60) AS clock FROM ev
""")
def tick_to_clock(t):
    return t.ev.select("event_id", sc.tick_to_clock(F.col("tick") % 200000).alias("clock"))


@query("p8_fixed_point", """
WITH p AS (SELECT p_partkey, (p_retailprice - 1000) / 7 AS x, (p_size + 1) / 3.0e0 AS y FROM part),
q AS (SELECT *, CAST(trunc(x * 65536) AS BIGINT) AS a, CAST(trunc(y * 65536) AS BIGINT) AS b FROM p)
SELECT p_partkey, a, b, (a * b) >> 16 AS product, CAST(trunc(CAST(a AS HUGEINT) * 65536 / b) AS BIGINT) AS quotient,
  a / 65536.0e0 AS back FROM q
""")
def fixed_point(t):
    x = t.part.select("p_partkey", ((F.col("p_retailprice") - 1000) / 7).alias("x"),
                      ((F.col("p_size") + 1) / 3).alias("y"))
    q = x.select("p_partkey", qn.qn_encode("x", 16).alias("a"), qn.qn_encode("y", 16).alias("b"))
    return q.withColumns({
        "product": qn.qn_mul("a", "b", 16),
        "quotient": qn.qn_div("a", "b", 16),
        "back": qn.qn_decode("a", 16),
    })


DECODED = """
d AS (SELECT o_orderkey, CAST(o_orderkey * 37 % 256 AS INTEGER) AS byte FROM orders),
e AS (SELECT o_orderkey, byte, CASE byte & 224 WHEN 0 THEN 'RECIPE_END' WHEN 32 THEN 'MOV' WHEN 64 THEN 'WAIT'
  WHEN 96 THEN 'REVERSE' WHEN 128 THEN 'LOOP' WHEN 160 THEN 'END_LOOP' ELSE 'error' END AS op,
  byte & 31 AS operand FROM d)
"""


def command_bytes(t):
    return t.orders.select("o_orderkey", (F.col("o_orderkey") * 37 % 256).cast("int").alias("byte"))


@query("p9_decode_packed", f"WITH {DECODED} SELECT o_orderkey, byte, op, operand FROM e")
def decode_packed(t):
    return sc.decode_packed(command_bytes(t), "byte")


@query("a12_opcode_counts", f"WITH {DECODED} SELECT op, count(*) AS n FROM e GROUP BY op")
def opcode_counts(t):
    return qu.opcode_counts(sc.decode_packed(command_bytes(t), "byte"))


@query("p10_code_label", """
SELECT o_orderkey,
  CASE o_orderkey % 6 WHEN 0 THEN 'OFF' WHEN 1 THEN 'Red' WHEN 2 THEN 'Blue' WHEN 3 THEN 'Green'
    ELSE 'Invalid Input' END AS label,
  CASE WHEN o_orderstatus = 'F' THEN 'Busy' WHEN o_custkey % 2 = 0 THEN 'On Break' ELSE 'Idle' END AS status
FROM orders
""")
def code_label(t):
    code = (F.col("o_orderkey") % 6).cast("string")
    return t.orders.select(
        "o_orderkey", sc.code_label(code).alias("label"),
        sc.busy_label(F.col("o_orderstatus") == "F", F.col("o_custkey") % 2 == 0).alias("status"),
    )


@query("p11_clamp", """
SELECT p_partkey, greatest(least(p_size - 10, 5), 0) AS position, least(p_size * 3, 99) AS shown FROM part
""")
def clamp(t):
    return t.part.select("p_partkey", sc.clamp(F.col("p_size") - 10, 0, 5).alias("position"),
                         sc.clamp(F.col("p_size") * 3, 0, 99).alias("shown"))


CYCLE = f"""
WITH {EV} SELECT event_id, ['Red', 'Green', 'Blue', 'Cyan', 'Magenta', 'Yellow', 'White'][
  CAST((row_number() OVER (ORDER BY us, event_id) - 1) % 7 + 1 AS INTEGER)] AS label FROM ev
"""


@query("p12_cycle_label", CYCLE)
def cycle_label(t):
    return sc.cycle_label(t.ev.select("event_id", "us"), ["us", "event_id"]).select("event_id", "label")


@query("p12_cycle_label_cut", CYCLE)
def cycle_label_cut(t):
    """One global order, cut into segments."""
    out = sc.cycle_label(t.ev.select("event_id", "us"), ["us", "event_id"], max_rows=700)
    return out.select("event_id", "label")


@query("p13_char_count", "SELECT doc_id, CAST(length(text) AS INTEGER) AS n FROM documents")
def char_count(t):
    return t.documents.select("doc_id", sc.char_count("text").alias("n"))


# ----------------------------------------------------------------------------- filters


@query("f1_band_filter", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey BETWEEN 50 AND 150")
def band_filter(t):
    return sc.band_filter(t.orders, "o_custkey", 50).select("o_orderkey", "o_custkey")


@query("f2_open_hours", f"""
WITH {EV} SELECT event_id, tick % 86400000 AS t FROM ev
WHERE tick % 86400000 >= 32400000 AND tick % 86400000 < 57600000
""")
def open_hours(t):
    day = t.ev.select("event_id", (F.col("tick") % 86400000).alias("t"))
    return sc.open_hours(day, "t", 32400000, 57600000)


@query("f5_near_zero", """
SELECT l_returnflag, count(*) FILTER (abs(l_discount - 0.05) < 1e-8) AS zero, count(*) AS n
FROM lineitem GROUP BY l_returnflag
""")
def near_zero(t):
    hit = sc.near_zero(F.col("l_discount") - 0.05)
    return t.lineitem.groupBy("l_returnflag").agg(F.count(F.when(hit, 1)).alias("zero"),
                                                  F.count(F.lit(1)).alias("n"))


@query("x1_scalar_function", "SELECT p_partkey, p_size * 2.0e0 - 7 AS y FROM part")
def scalar_function(t):
    """A caller's function of one variable, given as an expression."""
    df = t.part.select("p_partkey", "p_size")
    return sc.apply_scalar(df, lambda x: x * 2.0 - 7, "p_size").select("p_partkey", "y")


# ----------------------------------------------------------------------------- sorts


@query("o1_sort_two_keys", "SELECT p_size, p_retailprice, p_partkey FROM part ORDER BY p_size, p_retailprice")
def sort_two_keys(t):
    return sorting.sort_by(t.part.select("p_size", "p_retailprice", "p_partkey"), ["p_size", "p_retailprice"])


@query("o2_sort_numeric", "SELECT o_totalprice, o_orderkey FROM orders ORDER BY o_totalprice")
def sort_numeric(t):
    return sorting.sort_by(t.orders.select("o_totalprice", "o_orderkey"), "o_totalprice")


@query("o3_sort_by_size", """
SELECT p_partkey, p_size - 25 AS v FROM part ORDER BY abs(p_size - 25) DESC
""")
def sort_by_size(t):
    df = t.part.select("p_partkey", (F.col("p_size") - 25).alias("v"))
    return sorting.sort_by(df, "v", absolute=["v"])


@query("o4_traverse", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey DESC")
def traverse(t):
    return sorting.sort_by(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", descending=["o_orderkey"])


@query("x2_comparator", """
SELECT p_partkey, list_aggregate(list_sort([[-abs(p_size - 25), p_size - 25], [-abs(p_size % 7 - 3), p_size % 7 - 3],
  [-abs(p_partkey % 11 - 5), p_partkey % 11 - 5]]).list_transform(lambda p: p[2]), 'string_agg', ' ') AS sorted FROM part
""")
def comparator(t):
    """A comparator over an array: by size, largest first."""
    values = F.array((F.col("p_size") - 25).cast("long"), (F.col("p_size") % 7 - 3).cast("long"),
                     F.col("p_partkey") % 11 - 5)
    text = F.concat_ws(" ", F.transform(sorting.sort_array_by_size(values), lambda v: v.cast("string")))
    return t.part.select("p_partkey", text.alias("sorted"))


@query("w9_head_tail", """
(SELECT o_orderkey, o_custkey, 'first' AS side FROM orders ORDER BY o_orderkey LIMIT 6)
UNION ALL (SELECT o_orderkey, o_custkey, 'last' AS side FROM orders ORDER BY o_orderkey DESC LIMIT 6)
""")
def head_tail(t):
    return sorting.head_tail(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey")


@query("o5_cap_first", f"""
WITH {EV} SELECT user_id, event_id FROM ev
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) <= 10
""")
def cap_first(t):
    return sorting.cap_first(t.ev.select("user_id", "event_id", "us"), "user_id", ["us", "event_id"], 10).select(
        "user_id", "event_id"
    )


@query("u1_concat_runs", """
SELECT o_orderkey AS key, o_totalprice AS amount, 'orders' AS source FROM orders
UNION ALL SELECT l_orderkey, l_extendedprice, 'lineitem' FROM lineitem
""")
def concat_runs(t):
    runs = [t.orders.select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("amount")),
            t.lineitem.select(F.col("l_extendedprice").alias("amount"), F.col("l_orderkey").alias("key"))]
    return sorting.concat_runs(runs, ["orders", "lineitem"])


@query("j6_label_join", """
SELECT c_custkey, CASE WHEN n_regionkey <> 0 THEN n_name ELSE 'Invalid Input' END AS label
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def label_join(t):
    """Nations of the first region have no label."""
    labels = t.nation.filter(F.col("n_regionkey") != 0).select(
        F.col("n_nationkey").alias("code"), F.col("n_name").alias("label"))
    return joins.label_join(t.customer, "c_nationkey", labels, sc.INVALID_LABEL).select("c_custkey", "label")
