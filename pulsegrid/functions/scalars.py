"""Column expressions: polynomials, calibration, units, codes, labels, text forms.

Everything here is a built-in Spark expression; nothing leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import ordered as od

TOLERANCE = 1e-8


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------------------------- polynomials


def poly_eval(coefs, x) -> Column:
    """Value at ``x``, coefficients highest power first, by nested multiplication.

    A Python sequence becomes one flat arithmetic expression; an array column is folded.
    """
    x = col(x).cast("double")
    if isinstance(coefs, (list, tuple)):
        acc = F.lit(float(coefs[0]))
        for c in coefs[1:]:
            acc = acc * x + F.lit(float(c))
        return acc
    return F.aggregate(col(coefs), F.lit(0.0), lambda a, c: a * x + c)


def poly_eval_complex(coefs, re, im) -> Column:
    """Value at the complex number ``re + im·i`` as ``struct<re,im>``; real coefficients, highest first."""
    re, im = col(re).cast("double"), col(im).cast("double")
    zero = F.struct(F.lit(0.0).alias("re"), F.lit(0.0).alias("im"))
    return F.aggregate(
        col(coefs), zero,
        lambda a, c: F.struct((a["re"] * re - a["im"] * im + c).alias("re"),
                              (a["re"] * im + a["im"] * re).alias("im")),
    )


def _derive(coefs: Column) -> Column:
    n = F.size(coefs)
    return F.when(
        n > 1, F.transform(F.slice(coefs, 1, n - 1), lambda c, i: c * (n - 1 - i))
    ).otherwise(F.array(F.lit(0.0)))


def poly_deriv(coefs, times: int = 1) -> Column:
    """Coefficients of the first (or ``times``-th) derivative, highest power first."""
    out = col(coefs)
    for _ in range(times):
        out = _derive(out)
    return out


def quadratic_roots(a, b, c) -> Column:
    """Both roots of a·x²+b·x+c as ``struct<r0 struct<re,im>, r1 struct<re,im>>``; null when a is 0."""
    a, b, c = (col(v).cast("double") for v in (a, b, c))
    disc = b * b - F.lit(4.0) * a * c
    root = F.sqrt(F.abs(disc))
    twice = F.lit(2.0) * a
    real = disc >= 0

    def part(sign: int) -> Column:
        re = F.try_divide(F.when(real, -b + sign * root).otherwise(-b), twice)
        im = F.try_divide(F.when(real, F.lit(0.0)).otherwise(sign * root), twice)
        return F.struct(re.alias("re"), im.alias("im"))

    return F.when(a != 0, F.struct(part(1).alias("r0"), part(-1).alias("r1")))


def number_text(x) -> Column:
    """A number with six significant digits, the shortest way: 1.5, -395.213, 1e+06, 3.4e-07."""
    x = col(x).cast("double")
    sci = F.format_string("%.5e", x)
    size = F.abs(x)
    # six digits read back as a double print without padding in this range
    usual = F.regexp_replace(sci.cast("double").cast("string"), r"\.0$", "")
    small = F.regexp_replace(sci.cast("decimal(24,12)").cast("string"), r"\.?0+$", "")
    far = F.regexp_replace(sci, r"\.?0*e", "e")
    return (
        F.when(x == 0, F.lit("0"))
        .when((size >= 0.001) & (size < 999999.5), usual)
        .when((size >= 0.000099999950) & (size < 0.001), small)
        .otherwise(far)
    )


def poly_text(coefs, tol: float = TOLERANCE) -> Column:
    """``1x^3 + 2x^2 - 1x^0``: highest power first, terms near zero dropped after the first."""
    coefs = col(coefs)
    n = F.size(coefs)

    def term(c: Column, i: Column) -> Column:
        power = F.concat(F.lit("x^"), (n - 1 - i).cast("string"))
        sign = F.when(c < 0, F.lit("- ")).otherwise(F.lit("+ "))
        return (
            F.when(i == 0, F.concat(number_text(c), power))
            .when(F.abs(c) > tol, F.concat(sign, number_text(F.abs(c)), power))
            .otherwise(F.lit(None))
        )

    return F.concat_ws(" ", F.filter(F.transform(coefs, term), lambda t: t.isNotNull()))


def fit_text(coefs, tol: float = TOLERANCE) -> Column:
    """``c0 + c1x + c2x^2``: lowest power first, terms near zero dropped, sign shown."""

    def term(c: Column, i: Column) -> Column:
        power = (
            F.when(i == 0, F.lit("")).when(i == 1, F.lit("x"))
            .otherwise(F.concat(F.lit("x^"), i.cast("string")))
        )
        sign = F.when(c < 0, F.lit("- ")).otherwise(F.lit("+ "))
        return F.when(F.abs(c) > tol, F.concat(sign, number_text(F.abs(c)), power))

    kept = F.filter(F.transform(col(coefs), term), lambda t: t.isNotNull())
    joined = F.concat_ws(" ", kept)
    joined = F.regexp_replace(F.regexp_replace(joined, r"^\+ ", ""), r"^- ", "-")
    return F.when(joined == "", F.lit("0")).otherwise(joined)


def near_zero(c, tol: float = TOLERANCE) -> Column:
    return F.abs(col(c)) < tol


# ----------------------------------------------------------------------------- calibration

# The eight coefficient sets (a2, a1, a0) of the calibration sweep.
CALIBRATION_SETS: tuple[tuple[int, float, float, float], ...] = (
    (1, -0.000358309, 1.24539, -395.213),
    (2, -0.000300, 1.200, -390.0),
    (3, -0.000360, 1.250, -396.0),
    (4, -0.000370, 1.260, -397.0),
    (5, -0.000380, 1.270, -398.0),
    (6, -0.000390, 1.280, -399.0),
    (7, -0.000400, 1.290, -400.0),
    (8, -0.000410, 1.300, -401.0),
)


def correction(real, a2, a1, a0) -> Column:
    """``real`` minus the polynomial error rounded half away from zero.

    The running value is kept in single precision after each step, as the
    original readings were corrected; a double would round a few of them otherwise.
    """
    real = col(real).cast("int")
    a2, a1, a0 = (c if isinstance(c, Column) else F.lit(float(c)) for c in (a2, a1, a0))
    res = a2.cast("float")
    for a in (a1, a0):
        res = ((res * real.cast("float")).cast("double") + a).cast("float")
    wide = res.cast("double")
    return real - F.when(wide >= 0, (wide + 0.5).cast("int")).otherwise((wide - 0.5).cast("int"))


def correct(df: DataFrame, real: str, a2, a1, a0, name: str = "corrected") -> DataFrame:
    return df.withColumn(name, correction(real, a2, a1, a0))


# ----------------------------------------------------------------------------- units and time


def adc_to_temp(df: DataFrame, adc: str) -> DataFrame:
    """Volts, °C and °F of a 14-bit reading against a 2.5 V reference."""
    volts = F.col(adc) * F.lit(2.5) / F.lit(16384.0)
    celsius = (volts - 0.5) * 100.0
    return df.withColumns({"volts": volts, "celsius": celsius, "fahrenheit": celsius * 9.0 / 5.0 + 32.0})


# Fixed value: kilometres in a mile.
KM_PER_MILE = 1.609


def miles_to_km(miles) -> Column:
    return col(miles) * F.lit(KM_PER_MILE)


def tick_to_clock(t) -> Column:
    """``HH:MM`` of a tick: 100 ticks a minute from 09:00; hours run past 24."""
    t = col(t).cast("long")
    minutes = F.floor(t / 100).cast("long")
    return F.format_string("%02d:%02d", F.lit(9) + F.floor(minutes / 60), minutes % 60)


# ----------------------------------------------------------------------------- codes

# Opcodes in the top three bits of a command byte.
OPCODES: dict[int, str] = {
    0x00: "RECIPE_END",
    0x20: "MOV",
    0x40: "WAIT",
    0x60: "REVERSE",
    0x80: "LOOP",
    0xA0: "END_LOOP",
}

# What a one-character device code shows.
DEVICE_LABELS: dict[str, str] = {"0": "OFF", "1": "Red", "2": "Blue", "3": "Green"}
INVALID_LABEL = "Invalid Input"

# The colour order of the indicator.
COLOURS = ("Red", "Green", "Blue", "Cyan", "Magenta", "Yellow", "White")


def code_label(code, mapping: Mapping = DEVICE_LABELS, default: str | None = INVALID_LABEL) -> Column:
    """The label of a code, or ``default``."""
    out = F
    for k, v in mapping.items():
        out = out.when(col(code) == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default))


def busy_label(busy, on_break) -> Column:
    """Busy wins over On Break, On Break over Idle."""
    return F.when(col(busy), "Busy").when(col(on_break), "On Break").otherwise("Idle")


def decode_packed(df: DataFrame, byte: str) -> DataFrame:
    """``op`` from the top three bits and ``operand`` from the low five; unknown opcodes are ``error``."""
    top = F.col(byte).cast("int").bitwiseAND(F.lit(0xE0))
    return df.withColumns({
        "op": code_label(top, OPCODES, "error"),
        "operand": F.col(byte).cast("int").bitwiseAND(F.lit(0x1F)),
    })


def clamp(c, lo, hi) -> Column:
    return F.greatest(F.least(col(c), F.lit(hi)), F.lit(lo))


def cycle_label(df: DataFrame, order, labels: Sequence[str] = COLOURS, key=None, **opts) -> DataFrame:
    """The n-th row along ``order`` gets label n modulo the number of labels."""
    numbered = od.scan(df, key, order, _rn=od.row_number(), **opts)
    pick = F.element_at(F.array(*[F.lit(x) for x in labels]),
                        ((F.col("_rn") - 1) % len(labels) + 1).cast("int"))
    return numbered.withColumn("label", pick).drop("_rn")


def char_count(s) -> Column:
    return F.length(col(s))


# ----------------------------------------------------------------------------- filters


def band_filter(df: DataFrame, c: str, lo, hi=None) -> DataFrame:
    """Rows with lo <= c <= hi. Without ``hi`` the band is 100 wide and ``lo`` must be in 50..9950."""
    if hi is None:
        if not 50 <= lo <= 9950:
            raise ValueError("lower limit must be between 50 and 9950")
        hi = lo + 100
    return df.filter(F.col(c).between(lo, hi))


def open_hours(df: DataFrame, ts: str, opens, closes) -> DataFrame:
    """Rows with opens <= ts < closes."""
    return df.filter((F.col(ts) >= F.lit(opens)) & (F.col(ts) < F.lit(closes)))


def apply_scalar(df: DataFrame, fn: Callable[[Column], Column], c: str, name: str = "y") -> DataFrame:
    """A caller's scalar function, given as an expression so that it compiles with the plan."""
    return df.withColumn(name, fn(F.col(c)))
