"""Fixed-point numbers: a long scaled by 2^n."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import col


def _n(n) -> str:
    return str(n) if isinstance(n, int) else f"`{n}`"


def _scale(n) -> Column:
    return F.expr(f"shiftleft(1L, cast({_n(n)} as int))")


def qn_encode(x, n) -> Column:
    """Truncated toward zero. ``n`` is an int or the name of a column."""
    return (col(x) * _scale(n)).cast("long")


def qn_decode(q, n) -> Column:
    return col(q).cast("double") / _scale(n).cast("double")


def qn_mul(a: str, b: str, n) -> Column:
    return F.expr(f"shiftright(`{a}` * `{b}`, cast({_n(n)} as int))")


def qn_div(a: str, b: str, n) -> Column:
    """(a shifted left by n) / b, truncated toward zero; null for b = 0."""
    return F.expr(f"shiftleft(`{a}`, cast({_n(n)} as int)) div nullif(`{b}`, 0L)")
