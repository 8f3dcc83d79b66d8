"""Exact integer arithmetic (money and percentages never go through floating point)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def idiv(a: Column, b: Column) -> Column:
    """Floor division of integers (b > 0) by integral division: no double in between, so exact for all of bigint.

    ``div`` cuts towards zero; taking the remainder off first makes it the floor for negative ``a`` too.
    """
    return F.call_function("div", a - F.pmod(a, b), b)


def round_half_up_ratio(num: Column, den: Column) -> Column:
    """round(num/den) half-up for num >= 0, den > 0."""
    return idiv(2 * num + den, 2 * den)


def pct_half_up(num: Column, den: Column) -> Column:
    """round(100*num/den) half-up, 0 when den = 0."""
    return F.when(den > 0, idiv(200 * num + den, 2 * den)).otherwise(F.lit(0)).cast("bigint")


def pct1_half_up(num: Column, den: Column) -> Column:
    """round(100*num/den, 1) half-up, as a double with one decimal; NULL when den = 0."""
    return F.when(den > 0, idiv(2000 * num + den, 2 * den) / 10.0)


def pct_half_even(num: Column, den: Column) -> Column:
    """round(100*num/den) half-to-even (Python round), 0 when den = 0."""
    q = idiv(100 * num, den)
    r2 = 2 * F.pmod(100 * num, den)
    up = (r2 > den) | ((r2 == den) & (F.pmod(q, F.lit(2)) == 1))
    return F.when(den > 0, q + F.when(up, 1).otherwise(0)).otherwise(F.lit(0)).cast("bigint")


def at_gate(num: Column, den: Column, gate_num: int = 3, gate_den: int = 5, strict: bool = False) -> Column:
    """num/den >= gate (or > gate), exactly: gate_den*num >= gate_num*den; False when den = 0."""
    lhs, rhs = gate_den * num, gate_num * den
    return (den > 0) & ((lhs > rhs) if strict else (lhs >= rhs))
