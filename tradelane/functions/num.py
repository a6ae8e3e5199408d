"""Rounding and ratios that come out the same on every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_double(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("double")


def det_round(col: Column, digits: int) -> Column:
    """Half-away-from-zero rounding of a DOUBLE with one fixed formula.

    Built-in ROUND on doubles goes through a decimal string in Spark, so its
    last digit can differ from other engines.
    """
    scale = F.lit(float(10**digits))
    x = as_double(col)
    return F.signum(x) * F.floor(F.abs(x) * scale + F.lit(0.5)).cast("double") / scale + F.lit(0.0)


def ratio(num: Column, den: Column) -> Column:
    """DOUBLE division, NULL when the divisor is zero (ANSI mode would raise)."""
    return as_double(num) / F.nullif(as_double(den), F.lit(0.0))


def pct(num: Column, den: Column, digits: int = 1) -> Column:
    return det_round(F.lit(100.0) * ratio(num, den), digits)


def change_pct(cur: Column, prev: Column, digits: int = 1) -> Column:
    return det_round(raw_change_pct(cur, prev), digits)


def raw_change_pct(cur: Column, prev: Column) -> Column:
    return F.lit(100.0) * ratio(cur - prev, prev)


def whole(col: Column) -> Column:
    """Round a decimal to a whole BIGINT (a plain cast would truncate)."""
    return F.round(col, 0).cast(T.LongType())


def money(col: Column | str, precision: int = 12) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast(T.DecimalType(precision, 2))
