"""Rounding and money."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Veltkamp's constant for doubles, 2**27 + 1: splits a 53-bit significand into two halves.
_SPLITTER = 134217729.0


_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def number_or_null(text: Column) -> Column:
    """Text as a double, null unless it is a plain number; a bare cast would also take ``12d``."""
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def round_binary(x: Column, digits: int) -> Column:
    """Round a double half-even on its exact binary value, as ``round(x, digits)`` does in Python.

    Spark's own ``round`` works on the shortest decimal form, where 12.35 is a tie; as a double it
    is below the tie and gives 12.3. Only when ``x * 10**digits`` comes out as a tie can its
    nearest whole number be the wrong one; the product's own rounding error (Dekker's exact
    product) then decides, without a UDF.
    """
    scale = float(10**digits)
    product = x * F.lit(scale)
    high = x * F.lit(_SPLITTER) - (x * F.lit(_SPLITTER) - x)
    error = (high * F.lit(scale) - product) + (x - high) * F.lit(scale)
    nearest = F.rint(product)
    misled = (F.abs(product - nearest) == 0.5) & (error * (nearest - product) < 0.0)
    rounded = F.when(misled, product + product - nearest).otherwise(nearest) / F.lit(scale)
    return F.when(F.abs(product) < float(1 << 52), rounded).otherwise(x)  # larger ones have no decimals left


def decimal_text(x: Column, digits: int) -> Column:
    """``x`` as fixed-point text with ``digits`` decimals, rounded by :func:`round_binary`."""
    return round_binary(x, digits).try_cast(f"decimal(30,{digits})").cast("string")


def money(salary: Column, rate: Decimal) -> Column:
    """Exact product of a gross salary and a rate, kept in decimal."""
    return salary.cast("decimal(12,2)") * F.lit(rate)


def kilometres(distance_m: Column) -> Column:
    """Metres to kilometres with one decimal, ties away from zero (decimal rounding)."""
    return F.round(distance_m.cast("decimal(18,3)") / F.lit(Decimal(1000)), 1)


def whole_minutes(seconds: Column) -> Column:
    """Seconds to minutes, ties to the even minute."""
    return F.bround(seconds / F.lit(60.0), 0).cast("long")
