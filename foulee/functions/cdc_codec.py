"""Numbers as change-data-capture connectors write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foulee.functions.numeric import number_or_null

_BASE64 = r"^([A-Za-z0-9+/]{4})*([A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$"


def number_bytes(text: Column) -> Column:
    """Base64 text to bytes after dropping characters outside the alphabet; null when malformed."""
    kept = F.regexp_replace(text, "[^A-Za-z0-9+/=]", "")
    return F.when(kept.rlike(_BASE64), F.try_to_binary(kept, F.lit("base64")))


def _unsigned(data: Column) -> Column:
    """Up to seven bytes, most significant first, as a long."""
    return F.conv(F.hex(data), 16, 10).cast("long")


def _ieee_double(data: Column) -> Column:
    """Eight bytes, most significant first, as the double they encode."""
    bits = F.conv(F.hex(data), 16, -10).cast("long")
    sign = F.when(bits < 0, -1.0).otherwise(1.0)
    exponent = F.shiftright(bits, 52).bitwiseAND(F.lit(0x7FF))
    fraction = bits.bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))
    magnitude = (
        F.when(exponent == 0, fraction * F.lit(2.0**-1022))
        .when(exponent < 0x7FF, (fraction + 1.0) * F.pow(F.lit(2.0), (exponent - 1023).cast("double")))
        .when(fraction == 0.0, F.lit(float("inf")))
        .otherwise(F.lit(float("nan")))
    )
    return sign * magnitude


def _wide_unsigned(data: Column) -> Column:
    """More than eight bytes, folded into a double byte by byte."""
    size = F.length(data)
    digit = lambda i: F.conv(F.hex(F.substring(data, i, F.lit(1))), 16, 10).cast("double")
    return F.aggregate(
        F.when(size > 8, F.sequence(F.lit(1), size)), F.lit(0.0), lambda total, i: total * 256.0 + digit(i)
    )


def _twos_complement(data: Column, value: Column) -> Column:
    """``value`` read as signed: the top bit of its bytes counts negatively."""
    span = F.pow(F.lit(2.0), (F.length(data) * 8).cast("double"))
    return F.when(value * 2 >= span, value - span).otherwise(value)


def decode_number(text: Column, data: Column, scale: int = 2, signed: bool = False) -> Column:
    """A number sent as plain text or as base64 bytes; anything else is 0.0.

    ``data`` is :func:`number_bytes` of ``text``, best kept in a column because it is looked at
    many times. Eight bytes are a big-endian double, any other length a big-endian integer with
    ``scale`` decimals. Integers are read unsigned unless ``signed``. Text that is a valid number
    is taken as one even if it would also be valid base64.
    """
    size = F.length(data)
    integer = F.when(size > 8, _wide_unsigned(data)).otherwise(
        F.when(size > 0, F.when(size < 8, _unsigned(data))).otherwise(0).cast("double")
    )
    if signed:
        integer = _twos_complement(data, integer)
    decoded = F.when(size == 8, _ieee_double(data)).otherwise(integer / F.lit(float(10**scale)))
    return F.coalesce(number_or_null(text), decoded, F.lit(0.0))
