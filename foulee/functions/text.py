"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space around free text.
_WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def text(*parts: Column | str) -> Column:
    """Literal and computed parts joined; null when a computed part is null."""
    return F.concat(*[F.lit(part) if isinstance(part, str) else part for part in parts])


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_WHITE_SPACE))


def blank_to_null(text: Column) -> Column:
    """Stripped text, or null when nothing is left."""
    return F.nullif(strip(text), F.lit(""))


def address_key(address: Column) -> Column:
    """Addresses that differ only in case and spacing share one key; a blank one has none."""
    return F.nullif(F.lower(F.trim(F.regexp_replace(address, r"\s+", " "))), F.lit(""))


def full_name(first: Column, last: Column) -> Column:
    """First and last name separated by a space; null when either is missing."""
    return F.concat(first, F.lit(" "), last)


def quoted_comment(comment: Column) -> Column:
    """The comment as a quotation on a new line, or nothing when it is blank."""
    return F.when(strip(comment) != "", F.concat(F.lit("\n> _"), comment, F.lit("_"))).otherwise("")


def day_first(moment: Column) -> Column:
    """A wall-clock time as ``dd/MM/yyyy HH:mm``. Formatting its text form keeps the session time
    zone, and its clock changes, out of it."""
    parts = r"^(\d{4})-(\d{2})-(\d{2}) (\d{2}:\d{2}).*$"
    return F.regexp_replace(moment.cast("string"), parts, "$3/$2/$1 $4")
