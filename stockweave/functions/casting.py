"""Quantity rules of the feeds.

Feeds differ in how strict they are about a quantity: a store's bad cell ends that store, a bad
cell of the online shop or the depot ends the run, head office counts a bad cell as zero. The
``strict_*`` functions answer NULL for a bad cell, the ``require_*`` ones raise.

They also differ in what they read as a number. The strict rules take digits of every script, single
underscores between digits and any white space around; head office's takes ASCII alone.
"""

from __future__ import annotations

import sys
from unicodedata import category, decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockweave.fixed_values import MISSING_WORDS

# Plain decimal notation. Spark alone would also read 5d, 5f, NaN and Infinity.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
LEADING_PATTERN = r"^[+-]?(Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)"
INTEGER_PATTERN = r"^[+-]?[0-9]+$"

_CHARACTERS = [chr(code) for code in range(sys.maxunicode + 1)]
#: White space of ASCII, and of Unicode (which leaves out the separators below 0x20).
ASCII_BLANKS = "".join(c for c in _CHARACTERS[:0x1C] + [" "] if c.isspace())
BLANKS = ASCII_BLANKS + "".join(c for c in _CHARACTERS[0x80:] if c.isspace())
#: Decimal digits of all other scripts, and the ASCII ones that they stand for.
_DIGITS = [c for c in _CHARACTERS[0x80:] if category(c) == "Nd"]
DECIMAL_DIGITS = "".join(_DIGITS), "".join(str(decimal(c)) for c in _DIGITS)


def na_to_null(text: Column) -> Column:
    """NULL for the words which stand for a missing cell."""
    return F.when(~text.isin(*MISSING_WORDS), text)


def _plain_number(trimmed: Column) -> Column:
    return F.when(trimmed.rlike(NUMBER_PATTERN), trimmed).try_cast("double")


def number(text: Column) -> Column:
    """Double value of a plain number between ASCII white space, else NULL."""
    return _plain_number(F.btrim(text, F.lit(ASCII_BLANKS)))


def spelt_number(text: Column) -> Column:
    """A number's text as the strict rules spell it: without white space of any kind around it, its
    digits ASCII whatever their script, without single underscores between digits."""
    digits = F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, *DECIMAL_DIGITS)).otherwise(text)
    return F.regexp_replace(F.btrim(digits, F.lit(BLANKS)), "(?<=[0-9])_(?=[0-9])", "")


def truncated(value: Column) -> Column:
    """Whole part of a double, NULL where it does not fit a bigint."""
    return value.try_cast("bigint")


def strict_int_from_number(text: Column) -> Column:
    """Cells which were numbers in the workbook: the fraction is cut, anything else is bad."""
    return truncated(_plain_number(spelt_number(text)))


def strict_int_from_text(text: Column) -> Column:
    """Cells which were text in the workbook: whole numbers only."""
    spelt = spelt_number(text)
    return F.when(spelt.rlike(INTEGER_PATTERN), spelt).try_cast("bigint")


def coerced_int(text: Column) -> Column:
    """Whole part of a number; zero where the cell is not one."""
    return F.coalesce(truncated(number(text)), F.lit(0).cast("bigint"))


def require_double(text: Column, what: str) -> Column:
    """Double value; the query fails on a missing, non-numeric or infinite cell."""
    value = _plain_number(spelt_number(text))
    finite = value.isNotNull() & (F.abs(value) < F.lit(float("inf")))
    return F.when(finite, value).otherwise(_fail(text, what).cast("double"))


def require_int(text: Column, what: str) -> Column:
    """Whole part of a number; the query fails on any other cell."""
    return F.coalesce(strict_int_from_number(text), _fail(text, what).cast("bigint"))


def leading_number(text: Column) -> Column:
    """The number that a text starts with: ``12abc`` is 12. NaN if it starts with none."""
    trimmed = F.regexp_replace(text, r"^[\s\u00a0\ufeff]+", "")
    found = F.regexp_extract(trimmed, LEADING_PATTERN, 0)
    return F.coalesce(F.when(found != "", found).try_cast("double"), F.lit(float("nan")))


def _fail(text: Column, what: str) -> Column:
    return F.raise_error(
        F.concat(F.lit(f"{what}: not a quantity: "), F.coalesce(text, F.lit("<missing>")))
    )
