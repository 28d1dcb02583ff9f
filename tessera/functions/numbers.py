"""Numbers in extracted text: any decimal digits, and no failure on text that is no number."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@cache
def _digits() -> tuple[str, str]:
    """Every decimal digit beyond ASCII, and the ASCII digit of the same value."""
    found = [(chr(c), unicodedata.decimal(chr(c), None)) for c in range(128, sys.maxunicode + 1)]
    found = [(c, str(v)) for c, v in found if v is not None]
    return "".join(c for c, _ in found), "".join(v for _, v in found)


def ascii_digits(text: Column) -> Column:
    return F.when(F.length(text) == F.octet_length(text), text).otherwise(F.translate(text, *_digits()))


def to_double(text: Column) -> Column:
    """The text as a double, NULL if it is none."""
    return ascii_digits(text).try_cast("double")


def to_long(text: Column) -> Column:
    """The text as a long, NULL if it is none or out of range."""
    return ascii_digits(text).try_cast("bigint")
