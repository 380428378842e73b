"""Small array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that parts words, as a class of Java regular expressions.
BLANK = r"[\x20\x09-\x0D]"


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once per row, however often a lambda inside uses it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def words_of(text: Column) -> Column:
    """Words of a text, as an array; null and blank texts have none."""
    trimmed = F.regexp_replace(text, rf"^{BLANK}+|{BLANK}+$", "")
    none = F.array().cast("array<string>")
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, none).otherwise(
        let(trimmed, lambda t: F.when(t == "", none).otherwise(F.split(t, rf"{BLANK}+")))
    )


#: Bits of a hash that a sample goes by.
SAMPLE_BITS = 62


def hash_limit(wanted: int, rows: int) -> int:
    """The ``SAMPLE_BITS``-bit hash below which about ``wanted`` of ``rows`` rows lie."""
    return int(min(1.0, wanted / max(rows, 1)) * 2**SAMPLE_BITS)


def drawn(wanted: int, rows: int, *key: Column | str) -> Column:
    """True for about ``wanted`` of ``rows`` rows, by a hash of the key: the same at any size of table."""
    return F.shiftrightunsigned(F.xxhash64(*key), 64 - SAMPLE_BITS) < F.lit(hash_limit(wanted, rows))
