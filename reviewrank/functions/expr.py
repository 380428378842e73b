"""Column expressions. All are built from native functions, so they stay in generated code."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewrank.schema import NO_REASON

# Words that stand for a missing cell. The first list is matched on the cell as it
# is (what a pandas CSV reader drops), the second on the trimmed lower-case text.
CSV_NULL_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
TEXT_NULL_WORDS = ["", "nan", "none", "<na>"]
NUMBER_PATTERN = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))$"
_QUOTED = r"""\s*('[^']*'|"[^"]*")\s*"""
_MANY = rf"{_QUOTED}(,{_QUOTED})*,?\s*"
# A list or set of quoted words, or a tuple of them (one word in round brackets is no tuple).
PYTHON_LIST_PATTERN = (
    rf"(?s)^(\[\s*({_MANY})?\]|\{{{_MANY}\}}|\(\s*\)|\({_QUOTED},\s*\)|\({_QUOTED}(,{_QUOTED})+,?\s*\))$"
)
WHITESPACE = " \t\n\r\f\u000b"
# Both lists of words as one pattern, which is short code where many cells of a row are cleaned.
_CSV_NULL, _TEXT_NULL = ("|".join(map(re.escape, words)) for words in (CSV_NULL_WORDS, TEXT_NULL_WORDS))
MISSING_PATTERN = rf"\A(?:{_CSV_NULL}|[{WHITESPACE}]*(?i:{_TEXT_NULL})[{WHITESPACE}]*)\z"


def np_round(c: Column, digits: int) -> Column:
    """Round the way numpy does: scale, round half to even, unscale (not on the decimal text)."""
    scale = float(10**digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def at_least_zero(c: Column) -> Column:
    return F.greatest(c, F.lit(0.0))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def clean_text(c: Column) -> Column:
    """Trimmed text, or null for an empty cell or a word that means missing."""
    text = c.cast("string")
    return F.when(~text.rlike(MISSING_PATTERN), strip(text))


def number(df: DataFrame, name: str) -> Column:
    """Double, or null where the cell holds no number. NaN becomes null: Spark orders NaN above
    every number, so ``NaN >= 3`` would be true."""
    dtype = df.schema[name].dataType.simpleString()
    if dtype == "string":
        text = strip(F.col(name))
        return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def number_or_zero(df: DataFrame, name: str) -> Column:
    return F.coalesce(number(df, name), F.lit(0.0)) if name in df.columns else F.lit(0.0)


def first_nonempty(names: list[str]) -> Column:
    return F.coalesce(*[clean_text(F.col(n)) for n in names]) if names else F.lit(None).cast("string")


def count_populated(names: list[str]) -> Column:
    return add([clean_text(F.col(n)).isNotNull().cast("long") for n in names], F.lit(0).cast("long"))


def add(terms: list[Column], start: Column) -> Column:
    return reduce(lambda a, b: a + b, terms, start)


def yyyymmdd_text(name: str) -> Column:
    return F.regexp_replace(clean_text(F.col(name)), r"\.0$", "")


def yyyymmdd_or_null(name: str) -> Column:
    return date_of(yyyymmdd_text(name))


def date_of(text: Column) -> Column:
    return F.when(text.rlike(r"^\d{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd")))


def date_problem(name: str, text: Column, date: Column) -> Column:
    """What is wrong with a cell that is neither missing nor eight digits of a date; null where nothing is.
    ``text`` and ``date`` are the cleaned cell and what it was read as."""
    bad = text.isNotNull() & date.isNull()
    return F.when(bad, F.concat(F.lit(f"no YYYYMMDD date in {name}: "), text))


def sound(problems: list[Column]) -> Column:
    """A condition that holds for every row without a problem; one with a problem stops the job with it.

    As a filter it runs whatever columns are read later, so checking costs no pass of its own."""
    found = F.coalesce(*problems)
    return F.when(found.isNull(), F.lit(True)).otherwise(F.raise_error(found).cast("boolean"))


def wall_clock_seconds(c: Column) -> Column:
    """Seconds since 1970 on the calendar of the column, whatever the session zone: 30 days are
    always 30 * 86,400 apart."""
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86_400 + F.hour(c) * 3_600 + F.minute(c) * 60 + F.second(c)


def hash52(*parts: Column | str | int) -> Column:
    """52 bits of the MD5 of the parts' text, joined by colons: the same number in any engine that has MD5."""
    text = F.concat_ws(":", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def packed(names: list[str], out: str) -> dict[str, Column]:
    """Whole numbers as columns ``out`` and ``out_large`` for ``unpacked``: one number with some bits of each, which is
    short in a shuffle. Where one is null, negative or needs more bits, they stand in the struct ``out_large`` as they are."""
    bits = 63 // len(names)
    small = reduce(lambda a, b: a & b, [F.coalesce(F.col(n).between(0, 2**bits - 1), F.lit(False)) for n in names])
    total = reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(F.col(n).cast("bigint"), bits * i) for i, n in enumerate(names)])
    return {out: F.when(small, total), f"{out}_large": F.when(~small, F.struct(*names))}


def unpacked(names: list[str], out: str, kinds: dict[str, str]) -> dict[str, Column]:
    """The columns that ``packed`` put together, with their types."""
    bits = 63 // len(names)
    one = [F.shiftright(F.col(out), bits * i).bitwiseAND(F.lit(2**bits - 1)).cast(kinds[n]) for i, n in enumerate(names)]
    return {n: F.when(F.col(out).isNotNull(), c).otherwise(F.col(f"{out}_large")[n]) for n, c in zip(names, one)}


def is_weekend(c: Column) -> Column:
    return F.dayofweek(c).isin(1, 7)


# --- review flags and reason codes -------------------------------------------------------------


def parse_flag(df: DataFrame, name: str) -> Column:
    """Boolean from a boolean, a number or its text (its integer part is not 0) or true/yes, false/no; null
    for anything else."""
    dtype = df.schema[name].dataType.simpleString()
    c = F.col(name)
    if dtype == "boolean":
        return c
    if dtype != "string":
        return F.abs(F.nanvl(c.cast("double"), F.lit(None).cast("double"))) >= 1.0
    text = F.lower(strip(c))
    value = F.when(text.rlike(r"^[+-]?\d+(\.\d*)?$"), text.cast("double"))
    return (
        F.when(value.isNotNull(), F.abs(value) >= 1.0)
        .when(text.isin("true", "yes"), F.lit(True))
        .when(text.isin("false", "no"), F.lit(False))
    )


def parse_reason_codes(df: DataFrame, name: str) -> Column:
    """Array of codes from an array, a bracketed list of quoted words, or words split by comma or pipe."""
    c = F.col(name)
    empty = F.array().cast("array<string>")
    if df.schema[name].dataType.simpleString().startswith("array"):
        kept = F.filter(c.cast("array<string>"), lambda x: strip(x) != "")
        return F.coalesce(kept, empty)
    text = strip(c)
    quoted = F.regexp_extract_all(text, F.lit(r"""'([^']*)'|"([^"]*)\""""), F.lit(0))
    from_list = F.transform(quoted, lambda x: F.substring(x, F.lit(2), F.length(x) - 2))
    split = F.transform(F.split(F.replace(text, F.lit("|"), F.lit(",")), ","), strip)
    is_list = text.rlike(PYTHON_LIST_PATTERN)
    codes = F.when(is_list, from_list).otherwise(split)
    return F.when(text.isNull() | (text == "") | (text == "[]"), empty).otherwise(
        F.filter(codes, lambda x: strip(x) != "")
    )


def reason_display(codes: Column) -> Column:
    return F.when(F.size(codes) > 0, F.array_join(codes, ", ")).otherwise(F.lit(NO_REASON))


def reason_badges(codes: Column) -> Column:
    """Codes as words for a reader: ``EXCESS_UNITS`` becomes ``Excess Units``."""
    shown = F.when(F.size(codes) > 0, codes).otherwise(F.array(F.lit(NO_REASON)))
    return F.transform(shown, lambda x: F.initcap(F.replace(x, F.lit("_"), F.lit(" "))))


def list_text(codes: Column) -> Column:
    """An array as the text of a Python list, for CSV files, which hold no arrays."""
    quoted = F.transform(codes, lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
