"""Names, codes, search terms and masking."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def full_name(first: Column, last: Column) -> Column:
    """NULL if either part is NULL."""
    return F.concat(first, F.lit(" "), last)


def business_code(prefix: str, year: Column | int, number: Column) -> Column:
    """PREFIX-YYYY-000001; numbers beyond six digits keep all of them."""
    year = F.lit(year) if isinstance(year, int) else year
    digits = number.cast("string")
    padded = F.lpad(digits, F.greatest(F.length(digits), F.lit(6)), F.lit("0"))
    return F.concat_ws("-", F.lit(prefix), year.cast("string"), padded)


def words(col: Column) -> Column:
    """Lower-case letter and digit runs, without stemming or stop words."""
    return F.split(F.lower(col), r"[^\p{L}\p{N}]+")


def has_word(col: Column, term: str) -> Column:
    return F.array_contains(words(col), term.lower())


def masked_email(col: Column) -> Column:
    """First character and domain stay readable."""
    return F.regexp_replace(col, r"^(.)[^@]*", "$1***")


def masked_digits(col: Column, keep: int = 3) -> Column:
    """Stars for every character but the last ``keep``."""
    hidden = F.greatest(F.length(col) - keep, F.lit(0))
    return F.concat(F.repeat(F.lit("*"), hidden), F.right(col, F.lit(keep)))
