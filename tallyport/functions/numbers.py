"""Text to number, and numbers as the text shown in messages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WHOLE = r"^\s*[+-]?[0-9]+\s*$"
REAL = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([Ee][+-]?[0-9]+)?\s*$"


def whole_number(cell: Column) -> Column:
    """Whole number of any size up to 38 digits; anything else is null."""
    return F.when(cell.rlike(WHOLE), F.trim(cell).try_cast("decimal(38,0)"))


def real_number(cell: Column) -> Column:
    """Double; anything that is not plain decimal or exponent notation is null.

    The pattern keeps out `1d`, `NaN` and `Infinity`, which a bare cast accepts.
    """
    return F.when(cell.rlike(REAL), F.trim(cell).try_cast("double"))


def shown_real(value: Column) -> Column:
    """Short decimal text, such as `500.0`, `0.001`, `12345678.9` or `1e-05`.

    The digits are those of the JVM; before JDK 19 it prints a few very large or very
    small numbers with more digits than needed.
    """
    plain = F.regexp_replace(
        value.cast("decimal(38,20)").cast("string"), r"(\.\d+?)0*$", "$1"
    )
    scientific = F.regexp_replace(value.cast("string"), r"\.0E", "E")
    scientific = F.regexp_replace(scientific, r"E-(\d)$", "E-0$1")
    scientific = F.regexp_replace(scientific, r"E(\d)", "E+$1")
    size = F.abs(value)
    return (
        F.when(value == 0, F.lit("0.0"))
        .when((size >= 1e-3) & (size < 1e7), value.cast("string"))
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(F.lower(scientific))
    )
