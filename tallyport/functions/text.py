"""Text clean-up expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# The characters a full Unicode strip removes.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _white_or_empty(character: Column) -> Column:
    return F.translate(character, WHITE_SPACE, "") == ""


def strip(cell: Column) -> Column:
    """Both ends without white space; plain `trim` would remove blanks only.

    Most cells have none at either end: a look at the first and the last character
    spares them the trim, which copies character by character.
    """
    ends = _white_or_empty(F.substring(cell, 1, 1)) | _white_or_empty(F.substring(cell, -1, 1))
    return F.when(ends, F.trim(cell, F.lit(WHITE_SPACE))).otherwise(cell)


def is_blank(cell: Column) -> Column:
    first = F.substring(cell, 1, 1)
    return _white_or_empty(first) & (F.trim(cell, F.lit(WHITE_SPACE)) == "")


def null_or_empty(cell: Column) -> Column:
    return F.coalesce(cell, F.lit("")) == ""


def header_name(raw: Column, position: Column) -> Column:
    """Snake-case column name of a raw header; `col_<position>` when it has no letter."""
    name = F.regexp_replace(F.lower(raw), "[^0-9a-z_]+", "_")
    # Spark evaluates a column again that stands in branches only; both ends are looked at
    # first, so the replacement is made once, and most names are spared the work on their ends
    name = F.when(F.substring(name, 1, 1).between("a", "z"), name).otherwise(F.regexp_replace(name, "^[^a-z]+", ""))
    name = (
        F.when(name.endswith("__"), F.rtrim(name, F.lit("_")))
        .when(name.endswith("_"), F.substring(name, F.lit(1), F.length(name) - 1))
        .otherwise(name)
    )
    return F.when(name != "", name).otherwise(
        F.concat(F.lit("col_"), position.cast("string"))
    )


def header_names(raw: list[str]) -> list[str]:
    """The same rule for the handful of header names a driver holds."""
    names = []
    for position, header in enumerate(raw):
        name = re.sub("[^0-9a-z_]+", "_", header.strip().lower()).strip("_")
        names.append(re.sub("^[^a-z]+", "", name) or f"col_{position}")
    return names


def java_pattern(pattern: str) -> str:
    """Contract patterns use `(?P<n>..)` groups; Java spells them `(?<n>..)`."""
    return pattern.replace("(?P<", "(?<").replace("(?P=", "\\k<")


def java_replacement(replacement: str) -> str:
    """Back-references `\\1` become `$1`; a literal dollar sign is escaped."""
    escaped = replacement.replace("$", "\\$")
    return re.sub(r"\\(\d)", r"$\1", escaped)


def starts_with_match(cell: Column, pattern: str) -> Column:
    """The pattern matches from the start of the cell (it need not reach the end)."""
    return cell.rlike("(?d)^(?:" + java_pattern(pattern) + ")")
