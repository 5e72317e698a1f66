"""Reporting periods `YYYY-<letter><int>` as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# How many periods of each kind a year holds (half years, quarters,
# months, weeks, days). The bounds of H, Q, M, W and D are our assumption.
PERIODS_PER_YEAR = {"H": 2, "Q": 4, "M": 12, "W": 53, "D": 366}
# Periods with a required number, and year / snapshot / initial ones.
NUMBERED_PERIOD = r"\d{4}-[H|Q|M|W|D]\d"
OTHER_PERIOD = r"\d{4}-[J|A|I]"
# Validity of a row that has no dated history yet.
BEGIN_OF_TIME = "1970-01-01"
END_OF_TIME = "9999-12-31"


def well_formed(period: Column) -> Column:
    return period.rlike(f"^(?:{NUMBERED_PERIOD})") | period.rlike(f"^(?:{OTHER_PERIOD})")


def is_well_formed(period: str) -> bool:
    return re.match(f"(?:{NUMBERED_PERIOD})|(?:{OTHER_PERIOD})", period) is not None


def year_of(period: Column) -> Column:
    return F.substring(period, 1, 4).try_cast("int")


def letter_of(period: Column) -> Column:
    return F.substring(period, 6, 1)


def number_of(period: Column) -> Column:
    return F.substring(period, 7, 12).try_cast("int")


def limit_of(letter: Column) -> Column:
    """Periods per year of a letter, null for the letters that are not bounded."""
    limit = F.lit(None).cast("int")
    for name, count in PERIODS_PER_YEAR.items():
        limit = F.when(letter == name, F.lit(count)).otherwise(limit)
    return limit


def add(period: Column, steps: Column | int) -> Column:
    """The period `steps` later (or earlier), rolling over into other years.

    `J` counts years, `A` is an unbounded counter that starts at 1, `I` stays itself.
    Results outside the years 1000-9999 or below counter 1 are null.
    """
    steps = F.lit(steps) if isinstance(steps, int) else steps
    year, letter, number = year_of(period), letter_of(period), number_of(period)
    limit = limit_of(letter)
    place = number - 1 + steps
    new_year = year + F.floor(place / limit).cast("int")
    new_number = F.pmod(place, limit) + 1
    rolled = F.concat_ws("", new_year, F.lit("-"), letter, new_number)
    years = F.concat_ws("", year + steps, F.lit("-J"))
    counted = F.concat_ws("", year, F.lit("-A"), number + steps)
    return (
        F.when(letter == "I", period)
        .when((letter == "J") & (year + steps).between(1000, 9999), years)
        .when((letter == "A") & (number + steps >= 1), counted)
        .when(limit.isNotNull() & new_year.between(1000, 9999), rolled)
    )


def of_date(day: Column, letter: str) -> Column:
    """The period of a kind that holds a day; weeks are ISO weeks of the week's own year."""
    number = {
        "H": F.when(F.month(day) <= 6, 1).otherwise(2),
        "Q": F.quarter(day),
        "M": F.month(day),
        "W": F.weekofyear(day),
        "D": F.dayofyear(day),
    }
    if letter == "W":
        return F.concat_ws("", F.extract(F.lit("YEAROFWEEK"), day), F.lit("-W"), number[letter])
    if letter == "J":
        return F.concat_ws("", F.year(day), F.lit("-J"))
    return F.concat_ws("", F.year(day), F.lit(f"-{letter}"), number[letter])


def first_day(period: Column) -> Column:
    """First day of a numbered period or year; null for `A` and `I`."""
    year, letter, number = year_of(period), letter_of(period), number_of(period)
    month = (
        F.when(letter == "J", F.lit(1))
        .when(letter == "H", number * 6 - 5)
        .when(letter == "Q", number * 3 - 2)
        .when(letter == "M", number)
    )
    january = F.make_date(year, F.lit(1), F.lit(1))
    iso_monday = F.date_trunc("week", F.make_date(year, F.lit(1), F.lit(4)))
    return (
        F.when(month.isNotNull(), F.make_date(year, month, F.lit(1)))
        .when(letter == "D", F.date_add(january, number - 1))
        .when(letter == "W", F.date_add(iso_monday.cast("date"), (number - 1) * 7))
    )


def calendar(years_column: Column, letter: str) -> Column:
    """All periods of one year as an array, numbers padded to two digits."""
    if letter == "J":
        return F.array(F.concat_ws("", years_column, F.lit("-J01")))
    numbers = F.sequence(F.lit(1), F.lit(PERIODS_PER_YEAR[letter]))
    return F.transform(
        numbers,
        lambda n: F.concat_ws(
            "",
            years_column,
            F.lit(f"-{letter}"),
            F.lpad(n.cast("string"), F.greatest(F.length(n.cast("string")), F.lit(2)), "0"),
        ),
    )


def change_window(name: Column) -> tuple[Column, Column]:
    """Validity of the rows of a change file named `.._yyyymmdd-yyyymmdd`.

    New versions start on the first day of the month of the second date; versions they
    replace end on the day before.
    """
    end = F.to_date(F.regexp_extract(name, r"\d{8}-(\d{8})[^_]*$", 1), "yyyyMMdd")
    start = F.trunc(end, "MM")
    return start, F.date_sub(start, 1)


def period_window(period: Column) -> tuple[Column, Column]:
    """The same window taken from a reporting period instead of a file name."""
    start = first_day(period)
    return start, F.date_sub(start, 1)
