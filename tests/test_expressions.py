"""Column expressions against the plain Python rules they stand for."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyport.contract import ContractColumn, ContractError
from tallyport.functions import datatypes, numbers, periods, text
from tallyport.operators import checks
from tallyport.operators import profile
from tallyport.operators.cleaning import Replacement, replaced


def values(spark, cells, *columns, kind="string"):
    frame = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, c {kind}")
    return [tuple(r)[1:] for r in frame.select("i", *columns).orderBy("i").collect()]


# Header names and what becomes of them.
HEADERS = {
    "12__ne##$w_": "ne_w",
    "AbC  #dF$w_": "abc_df_w",
    "A+cF-*?ë.,mN(xy){}[]": "a_cf_mn_xy",
    "my_2#$%3fr y_": "my_2_3fr_y",
    " 12_#": "col_4",
}


def test_header_names(spark):
    raw, wanted = list(HEADERS), list(HEADERS.values())
    assert text.header_names(raw) == wanted
    assert values(spark, raw, text.header_name(F.col("c"), F.col("i"))) == [(w,) for w in wanted]


def test_strip_is_a_full_unicode_strip(spark):
    rng = random.Random(1)
    pool = text.WHITE_SPACE + "aé文​😀"
    cells = ["".join(rng.choice(pool) for _ in range(rng.randrange(9))) for _ in range(500)]
    assert values(spark, cells, text.strip(F.col("c"))) == [(c.strip(),) for c in cells]
    assert values(spark, cells, text.is_blank(F.col("c"))) == [(not c.strip(),) for c in cells]
    every = [chr(i) for i in range(0x3100) if not 0xD800 <= i < 0xE000]
    assert values(spark, every, text.strip(F.col("c"))) == [(c.strip(),) for c in every]


def test_regex_replacement(spark):
    cells = ["3-", "-4.5E-03", "a-b-c", "$1-", "", "--"]
    for pattern, new in (("(.*)-", "-\\1"), ("-", "$"), ("(?P<x>[a-c])", "<\\1>")):
        rule = Replacement("c", {pattern: new}, regex=True)
        assert values(spark, cells, replaced(F.col("c"), rule)) == [(re.sub(pattern, new, c),) for c in cells]


def test_value_replacement_is_not_chained(spark):
    rule = Replacement("c", {"a": "b", "b": "a", "": "none"})
    assert values(spark, ["a", "b", "", "ab"], replaced(F.col("c"), rule)) == [("b",), ("a",), ("none",), ("ab",)]


def test_shown_real_is_the_shortest_text(spark):
    rng = random.Random(5)
    # up to 12 digits, as delivered; a JVM before 19 prints some numbers with too many
    cells = [float(f"{rng.uniform(-1, 1) * 10.0 ** rng.randint(-5, 14):.12g}") for _ in range(400)]
    cells += [float(rng.randint(-10**9, 10**9)) / 100 for _ in range(200)]
    cells += [0.0, 0.1, 1e16, 1e15, 123456789.5, 1e-4, 0.00012, 1e-5, 12345678.0, 1e300, 1.5e-300]
    assert values(spark, cells, numbers.shown_real(F.col("c")), kind="double") == [(repr(c),) for c in cells]


def test_numbers_from_text(spark):
    cells = ["5", " +5 ", "-0", "1.5", "1d", "NaN", "Infinity", "", "x", ".5", "2.", "1e3", "9" * 30]
    whole = [5, 5, 0, None, None, None, None, None, None, None, None, None, int("9" * 30)]
    assert [r[0] for r in values(spark, cells, numbers.whole_number(F.col("c")))] == whole
    real = [5, 5, 0, 1.5, None, None, None, None, None, 0.5, 2, 1000, float("9" * 30)]
    assert [r[0] for r in values(spark, cells, numbers.real_number(F.col("c")))] == real


@pytest.mark.parametrize(
    "datatype, good, bad",
    [
        ("integer", ["1", "+1", "-12", "", "  "], ["1.0", "a", "1-"]),
        ("numeric", ["1", "1.", ".5", "-1.5E+3", ""], ["1,5", "--1", " "]),
        ("boolean", ["0", "1", "true", "no"], ["True", "", "ja"]),
        ("date", ["2024-01-31", "20240131", "2024-19-39", ""], ["2024-1-1", "x", "20241"]),
        ("timestamp", ["2024-01-01 10:00:00", "20240101", "2024-01-01zz", ""], ["2024", "x"]),
    ],
)
def test_accepted_text(spark, datatype, good, bad):
    pattern = datatypes.BASE_PATTERNS[datatypes.base_type(datatype)]
    result = values(spark, good + bad, text.starts_with_match(F.col("c"), pattern))
    assert [r[0] for r in result] == [True] * len(good) + [False] * len(bad)


def test_typed_cells(spark):
    cells = ["20240131", "2024-01-31", "2024-19-39", "00000000", "", "  ", "2024-1-1", "20240131x"]
    day = values(spark, cells, datatypes.load_cell(F.col("c"), "date").cast("string"))
    assert [r[0] for r in day] == ["2024-01-31", "2024-01-31", None, None, None, None, None, None]
    times = ["20240131 10:11:12", "2024-01-31 10:11:12", "20240131", "2024-01-31", "2024-01-31zz"]
    shown = values(spark, times, datatypes.load_cell(F.col("c"), "timestamp").cast("string"))
    noon = "2024-01-31 10:11:12"
    assert [r[0] for r in shown] == [noon, noon, "2024-01-31 00:00:00", "2024-01-31 00:00:00", None]
    flags = values(spark, ["yes", "0", "True", ""], datatypes.load_cell(F.col("c"), "boolean"))
    assert [r[0] for r in flags] == [True, False, None, None]
    assert values(spark, ["", "x"], datatypes.load_cell(F.col("c"), "text")) == [("",), ("x",)]


def moved(period, steps):
    """The period arithmetic, one step at a time."""
    year, letter, number = int(period[:4]), period[5], period[6:]
    if letter == "J":
        return f"{year + steps}-J"
    limit, number = periods.PERIODS_PER_YEAR[letter], int(number)
    for _ in range(abs(steps)):
        number += 1 if steps > 0 else -1
        if number > limit:
            year, number = year + 1, 1
        if number < 1:
            year, number = year - 1, limit
    return f"{year}-{letter}{number}"


def test_period_arithmetic(spark):
    rng = random.Random(2)
    cells = [(f"{rng.randint(1990, 2030)}-{k}{rng.randint(1, n)}", rng.randint(-800, 800))
             for k, n in periods.PERIODS_PER_YEAR.items() for _ in range(40)]
    cells += [("2020-J", 5), ("2020-J", -7)]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cells)], "i int, p string, n int")
    got = [r[0] for r in rows.orderBy("i").select(periods.add(F.col("p"), F.col("n"))).collect()]
    assert got == [moved(*c) for c in cells]
    odd = [("2020-I", 3), ("2020-A2", 3), ("2020-A2", -2), ("9999-Q4", 1), ("1000-Q1", -1)]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(odd)], "i int, p string, n int")
    got = [r[0] for r in rows.orderBy("i").select(periods.add(F.col("p"), F.col("n"))).collect()]
    assert got == ["2020-I", "2020-A5", None, None, None]


def test_period_format(spark):
    cells = ["2023-J01", "2023-Q1", "2023-Q", "2023-A", "2023-I", "23-Q1", "2023-X1", "2023Q1", "2023-M12x"]
    good = [True, True, False, True, True, False, False, False, True]
    assert [r[0] for r in values(spark, cells, periods.well_formed(F.col("c")))] == good


def test_first_day_of_period(spark):
    cells = ["2024-Q3", "2024-M2", "2024-H2", "2024-J", "2024-D60", "2024-W1", "2021-W1", "2024-A1"]
    days = ["2024-07-01", "2024-02-01", "2024-07-01", "2024-01-01", "2024-02-29", "2024-01-01", "2021-01-04", None]
    assert [r[0] for r in values(spark, cells, periods.first_day(F.col("c")).cast("string"))] == days


@pytest.mark.parametrize("bracket", [1e-9, 0.001, 0.2])
def test_exact_medians(spark, monkeypatch, bracket):
    """Also where the estimates miss the middle, on skewed and repeated values."""
    monkeypatch.setattr(profile, "BRACKET", max(bracket, 0.001))
    if bracket < 0.001:
        # estimates that never enclose the middle
        first = profile.basic_moments
        monkeypatch.setattr(profile, "basic_moments", lambda *a, **k: first(*a, **k).withColumn("middle", F.array("min", "min")))
    rng = np.random.default_rng(3)
    columns = {
        "even": rng.normal(size=1000),
        "skewed": rng.pareto(0.4, 1000) * 1e3,
        "hot": np.where(rng.random(1000) < 0.4, 7.0, rng.normal(size=1000) * 1e6),
        "pair": np.array([1.0] * 500 + [2.0] * 500),
        "gap": np.concatenate([np.linspace(-1, 0, 500), np.linspace(1e9, 2e9, 500)]),
        "one": np.array([5.0] * 1000),
    }
    rows = list(zip(*[c.tolist() for c in columns.values()]))
    frame = spark.createDataFrame([*rows, (None,) * 6, (1.5, None, None, 3.0, None, None)],
                                  ", ".join(f"{c} double" for c in columns)).repartition(5)
    got = {r.column_name: r for r in profile.moments(frame, list(columns), text=False).collect()}
    for place, name in enumerate(columns):
        extra = {"even": [1.5], "pair": [3.0]}.get(name, [])
        wanted = np.concatenate([columns[name], extra])
        assert got[name].median == pytest.approx(float(np.median(wanted)), rel=1e-12), name
        assert got[name].n == len(wanted) and got[name].missing == 1002 - len(wanted)


def test_medians_of_odd_values(spark):
    nan, inf = float("nan"), float("inf")
    columns = {
        "nan": [nan, 1.0, 2.0, 3.0], "nans": [nan, nan, 1.0], "inf": [inf, -inf, 5.0], "infs": [inf, inf, 1.0, inf],
        "wide": [-1.7e308, 1.7e308, None], "one": [4.0, None, None], "none": [None], "ties": [2.0, 2.0, 2.0, 9.0],
    }
    rows = [tuple(v[k] if k < len(v) else None for v in columns.values()) for k in range(4)]
    frame = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))
    got = {r.column_name: r.median for r in profile.moments(frame, list(columns), text=False).collect()}
    want = frame.agg(*[F.median(c).alias(c) for c in columns]).first()
    for c in columns:
        assert str(got[c]) == str(want[c]), c


@pytest.mark.parametrize("ranked, pieces", [(5, 20), (40, 100)])
@pytest.mark.parametrize("missed", [None, "min", "max"])
def test_medians_by_several_cuts(spark, monkeypatch, ranked, pieces, missed):
    """No column has many more than `ranked` values ranked, wherever the estimates lie."""
    rng = np.random.default_rng(ranked)
    nan, inf = float("nan"), float("inf")
    n = 3000
    columns = {
        "even": rng.normal(size=n),
        "skewed": rng.pareto(0.3, n),
        "hot": np.where(rng.random(n) < 0.49, 7.0, rng.normal(size=n) * 1e3),
        "pair": np.array([1.0] * (n // 2) + [2.0] * (n // 2)),
        "gap": np.concatenate([np.linspace(-1, 0, n // 2), np.linspace(1e9, 2e9, n // 2)]),
        "ends": np.concatenate([[-inf] * (n // 2 - 1), [3.0], [nan] * (n // 2)]),
        "one": np.array([5.0] * n),
    }
    frame = spark.createDataFrame(list(zip(*[c.tolist() for c in columns.values()])), ", ".join(f"{c} double" for c in columns))
    frame = profile.numeric_view(frame.repartition(4), list(columns), text=False)
    want = frame.agg(*[F.median(c).alias(c) for c in columns]).first().asDict()
    ends = frame.agg(*[f(c).alias(f"{c}_{f.__name__}") for c in columns for f in (F.min, F.max)]).first()
    sizes, at_ranks = [], profile._at_ranks

    def watched(numbers_, ranks, bounds):
        for c in ranks:
            low, high = (F.lit(b).cast("double") for b in bounds[c])
            sizes.append(numbers_.where((F.col(c) >= low) & (F.col(c) <= high)).select(c).distinct().count())
        return at_ranks(numbers_, ranks, bounds)

    monkeypatch.setattr(profile, "_at_ranks", watched)
    monkeypatch.setattr(profile, "BRACKET", 1.0)
    given = {}
    for c in columns:
        low, high = ends[f"{c}_min"], ends[f"{c}_max"]
        given[c] = (n, *{None: (low, high), "min": (low, low), "max": (high, high)}[missed], low, high)
    got = profile.medians(frame, given, ranked, pieces)
    assert {c: str(v) for c, v in got.items()} == {c: str(v) for c, v in want.items()}
    assert max(sizes) <= ranked + 4


def test_moments_take_two_passes(spark):
    tracker, group = spark.sparkContext.statusTracker(), "moments"
    frame = spark.range(1000).selectExpr("cast(id as double) a", "cast(id % 7 as double) b").repartition(3)
    spark.sparkContext.setJobGroup(group, group)
    profile.moments(frame, ["a", "b"], text=False)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # adaptive execution runs a job for each shuffle of a query
    assert len(tracker.getJobIdsForGroup(group)) <= 7


def test_weeks_and_whole_bounds(spark):
    days = ["2021-01-03", "2021-01-04", "2024-12-30"]
    frame = spark.createDataFrame([(d,) for d in days], "d string").select(periods.of_date(F.to_date("d"), "W"))
    assert [r[0] for r in frame.collect()] == ["2020-W53", "2021-W1", "2025-W1"]
    with pytest.raises(ContractError):
        checks.range_check(ContractColumn("n", "integer", "", "0.4:10"))


def test_moments_without_values(spark):
    frame = spark.createDataFrame([("x",), ("",)], "c string")
    row = profile.moments(frame, ["c"], text=True).first()
    assert (row.n, row.missing, row.median) == (2, 2, None)


def test_frequencies_leave_out_unique_columns(spark):
    frame = spark.range(1000).select(
        F.col("id").cast("string").alias("unique"),
        (F.col("id") % 50).cast("string").alias("fifty"),
        (F.col("id") % 51).cast("string").alias("more"),
        F.lit("").alias("single"),
        F.when(F.col("id") < 400, "").otherwise("b").alias("two"),
    )
    rows = profile.frequencies(frame, frame.columns).collect()
    assert {r.column_name for r in rows} == {"fifty", "two"}
    assert {(r.value, r.rows, r.percent) for r in rows if r.column_name == "two"} == {("", 400, 40.0), ("b", 600, 60.0)}
