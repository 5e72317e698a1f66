"""Profile of a delivery next to the table it will be added to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyport.contract import Contract
from tallyport.functions.numbers import real_number

MAX_CATEGORIES = 50
# Buckets for each value that a column may have at most.
BUCKETS = 20
# The middle of a column is looked for between estimates this share of its ranks away.
BRACKET = 0.001
# Values of a column that one task may rank, and pieces into which more of them are cut.
RANKED, PIECES = 1_000_000, 1000
MOMENTS = ["n", "missing", "min", "max", "mean", "median", "std"]


def numeric_view(df: DataFrame, columns: list[str], text: bool) -> DataFrame:
    """The columns as doubles; text that is no number becomes null."""
    number = lambda c: real_number(F.col(c)) if text else F.col(c).cast("double")
    return df.select(*[number(c).alias(c) for c in columns])


def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    """`(column_name, value)` for the non-null cells of the columns."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns]
    )
    return df.select(F.inline(cells)).where("value is not null")


def basic_moments(numbers_: DataFrame, columns: list[str], count_missing: bool) -> DataFrame:
    """One row per column from one aggregate: n, missing, min, max, mean, std, and what encloses the middle.

    `count_missing` makes n the number of all rows instead of the non-null ones.
    """
    per_column = []
    for c in columns:
        value = F.col(c)
        rows = F.count("*") if count_missing else F.count(value)
        per_column.append(
            F.struct(
                F.lit(c).alias("column_name"),
                rows.alias("n"),
                F.count_if(value.isNull()).alias("missing"),
                F.min(value).alias("min"),
                F.max(value).alias("max"),
                F.avg(value).alias("mean"),
                F.stddev_samp(value).alias("std"),
                F.percentile_approx(value, [0.5 - BRACKET, 0.5 + BRACKET], int(2 / BRACKET)).alias("middle"),
            )
        )
    return numbers_.agg(F.array(*per_column).alias("_all")).select(F.inline("_all"))


def medians(
    numbers_: DataFrame, moments: dict[str, tuple], ranked: int = RANKED, pieces: int = PIECES
) -> dict[str, float | None]:
    """Exact medians of many columns; no task ranks more than about `ranked` values of one.

    `moments` gives `(non-null count, low, high, min, max)` per column, low and high being
    estimates that should enclose the middle. One aggregate counts the cells below and, by value, those
    in between; a running total finds the middle ranks and proves that they lie there. Where
    more than `ranked` cells may lie in between, they are first cut at their own quantiles, and the
    few pieces around the middle are the new bounds, again and again. Where the middle
    lies elsewhere, counts tell on which side, and that is cut. There is no arithmetic
    on values, so infinite ones and NaN (the largest) stand where Spark orders them.
    """
    result: dict[str, float | None] = {c: None for c in moments}
    bounds = {c: (low, high) for c, (n, low, high, *_) in moments.items() if n}
    ranks = {c: ((n + 1) // 2, n // 2 + 1) for c, (n, *_) in moments.items() if n}
    # the estimates are within half a bracket
    between = {c: int(4 * BRACKET * moments[c][0]) for c in ranks}
    while ranks:
        narrow = {c: r for c, r in ranks.items() if between[c] <= ranked}
        wide = {c: bounds[c] for c in ranks if c not in narrow}
        found: dict[str, dict[int, float]] = {c: {} for c in narrow}
        for r in _at_ranks(numbers_, narrow, bounds).collect() if narrow else []:
            found[r.column_name].update({k: r.value for k in narrow[r.column_name] if r.before < k <= r.upto})
        for column, (low, high) in narrow.items():
            values = found[column]
            if low in values and high in values:
                a, b = values[low], values[high]
                result[column] = a if a == b else 0.5 * a + 0.5 * b
                del ranks[column]
            else:
                # counted next, which says on which side the middle is
                between[column] = ranked + 1
        for r in _cut(numbers_, wide, pieces).collect() if wide else []:
            bounds[r.column_name], between[r.column_name] = _around_middle(
                r, ranks[r.column_name], moments[r.column_name], bounds[r.column_name], pieces
            )
    return result


def _cut(numbers_: DataFrame, bounds: dict, pieces: int) -> DataFrame:
    """Per column the cells below the bounds, on each and strictly inside, and cuts of those inside."""
    per_column = []
    for column, ends in bounds.items():
        value = F.col(column)
        low, high = (F.lit(b).cast("double") for b in ends)
        inside = (value > low) & (value < high)
        cuts = F.percentile_approx(F.when(inside, value), [k / pieces for k in range(pieces + 1)], 10 * pieces)
        per_column.append(
            F.struct(
                F.lit(column).alias("column_name"), F.count_if(value < low).alias("below"),
                F.count_if(value == low).alias("at_low"), F.count_if(inside).alias("inside"),
                F.count_if((value == high) & (value != low)).alias("at_high"), cuts.alias("cuts"),
            )
        )
    return numbers_.agg(F.array(*per_column).alias("_all")).select(F.inline("_all"))


def _around_middle(cut, ranks: tuple[int, int], moments: tuple, bounds: tuple, pieces: int) -> tuple[tuple, int]:
    """Closer bounds of the middle ranks, and how many cells may lie between them.

    A quantile may be a tenth of a piece off, so two pieces are added on both sides.
    """
    (low, high), (first, last) = bounds, ranks
    n, _, _, smallest, largest = moments
    start = cut.below + cut.at_low
    end = start + cut.inside
    if first <= cut.below:
        return (smallest, low), cut.below
    if last > end + cut.at_high:
        return (high, largest), n - end - cut.at_high
    if last <= start:
        return (low, low), 0
    if first > end:
        return (high, high), 0
    if not cut.inside:
        return (low, high), 0
    i = (first - start - 1) * pieces // cut.inside - 2
    j = -((start - last) * pieces // cut.inside) + 2
    closer = (low if i < 0 else cut.cuts[i], high if j > pieces else cut.cuts[j])
    return closer, (min(j, pieces) - max(i, 0) + 1) * cut.inside // pieces


def _at_ranks(numbers_: DataFrame, ranks: dict, bounds: dict) -> DataFrame:
    """Per column the counted values that hold one of its two ranks."""
    cells = []
    for column in ranks:
        value = F.col(column)
        low, high = (F.lit(b).cast("double") for b in bounds[column])
        below, inside = value < low, (value >= low) & (value <= high)
        cell = F.struct(F.lit(column).alias("column_name"), F.when(~below, value).alias("value"))
        cells.append(F.when(below | inside, cell))
    counted = (
        numbers_.select(F.inline(F.array(*cells)))
        .where("column_name is not null")
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("rows"))
    )
    # the cells below are one row without a value, which comes first
    running = Window.partitionBy("column_name").orderBy("value")
    wanted = F.create_map(*[F.lit(x) for c, (a, b) in ranks.items() for x in (c, a)])
    also = F.create_map(*[F.lit(x) for c, (a, b) in ranks.items() for x in (c, b)])
    placed = counted.withColumn("upto", F.sum("rows").over(running)).withColumn("before", F.col("upto") - F.col("rows"))
    holds = lambda rank: (F.col("upto") >= rank) & (F.col("before") < rank)
    name = F.col("column_name")
    return placed.where((holds(wanted[name]) | holds(also[name])) & F.col("value").isNotNull())


def moments(df: DataFrame, columns: list[str], text: bool) -> DataFrame:
    """n, missing, min, max, mean, exact median and sample deviation per numeric column.

    For a delivery (`text`) n counts all rows and unusable text is missing; for a table
    n counts the non-null values.
    """
    view = numeric_view(df, columns, text)
    rows = basic_moments(view, columns, count_missing=text).collect()
    filled = {
        r.column_name: (r.n - r.missing if text else r.n, *(r.middle or (r.min, r.max)), r.min, r.max) for r in rows
    }
    middle = medians(view, filled)
    schema = (
        "column_name string, n long, missing long, min double, max double, "
        "mean double, median double, std double"
    )
    data = [
        (r.column_name, r.n, r.missing, r.min, r.max, r.mean, middle[r.column_name], r.std)
        for r in rows
    ]
    return df.sparkSession.createDataFrame(data, schema)


def two_decimals(value: Column) -> Column:
    return F.call_function("format_number", value, F.lit("0.00"))


def compare_moments(delivery: DataFrame, table: DataFrame) -> DataFrame:
    """`(column_name, statistic, delivery, database)`; `n.a.` for an empty table."""
    def long(df: DataFrame, value: str) -> DataFrame:
        # `n` and `missing` are counts, the rest is shown with two decimals
        shown = [
            F.struct(
                F.lit(m).alias("statistic"),
                (
                    F.col(m).cast("string")
                    if m in ("n", "missing")
                    else two_decimals(F.col(m))
                ).alias(value),
            )
            for m in MOMENTS
        ]
        return df.select("column_name", F.inline(F.array(*shown)))

    database = table.withColumn("_rows", F.col("n") + F.col("missing"))
    both = long(delivery, "delivery").join(
        long(database.where("_rows > 0"), "database"), ["column_name", "statistic"], "left"
    )
    return both.select(
        "column_name", "statistic", "delivery",
        F.coalesce("database", F.lit("n.a.")).alias("database"),
    )


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per column and value of text columns, all columns in one pass."""
    return (
        _long(df.select(*[F.col(c).cast("string").alias(c) for c in columns]), columns)
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("rows"))
    )


def categorical(df: DataFrame, columns: list[str], limit: int = MAX_CATEGORIES) -> list[str]:
    """Columns that may have at most `limit` different values.

    Values are dealt to buckets by a hash. A column that fills more than `limit` buckets has
    more than `limit` values for certain; all others are counted exactly afterwards. The set of
    buckets of a column is bounded, so near-unique columns cost no more than others.
    """
    if not columns:
        return []
    bucket = lambda c: F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(BUCKETS * limit))
    buckets = lambda c: F.when(F.col(c).isNotNull(), bucket(c))
    filled = df.agg(*[F.size(F.collect_set(buckets(c))).alias(c) for c in columns]).first().asDict()
    return [c for c in columns if filled[c] <= limit]


def frequencies(df: DataFrame, columns: list[str], limit: int = MAX_CATEGORIES) -> DataFrame:
    """Share of each value in columns with 2 to `limit` categories, in percent.

    Columns with far more values are left out first, so their values are never shuffled.
    An empty cell is a category.
    """
    return exact_frequencies(df, categorical(df, columns, limit), limit)


def exact_frequencies(df: DataFrame, columns: list[str], limit: int) -> DataFrame:
    if not columns:
        schema = "column_name string, value string, rows long, percent double"
        return df.sparkSession.createDataFrame([], schema)
    per_column = Window.partitionBy("column_name")
    return (
        value_counts(df, columns)
        .withColumn("_categories", F.count("*").over(per_column))
        .where(F.col("_categories").between(2, limit))
        .withColumn("percent", 100 * F.col("rows") / F.sum("rows").over(per_column))
        .select("column_name", "value", "rows", "percent")
    )


def table_shares(table: DataFrame, column: str) -> DataFrame:
    """Share of all rows, nulls included, per non-null value of a table column."""
    total = table.select(F.count("*").alias("total")).scalar()
    return (
        table.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count("*").alias("rows"))
        .select("value", "rows", (100 * F.col("rows") / total).alias("percent"))
    )


def all_table_shares(table: DataFrame, columns: list[str]) -> DataFrame:
    """Shares for several columns, from one pass over the table."""
    total = table.select(F.count("*").alias("total")).scalar()
    return value_counts(table, columns).select(
        "column_name", "value", "rows", (100 * F.col("rows") / total).alias("percent")
    )


def compare_frequencies(
    delivery: DataFrame, database: DataFrame, date_columns: list[str]
) -> DataFrame:
    """Delivery share next to database share per category.

    Dates of the database are compared without dashes, as deliveries may write yyyymmdd.
    A category the delivery lacks is `Missing`/`n.a.`, one the database lacks `Missing`.
    """
    category = F.when(
        F.col("column_name").isin(date_columns), F.regexp_replace("value", "-", "")
    ).otherwise(F.col("value"))
    here = delivery.select(
        "column_name", F.col("value").alias("category"),
        F.col("rows").cast("string").alias("absolute"), two_decimals(F.col("percent")).alias("delivery_percent"),
    )
    there = database.select(
        "column_name", category.alias("category"), two_decimals(F.col("percent")).alias("database_percent")
    )
    return here.join(there, ["column_name", "category"], "full_outer").select(
        "column_name",
        "category",
        F.coalesce("absolute", F.lit("Missing")).alias("absolute"),
        F.coalesce("delivery_percent", F.lit("n.a.")).alias("delivery_percent"),
        F.coalesce("database_percent", F.lit("Missing")).alias("database_percent"),
    )


def count_by_period(table: DataFrame) -> DataFrame:
    return table.groupBy("period").agg(F.count("period").alias("count"))


def profile_columns(contract: Contract, columns: list[str] | None = None) -> tuple[list[str], list[str]]:
    """Numeric columns and columns with frequencies (all but real types)."""
    chosen = contract.names if columns in (None, ["*"]) else columns
    numeric = [c for c in chosen if contract[c].base in ("integer", "real")]
    return numeric, [c for c in chosen if contract[c].base != "real"]


def profile_delivery(
    delivery: DataFrame,
    table: DataFrame,
    contract: Contract,
    columns: list[str] | None = None,
    max_categories: int = MAX_CATEGORIES,
) -> dict[str, DataFrame]:
    """Periods in the table, and moments and frequencies of delivery and table."""
    numeric, counted = profile_columns(contract, columns)
    few = categorical(delivery, counted, max_categories)
    shares = exact_frequencies(delivery, few, max_categories)
    dates = contract.of_base("date")
    return {
        "periods": count_by_period(table),
        "moments": compare_moments(
            moments(delivery, numeric, text=True), moments(table, numeric, text=False)
        ),
        "frequencies": compare_frequencies(shares, all_table_shares(table, few), dates)
        .join(shares.select("column_name").distinct(), "column_name", "left_semi"),
    }
