"""Comparison of two tables by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyport.contract import ContractError


def shapes(self_: DataFrame, other: DataFrame) -> DataFrame:
    """Rows and columns of both tables and whether they are equal."""
    spark = self_.sparkSession
    width = spark.createDataFrame(
        [("self", len(self_.columns)), ("other", len(other.columns))], "side string, columns int"
    )
    rows = (
        self_.agg(F.count("*").alias("rows")).withColumn("side", F.lit("self"))
        .unionByName(other.agg(F.count("*").alias("rows")).withColumn("side", F.lit("other")))
    )
    return rows.join(width, "side").select("side", "rows", "columns")


def column_differences(self_: list[str], other: list[str]) -> list[tuple[int, str | None, str | None]]:
    """Positions at which the ordered column names differ."""
    width = max(len(self_), len(other))
    pad = lambda names: list(names) + [None] * (width - len(names))
    pairs = zip(pad(self_), pad(other))
    return [(i, a, b) for i, (a, b) in enumerate(pairs) if a != b]


# Stands for the row as a whole where one side lacks a key.
ROW = "*"


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("copies")).where("copies > 1")


def cell_differences(
    self_: DataFrame, other: DataFrame, key: list[str], columns: list[str] | None = None
) -> DataFrame:
    """Differing cells as `(key, column_name, self, other)`, compared as text.

    Nulls equal nulls, in keys too. A key that one side lacks differs as a row: column_name
    is `*`, with `present` on the side that has it, and its non-null columns differ as well. The keys of
    each side must be unique (see `repeated_keys`).
    """
    columns = columns or [c for c in self_.columns if c not in key]
    text = lambda df, side: df.select(
        *[F.col(k).alias(f"{side}_key_{i}") for i, k in enumerate(key)],
        *[F.col(c).cast("string").alias(f"{side}_cell_{i}") for i, c in enumerate(columns)],
        F.lit("present").alias(f"{side}_row"),
    )
    same = [F.col(f"self_key_{i}").eqNullSafe(F.col(f"other_key_{i}")) for i in range(len(key))]
    both = text(self_, "self").join(text(other, "other"), same, "full_outer")
    named = [(ROW, "row"), *((c, f"cell_{i}") for i, c in enumerate(columns))]
    cells = [
        F.when(
            ~F.col(f"self_{c}").eqNullSafe(F.col(f"other_{c}")),
            F.struct(
                F.lit(name).alias("column_name"),
                F.col(f"self_{c}").alias("self"),
                F.col(f"other_{c}").alias("other"),
            ),
        )
        for name, c in named
    ]
    own = F.col("self_row").isNotNull()
    keys = [F.when(own, F.col(f"self_key_{i}")).otherwise(F.col(f"other_key_{i}")).alias(k) for i, k in enumerate(key)]
    return both.select(*keys, F.inline(F.array(*cells))).where("column_name is not null")


def compare_tables(self_: DataFrame, other: DataFrame, key: list[str]) -> tuple[bool, DataFrame | None]:
    """Equal or not, and the differing cells once shape and column names agree.

    Rows are told apart by their key, so a table in which a key repeats is refused.
    """
    if column_differences(self_.columns, other.columns):
        return False, None
    counts = shapes(self_, other).select("rows").distinct().count()
    if counts != 1:
        return False, None
    for side in (self_, other):
        repeated = repeated_keys(side, key).first()
        if repeated is not None:
            raise ContractError(f"key is not unique: {repeated.asDict()}")
    differing = cell_differences(self_, other, key)
    return differing.isEmpty(), differing
