"""Table reads and writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def select_from(
    table: DataFrame,
    columns: list[str | Column] | None = None,
    where: str | Column | None = None,
    group_by: list[str] | None = None,
    aggregates: list[Column] | None = None,
    limit: int = 0,
) -> DataFrame:
    """Projection, filter, grouping and limit over a table in one plan."""
    rows = table if where is None else table.where(where)
    if group_by is not None:
        rows = rows.groupBy(*group_by).agg(*(aggregates or [F.count("*").alias("count")]))
    if columns is not None:
        rows = rows.select(*columns)
    return rows.limit(limit) if limit >= 1 else rows


def full_table(
    spark: SparkSession,
    name: str,
    columns: list[str] | None = None,
    jdbc: dict | None = None,
) -> DataFrame:
    """A whole table of the catalogue, or of a remote database read in parallel.

    `jdbc` takes Spark's options; with `partitionColumn`, `lowerBound`, `upperBound` and
    `numPartitions` the read is split over the executors.
    """
    if jdbc is None:
        table = spark.table(name)
    else:
        table = spark.read.format("jdbc").options(**jdbc, dbtable=name).load()
    return table if columns is None else table.select(*columns)


def run_query(spark: SparkSession, text: str, args: dict | None = None, **tables: DataFrame) -> DataFrame:
    """A query with bound parameters; frames can be named in it as `{name}`."""
    return spark.sql(text, args=args, **tables)


def append(df: DataFrame, path: str, *partition_by: str, spread: bool = False) -> None:
    """Append to a table kept by partition.

    A delivery has one period, so each task writes one file. `spread` is for rows of many
    partitions: they are gathered by partition first, and large partitions split again.
    """
    if spread:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Overwrite a catalogue table, kept at `path` if one is given."""
    writer = df.write.mode("overwrite")
    (writer if path is None else writer.option("path", path)).saveAsTable(name)
