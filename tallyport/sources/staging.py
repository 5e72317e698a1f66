"""Staged deliveries: written once as Parquet, numbered from their place in the files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyport.session import scratch, small_side
from tallyport.sources.delimited import PLACE, SPLIT

TRACE = [*SPLIT, PLACE]


def stage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write a cleaned delivery and return the scan of what was written.

    Rows that carry their split also get their order in it, counted here so that rows
    dropped by the cleaning leave no gaps.
    """
    spark = df.sparkSession
    if SPLIT[0] in df.columns:
        df = df.withColumn(PLACE, F.monotonically_increasing_id())
    path = path or scratch(spark, "staged")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def traced_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet rows with their file and their index in it."""
    rows = spark.read.parquet(path)
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias(SPLIT[0]),
        F.lit(0).cast("long").alias(SPLIT[1]),
        F.col("_metadata.row_index").alias(PLACE),
    )


def number_rows(df: DataFrame, name: str = "record_no", start: int = 1) -> DataFrame:
    """Dense numbers in file order, without sorting or shuffling the rows.

    `df` carries the trace columns and must be a scan or written rows. The first pass
    counts per split; the running total runs over one row per split only. The second
    pass adds the offset of its split to each row's place in it.
    """
    splits = df.groupBy(*SPLIT).agg(
        F.count("*").alias("_rows"), F.min(PLACE).alias("_first")
    )
    before = Window.orderBy(*SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(
        *SPLIT,
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_offset"),
    )
    number = (F.col("_offset") + F.col(PLACE) + start).cast("long")
    return (
        df.join(small_side(offsets), SPLIT)
        .withColumn(name, number)
        .drop(*TRACE, "_offset")
    )
