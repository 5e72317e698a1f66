"""Helpers the operators share: input tables, written intermediate tables, numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyport.session import scratch


# Rows of an Arrow batch: texts are long, and Spark's own 10,000 rows of them fill a small executor.
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 500


def small_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches for this session, unless it has a size of its own."""
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written once as Parquet to the shared folder and read again.

    Cuts the lineage: the rows survive lost executors and are computed once.
    """
    small_batches(df.sparkSession)
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def flagged(flags: DataFrame) -> bool:
    """Whether a frame has any row."""
    return not flags.isEmpty()


def numbered(df: DataFrame, key: Column, group: Column | None, out: str, cells: int = 1024) -> DataFrame:
    """Adds `out`: gapless long numbers from 0 within each value of `group`, in no set order.

    Rows are dealt to `cells` cells by a hash of `key`; numbers are a running total of the
    cells' counts plus the place within the cell, so no group is ordered in one task. The
    table of counts has at most `cells` rows for each group.
    """
    group = F.lit(0) if group is None else group
    placed = df.withColumns({"__group": group, "__cell": F.pmod(F.xxhash64(key), F.lit(cells)).cast("int"), "__numbered": key})
    counts = placed.groupBy("__group", "__cell").agg(F.count("*").alias("__n"))
    before = counts.select(
        F.col("__group").alias("__g"),
        F.col("__cell").alias("__c"),
        (F.sum("__n").over(Window.partitionBy("__group").orderBy("__cell")) - F.col("__n")).alias("__before"),
    )
    place = F.row_number().over(Window.partitionBy("__group", "__cell").orderBy("__numbered"))
    ranked = placed.withColumn("__place", place)
    return (
        ranked.join(before, F.col("__group").eqNullSafe(F.col("__g")) & (F.col("__cell") == F.col("__c")))
        .withColumn(out, F.col("__before") + F.col("__place") - 1)
        .drop("__group", "__cell", "__numbered", "__place", "__g", "__c", "__before")
    )
