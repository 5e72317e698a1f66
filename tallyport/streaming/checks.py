"""Check deliveries as their files land: cleaning and checks are row-local, no state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyport.contract import Contract
from tallyport.operators.checks import LOADS, WRONG_FORM, failures, ragged_rows
from tallyport.operators.cleaning import CleaningRules, clean
from tallyport.sources.delimited import RAGGED, SPLIT, read_delivery, sorted_headers


def landed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of the delimited files that land in a folder; what is in them is not read here."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    return files.options(recursiveFileLookup=True, pathGlobFilter="*.csv").load(folder).select("path")


def refused_files(spark: SparkSession, files: list[tuple[str, str]]) -> DataFrame:
    """A failure for each file that cannot be read under the contract."""
    return spark.createDataFrame(files, "file string, message string").select(
        F.lit(None).cast("string").alias("row"),
        "file",
        F.lit(LOADS).alias("phase"),
        F.lit(0).alias("column"),
        F.lit("").alias("column_name"),
        F.lit(WRONG_FORM).alias("error_code"),
        "message",
        F.lit(0).alias("element"),
    )


def check_landing(
    spark: SparkSession,
    folder: str,
    out: str,
    contract: Contract,
    rules: CleaningRules,
    row: str,
    sep: str = ";",
) -> StreamingQuery:
    """Failed cells of every landed file, each file once, below `out`/failures.

    `row` is the column that identifies a row of the delivery. Every file is read under its own
    header; one whose header the contract does not accept, or that has blank lines only, becomes one failure (code 7, no row), and the
    others are checked. A batch's failures replace those of the same batch, so a restarted query neither
    loses nor repeats any.
    """

    def check(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(r.path for r in batch.collect())  # a row for each landed file
        if not paths:
            return
        headers, refused = sorted_headers(spark, paths, contract, sep)
        found = refused_files(spark, refused)
        if headers:
            rows = read_delivery(spark, paths, contract, sep=sep, traced=True, ragged=True, headers=headers)
            cleaned = clean(rows, contract, rules).drop(SPLIT[1])
            numbered = cleaned.withColumnRenamed(SPLIT[0], "file").withColumn("row", F.col(row))
            failed = failures(numbered, contract, carry=("file",))
            found = failed.unionByName(ragged_rows(numbered, RAGGED, carry=("file",))).unionByName(found)
        found.write.mode("overwrite").parquet(f"{out}/failures/batch={batch_id}")

    return (
        landed_files(spark, folder)
        .writeStream.foreachBatch(check)
        .option("checkpointLocation", f"{out}/progress")
        .trigger(availableNow=True)
        .start()
    )
