"""Apply change files to a stored history as they arrive; a replayed batch changes nothing, and nothing is lost."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tallyport.functions.periods import change_window
from tallyport.operators.history import ACTION, POSITION
from tallyport.operators.stored import StoredHistory
from tallyport.session import scratch
from tallyport.sources.delimited import NO_NULL, RAGGED
from tallyport.sources.files import CHANGE_PATH, window_name

# Why a landed row is not applied, besides the verdicts of the history.
NO_WINDOW, CELL_COUNT, BAD_CELL, NO_KEY = (
    "no change window in the name", "number of cells", "cell is not of its type", "no key",
)
QUARANTINE = "file string, action string, raw string, columns string, reason string, change string"


def landed_changes(
    spark: SparkSession, folder: str, data: T.StructType, sep: str = ","
) -> DataFrame:
    """Landed change rows as text: instruction, data columns, raw line of ragged rows, change name, file and split."""
    names = [ACTION, *data.names]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, RAGGED]])
    path = F.col("_metadata.file_path")
    return (
        spark.readStream.schema(schema)
        .options(sep=sep, quote='"', escape='"', nullValue=NO_NULL, emptyValue="", mode="PERMISSIVE",
                 recursiveFileLookup=True, pathGlobFilter="*.csv", columnNameOfCorruptRecord=RAGGED)
        # a parser that skips columns does not count the cells
        .option("columnPruning", False)
        .csv(folder)
        .select(
            *[F.coalesce(F.col(n), F.lit("")).alias(n) for n in names],
            RAGGED,
            # the change is the file, or the folder of part files, right below the landing folder
            window_name(F.regexp_extract(path, CHANGE_PATH, 2)).alias("change"),
            path.alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
        )
    )


def judged_cells(landed: DataFrame, data: T.StructType, key: list[str]) -> DataFrame:
    """Typed rows with the columns whose cells do not load, and the reason why a row is not applied (null: it is).

    A blank cell of a column that is no text is null. Text cells stay as they are.
    """
    is_text = {f.name: isinstance(f.dataType, T.StringType) for f in data}
    value = lambda f: F.col(f.name) if is_text[f.name] else F.trim(f.name).try_cast(f.dataType)
    bad = [F.when((F.trim(f.name) != "") & value(f).isNull(), f.name) for f in data if not is_text[f.name]]
    none = [value(data[k]).isNull() | (F.trim(k) == "") for k in key]
    any_none = none[0]
    for other in none[1:]:
        any_none = any_none | other
    columns = F.array_compact(F.array(*bad)) if bad else F.expr("cast(array() as array<string>)")
    reason = (
        F.when(F.col("change").isNull(), NO_WINDOW)
        .when(F.col(RAGGED).isNotNull(), CELL_COUNT)
        .when(F.size(columns) > 0, BAD_CELL)
        .when(any_none, NO_KEY)
    )
    raw = F.coalesce(RAGGED, F.to_csv(F.struct(ACTION, *data.names), {"quote": '"', "escape": '"'}))
    return landed.select(
        ACTION, *[value(f).alias(f.name) for f in data], "change", "_file", POSITION,
        raw.alias("_raw"), F.array_join(columns, ",").alias("_columns"), reason.alias("_reason"),
    )


def quarantined(rows: DataFrame, reason: Column, change: Column) -> DataFrame:
    return rows.select(
        F.col("_file").alias("file"), F.col(ACTION).alias("action"), F.col("_raw").alias("raw"),
        F.col("_columns").alias("columns"), reason.alias("reason"), change.alias("change"),
    )


def quarantine(store: StoredHistory) -> DataFrame:
    """What streams did not apply: rows (file, action, raw, columns, reason, change)."""
    try:
        return store.spark.read.schema(QUARANTINE).parquet(f"{store.root}/quarantine")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return store.spark.createDataFrame([], QUARANTINE)


def apply_landing(
    store: StoredHistory, folder: str, data: T.StructType, key: list[str], progress: str
) -> StreamingQuery:
    """Apply landed change files, each as one version of the history, in name order.

    Changes that land together are applied one after the other, so the checks of a file
    see the state that the file before it left. A change file must land complete. A file that
    was applied before, by a stream or by a delivery, is passed over, also with lost progress.

    No row is lost: one with too many or too few cells, with a cell that is not of its column's type or without a key is
    not applied, and neither is one that the history refuses; they go to `quarantine` with their raw line, under
    the change's name and before the change becomes visible. All rows of a file without a change window in its
    name go there under the file's name. A replay replaces what it wrote before.
    """

    def kept(rows: DataFrame) -> None:
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("change").parquet(f"{store.root}/quarantine")

    def apply(batch: DataFrame, batch_id: int) -> None:
        # the order of the rows of a change: file, split, place in the split; written once, so
        # that every use sees the same places
        place = F.struct("_file", "_block", F.monotonically_increasing_id().alias("_place"))
        path = scratch(store.spark, "landed")
        judged_cells(batch.withColumn(POSITION, place), data, key).write.parquet(path)
        landed = store.spark.read.parquet(path)
        # a row for each change file
        files = landed.groupBy("change").agg(F.count("_reason").alias("bad")).collect()
        if any(f.change is None for f in files):
            unnamed = landed.where("change is null")
            kept(quarantined(unnamed, F.col("_reason"), F.regexp_extract("_file", r"([^/]*)$", 1)))
        for name in sorted(f.change for f in files if f.change is not None):
            if store.has(name):
                continue
            start, end = change_window(F.lit(name))
            rows = landed.where(F.col("change") == name)
            bad = quarantined(rows.where("_reason is not null"), F.col("_reason"), F.lit(name))

            def before(refused: DataFrame, bad: DataFrame = bad, name: str = name) -> None:
                kept(bad.unionByName(quarantined(refused, F.col("reason"), F.lit(name))))

            store.apply(name, rows.where("_reason is null").drop("_reason", "change"), start, end, before=before)

    return (
        landed_changes(store.spark, folder, data)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
