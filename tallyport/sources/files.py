"""Deliveries found in folders: one listing job, names parsed as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyport.sources.delimited import PLACE, text_frame

# Fixed value: start of the history that a full extract covers.
FULL_EXTRACT_FROM = "20130101"


def listing(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Paths below `root`; only names are read, file contents are pruned away."""
    return (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup=True, pathGlobFilter=glob)
        .load(root)
        .select("path")
    )


def folder_and_name(path: Column, root: str) -> tuple[Column, Column]:
    """First two levels below the root: the period folder and the delivered object.

    An object is a file or, when Spark wrote it, a folder of part files.
    """
    below = F.element_at(F.split(path, root.rstrip("/") + "/", 2), 2)
    levels = F.split(below, "/")
    plain = lambda part: F.regexp_replace(part, "^[a-z_]+=", "")
    return plain(F.get(levels, F.lit(0))), plain(F.get(levels, F.lit(1)))


def discover(
    spark: SparkSession, root: str, data_pattern: str, header_pattern: str
) -> DataFrame:
    """Delivered data and header files per period: kind, date, source code, project.

    Data names look like `<date>_<source>_<project>`, header names like
    `<date>_<source>_<kind>_<project>`; the last part may hold more underscores.
    """
    paths = listing(spark, root)
    period, name = folder_and_name(F.col("path"), root)
    found = paths.select(period.alias("period"), name.alias("name")).distinct()
    stem = F.regexp_replace("name", r"\.[^.]*$", "")
    is_data = stem.rlike(f"^(?:{data_pattern})")
    is_header = stem.rlike(f"^(?:{header_pattern})")
    parts = 3
    data_parts, header_parts = F.split(stem, "_", parts), F.split(stem, "_", parts + 1)
    project = F.when(is_data, F.get(data_parts, F.lit(2))).otherwise(
        F.get(header_parts, F.lit(3))
    )
    return (
        found.withColumn("kind", F.when(is_data, "data").when(is_header, "header"))
        .where("kind is not null")
        .select(
            "period",
            "name",
            "kind",
            F.trim(F.get(data_parts, F.lit(0))).alias("delivered_on"),
            F.upper(F.trim(F.get(data_parts, F.lit(1)))).alias("source_code"),
            F.lower(F.trim(F.regexp_replace(project, "_", ""))).alias("project"),
        )
    )


def delivery_range(name: Column) -> tuple[Column, Column]:
    """From and to of a stored extract: `full_<to>` or `<word>_<from>-<to>`."""
    full = F.split(name, "_")[0] == "full"
    second = F.get(F.split(name, "_"), F.lit(1))
    bounds = F.split(second, "-")
    until = F.get(bounds, F.lit(1))
    stem = F.regexp_replace(until, r"\.[^.]*$", "")
    start = F.when(full, F.lit(FULL_EXTRACT_FROM)).otherwise(F.get(bounds, F.lit(0)))
    return start, F.when(full, second).otherwise(stem)


def ordered_changes(
    spark: SparkSession, root: str, prefix: str, names: list[str], sep: str = ","
) -> DataFrame:
    """All rows of the change files below `root` whose name starts with `prefix`.

    One scan of all files. `file_name` sorts in the order of application; `_file`,
    `_block` and `_place` give the order of the rows inside a file.
    """
    rows = text_frame(spark, f"{root}/{prefix}*", names, sep, header=False, traced=True)
    name = F.regexp_extract("_file", f"/({prefix}[^/]*)(?:/[^/]*)?$", 1)
    return rows.withColumns(
        {
            "file_name": F.regexp_replace(name, r"\.csv$", ""),
            PLACE: F.monotonically_increasing_id(),
        }
    )


# A change file, or a folder of part files, carries the two dates of its window in its name.
CHANGE_PATH = r"^(.*/(?:[a-z_]+=)?([^/]*_\d{8}-\d{8})(?:\.csv)?)(?:/[^/]*)?$"


def window_name(name: Column) -> Column:
    """A change's name, null if it holds no two dates."""
    last = F.regexp_extract(name, r"\d{8}-(\d{8})[^_]*$", 1)
    return F.when(F.try_to_date(last, "yyyyMMdd").isNotNull(), name)


def change_files(spark: SparkSession, folder: str) -> DataFrame:
    """The change files in a folder as (name, path), in the order in which they are applied; files without a window have no name."""
    listed = (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup=True, pathGlobFilter="*.csv")
        .load(folder)
        .select("path")
    )
    name, path = (F.regexp_extract("path", CHANGE_PATH, k) for k in (2, 1))
    found = listed.select(window_name(name).alias("name"), path.alias("found"), "path")
    return found.select("name", F.when(F.col("name").isNull(), F.col("path")).otherwise(F.col("found")).alias("path")).distinct().orderBy("name", "path")
