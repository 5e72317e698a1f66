"""Delimited files with line breaks inside cells, read by many tasks for one file.

A line alone does not say whether it begins inside a quoted cell, but it says how it ends in
either case: it maps "inside" and "outside" to one of them. These maps are composed over the
lines of a split, then over the splits of a file (a row each), and tell where records begin. Lines are
put together within the split in which their record begins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyport.session import settle, small_side

FILE, BLOCK = "_file", "_block"
RECORD, LINE = "_record", "_line"
HEAD = "_head"
# Encodings in which a line break is one byte that is part of nothing else.
ONE_BYTE_BREAKS = ("UTF-8", "ISO-8859-1", "US-ASCII")


def can_split(sep: str, charset: str) -> bool:
    return len(sep) == 1 and charset in ONE_BYTE_BREAKS


def _ends_inside(line: Column, sep: str) -> tuple[Column, Column]:
    """Whether a line ends inside a quoted cell if it begins outside, and if it begins inside.

    A cell is quoted if a quote is its first character; doubled quotes stand for one, and what
    follows the closing quote up to the next separator belongs to the cell. The patterns never step back.
    """
    s = f"\\x{{{ord(sep):x}}}"
    quoted = r'"[^"]*+(?:""[^"]*+)*+'
    cell = f'(?:[^"{s}][^{s}]*+|{quoted}"[^{s}]*+)?+'
    left_open = f"(?:{cell}{s})*+{quoted}\\z"
    inside = f'\\A[^"]*+(?:""[^"]*+)*+(?:\\z|"[^{s}]*+{s}{left_open})'
    return line.rlike(f"\\A{left_open}"), line.rlike(inside)


def _states_before(df: DataFrame, part: list[str], order: str) -> DataFrame:
    """Adds `b0` and `b1`: the state before each row of a part that begins outside, and inside (1).

    `e0` and `e1` are the states a row leads to from outside and from inside. A row that leads to the
    same state from both settles all before it; behind it only flips count.
    """
    upto = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    flip = ((F.col("e0") == 1) & (F.col("e1") == 0)).cast("int")
    df = df.withColumn("_flips", F.sum(flip).over(upto))
    settled = F.when(F.col("e0") == F.col("e1"), F.struct(F.col("e0").alias("state"), F.col("_flips").alias("flips")))
    df = df.withColumns(
        {
            "_known": F.last(settled, ignorenulls=True).over(ahead),
            "_before": F.coalesce(F.last("_flips").over(ahead), F.lit(0)),
        }
    )
    flips = F.col("_before") - F.coalesce(F.col("_known.flips"), F.lit(0))
    state = lambda start: ((F.coalesce(F.col("_known.state"), F.lit(start)) + flips) % 2).cast("int")
    return df.withColumns({"b0": state(0), "b1": state(1)}).drop("_flips", "_known", "_before")


def _placed_lines(spark: SparkSession, path: str | list[str], sep: str, charset: str) -> DataFrame:
    """Physical lines with the split and number of the record they belong to.

    In a file that ends inside a quoted cell, the lines from the last record on are records
    of their own, so one stray quote does not make one cell of the rest of the file.
    """
    text = F.col("value") if charset == "UTF-8" else F.decode(F.col("value").cast("binary"), charset)
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias("_at"),
        F.monotonically_increasing_id().alias("_place"),
        text.alias("value"),
    )
    e0, e1 = (c.cast("int") for c in _ends_inside(F.col("value"), sep))
    lines = _states_before(lines.withColumns({"e0": e0, "e1": e1}), [FILE, "_at"], "_place")
    upto = Window.partitionBy(FILE, "_at").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    after = lambda before: F.when(F.col(before) == 0, F.col("e0")).otherwise(F.col("e1"))
    lines = lines.withColumns(
        {f"r{s}": F.sum((F.col(f"b{s}") == 0).cast("int")).over(upto) for s in (0, 1)}
        | {f"a{s}": after(f"b{s}") for s in (0, 1)}
    )
    lines = settle(lines.select(FILE, "_at", "_place", "value", "r0", "r1", "a0", "a1"))

    splits = lines.groupBy(FILE, "_at").agg(
        *[F.max_by(f"a{s}", "_place").alias(f"e{s}") for s in (0, 1)], *[F.max(f"r{s}").alias(f"r{s}") for s in (0, 1)]
    )
    splits = _states_before(splits, [FILE], "_at")
    outside = F.col("b0") == 0
    begun = F.when(outside, F.col("r0")).otherwise(F.col("r1"))
    latest = F.when(begun > 0, F.struct(F.col("_at").alias("at"), begun.alias("record")))
    ahead = Window.partitionBy(FILE).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(FILE).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    splits = splits.select(
        FILE, "_at",
        outside.alias("_outside"),
        F.last(latest, ignorenulls=True).over(ahead).alias("_owner"),
        # the record that no line closes
        F.when(F.last(after("b0")).over(whole) == 1, F.last(latest, ignorenulls=True).over(whole)).alias("_tail"),
    )
    record = F.when(F.col("_outside"), F.col("r0")).otherwise(F.col("r1"))
    own = F.struct(F.col("_at").alias("at"), record.alias("record"))
    placed = lines.join(small_side(splits), [FILE, "_at"]).withColumn(
        "_owner", F.when(record == 0, F.col("_owner")).otherwise(own)
    )
    lone = F.coalesce(F.col("_owner") == F.col("_tail"), F.lit(False))
    return placed.select(
        FILE,
        F.when(lone, F.col("_at")).otherwise(F.col("_owner.at")).alias(BLOCK),
        F.when(lone, record).otherwise(F.col("_owner.record")).alias(RECORD),
        F.when(lone, F.col("_place")).otherwise(-1).alias(LINE),
        "_at", "_place", "value",
    )


def _joined(lines: DataFrame) -> DataFrame:
    """The records that lines make; breaks inside a cell stay as they are."""
    parts = F.array_sort(F.collect_list(F.struct("_at", "_place", "value")))
    record = F.array_join(F.transform(parts, lambda p: p["value"]), "\n")
    return lines.groupBy(FILE, BLOCK, RECORD, LINE).agg(F.regexp_replace(record, "\r\\z", "").alias("value"))


class Records:
    """The records of delimited files: `heads` has the first one of each file, `body` gives all or the others."""

    def __init__(self, spark: SparkSession, path: str | list[str], sep: str, charset: str):
        self.lines = _placed_lines(spark, path, sep, charset)
        key = F.struct(BLOCK, RECORD, LINE)
        firsts = self.lines.where("value not in ('', '\r')").groupBy(FILE).agg(F.min(key).alias(HEAD))
        self.firsts = small_side(firsts)
        of_head = self.lines.join(self.firsts, FILE).where(key == F.col(HEAD))
        mark = F.regexp_replace("value", "^\ufeff", "")
        self.heads = settle(_joined(of_head).select(FILE, mark.alias("value")))

    def headers(self) -> list[str]:
        """The different headers, as text."""
        return sorted(r.value for r in self.heads.select("value").distinct().collect())

    def body(self, header: str | None = None) -> DataFrame:
        """(`_file`, `_block`, `value`) in the order of the files: all records, or those below a header without it."""
        lines, key = self.lines, F.struct(BLOCK, RECORD, LINE)
        if header is not None:
            under = self.heads.where(F.col("value") == header).select(FILE)
            lines = lines.join(self.firsts, FILE).where(key != F.col(HEAD)).drop(HEAD).join(small_side(under), FILE)
        # by split, so that rows are numbered in the order of the file
        dealt = _joined(lines.repartition(F.col(FILE), F.col(BLOCK))).where("value <> ''")
        ordered = dealt.sortWithinPartitions(FILE, BLOCK, RECORD, LINE)
        first = (F.col(BLOCK) == 0) & (F.col(RECORD) == 1)
        return ordered.select(FILE, BLOCK, F.when(first, F.regexp_replace("value", "^\ufeff", "")).otherwise(F.col("value")).alias("value"))
