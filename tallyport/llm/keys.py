"""Taking rows out of a wide table by a key, without moving the rows that stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyport.llm.bloom import BlockedBloom
from tallyport.llm.tables import written


def row_key(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A hash of id and text; nulls count."""
    text = F.col(text_col).cast("string")
    return F.xxhash64(F.col(id_col), F.xxhash64(text), text.isNull())


def without(docs: DataFrame, key: Column, gone: DataFrame) -> DataFrame:
    """Rows of `docs` whose key is not in `gone` (one column of long).

    Only rows that pass a Bloom filter over `gone` are shuffled and joined; all others go on
    as they are.
    """
    gone = written(gone.select(F.col(gone.columns[0]).alias("__gone")).distinct(), "gone")
    marked = BlockedBloom(gone, F.col("__gone")).marked(docs.withColumn("__probe", key), F.col("__probe"), "__likely")
    checked = marked.where("__likely").join(gone, F.col("__probe") == F.col("__gone"), "left_anti")
    return marked.where("not __likely").unionByName(checked).drop("__probe", "__likely")
