"""From raw documents to shards: language, near duplicates, benchmark leaks, mixture, shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyport.llm import decontamination, language_id, mixing, sharding
from tallyport.llm.jaccard_join import JaccardJoin
from tallyport.llm.keys import row_key, without
from tallyport.llm.tables import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; declared language and source count as evidence.

    Texts without a letter go, null and empty ones among them, and those in which no language
    reaches a probability of one half. All other rows stay, repeated ones too.
    """
    model = language_id.Model.fitted(docs, "lang", "text", "doc_id")
    found = language_id.identified_texts(docs, model, row_key(docs))
    return without(docs, row_key(docs), language_id.rejected(found).select("key")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the least id, rows without an id last.

    Texts without a word have no copies and stay. Of rows with equal id and text one stays.
    """
    keyed = docs.withColumn("__key", row_key(docs))
    classes = JaccardJoin(keyed, id_col="__key").classes()
    ids = keyed.select("doc_id", F.col("__key").alias("id"))
    rows = written(ids.join(classes.distinct(), "id"), "classes")
    first = rows.where("n_shingles > 0").groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "id")).alias("first")
    )
    kept = first.select(F.col("first.id").alias("kept"))
    gone = rows.where("n_shingles > 0").join(kept, F.col("id") == F.col("kept"), "left_anti").select("id")
    unique = without(keyed, F.col("__key"), gone)
    # rows that repeat both id and text
    repeated = written(rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("id").alias("__twice")), "twice")
    single = without(unique, F.col("__key"), repeated)
    first_row = F.row_number().over(Window.partitionBy("__key").orderBy("lang", "source", "n_chars"))
    twice = unique.join(repeated, F.col("__key") == F.col("__twice"), "left_semi").withColumn("__n", first_row).where("__n = 1")
    return single.select(*COLUMNS).unionByName(twice.select(*COLUMNS))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item, within its budget of edits."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated so that all sources are expected to weigh the same, in random order."""
    return mixing.mixed(docs).select(*COLUMNS)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies dealt to shards; equal texts are linked."""
    return sharding.sharded(docs).drop("text")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminated", decontaminated),
    ("mixture", mixture),
    ("shards", shards),
]

# Language identification and the verification of edits are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
