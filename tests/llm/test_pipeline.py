from pyspark.sql import functions as F

import corpus_pipeline
from tallyport.llm.keys import row_key, without

from .brute import jaccard_classes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_on_odd_rows(spark, tmp_path):
    """Each stage keeps what it must: nulls, repeated rows, empty texts and added columns included."""
    sf_dir = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    leak = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").first().text
    base = "the house and the garden of the old man that was with the sea and the wind on a hill for the night "
    odd = [
        (90001, None, "en", "s", 0), (90002, "", None, None, None), (90003, "12 !! 34", "de", "s", 8), (90004, base * 3 + "one", "en", "s", 9),
        (90005, base * 3 + "two", "en", "s", 9), (90005, base * 3 + "two", "en", "s", 9), (None, base * 3 + "ONE", "xx", "s", 9),
        (90006, base + leak.upper() + base, "en", "s", 5), (90007, base * 2000, "en", "s", 1),
    ]
    docs = given.select(*corpus_pipeline.COLUMNS).unionByName(spark.createDataFrame(odd, SCHEMA)).withColumn("key", F.lit(1))
    spoken = corpus_pipeline.language(spark, docs, sf_dir)
    ids = [r.doc_id for r in spoken.select("doc_id").collect()]
    assert spoken.columns == corpus_pipeline.COLUMNS
    assert sorted(i for i in ids if i is not None and i < 90000) == sorted(r.doc_id for r in given.collect())
    assert [ids.count(i) for i in (90001, 90002, 90003, 90004, 90005, None, 90006, 90007)] == [0, 0, 0, 1, 2, 1, 1, 1]
    rows = [(r.doc_id, r.text) for r in spoken.collect()]
    kept = corpus_pipeline.near_duplicates(spark, spoken, sf_dir)
    want = {least for i, _, least in jaccard_classes(rows)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    clean = corpus_pipeline.decontaminated(spark, kept, sf_dir)
    left = {r.doc_id for r in clean.collect()}
    assert left <= want and 90006 not in left and 90004 in left
    mixed = corpus_pipeline.mixture(spark, clean, sf_dir)
    assert mixed.columns == corpus_pipeline.COLUMNS and {r.doc_id for r in mixed.collect()} <= left
    out = corpus_pipeline.shards(spark, mixed, sf_dir)
    assert out.count() == mixed.count() and "text" not in out.columns


def test_rows_without_keys(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (None, None), (None, ""), (2, None), (2, None)], "doc_id long, text string")
    gone = docs.where("text = 'a' or doc_id = 2 or (doc_id is null and text is null)").select(row_key(docs))
    assert sorted(map(str, without(docs, row_key(docs), gone).collect())) == ["Row(doc_id=1, text='b')", "Row(doc_id=None, text='')"]
