"""Repeated rows, repetitive texts and very large numbers."""

import time

import pytest
from pyspark.sql import functions as F

from tallyport.llm import decontamination, mixing, topk_search


def plain_best(rows, queries, k):
    out = {}
    for i, q in queries:
        found = []
        for j, v in rows:
            if j != i and len(v) == len(q):
                score = sum(int(a) * int(b) for a, b in zip(q, v, strict=True))
                found.append((-min(max(score, -(2**63)), 2**63 - 1), j))
        out[i] = sorted(found)[:k]
    return sorted((i, n, j, -s) for i, best in out.items() for n, (s, j) in enumerate(best, 1))


@pytest.mark.parametrize("large", [1.0, 1e9, 1e152, 1e300])
def test_search_of_large_components(spark, large):
    rows = [(k, [float((k * 7919 + d * 104729) % 97 - 48) * (large if (k + d) % 3 else 1.0) for d in range(8)]) for k in range(60)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk_search.top_k(table, table.where("vec_id % 10 = 0"), 5, scale=1)
    assert sorted(map(tuple, got.collect())) == plain_best(rows, [r for r in rows if r[0] % 10 == 0], 5)


def test_search_takes_the_usable_one_of_repeated_queries(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(0, [None, 1.0]), (0, [-inf, 1.0]), (0, [nan, 0.0]), (0, None), (0, [2.0, 3.0]), (1, [1.0, 1.0]), (2, [1e308, 1.0])]
    table = spark.createDataFrame(odd, "vec_id long, embedding array<double>")
    got = topk_search.top_k(table, table.where("vec_id = 0"), 5, scale=256)
    assert [tuple(r)[:3] for r in got.orderBy("rank").collect()] == [(0, 1, 2), (0, 2, 1)]


def test_repeated_benchmark_rows_and_repetitive_texts(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 5000)
    item = "ab " * 29 + "ab"
    benchmark = spark.range(3000).select(F.lit(7).cast("long").alias("item_id"), F.lit(item).alias("text"))
    changed = ("ab " * 20 + "xb ") * 15000
    docs = spark.createDataFrame([(1, "ab " * 340000), (2, changed), (3, "other words")], "doc_id long, text string")
    begun = time.perf_counter()
    found = {(r.doc_id, r.item_id, r.edits) for r in decontamination.leaks(docs, benchmark).collect()}
    assert found == {(1, 7, 0), (2, 7, 1)}
    assert [r.doc_id for r in decontamination.clean(docs, benchmark).collect()] == [3]
    assert time.perf_counter() - begun < 60


def test_documents_move_once(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), (F.col("id") % 3).cast("string").alias("source"))
    plan = mixing.mixed(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") - plan.count("BroadcastExchange") == 1 and "SortMergeJoin" not in plan
