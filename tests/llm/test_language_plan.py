from tallyport.llm import language_id


def test_plan_grows_with_the_languages_only_in_proportion(spark):
    rows = [(1, "l0", None, "a.org", [-1.0 - k for k in range(32)]), (2, None, None, None, None)]
    lengths = {}
    for n in (8, 32):
        evidence = spark.createDataFrame([(*r[:4], r[4] and r[4][:n]) for r in rows], language_id.EVIDENCE_SCHEMA)
        found = language_id.rejected(language_id.fused(evidence, [f"l{k}" for k in range(n)]))
        lengths[n] = len(found._jdf.queryExecution().analyzed().toString())
        assert [r.key for r in found.collect()] == [2]
    assert lengths[32] < 6 * lengths[8]
