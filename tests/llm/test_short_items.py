from tallyport.llm import decontamination


def test_short_items_and_items_without_an_id(spark):
    """Short items are found exactly and as whole words; items without an id count as well."""
    long = "What is the name of the river that runs through the town of Ulm?"
    items = [(1, "Who am I?"), (2, "cat"), (None, "short one"), (None, long), (3, "  "), (4, "öl"), (5, None), (6, "2+2")]
    rows = [
        (1, "x who  AM\ni? y"), (2, "concat cats"), (3, "a cat."), (4, "Short one!"), (5, "See: " + long.replace("river", "rivre")),
        (6, "Möl"), (7, "Möl öl-x"), (8, "who am I"), (9, "cats, cat"), (10, None), (11, "cat"), (12, "12+2 2+21"), (13, "=2+2="),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.edits, r.end_at) for r in decontamination.leaks(docs, bench).collect()}
    want = {(1, 1, 0, 11), (3, 2, 0, 5), (4, None, 0, 9), (7, 4, 0, 8), (9, 2, 0, 9), (11, 2, 0, 3), (13, 6, 0, 4)}
    assert {r for r in got if r[0] != 5} == want
    assert [r[1] for r in got if r[0] == 5] == [None]
    assert sorted(r.doc_id for r in decontamination.clean(docs, bench).collect()) == [2, 6, 8, 10, 12]
