import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyport.llm.cell_join import CellJoin
from tallyport.llm.jaccard_join import MOST_PARTS, SKETCH, JaccardJoin, _regions

from .brute import jaccard_classes


def key(row):
    return tuple((v is None, v) for v in row)


def compare(spark, rows, percent=75, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"name": F.lit("x"), "n": F.lit(1), "cell": F.lit(2)})
    got = [tuple(r) for r in JaccardJoin(df.repartition(3), percent=percent, **options).classes().collect()]
    assert sorted(got, key=key) == sorted(jaccard_classes(rows, percent), key=key)


def test_given_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in JaccardJoin(docs).classes().collect()]
    assert sorted(got) == sorted(jaccard_classes(rows))


def test_defined_cases(spark):
    compare(
        spark,
        [
            (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "ONE  two\n"), (6, "one two three four five"), (None, "one two"),
            (7, "É one two three four five"), (7, "É one two three four five"), (8, "é one two three four five"), (9, "one two"),
            (10, "w " * 30_000), (None, None),
        ],
    )


@pytest.mark.parametrize(("block", "percent", "crowd"), [(2, 75, 3), (1024, 50, 4096), (1024, 60, 5)])
def test_chains_and_crowded_regions(spark, block, percent, crowd):
    # variants of a few texts at all distances: links that only a middle text makes, cells of several components
    rng = random.Random(5)
    base = [[f"w{rng.randrange(400)}" for _ in range(60)] for _ in range(4)]
    rows = []
    for k in range(70):
        words = list(base[k % 4])
        for _ in range(rng.randrange(6)):
            words[rng.randrange(60)] = f"x{rng.randrange(9)}"
        if rng.random() < 0.3:
            words = words[: rng.randrange(8, 60)]
        rows.append((k, " ".join(words)))
    compare(spark, rows, percent=percent, block=block, crowd=crowd)


def test_crowd_around_a_shared_passage(spark):
    # all share most shingles and none is linked to all others; a few are linked
    rng = random.Random(11)
    passage = [f"p{k}" for k in range(60)]
    rows = [(k, " ".join([f"u{rng.randrange(10**6)}" for _ in range(12)] + passage)) for k in range(60)]
    rows += [(100 + k, rows[k][1] + " end") for k in range(3)] + [(200 + k, "start " + rows[k][1]) for k in range(2, 5)]
    compare(spark, rows, percent=75, crowd=20)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert JaccardJoin(df).classes().count() == 0


def test_pivot_is_the_member_of_least_place(spark):
    rows = [(1, k, 50, 0 if k == 17 else 3 + k % 5) for k in range(40)] + [(2, k, 50, 4) for k in range(9)]
    pivots = CellJoin._pivots(spark.createDataFrame(rows, "cell long, name long, n int, place int"))
    got = {r.cell: (r.pivot.name, r.pivot.place) for r in pivots.collect()}
    assert got[1] == (17, 0) and got[2][1] == 4


def test_edited_copies_need_few_comparisons(spark, monkeypatch):
    # copies with one to 30 changed words in 200, the plain text among them
    rng = random.Random(3)
    words = [f"w{k}" for k in range(200)]
    rows = [(0, " ".join(words))]
    for k in range(1, 300):
        changed = list(words)
        for at in rng.sample(range(200), rng.randint(1, 30)):
            changed[at] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(changed)))
    made, tested = [], CellJoin._tested

    def counted(self, pairs, before):
        made.append(pairs.where(self._sizes_fit() & self._within_reach()).count())
        return tested(self, pairs, before)

    monkeypatch.setattr(CellJoin, "_tested", counted)
    compare(spark, rows)
    assert sum(made[1:]) < 1000


def test_whole_sets_are_compared_for_likely_pairs_only(spark, monkeypatch):
    # 40 sets of 400 to 447 shingles: neighbours by number are linked, all others share fewer
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 400 + 40 * 40, dtype=np.uint64)
    sets = {k: np.sort(base[40 * k : 40 * k + 400 + k]) for k in range(40)}
    held = spark.createDataFrame([(k, len(s), bytearray(s.tobytes())) for k, s in sets.items()], "name long, n int, shingles binary")
    pairs = [(a, len(sets[a]), b, len(sets[b])) for a in sets for b in sets if a < b]
    whole, compared = [], CellJoin._compared

    def counted(pairs, sets, kind=np.uint64):
        whole.append(pairs.count() if kind is np.uint64 else 0)
        return compared(pairs, sets, kind)

    monkeypatch.setattr(CellJoin, "_compared", staticmethod(counted))
    join = CellJoin(lambda nodes: held, 75, None)
    found = join._verified(spark.createDataFrame(pairs, "x long, xn int, y long, yn int"), True).collect()
    assert len(found) == len(pairs) and sum(whole) < 60
    links = 0
    for r in found:
        shared = len(np.intersect1d(sets[r.x], sets[r.y]))
        linked = 100 * shared >= 75 * (r.xn + r.yn - shared)
        links += linked
        assert r.shared == shared if linked else shared <= r.shared and 100 * r.shared < 75 * (r.xn + r.yn - r.shared)
    assert links == 39


def test_first_round_compares_short_sets_too(spark, monkeypatch):
    # versions of a text with one to 30 changed words in 200: most pairs with a pivot are not linked
    rng = random.Random(8)
    words = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(150):
        changed = list(words)
        for at in rng.sample(range(200), rng.randint(1, 30)):
            changed[at] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(changed)))
    made, compared = {np.uint64: 0, np.uint16: 0}, CellJoin._compared

    def counted(pairs, sets, kind=np.uint64):
        made[kind] += pairs.count()
        return compared(pairs, sets, kind)

    monkeypatch.setattr(CellJoin, "_compared", staticmethod(counted))
    links = JaccardJoin(spark.createDataFrame(rows, "doc_id long, text string")).links.count()
    assert 0 < links <= made[np.uint64] <= links + 5 < made[np.uint16]


def test_chance_does_not_part_regions():
    class Sketch:
        value = np.full(SKETCH, 5000)

    text = " ".join(f"w{k}" for k in range(40))
    batch = pa.record_batch([pa.array([text])], names=["text"])
    packed = np.concatenate([b.column(2).to_numpy() for b in _regions([batch], 5, 75, Sketch)])
    assert len(packed) and not (packed & MOST_PARTS).any()
