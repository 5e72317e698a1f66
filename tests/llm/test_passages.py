import random

import numpy as np
from pyspark.sql import functions as F

from tallyport.llm import passages
from tallyport.llm.paragraph_dedup import ParagraphDedup, without_repeats


def lines_of(rng):
    return lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def test_stretches_of_24_words_share_a_unit():
    rng = np.random.default_rng(5)
    for _ in range(500):
        draw = lambda n: rng.integers(0, 2**63, n).astype(np.uint64)
        same = draw(24)
        names = [set(passages.units(np.concatenate((draw(60), same, draw(60))))[2]) for _ in range(2)]
        assert names[0] & names[1]


def test_passages_inside_lines(spark):
    """Passages of 51 words and more in long lines, in texts without breaks, in other breaks, with a changed word, and in one document."""
    rng = random.Random(11)
    line = lines_of(rng)
    base = [line(n) for n in (51, 60, 60, 90, 70)]
    words = base[2].split()
    words[30] = "OTHER"
    changed = " ".join(words)
    broken = "\n".join(" ".join(base[3].split()[k : k + 6]) for k in range(0, 90, 6))
    far, twenty = line(60), line(20)
    rows = [
        (0, "\n".join([line(80) + " " + base[0] + " " + line(80), line(40) + " " + base[2] + " " + line(30)])),
        (1, line(200) + " " + base[1] + " " + line(300)),
        (2, line(50) + " " + base[3] + " " + line(50) + " " + twenty),
        (10, line(300) + " " + base[0].upper() + " " + line(300)),
        (11, line(7) + " " + base[1] + " " + line(4) + "\n" + line(12)),
        (12, line(90) + " é " + changed + " " + line(90)),
        (13, line(60) + "\n" + broken + "\n" + line(60)),
        (14, line(60) + " " + base[4] + " " + line(90) + " " + base[4] + " " + line(60)),
        (15, line(60) + " " + twenty + " " + line(60)),
        (16, "long " * 3000),
        (17, None),
        (18, ""),
        (None, line(100) + " " + far + " " + line(100)),
        (19, line(100) + " " + far + " " + line(100)),
    ]
    planted = {10: base[0].upper(), 11: base[1], 12: changed, 13: broken, 14: base[4], 19: far}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    documents = ParagraphDedup(docs.repartition(3)).documents()
    got = {r.doc_id: r for r in documents.collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        spans = got[i].spans
        raw = (text or "").encode()
        if i in planted:
            passage = planted[i].encode()
            at = raw.rindex(passage)
            assert [(s.start, s.end) for s in spans] == [(at, at + len(passage))], i
        elif i == 16:
            assert len(spans) == 1 and spans[0].end == len(raw) - 1 and 0 < spans[0].start < 100
        else:
            assert spans == [] and got[i].removed == []
    assert [got[i].kept_in for i in (10, 11, 12, 13, 14, 19)] == [[0], [1], [0], [2], [14], []]
    left = {r.doc_id: r.text for r in without_repeats(docs.withColumn("x", F.lit(1)), documents).collect()}
    assert all(left[i] == t for i, t in rows if i not in planted and i != 16)
    assert all(" ".join(t.replace(planted[i], "", 1).split()) == " ".join(left[i].split()) for i, t in rows if i in planted and i != 14)
    assert left[14].count(base[4]) == 1


def test_passages_are_compared_by_their_text(spark, monkeypatch):
    # 30 documents with one passage: what is moved are the bytes of the words around it
    rng = random.Random(21)
    line = lines_of(rng)
    passage = line(80)
    rows = [(k, line(200) + " " + passage + " " + line(200)) for k in range(30)]
    moved, written = [], passages.written

    def counted(df, name):
        out = written(df, name)
        if name == "words":
            sizes = [F.octet_length(c) for c, kind in out.dtypes if kind == "binary"]
            moved.append(out.select(sum(sizes[1:], sizes[0]).alias("n")).agg(F.sum("n"), F.count("*")).first())
        return out

    monkeypatch.setattr(passages, "written", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(F.col("doc_id").alias("doc"), "text")
    none = spark.createDataFrame([], "doc long, paragraph int")
    found = passages.passages(docs, none, 75).collect()
    starts = {k: text.index(passage) for k, text in rows}
    assert {(r.doc, r.start) for r in found if r.first_doc == 0} == {(k, starts[k]) for k in range(1, 30)}
    assert all(starts[r.doc] <= r.start < r.end <= starts[r.doc] + len(passage) for r in found)
    # a window has some 200 words of 4.9 bytes
    assert moved[0][1] >= 30 and moved[0][0] < 1800 * moved[0][1]
