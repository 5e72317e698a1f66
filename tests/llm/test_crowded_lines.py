import random

from pyspark.sql import functions as F

from tallyport.llm import cell_join, paragraph_dedup
from tallyport.llm.paragraph_dedup import ParagraphDedup

from .brute import jaccard_classes


def test_versions_of_a_line_without_a_middle(spark, monkeypatch):
    # all versions share most words and few are linked
    monkeypatch.setattr(paragraph_dedup, "CROWD", 8)
    rng = random.Random(12)
    base = [f"w{k}" for k in range(60)]
    lines = []
    for _ in range(150):
        line = list(base)
        for at in rng.sample(range(60), 3):
            line[at] = f"x{rng.randrange(10**6)}"
        lines.append(" ".join(line))
    lines += [line + " end" for line in lines[:20]]
    rows = list(enumerate(lines))
    made, pairs = [], cell_join.CellJoin._pairs

    def counted(self, *args, **options):
        out = pairs(self, *args, **options)
        made.append(out.count())
        return out

    monkeypatch.setattr(cell_join.CellJoin, "_pairs", counted)
    found = ParagraphDedup(spark.createDataFrame(rows, "doc_id long, text string"))
    want = {i for i, _, least in jaccard_classes(rows) if least != i}
    assert {r.doc for r in found.removals.collect()} == want and 20 <= len(want) < 160
    assert sum(made) < 2 * len(rows) ** 2


def test_classes_of_a_large_cell_are_exploded_once(spark):
    join = cell_join.CellJoin(None, 75, None)
    rows = spark.range(2000).select(F.lit(1).alias("cell"), F.col("id").alias("name"), (F.lit(100) + F.col("id") % 3).cast("int").alias("n"), F.lit(0).alias("place"))
    plan = join._with_partners(rows)._jdf.queryExecution().optimizedPlan().toString()
    at = plan.index("Generate explode(sequence(low")
    assert plan.index("Aggregate", at) < plan.index("Range", at)
    assert join._with_partners(rows).count() == 2000
