import random

from tallyport.llm import repeats
from .test_small_operators import long_repeats


def test_versions_of_a_crowded_passage(spark, monkeypatch):
    """Versions that share parts of a passage with each other only in part, beside exact copies."""
    monkeypatch.setattr(repeats, "CROWD_BYTES", 0)
    made = []
    real = repeats._crowded

    def counted(kinds, length):
        before = repeats.written

        def seen(df, name):
            out = before(df, name)
            if name == "blocks":
                made.append(out.count())
            return out

        monkeypatch.setattr(repeats, "written", seen)
        try:
            return real(kinds, length)
        finally:
            monkeypatch.setattr(repeats, "written", before)

    monkeypatch.setattr(repeats, "_crowded", counted)
    rng = random.Random(8)
    passage = [rng.choice("abcdefgh") for _ in range(420)]
    rows = []
    for k in range(60):
        text = list(passage)
        for _ in range(k % 4):
            text[rng.randrange(len(text))] = rng.choice("XYZ")
        own = "".join(rng.choice("ijkl") for _ in range(rng.randrange(40)))
        rows.append((k, own + "".join(text[rng.randrange(0, 60) :]) + own[::-1]))
    rows += [(100 + k, "".join(passage)) for k in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.id, r.n_bytes, len(r.spans), bytes(r.kept)) for r in repeats.without_repeats(df, length=120).collect()]
    assert sorted(got) == sorted(long_repeats(rows, 120))
    # one row a window would be as many as this
    windows = sum(len(t) - 119 for _, t in rows)
    assert 0 < sum(made) < windows / 2
