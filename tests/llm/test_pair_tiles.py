import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyport.llm import pair_tiles


def model(rows, least=10, best=2000, share=50):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for k in (1, 2, 3):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = [g for g, a in f.items() if len(g) > 1 and a >= least]
        kept = []
        for g in candidates:
            a = f[g]
            if any(len(b) > len(g) and g in (b[:2], b[1:]) and 100 * f[b] >= share * a for b in candidates):
                continue
            cuts = [(1000000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def drawn(seed, n):
    draw = random.Random(seed)
    words = ["The", "of", "a", "été", "日本", "x1", "ok,", "end.", "long", "ÉTÉ", "b;c", "\x00"] + [f"w{k}" for k in range(60)]
    weights = [1 / (k + 1) for k in range(len(words))]
    rows = []
    for _ in range(n):
        text = draw.choice([" ", "\t", "  "]).join(draw.choices(words, weights, k=draw.randrange(0, 60)))
        rows.append((draw.choice(["en", "en", "fr", None, ""]), text.replace("long", "New York City")))
    rows += [("en", None), (None, None), ("fr", ""), ("fr", ".,;"), ("xx", "only once here"), ("de", "und " * 5000)]
    return rows + [("en", "a copied line of words that many share\n")] * 300


@pytest.mark.parametrize("band, chunk, part, dense", [(1024, 8 << 20, 1 << 27, 1 << 22), (4, 2000, 1 << 27, 64), (2, 500, 300, 1)])
def test_collocations_are_those_of_the_model(spark, monkeypatch, band, chunk, part, dense):
    for name, value in (("BAND", band), ("CHUNK_BYTES", chunk), ("PART_WORDS", part), ("DENSE", dense)):
        monkeypatch.setattr(pair_tiles, name, value)
    rows = drawn(band, 150)
    docs = spark.createDataFrame(rows, "lang string, text string").withColumns({c: F.lit("x") for c in ("word", "a", "n", "id", "chunk", "f")})
    for least, best in ((10, 2000), (3, 7)):
        got = sorted(tuple(r) for r in pair_tiles.collocations(docs.repartition(3), least, best).collect())
        assert got == model(rows, least, best)
        assert got


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert pair_tiles.collocations(docs).count() == 0
    docs = spark.createDataFrame([("en", None), ("en", " . ")], "lang string, text string")
    assert pair_tiles.collocations(docs).count() == 0


def test_tiles_hold_every_pair():
    draw = np.random.default_rng(1)
    left, right = (draw.zipf(1.2, 20000) % (1 << 30) for _ in range(2))
    for parts in (1, 7):
        found = Counter()
        for _, _, tile, high, part, codes, counts in pair_tiles.in_tiles(1, "en", parts, left, right):
            i, j = tile // 64, tile % 64
            wide = pair_tiles.width(j)
            low = np.frombuffer(codes, np.uint32).astype(np.int64) + (high << 32)
            assert (low % parts == part).all()
            for code, n in zip(low.tolist(), np.frombuffer(counts, np.uint32).tolist(), strict=True):
                found[code // wide + (pair_tiles.width(i) if i else 0), code % wide + (wide if j else 0)] += n
        assert found == Counter(zip(left.tolist(), right.tolist(), strict=True))
