import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyport.llm import best_fit, word_ids
from tallyport.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
SMALLEST = "/root/testdata/sf0.001"


def one_by_one(lengths, capacity):
    """Remaining capacities of best fit decreasing, a document at a time."""
    bins = []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in bins if r >= length]
        if fits:
            bins.remove(min(fits))
            bins.append(min(fits) - length)
        else:
            bins.append(capacity - length)
    return sorted(bins)


def check_places(rows, capacity):
    """rows (sequence, offset, length): gapless from 0 in each sequence, within the capacity."""
    held = {}
    for sequence, offset, length in rows:
        held.setdefault(sequence, []).append((offset, length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return sorted(capacity - sum(n for _, n in p) for p in held.values())


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 40).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=120))))
def test_plan_packs_as_one_by_one(case):
    capacity, lengths = case
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan = best_fit.Plan(counts, capacity)
    length = np.repeat(np.array(sorted(counts), np.int64), [counts[n] for n in sorted(counts)])
    rank = np.concatenate([np.arange(counts[n]) for n in sorted(counts)]) if counts else np.empty(0, np.int64)
    sequence, offset = plan.places(length, rank)
    left = check_places(list(zip(sequence.tolist(), offset.tolist(), length.tolist(), strict=True)), capacity)
    assert left == one_by_one(lengths, capacity)
    assert sorted(set(sequence.tolist())) == list(range(plan.sequences))


def test_plan_of_many_documents_is_small():
    draw = random.Random(1)
    counts = {n: draw.randrange(10**9, 10**11) for n in range(1, 2049)}
    plan = best_fit.Plan(counts, 2048)
    total = sum(n * c for n, c in counts.items())
    assert len(plan.keys) < 100_000
    assert -(-total // 2048) <= plan.sequences < 1.01 * total / 2048


TEXTS = [
    None, "", " ", "\n\n", "One. two, THREE.four ,five", "CUMHURİYETİ. x", "जड़, जड़.", "é. á, é.", "it's I'LL don't.",
    "<|endoftext|> a<|endoftext|>. <|EndOfText|>", "a.b,c...d", "1.5 2,5 12", "tab\tand\rreturn\vline hard", "word " * 3000, "x" * 9000, "日本語。テスト、", "ΣΑΣ. Σ",
]


def test_ids_are_those_of_the_whole_text():
    import pyarrow as pa

    tokenizer = Tokenizer.from_file(PATH)
    ids, sizes = word_ids.WordIds(PATH, 0).ids(pa.array(TEXTS, pa.string()))
    parts = np.split(ids, np.cumsum(sizes)[:-1])
    for text, part in zip(TEXTS, parts, strict=True):
        assert part.tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], text
    ids, sizes = word_ids.WordIds(PATH, 0).ids(pa.array([], pa.string()))
    assert len(ids) == len(sizes) == 0


def model(rows, capacity, end):
    tokenizer = Tokenizer.from_file(PATH)
    out = []
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            out.append((i, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row)


def test_small_table_with_hard_rows(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, "null id"), (None, None), (3, "again"), (3, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("part", "rank", "ids", "length")})
    packing = best_fit.Packing(docs.repartition(4), PATH, capacity=64, end=7)
    digests = packing.pieces.mapInArrow(best_fit._digests, best_fit.PIECES.replace("ids array<int>", "ids_crc32 long"))
    got = packing.placed(digests).collect()
    want = model(rows, 64, 7)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)
    left = check_places([(r.sequence_id, r.offset, r.length) for r in got], 64)
    assert left == one_by_one([w[3] for w in want], 64)
    sequences = packing.sequences().collect()
    assert sorted(64 - r.length for r in sequences) == left and all(len(r.ids) == r.length for r in sequences)
    empty = best_fit.Packing(docs.limit(0), PATH)
    assert empty.placed(empty.pieces).count() == 0 and empty.sequences().count() == 0


def test_query(spark):
    rows = spark.read.parquet(f"{SMALLEST}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op13_best_fit_packing"](spark, SMALLEST).collect()
    want = model([tuple(r) for r in rows], 2048, 0)
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    left = check_places([(r.sequence_id, r.offset, r.length) for r in got], 2048)
    assert left == one_by_one([w[3] for w in want], 2048)
