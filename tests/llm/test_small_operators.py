import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyport.llm import decontamination, language_id, mixing, repeats, sharding, token_codec, token_files, topk_search, url_filter
from tallyport.llm.graph import components
from tallyport.llm.paragraph_dedup import ParagraphDedup, without_lines

from .brute import jaccard_classes, shingle_set


def clashing(df):
    return df.withColumns({c: F.lit(1) for c in ("size", "name", "n", "shard", "copy", "host", "id", "__key")})


# components


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(20)] + [(100, k) for k in range(101, 130)] + [(7, 7), (50, 51), (51, 50)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    want = {**dict.fromkeys(range(21), 0), **dict.fromkeys(range(100, 130), 100), 50: 50, 51: 50}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# 1


def test_urls_judged(spark):
    cases = {
        "http://NET/x": ("net", "/x", "net/", "block"),
        "https://a.example.net/en/1?q=/": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "https://a.example.net/en": ("a.example.net", "/en", "net/", "block"),
        "x://example.com/de/": ("example.com", "/de/", "example.com/de/", "block"),
        "x://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
        "x://a.org#/fr/": ("a.org", "", None, "allow"),
        "x://a.org/fr/": ("a.org", "/fr/", "org/fr/", "allow"),
        "x://a.net": ("a.net", "", None, "allow"),
        "http://www.bad.com/p/?utm_a=1#x": ("www.bad.com", "/p/", None, "block"),
        "ftp://bad.com/p": ("bad.com", "/p", None, "block"),
        "ftp://bad.com/p?a=1": ("bad.com", "/p", None, "allow"),
        "no address": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    pages = clashing(spark.createDataFrame([(u,) for u in cases] * 2, "url string"))
    listed = spark.createDataFrame([("bad.com/p",), (None,), ("bad.com/p",)], "c string")
    for blocks in (1, 1 << 20):
        out = url_filter.judged(pages, url_filter.RULES, listed, max_blocks=blocks)
        rows = out.select("url", "host", "path", "rule", "verdict").collect()
        assert len(rows) == 2 * len(cases)
        for r in rows:
            assert tuple(r)[1:] == cases[r.url], r
    assert url_filter.judged(pages, [], listed.limit(0)).where("verdict = 'block'").count() == 0
    assert url_filter.judged(pages.limit(0), url_filter.RULES, listed).count() == 0


# 2


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1000, 70_001])
@pytest.mark.parametrize("vocabulary", [1, 2, 300, 49_408])
def test_codec_round_trip(n, vocabulary):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n), vocabulary) - 1
    ids[n // 2 :] = ids[: n - n // 2]
    assert (token_codec.decode(token_codec.encode(ids, vocabulary), n, vocabulary) == ids).all()


def test_damaged_blocks_are_found():
    block = token_codec.pack([1, None], np.array([2, 1]), np.array([5, 6, 2]), 10)
    assert token_codec.unpack(block)[0] == [1, None]
    for at in range(len(block)):
        with pytest.raises(ValueError):
            token_codec.unpack(block[:at] + bytes([block[at] ^ 1]) + block[at + 1 :])


def test_token_files(spark, tmp_path):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["The cat's 42, É.", None, "", "  \n\t ", "<|STARTOFTEXT|> x", "same. same,", "long " * 40_000, "e\u0301te\u00a0x İ ΑΣ."]
    rows = [(k * 7 % 11, t) for k, t in enumerate(texts)] + [(3, "same. same,")]
    token_files.write_tokens(clashing(spark.createDataFrame(rows, "doc_id long, text string")), str(tmp_path / "t"), path)
    found = sorted(token_files.read_tokens(spark, str(tmp_path / "t")).collect(), key=lambda r: r.start)
    tokenizer = Tokenizer.from_file(path)
    start = 0
    assert [r.doc_id for r in found] == sorted(i for i, _ in rows)
    left = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows]
    for r in found:
        assert r.start == start
        start += r.n_tokens
        left.remove((r.doc_id, r.ids))
    digests = token_files.read_tokens(spark, str(tmp_path / "t"), digest=True).collect()
    assert {(r.start, r.ids_crc32) for r in digests} == {(r.start, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in found}
    token_files.write_tokens(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "e"), path)
    assert token_files.read_tokens(spark, str(tmp_path / "e")).count() == 0


# 3


def test_top_k(spark):
    rng = random.Random(3)
    rows = [(k, [rng.choice([-1.0, -0.1, 0.0, 0.3, 2.0]) for _ in range(7)]) for k in range(60)]
    rows += [(100, [1.0]), (150, [2.0]), (200, []), (250, []), (300, None), (350, [1.0, None]), (400, [float("nan")] * 7), (None, [0.5] * 7)]
    rows += [(450, [1e12] * 7), (500, [3.7e9] * 7), (52, rows[52][1]), (52, rows[52][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(0))
    got = sorted(tuple(r) for r in topk_search.top_k(df.repartition(3), df.where("vec_id % 50 = 0"), k=5).collect())
    valid = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for i, v in valid:
        if i % 50 == 0:
            scores = [(min(max(sum(a * b for a, b in zip(v, w)), -(2**63)), 2**63 - 1), j) for j, w in valid if j != i and len(w) == len(v)]
            want += [(i, rank, j, s) for rank, (s, j) in enumerate(sorted(scores, key=lambda x: (-x[0], x[1]))[:5], 1)]
    assert got == sorted(want)
    assert topk_search.top_k(df.limit(0), df).count() == 0


# 5


def test_language_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language_id.Model.fitted(docs.where("doc_id % 2 = 0"), "lang", "text", "doc_id")
    rest = docs.where("doc_id % 2 = 1")
    found = language_id.identified_texts(rest, model, F.col("doc_id"), declared_col=None).collect()
    truth = {r.doc_id: r.lang for r in rest.collect()}
    assert np.mean([truth[r.key] == r.lang for r in found]) > 0.97
    wrong = rest.withColumn("lang", F.lit("xx"))  # a declaration that tells nothing
    found = language_id.identified_texts(wrong, model, F.col("doc_id")).collect()
    assert np.mean([truth[r.key] == r.lang for r in found]) > 0.97


def test_evidence_is_fused_as_stated(spark):
    names, rng = ["a", "b", "c"], random.Random(2)
    rows = []
    for k in range(40):
        scores = None if k % 9 == 0 else [rng.uniform(-3, 0) for _ in names]
        rows.append((k, rng.choice(["a", "zz", None]), rng.choice(["com/a", "org", None]), rng.choice(["x.e.com", "y.e.com", "o.org", None]), scores))
    found = language_id.fused(spark.createDataFrame(rows, language_id.EVIDENCE_SCHEMA), names).collect()

    def normal(logs):
        powers = [math.exp(x - max(logs)) for x in logs]
        return [p / sum(powers) for p in powers]

    alone = [normal(r[4]) if r[4] else [1 / 3] * 3 for r in rows]
    total = [sum(a[k] for a in alone) for k in range(3)]
    overall = [(t + 1) / (sum(total) + 3) for t in total]

    def mass(test):
        return [sum(a[k] for a, r in zip(alone, rows) if test(r)) for k in range(3)]

    for r, own in zip(rows, alone):
        logs = []
        for k in range(3):
            prior = overall[k]
            if r[3]:
                domain = ".".join(r[3].split(".")[-2:])
                wide = mass(lambda q: q[3] and ".".join(q[3].split(".")[-2:]) == domain)
                wider = (wide[k] + 8 * overall[k]) / (sum(wide) + 8)
                seen = mass(lambda q: q[3] == r[3])
                prior = (max(seen[k] - own[k], 0) + 8 * wider) / (sum(seen) - 1 + 8)
            log = math.log(prior) + (r[4][k] if r[4] else 0)
            for c in (1, 2):
                if r[c]:
                    log += math.log((mass(lambda q: q[c] == r[c])[k] + 1) / (total[k] + 4))
            logs.append(log)
        p = normal(logs)
        got = next(f for f in found if f.key == r[0])
        assert got.lang == names[p.index(max(p))] and abs(got.p - max(p)) < 1e-9
        assert (got.text_lang is None) == (r[4] is None)


def test_language_of_odd_pages(spark):
    model = language_id.Model.fitted(spark.createDataFrame([("en", "the house and", 1), ("fr", "le chat est", 2), (None, "x", 3)], "lang string, text string, k long"), "lang", "text", "k")
    pages = [
        (1, "http://a.fr/", "<html lang='fr'><script>the house and</script><p>le chat</p></html>"), (2, None, None), (3, "", ""), (2, None, None),
        (None, "x", "<!-- the --> the house &amp; the house"), (4, "http://a.fr/de/", "1234 !!"), (5, "http://b.com", "the house and the " * 9000),
    ]
    found = language_id.identified_pages(clashing(spark.createDataFrame(pages, "page_id long, url string, html string")), model).collect()
    assert len(found) == len(pages)
    by = {r.key: r for r in found}
    assert by[1].lang == "fr" and by[1].declared == "fr" and by[5].lang == "en" and by[None].lang == "en"
    assert by[2].text_lang is None and by[4].text_lang is None
    empty = language_id.Model.fitted(spark.createDataFrame([], "lang string, text string, k long"), "lang", "text", "k")
    assert {r.lang for r in language_id.identified_pages(spark.createDataFrame(pages, "page_id long, url string, html string"), empty).collect()} == {None}


# 6


def long_repeats(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen: dict[bytes, int] = {}
    for b in texts:
        for k in range(len(b) - length + 1):
            seen[b[k : k + length]] = seen.get(b[k : k + length], 0) + 1
    out = []
    for (i, _), b in zip(rows, texts):
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("crowd", [1, 1 << 18])
def test_repeats_match_brute_force(spark, crowd, monkeypatch):
    monkeypatch.setattr(repeats, "CROWD_BYTES", crowd)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé \n") for _ in range(rng.randrange(1, 60)))
    shared = ["".join(word() for _ in range(6)) for _ in range(3)]
    rows = [(k, "".join(rng.choice([word, lambda: rng.choice(shared)[rng.randrange(9) :]])() for _ in range(12))) for k in range(25)]
    rows += [(90, "a" * 900), (91, "ab" * 300), (92, None), (93, ""), (93, rows[0][1]), (None, rows[1][1]), (None, rows[1][1]), (7, "short"), (94, rows[2][1][5:300])]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string")).repartition(4)
    got = [(r.id, r.n_bytes, len(r.spans), bytes(r.kept)) for r in repeats.without_repeats(df, length=120).collect()]
    order = lambda r: (r[0] is None, r)
    assert sorted(got, key=order) == sorted(long_repeats(rows, 120), key=order)


def test_repeats_in_texts_of_several_pieces(monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 500)
    rng = random.Random(1)
    text = bytes(rng.choice(b"abc") for _ in range(3000))
    found = list(repeats.anchors(text, 120))
    windows = [w for _, _, a, b in found for w in range(a, b + 1)]
    assert windows == list(range(len(text) - 119))
    other = list(repeats.anchors(b"xx" + text[700:1400], 120))
    places = {h for h, *_ in found}
    assert sum(h in places for h, *_ in other) >= len(other) - 2


def test_repeats_of_an_empty_table(spark):
    assert repeats.without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# 7


def test_shards(spark):
    rng = random.Random(6)
    rows = [(k, "x" * rng.randrange(200) if k % 3 else f"group {k % 21}" * 9) for k in range(600)] + [(900, None), (901, ""), (None, "a"), (5, "b"), (5, "b"), (902, "é" * 100)]
    rows += [(1000 + k, "hot text of many copies") for k in range(300)]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    out = sharding.sharded(df).collect()
    assert len(out) == len(rows)
    sizes: dict[int, int] = {}
    slots: dict[int, list[int]] = {}
    for r in out:
        raw = (r.text or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        sizes[r.shard] = sizes.get(r.shard, 0) + r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 450
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    small = {}
    for r in out:
        if r.text and r.text.startswith("group"):
            small.setdefault(r.text, set()).add(r.shard)
    assert sum(len(s) > 1 for s in small.values()) <= 2
    assert sharding.sharded(df.limit(0)).count() == 0
    linked = sharding.sharded(df, spark.createDataFrame([(k, k // 2) for k in range(600)], "id long, g long"))
    place = {r.doc_id: r.shard for r in linked.collect()}
    assert sum(place[k] == place[k + 1] for k in range(0, 600, 2)) > 200


def test_shards_of_repeated_rows(spark):
    """Rows that repeat id and text, a third of all and more, are spread like other documents."""
    rows = [(1, "equal row 012345")] * 400 + [(k, "y" * (k % 40)) for k in range(2, 102)] + [(None, None)] * 90
    rows += [(200 + k % 5, f"pair {k % 5}") for k in range(10)]
    for df in (spark.createDataFrame(rows, "doc_id long, text string"), clashing(spark.createDataFrame(rows, "doc_id long, text string"))):
        out = sharding.sharded(df).collect()
        assert sorted(map(repr, ((r.doc_id, r.text) for r in out))) == sorted(map(repr, rows))
        sizes: dict[int, int] = {}
        slots: dict[int, list[int]] = {}
        for r in out:
            sizes[r.shard] = sizes.get(r.shard, 0) + r["size"]
            slots.setdefault(r.shard, []).append(r.slot)
        assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 120
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())


# 8


def test_paragraphs(spark):
    rng = random.Random(8)
    line = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    passage = line(60)
    near = passage.split()
    near[30] = "OTHER"
    rows = [(k, "\n".join([line(20), passage if k % 3 == 0 else " ".join(near), "short line", line(9)])) for k in range(9)]
    rows += [(20, None), (21, ""), (22, passage.upper()), (None, line(12)), (23, "\n".join([passage, passage])), (24, line(20_000)), (0, rows[0][1])]
    found = ParagraphDedup(clashing(spark.createDataFrame(rows, "doc_id long, text string")))
    got = {r.doc_id: r for r in found.documents().collect()}
    assert len(got) == len({i for i, _ in rows})
    removed = {(i, k) for i, r in got.items() for k in r.removed}
    assert removed == {(k, 1) for k in range(1, 9)} | {(22, 0), (23, 0), (23, 1)}
    assert all(r.kept_in == [0] for r in got.values() if r.removed)
    assert got[20].n_paragraphs == 0 and got[24].n_paragraphs == 1
    left = {r.doc_id: r.text for r in without_lines(spark.createDataFrame(rows, "doc_id long, text string"), found.documents()).collect()}
    assert left[22] == "" and left[3].count("\n") == 2 and left[20] is None
    assert ParagraphDedup(spark.createDataFrame([], "doc_id long, text string")).documents().count() == 0


def test_given_paragraphs_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, k, line) for r in docs.collect() for k, line in enumerate(r.text.split("\n")) if len(line.encode().split()) >= 8]
    classes = jaccard_classes([(n, line) for n, (_, _, line) in enumerate(sorted(rows))])
    want = {sorted(rows)[n][:2] for n, _, least in classes if least != n}
    assert {(r.doc, r.paragraph) for r in ParagraphDedup(docs).removals.collect()} == want
    assert shingle_set("") == frozenset()


# 9


def edit_distance_to_part(item, text):
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        last, row[0] = row[0], 0
        for k, p in enumerate(item, 1):
            last, row[k] = row[k], min(row[k] + 1, row[k - 1] + 1, last + (p != c))
        best = min(best, row[-1])
    return best


def test_leaks_match_brute_force(spark, monkeypatch):
    rng = random.Random(9)
    words = lambda n: " ".join(rng.choice(["alpha", "be", "gamma ray", "delta", "Èps", "zet"]) + str(rng.randrange(30)) for _ in range(n))
    items = [(k, words(12)) for k in range(12)] + [(50, "too short"), (51, None), (None, words(9))]
    items.append((52, items[0][1]))
    rows = []
    for k in range(60):
        text = list(items[rng.randrange(12)][1])
        for _ in range(rng.randrange(8)):
            at = rng.randrange(len(text))
            text[at : at + rng.randrange(2)] = rng.choice(["", "x", "yz", " \n"])
        rows.append((k, words(5) + "\n" + "".join(text).upper() + words(3)))
    rows += [(70, None), (71, ""), (3, rows[3][1]), (None, items[2][1]), (72, "gamma " * 20_000)]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string")).repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for i, t in rows:
        text = decontamination.plain((t or "").encode())
        for j, item in items:
            pattern = decontamination.plain((item or "").encode())
            if t is not None and j is not None and len(pattern) >= decontamination.MIN_BYTES and len(text) < 5000:
                edits = edit_distance_to_part(pattern, text)
                if edits <= decontamination.budget(pattern):
                    want.append((i, j, edits))
    for size in (4 << 20, 200):
        monkeypatch.setattr(decontamination, "BLOCK_BYTES", size)
        order = lambda r: tuple((v is None, v) for v in r)
        got = [tuple(r)[:3] for r in decontamination.leaks(docs, bench).collect()]
        assert sorted(got, key=order) == sorted(want, key=order)
        hit = {i for i, _, _ in want}
        assert sorted(r.doc_id for r in decontamination.clean(docs, bench).collect() if r.doc_id is not None) == sorted(i for i, _ in rows if i is not None and i not in hit)
    assert decontamination.leaks(docs.limit(0), bench).count() == 0
    assert decontamination.leaks(docs, bench.limit(0)).count() == 0


# 10


def test_poisson_counts(spark):
    rows = [(k, "a" * 9, "rare" if k < 2 else ("big" if k < 3000 else None)) for k in range(4000)] + [(0, "a" * 9, "rare"), (None, None, "null"), (9000, "", "null")]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    out = mixing.mixed(df, {"rare": 1, "big": 2, "null": 0}).select("doc_id", "source", "copy", "copies", "shuffle_key").collect()
    counts: dict[str, int] = {}
    for r in out:
        counts[r.source] = counts.get(r.source, 0) + 1
    assert set(counts) == {"rare", "big"}
    total = sum(len(t or "") + 1 for _, t, _ in rows) / 10
    assert abs(counts["rare"] - total / 3) < 6 * math.sqrt(total) and abs(counts["big"] - 2 * total / 3) < 6 * math.sqrt(total)
    assert len({(r.doc_id, r.copy) for r in out if r.doc_id != 0}) == sum(r.doc_id != 0 for r in out)
    assert {r.copies for r in out if r.doc_id == 0} == {max(r.copy for r in out if r.doc_id == 0)}
    again = mixing.mixed(df.repartition(5), {"rare": 1, "big": 2, "null": 0})
    assert sorted(r.shuffle_key for r in again.collect()) == sorted(r.shuffle_key for r in out)
    shares = [n for n, in spark.createDataFrame([(k, "x", "s") for k in range(5000)], "doc_id long, text string, source string").transform(lambda d: mixing.mixed(d)).groupBy("doc_id").count().select("count").collect()]
    for k in (1, 2, 3):
        assert abs(shares.count(k) / 5000 - math.exp(-1) / math.factorial(k)) < 0.03
    assert mixing.mixed(df.limit(0)).count() == 0
