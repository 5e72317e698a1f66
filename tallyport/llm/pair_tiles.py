"""Collocations: pairs of frequency-ranked ids counted in tiles, and frequent pairs ranked and paired again."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyport.llm.registry import query
from tallyport.llm.tables import small_batches, table, written
from tallyport.llm.word_ids import bytes_of

# Bytes of text in a chunk of encoded words, words of a language for one part of each tile.
CHUNK_BYTES, PART_WORDS = 4 << 20, 1 << 25
# Ids of the first band; each later band is as wide as all before it.
BAND = 1024
# Cells that are counted by address; larger tiles, and chunks with few pairs of a tile, are sorted.
DENSE = 1 << 22
# Entries a sparse tile gathers before they are summed.
GATHERED = 1 << 22
CODE_BITS, ID_BITS = 32, 31
# Parts of a language ranked apart, before its best phrases are.
PARTS = 64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# What parts words (1) and pieces (2).
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2

CHUNKS = "chunk long, lang string, codes binary, words array<string>, counts array<long>"
TILES = "chunk long, lang string, tile int, high long, part long, codes binary, counts binary"
COUNTED = "lang string, tile int, high long, part long, code array<long>, n array<long>"
TILE_KEY = ["lang", "tile", "high", "part"]


def cut(data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in a row, lower-cased, and for each the number of piece ends before it."""
    kind = KIND[data]
    inside = kind == 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = bounds[:-1][bounds[:-1] < len(data)]
    begins[first] = inside[first]
    starts = np.flatnonzero(begins)
    offsets = np.append(np.cumsum(inside)[starts] - 1, inside.sum()).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(LOWER[data[inside]]))
    piece = np.cumsum(kind == 2)[starts] + np.searchsorted(bounds, starts, "right")
    return words, piece


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, made = TaskContext.get().partitionId() << 32, 0
    names = ["chunk", "lang", "codes", "words", "counts"]
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64())]

    def chunks(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal made
        rows = pa.Table.from_batches(held).combine_chunks()
        langs = rows.column(0).combine_chunks().dictionary_encode()
        which = langs.indices.to_numpy(zero_copy_only=False)
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            texts = rows.column(1).filter(pa.array(which == k)).combine_chunks()
            words, piece = cut(*bytes_of(texts))
            if not len(words):
                continue
            encoded = words.dictionary_encode()
            codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
            counts = np.bincount(codes, minlength=len(encoded.dictionary))
            ends = np.append(0, np.cumsum(np.diff(piece) != 0))
            out = np.full(len(codes) + ends[-1], -1, np.int32)  # a piece end is -1
            out[np.arange(len(codes)) + ends] = codes
            row = [part + made, lang, out.tobytes(), encoded.dictionary.to_pylist(), counts]
            made += 1
            yield pa.record_batch([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=names)

    held, size = [], 0
    for batch in batches:
        held.append(pa.record_batch([batch.column(0), batch.column(1).cast(pa.large_string())], names=["lang", "text"]))
        size += held[-1].column(1).nbytes
        if size >= CHUNK_BYTES:
            yield from chunks(held)
            held, size = [], 0
    if held:
        yield from chunks(held)


def ranked(df: DataFrame, group: str, order: list[Column], out: str, name: str) -> DataFrame:
    """Adds `out`: gapless numbers from 0 within each value of `group`, in the given order, and writes the rows.

    Rows are dealt and sorted by ranges of (group, order); a running total over the parts gives where each begins, so a
    large group is ordered by many tasks.
    """
    rows = df.repartitionByRange(F.col(group), *order).sortWithinPartitions(F.col(group), *order)
    rows = written(rows.withColumn("_place", F.monotonically_increasing_id()), name)
    in_part = F.shiftright("_place", 33)
    parts = rows.groupBy(group, in_part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_part")) - F.col("_n")
    begins = parts.select(F.col(group).alias("_group"), "_part", (before - F.col("_first")).alias("_shift"))
    joined = rows.join(begins, (F.col(group) == F.col("_group")) & (in_part == F.col("_part")))
    return joined.withColumn(out, F.col("_place") + F.col("_shift")).drop("_place", "_group", "_part", "_shift")


def bands(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The band of each id, and its place in the band."""
    band = np.frexp((ids // BAND).astype(np.float64))[1].astype(np.int64)
    return band, ids - np.where(band > 0, BAND << np.maximum(band - 1, 0), 0)


def width(band: int) -> int:
    return BAND << max(band - 1, 0)


def summed(codes: np.ndarray, counts: np.ndarray | None, area: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and the sum of their counts (None: 1 each)."""
    if area <= DENSE and len(codes) * 8 >= area:
        if counts is None:
            total = np.bincount(codes, minlength=1)
        else:
            total = np.zeros(area, np.int64)
            np.add.at(total, codes, counts)
        found = np.flatnonzero(total)
        return found, total[found]
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    begins = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])[: len(codes)])
    if counts is None:
        return codes[begins], np.diff(np.append(begins, len(codes)))
    return codes[begins], np.add.reduceat(counts[order], begins) if len(begins) else counts[:0]


def in_tiles(chunk: int, lang: str, parts: int, left: np.ndarray, right: np.ndarray) -> Iterator[list]:
    """Rows of TILES: the pairs of a chunk summed by tile, large tiles by 2^32 codes, and each in `parts` by its code."""
    left_band, left_place = bands(left)
    right_band, right_place = bands(right)
    tile = (left_band * 64 + right_band).astype(np.uint16)
    code = left_place * (BAND << np.maximum(right_band - 1, 0)) + right_place
    order = np.argsort(tile, kind="stable")
    tile, code = tile[order], code[order]
    begins = np.flatnonzero(np.append(True, tile[1:] != tile[:-1])[: len(tile)])
    for b, e in zip(begins, np.append(begins[1:], len(tile)), strict=True):
        t = int(tile[b])
        codes, counts = summed(code[b:e], None, width(t // 64) * width(t % 64))
        key = (codes >> CODE_BITS) * parts + codes % parts
        if parts > 1:
            by = np.argsort(key, kind="stable")
            codes, counts, key = codes[by], counts[by], key[by]
        cuts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        for x, y in zip(cuts, np.append(cuts[1:], len(key)), strict=True):
            low = (codes[x:y] & ((1 << CODE_BITS) - 1)).astype(np.uint32)
            yield [chunk, lang, t, int(codes[x]) >> CODE_BITS, int(codes[x] % parts), low.tobytes(), counts[x:y].astype(np.uint32).tobytes()]


def _batch(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    names = ["chunk", "lang", "tile", "high", "part", "codes", "counts"]
    return pa.record_batch([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def ids_of(codes: bytes, places: list, ids: list) -> np.ndarray:
    """Ranked ids of a chunk's words; piece ends and words that are too rare are -1."""
    codes = np.frombuffer(codes, np.int32)
    known = np.full(int(codes.max(initial=-1)) + 2, -1, np.int64)
    known[places] = ids
    known[-1] = -1
    return known[codes]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        chunk, lang, parts = (batch.column(k).to_pylist() for k in (0, 1, 2))
        for k in range(batch.num_rows):
            ids = ids_of(batch.column(3)[k].as_py(), batch.column(4)[k].values.to_numpy(), batch.column(5)[k].values.to_numpy())
            at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
            rows = list(in_tiles(chunk[k], lang[k], parts[k], ids[at], ids[at + 1]))
            if rows:
                yield _batch(rows)


def _counted(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Rows of TILES in order of their key to its codes that reach `least`, with their counts."""
    names = ["lang", "tile", "high", "part", "code", "n"]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    key, codes, counts, size, dense = None, [], [], 0, None

    def gathered() -> None:
        nonlocal codes, counts, size
        if codes:
            found, total = summed(np.concatenate(codes), np.concatenate(counts), 1 << 62)
            codes, counts, size = [found], [total], 0

    def closed() -> Iterator[pa.RecordBatch]:
        nonlocal codes, counts
        if dense is not None:
            codes = [np.flatnonzero(dense >= least)]
            counts = [dense[codes[0]]]
        else:
            gathered()
        keep = counts[0] >= least
        if keep.any():
            row = [*key, codes[0][keep] + (key[2] << CODE_BITS), counts[0][keep]]
            yield pa.record_batch([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=names)

    for batch in batches:
        keys = list(zip(*[batch.column(k).to_pylist() for k in (0, 1, 2, 3)], strict=True))
        for k, now in enumerate(keys):
            if now != key:
                if key is not None:
                    yield from closed()
                key, codes, counts, size = now, [], [], 0
                area = width(now[1] // 64) * width(now[1] % 64)
                dense = np.zeros(area, np.int64) if area <= DENSE else None
            code = np.frombuffer(batch.column(4)[k].as_py(), np.uint32)
            count = np.frombuffer(batch.column(5)[k].as_py(), np.uint32)
            if dense is not None:
                dense[code] += count  # the codes of a row are distinct
            else:
                codes.append(code.astype(np.int64))
                counts.append(count.astype(np.int64))
                size += len(code)
                if size > GATHERED:
                    gathered()
    if key is not None:
        yield from closed()


def counted(tiles: DataFrame, least: int) -> DataFrame:
    """Rows (lang, tile, high, part, code, n) of the pairs found at least so often, in any number of chunks."""
    moved = tiles.select(*TILE_KEY, "codes", "counts").repartition(*TILE_KEY).sortWithinPartitions(*TILE_KEY)
    found = moved.mapInArrow(lambda it: _counted(it, least), COUNTED)
    return found.select(*TILE_KEY, F.explode(F.arrays_zip("code", "n")).alias("c")).select(*TILE_KEY, "c.code", "c.n")


def band_start(band: Column) -> Column:
    return F.when(band > 0, F.call_function("shiftleft", F.lit(BAND).cast("long"), (band - 1).cast("int"))).otherwise(0)


def band_width(band: Column) -> Column:
    return F.call_function("shiftleft", F.lit(BAND).cast("long"), F.greatest(band - 1, F.lit(0)).cast("int"))


def with_ids(counts: DataFrame, left: str, right: str) -> DataFrame:
    """The two ids of each counted pair, from its tile and code."""
    left_band, right_band = F.expr("tile div 64").cast("int"), F.col("tile") % 64
    wide = band_width(right_band)
    rest = F.col("code") % wide
    return counts.withColumns({
        left: band_start(left_band) + F.call_function("div", F.col("code"), wide),
        right: band_start(right_band) + rest,
    })


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each chunk which of its pairs are frequent, with their ids: rows (chunk, pairs, ids).

    Of a key, the frequent codes come first, then what chunks sent.
    """
    key, codes, ids = None, np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in batches:
        keys = list(zip(*[batch.column(k).to_pylist() for k in (0, 1, 2, 3)], strict=True))
        chunks = batch.column(4).to_pylist()
        out = []
        for k, now in enumerate(keys):
            own = batch.column(5)[k].as_py()
            if chunks[k] is None:
                key, codes, ids = now, np.frombuffer(own, np.int64), np.frombuffer(batch.column(6)[k].as_py(), np.int64)
                continue
            if now != key:
                continue  # nothing of this tile is frequent
            asked = np.frombuffer(own, np.uint32).astype(np.int64) + (now[2] << CODE_BITS)
            at = np.minimum(np.searchsorted(codes, asked), len(codes) - 1)
            hit = codes[at] == asked
            if hit.any():
                left_band, right_band = now[1] // 64, now[1] % 64
                wide = width(right_band)
                left = asked[hit] // wide + (width(left_band) if left_band else 0)
                right = asked[hit] % wide + (wide if right_band else 0)
                out.append((chunks[k], ((left << ID_BITS) | right).tobytes(), ids[at[hit]].tobytes()))
        if out:
            kinds = [pa.int64(), pa.binary(), pa.binary()]
            yield pa.record_batch([pa.array(v, t) for v, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["chunk", "pairs", "ids"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells = [pa.array([c.values.to_numpy().astype(np.int64).tobytes() for c in batch.column(k)], pa.binary()) for k in (4, 5)]
        yield pa.record_batch([*batch.columns[:4], *cells], names=[*TILE_KEY, "codes", "counts"])


def _triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        chunk, lang, parts = (batch.column(k).to_pylist() for k in (0, 1, 2))
        for k in range(batch.num_rows):
            words = ids_of(batch.column(3)[k].as_py(), batch.column(4)[k].values.to_numpy(), batch.column(5)[k].values.to_numpy())
            pairs = np.concatenate([np.frombuffer(p.as_py(), np.int64) for p in batch.column(6)[k].values])
            ids = np.concatenate([np.frombuffer(p.as_py(), np.int64) for p in batch.column(7)[k].values])
            order = np.argsort(pairs)
            pairs, ids = pairs[order], ids[order]
            both = (words[:-1] >= 0) & (words[1:] >= 0)
            pair = np.where(both, (words[:-1] << ID_BITS) | words[1:], -1)
            at = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
            pair_id = np.where(pairs[at] == pair, ids[at], -1)
            # a phrase of three words is as frequent as asked only if both its pairs are
            here = np.flatnonzero((pair_id[:-1] >= 0) & (pair_id[1:] >= 0))
            rows = list(in_tiles(chunk[k], lang[k], parts[k], pair_id[here], words[here + 2]))
            if rows:
                yield _batch(rows)


class Phrases:
    """Counts of the phrases of one, two and three words that occur at least `least` times in a language.

    `words` (lang, word, f, id), `pairs` (lang, left, right, a, id), `triples` (lang, pair, right, a) and `totals` (lang, n: all
    words). Words are `[^ \\t]+` of the pieces between `.,;:!?` and line ends, A-Z lower-cased; a null text is
    empty, a null language is `und`; whole texts are read once.

    Chunks of text become codes of the chunk's own dictionary. Dictionaries, not texts, are joined with the words ranked
    by frequency. Ids fall into bands, each as wide as all before it, which by Zipf's law hold about as many words
    each, and pairs of ids into tiles of two bands. A chunk sums its pairs before they move, so the most
    frequent pair is one entry a chunk; a tile is summed by address if it is small, else by sorting, in as many parts as
    the language's size asks for. The frequent pairs are ranked in turn, each chunk is told the ids of its own, and
    pairs of (pair, word) are counted in the same way.
    """

    def __init__(self, docs: DataFrame, least: int = 10, text_col: str = "text", lang_col: str = "lang"):
        small_batches(docs.sparkSession)
        rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
        chunks = written(rows.mapInArrow(_encoded, CHUNKS), "chunks")
        entries = chunks.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w"))
        entries = entries.select("chunk", "lang", "place", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
        total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
        self.totals = written(chunks.groupBy("lang").agg(F.sum(total).alias("n")), "totals")
        frequent = entries.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
        self.words = written(ranked(frequent, "lang", [F.desc("f"), F.col("word")], "id", "words"), "words")
        if not self.words.where(F.col("id") >= 1 << ID_BITS).isEmpty():
            raise ValueError("more frequent words than ids")

        parts = self.totals.select("lang", F.expr(f"1 + n div {PART_WORDS}").alias("parts"))
        known = entries.select("chunk", "lang", "place", "word").join(self.words.select("lang", "word", "id"), ["lang", "word"])
        known = known.groupBy("chunk").agg(F.collect_list(F.struct("place", "id")).alias("k"))
        told = chunks.select("chunk", "lang", "codes").join(known, "chunk").join(parts, "lang")
        told = written(told.select("chunk", "lang", "parts", "codes", F.col("k.place").alias("place"), F.col("k.id").alias("id")), "told")

        tiles = written(told.mapInArrow(_pairs, TILES), "tiles")
        pairs = with_ids(counted(tiles, least), "left", "right").withColumnRenamed("n", "a")
        self.pairs = written(ranked(pairs, "lang", [F.desc("a"), F.col("left"), F.col("right")], "id", "pairs"), "pairs")

        codes = F.array_sort(F.collect_list(F.struct("code", "id")))
        frequent = self.pairs.groupBy(*TILE_KEY).agg(codes.alias("c")).select(*TILE_KEY, F.col("c.code").alias("codes"), F.col("c.id").alias("counts"))
        frequent = frequent.mapInArrow(_packed, "lang string, tile int, high long, part long, codes binary, counts binary")
        both = frequent.withColumn("chunk", F.lit(None).cast("long")).unionByName(tiles.select(*TILE_KEY, "chunk", "codes", F.lit(None).cast("binary").alias("counts")))
        both = both.select(*TILE_KEY, "chunk", "codes", "counts").repartition(*TILE_KEY).sortWithinPartitions(*TILE_KEY, F.asc_nulls_first("chunk"))
        answers = both.mapInArrow(_answered, "chunk long, pairs binary, ids binary")
        answers = answers.groupBy("chunk").agg(F.collect_list(F.struct("pairs", "ids")).alias("p"))
        told = told.join(answers, "chunk").select("chunk", "lang", "parts", "codes", "place", "id", F.col("p.pairs").alias("pairs"), F.col("p.ids").alias("ids"))
        triples = with_ids(counted(told.mapInArrow(_triples, TILES), least), "pair", "right").withColumnRenamed("n", "a")
        self.triples = written(triples.select("lang", "pair", "right", "a"), "triples")

    def scored(self) -> DataFrame:
        """Rows (lang, phrase, a, l, r, n, score, inside): all phrases of two and three words; inside is the count of the most frequent longer phrase that holds it.

        score is floor(1000000 a a / (l r)) of the cut that gives the least, the first of equal ones; products are decimals
        of 38 digits.
        """
        word = self.words.select("lang", "id", "word", "f")
        first = word.withColumnsRenamed({"id": "left", "word": "w1", "f": "f1"})
        second = word.withColumnsRenamed({"id": "right", "word": "w2", "f": "f2"})
        pairs = self.pairs.select("lang", "left", "right", "a", "id").join(first, ["lang", "left"]).join(second, ["lang", "right"])
        pairs = written(pairs, "pairs")
        head = pairs.select("lang", F.col("id").alias("pair"), F.col("right").alias("middle"), "w1", "f1", "w2", F.col("a").alias("a12"))
        third = word.select("lang", F.col("id").alias("right"), F.col("word").alias("w3"), F.col("f").alias("f3"))
        tail = self.pairs.select("lang", F.col("left").alias("middle"), "right", F.col("a").alias("a23"), F.col("id").alias("tail"))
        triples = self.triples.join(head, ["lang", "pair"]).join(third, ["lang", "right"]).join(tail, ["lang", "middle", "right"])
        triples = written(triples, "triples")
        inside = triples.select("lang", F.explode(F.array_distinct(F.array("pair", "tail"))).alias("id"), "a")
        inside = inside.groupBy("lang", "id").agg(F.max("a").alias("inside"))
        two = pairs.join(inside, ["lang", "id"], "left").select(
            "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), score("a", "f1", "f2").alias("score"), "inside"
        )
        at_one, at_two = score("a", "f1", "a23"), score("a", "a12", "f3")
        later = at_two < at_one
        three = triples.select(
            "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
            F.when(later, F.col("a12")).otherwise(F.col("f1")).alias("l"), F.when(later, F.col("f3")).otherwise(F.col("a23")).alias("r"),
            F.least(at_one, at_two).alias("score"), F.lit(None).cast("long").alias("inside"),
        )
        return two.unionByName(three).join(self.totals, "lang")


def score(a: str, left: str, right: str) -> Column:
    wide = lambda c: f"cast({c} as decimal(18, 0))"
    return F.expr(f"({wide(a)} * {wide(a)} * cast(1000000 as decimal(7, 0))) div ({wide(left)} * {wide(right)})")


def collocations(docs: DataFrame, least: int = 10, best: int = 2000, share: int = 50) -> DataFrame:
    """The `best` phrases of each language by score: (lang, rank, phrase, a, l, r, n, score).

    A phrase inside a longer one with at least `share` percent of its count is dropped.
    """
    kept = Phrases(docs, least).scored().where(F.col("inside").isNull() | (100 * F.col("inside") < share * F.col("a")))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # first the best of each of many parts of a language, so that the last ranking meets few rows
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
    kept = kept.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= best)
    placed = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= best)
    return placed.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH pieces AS (
    SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM (
        SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
), words AS (
    SELECT lang, [w FOR w IN regexp_split_to_array(p, '[ \x09]+') IF w <> ''] AS w FROM pieces
), grams AS (
    SELECT lang, k, unnest([array_to_string(list_slice(w, i, i + k - 1), ' ') FOR i IN range(1, len(w) - k + 2)]) AS g
    FROM words, (VALUES (1), (2), (3)) AS sizes(k) WHERE len(w) >= k
), f AS (
    SELECT lang, k, g, count(*) AS a FROM grams GROUP BY lang, k, g
), totals AS (
    SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
    SELECT lang, k, g, a, string_split(g, ' ') AS w FROM f WHERE k > 1 AND a >= 10
), cuts AS (
    SELECT c.lang, c.k, c.g, c.a, j, x.a AS l, y.a AS r, (1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a) AS score
    FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates) c
    JOIN f x ON x.lang = c.lang AND x.k = j AND x.g = array_to_string(list_slice(w, 1, j), ' ')
    JOIN f y ON y.lang = c.lang AND y.k = c.k - j AND y.g = array_to_string(list_slice(w, j + 1, c.k), ' ')
), scored AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1
), covered AS (
    SELECT DISTINCT c.lang, c.g FROM candidates c JOIN (
        SELECT lang, a, unnest([array_to_string(list_slice(w, 1, 2), ' '), array_to_string(list_slice(w, 2, 3), ' ')]) AS g FROM candidates WHERE k = 3
    ) b ON b.lang = c.lang AND b.g = c.g WHERE 100 * b.a >= 50 * c.a
)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.g) AS rank, s.g AS phrase, s.a, s.l, s.r,
    t.n::BIGINT AS n, s.score::BIGINT AS score
FROM scored s JOIN totals t ON t.lang = s.lang
WHERE NOT EXISTS (SELECT 1 FROM covered v WHERE v.lang = s.lang AND v.g = s.g)
QUALIFY rank <= 2000
"""


@query("op12_pair_tiles", SQL)
def op12_pair_tiles(spark, sf_dir):
    """The best collocations of each language over all documents."""
    return collocations(table(spark, sf_dir, "documents"))
