"""Repeated paragraphs across documents: MinHash bands, exact Jaccard, removal by components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyport.llm import passages, shingles
from tallyport.llm.bloom import BlockedBloom
from tallyport.llm.cell_join import CellJoin, node
from tallyport.llm.registry import query
from tallyport.llm.tables import table, written

PERCENT = 75
# Lines of fewer words are not paragraphs: they repeat by chance.
MIN_WORDS = 8
# Share of the pairs at the threshold that the bands must bring together.
RECALL = 0.999
ROWS = 2
# Paragraphs of a cell outside its largest component; more of them are banded again, by so many values in a band.
CROWD = 64
FINER_ROWS = (8, 12, 16)
# Pairs of a cell that are compared before it counts as crowded too.
MOST_PAIRS = CROWD * CROWD


def tuned(threshold: float, recall: float = RECALL, rows: int = ROWS) -> int:
    """The least number of bands of `rows` values that gives this recall at the threshold."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - threshold**rows)))


def _multipliers(n: int, level: int = 0) -> np.ndarray:
    return np.random.default_rng(97 + level).integers(1, 2**62, n, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def paragraphs(texts: list[bytes], min_words: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Text number, line number and bytes of all lines of `min_words` words or more."""
    of, number, lines = [], [], []
    for k, text in enumerate(texts):
        for at, line in enumerate(text.split(b"\n")):
            if len(line) >= 2 * min_words - 1 and len(line.split()) >= min_words:
                of.append(k)
                number.append(at)
                lines.append(line)
    return np.array(of, np.int64), np.array(number, np.int32), lines


def described(lines: list[bytes], bands: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Set size, set name and band keys of each line; every line has a word."""
    found, counts = shingles.runs(lines)
    line = np.repeat(np.arange(len(lines)), counts)
    order = np.argsort(found)
    order = order[np.argsort(line[order], kind="stable")]
    found, line = found[order], line[order]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:] != found[:-1]) | (line[1:] != line[:-1])
    found, line = found[fresh], line[fresh]
    starts = np.searchsorted(line, np.arange(len(lines)))
    sizes = np.diff(np.append(starts, len(found))).astype(np.int32)
    names = np.add.reduceat(shingles.mixed(found * np.uint64(0x9E3779B97F4A7C15)), starts).view(np.int64)
    keys = np.empty((len(lines), bands), np.uint64)
    factors = _multipliers(bands * rows)
    for band in range(bands):
        key = np.full(len(lines), band, np.uint64)
        for k in range(rows):
            least = np.minimum.reduceat(shingles.mixed(found * factors[band * rows + k]), starts)
            key = shingles.mixed(key + least * np.uint64(2 * k + 3))
        keys[:, band] = key
    return sizes, names, keys.view(np.int64)


def _pieces(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _signed(batches: Iterator[pa.RecordBatch], min_words: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    """A row (doc, paragraph, n, name, keys) for each paragraph, and one with paragraph -1 for each document."""
    for batch in _pieces(batches):
        ids = batch.column(0)
        texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column(1)]
        blank = len(ids)
        yield pa.record_batch(
            [ids, pa.array([-1] * blank, pa.int32()), pa.array([0] * blank, pa.int32()), pa.nulls(blank, pa.int64()), pa.nulls(blank, pa.list_(pa.int64()))],
            names=["doc", "paragraph", "n", "name", "keys"],
        )
        of, number, lines = paragraphs(texts, min_words)
        at = 0
        while at < len(lines):
            end, size = at, 0
            while end < len(lines) and (end == at or size + len(lines[end]) < shingles.SLICE) and end - at < 60_000:
                size += len(lines[end])
                end += 1
            sizes, names, keys = described(lines[at:end], bands, rows)
            flat = pa.array(keys.reshape(-1))
            yield pa.record_batch(
                [
                    ids.take(pa.array(of[at:end])),
                    pa.array(number[at:end]),
                    pa.array(sizes),
                    pa.array(names),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, bands), pa.int32()), flat),
                ],
                names=["doc", "paragraph", "n", "name", "keys"],
            )
            at = end


def _sets(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """The shingle sets of the wanted lines of each text."""
    for batch in _pieces(batches):
        names, sizes, packed = [], [], []
        for text, wanted in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            lines = text.as_buffer().to_pybytes().split(b"\n") if text.is_valid else []
            for found in shingles.sets(lines[k] for k in wanted if k < len(lines)):
                names.append(shingles.fingerprint(found))
                sizes.append(len(found))
                packed.append(found.tobytes())
        yield pa.record_batch(
            [pa.array(names, pa.int64()), pa.array(sizes, pa.int32()), pa.array(packed, pa.binary())], names=["name", "n", "shingles"]
        )


def _banded(batches: Iterator[pa.RecordBatch], bands: int, rows: int, level: int) -> Iterator[pa.RecordBatch]:
    """The finer cells of each set: bands of values that no level before has used."""
    factors = _multipliers(bands * rows, level)
    for batch in _pieces(batches):
        held = [np.frombuffer(packed.as_buffer(), np.uint64) for packed in batch.column(2)]
        if not held:
            continue
        starts = np.concatenate([[0], np.cumsum([len(h) for h in held])[:-1]]).astype(np.int64)
        found = np.concatenate(held)
        keys = []
        for band in range(bands):
            key = np.full(len(held), level << 32 | band, np.uint64)
            for k in range(rows):
                least = np.minimum.reduceat(shingles.mixed(found * factors[band * rows + k]), starts)
                key = shingles.mixed(key + least * np.uint64(2 * k + 3))
            keys.append(key.view(np.int64))
        yield pa.record_batch(
            [pa.array(np.concatenate(keys)), *(pa.concat_arrays([batch.column(c)] * bands) for c in (0, 1))], names=["cell", "name", "n"]
        )


def _several(banded: DataFrame, name: str) -> DataFrame:
    """Rows (cell, name, n, place) of cells that hold several sets."""
    # 32 bits tell the names of a cell apart, as far as its recall goes, and take less room
    short = F.hash("name")
    several = banded.groupBy("cell").agg(F.min(short).alias("lo"), F.max(short).alias("hi")).where("lo != hi").select("cell")
    several = written(several, name)
    likely = BlockedBloom(several, F.col("cell")).pass_through(banded, F.col("cell"))
    kept = likely.distinct().join(several, "cell", "left_semi")
    return kept.select("cell", "name", "n", F.lit(0).alias("place"))


def _rebanded(crowds: DataFrame, fetch: Callable[[DataFrame], DataFrame], percent: int, recall: float, level: int) -> DataFrame:
    """The members of crowded cells in bands of more values, found with the same recall.

    Members that share several crowded cells meet again once: the finer cells are the bands' own.
    """
    rows = FINER_ROWS[level - 1]
    bands = tuned(percent / 100, recall, rows)
    sets = fetch(crowds.select("n", "name").distinct()).select("name", "n", "shingles")
    finer = sets.mapInArrow(lambda it: _banded(it, bands, rows, level), "cell long, name long, n int")
    return _several(written(finer, "finer_bands"), "finer_several")


class ParagraphDedup:
    """Paragraphs that repeat, exactly or nearly, in a table of documents.

    A paragraph is a line of at least `min_words` words; its set are its distinct five-word shingles with
    A-Z as a-z. Paragraphs are linked if their sets have a Jaccard similarity of `percent` %
    or more: equal sets always, others if they share a MinHash band (the number of bands follows from
    `recall`) and pass the exact comparison. Of each component the first paragraph, by document id
    and line number, stays, and all others are removed.

    Then passages are removed that stand inside longer or differently broken lines: stretches of
    `passages.MIN_PASSAGE` words or more that repeat, exactly or at `percent` %, what stands at an earlier place.

    `removals`: rows (doc, paragraph, first_doc, first_paragraph), one for each removed paragraph.
    `passages`: rows (doc, start, end, first_doc), the bytes of each passage that is removed besides.
    `documents()`: rows (doc_id, n_paragraphs, removed, kept_in, spans), one for each id: the numbers of the
    removed lines in order, the documents that keep their like, and the merged passages (start, end). A null or empty text has no
    paragraphs. Rows of the same id count as one document, a line number being one place; a null id is an id that comes
    first. Other columns are not read.
    """

    def __init__(
        self,
        docs: DataFrame,
        id_col: str = "doc_id",
        text_col: str = "text",
        percent: int = PERCENT,
        min_words: int = MIN_WORDS,
        recall: float = RECALL,
    ):
        bands, rows = tuned(percent / 100, recall), ROWS
        self.input = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
        schema = "doc long, paragraph int, n int, name long, keys array<long>"
        self.rows = written(self.input.mapInArrow(lambda it: _signed(it, min_words, bands, rows), schema), "paragraphs")
        self.places = self.rows.where("paragraph >= 0").select("doc", "paragraph", "n", "name")
        place = F.struct("doc", "paragraph")
        self.nodes = written(self.places.groupBy("n", "name").agg(F.min(place).alias("first"), F.count("*").alias("times")), "nodes")
        cells = self._cells()
        fetch = lambda nodes: self._wanted_sets(nodes, min_words)
        finer = lambda crowds, level: _rebanded(crowds, fetch, percent, recall, level)
        found = CellJoin(fetch, percent, finer, crowd=CROWD, turns=0, levels=len(FINER_ROWS), most_pairs=MOST_PAIRS)
        self.links = found.join(cells)
        self.removals = self._removals(found.labels)
        self.passages = passages.passages(self.input, self.removals, percent)

    def _cells(self) -> DataFrame:
        """Rows (cell, name, n, place) of bands that hold several sets."""
        banded = self.rows.where("paragraph >= 0").select(F.explode("keys").alias("cell"), "name", "n")
        return written(_several(banded, "bands"), "cells")

    def _wanted_sets(self, nodes: DataFrame, min_words: int) -> DataFrame:
        wanted = nodes.join(self.nodes, ["n", "name"]).select("first.doc", "first.paragraph")
        # lines of one document: no more than it has
        wanted = written(wanted.groupBy("doc").agg(F.collect_list("paragraph").alias("lines")), "wanted")
        likely = BlockedBloom(wanted, F.col("doc")).pass_through(self.input, F.col("doc"))
        texts = likely.join(wanted.select(F.col("doc").alias("of"), "lines"), F.col("doc").eqNullSafe(F.col("of")))
        schema = "name long, n int, shingles binary"
        return written(texts.select("text", "lines").mapInArrow(lambda it: _sets(it, min_words), schema), "sets")

    def _removals(self, labels: DataFrame) -> DataFrame:
        known = self.nodes.join(labels, ["n", "name"], "left")
        # only sets that are linked or occur several times matter from here on
        known = known.where("times > 1 or component is not null").withColumn("component", F.coalesce("component", node()))
        first = known.groupBy("component").agg(F.min("first").alias("keep"))
        keep = written(known.join(first, "component").select("n", "name", "keep"), "keepers")
        likely = BlockedBloom(keep, F.xxhash64("n", "name")).pass_through(self.places, F.xxhash64("n", "name"))
        gone = likely.join(keep, ["n", "name"]).where(~F.struct("doc", "paragraph").eqNullSafe(F.col("keep")))
        return written(
            gone.select("doc", "paragraph", F.col("keep.doc").alias("first_doc"), F.col("keep.paragraph").alias("first_paragraph")), "removals"
        )

    def documents(self) -> DataFrame:
        gone = self.removals.groupBy("doc").agg(
            F.sort_array(F.collect_set("paragraph")).alias("removed"), F.sort_array(F.collect_set("first_doc")).alias("kept_in")
        )
        all_docs = self.rows.groupBy("doc").agg(F.countDistinct(F.when(F.col("paragraph") >= 0, F.col("paragraph"))).alias("n_paragraphs"))
        gone = gone.withColumnRenamed("doc", "of")
        cut = passages.merged(self.passages).select(F.col("doc").alias("from"), "spans", F.col("kept_in").alias("kept"))
        none = F.array()
        joined = all_docs.join(gone, F.col("doc").eqNullSafe(F.col("of")), "left").join(cut, F.col("doc").eqNullSafe(F.col("from")), "left")
        kept = [F.coalesce(c, none.cast("array<long>")) for c in ("kept_in", "kept")]
        return joined.select(
            F.col("doc").alias("doc_id"),
            "n_paragraphs",
            F.coalesce("removed", none.cast("array<int>")).alias("removed"),
            F.sort_array(F.array_union(*kept)).alias("kept_in"),
            F.coalesce("spans", none.cast("array<struct<start:int,end:int>>")).alias("spans"),
        )


def without_lines(docs: DataFrame, documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the removed lines of `documents` (from `ParagraphDedup.documents`) taken out of their text."""
    gone = documents.select(F.col("doc_id").alias("__of"), F.col("removed").alias("__gone")).where(F.size("__gone") > 0)
    joined = docs.join(gone, F.col(id_col).cast("long").eqNullSafe(F.col("__of")), "left")
    lines = F.split(F.col(text_col), "\n", -1)
    kept = F.filter(lines, lambda line, k: ~F.array_contains(F.col("__gone"), k))
    return joined.withColumn(text_col, F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))).drop("__of", "__gone")


def _shortened(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """Takes the lines and bytes of the last two columns out of the text."""
    for batch in batches:
        texts = []
        for text, lines, spans in zip(batch.column(at), batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1), strict=True):
            lines, spans = lines.as_py(), spans.as_py()
            if not text.is_valid or not (lines or spans):
                texts.append(text.as_py())
                continue
            raw = text.as_buffer().to_pybytes()
            cuts = [(s["start"], s["end"]) for s in spans or ()]
            begin, starts = 0, []
            for line in raw.split(b"\n"):
                starts.append(begin)
                begin += len(line) + 1
            starts.append(begin)
            # a line goes with its break; the last one with that before it
            cuts += [(starts[k] - (k == len(starts) - 2), starts[k + 1]) for k in lines or () if k < len(starts) - 1]
            kept, end = [], 0
            for a, b in sorted(cuts):
                kept.append(raw[end : max(a, end)])
                end = max(end, b)
            texts.append(b"".join([*kept, raw[end:]]).decode())
        columns = batch.columns[:-2]
        columns[at] = pa.array(texts, batch.schema.field(at).type)
        yield pa.record_batch(columns, names=batch.schema.names[:-2])


def without_repeats(docs: DataFrame, documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the removed lines and passages of `documents` (from `ParagraphDedup.documents`) taken out of their text."""
    gone = documents.where((F.size("removed") > 0) | (F.size("spans") > 0)).select(
        F.col("doc_id").alias("__of"), F.col("removed").alias("__gone"), F.col("spans").alias("__spans")
    )
    docs = docs.withColumn(text_col, F.col(text_col).cast("string"))
    joined = docs.join(gone, F.col(id_col).cast("long").eqNullSafe(F.col("__of")), "left").drop("__of")
    at = docs.columns.index(text_col)
    return joined.mapInArrow(lambda it: _shortened(it, at), docs.schema)


@query("op8_paragraph_dedup")
def op8_paragraph_dedup(spark, sf_dir):
    """Every document with the paragraphs and passages that it repeats from others or from itself."""
    found = ParagraphDedup(table(spark, sf_dir, "documents")).documents()
    return found.withColumns({"n_removed": F.size("removed"), "n_spans": F.size("spans")})
