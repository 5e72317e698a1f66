"""Exact n-gram Jaccard join of texts as a metric-space join.

The points are sets of word shingles, the metric is the Jaccard distance. Whole documents are
poor first pivots: two unrelated texts share no shingle, so nearly every text is at distance 1
from every document and a triangle-inequality window would keep them all. The first pivots are
therefore single shingles, which are points of the same space. A text lies at distance 1 - 1/n
from each of its n shingles and at 1 from all others; its Voronoi region is that of its least
frequent shingle, and its window are the further regions which a text within the radius may
have chosen: a text of n shingles must share one of its n - ceil(t n) + 1 least frequent ones
with every partner, whatever the common order of shingles is.

Within a region the pivots are documents. A cell is one pivot and the rest: all distances to
the pivot are computed exactly, those within the radius are links, and linked texts need not
be compared again with one another. Where a cell still holds several components, its members
are dealt to rings of the pivot's distance; two texts can only be linked if their distances to
the pivot differ by no more than the radius (triangle inequality), so each member goes to the
two cells made of its ring and the next or the one before. There the members outside the largest
component are pivots in turn, against all others whose size fits. A cell in which that would be many pairs
is divided by the next shingle that linked members must share, and so on, until no cell holds two
components. Every pair of a cell is thus settled: by a test, by its components being joined
already, or by a bound (triangle inequality, sizes, or the place of the region's shingle).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyport.llm import shingles
from tallyport.llm.bloom import BlockedBloom
from tallyport.llm.cell_join import BLOCK, CROWD, CellJoin, node, short
from tallyport.llm.registry import query
from tallyport.llm.tables import table, written

# Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
# The frequency sketch: counts of shingles by the low bits of their hash, 4 MB whatever the input.
SKETCH = 1 << 20
CHUNK = 1 << 12
# Members of a first cell; a region that may be larger is dealt to several cells.
CELL = 1024
# A row of a region carries size, place and part in one long of 32, 20 and 12 bits.
MOST_PARTS, MOST_PLACES = (1 << 12) - 1, (1 << 20) - 1


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches cut to fewer rows, so that what is made of them stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _described(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """A row for each text (size and name of its set), and at the end the task's shingle counts."""
    counts = np.zeros(SKETCH, np.int64)
    for batch in _parts(batches):
        n, names, held = [], [], []
        for found in shingles.sets((t.as_buffer() if t.is_valid else None for t in batch.column(1)), words):
            n.append(len(found))
            names.append(shingles.fingerprint(found))
            held.append(found)
        if held:
            np.add.at(counts, (np.concatenate(held) & np.uint64(SKETCH - 1)).astype(np.int64), 1)
        yield pa.record_batch(
            [batch.column(0), pa.array(n, pa.int32()), pa.array(names, pa.int64()), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())],
            names=["id", "n", "name", "chunk", "counts"],
        )
    full = [k for k in range(0, SKETCH, CHUNK) if counts[k : k + CHUNK].any()]
    blank = len(full)
    yield pa.record_batch(
        [
            pa.nulls(blank, pa.int64()),
            pa.nulls(blank, pa.int32()),
            pa.nulls(blank, pa.int64()),
            pa.array([k // CHUNK for k in full], pa.int32()),
            pa.array([counts[k : k + CHUNK].tobytes() for k in full], pa.binary()),
        ],
        names=["id", "n", "name", "chunk", "counts"],
    )


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the counts of a chunk over all tasks; memory is bounded by the sketch."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sums[chunk] = sums.get(chunk, 0) + np.frombuffer(counts, np.int64)
    yield pa.record_batch(
        [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["chunk", "counts"]
    )


def _regions(batches: Iterator[pa.RecordBatch], words: int, percent: int, sketch) -> Iterator[pa.RecordBatch]:
    """A row for each region in whose window a text lies, with the shingle's place in the common order.

    A set met again in the task is left out.

    The sketch bounds the texts of a region from above; `part` splits a region that may have
    more than `CELL` of them besides what any counter holds by chance, and is 0 in all others.
    """
    counts = sketch.value
    chance = int(np.median(counts))
    met: set[tuple[int, int]] = set()
    for batch in _parts(batches):
        regions, names, packed = [], [], []
        for found in shingles.sets((t.as_buffer() if t.is_valid else None for t in batch.column(0)), words):
            n = len(found)
            name = shingles.fingerprint(found)
            if not n or (n, name) in met:
                continue
            if len(met) < 50_000:
                met.add((n, name))
            width = n - (percent * n + 99) // 100 + 1
            often = counts[(found & np.uint64(SKETCH - 1)).astype(np.int64)]
            order = np.lexsort((found, often))[:width]
            split = -(-(often[order] - chance) // CELL)
            regions.append(found[order].view(np.int64))
            part = np.where(split > 1, 1 + name % np.clip(split, 1, MOST_PARTS), 0)
            # a place beyond its bits counts as an earlier one, which only leaves more to compare
            place = np.minimum(np.arange(width), MOST_PLACES)
            names.append(name)
            packed.append(n << 32 | place << 12 | part)
        widths = [len(r) for r in regions]
        if widths:
            yield pa.record_batch(
                [
                    pa.array(np.concatenate(regions), pa.int64()),
                    pa.array(np.repeat(np.array(names, np.int64), widths), pa.int64()),
                    pa.array(np.concatenate(packed), pa.int64()),
                ],
                names=["region", "name", "packed"],
            )


def _next_shingles(batches: Iterator[pa.RecordBatch], percent: int, level: int, sketch) -> Iterator[pa.RecordBatch]:
    """For each member of a cell the finer cells of its next shingles; the place leaves out the `level` shared ones before."""
    counts = sketch.value
    for batch in _parts(batches):
        cells, names, sizes, places = [], [], [], []
        for cell, name, n, place, packed in zip(
            *(batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)), batch.column(4), strict=True
        ):
            found = np.frombuffer(packed.as_buffer(), np.uint64)
            order = np.lexsort((found, counts[(found & np.uint64(SKETCH - 1)).astype(np.int64)]))
            at = np.arange(int(place) + level, min(int(n) - (percent * int(n) + 99) // 100 + 1 + level, int(n)))
            cells.append(shingles.mixed(found[order[at]] + shingles.mixed(np.full(len(at), cell, np.int64).view(np.uint64))).view(np.int64))
            names.append(np.full(len(at), name, np.int64))
            sizes.append(np.full(len(at), n, np.int32))
            places.append((at - level).astype(np.int32))
        if cells:
            yield pa.record_batch([pa.array(np.concatenate(c)) for c in (cells, names, sizes, places)], names=["cell", "name", "n", "place"])


def _packed(batches: Iterator[pa.RecordBatch], words: int, pack: Callable[[np.ndarray], bytes]) -> Iterator[pa.RecordBatch]:
    for batch in _parts(batches):
        held = list(shingles.sets((t.as_buffer() if t.is_valid else None for t in batch.column(1)), words))
        yield pa.record_batch(
            [
                batch.column(0),
                pa.array([shingles.fingerprint(s) for s in held], pa.int64()),
                pa.array([len(s) for s in held], pa.int32()),
                pa.array([pack(s) for s in held], pa.binary()),
            ],
            names=["id", "name", "n", "shingles"],
        )


class JaccardJoin:
    """Links between texts whose shingle sets have a Jaccard similarity of `percent` % or more.

    `documents`: rows (id, n, name), one for each input row: the size and the name of its set.
    Equal sets have the same (n, name). A null text, an empty one or one without words has size
    0 and no links. Rows may repeat, ids may be null or repeat; other columns are not read.
    `links`: rows (x, xn, y, yn, shared), verified links between different sets; together they
    connect all sets that any chain of links connects.
    `classes()`: rows (id, n_shingles, component_id), one for each input row; the component is
    the least id that links reach, or the row's own.
    """

    def __init__(
        self,
        docs: DataFrame,
        id_col: str = "doc_id",
        text_col: str = "text",
        words: int = shingles.WORDS,
        percent: int = PERCENT,
        block: int = BLOCK,
        crowd: int = CROWD,
    ):
        self.percent, self.words = percent, words
        self.input = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        described = written(
            self.input.mapInArrow(lambda it: _described(it, words), "id long, n int, name long, chunk int, counts binary"),
            "described",
        )
        self.documents = described.where("chunk is null").select("id", "n", "name")
        self.nodes = self.documents.where("n > 0").groupBy("n", "name").agg(F.min("id").alias("least"))
        self.sketch = self._sketch(described)
        cells = self._first_cells(self.sketch)
        found = CellJoin(
            self._packed_sets, percent, self._finer, block, crowd, fetch_short=lambda nodes: self._packed_sets(nodes, short)
        )
        self.links = found.join(cells)
        self.labels = found.labels

    def _sketch(self, described: DataFrame):
        """Counts of all shingles of all texts by low bits of the hash: of fixed size, sent to all executors."""
        chunks = (
            described.where("chunk is not null")
            .select("chunk", "counts")
            .repartition(SKETCH // CHUNK, "chunk")
            .mapInArrow(_summed, "chunk int, counts binary")
        )
        counts = np.zeros(SKETCH, np.int64)
        for row in chunks.collect():  # SKETCH / CHUNK rows
            counts[row.chunk * CHUNK : (row.chunk + 1) * CHUNK] = np.frombuffer(row["counts"], np.int64)
        return self.input.sparkSession.sparkContext.broadcast(counts)

    def _first_cells(self, sketch) -> DataFrame:
        """Rows (cell, name, n): the regions in which a text may have company."""
        words, percent = self.words, self.percent
        rows = self.input.select("text").mapInArrow(
            lambda it: _regions(it, words, percent, sketch), "region long, name long, packed long"
        )
        part = F.col("packed").bitwiseAND(MOST_PARTS)
        # dealt out first, so that what is computed from a row is not moved with it
        dealt = rows.repartition("region", part).select(
            "region",
            "name",
            F.shiftrightunsigned("packed", 32).cast("int").alias("n"),
            F.shiftrightunsigned("packed", 12).bitwiseAND(MOST_PLACES).cast("int").alias("place"),
            part.alias("part"),
        )
        within = Window.partitionBy("region", "part")
        h = F.xxhash64("n", "name")
        seen = dealt.withColumns(
            {
                "low": F.min(h).over(within),
                "high": F.max(h).over(within),
                "same": F.sum(F.shiftright(h, 32)).over(within),
                "mixed": F.bit_xor(h).over(within),
                "k": F.count("*").over(within),
            }
        )
        # regions with the same members become one cell, with each member's first place; a region in parts stays one
        cell = F.when(F.col("part") == 0, F.xxhash64("low", "high", "same", "mixed", "k")).otherwise(F.col("region"))
        kept = seen.where((F.col("low") != F.col("high")) | (F.col("part") > 0)).select(cell.alias("cell"), "name", "n", "place")
        return written(kept.groupBy("cell", "name", "n").agg(F.min("place").alias("place")), "cells")

    def _finer(self, rows: DataFrame, level: int) -> DataFrame:
        """Crowded cells divided by the next shingle that two members may share.

        Linked sets share ceil(t n) shingles or more, so the one after the `level` first that they share is
        among the n - ceil(t n) + 1 + level first of each set, and behind the cell's own.
        """
        percent, sketch = self.percent, self.sketch
        sets = self._packed_sets(rows.select("n", "name").distinct())
        both = rows.join(sets, ["n", "name"]).select("cell", "name", "n", "place", "shingles")
        return both.mapInArrow(lambda it: _next_shingles(it, percent, level, sketch), "cell long, name long, n int, place int").distinct()

    def _packed_sets(self, nodes: DataFrame, pack: Callable[[np.ndarray], bytes] = np.ndarray.tobytes) -> DataFrame:
        """The sets of these names, made again from one text of each.

        Two filters stand for exact joins, so that no text is moved. A set that passes them in error has a name that nothing
        asks for, or comes twice.
        """
        wanted = written(nodes.join(self.nodes, ["n", "name"]).select("n", "name", F.col("least").alias("wanted")), "wanted")
        likely = BlockedBloom(wanted, F.col("wanted")).pass_through(self.input, F.col("id"))
        words = self.words
        sets = likely.mapInArrow(lambda it: _packed(it, words, pack), "id long, name long, n int, shingles binary")
        named = BlockedBloom(wanted, F.xxhash64("wanted", "n", "name")).pass_through(sets, F.xxhash64("id", "n", "name"))
        return written(named.select("name", "n", "shingles"), "sets")

    def classes(self) -> DataFrame:
        in_class = self.nodes.join(self.labels, ["n", "name"], "left").withColumn("component", F.coalesce("component", node()))
        least = in_class.groupBy("component").agg(F.min("least").alias("component_id"))
        known = in_class.join(least, "component").select("n", "name", "component_id")
        return self.documents.join(known, ["n", "name"], "left").select(
            "id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")
        )


@query(
    "op4_jaccard_join",
    r"""
    with recursive words as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
        from documents
    ), shingles as (
        select distinct doc_id, unnest(case when len(w) = 0 then []::varchar[] when len(w) < 5 then [array_to_string(w, ' ')]
            else list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) end) as shingle
        from words
    ), sizes as (select doc_id, count(*) as n from shingles group by 1),
    shared as (
        select a.doc_id as x, b.doc_id as y, count(*) as c from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2
    ), links as (
        select x, y from shared join sizes a on a.doc_id = x join sizes b on b.doc_id = y where 100 * c >= 75 * (a.n + b.n - c)
    ), both_ways as (select x, y from links union all select y, x from links),
    reached as (
        select doc_id, doc_id as other from documents
        union
        select reached.doc_id, both_ways.y from reached join both_ways on reached.other = both_ways.x
    )
    select r.doc_id, coalesce(any_value(n), 0) as n_shingles, min(other) as component_id
    from reached r left join sizes s on s.doc_id = r.doc_id group by 1
    """,
)
def op4_jaccard_join(spark, sf_dir):
    """Every document with the size of its shingle set and its class."""
    return JaccardJoin(table(spark, sf_dir, "documents")).classes().withColumnRenamed("id", "doc_id")
