"""Documents packed into sequences of a fixed number of tokens, best fit decreasing."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tallyport.llm.registry import query
from tallyport.llm.tables import small_batches, table, written
from tallyport.llm.word_ids import WordIds, encoded_texts

CAPACITY, END = 2048, 0
RANK_BITS = 48
PIECES = "part int, doc_id long, piece int, start long, length int, rank long, ids array<int>"


class OpenBins:
    """Segment tree over remaining capacities: how many open bins have each, and sums of them above."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.sums = [0] * (2 * self.leaves)

    def add(self, remaining: int, bins: int) -> None:
        node = self.leaves + remaining
        while node:
            self.sums[node] += bins
            node //= 2

    def tightest(self, length: int) -> int | None:
        """The least remaining capacity of an open bin that still holds `length`."""
        node = self.leaves + length
        if self.sums[node]:
            return length
        while node > 1 and (node % 2 or not self.sums[node + 1]):  # up, until the right neighbour holds bins
            node //= 2
        if node <= 1:
            return None
        node += 1
        while node < self.leaves:
            node = 2 * node if self.sums[2 * node] else 2 * node + 1
        return node - self.leaves


class Plan:
    """Where the k-th of all documents of a length goes, for all lengths.

    Best fit decreasing takes documents by falling length, and those of one length are alike. What it does
    with all of them is therefore told by the counts of the lengths, at most `capacity` numbers. A step of the plan is a
    run: bins numbered in a row that hold the same take the same number of documents of the length. For a bin
    that was the tightest stays it while it holds another document of that length, one step fills it up. A
    length leaves at most two more kinds of bins than it found, so the plan has a size that the
    capacity bounds, whatever the number of documents; sequences are as many as one by one.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        open_bins, bins = OpenBins(capacity), {}
        runs, self.sequences = [], 0
        for length in sorted(counts, reverse=True):
            left, rank = counts[length], 0
            while left:
                remaining = open_bins.tightest(length)
                if remaining is None:
                    new = -(-left // (capacity // length))
                    remaining, first, n = capacity, self.sequences, new
                    self.sequences += new
                else:
                    first, n = bins[remaining].pop()
                    open_bins.add(remaining, -n)
                each = remaining // length
                full = min(n, left // each)
                over = min(left - full * each, each) if full < n else 0
                parts = [(first, full, each), (first + full, 1 if over else 0, over)]
                for begin, among, take in parts:
                    if among:
                        runs.append((length, rank, take, begin, capacity - remaining))
                        rank, left = rank + among * take, left - among * take
                taken = full + bool(over)
                for begin, among, rest in [(b, a, remaining - t * length) for b, a, t in parts] + [(first + taken, n - taken, remaining)]:
                    if among and rest:
                        bins.setdefault(rest, []).append((begin, among))
                        open_bins.add(rest, among)
        runs.sort()
        columns = np.array(runs, np.int64).reshape(-1, 5).T
        self.length, self.rank, self.each, self.first, self.offset = columns
        self.keys = (self.length << RANK_BITS) | self.rank

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of documents given by their length and their number among those of it."""
        run = np.searchsorted(self.keys, (length << RANK_BITS) | rank, "right") - 1
        k = rank - self.rank[run]
        return self.first[run] + k // self.each[run], self.offset[run] + k % self.each[run] * length


def _cut(batches: Iterator[pa.RecordBatch], path: str, end: int, capacity: int) -> Iterator[pa.RecordBatch]:
    words = WordIds(path, end)
    part = TaskContext.get().partitionId()
    seen = np.zeros(capacity + 1, np.int64)

    def pieces(docs: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        per_doc = -(-sizes // capacity)
        doc = np.repeat(np.arange(len(sizes)), per_doc)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
        length = np.minimum(sizes[doc] - piece * capacity, capacity)
        # the number of each piece among all of its length in this task
        order = np.argsort(length, kind="stable")
        ordered = length[order]
        rank = np.empty(len(doc), np.int64)
        rank[order] = np.arange(len(doc)) - np.searchsorted(ordered, ordered) + seen[ordered]
        np.add.at(seen, length, 1)
        bounds = np.append(0, np.cumsum(length)).astype(np.int32)
        return pa.record_batch(
            [pa.array(np.full(len(doc), part, np.int32)), docs.take(pa.array(doc)), pa.array(piece.astype(np.int32)),
             pa.array(piece * capacity), pa.array(length.astype(np.int32)), pa.array(rank),
             pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids))],
            names=["part", "doc_id", "piece", "start", "length", "rank", "ids"],
        )

    for docs, ids, sizes in encoded_texts(batches, words):
        yield pieces(docs, ids, sizes)


def _placed(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index
        length = batch.column(at("length")).to_numpy(zero_copy_only=False).astype(np.int64)
        sequence, offset = plan.places(length, batch.column(at("rank")).to_numpy(zero_copy_only=False))
        rest = [k for k, name in enumerate(batch.schema.names) if name not in ("rank", "part")]
        yield pa.record_batch(
            [*[batch.column(k) for k in rest], pa.array(sequence), pa.array(offset)],
            names=[*[batch.schema.names[k] for k in rest], "sequence_id", "offset"],
        )


class Packing:
    """Documents as pieces of at most `capacity` tokens, and the sequences that hold them.

    `pieces` are the written rows (part, doc_id, piece, start, length, rank, ids): the ids of a document with `end`
    behind them, cut only where it has more than `capacity`. A null text is empty, rows of the same id are documents of
    their own, a null id is kept. The only table that meets the driver has a row for each length, at most
    `capacity`; ids are not moved to be placed. `tokenizer` is the file of a tokenizer that `WordIds` fits,
    at the same place on all machines.
    """

    def __init__(
        self, docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END,
        id_col: str = "doc_id", text_col: str = "text",
    ):
        small_batches(docs.sparkSession)
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        self.pieces = written(rows.mapInArrow(lambda it: _cut(it, tokenizer, end, capacity), PIECES), "pieces")
        per_part = self.pieces.groupBy("part", "length").agg((F.max("rank") + 1).alias("n"))
        self.counts = written(per_part, "lengths")
        totals = self.counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
        self.plan = Plan({r.length: r.n for r in totals}, capacity)

    def placed(self, pieces: DataFrame) -> DataFrame:
        """Adds sequence_id (from 0, without gaps) and offset in it to rows derived from `pieces`; part and rank go."""
        before = self.counts.select(
            F.col("part").alias("_part"),
            F.col("length").alias("_length"),
            (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("_before"),
        )
        same = (F.col("part") == F.col("_part")) & (F.col("length") == F.col("_length"))
        ranked = pieces.join(before, same).withColumn("rank", F.col("rank") + F.col("_before")).drop("_part", "_length", "_before")
        plan = self.plan
        kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name not in ("rank", "part")]
        schema = ", ".join([*kept, "sequence_id long", "offset long"])
        return ranked.mapInArrow(lambda it: _placed(it, plan), schema)

    def sequences(self) -> DataFrame:
        """Rows (sequence_id, length, ids) of the packed sequences."""
        parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
        packed = self.placed(self.pieces).groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts"))
        return packed.select("sequence_id", "length", F.flatten("parts.ids").alias("ids"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(batch.num_columns - 1)
        flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        ends = np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))
        crcs = [zlib.crc32(flat[b:e]) for b, e in zip(np.append(0, ends[:-1]), ends, strict=True)]
        yield pa.record_batch([*batch.columns[:-1], pa.array(crcs, pa.int64())], names=[*batch.schema.names[:-1], "ids_crc32"])


@query("op13_best_fit_packing")
def op13_best_fit_packing(spark, sf_dir):
    """Every piece of every document with its place, its ids as a digest."""
    import public_tokenizers

    packing = Packing(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    digests = packing.pieces.mapInArrow(_digests, PIECES.replace("ids array<int>", "ids_crc32 long"))
    return packing.placed(digests).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset"
    )
