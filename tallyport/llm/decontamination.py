"""Documents that hold benchmark items, up to a budget of edits: pieces by pigeonhole, then Myers."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tallyport.llm.registry import query
from tallyport.llm.tables import small_batches, table

# Edits allowed for each byte of an item; the budget is rounded down.
EDIT_RATE = 0.05
# Items of fewer bytes are looked for without edits, as whole words.
MIN_BYTES = 40
# Bytes of items that are searched together and sent to the executors.
BLOCK_BYTES = 4 << 20


def plain(text: bytes) -> bytes:
    """A-Z as a-z and white space as one space: what is compared."""
    return b" ".join(text.lower().split())


def budget(item: bytes, rate: float = EDIT_RATE) -> int:
    return int(len(item) * rate)


def inside_word(text: bytes, at: int) -> bool:
    """Whether the place lies between two bytes of one word: ASCII letters, digits and all bytes of other letters."""
    return 0 < at < len(text) and all(b >= 128 or chr(b).isalnum() for b in text[at - 1 : at + 1])


def pieces(item: bytes, edits: int) -> list[tuple[int, bytes]]:
    """`edits` + 1 pieces with their places; a text within that many edits holds one unchanged."""
    cuts = [len(item) * k // (edits + 1) for k in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Pattern:
    """Myers' bit-parallel comparison of one item with texts; one bit for each of its bytes."""

    def __init__(self, item: bytes):
        self.size = len(item)
        self.full = (1 << self.size) - 1
        self.top = 1 << (self.size - 1)
        self.places: dict[int, int] = {}
        for k, byte in enumerate(item):
            self.places[byte] = self.places.get(byte, 0) | 1 << k

    def nearest(self, text: bytes) -> tuple[int, int]:
        """The least edit distance to a substring of `text`, and the end of the first such one."""
        up, down, score = self.full, 0, self.size
        best, end = score, 0
        get, full, top = self.places.get, self.full, self.top
        for k, byte in enumerate(text, 1):
            equal = get(byte, 0)
            across = (((equal & up) + up) ^ up) | equal
            more = down | (full & ~(across | up))
            less = up & across
            if more & top:
                score += 1
            elif less & top:
                score -= 1
                if score < best:
                    best, end = score, k
            turned = equal | down
            more <<= 1
            up = ((less << 1) | ~(turned | more)) & full
            down = more & turned & full
        return best, end


class Finder:
    """All items of one block: an automaton over their pieces."""

    def __init__(self, items: list[tuple[int | None, bytes]], rate: float):
        self.items = [(i, text, budget(text, rate) if len(text) >= MIN_BYTES else 0) for i, text in items]
        self.patterns: dict[int, Pattern] = {}
        self.automaton = ahocorasick.Automaton()
        places: dict[bytes, list[tuple[int, int]]] = {}
        for k, (_, text, edits) in enumerate(self.items):
            for at, piece in pieces(text, edits):
                places.setdefault(piece, []).append((k, at))
        for piece, of in places.items():
            self.automaton.add_word(piece.decode("latin-1"), (len(piece), of))
        self.automaton.make_automaton()

    def found(self, text: bytes) -> dict[int, tuple[int, int]]:
        """Number of each item within its budget: (edits, end of the place in the plain text)."""
        out: dict[int, tuple[int, int]] = {}
        # of each item, the windows around its hits; those that meet are one
        windows: dict[int, list[list[int]]] = {}
        for last, (size, of) in self.automaton.iter(text.decode("latin-1")):
            for k, at in of:
                _, item, edits = self.items[k]
                start = last + 1 - size - at
                if len(item) < MIN_BYTES:
                    if k not in out and not inside_word(text, start) and not inside_word(text, last + 1):
                        out[k] = (0, last + 1)
                    continue
                low, high = max(0, start - 2 * edits), max(0, start + len(item) + 2 * edits)
                near = windows.setdefault(k, [])
                if near and low <= near[-1][1] and near[-1][0] <= high:
                    near[-1] = [min(near[-1][0], low), max(near[-1][1], high)]
                else:
                    near.append([low, high])
        for k, near in windows.items():
            _, item, edits = self.items[k]
            if k not in self.patterns:
                self.patterns[k] = Pattern(item)
            near.sort()
            merged = near[:1]
            for low, high in near[1:]:
                if low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                else:
                    merged.append([low, high])
            for low, high in merged:
                best, end = self.patterns[k].nearest(text[low:high])
                if best <= edits and (best, low + end) < out.get(k, (edits + 1, 0)):
                    out[k] = (best, low + end)
        return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> list[list[tuple[int, bytes]]]:
    """The items in blocks of a bounded size; one that is larger than a block stands alone."""
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).where(
        "t is not null"
    ).distinct()  # rows that repeat would never part
    n = 1
    while True:
        sized = items.withColumn("block", F.pmod(F.xxhash64("i", "t"), F.lit(n)).cast("int"))
        sizes = sized.groupBy("block").agg(F.sum(F.octet_length("t")).alias("size"), F.count("*").alias("items"))
        if sizes.where((F.col("size") > BLOCK_BYTES) & (F.col("items") > 1)).isEmpty():
            break
        n *= 2
    for block in range(n):
        rows = [(r.i, plain(r.t.encode())) for r in sized.where(F.col("block") == block).select("i", "t").distinct().collect()]
        yield sorted(((i, t) for i, t in rows if t), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def _scanned(batches: Iterator[pa.RecordBatch], sent, rate: float, at: int, clean: bool) -> Iterator[pa.RecordBatch]:
    finder = Finder(sent.value, rate) if sent.value else None
    for batch in batches:
        found = []
        for row, text in enumerate(batch.column(at).cast(pa.string())):
            hits = finder.found(plain(text.as_buffer().to_pybytes())) if finder and text.is_valid else {}
            found.append(hits)
        if clean:
            yield batch.filter(pa.array([not hits for hits in found], pa.bool_()))
        else:
            rows = [(row, sent.value[k][0], *hit) for row, hits in enumerate(found) for k, hit in hits.items()]
            yield pa.record_batch(
                [
                    pc.take(batch.column(0), pa.array([r[0] for r in rows], pa.int64())),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.int32()),
                    pa.array([r[3] for r in rows], pa.int64()),
                ],
                names=["doc_id", "item_id", "edits", "at"],
            )


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", rate: float = EDIT_RATE
) -> DataFrame:
    """Rows (doc_id, item_id, edits, end_at): items that stand in a document within their budget.

    Case of A-Z and the amount of white space don't count; an item of n bytes may differ by
    rate * n edits, one of less than `MIN_BYTES` bytes by none, and then it must begin and end at the
    ends of words. edits is the least distance to any part of the document, end_at the byte
    of its plain form where the first such part ends. Items and documents without
    text have no rows; a repeated row of documents has its own rows; ids of both may be null, and an item
    without an id is told apart by its text. The items are searched in blocks of bounded size, each
    against all documents.
    """
    small_batches(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for block in _blocks(benchmark, item_col, "text"):
        sent = sc.broadcast(block)
        part = narrow.mapInArrow(lambda it, s=sent: _scanned(it, s, rate, 1, False), "doc_id long, item_id long, edits int, at long")
        out = part if out is None else out.unionByName(part)
    return out.withColumnRenamed("at", "end_at")


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", rate: float = EDIT_RATE) -> DataFrame:
    """The documents that hold no item, with all their columns; those without text stay."""
    small_batches(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    at = docs.columns.index(text_col)
    for block in _blocks(benchmark, item_col, "text"):
        sent = sc.broadcast(block)
        docs = docs.mapInArrow(lambda it, s=sent: _scanned(it, s, rate, at, True), docs.schema)
    return docs


@query("op9_decontamination")
def op9_decontamination(spark, sf_dir):
    """Every benchmark item that a document holds, over all documents."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
