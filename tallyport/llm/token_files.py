"""Documents as token ids in binary blocks: tokenised, coded, written and read back."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyport.llm import token_codec
from tallyport.llm.registry import query
from tallyport.llm.tables import small_batches, table
from tallyport.llm.word_ids import WordIds, encoded_texts
from tallyport.session import scratch

# Ids of a block; one holds whole documents, and more ids only if a single document has them.
BLOCK_IDS = 1 << 20
END = 2


class Words:
    """Ids of single texts by the tokenizer."""

    def __init__(self, path: str):
        self.bulk = WordIds(path, END)

    def ids(self, text: str) -> np.ndarray:
        return self.bulk.ids(pa.array([text], pa.string()))[0][:-1]


def _coded(batches: Iterator[pa.RecordBatch], path: str, end: int) -> Iterator[pa.RecordBatch]:
    words = WordIds(path, end)
    vocabulary = max(words.vocabulary, end + 1)
    part = TaskContext.get().partitionId()
    docs: list[int | None] = []
    held: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    size = block = before = 0

    def flushed() -> pa.RecordBatch:
        payload = token_codec.pack(docs, np.concatenate(counts), np.concatenate(held).astype(np.int64), vocabulary)
        row = [[part], [block], [before], [len(docs)], [size], [payload]]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        return pa.record_batch([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names=BLOCK_NAMES)

    for names, ids, sizes in encoded_texts(batches, words):
        ends = np.append(0, np.cumsum(sizes))
        at = 0
        while at < len(sizes):
            # so many documents fit the block; an empty one takes one whatever its size
            upto = int(np.searchsorted(ends, ends[at] + BLOCK_IDS - size, "right")) - 1
            if not docs:
                upto = max(upto, at + 1)
            elif upto <= at:
                yield flushed()
                before, block = before + size, block + 1
                docs, held, counts, size = [], [], [], 0
                continue
            docs += names[at:upto].to_pylist()
            held.append(ids[ends[at] : ends[upto]])
            counts.append(sizes[at:upto])
            size += int(ends[upto] - ends[at])
            at = upto
    if docs:
        yield flushed()


BLOCK_NAMES = ["part", "block", "before", "n_docs", "n_ids", "payload"]
BLOCKS = "part int, block int, before long, n_docs int, n_ids int, payload binary"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end: int = END) -> None:
    """Writes the ids of all documents, each with `end` behind it, in ascending order of document id.

    Documents are dealt to parts by ranges of their id and ordered in them, null ids first. Each task writes
    the blocks of its part as rows of a Parquet file: part, block, ids before it in the part,
    number of documents and ids, and the coded block with its checksums. A null text is empty. Rows of the
    same id stand together. `tokenizer` is the file of a tokenizer that drops white space, at the same place on all machines.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.repartitionByRange("id").sortWithinPartitions("id")
    rows.mapInArrow(lambda it: _coded(it, tokenizer, end), BLOCKS).write.parquet(path)


def _decoded(batches: Iterator[pa.RecordBatch], digest: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            docs, counts, ids = token_codec.unpack(payload.as_py())
            ends = np.cumsum(counts)
            starts = begin + ends - counts
            own = [ids[e - n : e].astype("<u4") for e, n in zip(ends, counts, strict=True)]
            last = pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64()) if digest else pa.array([x.astype(np.int32) for x in own], pa.list_(pa.int32()))
            yield pa.record_batch(
                [pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), last],
                names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"],
            )


def read_tokens(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids) of written files; with `digest` ids_crc32 for ids.

    start is the number of ids of all documents before. A damaged block raises an error.
    """
    blocks = spark.read.schema(BLOCKS).parquet(path)
    # a row for each part, that is for each task that wrote
    sizes = {r.part: r.n for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    begins, total = [], 0
    for part in sorted(sizes):
        begins.append((part, total))
        total += sizes[part]
    offsets = F.broadcast(spark.createDataFrame(begins, "part int, offset long"))
    placed = blocks.join(offsets, "part").select((F.col("offset") + F.col("before")).alias("begin"), "payload")
    kind = "ids_crc32 long" if digest else "ids array<int>"
    return placed.mapInArrow(lambda it: _decoded(it, digest), f"doc_id long, start long, n_tokens long, {kind}")


@query("op2_token_files")
def op2_token_files(spark, sf_dir):
    """Every document's ids from the written files, as digests."""
    import public_tokenizers

    path = scratch(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(spark, path, digest=True)
