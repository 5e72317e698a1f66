"""Long repeated strings across documents by run-length indexes over a distributed selection.

The text that can hold a repeat is selected first. Of each window of `length` bytes one gram
is the anchor: that with the least hash. Equal windows have equal anchors, so a window whose
anchor occurs once has no copy. For anchors that occur several times the stretch of text around
them is kept (the windows that chose the anchor), equal stretches once with their number.

Stretches with the same anchor hash come to one bucket. There a Burrows-Wheeler transform of all
its stretches is built (suffixes sorted by prefix doubling), compressed to runs, and sampled at the
ends of its runs. The samples give the longest match of each suffix with another one: at the
ends of a run it is computed, inside a run it is one less than that of the position before. A
position with a match of `length` bytes starts a repeated window.

Anchors with very many different stretches do not go to a bucket: blocks of their windows are told
apart by 128-bit hashes and counted by grouped aggregation, which has no hot group. Blocks that repeat in part are divided.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyport.llm import shingles
from tallyport.llm.bloom import BlockedBloom
from tallyport.llm.registry import query
from tallyport.llm.tables import table, written

LENGTH = 400
# Bytes of a gram.
GRAM = 24
# Bytes of the different stretches of an anchor that may go to one index; more are counted by windows.
CROWD_BYTES = 1 << 18
# Bytes of stretches that are indexed together at most, unless one anchor has more.
INDEX_BYTES = 1 << 19
# Windows of a block of a crowded anchor, from the first division to the last.
BLOCKS = (48, 8, 1)
# Bytes of text whose anchors are found at once; the pieces of a long text overlap.
PIECE = 1 << 20
# Bits for a place in a piece; a piece with a window more must be shorter than 2^21 bytes.
PLACE_BITS = 21
U = np.uint64

_ODD = shingles._BYTES.copy()
_ODD[shingles._SPACE] = np.arange(3, 15, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of each string of `size` bytes, by doubling; equal strings have equal hashes."""
    held, width, out, done = _ODD[data], 1, None, 0
    while True:
        if size & width:
            if out is None:
                out = held.copy()
            else:
                n = len(data) - done - width + 1
                out = out[:n] * np.uint64(0xD6E8FEB86659FD93 + 2 * width) + held[done : done + n]
            done += width
        if 2 * width > size:
            return shingles.mixed(out)
        n = len(held) - width
        held = held[:n] * np.uint64(0x9E3779B97F4A7C15 + 4 * width) + held[width : width + n]
        width *= 2


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value of each window of `width` values; by 43 bits, the leftmost of equal ones."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    mask = U((1 << PLACE_BITS) - 1)
    values = (values & ~mask) | np.arange(len(values), dtype=np.uint64)
    # blocks of the window's width: the minimum is that of a suffix of one block and a prefix of the next
    pad = -len(values) % width
    blocks = np.concatenate((values, np.full(pad, ~U(0)))).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return (np.minimum(back[:n], ahead[width - 1 : width - 1 + n]) & mask).astype(np.int64)


def anchors(text: bytes, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Rows (hash, place, first window, last window) of the anchors of a text."""
    out = [np.empty((0, 4), np.int64)]
    step = max(PIECE, 2 * length)
    for at in range(0, max(1, len(text) - length + 1), step):
        data = np.frombuffer(text[at : at + step + length - 1], np.uint8)
        if len(data) < length:
            break
        hashes = rolling(data, gram)
        places = least_in_windows(hashes, length - gram + 1)
        cut = np.flatnonzero(np.diff(places)) + 1
        firsts, lasts = np.append(0, cut), np.append(cut, len(places)) - 1
        p = places[firsts]
        out.append(np.stack((hashes[p].view(np.int64), at + p, at + firsts, at + lasts), axis=1))
    return np.concatenate(out)


def _listed(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """A row (id, h, anchor, first, last) for each anchor."""
    for batch in batches:
        for piece in range(0, batch.num_rows, 512):
            part = batch.slice(piece, 512)
            of, rows = [], []
            for k, text in enumerate(part.column(2)):
                found = anchors(text.as_buffer().to_pybytes(), length) if text.is_valid else np.empty((0, 4), np.int64)
                of.append(np.full(len(found), k))
                rows.append(found)
            flat, of = np.concatenate(rows), np.concatenate(of)
            yield pa.record_batch(
                [*(part.column(c).take(pa.array(of, pa.int64())) for c in (0, 1)), *(pa.array(flat[:, c]) for c in (0, 2, 3))],
                names=["id", "h", "anchor", "first", "last"],
            )


def _stretched(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """For the wanted anchors of each text the stretch of bytes that its windows cover."""
    for batch in batches:
        for piece in range(0, batch.num_rows, 256):
            part = batch.slice(piece, 256)
            of, anchor, first, stretch = [], [], [], []
            for k, (text, spots) in enumerate(zip(part.column(2), part.column(3).to_pylist(), strict=True)):
                raw = text.as_buffer().to_pybytes()
                for spot in spots:
                    of.append(k)
                    anchor.append(spot["anchor"])
                    first.append(spot["first"])
                    stretch.append(raw[spot["first"] : spot["last"] + length])
            yield pa.record_batch(
                [
                    *(part.column(c).take(pa.array(of, pa.int64())) for c in (0, 1)),
                    pa.array(anchor, pa.int64()), pa.array(first, pa.int64()), pa.array(stretch, pa.binary()),
                ],
                names=["id", "h", "anchor", "first", "stretch"],
            )


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by doubling the compared length; `codes` are small numbers, at most 2^20 of them."""
    n = len(codes)
    place = np.arange(n, dtype=np.uint64)
    bits = np.uint64(20)
    # at first as many codes as 44 bits hold
    different, wide = np.unique(codes, return_inverse=True)
    each = max(1, int(len(different)).bit_length())
    width = 44 // each
    wide = wide.astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(width):
        key <<= np.uint64(each)
        key[: n - k] |= wide[k:]
    ranks = None
    while True:
        packed = np.sort((key << bits) | place)
        order = (packed & np.uint64((1 << 20) - 1)).astype(np.int64)
        sorted_keys = packed >> bits
        fresh = np.ones(n, bool)
        fresh[1:] = sorted_keys[1:] != sorted_keys[:-1]
        ranks = np.empty(n, np.uint64)
        ranks[order] = np.cumsum(fresh).astype(np.uint64)
        if fresh.all():
            return order
        key = ranks << bits
        key[: n - width] |= ranks[width:]
        width *= 2


class RunLengthIndex:
    """The run-compressed Burrows-Wheeler transform of several strings, sampled at the ends of its runs.

    Each string ends in a sign of its own kind: no match goes beyond the end of a string.
    """

    def __init__(self, strings: list[bytes]):
        lengths = np.array([len(s) for s in strings], np.int64)
        self.starts = np.cumsum(lengths + 1) - lengths - 1
        n = int((lengths + 1).sum())
        codes = np.zeros(n, np.uint16)
        inside = np.ones(n, bool)
        self.ends = self.starts + lengths
        inside[self.ends] = False
        codes[inside] = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint16) + 1
        self.codes = codes
        # bytes left in the string from each position
        self.left = np.repeat(self.ends, lengths + 1) - np.arange(n)
        order = suffix_array(codes)
        before = np.where(order > 0, codes[order - 1], 0)
        # a string's first byte has nothing before it: it ends a run on both sides
        heads = np.ones(n, bool)
        heads[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
        runs = np.flatnonzero(heads)
        self.symbols = before[runs]
        self.run_starts = order[runs]
        self.run_ends = order[np.append(runs[1:], n) - 1]
        # neighbours of the samples in the order of suffixes
        self.above = order[np.maximum(runs - 1, 0)]
        self.below = order[np.minimum(np.append(runs[1:], n), n - 1)]

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of pairs of suffixes within their strings."""
        limit = np.where(a == b, 0, np.minimum(self.left[a], self.left[b]))
        out = np.zeros(len(a), np.int64)
        alive = np.flatnonzero(limit > 0)
        at = 0
        while len(alive):
            width = 16
            spans = np.arange(width)
            x = np.minimum(a[alive, None] + at + spans, len(self.codes) - 1)
            y = np.minimum(b[alive, None] + at + spans, len(self.codes) - 1)
            differ = self.codes[x] != self.codes[y]
            any_differ = differ.any(axis=1)
            run = np.where(any_differ, differ.argmax(axis=1), width)
            out[alive] = np.minimum(at + run, limit[alive])
            at += width
            alive = alive[~any_differ & (limit[alive] > at)]
        return out

    def matches(self) -> np.ndarray:
        """For each position the length of its longest match that starts at another one."""
        n = len(self.codes)
        longest = np.zeros(n, np.int64)
        for samples, partners in ((self.run_starts, self.above), (self.run_ends, self.below)):
            known = np.zeros(n, np.int64)
            sampled = np.zeros(n, bool)
            sampled[samples] = True
            known[samples] = self._common(samples, partners)
            # inside a run a match is one shorter than that of the position before
            last = np.maximum.accumulate(np.where(sampled, np.arange(n), -1))
            reach = np.where(last >= 0, known[np.maximum(last, 0)] - (np.arange(n) - last), 0)
            longest = np.maximum(longest, np.maximum(reach, 0))
        return longest


def _marks(strings: list[bytes], copies: list[int], length: int) -> list[np.ndarray]:
    """Offsets of the windows of each string that occur elsewhere too."""
    index = RunLengthIndex(strings)
    longest = index.matches()
    out = []
    for start, text, times in zip(index.starts, strings, copies, strict=True):
        windows = len(text) - length + 1
        out.append(np.arange(windows) if times > 1 else np.flatnonzero(longest[start : start + windows] >= length))
    return out


def intervals(offsets: np.ndarray) -> list[tuple[int, int]]:
    """Runs of neighbouring numbers as (first, last)."""
    if not len(offsets):
        return []
    cut = np.flatnonzero(np.diff(offsets) > 1)
    return list(zip(offsets[np.append(0, cut + 1)].tolist(), offsets[np.append(cut, len(offsets) - 1)].tolist(), strict=True))


def _indexed(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows (anchor, stretch name, first, last) of repeated windows; rows come ordered by anchor."""
    held: list[tuple[int, int, int, bytes]] = []
    size = 0

    def flushed() -> pa.RecordBatch:
        marks = _marks([h[3] for h in held], [h[2] for h in held], length)
        rows = [(h[0], h[1], a, b) for h, found in zip(held, marks, strict=True) for a, b in intervals(found)]
        flat = np.array(rows, np.int64).reshape(-1, 4)
        return pa.record_batch([pa.array(flat[:, c]) for c in range(4)], names=["anchor", "name", "from", "to"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in range(4)]
        for anchor, name, times, stretch in zip(*columns, strict=True):
            if held and anchor != held[-1][0] and size + len(stretch) > INDEX_BYTES:
                yield flushed()
                held, size = [], 0
            held.append((anchor, name, times, stretch))
            size += len(stretch) + 1
    if held:
        yield flushed()


def _blocks(batches: Iterator[pa.RecordBatch], length: int, width: int) -> Iterator[pa.RecordBatch]:
    """Rows (anchor, name, times, from, to, inner, outer) for the blocks of windows in the ranges of each stretch.

    A block are the windows from..to that hold the anchor at up to `width` neighbouring places. inner is a hash of
    all that windows with these places have in common, outer one of all that these windows cover. Equal
    windows hold the anchor at the same place, so a window can only be repeated if its block's
    inner string is, and is for certain if the outer one is.
    """
    for batch in batches:
        for anchor, name, stretch, ranges in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
            data = np.frombuffer(stretch, np.uint8)
            # the first place of its gram is the anchor's: the first window would have chosen an earlier one
            place = int(np.flatnonzero(rolling(data, GRAM).view(np.int64) == anchor)[0])
            from_, to, block, times = [], [], [], []
            for part in ranges:
                at = np.arange(part["from"], part["to"] + 1)
                of = (place - at) // width
                cut = np.flatnonzero(np.diff(of)) + 1
                times.append(np.full(len(cut) + 1, part["times"]))
                from_.append(at[np.append(0, cut)])
                to.append(at[np.append(cut, len(at)) - 1])
                block.append(of[np.append(0, cut)])
            first, last, of = np.concatenate(from_), np.concatenate(to), np.concatenate(block)
            # what windows of these places share begins where the latest of them does and ends with the earliest
            inner = [stretch[place - k * width : place - (k + 1) * width + 1 + length] for k in of.tolist()]
            outer = [stretch[x : y + length] for x, y in zip(first.tolist(), last.tolist(), strict=True)]
            n = len(of)
            yield pa.record_batch(
                [
                    pa.array(np.full(n, anchor, np.int64)), pa.array(np.full(n, name, np.int64)), pa.array(np.concatenate(times)),
                    pa.array(first), pa.array(last), _digest(inner, of), _digest(outer, place - first),
                ],
                names=["anchor", "name", "times", "from", "to", "inner", "outer"],
            )


def _digest(strings: list[bytes], places: np.ndarray) -> pa.Array:
    """128-bit hashes of strings with a number each."""
    found = [blake2b(s, digest_size=16, salt=k.to_bytes(8, "little")).digest() for s, k in zip(strings, places.tolist(), strict=True)]
    return pa.array(found, pa.binary())


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The removed spans of each text from the repeated windows, and what is left."""
    for batch in batches:
        spans, texts = [], []
        for text, found in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            own: list[list[int]] = []
            for window in sorted((w["from"], w["to"]) for w in found or ()):
                begin, end = window[0], window[1] + length
                if own and begin <= own[-1][1]:
                    own[-1][1] = max(own[-1][1], end)
                else:
                    own.append([begin, end])
            spans.append([{"begin": a, "end": b} for a, b in own])
            ends = [0, *(b for _, b in own)]
            texts.append(b"".join(raw[e:a] for e, a in zip(ends, [*(a for a, _ in own), len(raw)], strict=True)))
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        yield pa.record_batch(
            [batch.column(0), pa.array([len(t.as_buffer()) if t.is_valid else 0 for t in batch.column(1)], pa.int64()), pa.array(spans, kind), pa.array(texts, pa.binary())],
            names=["id", "n_bytes", "spans", "kept"],
        )


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Rows (id, n_bytes, spans, kept), one for each row of `docs`.

    spans are the maximal runs of bytes that are covered by a string of `length` bytes which also
    starts anywhere else, in another document or the same one; kept are the other bytes. A
    null text is empty. Repeated rows are copies of one another. Ids may be null or repeat;
    other columns are not read. `length` is at least twice the size of a gram.
    """
    text = F.col(text_col).cast("string")
    number = F.col(id_col).cast("long")
    # id and h together name a row; rows that share both are equal
    texts = docs.select(
        number.alias("given"), F.coalesce(number, F.lit(0).cast("long")).alias("id"), F.xxhash64(text, number.isNull()).alias("h"), text.alias("text")
    )
    places = "id long, h long, anchor long, first long, last long"
    listed = written(texts.select("id", "h", "text").mapInArrow(lambda it: _listed(it, length), places), "anchors")
    several = written(listed.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "repeated")
    likely = BlockedBloom(several, F.col("anchor")).pass_through(listed, F.col("anchor"))
    spots = likely.join(several, "anchor", "left_semi").groupBy("id", "h").agg(F.collect_set(F.struct("anchor", "first", "last")).alias("spots"))
    stretches = written(_with_text(texts, spots, "spots", length), "stretches")

    name = F.xxhash64("stretch")
    kinds = written(
        stretches.groupBy("anchor", name.alias("name")).agg(F.count("*").alias("times"), F.any_value("stretch").alias("stretch")), "kinds"
    )
    crowds = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum(F.octet_length("stretch") + 1).alias("bytes"))
    kinds = kinds.join(crowds, "anchor")
    alone = kinds.where("kinds = 1 and times > 1").select(
        "anchor", "name", F.lit(0).cast("long").alias("from"), (F.octet_length("stretch") - length).cast("long").alias("to")
    )
    few = kinds.where((F.col("kinds") > 1) & (F.col("bytes") <= CROWD_BYTES)).select("anchor", "name", "times", "stretch")
    indexed = (
        few.repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(lambda it: _indexed(it, length), "anchor long, name long, from long, to long")
    )
    crowded = _crowded(kinds.where((F.col("kinds") > 1) & (F.col("bytes") > CROWD_BYTES)), length)
    marks = written(alone.unionByName(indexed).unionByName(crowded), "marks")

    seen = stretches.select("id", "h", "anchor", name.alias("name"), "first").join(marks, ["anchor", "name"])
    window = F.struct((F.col("first") + F.col("from")).alias("from"), (F.col("first") + F.col("to")).alias("to"))
    found = written(seen.groupBy("id", "h").agg(F.collect_set(window).alias("windows")), "windows")
    flagged = BlockedBloom(found, F.xxhash64("id", "h")).marked(texts, F.xxhash64("id", "h"), "likely")
    hit = flagged.where("likely").join(found, ["id", "h"], "left").select("given", "text", "windows")
    rest = flagged.where("not likely").select("given", "text", F.lit(None).cast(found.schema["windows"].dataType).alias("windows"))
    out = "id long, n_bytes long, spans array<struct<begin:long,end:long>>, kept binary"
    return hit.unionByName(rest).mapInArrow(lambda it: _cut(it, length), out)


def _with_text(texts: DataFrame, spots: DataFrame, name: str, length: int) -> DataFrame:
    """The stretches of the wanted places; only texts that may have some are moved."""
    spots = written(spots, "spots")
    likely = BlockedBloom(spots, F.xxhash64("id", "h")).pass_through(texts, F.xxhash64("id", "h"))
    joined = likely.join(spots, ["id", "h"]).select("id", "h", "text", name)
    return joined.mapInArrow(lambda it: _stretched(it, length), "id long, h long, anchor long, first long, stretch binary")


def _crowded(kinds: DataFrame, length: int) -> DataFrame:
    """Repeated windows of anchors with very many stretches, by counting hashes of blocks of windows.

    Blocks that repeat as a whole are settled. Those that have their inner string in common with different ones are
    divided, equal ones once with their number, the settled ones as partners of the others.
    """
    stretches = kinds.select("anchor", "name", "stretch")
    every = F.struct(
        F.lit(0).cast("long").alias("from"), (F.octet_length("stretch") - length).cast("long").alias("to"), F.col("times").alias("times")
    )
    left = kinds.select("anchor", "name", "stretch", F.array(every).alias("ranges"))
    settled = []
    for width in BLOCKS:
        rows = "anchor long, name long, times long, from long, to long, inner binary, outer binary"
        blocks = written(left.mapInArrow(lambda it, width=width: _blocks(it, length, width), rows), "blocks")
        one = F.min(F.struct("name", "from", "to")).alias("one")
        different = written(blocks.groupBy("anchor", "inner", "outer").agg(F.sum("times").alias("times"), one), "different")
        whole = different.where("times > 1").select("anchor", "inner", "outer")
        settled.append(blocks.join(whole, ["anchor", "inner", "outer"], "left_semi").select("anchor", "name", "from", "to"))
        several = different.groupBy("anchor", "inner").agg(F.count("*").alias("n")).where("n > 1").select("anchor", "inner")
        divided = different.join(several, ["anchor", "inner"], "left_semi").select("anchor", "one.*", "times")
        parts = divided.groupBy("anchor", "name").agg(F.collect_list(F.struct("from", "to", "times")).alias("ranges"))
        left = stretches.join(parts, ["anchor", "name"])
    return reduce(DataFrame.unionByName, settled)


@query("op6_repeats")
def op6_repeats(spark, sf_dir):
    """Every document without the bytes that 400-byte repeats cover."""
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
