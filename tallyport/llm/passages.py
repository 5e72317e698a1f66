"""Passages that repeat inside longer lines: content-defined units as seeds, exact comparison around them.

Words are cut where a word has the least hash of some `WINDOW` words in a row. A unit goes from a cut to the
first cut at least `UNIT` words on. Cuts depend on the words around them only: a stretch of
2 * WINDOW + UNIT - 1 = 24 words that stands in two places gives both an equal unit. Two passages of more than 50 words
with a Jaccard similarity of 75 % have at most one changed place in 35 words, so they share such a stretch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyport.llm import shingles
from tallyport.llm.bloom import MAX_BLOCKS, BlockedBloom
from tallyport.llm.tables import written

WINDOW, UNIT = 8, 9
# A repeated passage of fewer words is left alone.
MIN_PASSAGE = 25
# Words without an equal unit between two that may belong to one passage.
GAP = 26
# Words looked at on both sides of the equal units; the windows of first places end at multiples of `STEP`, so that few differ.
AROUND, STEP = 50, 64

_FACTOR = 0xD1342543DE82EF95
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of the words of a text, A-Z as a-z."""
    return shingles.word_hashes(np.frombuffer(text.lower(), np.uint8))


def units(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and name of each unit."""
    none = np.empty(0, np.int64)
    if len(hashes) < UNIT + 1:
        return none, none, none
    windows = np.lib.stride_tricks.sliding_window_view(hashes, WINDOW)
    # of equal hashes the last one
    least = np.arange(WINDOW - 1, len(hashes)) - windows[:, ::-1].argmin(axis=1)
    cuts = least[np.concatenate(([True], least[1:] != least[:-1]))]
    last = np.searchsorted(cuts, cuts + UNIT)
    starts = cuts[last < len(cuts)]
    ends = cuts[last[last < len(cuts)]]
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * _powers(_FACTOR, len(hashes))[:-1], out=sums[1:])
    names = shingles.mixed((sums[ends] - sums[starts]) * _powers(_INVERSE, len(hashes))[starts])
    return starts, ends - starts, names.view(np.int64)


UNITS = "doc long, at int, n int, line int, last int, name long"


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row (doc, at, n, line, last, name) for each unit; line and last are its first and last line."""
    names = ["doc", "at", "n", "line", "last", "name"]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
    for batch in batches:
        rows: list[list[np.ndarray]] = [[] for _ in names]
        size = 0
        for k, text in enumerate(batch.column(1)):
            if not text.is_valid:
                continue
            raw = text.as_buffer().to_pybytes()
            begins, hashes = words(raw)
            at, n, name = units(hashes)
            breaks = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10)
            line = np.searchsorted(breaks, begins)
            for out, part in zip(rows, (np.full(len(at), k), at, n, line[at], line[at + n - 1], name), strict=True):
                out.append(part)
            size += len(at)
            if size > 100_000:
                yield _table(batch, rows, kinds, names)
                rows, size = [[] for _ in names], 0
        if size:
            yield _table(batch, rows, kinds, names)


def _table(batch: pa.RecordBatch, rows: list[list[np.ndarray]], kinds: list, names: list[str]) -> pa.RecordBatch:
    of, *rest = (np.concatenate(r) for r in rows)
    return pa.record_batch([batch.column(0).take(pa.array(of)), *[pa.array(r).cast(k) for r, k in zip(rest, kinds, strict=True)]], names=names)


PARTS = "doc long, of long, first boolean, first_lo int, first_hi int, begin int, words binary"


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted words of each text, and where they begin; `first`: of a first place."""
    for batch in batches:
        for k in range(batch.num_rows):
            text, wanted = batch.column(1)[k], batch.column(2)[k].as_py()
            if not text.is_valid:
                continue
            raw = text.as_buffer().to_pybytes()
            edges = np.flatnonzero(np.diff(np.concatenate(([True], shingles._SPACE[np.frombuffer(raw, np.uint8)], [True])).view(np.int8)))
            starts, ends = edges[::2], edges[1::2]
            for at in range(0, len(wanted), 1000):
                some = [w for w in wanted[at : at + 1000] if w["lo"] < len(starts)]
                begins = [int(starts[w["lo"]]) for w in some]
                cut = [raw[b : ends[min(w["hi"], len(ends)) - 1]] if w["hi"] > w["lo"] else b"" for b, w in zip(begins, some, strict=True)]
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array([k] * len(some), pa.int64())),
                        pa.array([w["of"] for w in some], pa.int64()),
                        pa.array([w["first"] for w in some], pa.bool_()),
                        pa.array([w["first_lo"] for w in some], pa.int32()),
                        pa.array([w["first_hi"] for w in some], pa.int32()),
                        pa.array(begins, pa.int32()),
                        pa.array(cut, pa.binary()),
                    ],
                    names=["doc", "of", "first", "first_lo", "first_hi", "begin", "words"],
                )


def _runs(hashes: np.ndarray) -> np.ndarray:
    """Hashes of all five-word shingles in order."""
    n = len(hashes) - shingles.WORDS + 1
    out = np.full(max(n, 0), shingles.WORDS, np.uint64)
    for k in range(shingles.WORDS if n > 0 else 0):
        out = shingles.mixed(out * _MULTIPLIER + hashes[k : k + n])
    return out


def repeated(later: np.ndarray, first: np.ndarray, percent: int, least: int = MIN_PASSAGE) -> list[tuple[int, int]]:
    """Ranges of words of `later` that are in `first` too, each of `least` words or more.

    Stretches whose shingles are all in `first` form one range with what is between them if the
    range and its counterpart have a Jaccard similarity of `percent` % or more; else
    they are parted at the widest gap.
    """
    mine, other = _runs(later), _runs(first)
    at = np.flatnonzero(np.isin(mine, other))
    if not len(at):
        return []
    edge = np.flatnonzero(np.diff(at) > shingles.WORDS)
    begins, lasts = at[np.concatenate(([0], edge + 1))], at[np.concatenate((edge, [len(at) - 1]))]
    out, left = [], [(0, len(begins) - 1)]
    while left:
        i, j = left.pop()
        a, b = int(begins[i]), int(lasts[j]) + shingles.WORDS
        if i < j:
            own = np.unique(mine[a : lasts[j] + 1])
            there = np.flatnonzero(np.isin(other, own))
            theirs = np.unique(other[there[0] : there[-1] + 1])
            shared = len(np.intersect1d(own, theirs, assume_unique=True))
            if 100 * shared < percent * (len(own) + len(theirs) - shared):
                widest = i + int(np.argmax(begins[i + 1 : j + 1] - lasts[i:j]))
                left += [(i, widest), (widest + 1, j)]
                continue
        if b - a >= least:
            out.append((a, b))
    return sorted(out)


def _compared(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The repeated bytes of rows (doc, of, begin, words, first words); equal first words in a row are hashed once."""
    known, first = None, None
    for batch in batches:
        rows = []
        for k in range(batch.num_rows):
            raw, other = (batch.column(c)[k].as_buffer().to_pybytes() for c in (3, 4))
            if other != known:
                known, first = other, words(other)[1]
            starts, later = words(raw)
            found = repeated(later, first, percent)
            if found:
                begin = batch.column(2)[k].as_py()
                # a range ends with its last word, before the white space that follows
                rows += [(k, begin + int(starts[a]), begin + (len(raw) if b == len(starts) else len(raw[: starts[b]].rstrip()))) for a, b in found]
        of = pa.array([r[0] for r in rows], pa.int64())
        yield pa.record_batch(
            [batch.column(0).take(of), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32()), batch.column(1).take(of)],
            names=["doc", "start", "end", "first_doc"],
        )


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _candidates(texts: DataFrame, removals: DataFrame) -> DataFrame:
    """Rows (doc, lo, hi, of, first_lo, first_hi): words of a document that may repeat words of an earlier place."""
    rows = written(texts.mapInArrow(_united, UNITS), "units")
    several = written(rows.groupBy("name").agg(F.count("*").alias("k")).where("k > 1").select("name"), "repeated")
    known = BlockedBloom(several, F.col("name"))
    likely = known.pass_through(rows, F.col("name"))
    if known.blocks == MAX_BLOCKS:  # a full filter lets much pass in error; else what is alone goes with the counts below
        likely = likely.join(several, "name", "left_semi")
    # a document in a struct equals itself without an id too: rows dealt out by it once are joined and made distinct there
    place = [F.struct("doc").alias("in"), "name", F.struct("at", "n").alias("at"), "line", "last"]
    lines = removals.groupBy(F.struct("doc").alias("in")).agg(F.collect_set("paragraph").alias("gone"))
    held = likely.select(*place).join(lines, "in", "left").where(
        F.col("gone").isNull() | ~F.arrays_overlap("gone", F.sequence("line", "last"))
    )
    places = written(held.select("name", "in", "at").distinct().select("name", "in.doc", "at.at", "at.n"), "places")
    first = places.groupBy("name").agg(F.min(F.struct("doc", "at")).alias("first"), F.count("*").alias("k")).where("k > 1")
    first = written(first.select("name", F.col("first.doc").alias("of"), F.col("first.at").alias("first_at")), "firsts")
    # not the first place itself, nor what overlaps it
    later = places.join(first, "name").where(~(_same("doc", "of") & (F.col("at") < F.col("first_at") + F.col("n"))))
    order = Window.partitionBy("doc", "of").orderBy("at")
    shift = F.col("first_at") - F.col("at")
    apart = (F.col("at") - F.lag(F.col("at") + F.col("n")).over(order) > GAP) | (F.abs(shift - F.lag(shift).over(order)) > GAP)
    chains = later.withColumn("apart", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("chain", F.sum("apart").over(order))
    ends = chains.groupBy("doc", "of", "chain").agg(
        F.min("at").alias("lo"), F.max(F.col("at") + F.col("n")).alias("hi"), F.min("first_at").alias("a"), F.max(F.col("first_at") + F.col("n")).alias("b")
    )
    own = _same("doc", "of")
    wide = F.ceil((F.col("b") + AROUND) / STEP).cast("int") * STEP
    # in one document what is compared must not overlap: it is parted in the middle
    middle = F.least(F.greatest(F.floor((F.col("b") + F.col("lo")) / 2).cast("int"), F.col("lo") - AROUND), F.col("lo"))
    return written(
        ends.select(
            "doc",
            F.when(own, middle).otherwise(F.greatest(F.col("lo") - AROUND, F.lit(0))).alias("lo"),
            (F.col("hi") + AROUND).alias("hi"),
            "of",
            F.greatest(F.floor((F.col("a") - AROUND) / STEP).cast("int") * STEP, F.lit(0)).alias("first_lo"),
            F.when(own, F.least(wide, middle)).otherwise(wide).alias("first_hi"),
        ),
        "candidates",
    )


def passages(texts: DataFrame, removals: DataFrame, percent: int) -> DataFrame:
    """Rows (doc, start, end, first_doc): bytes of passages that repeat an earlier one, of texts (doc, text).

    Units that touch a line of `removals` (doc, paragraph) take no part.
    """
    found = _candidates(texts, removals)
    part = lambda lo, hi, *of: F.struct(*(F.col(c).alias(n) for c, n in zip((lo, hi), ("lo", "hi"), strict=True)), *of)
    # a first place is fetched once, however many repeat it; their words meet it by its document and words
    later = found.select("doc", part("lo", "hi", F.col("of"), F.lit(False).alias("first"), "first_lo", "first_hi").alias("part"))
    first = found.select(
        F.col("of").alias("doc"), part("first_lo", "first_hi", F.col("of"), F.lit(True).alias("first"), "first_lo", "first_hi").alias("part")
    )
    wanted = later.unionByName(first.distinct()).groupBy("doc").agg(F.collect_list("part").alias("wanted"))
    wanted = written(wanted.select(F.col("doc").alias("in"), "wanted"), "wanted")
    likely = BlockedBloom(wanted, F.col("in")).pass_through(texts, F.col("doc"))
    fetched = likely.join(wanted, _same("doc", "in")).select("doc", "text", "wanted").mapInArrow(_fetched, PARTS)
    fetched = written(fetched, "words")
    later = fetched.where("not first").drop("first")
    first = fetched.where("first").select(F.col("doc").alias("fd"), F.col("first_lo").alias("fl"), F.col("first_hi").alias("fh"), F.col("words").alias("first_words"))
    pairs = later.join(first, _same("of", "fd") & (F.col("first_lo") == F.col("fl")) & (F.col("first_hi") == F.col("fh")))
    pairs = pairs.select("doc", "of", "begin", "words", "first_words")
    spans = pairs.mapInArrow(lambda it: _compared(it, percent), "doc long, start int, end int, first_doc long")
    return written(spans.distinct(), "passages")


def merged(spans: DataFrame) -> DataFrame:
    """Rows (doc, spans, kept_in): the spans of each document in order, those that meet as one."""
    order = Window.partitionBy("doc").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    parts = spans.withColumn("fresh", F.coalesce(F.col("start") > before + 1, F.lit(True)).cast("int"))
    parts = parts.withColumn("part", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = parts.groupBy("doc", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.collect_set("first_doc").alias("of"))
    return whole.groupBy("doc").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"), F.array_distinct(F.flatten(F.collect_list("of"))).alias("kept_in")
    )
