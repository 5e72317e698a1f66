"""Links within cells of shingle sets: recursive, exact, without comparing all pairs of a cell."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyport.llm.bloom import BlockedBloom
from tallyport.llm.graph import components
from tallyport.llm.tables import flagged, written

# Members of a cell that are compared with all others of it at a time, once it is not divided any more.
BLOCK = 1024
# A cell with more members than this outside its largest component is crowded. So many of them are compared
# with all others first; what is crowded then is divided into finer cells, at most so many times.
CROWD, TURNS, LEVELS = 1024, 1, 4


def short(found: np.ndarray) -> bytes:
    """16 bits of each shingle of a set, in order: all low bytes, then all high ones, of which many are alike."""
    return np.sort(found.astype(np.uint16)).view(np.uint8).reshape(-1, 2).T.tobytes()


def members(packed: pa.Buffer, kind: type) -> np.ndarray:
    """The sorted members of a whole set or a shortened one."""
    if kind is np.uint64:
        return np.frombuffer(packed, kind)
    return np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(2, -1).T).view(np.uint16).reshape(-1)


def _overlaps(batches: Iterator[pa.RecordBatch], kind: type = np.uint64) -> Iterator[pa.RecordBatch]:
    """The size of the intersection of each pair; of shortened sets a bound from above."""
    for batch in batches:
        left, right = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
        shared = np.zeros(batch.num_rows, np.int32)
        for k in range(batch.num_rows):
            x, y = (members(side[k].as_buffer(), kind) for side in (left, right))
            if len(x) > len(y):
                x, y = y, x
            at = np.searchsorted(y, x)
            shared[k] = np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x)
        yield pa.record_batch([*batch.columns[:-2], pa.array(shared)], names=["x", "xn", "y", "yn", "shared"])


def _shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets with 16 bits of each shingle. Shared shingles agree in them, others by chance."""
    for batch in batches:
        packed = [short(np.frombuffer(s.as_buffer(), np.uint64)) for s in batch.column(2)]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["name", "n", "shingles"])


def node(name: str = "name", n: str = "n") -> Column:
    return F.struct(F.col(n).alias("n"), F.col(name).alias("name"))


def pair(a: Column, b: Column) -> list[Column]:
    """The columns of an unordered pair of nodes with places."""
    x, y = F.least(a, b), F.greatest(a, b)
    return [x["name"].alias("x"), x["n"].alias("xn"), y["name"].alias("y"), y["n"].alias("yn"), x["place"].alias("xp"), y["place"].alias("yp")]


def placed(name: str = "name", n: str = "n", place: str = "place") -> Column:
    return F.struct(F.col(n).alias("n"), F.col(name).alias("name"), F.col(place).alias("place"))


PAIR = ["x", "xn", "y", "yn"]


class CellJoin:
    """Finds the links between sets that share a cell.

    `fetch` gets rows (name, n), name and size of sets, and returns rows (name, n, shingles) with
    their sorted 64-bit shingles; only sets that are to be compared are fetched. A link is a
    Jaccard similarity of `percent` % or more.

    `split` gets the rows (cell, name, n, place) of crowded cells and the number of divisions before
    and with this one, and returns the rows of finer cells, such that each pair that may be linked shares one
    of them. Cells of more than `most_pairs` pairs to compare count as crowded too. A crowd that is still one after `levels` divisions is compared whole, in blocks.

    `fetch_short`, if given, does what `fetch` does for shortened sets. All pairs are compared by them first, and `fetch` is asked
    only for the sets of pairs that they admit.
    """

    def __init__(
        self,
        fetch: Callable[[DataFrame], DataFrame],
        percent: int,
        split: Callable[[DataFrame, int], DataFrame],
        block: int = BLOCK,
        crowd: int = CROWD,
        turns: int = TURNS,
        levels: int = LEVELS,
        most_pairs: int | None = None,
        fetch_short: Callable[[DataFrame], DataFrame] | None = None,
    ):
        self.fetch, self.percent, self.split, self.block, self.crowd = fetch, percent, split, block, crowd
        self.turns, self.levels, self.most_pairs, self.fetch_short = turns, levels, most_pairs, fetch_short

    @staticmethod
    def _compared(pairs: DataFrame, sets: DataFrame, kind: type = np.uint64) -> DataFrame:
        x = sets.select(F.col("name").alias("x"), F.col("n").alias("xn"), F.col("shingles").alias("xs"))
        y = sets.select(F.col("name").alias("y"), F.col("n").alias("yn"), F.col("shingles").alias("ys"))
        both = pairs.join(x, ["x", "xn"]).join(y, ["y", "yn"]).select(*PAIR, "xs", "ys")
        return both.mapInArrow(lambda it: _overlaps(it, kind), "x long, xn int, y long, yn int, shared int")

    @staticmethod
    def _ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array(node("x", "xn"), node("y", "yn"))).alias("end")).select("end.n", "end.name").distinct()

    def _verified(self, pairs: DataFrame, bounded: bool) -> DataFrame:
        """Pairs with the exact size of their intersection; `bounded`: of pairs that cannot be linked a bound of it.

        The bound comes from shortened sets, so whole sets are moved for few pairs besides the links.
        """
        if self.fetch_short is not None:
            bounds, likely, ends = self._bounds(pairs, self.fetch_short(self._ends(pairs)))
            whole = self.fetch(ends)
        else:
            sets = self.fetch(self._ends(pairs))
            if not bounded:
                return self._compared(pairs, sets)
            short_sets = sets.select("name", "n", "shingles").mapInArrow(_shortened, "name long, n int, shingles binary")
            bounds, likely, ends = self._bounds(pairs, short_sets)
            key = F.xxhash64("n", "name")
            whole = BlockedBloom(ends, key).pass_through(sets, key)
        return bounds.where(~self._similar()).unionByName(self._compared(likely, whole))

    def _bounds(self, pairs: DataFrame, short_sets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Pairs with a bound of their overlap, those that may be linked, and the sets of these."""
        bounds = written(self._compared(pairs, short_sets, np.uint16), "bounds")
        likely = self._linked(bounds).select(*PAIR).distinct()
        return bounds, likely, written(self._ends(likely), "ends")

    def _similar(self) -> Column:
        union = F.col("xn") + F.col("yn") - F.col("shared")
        return F.lit(100).cast("long") * F.col("shared") >= F.lit(self.percent).cast("long") * union

    def _linked(self, tested: DataFrame) -> DataFrame:
        return tested.where(self._similar())

    def _sizes_fit(self) -> Column:
        small, large = F.least("xn", "yn").cast("long"), F.greatest("xn", "yn").cast("long")
        return 100 * small >= self.percent * large

    def _within_reach(self) -> Column:
        """Whether a pair may be linked if the region's shingle is the first that both have.

        Both have at most the shingles from their places on in common then. A linked pair whose
        first common shingle is another one passes in that one's region.
        """
        most = F.least(F.col("xn") - F.col("xp"), F.col("yn") - F.col("yp")).cast("long")
        return (100 + self.percent) * most >= self.percent * (F.col("xn") + F.col("yn")).cast("long")

    def _with_partners(self, rows: DataFrame) -> DataFrame:
        """Rows with the class of their size and the classes that linked sets can have; without those that have no partner in their cell.

        The size and the place of a set bound its partners' sizes from both sides. The classes
        are join keys, so pairs that the bounds exclude are not made.
        """
        p = self.percent
        size_class = lambda n: F.floor(F.log(n.cast("double")) * 14).cast("int")  # noqa: E731 - steps of 7 %
        n, place = F.col("n").cast("long"), F.col("place").cast("long")
        least = F.greatest(F.expr(f"({p}L * n) div 100L"), F.lit(1).cast("long"))
        most = (100 * n - (100 + p) * place) / p
        sized = rows.withColumns({"size": size_class(n), "low": size_class(least), "most": F.floor(most)}).where("most >= 1")
        sized = sized.withColumn("high", size_class(F.col("most"))).drop("most").where("low <= high")
        # a handful of classes for each cell, however many members it has
        classes = sized.select("cell", F.col("size").alias("theirs"), "low", "high").distinct()
        offered = classes.select("cell", "theirs", F.explode(F.sequence("low", "high")).alias("size")).distinct()
        asked = offered.groupBy("cell", "size").agg(F.collect_set("theirs").alias("askers"))
        met = sized.join(asked, ["cell", "size"])
        return met.where(F.exists("askers", lambda c: c.between(F.col("low"), F.col("high")))).drop("askers")

    def _pairs(self, chosen: DataFrame, rows: DataFrame, all_apart: bool = False) -> DataFrame:
        """Pairs of a chosen member and another of its cell, in different components and of sizes that fit.

        `all_apart`: chosen are all members outside the largest component, so two of them are met once.
        """
        a = chosen.select(
            "cell", placed().alias("a"), F.col("component").alias("own"), F.col("size").alias("a_size"), F.explode(F.sequence("low", "high")).alias("size")
        )
        b = rows.select("cell", placed().alias("b"), "component", "main", "size", "low", "high")
        met = a.join(b, ["cell", "size"]).where((F.col("own") != F.col("component")) & F.col("a_size").between(F.col("low"), F.col("high")))
        if all_apart:
            met = met.where((F.col("component") == F.col("main")) | (F.col("a") < F.col("b")))
        return met.select(*pair(F.col("a"), F.col("b")))

    def _with_components(self, rows: DataFrame, links: DataFrame) -> DataFrame:
        self._label(links)
        return rows.join(self.labels, ["name", "n"], "left").withColumn("component", F.coalesce("component", node()))

    def _label(self, links: DataFrame) -> None:
        ends = links.select(node("x", "xn").alias("a"), node("y", "yn").alias("b"))
        self.labels = components(ends).select(F.col("node.name").alias("name"), F.col("node.n").alias("n"), "component")

    @staticmethod
    def _pivots(cells: DataFrame) -> DataFrame:
        """The pivot of each cell of several members, and how many there are.

        It is the member of the least place: the fewer shingles of its own a set has, the closer it is to the others.
        """
        order = F.struct("place", F.xxhash64("name", "n").alias("h"), "n", "name")
        of = cells.groupBy("cell").agg(F.count("*").alias("members"), F.min(order).alias("p")).where("members > 1")
        return of.select("cell", "members", F.struct("p.n", "p.name", "p.place").alias("pivot"))

    @staticmethod
    def _around(rows: DataFrame) -> DataFrame:
        """The pairs of the members with the pivot of their cell."""
        return rows.where(placed() != F.col("pivot")).select(*pair(placed(), F.col("pivot")))

    @staticmethod
    def _open(rows: DataFrame) -> DataFrame:
        """Cells that hold several components, with the largest one and the number of members outside it.

        Of cells with the same members the one with the earliest places is kept: it belongs to the
        first shingle that they share.
        """
        # sums of halves of the hashes: a sum of longs does not overflow
        h = F.xxhash64("n", "name")
        parts = rows.groupBy("cell", "component").agg(
            F.count("*").alias("k"),
            F.sum("place").alias("places"),
            F.sum(F.shiftright(h, 32)).alias("same"),
            F.bit_xor(h).alias("mixed"),
        )
        return (
            parts.groupBy("cell")
            .agg(
                F.count("*").alias("parts"),
                F.sum("k").alias("members"),
                F.sum("same").alias("same"),
                F.bit_xor("mixed").alias("mixed"),
                F.sum("places").alias("places"),
                F.max(F.struct("k", "component")).alias("largest"),
            )
            .where("parts > 1")
            .groupBy("members", "same", "mixed")
            .agg(F.min(F.struct("places", "cell", "largest")).alias("c"))
            .select("c.cell", "members", F.col("c.largest.component").alias("main"), (F.col("members") - F.col("c.largest.k")).alias("apart"))
        )

    def _rings(self, rows: DataFrame, tested: DataFrame) -> DataFrame:
        """The next cells: a member goes to the pairs of rings that its distance to the pivot allows."""
        around = rows.where(placed() != F.col("pivot")).select("cell", "name", "n", "place", *pair(placed(), F.col("pivot")))
        met = around.join(tested, PAIR, "left")
        union = (F.col("xn") + F.col("yn") - F.col("shared")).cast("long")
        # without a test the sizes give the least distance, and the largest is 1
        near = F.when(F.col("shared").isNotNull(), F.expr(f"((union - shared) * 100L) div (union * {100 - self.percent}L)")).otherwise(
            F.expr(f"((greatest(xn, yn) - least(xn, yn)) * 100L) div (greatest(xn, yn) * {100 - self.percent}L)")
        )
        last = 100 // (100 - self.percent)
        far = F.when(F.col("shared").isNotNull(), F.col("near")).otherwise(F.lit(last).cast("long"))
        ranged = met.withColumn("union", union).withColumn("near", near).withColumn("far", far)
        return ranged.select(
            F.explode(F.sequence(F.greatest(F.col("near") - 1, F.lit(0).cast("long")), "far")).alias("ring"), "cell", "name", "n", "place"
        ).select(F.xxhash64("cell", "ring").alias("cell"), "name", "n", "place")

    def _tested(self, pairs: DataFrame, before: DataFrame | None) -> DataFrame:
        """The overlaps of pairs that may be linked and were not tested before."""
        fresh = pairs.where(self._sizes_fit() & self._within_reach()).select(*PAIR).distinct()
        if before is not None:
            fresh = fresh.join(before, PAIR, "left_anti")
        return written(self._verified(written(fresh, "pairs"), before is not None).distinct(), "tested")

    @staticmethod
    def _turn(rows: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
        """Members outside the largest component that are compared now, and the other members."""
        turn = F.row_number().over(Window.partitionBy("cell").orderBy(F.xxhash64("name", "n"), "name", "n", "place"))
        chosen = written(rows.where("component != main").withColumn("turn", turn).where(F.col("turn") <= block), "chosen")
        keys = ["cell", "name", "n", "place"]
        return chosen, rows.join(chosen.select(keys), keys, "left_anti")

    def join(self, cells: DataFrame) -> DataFrame:
        """Verified links (x, xn, y, yn, shared) of rows (cell, name, n, place).

        place is the number of shingles of the set that come before the cell's own in the common
        order, or 0. The links connect all sets that any chain of links within cells connects.
        Afterwards `labels` has rows (name, n, component) for all linked sets.
        """
        # every cell against its pivot
        rows = written(cells.join(self._pivots(cells), "cell"), "rows")
        tested = self._tested(self._around(rows), None)
        # a cell of two is settled
        rows = written(self._rings(rows.where("members > 2"), tested).distinct(), "rings")
        level = 0
        while True:
            # cells in which components remain apart: members outside the largest one against all others
            rows = self._with_components(rows.select("cell", "name", "n", "place"), self._linked(tested))
            rows = written(rows, "labelled")
            state = written(self._open(rows), "open")
            if not flagged(state):
                return self._linked(tested)
            rows = rows.join(state, "cell")
            level += 1
            if level <= self.turns + self.levels:
                crowded = F.col("apart") > self.crowd
                if self.most_pairs is not None:
                    crowded |= F.col("apart") * F.col("members") > self.most_pairs
                likely = written(self._with_partners(rows), "likely")
                some, crowds = likely.where(~crowded), likely.where(crowded)
                more = flagged(crowds)
                pairs = self._pairs(some.where("component != main"), some, all_apart=True)
                if more and level <= self.turns:
                    pivots, rows = self._turn(crowds, self.crowd)
                    pairs = pairs.unionByName(self._pairs(pivots, crowds))
                elif more:
                    rows = written(self.split(crowds.select("cell", "name", "n", "place"), level - self.turns), "finer")
                    # finer cells meet their pivots first: what these link is not compared with one another
                    pairs = pairs.unionByName(self._around(rows.join(self._pivots(rows), "cell")))
            else:
                likely = written(self._with_partners(rows), "likely")
                chosen, rows = self._turn(likely, self.block)
                pairs = self._pairs(chosen, likely)
                more = True
            tested = tested.unionByName(self._tested(pairs, tested))
            if not more:
                self._label(self._linked(tested))
                return self._linked(tested)
