"""Shards of even size that keep linked documents together: balanced label propagation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyport.llm.registry import query
from tallyport.llm.tables import flagged, numbered, table, written

SHARDS = 8
ROUNDS = 4
# How far a shard may grow over its share while labels move.
SLACK = 0.05
# Moves are admitted by cells of a hash, so that quotas need few counts.
CELLS = 128
# Equal rows that weigh more than a shard's share divided by this are moved in parts of that weight.
PARTS = 1000


def _cell(unit: str) -> Column:
    return F.pmod(F.xxhash64(unit), F.lit(CELLS)).cast("int")


def _tallies(members: DataFrame, state: DataFrame) -> DataFrame:
    """For each group its weight, and its weight in each shard (at most as many entries as shards)."""
    by_shard = members.join(state, "node").groupBy("group", "shard").agg(F.sum("size").alias("weight"))
    return by_shard.groupBy("group").agg(
        F.collect_list(F.struct("shard", "weight")).alias("tally"), F.sum("weight").alias("group_size")
    )


def _wishes(members: DataFrame, state: DataFrame, cap: float) -> DataFrame:
    """The shard in which a document has most of its neighbours, and the unit it moves with."""
    votes = members.join(_tallies(members, state), "group").select(
        "node", "group", "group_size", F.explode("tally").alias("t")
    )
    sums = votes.groupBy("node", F.col("t.shard").alias("wish")).agg(
        F.sum("t.weight").alias("weight"), F.min("group").alias("unit"), F.max("group_size").alias("unit_size")
    )
    # equal votes: the same choice for all members of a group, another one for each group
    best = F.max(F.struct("weight", F.xxhash64("wish", "unit").alias("tie"), "wish", "unit", "unit_size")).alias("best")
    # a group that is large against a shard moves in parts
    large = F.col("best.unit_size") > cap / 4
    unit = F.when(large, F.xxhash64("node")).otherwise(F.xxhash64("best.unit"))
    return sums.groupBy("node").agg(best).select("node", F.col("best.wish").alias("wish"), unit.alias("unit"), large.alias("large"))


def _round(state: DataFrame, wishes: DataFrame, cap: float, shards: int) -> tuple[DataFrame, bool]:
    """Documents move to the shard they wish as far as its quota goes."""
    # groups that are moved whole come first
    admission = F.when(F.col("large"), _cell("unit") + CELLS).otherwise(_cell("unit"))
    movers = written(state.join(wishes, "node").where("wish != shard").withColumn("cell", admission), "movers")
    if not flagged(movers):
        return state, False
    held = {r.shard: r.total for r in state.groupBy("shard").agg(F.sum("size").alias("total")).collect()}
    leaving = {r.shard: r.total for r in movers.groupBy("shard").agg(F.sum("size").alias("total")).collect()}
    quota = F.create_map(
        *[x for s in range(shards) for x in (F.lit(s), F.lit(float(max(0.0, cap - held.get(s, 0)) + leaving.get(s, 0))))]
    )
    sums = movers.groupBy("wish", "cell").agg(F.sum("size").alias("size"))
    running = F.sum("size").over(Window.partitionBy("wish").orderBy("cell"))
    admitted = sums.withColumn("running", running).where(F.col("running") <= quota[F.col("wish")])
    # at most 2 * CELLS rows for each shard
    moves = movers.join(F.broadcast(admitted.select("wish", "cell")), ["wish", "cell"]).select("node", F.col("wish").alias("to"))
    moved = state.join(moves, "node", "left").select("node", "size", F.coalesce("to", "shard").alias("shard"))
    return written(moved, "state"), True


def _evened(state: DataFrame, units: DataFrame, shards: int) -> DataFrame:
    """Takes from shards above their share what fills the others, unlinked documents first.

    The documents of a shard stand in cells; a running total over cells and within the cell
    gives each its place, and those whose place ends within the surplus are given away. The
    surplus of all shards in a row is cut at the gaps of the others. Differences are left of
    the size of a document.
    """
    totals = {r.shard: r.total for r in state.groupBy("shard").agg(F.sum("size").alias("total")).collect()}
    share = sum(totals.values()) / shards
    surplus = {s: max(0.0, totals.get(s, 0) - share) for s in range(shards)}
    offset, ahead = {}, 0.0
    for s in range(shards):
        offset[s], ahead = ahead, ahead + surplus[s]
    pick = lambda values: F.create_map(*[x for s in range(shards) for x in (F.lit(s), F.lit(float(values[s])))])
    placed = state.join(units, "node", "left").withColumn(
        "cell", F.when(F.col("unit").isNull(), _cell("node")).otherwise(_cell("unit") + CELLS)
    )
    cells = placed.groupBy("shard", "cell").agg(F.sum("size").alias("cell_size"))
    before = F.sum("cell_size").over(Window.partitionBy("shard").orderBy("cell")) - F.col("cell_size")
    starts = F.broadcast(cells.select("shard", "cell", before.alias("before")))  # at most 2 * CELLS rows a shard
    inner = F.sum("size").over(Window.partitionBy("shard", "cell").orderBy("unit", "node").rowsBetween(Window.unboundedPreceding, 0))
    ends = placed.join(starts, ["shard", "cell"]).withColumn("end", F.col("before") + inner)
    place = pick(offset)[F.col("shard")] + F.col("end") - F.col("size") / 2
    to, edge = F.col("shard"), 0.0
    gaps = []
    for s in range(shards):
        gap = max(0.0, share - totals.get(s, 0))
        if gap:
            edge += gap
            gaps.append((s, edge))
    given = F.lit(gaps[-1][0]) if gaps else to
    for s, end in reversed(gaps[:-1]):
        given = F.when(place < end, s).otherwise(given)
    out = F.when(F.col("end") <= pick(surplus)[F.col("shard")], given).otherwise(to)
    return ends.select("node", "size", out.cast("int").alias("shard"))


def _parted(rows: DataFrame, narrow: DataFrame, id_col: str, total: int, shards: int) -> tuple[DataFrame, DataFrame]:
    """`rows` and `narrow` with the copies of heavy nodes dealt evenly to nodes of at most a part's weight.

    Each copy weighs the same, so dealing them in turn is even. The rows that are dealt are written
    with their part, which therefore is the same wherever they are read.
    """
    part = total / (shards * PARTS)
    nodes = narrow.groupBy("__node").agg(F.sum("size").alias("weight"), F.count("*").alias("n")).where(F.col("n") > 1)
    parts = F.ceil(F.col("weight") / part)
    # with a part for each copy, numbers are not taken twice
    parts = F.when(parts < F.col("n"), parts).otherwise(F.lit(2**63 - 1))
    heavy = written(nodes.where(F.col("weight") > part).select(F.col("__node").alias("__heavy"), parts.alias("__parts")), "heavy")
    if not flagged(heavy):
        return rows, narrow
    few = F.broadcast(heavy)  # at most shards * PARTS rows
    same = F.col("__node") == F.col("__heavy")
    dealt = F.xxhash64("__node", F.pmod(F.monotonically_increasing_id(), F.col("__parts")))
    copies = written(rows.join(few, same).withColumn("__node", dealt).drop("__heavy", "__parts"), "copies")
    light = narrow.join(few, same, "left_anti").unionByName(copies.select(F.col(id_col).alias("id"), *narrow.columns[1:]))
    return rows.join(few, same, "left_anti").unionByName(copies), written(light, "rows")


def sharded(
    docs: DataFrame,
    links: DataFrame | None = None,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = ROUNDS,
) -> DataFrame:
    """The rows of `docs` with size, text_crc32, law, shard, slot and grown_shard.

    The law is `bytes`: shards hold nearly the same number of bytes. A row's size is the UTF-8
    bytes of its text plus 1. Documents start in a shard given by a hash; then, for `rounds`
    rounds, each moves to the shard in which its neighbours weigh most, as far as the
    capacity there goes. `links` has rows (id, group): documents of a group are neighbours
    of one another, a pair of linked documents is a group of two. Without it, equal texts
    are neighbours. At the end the sizes are evened out, unlinked documents moving first.
    A group larger than a shard is split. A slot is a row's number in its shard, from 0.

    A null text has size 1 and no neighbours. Rows that repeat both id and text stay together, unless
    they weigh more than a thousandth of a shard; then they are neighbours like other equal texts.
    A null id is an id like any other, but has no links in `links`. Columns of the added names are replaced.
    grown_shard is null under this law.
    """
    added = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = docs.drop(*added)
    text = F.col(text_col).cast("string")
    rows = rows.withColumns(
        {
            "size": F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1,
            "text_crc32": F.crc32(F.coalesce(text, F.lit(""))),
            "__same": F.xxhash64(text),
            "__blank": text.isNull(),
        }
    ).withColumn("__node", F.xxhash64(F.col(id_col), "__same", "__blank"))
    narrow = written(rows.select(F.col(id_col).alias("id"), "size", "__node", "__same", "__blank"), "rows")
    total = narrow.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("t")).first().t
    rows, narrow = _parted(rows, narrow, id_col, total, shards)
    nodes = narrow.groupBy(F.col("__node").alias("node")).agg(F.sum("size").alias("size"))
    state = written(nodes.withColumn("shard", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int")), "state")
    if links is None:
        members = narrow.where("not __blank").select(F.col("__node").alias("node"), F.col("__same").alias("group")).distinct()
    else:
        named = links.select(F.col(links.columns[0]).alias("id"), F.xxhash64(F.col(links.columns[1])).alias("group"))
        members = narrow.join(named, "id").select(F.col("__node").alias("node"), "group").distinct()
    lonely = members.groupBy("group").agg(F.count("*").alias("n")).where("n > 1").select("group")
    members = written(members.join(lonely, "group"), "members")

    cap = (1 + SLACK) * total / shards
    for _ in range(rounds):
        state, moved = _round(state, _wishes(members, state, cap), cap, shards)
        if not moved:
            break
    final = written(_evened(state, _wishes(members, state, cap).select("node", "unit"), shards), "shards")
    placed = rows.join(final.select(F.col("node").alias("__n"), "shard"), F.col("__node") == F.col("__n"))
    out = numbered(placed.withColumn("law", F.lit("bytes")), F.col("__node"), F.col("shard"), "slot", cells=2 * CELLS)
    return out.withColumn("grown_shard", F.lit(None).cast("int")).select(
        *[c for c in docs.columns if c not in added], *added
    )


@query("op7_sharding")
def op7_sharding(spark, sf_dir):
    """Every document's shard; equal texts are the links."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharded(docs).drop("text")
