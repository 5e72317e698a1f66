"""Conversations in a prefix trie: containers of suffixes below trie heads, burst where they are too large."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyport.llm.registry import query
from tallyport.llm.tables import small_batches, table, written
from tallyport.session import small_side

# Bytes of a turn's id, and suffixes that a container holds before it is burst.
ID, CONTAINER = 16, 1024
# Member ids joined to one text before they are hashed.
CHUNK = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()

ENDED = "seq binary, cps array<int>, n long, least long, ends string"
SWEPT = (
    "head binary, path array<binary>, is_head boolean, turn_id binary, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


def digest(*parts: Column) -> Column:
    """The first 16 bytes of the SHA-256 of binary columns."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 2 * ID))


def turns_of(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turns): each conversation's turns as (id, code points), in order of turn, null first.

    Null role or text is empty, rows without conv_id belong to no conversation and are left out, rows of the same
    turn are ordered by the id of their role and text and all count. Turns are known by 16 bytes of a SHA-256; a
    conversation is a row, of 20 bytes a turn.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        digest(F.octet_length(role).cast("string").cast("binary"), F.lit(b":"), role.cast("binary"), text.cast("binary")).alias("id"),
        F.length(text).alias("cp"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("turn", "id", "cp")))
    return rows.groupBy("conv_id").agg(ordered.alias("turns")).select("conv_id", F.transform("turns", lambda t: F.struct(t.id.alias("id"), t.cp.alias("cp"))).alias("turns"))


def rebuilt(own: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """Conversations that begin with the first h turns of their group's first one, h below `heads` by a hash of the id."""
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % heads).cast("int")
    leads = own.where(c % group == 0).select(c.alias("_lead"), F.slice("turns", 1, heads - 1).alias("_turns"))
    joined = own.join(leads, c - c % group == F.col("_lead"), "left")
    none = F.slice("turns", 1, 0)
    first = F.slice(F.coalesce("_turns", none), F.lit(1), h)
    return joined.select("conv_id", F.concat(first, F.slice("turns", h + 1, F.lit(2**31 - 1))).alias("turns"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows of a key, at most CHUNK rows each, as (key, first id, number, ids joined, seq, cps)."""
    names = ["key", "first", "n", "ids", "seq", "cps"]
    for batch in batches:
        keys, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        begins = [k for k in range(len(keys)) if k % CHUNK == 0 or keys[k] != keys[k - 1]]
        ends = [*begins[1:], len(keys)]
        at = pa.array(begins, pa.int64())
        joined = [",".join(map(str, ids[b:e])) for b, e in zip(begins, ends, strict=True)]
        yield pa.record_batch(
            [batch.column(0).take(at), pa.array([ids[b] for b in begins], pa.int64()),
             pa.array([e - b for b, e in zip(begins, ends, strict=True)], pa.int64()), pa.array(joined, pa.string()),
             batch.column(2).take(at), batch.column(3).take(at)],
            names=names,
        )


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in order of key and first id to a row for each key; ids are hashed as they stream by."""
    names, kinds = ["seq", "cps", "n", "least", "ends"], [pa.binary(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.string()]
    key, row, sha = None, None, None
    for batch in batches:
        out = []
        for k, first, n, ids, seq, cps in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if k != key:
                if row:
                    out.append([*row, sha.hexdigest()])
                key, row, sha = k, [seq, cps, 0, first], hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
            row[2] += n
        if out:
            yield pa.record_batch([pa.array(v, t) for v, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
    if row:
        yield pa.record_batch([pa.array([v], t) for v, t in zip([*row, sha.hexdigest()], kinds, strict=True)], names=names)


def distinct_sequences(conversations: DataFrame) -> DataFrame:
    """Rows (seq, cps, n, least, ends): each distinct sequence of turns with number, least id and digest of its conversations.

    `conversations` has conv_id and turns. Copies of one conversation are ordered by ranges of (sequence, id), so many
    tasks share a large group; only the joined ids, thousands to a row, stream through the task that hashes
    them, for a SHA-256 is made in order.
    """
    sequence = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t.id)), ""))
    rows = written(conversations.select("conv_id", sequence.alias("seq"), F.col("turns.cp").alias("cps")), "sequences")
    keyed = rows.select(digest(F.col("seq")).alias("key"), "conv_id", "seq", "cps")
    ordered = keyed.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    chunks = ordered.mapInArrow(_chunks, "key binary, first long, n long, ids string, seq binary, cps array<int>")
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_ended, ENDED)


def common(low: str, high: str) -> Column:
    """The number of turns two sequences have in common at their begin."""
    return F.expr(
        f"if(length({low}) < {ID} or length({high}) < {ID}, 0, coalesce(nullif(array_position(transform("
        f"sequence(1, cast(least(length({low}), length({high})) / {ID} as int)), "
        f"i -> substring({low}, (i - 1) * {ID} + 1, {ID}) <> substring({high}, (i - 1) * {ID} + 1, {ID})), true), 0) - 1, "
        f"cast(least(length({low}), length({high})) / {ID} as int)))"
    ).cast("int")


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Containers, sorted by head and suffix, to the nodes from their head on."""
    names = [f.split()[0] for f in SWEPT.split(", ")]
    kinds = [pa.binary(), pa.list_(pa.binary()), pa.bool_(), pa.binary(), *[pa.int64()] * 7, pa.string()]
    container, nodes, open_nodes, before, out = None, [], [], b"", []

    def close(depth: int) -> None:
        """Closes the open nodes deeper than `depth` below the head; each adds what it gathered to its parent."""
        while len(open_nodes) > depth + 1:
            node = open_nodes.pop()
            node["leaves"] = node["leaves"] or 1
            node["saved"] += (node["n"] - 1) * node["cp"]
            if open_nodes:
                parent = open_nodes[-1]
                parent["n"] += node["n"]
                parent["least"] = min(parent["least"], node["least"])
                parent["children"] += 1
                parent["leaves"] += node["leaves"]
                parent["saved"] += node["saved"]

    def opened(turn: bytes | None, cp: int) -> None:
        node = {"turn": turn, "cp": cp, "n": 0, "least": 1 << 63, "children": 0, "leaves": 0, "saved": 0, "ends": NO_ENDS}
        node["above"], node["down"] = (open_nodes[-1] if open_nodes else None), len(open_nodes)
        nodes.append(node)
        open_nodes.append(node)

    def finished() -> None:
        close(-1)
        head, path, depth = container
        for x in nodes:
            above = x["above"]["least"] if x["above"] else None
            out.append((head, path, x["down"] == 0, x["turn"], x["least"], depth + x["down"], above, x["n"], x["children"], x["leaves"], x["saved"], x["ends"]))

    def batch_out() -> pa.RecordBatch:
        made = pa.record_batch([pa.array(v, t) for v, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
        out.clear()
        return made

    for batch in batches:
        for head, path, depth, turn, cp, seq, cps, n, least, ends in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if container is None or head != container[0]:
                if container is not None:
                    finished()
                container, nodes, open_nodes, before = (head, path, depth), [], [], b""
                opened(turn, cp)
            size, shared = len(seq) // ID, 0
            most = min(size, len(before) // ID)
            while shared < most and seq[ID * shared : ID * shared + ID] == before[ID * shared : ID * shared + ID]:
                shared += 1
            close(shared)
            for k in range(shared, size):
                opened(seq[ID * k : ID * k + ID], cps[k])
            last = open_nodes[-1]
            last["n"], last["least"], last["ends"] = last["n"] + n, min(last["least"], least), ends
            before = seq
        if out:
            yield batch_out()
    if container is not None:
        finished()
        yield batch_out()


def burst(sequences: DataFrame, container: int = CONTAINER) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Suffix containers of at most `container` rows; the heads that were burst, and the sequences that end at those.

    All begins in the root's container. A container that is too large is burst at the last node all its suffixes pass: one
    that ends there stays with the head, the others go to a container for each next turn id. A burst always parts a
    container, so there are at most as many rounds as branchings on a path; a round counts containers
    before the shuffle and moves no row.
    """
    root = F.unhex(F.lit("00" * ID))
    active = written(
        sequences.select(
            root.alias("head"), F.expr("cast(array() as array<binary>)").alias("path"), F.lit(0).alias("depth"),
            F.lit(None).cast("binary").alias("turn"), F.lit(0).alias("cp"), "seq", "cps", "n", "least", "ends",
        ),
        "container",
    )
    names, done, heads, stops = active.columns, [], [], []
    while True:
        held = active.groupBy("head").agg(
            F.count("*").alias("rows"), F.min(F.struct("seq", "cps", "path", "depth", "turn", "cp")).alias("low"), F.max("seq").alias("high")
        )
        large = held.where(F.col("rows") > container).select("head", "low.*", "high").withColumn("q", common("seq", "high"))
        large = small_side(large.withColumns({"seq": F.expr(f"substring(seq, 1, q * {ID})"), "cps": F.slice("cps", F.lit(1), F.col("q"))}))
        if large.isEmpty():
            done.append(active)
            break
        heads.append(large.drop("high"))
        marked = active.join(large.select("head", "q"), "head", "left")
        done.append(marked.where("q is null").select(*names))
        ending = F.length("seq") == F.col("q") * ID
        stops.append(marked.where(ending).select("head", "path", "n", "least", "ends"))
        begin = F.col("q") * ID
        next_turn = F.expr(f"substring(seq, q * {ID} + 1, {ID})")
        active = written(
            marked.where(~ending).select(
                digest(F.col("head"), F.expr(f"substring(seq, 1, (q + 1) * {ID})")).alias("head"),
                F.concat("path", F.array("head")).alias("path"),
                (F.col("depth") + F.col("q") + 1).alias("depth"),
                next_turn.alias("turn"),
                F.get("cps", F.col("q")).alias("cp"),
                F.substring("seq", begin + ID + 1, F.lit(2**31 - 1)).alias("seq"),
                F.slice("cps", F.col("q") + 2, F.lit(2**31 - 1)).alias("cps"),
                "n", "least", "ends",
            ),
            "container",
        )
    return _union(done), _union(heads), _union(stops)


def _union(frames: list[DataFrame]) -> DataFrame | None:
    out = None
    for df in frames:
        out = df if out is None else out.unionByName(df)
    return out


def trie(conversations: DataFrame, container: int = CONTAINER) -> DataFrame:
    """The nodes of the prefix trie of conversations given as (conv_id, turns of (id, cp)).

    Rows (turn_id, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256); conv_id,
    the smallest member, and depth name a node, turn_id its last turn (null at the root). An empty table has no node.
    """
    small_batches(conversations.sparkSession)
    containers, heads, stops = burst(distinct_sequences(conversations), container)
    kept = ["head", "path", "depth", "turn", "cp", "seq", "cps", "n", "least", "ends"]
    ordered = containers.select(*kept).repartition("head").sortWithinPartitions("head", "seq")
    columns = [f.split()[0] for f in SWEPT.split(", ")][3:]
    if heads is None:
        return ordered.mapInArrow(_sweep, SWEPT).select(*columns)
    swept = written(ordered.mapInArrow(_sweep, SWEPT), "nodes")
    heads = written(heads.withColumn("parent", F.expr("try_element_at(path, -1)")), "heads")
    stops = written(stops, "stops")

    # what a burst head gathers from the containers below it and from the sequences that end at it
    below = swept.where("is_head").select("path", F.col("n_convs").alias("n"), F.col("conv_id").alias("least"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
    ending = stops.select(F.concat("path", F.array("head")).alias("path"), "n", "least", F.lit(0).alias("leaves"), F.lit(0).alias("saved"))
    gathered = (
        below.unionByName(ending)
        .select(F.explode("path").alias("head"), "n", "least", "leaves", "saved")
        .groupBy("head")
        .agg(*[F.sum(c).alias(c) for c in ("n", "leaves", "saved")], F.min("least").alias("least"))
    )
    children = (
        swept.where("is_head").select(F.expr("try_element_at(path, -1)").alias("head")).unionByName(heads.select(F.col("parent").alias("head")))
        .groupBy("head").agg(F.count("*").alias("children"))
    )
    ends = stops.select("head", "ends")
    full = written(
        heads.join(gathered, "head").join(children, "head").join(ends, "head", "left")
        .withColumn("cps", F.concat(F.array("cp"), "cps"))
        .withColumn("own", (F.col("n") - 1) * F.aggregate("cps", F.lit(0).cast("long"), lambda a, x: a + x)),
        "heads",
    )
    deeper = full.select(F.explode("path").alias("head"), "own").groupBy("head").agg(F.sum("own").alias("deeper"))
    least = full.select(F.col("head").alias("parent"), F.col("least").alias("parent_least"))
    last = F.col("pos") == F.col("q")
    rest = F.aggregate(F.slice("cps", F.col("pos") + 1, F.size("cps") - F.col("pos")), F.lit(0).cast("long"), lambda a, x: a + x)
    chain = (
        full.join(deeper, "head", "left").join(least, "parent", "left")
        .withColumn("pos", F.explode(F.expr("sequence(0, q)")))
        .select(
            F.when(F.col("pos") == 0, F.col("turn")).otherwise(F.expr(f"substring(seq, (pos - 1) * {ID} + 1, {ID})")).alias("turn_id"),
            F.col("least").alias("conv_id"),
            (F.col("depth") + F.col("pos")).cast("long").alias("depth"),
            F.when(F.col("pos") == 0, F.col("parent_least")).otherwise(F.col("least")).alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            F.when(last, F.col("children")).otherwise(1).alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            (F.col("saved") + F.coalesce("deeper", F.lit(0)) + (F.col("n") - 1) * rest).alias("saved_tokens"),
            F.when(last, F.coalesce("ends", F.lit(NO_ENDS))).otherwise(NO_ENDS).alias("ends_sha256"),
        )
    )
    tops = swept.where("is_head").withColumn("parent", F.expr("try_element_at(path, -1)")).join(least, "parent", "left")
    tops = tops.withColumn("parent_conv_id", F.col("parent_least")).select(*columns)
    return swept.where("not is_head").select(*columns).unionByName(tops).unionByName(chain.select(*columns))


SQL = """
WITH t AS (
    SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT c, list({'id': md5(r) || md5(x), 'cp': length(x)} ORDER BY turn NULLS FIRST, r, x) AS ts FROM t GROUP BY c
), hashed AS (
    SELECT c, ts, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
        lambda acc, b: list_reduce(list_prepend(xor(acc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
            lambda v, z: xor(v >> 1, (v & 1) * 3988292384))), 4294967295) % 6 AS h
    FROM own
), whole AS (
    SELECT a.c, list_concat(CASE WHEN b.c IS NULL THEN [] ELSE list_slice(b.ts, 1, a.h) END, list_slice(a.ts, a.h + 1, len(a.ts))) AS ts
    FROM hashed a LEFT JOIN own b ON b.c = a.c - a.c % 100
), passed AS (
    SELECT c, d, len(ts) AS turns, array_to_string(list_transform(list_slice(ts, 1, d), lambda s: s.id), '/') AS node,
        array_to_string(list_transform(list_slice(ts, 1, d - 1), lambda s: s.id), '/') AS above,
        CASE WHEN d = 0 THEN 0 ELSE ts[d].cp END AS cp
    FROM (SELECT c, ts, unnest(range(0, len(ts) + 1)) AS d FROM whole)
), nodes AS (
    SELECT node, any_value(CASE WHEN d > 0 THEN above END) AS above, d, min(c) AS conv_id, count(*) AS n_convs, any_value(cp) AS cp,
        sha256(coalesce(string_agg(CASE WHEN turns = d THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends
    FROM passed GROUP BY node, d
), counted AS (
    SELECT n.*, (SELECT count(*) FROM nodes k WHERE k.d = n.d + 1 AND k.above = n.node) AS n_children FROM nodes n
), subtree AS (
    SELECT p.node, p.d, sum((k.n_convs - 1) * k.cp) AS saved, sum(CASE WHEN k.n_children = 0 THEN 1 ELSE 0 END) AS leaves
    FROM counted k JOIN passed p ON p.c = k.conv_id AND p.d <= k.d GROUP BY p.node, p.d
)
SELECT n.conv_id, n.d::BIGINT AS depth, a.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, n.n_children::BIGINT AS n_children,
    s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM counted n JOIN subtree s ON s.node = n.node AND s.d = n.d LEFT JOIN nodes a ON a.d = n.d - 1 AND a.node = n.above
"""


@query("op11_burst_trie", SQL)
def op11_burst_trie(spark, sf_dir):
    """Every node of the trie of all rebuilt conversations."""
    own = written(turns_of(table(spark, sf_dir, "conversations")), "conversations")
    return trie(rebuilt(own)).drop("turn_id")
