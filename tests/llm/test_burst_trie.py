import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tallyport.llm import burst_trie


def model(rows):
    """Rows (conv_id, turn, role, text) to the rows of the trie of the rebuilt conversations."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])
        built[c] = tuple(base[:h] + ts[h:])
    nodes = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(ts[:d], []).append(c)
    out = []
    for path, members in nodes.items():
        subtree = [p for p in nodes if p[: len(path)] == path]
        children = lambda p: sum(len(q) == len(p) + 1 and q[: len(p)] == p for q in nodes)
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in subtree if p)
        ends = ",".join(map(str, sorted(c for c in members if built[c] == path)))
        parent = min(nodes[path[:-1]]) if path else None
        leaves = sum(children(p) == 0 for p in subtree)
        out.append((min(members), len(path), parent, len(members), children(path), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(spark, rows, container):
    schema = "conv_id long, turn long, role string, text string"
    conversations = spark.createDataFrame(rows, schema).withColumns({c: F.lit(1) for c in ("head", "seq", "cp", "n", "key")})
    found = burst_trie.trie(burst_trie.rebuilt(burst_trie.turns_of(conversations)), container)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in found.select(*columns).collect()), key=repr)


def drawn(seed):
    draw = random.Random(seed)
    texts = ["a", "bb", "", None, "日本", "x" * 50]
    rows = []
    for c in [*range(40), *range(100, 130), -7, -100, 505, 10**15]:
        for turn in range(draw.randrange(1, 9)):
            rows.append((c, draw.choice([turn, turn, turn, None]), draw.choice(["user", "user", None]), draw.choice(texts[: draw.choice([1, 2, 6])])))
    rows += [(None, 1, "user", "x"), (3, 1, "user", "a"), (3, 1, "user", "a")]
    # a long conversation and copies of it without a base
    rows += [(c, t, "user", str(t)) for c in (777, 778, 779, 1776) for t in range(60)]
    return rows


@pytest.mark.parametrize("seed, container", [(1, 1), (2, 5), (3, 1024)])
def test_trie_is_that_of_the_model(spark, seed, container):
    rows = drawn(seed)
    # the contract leaves the order of rows of one turn open; the model orders by role and text, so give none
    seen, single = set(), []
    for row in rows:
        if row[:2] not in seen:
            seen.add(row[:2])
            single.append(row)
    assert result(spark, single, container) == model(single)


def test_tied_turns_have_one_order(spark):
    rows = drawn(5)
    turned = rows[::-1]
    assert result(spark, rows, 3) == result(spark, turned, 7)


def test_empty_and_turnless(spark):
    assert result(spark, [], 1) == []
    # conversation 9 loses all its turns: its group has no first conversation
    rows = [(c, 0, "user", "hello") for c in range(1, 30)]
    found = result(spark, rows, 2)
    assert found == model(rows) and any(r[1] == 0 for r in found)
