"""Exact search of the largest inner products with bounds from segment statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyport.llm.registry import query
from tallyport.llm.tables import numbered, table, written

SCALE = 256
# Segments of each resolution, coarse to fine.
LEVELS = (1, 4, 16)
QUERY_BLOCK, ROW_BLOCK = 256, 2048
# Copies of a query block, so that one block does not bring all rows to one task.
SALTS = 32
BLOCK = "dim int, first long, ids binary, numbers binary"


def _blocks(batches: Iterator[pa.RecordBatch], size: int, scale: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, vector) packed to matrices of at most `size` rows of one dimension."""
    held: dict[int, list[tuple[int, np.ndarray]]] = {}

    def packed(dim: int) -> pa.RecordBatch:
        rows = held.pop(dim)
        with np.errstate(over="ignore"):
            matrix = np.floor(np.array([v for _, v in rows], np.float64).reshape(len(rows), dim) * scale)
        matrix = np.clip(matrix, -LARGEST, LARGEST)
        return pa.record_batch(
            [
                pa.array([dim], pa.int32()),
                pa.array([rows[0][0]], pa.int64()),
                pa.array([np.array([i for i, _ in rows], np.int64).tobytes()], pa.binary()),
                pa.array([matrix.tobytes()], pa.binary()),
            ],
            names=["dim", "first", "ids", "numbers"],
        )

    for batch in batches:
        for i, vector in zip(batch.column(0), batch.column(1), strict=True):
            if not i.is_valid or not vector.is_valid or vector.values.null_count:
                continue
            numbers = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if not np.isfinite(numbers).all():
                continue
            rows = held.setdefault(len(numbers), [])
            rows.append((i.as_py(), numbers))
            if len(rows) == size:
                yield packed(len(numbers))
    for dim in list(held):
        yield packed(dim)


LARGEST = np.finfo(np.float64).max


def _statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Segment means and deviations, scaled so that their distance bounds that of the vectors from below."""
    parts = np.array_split(np.arange(x.shape[1]), min(segments, x.shape[1]))
    out = np.empty((len(x), 2 * len(parts)))
    for k, part in enumerate(parts):
        out[:, 2 * k] = x[:, part].mean(axis=1) * np.sqrt(len(part))
        out[:, 2 * k + 1] = x[:, part].std(axis=1) * np.sqrt(len(part))
    return out


def _exact(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products as integers; beyond 2^53 with Python's, cut to the range of a long."""
    if np.abs(q).max(initial=0) * np.abs(rows).max(initial=0) * max(1, len(q)) < 2**53:
        return (rows @ q).astype(np.int64)
    wide = [sum(int(a) * int(b) for a, b in zip(q, row, strict=True)) for row in rows]
    return np.array([min(max(s, -(2**63)), 2**63 - 1) for s in wide], np.int64)


def best_of(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query of a block the ids and scores of its k best rows of another block.

    With segment means and deviations the squared distance of two vectors is at least the sum
    of the squared differences of both; with the norms this bounds the inner product from
    above. Rows whose bound is below the k-th best score known are dropped, coarse levels
    first, and the rest are computed exactly.
    """
    dim = x.shape[1]
    # bounds are taken of components of at most 1, so that no square overflows; scores are cut to the range of a long
    unit = max(1.0, np.abs(x).max(initial=0), np.abs(q).max(initial=0))
    small_x, small_q = x / unit, q / unit
    x_norm, q_norm = (small_x * small_x).sum(axis=1), (small_q * small_q).sum(axis=1)
    levels = [(_statistics(small_q, s), _statistics(small_x, s)) for s in LEVELS] if dim else []
    for at, own in enumerate(q_ids):
        alive = np.flatnonzero(ids != own)
        if dim and len(alive) > k:
            slack = 1 / unit / unit + 1e-9 * (q_norm[at] + x_norm.max())
            floor = None
            for of_q, of_x in levels:
                gaps = of_x[alive] - of_q[at]
                bound = (q_norm[at] + x_norm[alive] - (gaps * gaps).sum(axis=1)) / 2 + slack
                if floor is None:
                    likely = alive[np.argpartition(-bound, k - 1)[:k]]
                    score = _exact(q[at], x[likely]).min()
                    floor = -np.inf if score == -(2**63) else float(score) / unit / unit
                alive = alive[bound >= floor]
        scores = _exact(q[at], x[alive])
        order = np.lexsort((ids[alive], -scores.astype(np.float64) if abs(scores).max(initial=0) < 2**53 else ~scores))[:k]
        yield int(own), ids[alive][order], scores[order]


def _searched(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for dim, q_ids, q, ids, x in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
            q_ids, ids = np.frombuffer(q_ids, np.int64), np.frombuffer(ids, np.int64)
            queries, rows = (np.frombuffer(m, np.float64).reshape(-1, dim) if dim else np.empty((len(i), 0)) for m, i in ((q, q_ids), (x, ids)))
            found = list(best_of(q_ids, queries, ids, rows, k))
            yield pa.record_batch(
                [
                    pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]), pa.int64()),
                    pa.array(np.concatenate([f[1] for f in found]), pa.int64()),
                    pa.array(np.concatenate([f[2] for f in found]), pa.int64()),
                ],
                names=["query_id", "vec_id", "score"],
            )


def top_k(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """The `k` rows with the largest inner product for each query: query_id, rank, vec_id, score.

    Components x become floor(scale * x). Blocks of queries meet blocks of rows; each meeting
    gives at most k rows a query, of which Spark keeps the best k. Ties go to the smaller id.
    Rows and queries with a null id, a null vector or a null, infinite or NaN component take
    no part; vectors of another length than the query's are not compared, those of length 0
    have score 0. A query does not find rows of its own id; a query id that repeats is asked
    once, with its least vector; a candidate that repeats counts each time. Other columns are not read.
    """
    vector = F.col(vector_col).cast("array<double>")
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    asked = queries.where(vector.isNotNull() & ~F.coalesce(odd, F.lit(False))).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(vector).alias("vector"))
    q = written(asked.mapInArrow(lambda it: _blocks(it, QUERY_BLOCK, scale), BLOCK), "queries")
    q = written(numbered(q, F.col("first"), F.col("dim"), "number", cells=16), "queries")
    blocks = F.broadcast(q.groupBy("dim").agg(F.count("*").alias("n")))  # a row for each length of vector
    x = rows.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector")).mapInArrow(
        lambda it: _blocks(it, ROW_BLOCK, scale), BLOCK
    )
    x = x.join(blocks, "dim").select(
        "dim",
        F.col("ids").alias("row_ids"),
        F.col("numbers").alias("row_numbers"),
        F.pmod(F.xxhash64("first"), F.lit(SALTS)).alias("salt"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("number"),
    )
    salted = q.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    met = salted.join(x, ["dim", "number", "salt"]).select("dim", "ids", "numbers", "row_ids", "row_numbers")
    found = met.mapInArrow(lambda it: _searched(it, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query(
    "op3_topk_search",
    """
    with v as (
        select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
        where vec_id is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), pairs as (
        select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
        from v q join v c on q.vec_id != c.vec_id and len(q.v) = len(c.v) where q.vec_id % 50 = 0
    ), ranked as (
        select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from pairs
    )
    select query_id, rank, vec_id, score from ranked where rank <= 5
    """,
)
def op3_topk_search(spark, sf_dir):
    """The five best rows for every fiftieth vector, searched in all vectors."""
    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.where("vec_id % 50 = 0"))
