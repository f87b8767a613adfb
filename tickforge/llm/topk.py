"""Exact top-k inner-product search by columnar branch-and-bound.

Vectors become integers floor(scale * x) and are packed into blocks with one column after the other. For a block of
queries against a block of candidates, scores accumulate over blocks of dimensions. After each, what the dimensions
left can add is at most the product of the rests' norms (Cauchy-Schwarz), and at least its negative; a candidate
whose best possible score is below the k-th largest guaranteed score is dropped, and survivors are compacted before
the next dimensions. Queries are a stated share of the rows; each cell of query block and candidate block is a row
of an equi-join on the block numbers, spread over all tasks, so nothing is collected. Each cell gives k rows a query
at most, and ranks follow from a window whose partial limit runs before its shuffle.

Edge cases: vectors that are null, empty, or hold null or non-finite components take no part, nor do rows with a null
vec_id; vectors are compared with those of their own length; equal scores go to the smaller vec_id; with fewer than k candidates all
are returned; rows that repeat a vec_id are candidates each, and a query by that vec_id uses its least vector; extra
columns are ignored. Arithmetic is exact: in double precision while sums stay below 2**53, else in 64-bit integers
(scores beyond 64 bits are out of contract).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch

SCALE, K = 64, 20
QUERY_BLOCK, CANDIDATE_BLOCK, DIMENSION_BLOCK = 512, 2048, 16


def _quantised(batch: pa.RecordBatch, column: str, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, integer vectors) of the usable rows, a pair for each length of vector."""
    lists = batch.column(column)
    keep = np.asarray(lists.is_valid()) & np.asarray(batch.column("vec_id").is_valid())
    lists, ids = lists.filter(pa.array(keep)), batch.column("vec_id").filter(pa.array(keep)).to_numpy()
    flat = lists.flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
    size = np.asarray(lists.value_lengths())
    first = np.cumsum(size) - size
    for n in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == n)
        x = values[first[rows][:, None] + np.arange(n)]
        ok = np.isfinite(x).all(axis=1)
        yield ids[rows][ok], np.floor(x[ok] * scale).astype(np.int64)


def _pack(block: int, scale: int):
    """Rows of at most `block` vectors: block number (unique), length, ids, and the columns one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def put(n: int, ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([ids.tobytes()]), pa.array([np.ascontiguousarray(x.T).tobytes()])], names=["dim", "ids", "cols"])

        for batch in batches:
            for ids, x in _quantised(batch, "embedding", scale):
                n = x.shape[1]
                old = held.get(n)
                ids, x = (ids, x) if old is None else (np.concatenate([old[0], ids]), np.concatenate([old[1], x]))
                while len(ids) >= block:
                    yield put(n, ids[:block], x[:block])
                    ids, x = ids[block:], x[block:]
                held[n] = [ids, x]
        for n, (ids, x) in held.items():
            if len(ids):
                yield put(n, ids, x)

    return run


def search(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, score) of each query's k largest products with candidates of another id.

    q, c: (dimensions, rows). Candidates are compacted when no query of the block needs them any more.
    """
    dims, n_q = q.shape
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * dims
    kind = np.float64 if top < 2**53 else np.int64
    q, c = q.astype(kind), c.astype(kind)
    rest = lambda x: np.sqrt(np.cumsum((x.astype(np.float64) ** 2)[::-1], axis=0)[::-1])
    q_rest, c_rest = rest(q), rest(c)
    alive = np.arange(c.shape[1])
    same = q_ids[:, None] == c_ids[None, :]
    score = np.zeros((n_q, len(alive)), kind)
    for d in range(0, dims, DIMENSION_BLOCK):
        score += q[d : d + DIMENSION_BLOCK].T @ c[d : d + DIMENSION_BLOCK]
        end = d + DIMENSION_BLOCK
        if end >= dims or len(alive) <= k + 1:
            continue
        # Rounded up by more than the error of the norms.
        left = np.outer(q_rest[end], c_rest[end]) * (1 + 1e-9) + 1e-6
        floor = np.where(same, -np.inf, score - left)
        bound = np.partition(floor, len(alive) - k, axis=1)[:, len(alive) - k] if len(alive) > k else np.full(n_q, -np.inf)
        need = ((score + left >= bound[:, None]) & ~same).any(axis=0)
        if need.sum() < 0.8 * len(need):
            alive, c, c_rest, same, score = alive[need], c[:, need], c_rest[:, need], same[:, need], score[:, need]
    rows, cols, values = [], [], []
    for i in range(n_q):
        ok = np.flatnonzero(~same[i])
        order = ok[np.lexsort((c_ids[alive[ok]], -score[i, ok]))[:k]]
        rows.append(np.full(len(order), i))
        cols.append(alive[order])
        values.append(score[i, order])
    return tuple(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (rows, cols, values))


def _cells(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, qi, qc, ci, cc in zip(batch.column("dim").to_pylist(), *(batch.column(x) for x in ("q_ids", "q_cols", "ids", "cols")), strict=True):
                q_ids, c_ids = (np.frombuffer(x.as_buffer(), np.int64) for x in (qi, ci))
                q, c = (np.frombuffer(x.as_buffer(), np.int64).reshape(dim, -1) for x in (qc, cc))
                r, j, s = search(q_ids, q, c_ids, c, k)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[r]), pa.array(c_ids[j]), pa.array(s)], names=["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best among `vectors` (vec_id, embedding)."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    schema = "dim int, ids binary, cols binary"
    pick = lambda df: df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    one = pick(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    # Partitions of about a block, however the tables are cut.
    blocks = lambda df, size: df.repartition(max(1, -(-df.count() // size)))
    q = blocks(one, QUERY_BLOCK).mapInArrow(_pack(QUERY_BLOCK, scale), schema).withColumn("q", F.monotonically_increasing_id())
    c = blocks(pick(vectors), CANDIDATE_BLOCK).mapInArrow(_pack(CANDIDATE_BLOCK, scale), schema).withColumn("c", F.monotonically_increasing_id())
    q, c = scratch.write(q, "queries"), scratch.write(c, "candidates")
    # Block numbers only: their pairs are the cells, and each block is joined to its cells.
    q_keys, c_keys = q.select("q", "dim"), c.select("c", "dim")
    cells = q_keys.join(c_keys, "dim").repartition("q", "c")
    full = cells.join(q.select("q", F.col("ids").alias("q_ids"), F.col("cols").alias("q_cols")), "q").join(c.select("c", "ids", "cols"), "c")
    hits = full.select("dim", "q_ids", "q_cols", "ids", "cols").mapInArrow(_cells(k), "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
