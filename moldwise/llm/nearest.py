"""Nearest neighbours by largest inner product: a block matrix join over int8 tiles with error bounds.

Queries and candidates are dealt into blocks, and each pair of blocks is a
task.  Vectors are scaled to int8; the product of two blocks (exact in
float32) gives every inner product up to a bound from the vectors' norms and
those of their rounding errors.  Pairs that can still be among a query's k
best are computed again in double precision, component after component, and
go through a heap for each query; a window picks the k best of all blocks.

Vectors that are null, empty, zero, or hold null or non-finite components take
no part, nor do rows without an id.  Rows alike in id and vector count once;
vectors meet only those of as many components.  A query with no other vector
has no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, BLOCK, TILE = 20, 4096, 1024
EXACT = 1024  # components whose int8 products add up exactly in float32


def usable(vector: Column) -> Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & whole & F.exists(vector, lambda x: x != 0)


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, and the norms of the rows, of the rounded rows and of the differences."""
    scale = np.abs(x).max(axis=1) / 127
    scale[scale == 0] = np.finfo(float).tiny
    q = np.rint(x / scale[:, None])
    back = q * scale[:, None]
    return q.astype(np.int8), scale, np.linalg.norm(x, axis=1), np.linalg.norm(back, axis=1), np.linalg.norm(x - back, axis=1)


def tile_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of int8 rows, exactly."""
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT):
        out += a[:, at : at + EXACT].astype(np.float32) @ b[:, at : at + EXACT].astype(np.float32).T
    return out


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed from the first component to the last."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


def block_best(ids: np.ndarray, x: np.ndarray, other_ids: np.ndarray, y: np.ndarray, k: int) -> list[list[tuple[float, int]]]:
    """The k best (score, -id) of one block of candidates for each query of another."""
    heaps: list[list[tuple[float, int]]] = [[] for _ in ids]
    qx, sx, nx, rx, ex = quantised(x)
    for at in range(0, len(y), TILE):
        part, names = y[at : at + TILE], other_ids[at : at + TILE]
        qy, sy, ny, _, ey = quantised(part)
        near = tile_product(qx, qy) * sx[:, None] * sy
        bound = (ex[:, None] * ny + rx[:, None] * ey) * (1 + 1e-9) + 1e-12 * nx[:, None] * ny
        own = ids[:, None] == names
        low = np.where(own, -np.inf, near - bound)
        kth = np.partition(low, -k, axis=1)[:, -k] if len(names) >= k else np.full(len(ids), -np.inf)
        floor = np.maximum(kth, [h[0][0] if len(h) >= k else -np.inf for h in heaps])
        query, other = np.nonzero(~own & ~(near + bound < floor[:, None]))
        for i, j, score in zip(query.tolist(), other.tolist(), exact_products(x[query], part[other]).tolist()):
            entry = (score, -int(names[j]))
            if len(heaps[i]) < k:
                heapq.heappush(heaps[i], entry)
            elif entry > heaps[i][0]:
                heapq.heapreplace(heaps[i], entry)
    return heaps


def nearest(queries: DataFrame, candidates: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates of largest inner product with each query, without its own id.

    Both sides have ``vec_id`` and ``embedding``.  Each query meets all
    candidates, block by block; a task holds two blocks.
    """
    sides = []
    for side in (queries, candidates):
        vector = F.col("embedding").cast("array<double>")
        clean = side.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("embedding"))
        clean = clean.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).dropDuplicates(["vec_id", "embedding"])
        sides.append(clean.withColumn("key", F.xxhash64("embedding")))
    blocks = [max(1, -(-s.count() // block)) for s in sides]
    cells = []
    for mine, (side, n, others) in enumerate(zip(sides, blocks, reversed(blocks))):
        own = F.pmod(F.xxhash64("vec_id", "key"), F.lit(n)).cast("int").alias("own")
        dealt = side.select("*", own, F.size("embedding").alias("dim")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
        one, two = ("own", "other") if mine == 0 else ("other", "own")
        cells.append(dealt.select("dim", F.col(one).alias("one"), F.col(two).alias("two"), F.lit(mine == 0).alias("asks"), "vec_id", "key", "embedding"))

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        asks = rows.column("asks").to_numpy()
        ids, marks = rows.column("vec_id").to_numpy(), rows.column("key").to_numpy()
        x = rows.column("embedding").combine_chunks()
        x = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        found = block_best(ids[asks], x[asks], ids[~asks], x[~asks], k)
        count = [len(h) for h in found]
        flat = [e for h in found for e in h]
        return pa.table({
            "query_id": pa.array(np.repeat(ids[asks], count), pa.int64()), "key": pa.array(np.repeat(marks[asks], count), pa.int64()),
            "vec_id": pa.array([-e[1] for e in flat], pa.int64()), "score": pa.array([e[0] for e in flat], pa.float64()),
        })

    best = cells[0].unionByName(cells[1]).groupBy("dim", "one", "two").applyInArrow(run, "query_id long, key long, vec_id long, score double")
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_report(vectors: DataFrame, every: int = 20) -> DataFrame:
    return nearest(vectors.where(F.col("vec_id") % every == 0), vectors)


ORACLE_SQL = """
with v as (select distinct vec_id, embedding::double[] as e from embeddings where vec_id is not null and embedding is not null),
ok as (select * from v where len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
pairs as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e) as score
          from ok q join ok c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id and len(q.e) = len(c.e)),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from pairs)
select query_id, rank::integer as rank, vec_id, score from ranked where rank <= 20
"""
