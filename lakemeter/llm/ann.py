"""Nearest neighbours by cosine: a block matrix join of int8 tiles (operator 5).

Vectors are scaled to length 1 and quantised to int8 with one scale each.  Rows of a block of
queries times columns of a block of candidates give a tile of int8 products; the quantisation
errors of both sides (their exact Euclidean lengths) bound how far a product can be from the true
cosine.  Pairs whose upper bound reaches the k-th best lower bound of their query survive and are
computed in double precision; heaps merge them over the tiles of a task, and a ranking over the
tasks.  The bounds hold for every pair, so the result is exact (recall 1).

Cases: vectors that are null or zero or hold null or non-finite components, and rows without an
id, take no part; only vectors of equal length are compared; rows that share an id are never each
other's neighbours; rows that repeat id and vector count once; an id that is a query with several
vectors is asked with its least one.  No query or no candidate: no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemeter.llm import vectors as V

BLOCK = 8192
QUERY_BLOCK = 512


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow or underflow on the way."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def quantise(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, the length of what they stand for, the length of the error."""
    scale = np.abs(u).max(axis=1) / 127.0
    cells = np.rint(u / scale[:, None]).astype(np.int8)
    stood = cells * scale[:, None]
    return cells, scale, np.sqrt((stood * stood).sum(1)), np.sqrt(((u - stood) ** 2).sum(1))


def tile_bounds(a, b) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all cosines of a tile, from int8 products."""
    qa, sa, na, ea = a
    qb, sb, nb, eb = b
    exact = np.float32 if qa.shape[1] * 127 * 127 < 2 ** 24 else np.float64  # sums of int8 products are whole
    product = (qa.astype(exact) @ qb.astype(exact).T).astype(np.float64) * sa[:, None] * sb[None, :]
    error = na[:, None] * eb[None, :] + ea[:, None] * nb[None, :] + ea[:, None] * eb[None, :] + 1e-12
    return product - error, product + error


def cosine(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", under="ignore", invalid="ignore", divide="ignore"):
        value = (x * q).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((q * q).sum()))
    odd = ~np.isfinite(value)
    if odd.any():
        value[odd] = (unit(x[odd]) * unit(q[None, :])).sum(1)
    return value


def search(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` greatest cosines of each query's row; ``is_query`` is a condition on ``id``."""
    rows = V.usable(df, id_col, vec_col).filter(F.exists("vec", lambda x: x != 0))
    queries = rows.filter(is_query).groupBy("id").agg(F.min("vec").alias("vec")).withColumn("dim", F.size("vec"))
    numbered = V.hashed_blocks(rows, BLOCK)
    candidates = V.pack(numbered)
    asked = V.pack(V.hashed_blocks(queries, QUERY_BLOCK)).select(
        "dim", F.col("ids").alias("q_ids"), F.col("cells").alias("q_cells"))
    blocks = numbered.select("dim", "block").distinct().groupBy("dim").agg(F.collect_list("block").alias("blocks"))
    grid = asked.join(blocks, "dim").withColumn("block", F.explode("blocks")).drop("blocks")

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list[tuple[float, int]]] = {}
        for batch in batches:
            for r in batch.to_pylist():
                q_ids, qs = V.unpack(r["q_ids"], r["q_cells"], r["dim"])
                ids, x = V.unpack(r["ids"], r["cells"], r["dim"])
                low, high = tile_bounds(quantise(unit(qs)), quantise(unit(x)))
                own = q_ids[:, None] == ids[None, :]
                low[own] = high[own] = -np.inf
                cut = np.partition(low, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(q_ids), -np.inf)
                for i, query_id in enumerate(q_ids.tolist()):
                    heap = heaps.setdefault(query_id, [])
                    least = max(cut[i], heap[0][0] - 1e-9) if len(heap) == k else cut[i]
                    live = np.flatnonzero((high[i] >= least) & ~own[i])
                    for score, vec_id in zip(cosine(x[live], qs[i]).tolist(), ids[live].tolist()):
                        entry = (score, -vec_id)
                        if len(heap) < k:
                            heapq.heappush(heap, entry)
                        elif entry > heap[0]:
                            heapq.heapreplace(heap, entry)
            if len(heaps) > 50_000:
                yield _rows(heaps)
                heaps = {}
        yield _rows(heaps)

    pairs = grid.join(candidates, ["dim", "block"]).select("dim", "q_ids", "q_cells", "ids", "cells")
    return V.best(pairs.mapInArrow(tiles, "query_id long, vec_id long, score double"), k)


def _rows(heaps: dict[int, list[tuple[float, int]]]) -> pa.RecordBatch:
    rows = [(q, -vec_id, score) for q, heap in heaps.items() for score, vec_id in heap]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))],
        names=["query_id", "vec_id", "score"])
