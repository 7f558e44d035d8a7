"""Exact top-k by inner product with pivot-table elimination (operator 2).

Each vector becomes whole numbers.  A table of its distances to ``PIVOTS`` pivot vectors bounds
its distance to a query from below (triangle inequality, greatest bound over all pivots), hence
its inner product from above: ``q.x = (|q|^2 + |x|^2 - |q-x|^2) / 2``.  Candidates lie in cells
around their nearest pivot, cells in blocks of bounded size.  A query visits only the cells whose
greatest possible score reaches the k-th best score it has among the pivots; in a block it takes
candidates in bound order and stops when the next bound is below its k-th best score.  Bounds
only order and end the work: every score is exact, and no candidate is dropped otherwise.

Cases: vectors that are null or hold null or non-finite components, and rows without an id, take
no part; only vectors of equal length are compared; components beyond 64 bits are clamped, and
scores too; rows that share an id are never each other's candidates; as a query an id counts once
(its least vector), as candidates rows that repeat id and vector count once.  No query or no
candidate: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemeter.llm import vectors as V

#: pivots in all (a bounded table that every task holds), rows of a block, candidates tried at a time
PIVOTS = 64
BLOCK = 4096
QUERY_BLOCK = 512
STEP = 256
_LONG = 2 ** 63 - 1


def whole_numbers(rows: DataFrame, scale: float = 256.0) -> DataFrame:
    """``usable`` rows with each component x as floor(scale * x)."""
    return rows.withColumn("vec", F.transform("vec", lambda x: F.floor(x * F.lit(scale)).cast("double")))


class Pivots:
    """Pivot vectors by dimension, and bounds from distances to them."""

    def __init__(self, rows):
        self.ids: dict[int, np.ndarray] = {}
        self.vecs: dict[int, np.ndarray] = {}
        for dim in sorted({len(r["vec"]) for r in rows}):
            own = [r for r in rows if len(r["vec"]) == dim]
            self.ids[dim] = np.array([r["id"] for r in own], np.int64)
            self.vecs[dim] = np.array([r["vec"] for r in own], np.float64).reshape(len(own), dim)

    def distances(self, x: np.ndarray) -> np.ndarray:
        p = self.vecs.get(x.shape[1])
        if p is None:
            return np.zeros((len(x), 0))
        with np.errstate(over="ignore", invalid="ignore"):
            d = (x * x).sum(1)[:, None] + (p * p).sum(1)[None, :] - 2 * (x @ p.T)
            return np.nan_to_num(np.sqrt(np.maximum(d, 0)), nan=0.0, posinf=0.0)


def scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers held as doubles, exact, clamped to 64 bits."""
    if not x.size:
        return np.zeros(len(x), np.int64)
    if np.abs(x).max() * np.abs(q).max() * x.shape[1] < 2.0 ** 53:
        return (x @ q).astype(np.int64)
    own = [int(b) for b in q]
    return np.array([max(-_LONG - 1, min(_LONG, sum(int(a) * b for a, b in zip(row, own)))) for row in x], np.int64)


def upper_bounds(q: np.ndarray, q_dist: np.ndarray, norm2: np.ndarray, dist: np.ndarray) -> np.ndarray:
    """Greatest possible inner product of ``q`` with each row, from its distances to the pivots."""
    with np.errstate(over="ignore", invalid="ignore"):
        square = float(q @ q)
        gap = np.abs(dist - q_dist).max(axis=1) if dist.shape[1] else np.zeros(len(norm2))
        slack = 1e-6 * (square + norm2) + 1.0  # more than the rounding of the distances
        bound = np.minimum((square + norm2 - gap * gap) / 2, np.sqrt(square * norm2)) + slack
        return np.nan_to_num(bound, nan=np.inf)


def top(ids: np.ndarray, x: np.ndarray, dist: np.ndarray, norm2: np.ndarray, query_id: int, q: np.ndarray,
        q_dist: np.ndarray, least: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best of one block for one query, in bound order until the next bound is too low."""
    bound = upper_bounds(q, q_dist, norm2, dist)
    open_ = np.flatnonzero((bound >= least) & (ids != query_id))
    open_ = open_[np.argsort(-bound[open_], kind="stable")]
    best_ids, best_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for at in range(0, len(open_), STEP):
        some = open_[at:at + STEP]
        if len(best_scores) == k and bound[some[0]] < best_scores[-1]:
            break
        best_ids = np.concatenate([best_ids, ids[some]])
        best_scores = np.concatenate([best_scores, scores(x[some], q)])
        order = np.lexsort((best_ids, ~best_scores))[:k]  # highest first, ties to the smaller id
        best_ids, best_scores = best_ids[order], best_scores[order]
    return best_ids, best_scores


def pivot_rows(rows: DataFrame) -> DataFrame:
    """``PIVOTS`` rows by hash of the id, one of each id and dimension (its least vector): a repeated
    row is one candidate, so it counts once in the k-th best score among the pivots."""
    chosen = rows.select("id", "dim").distinct().orderBy(F.xxhash64("id"), "id", "dim").limit(PIVOTS)
    return rows.join(F.broadcast(chosen), ["id", "dim"]).groupBy("id", "dim").agg(F.min("vec").alias("vec"))


def search(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
           scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` greatest inner products of each query's row.

    ``is_query`` is a condition on ``id``."""
    rows = whole_numbers(V.usable(df, id_col, vec_col), scale)
    queries = rows.filter(is_query).groupBy("id").agg(F.min("vec").alias("vec")).withColumn("dim", F.size("vec"))
    pivots = Pivots(pivot_rows(rows).collect())  # PIVOTS rows at most

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch["dim"].to_numpy()
            for dim in np.unique(dims):
                own = batch.filter(pa.array(dims == dim))
                dist = pivots.distances(V.matrix(own, int(dim)))
                cell = dist.argmin(axis=1) if dist.shape[1] else np.zeros(len(dist), np.int64)
                yield pa.RecordBatch.from_arrays([own["dim"], pa.array(cell, pa.int32()), own["id"], own["vec"]],
                                                 names=["dim", "cell", "id", "vec"])

    placed = rows.select("dim", "id", "vec").mapInArrow(cells, "dim int, cell int, id long, vec array<double>")
    # a row for each cell in use: a block is a cell, or a share of one that holds many rows
    shares = (placed.groupBy("dim", "cell").count()
              .select("dim", "cell", F.ceil(F.col("count") / BLOCK).cast("int").alias("shares")))
    number = F.col("cell") + PIVOTS * F.pmod(F.xxhash64("id"), F.col("shares")).cast("int")
    candidates = V.pack(placed.join(shares, ["dim", "cell"]).withColumn("block", number))
    asked = V.pack(V.hashed_blocks(queries, QUERY_BLOCK)).select(
        "dim", F.col("n").alias("q_n"), F.col("ids").alias("q_ids"), F.col("cells").alias("q_cells"))
    # every block of queries meets every block of candidates of its dimension, one pair at a time
    blocks = shares.select("dim", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "cell")
    blocks = blocks.groupBy("dim").agg(F.collect_list(F.col("cell") + PIVOTS * F.col("share")).alias("blocks"))
    grid = asked.join(blocks, "dim").withColumn("block", F.explode("blocks")).drop("blocks")

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                q_ids, qs = V.unpack(r["q_ids"], r["q_cells"], r["dim"])
                ids, x = V.unpack(r["ids"], r["cells"], r["dim"])
                dist, q_dist = pivots.distances(x), pivots.distances(qs)
                with np.errstate(over="ignore"):
                    norm2 = (x * x).sum(1)
                # the cell as a whole: no candidate can be nearer than the gap to the cell's range
                low, high = (dist.min(0), dist.max(0)) if dist.shape[1] else (np.zeros(0), np.zeros(0))
                out_q, out_id, out_score = [], [], []
                for query_id, q, d in zip(q_ids.tolist(), qs, q_dist):
                    p_ids = pivots.ids.get(r["dim"], np.zeros(0, np.int64))
                    known = np.sort(scores(pivots.vecs[r["dim"]][p_ids != query_id], q))[::-1] if len(p_ids) else []
                    least = float(known[k - 1]) if len(known) >= k else -np.inf
                    gap = np.maximum(np.maximum(low - d, d - high), 0).max(initial=0.0)
                    reach = upper_bounds(q, np.array([gap]), norm2.max(keepdims=True), np.zeros((1, 1)))[0]
                    if reach < least:
                        continue
                    found, score = top(ids, x, dist, norm2, query_id, q, d, least, k)
                    out_q.append(np.full(len(found), query_id))
                    out_id.append(found)
                    out_score.append(score)
                if out_q:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (out_q, out_id, out_score)],
                                                     names=["query_id", "vec_id", "score"])

    pairs = grid.join(candidates, ["dim", "block"]).select("dim", "q_ids", "q_cells", "ids", "cells")
    return V.best(pairs.mapInArrow(tile, "query_id long, vec_id long, score long"), k)
