"""Vectors in packed blocks: bounded groups of rows as one row, and the grid of block pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PACKED = "dim int, block int, n int, ids binary, cells binary"


def finite(vec_col: str) -> Column:
    """Whether the vector is not null and all its components are numbers (no null, NaN or infinity)."""
    v = F.col(vec_col)
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & F.coalesce(whole, F.lit(False))


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec array<double>, dim) of the rows that take part; a row without an id does not."""
    rows = df.filter(F.col(id_col).isNotNull() & finite(vec_col))
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"),
                       F.size(vec_col).alias("dim"))


def matrix(table: pa.Table | pa.RecordBatch, dim: int, column: str = "vec") -> np.ndarray:
    """The rows of a list column, all of size ``dim``, as one matrix of doubles."""
    col = table[column]
    values = pa.concat_arrays([x.flatten() for x in col.chunks]) if isinstance(col, pa.ChunkedArray) else col.flatten()
    return values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(table), dim)


def pack(rows: DataFrame) -> DataFrame:
    """One row for each (dim, block): ids (64-bit) and vectors (doubles) back to back.

    The caller numbers blocks so that each holds a bounded number of rows.  Rows that repeat an
    id and a vector count once."""
    def run(key, table):
        dim, block = key[0].as_py(), key[1].as_py()
        ids = table["id"].to_numpy()
        vecs = matrix(table, dim)
        order = np.lexsort([*vecs.T[:1], ids])
        ids, vecs = ids[order], vecs[order]
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (vecs[1:] != vecs[:-1]).any(axis=1)
        ids, vecs = ids[new], vecs[new]
        return pa.table({"dim": pa.array([dim], pa.int32()), "block": pa.array([block], pa.int32()),
                         "n": pa.array([len(ids)], pa.int32()), "ids": pa.array([ids.tobytes()], pa.binary()),
                         "cells": pa.array([vecs.tobytes()], pa.binary())})

    return rows.select("dim", "block", "id", "vec").groupBy("dim", "block").applyInArrow(run, PACKED)


def unpack(ids: bytes, cells: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(cells, np.float64).reshape(len(ids), dim)


def hashed_blocks(rows: DataFrame, size: int) -> DataFrame:
    """Number blocks of about ``size`` rows by a hash of the id (one count over the rows)."""
    blocks = max(1, -(-rows.count() // size))
    return rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))


def best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` highest scores of each query, ties to the smaller vec_id, ranked from 1."""
    from pyspark.sql import Window

    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
