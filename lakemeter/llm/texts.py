"""Text blocks inside tasks: Arrow string columns as numpy buffers, words, rolling hashes, anchors.

Everything here works on one bounded block of whole documents at a time (``blocks``), so the
memory of a task follows the block size (and the longest single text), not its input.
A null text is an empty text.  All hashes are fixed (no per-process seed): equal content gives
equal hashes on every executor and after a retry.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: the six bytes that separate words: space, tab, line feed, vertical tab, form feed, return
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: stands for a null document id in shuffles: after every other document
NULL_ID = 2 ** 63 - 1
#: keys of rows without an id begin here; ids lie below
NO_ID = 1 << 62
#: longest range hashed by the polynomial
SHORT = 256
BLOCK_BYTES = 1 << 19

try:
    _LIBC = ctypes.CDLL("libc.so.6") if hasattr(ctypes.CDLL("libc.so.6"), "malloc_trim") else None
except OSError:  # another C library
    _LIBC = None

_ODD = 0x9E3779B97F4A7C15
_INV = pow(_ODD, -1, 1 << 64)
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2 ** 63, 256, dtype=np.uint64)
_POW: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


@dataclass
class Block:
    """Whole documents back to back: ``data`` bytes, document ``i`` is ``offsets[i]:offsets[i+1]``."""
    ids: np.ndarray
    data: np.ndarray
    offsets: np.ndarray
    first_row: int
    batch: pa.RecordBatch

    def __len__(self) -> int:
        return len(self.ids)


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def id_values(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False)


def blocks(batches: Iterator[pa.RecordBatch], id_col: str = "doc_id", text_col: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut Arrow batches into blocks of whole documents of about ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = string_buffers(batch.column(batch.schema.get_field_index(text_col)))
        ids = id_values(batch.column(batch.schema.get_field_index(id_col)))
        row = 0
        while row < len(ids):
            end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
            yield Block(ids[row:end], data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row], row, batch)
            row = end
        release()


def release() -> None:
    """Give freed memory back to the system: a worker outlives its task, and Spark keeps it for the next."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


#: a group of fewer bytes leaves too little behind to be worth the call
TIDY_BYTES = 1 << 20


def tidy_batches(run):
    """``run`` (batches -> batches), giving memory back when the task ends and its last block is gone too."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()
    return of


def tidy_group(run):
    """``run`` (key, table -> table), giving memory back after each large group."""
    def of(key, table):
        out = run(key, table)
        if table.nbytes >= TIDY_BYTES:
            release()
        return out
    return of


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) < n:
        size = 1 << int(n).bit_length()
        pair = []
        for base in (_ODD, _INV):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            pair.append(np.multiply.accumulate(steps))
        if size > 4 * BLOCK_BYTES:  # one very long text: not kept
            return pair[0][:n], pair[1][:n]
        _POW[:] = pair
    return _POW[0][:n], _POW[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


#: all ASCII bytes but letters and digits
NOT_ALNUM = np.array([x < 128 and not chr(x).isalnum() for x in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass
class Words:
    """Words of a block in order: byte ranges, document index, content hash; ``bounds[d]:bounds[d+1]`` are document d's."""
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray


def word_ranges(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the runs of bytes other than ``between``, inside documents."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~between[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    starts[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Content hash of each byte range: short ranges from one prefix polynomial over the block, long ones
    by a digest (modulo a power of two, long texts of two alternating values share a polynomial)."""
    up, down = _powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], out=prefix[1:])
    h = (prefix[end] - prefix[start]) * down[start]
    h = mix(h + (end - start).astype(np.uint64))
    for i in np.flatnonzero(end - start > SHORT):
        h[i] = int.from_bytes(hashlib.blake2b(data[start[i]:end[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def words(block_data: np.ndarray, offsets: np.ndarray, lower: bool = False, between: np.ndarray = SPACE) -> Words:
    data = LOWER[block_data] if lower else block_data
    start, end = word_ranges(data, offsets, between)
    doc = np.searchsorted(offsets, start, "right") - 1
    bounds = np.searchsorted(start, offsets)
    return Words(start, end, doc, range_hashes(data, start, end), bounds)


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` values (length ``len(h)-n+1``), by binary powers."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out, length, power, width = None, 0, h, 1
    base = np.uint64(0xD6E8FEB86659FD93)
    scale = base
    rest = n
    while rest:
        if rest & 1:
            if out is None:
                out, length = power, width
            else:
                size = len(h) - length - width + 1
                out = out[:size] * scale + power[length:length + size]
                length += width
        rest >>= 1
        if rest:
            size = len(power) - width
            power = power[:size] * scale + power[width:width + size]
            scale = np.uint64(int(scale) ** 2 % (1 << 64))
            width *= 2
    return mix(out)


def sliding_argmin(x: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost minimum of each window of ``width`` values."""
    n = len(x) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    pos = np.arange(len(x), dtype=np.int64)
    val, span = x, 1
    while span * 2 <= width:
        left, right = val[:-span], val[span:]
        take = right < left
        pos = np.where(take, pos[span:], pos[:-span])
        val = np.where(take, right, left)
        span *= 2
    shift = width - span
    if shift:
        take = val[shift:shift + n] < val[:n]
        return np.where(take, pos[shift:shift + n], pos[:n])
    return pos[:n]


def shingle_sets(w: Words, n_docs: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``n``-word shingles of each document: (document index, hash), sorted by document.

    A document with fewer than ``n`` words has its whole sequence as one; without words, none.
    """
    count = np.diff(w.bounds)
    grams = gram_hashes(w.hash, n)
    keep = np.zeros(0, bool) if not len(grams) else w.doc[:len(grams)] == w.doc[n - 1:]
    doc = [w.doc[:len(grams)][keep]]
    value = [grams[keep]]
    for size in range(1, n):
        short = np.flatnonzero(count == size)
        if len(short):
            at = w.bounds[short]
            h = np.full(len(short), size, np.uint64)
            for i in range(size):
                h = mix(h * np.uint64(0xD6E8FEB86659FD93) + w.hash[at + i])
            doc.append(short)
            value.append(h)
    doc, value = np.concatenate(doc), np.concatenate(value)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[first], value[first]


# -- frames ------------------------------------------------------------------------------
def id_key(col: str | Column = "doc_id") -> Column:
    """The document id as a join and order key; null comes after every other id."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("long"), F.lit(NULL_ID))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The document id; rows without one are documents by their text, after all ids."""
    by_text = F.lit(NO_ID) + F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))), 3)
    return F.coalesce(F.col(f"`{id_col}`").cast("long"), by_text)


def key_id(col: str | Column) -> Column:
    """The id that a ``row_key`` stands for (null for rows without one)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c < NO_ID, c)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that ``df`` does not have."""
    while name in df.columns:
        name += "_"
    return name


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc_mod(col: str, n: int) -> Column:
    """crc32 of the id written as text, modulo n (null id: the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


# -- sums of fixed-size tables over all tasks ---------------------------------------------
SUM_SLICES = 16


def table_rows(values: np.ndarray) -> pa.RecordBatch:
    """A task's table (any numbers), in slices, for ``table_sum``; the task number spreads the sums."""
    from pyspark import TaskContext

    parts = np.array_split(values.astype(np.float64).ravel(), SUM_SLICES)
    context = TaskContext.get()
    return pa.RecordBatch.from_arrays(
        [pa.array(range(SUM_SLICES), pa.int32()), pa.array([(context.partitionId() if context else 0) % 1024] * SUM_SLICES, pa.int32()),
         pa.array([packed(x) for x in parts], pa.binary())], names=["slice", "part", "counts"])


def table_sum(rows: DataFrame, size: int) -> np.ndarray:
    """The sum of all tasks' tables of ``size`` numbers, added in two steps and then collected."""
    def add(key, table):
        total = sum(np.frombuffer(x.as_py(), np.float64) for x in table["counts"])
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([packed(total)], pa.binary())})

    for keys in (["slice", "part"], ["slice"]):
        rows = rows.groupBy(*keys).applyInArrow(add, "slice int, counts binary")
    parts = np.array_split(np.zeros(size), SUM_SLICES)
    for r in rows.collect():  # SUM_SLICES rows of fixed size
        parts[r["slice"]] = np.frombuffer(r["counts"], np.float64)
    return np.concatenate(parts)
