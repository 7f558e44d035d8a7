"""Content anchors: equal windows of two documents meet in one shard, wherever they stand.

The anchor of a window is the position of its leftmost least ``gram`` hash, so it depends on the
window's content only.  Consecutive windows mostly share their anchor; such a run of windows and
the text it covers is a *segment*, owned by the hash of its anchor gram.  Equal windows lie in
segments with equal grams: a shard of gram hashes sees every occurrence of its windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemeter.llm import texts as T

#: one segment: gram hash, hash of the covered text, document id, first window, number of windows,
#: number of the segment in its document, whether its task met it in a later document too
RECORD = np.dtype([("gram", np.uint64), ("text", np.uint64), ("id", np.int64), ("start", np.uint32), ("windows", np.uint32), ("seq", np.uint32),
                   ("more", np.uint8)])
#: records that a task holds before it sends them on, and that a shard gets about
HELD = 500_000
SHARD = 300_000
SPAN = np.dtype([("id", np.int64), ("start", np.int64), ("end", np.int64)])


def range_sums(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Content hash of ranges of 64-bit values."""
    up, down = T._powers(len(values) + 1)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=prefix[1:])
    return T.mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


@dataclass
class Segments:
    """Segments of a block in order, positions in units of the whole block."""
    first: np.ndarray
    last: np.ndarray
    gram: np.ndarray
    text: np.ndarray


def segments(values: np.ndarray, bounds: np.ndarray, window: int, gram: int) -> Segments:
    """Segments of the units ``values`` (hashes of bytes or words); document d is ``bounds[d]:bounds[d+1]``."""
    none = np.zeros(0, np.int64)
    n = len(values) - window + 1
    if n <= 0:
        return Segments(none, none, none.astype(np.uint64), none.astype(np.uint64))
    room = np.zeros(len(values) + 1, np.int32)  # windows that start inside one document
    size = np.diff(bounds)
    fits = size >= window
    np.add.at(room, bounds[:-1][fits], 1)
    np.add.at(room, bounds[:-1][fits] + size[fits] - window + 1, -1)
    at = np.flatnonzero(np.cumsum(room[:n]) > 0)
    if not len(at):
        return Segments(none, none, none.astype(np.uint64), none.astype(np.uint64))
    g = T.gram_hashes(values, gram)
    anchor = T.sliding_argmin(g, window - gram + 1)[at]
    head = np.ones(len(at), bool)
    head[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    first = at[head]
    last = at[np.append(np.flatnonzero(head)[1:] - 1, len(at) - 1)]
    return Segments(first, last, g[anchor[head]], range_sums(values, first, last + window))


def records(block_ids: np.ndarray, bounds: np.ndarray, s: Segments) -> np.ndarray:
    doc = np.searchsorted(bounds, s.first, "right") - 1
    out = np.zeros(len(doc), RECORD)
    out["gram"], out["text"], out["id"] = s.gram, s.text, block_ids[doc]
    out["start"] = s.first - bounds[doc]
    out["windows"] = s.last - s.first + 1
    out["seq"] = np.arange(len(doc)) - np.searchsorted(doc, doc)
    return out


def by_class(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Records sorted by gram, text, id, start, and whether each begins a class (equal gram and text)."""
    r = r[np.lexsort((r["start"], r["id"], r["text"], r["gram"]))]
    head = np.ones(len(r), bool)
    head[1:] = (r["gram"][1:] != r["gram"][:-1]) | (r["text"][1:] != r["text"][:-1])
    return r, head


_COLUMNS = ("gram", "text", "id", "start", "windows", "seq", "more")


def pack(r: np.ndarray) -> bytes:
    """Column by column, in document order, which compresses well."""
    r = r[np.lexsort((r["start"], r["id"]))]
    return b"".join(T.packed(r[c]) for c in _COLUMNS)


def unpack(data: bytes) -> np.ndarray:
    n = len(data) // RECORD.itemsize
    out, at = np.zeros(n, RECORD), 0
    for c in _COLUMNS:
        kind = RECORD[c]
        out[c] = np.frombuffer(data, kind, n, at)
        at += n * kind.itemsize
    return out


def split(rows: np.ndarray, key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Rows by key."""
    order = np.argsort(key, kind="stable")
    rows, key = rows[order], key[order]
    edges = np.flatnonzero(np.diff(key)) + 1
    for a, b in zip([0, *edges], [*edges, len(rows)]):
        if b > a:
            yield int(key[a]), rows[a:b]


def merged(spans: np.ndarray) -> np.ndarray:
    """Overlapping or adjoining spans of a document as one."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans["start"], spans["id"]))]
    new_doc = np.ones(len(spans), bool)
    new_doc[1:] = spans["id"][1:] != spans["id"][:-1]
    group = np.cumsum(new_doc) - 1
    # running greatest end inside each document: lift each document above the last
    lift = group * (int(spans["end"].max()) + 1)
    reach = np.maximum.accumulate(spans["end"] + lift) - lift
    new = new_doc.copy()
    new[1:] |= spans["start"][1:] > reach[:-1]
    at = np.flatnonzero(new)
    out = spans[at].copy()
    out["end"] = np.maximum.reduceat(spans["end"], at)
    return out


SPANS = "bucket long, spans binary"


def span_batch(spans: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Spans packed by the bucket of their document."""
    bucket = (T.mix(spans["id"].view(np.int64).astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    parts = list(split(spans, bucket))
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in parts], pa.int64()), pa.array([T.packed(x) for _, x in parts], pa.binary())],
        names=["bucket", "spans"])


def sizes(docs: DataFrame, text_col: str) -> int:
    """Bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


def apply_spans(docs: DataFrame, spans: DataFrame, buckets: int, cut, schema: str, id_col: str) -> DataFrame:
    """``cut(table, spans)`` for each bucket of documents and the spans of its documents.

    Buckets are hashes of the id, of about equal bytes; ``docs`` keeps its columns."""
    key = "_bucket"
    while key in docs.columns:
        key += "_"

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = T.id_values(batch.column(batch.schema.get_field_index(id_col)))
            bucket = (T.mix(ids.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bucket)], names=[*batch.schema.names, key])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    keyed = docs.mapInArrow(number, f"{fields}, `{key}` long")

    def run(left, right):
        parts = [np.frombuffer(x.as_py(), SPAN) for x in right["spans"]]
        out = cut(left.drop_columns([key]), np.concatenate(parts) if parts else np.zeros(0, SPAN))
        T.release()
        return out

    return keyed.groupBy(key).cogroup(spans.withColumnRenamed("bucket", key).groupBy(key)).applyInArrow(run, schema)


def cover(ids: np.ndarray, bounds: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Which units of the documents ``bounds[i]:bounds[i+1]`` of ``ids`` lie in a span; rows that repeat an id share its spans."""
    mask = np.zeros(int(bounds[-1]) + 1, np.int32)
    if len(spans):
        spans = merged(spans)
        order = np.argsort(ids, kind="stable")
        low = np.searchsorted(ids[order], spans["id"], "left")
        high = np.searchsorted(ids[order], spans["id"], "right")
        reps = high - low
        spot = np.repeat(low, reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        row, s = order[spot], np.repeat(spans, reps)
        size = bounds[row + 1] - bounds[row]
        np.add.at(mask, bounds[row] + np.minimum(s["start"], size), 1)
        np.add.at(mask, bounds[row] + np.minimum(s["end"], size), -1)
    return np.cumsum(mask[:-1]) > 0


def span_counts(mask: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Covered units and maximal runs of each document."""
    start = mask.copy()
    start[1:] &= ~mask[:-1]
    edge = bounds[1:-1]
    edge = edge[edge < len(mask)]
    start[edge] = mask[edge]
    total = lambda x: np.concatenate([[0], np.cumsum(x)])
    a, b = total(mask), total(start)
    return a[bounds[1:]] - a[bounds[:-1]], b[bounds[1:]] - b[bounds[:-1]]
