"""Suffix-array deduplication of byte strings (operator 3).

A byte goes when a string of ``WINDOW`` bytes that covers it also starts earlier: in a document of
smaller id, or earlier in its own.

1. Content anchors route every window to the shard of its anchor gram (``anchors``).  Segments of
   equal text are classes: all occurrences but the first go whole.  A task sends each class once.
2. Where a gram has several classes, their first occurrences may share windows.  Their texts form
   shards of bounded size; each shard builds its suffix array by Larsson-Sadakane refinement (sorted
   groups keep their rank, the others are sorted by the rank ``h`` further on, ``h`` doubling until
   all are settled), and common prefixes of neighbours by Kasai's walk in text order, run in all
   segments of the shard side by side.  Runs of neighbours with ``WINDOW`` common bytes are equal
   windows; all but the first occurrence go.
3. A gram with more classes than a shard holds is dealt over several shards; the first occurrence
   of each window that they find is merged across shards by content ranges: binary search among
   sorted window strings gives each its range, where equal strings of several shards meet.

Documents then lose the union of the spans found.  Lists per document stay inside one row.

Cases: null or empty text: nothing to remove; a null id is one document after all others; rows that
repeat an id are one document, so equal positions are the same occurrence and each row loses the
union of the spans of its id; texts shorter than ``WINDOW`` stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemeter.llm import anchors as A
from lakemeter.llm import texts as T
from lakemeter.session import Scratch, settle

WINDOW = 100
GRAM = 32
#: bytes of text in a shard of suffixes, classes of one gram in a shard, bytes of a bucket of documents
SHARD_BYTES = 1 << 20
CLASSES = 4096
BUCKET_BYTES = 4 << 20


# -- suffix arrays -------------------------------------------------------------------------
def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted suffixes, and the place of each position among them.

    Larsson-Sadakane: positions whose order is settled keep their place; the others are sorted
    inside their group by the rank ``h`` places on, and ``h`` doubles until all are settled."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    padded = np.zeros(n + 8, np.uint64)
    padded[:n] = text
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i:n + i]
    sa = np.argsort(key)
    ordered = key[sa]
    head = np.ones(n, bool)
    head[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[sa] = np.flatnonzero(head)[np.cumsum(head) - 1]
    h = 8
    while True:
        alone = head & np.append(head[1:], True)
        open_ = np.flatnonzero(~alone)  # places in groups of two or more
        if not len(open_):
            break
        pos = sa[open_]
        following = rank[np.minimum(pos + h, n)] + 1
        order = np.argsort((rank[pos] << 32) | following)  # whole groups stay in their places
        pos, following = pos[order], following[order]
        sa[open_] = pos
        own = rank[pos]
        new = np.ones(len(pos), bool)
        new[1:] = (own[1:] != own[:-1]) | (following[1:] != following[:-1])
        head[open_] = new
        rank[pos] = open_[np.flatnonzero(new)[np.cumsum(new) - 1]]
        h *= 2
    place = np.empty(n, np.int64)
    place[sa] = np.arange(n)
    return sa, place


def kasai(text: np.ndarray, sa: np.ndarray, place: np.ndarray, lanes: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix, up to ``depth`` bytes, of each suffix with the one before it in order.

    Kasai's walk: the prefix at the next position is at most one byte shorter.  ``lanes`` are the
    starts of stretches of the text that are walked side by side."""
    n = len(text)
    lcp = np.zeros(n, np.int64)
    if not n:
        return lcp
    words = np.zeros(n + 8, np.uint64)
    words[:n] = text
    eight = np.zeros(n, np.uint64)
    for i in range(8):
        eight |= words[i:n + i] << np.uint64(8 * i)
    ends = np.append(lanes[1:], n)
    order = np.argsort(lanes - ends, kind="stable")  # longest first, so the lanes still walking are a prefix
    lanes, length = lanes[order], (ends - lanes)[order]
    common = np.zeros(len(lanes), np.int64)
    for step in range(int(length[0]) if len(length) else 0):
        live = int(np.searchsorted(-length, -step, "left"))
        p = lanes[:live] + step
        r = place[p]
        q = sa[np.maximum(r - 1, 0)]
        h = np.maximum(common[:live] - 1, 0)
        room = np.minimum(n - np.maximum(p, q), depth)
        h = np.minimum(h, room)
        at = np.flatnonzero((r > 0) & (h < room))
        while len(at):
            x = eight[p[at] + h[at]] ^ eight[q[at] + h[at]]
            low = x & (~x + np.uint64(1))
            same = np.where(x == 0, 8, (np.log2(np.maximum(low, 1).astype(np.float64)).astype(np.int64)) >> 3)
            h[at] = np.minimum(h[at] + same, room[at])
            at = at[(same == 8) & (h[at] < room[at])]
        h[r == 0] = 0
        common[:live] = h
        lcp[r] = h
    return lcp


def repeated_windows(text: np.ndarray, starts: np.ndarray, windows: np.ndarray, ids: np.ndarray, offset: np.ndarray):
    """Windows of a shard: (segment, window, whether it is the first of its kind here, kind).

    ``starts``: where each segment begins in ``text``; it has ``windows`` windows, the first at
    ``offset`` of document ``ids``."""
    sa, place = suffix_array(text)
    lcp = kasai(text, sa, place, starts, WINDOW)
    kind = np.cumsum(lcp < WINDOW)[place]  # by text position
    seg = np.repeat(np.arange(len(starts)), windows)
    step = np.arange(len(seg)) - np.repeat(np.cumsum(windows) - windows, windows)
    kind = kind[starts[seg] + step]
    order = np.lexsort((offset[seg] + step, ids[seg], kind))
    seg, step, kind = seg[order], step[order], kind[order]
    head = np.ones(len(kind), bool)
    head[1:] = kind[1:] != kind[:-1]
    # the same position of a document (a repeated row) is no earlier start
    where = offset[seg] + step
    first = np.maximum.accumulate(np.where(head, np.arange(len(kind)), 0))
    same = (ids[seg] == ids[seg][first]) & (where == where[first])
    return seg, step, head, same


# -- the corpus ----------------------------------------------------------------------------
def segment_rows(docs: DataFrame, shards: int, buckets: int) -> DataFrame:
    """Rows with a shard: packed segments; rows with a bucket: spans that repeat inside the task."""
    schema = "shard long, records binary, " + A.SPANS

    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        r, head = A.by_class(np.concatenate(held))
        first = np.maximum.accumulate(np.where(head, np.arange(len(r)), 0))
        again = ~head & ((r["id"] != r["id"][first]) | (r["start"] != r["start"][first]))
        spans = A.span_batch(A.merged(spans_of(r[again])), buckets)
        kept = list(A.split(r[head], (T.mix(r["gram"][head]) % np.uint64(shards)).astype(np.int64)))
        k, m = len(kept), spans.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in kept] + [None] * m, pa.int64()), pa.array([A.pack(x) for _, x in kept] + [None] * m, pa.binary()),
             pa.array([None] * k + spans["bucket"].to_pylist(), pa.int64()), pa.array([None] * k + spans["spans"].to_pylist(), pa.binary())],
            names=["shard", "records", "bucket", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for block in T.blocks(batches):
            found = A.segments(T._BYTE[block.data], block.offsets, WINDOW, GRAM)
            held.append(A.records(block.ids, block.offsets, found))
            n += len(held[-1])
            if n >= A.HELD:
                yield from flush(held)
                held, n = [], 0
        yield from flush(held)

    return docs.mapInArrow(T.tidy_batches(run), schema)


def spans_of(r: np.ndarray) -> np.ndarray:
    out = np.zeros(len(r), A.SPAN)
    out["id"], out["start"] = r["id"], r["start"]
    out["end"] = r["start"].astype(np.int64) + r["windows"] + WINDOW - 1
    return out


def class_rows(packed: DataFrame, buckets: int, parts: int) -> DataFrame:
    """Rows with a bucket: spans of repeated segments; others: first occurrences that may share windows
    with another class of their gram - (part, share) is the shard of suffixes they go to."""
    schema = "part long, share int, id long, start long, windows int, " + A.SPANS

    def run(key, table):
        r, head = A.by_class(np.concatenate([A.unpack(x.as_py()) for x in table["records"]]))
        first = np.maximum.accumulate(np.where(head, np.arange(len(r)), 0))
        again = ~head & ((r["id"] != r["id"][first]) | (r["start"] != r["start"][first]))
        spans = A.span_batch(A.merged(spans_of(r[again])), buckets)
        one = r[head]
        gram_head = np.ones(len(one), bool)
        gram_head[1:] = one["gram"][1:] != one["gram"][:-1]
        at = np.flatnonzero(gram_head)
        size = np.diff(np.append(at, len(one)))
        many = np.repeat(size, size)
        nth = np.arange(len(one)) - np.repeat(at, size)
        one, nth, many = one[many > 1], nth[many > 1], many[many > 1]
        # a gram with very many classes has shards of its own, numbered by the gram itself
        part = np.where(many > CLASSES, (one["gram"] >> np.uint64(1)).astype(np.int64) | (1 << 62), (T.mix(one["gram"]) % np.uint64(parts)).astype(np.int64))
        share = np.where(many > CLASSES, 1 + nth // CLASSES, 0)
        k, m = len(one), spans.num_rows
        T.release()
        none = lambda n, kind: pa.nulls(n, kind)
        return pa.table({
            "part": pa.chunked_array([pa.array(part), none(m, pa.int64())]), "share": pa.chunked_array([pa.array(share.astype(np.int32)), none(m, pa.int32())]),
            "id": pa.chunked_array([pa.array(np.ascontiguousarray(one["id"])), none(m, pa.int64())]),
            "start": pa.chunked_array([pa.array(one["start"].astype(np.int64)), none(m, pa.int64())]),
            "windows": pa.chunked_array([pa.array(one["windows"].astype(np.int32)), none(m, pa.int32())]),
            "bucket": pa.chunked_array([none(k, pa.int64()), spans["bucket"]]), "spans": pa.chunked_array([none(k, pa.binary()), spans["spans"]])})

    return packed.groupBy("shard").applyInArrow(run, schema)


def shard_rows(firsts: DataFrame, buckets: int) -> DataFrame:
    """Suffix arrays of the shards (part, share): spans by bucket, and for grams dealt over several
    shards the first occurrence of each window (``window``, id, start)."""
    schema = "window binary, id long, start long, " + A.SPANS

    def run(key, table):
        data, offsets = T.string_buffers(table["piece"])
        ids = table["id"].to_numpy()
        start, windows = table["start"].to_numpy(), table["windows"].to_numpy().astype(np.int64)
        seg, step, head, same = repeated_windows(data, offsets[:-1], windows, ids, start)
        found = np.zeros(int((~same).sum()), A.SPAN)
        found["id"] = ids[seg[~same]]
        found["start"] = (start[seg] + step)[~same]
        found["end"] = found["start"] + WINDOW
        spans = A.span_batch(A.merged(found), buckets)
        T.release()
        if key[1].as_py():
            at = (offsets[:-1][seg] + step)[head]
            own_id, own_start = ids[seg][head], (start[seg] + step)[head]
            strings = [data[a:a + WINDOW].tobytes() for a in at.tolist()]
        else:
            strings, own_id, own_start = [], np.zeros(0, np.int64), np.zeros(0, np.int64)
        k, m = len(strings), spans.num_rows
        return pa.table({
            "window": pa.chunked_array([pa.array(strings, pa.binary()), pa.nulls(m, pa.binary())]),
            "id": pa.chunked_array([pa.array(np.ascontiguousarray(own_id), pa.int64()), pa.nulls(m, pa.int64())]),
            "start": pa.chunked_array([pa.array(np.ascontiguousarray(own_start).astype(np.int64)), pa.nulls(m, pa.int64())]),
            "bucket": pa.chunked_array([pa.nulls(k, pa.int64()), spans["bucket"]]), "spans": pa.chunked_array([pa.nulls(k, pa.binary()), spans["spans"]])})

    return firsts.groupBy("part", "share").applyInArrow(run, schema)


def merge_shards(heads: DataFrame, buckets: int) -> DataFrame:
    """Spans of windows whose first occurrences in several shards are equal, all but the first of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            data = np.frombuffer(b"".join(batch["window"].to_pylist()), f"S{WINDOW}") if batch.num_rows else []
            if not len(data):
                continue
            raw = np.frombuffer(data.tobytes(), np.uint8).reshape(-1, WINDOW)
            again = np.zeros(len(raw), bool)
            again[1:] = (raw[1:] == raw[:-1]).all(axis=1)
            again[0] = last is not None and bool((raw[0] == last).all())
            last = raw[-1].copy()
            found = np.zeros(int(again.sum()), A.SPAN)
            found["id"] = batch["id"].to_numpy()[again]
            found["start"] = batch["start"].to_numpy()[again]
            found["end"] = found["start"] + WINDOW
            yield A.span_batch(A.merged(found), buckets)

    return (heads.repartitionByRange("window").sortWithinPartitions("window", "id", "start")
            .mapInArrow(run, A.SPANS))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: str = "", finish=None) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (the bytes that stay), names after ``prefix``.

    ``finish`` makes a table of the columns of ``docs`` out of such a table, in the same step."""
    key = T.free_name(docs, "_suffix_key")
    docs = docs.withColumn(key, T.row_key(id_col, text_col))
    plain = docs.select(F.col(key).alias("doc_id"), F.col(text_col).alias("text"))
    total = A.sizes(docs, text_col)
    buckets = max(8, total // BUCKET_BYTES + 1)
    with Scratch(docs.sparkSession) as scratch:
        rows = scratch.save(segment_rows(plain, max(8, total // 40 // A.SHARD + 1), buckets))
        packed = rows.filter(F.col("shard").isNotNull()).select("shard", "records")
        classes = scratch.save(class_rows(packed, buckets, max(8, total // 4 // SHARD_BYTES + 1)))
        firsts = classes.filter(F.col("part").isNotNull()).select("part", "share", "id", "start", "windows")
        texts = plain.select(T.id_key("doc_id").alias("id"), F.col("text").cast("binary").alias("text"))
        piece = F.substring(F.col("text"), (F.col("start") + 1).cast("int"), (F.col("windows") + WINDOW - 1).cast("int"))
        # the list of firsts grows with the corpus: one plan at every size, no broadcast
        firsts = texts.join(firsts.hint("merge"), "id").select("part", "share", "id", "start", "windows", piece.alias("piece")) \
            .filter(F.octet_length("piece") == F.col("windows") + WINDOW - 1)
        found = scratch.save(shard_rows(firsts, buckets))
        spans = merge_shards(found.filter(F.col("window").isNotNull()).select("window", "id", "start"), buckets)
        for part in (rows, classes, found):
            spans = spans.unionByName(part.filter(F.col("bucket").isNotNull()).select("bucket", "spans"))
        spans = settle(spans)

    def cut(table: pa.Table, own: np.ndarray) -> pa.Table:
        data, bounds = T.string_buffers(table[text_col])
        mask = A.cover(T.id_values(table[key]), bounds, own)
        removed, runs = A.span_counts(mask, bounds)
        size = np.diff(bounds)
        upto = np.concatenate([[0], np.cumsum(size - removed)])
        kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(upto.astype(np.int64)), pa.py_buffer(data[~mask].tobytes())])
        for name, values in (("n_bytes", pa.array(size)), ("n_removed", pa.array(removed)), ("n_spans", pa.array(runs)), ("kept", kept.cast(pa.binary()))):
            table = table.append_column(prefix + name, values)
        return finish(table) if finish else table

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    if not finish:
        schema += f", `{prefix}n_bytes` long, `{prefix}n_removed` long, `{prefix}n_spans` long, `{prefix}kept` binary"
    return A.apply_spans(docs, spans, buckets, cut, schema, key).drop(key)


def report(cut: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return cut.select(id_col, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def cut_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with the repeats taken out of the texts (a character cut in two goes whole)."""
    prefix = "_suffix_"

    def finish(table: pa.Table) -> pa.Table:
        texts, removed = table[text_col].to_pylist(), table[prefix + "n_removed"].to_pylist()
        kept = [t if not n else k.as_py().decode("utf-8", "ignore") for t, n, k in zip(texts, removed, table[prefix + "kept"])]
        new = {text_col: pa.array(kept, table.schema.field(text_col).type)}
        if chars_col in table.schema.names:
            old = table[chars_col].to_pylist()
            new[chars_col] = pa.array([o if not n else len(k) for o, n, k in zip(old, removed, kept)], table.schema.field(chars_col).type)
        names = [x for x in table.schema.names if x not in columns]
        return pa.table({x: new.get(x, table[x]) for x in names})

    columns = [prefix + x for x in ("n_bytes", "n_removed", "n_spans", "kept")]
    return remove_repeats(docs, id_col, text_col, prefix, finish)
