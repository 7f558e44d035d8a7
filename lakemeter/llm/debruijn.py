"""Substring deduplication by De Bruijn compaction (operator 4).

A word goes when a window of ``WINDOW`` words that covers it also starts in a document of smaller id.

1. Edges.  Every window is an edge of the De Bruijn graph of token k-mers.  Windows that share
   their content anchor (``anchors``) follow each other without a branch wherever they occur, so
   a whole segment is written as one edge (its anchor gram and a hash of its words).
2. Repeats.  Edges of two documents or more are kept with their first document and all their
   source coordinates.
3. Compaction.  An edge joins its successor when the two follow each other wherever both occur,
   without another successor or predecessor, and share their first document; chains of such
   pairs collapse into paths by pointer doubling, one join a round.
4. Spans.  Each document's run on a path is one span between source coordinates, verified against
   the first document's coordinates of the same part of the path; later documents lose it.
5. Where an anchor gram has several edges, parts of them may still agree: the windows of their
   first occurrences are compared one by one, each task sending the first of a kind only.

Cases: null or empty text has no words; a null id is one document after all others; rows that
repeat an id are one document, whose rows all lose the spans of the id; repeats inside one
document stay; documents shorter than a window stay.  Kept words are joined by one space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemeter.llm import anchors as A
from lakemeter.llm import texts as T
from lakemeter.session import Scratch, settle

WINDOW = 50
GRAM = 16
BUCKET_BYTES = 4 << 20
#: windows that a task holds before it sends the firsts on, and about as many as a shard gets
HELD = 500_000

_KIND = np.dtype([("a", np.uint64), ("b", np.uint64), ("id", np.int64), ("start", np.int64)])


_EDGE = "gram long, text long, id long, seq int, start int, windows int"


def _edge_columns(r: np.ndarray) -> list[pa.Array]:
    column = lambda c, kind: pa.array(np.ascontiguousarray(r[c]).view(np.int64) if kind is None else r[c].astype(kind))
    return [column("gram", None), column("text", None), column("id", None), column("seq", np.int32), column("start", np.int32), column("windows", np.int32)]


def edges(docs: DataFrame, shards: int) -> DataFrame:
    """Rows with a shard: packed edges, of each kind those of its first document in the task; others:
    the edges of later documents, one a row."""
    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        r, head = A.by_class(np.concatenate(held))
        at = np.flatnonzero(head)
        kind = np.cumsum(head) - 1
        first = r["id"] == r["id"][at][kind]
        r["more"] = np.logical_or.reduceat(~first, at)[kind]
        kept = list(A.split(r[first], (T.mix(r["gram"][first]) % np.uint64(shards)).astype(np.int64)))
        none = [pa.nulls(len(kept), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())]
        names = ["shard", "records", "gram", "text", "id", "seq", "start", "windows"]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in kept], pa.int64()), pa.array([A.pack(x) for _, x in kept], pa.binary()), *none], names=names)
        later = r[~first]
        yield pa.RecordBatch.from_arrays([pa.nulls(len(later), pa.int64()), pa.nulls(len(later), pa.binary()), *_edge_columns(later)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for block in T.blocks(batches):
            w = T.words(block.data, block.offsets)
            held.append(A.records(block.ids, w.bounds, A.segments(w.hash, w.bounds, WINDOW, GRAM)))
            n += len(held[-1])
            if n >= A.HELD:
                yield from flush(held)
                held, n = [], 0
        yield from flush(held)

    return docs.mapInArrow(run, "shard long, records binary, " + _EDGE)


#: rows of ``repeated_edges``: a repeated kind of edge, an occurrence of one, a part of a crowded gram
KIND, OCCURRENCE, CROWD = 0, 1, 2


def repeated_edges(packed: DataFrame) -> DataFrame:
    """Of each shard: KIND rows (each repeated edge with its first document), OCCURRENCE rows (where it
    stands), CROWD rows (first occurrences of grams that have several edges in several documents)."""
    def run(key, table):
        r, head = A.by_class(np.concatenate([A.unpack(x.as_py()) for x in table["records"]]))
        at = np.flatnonzero(head)
        kind = np.cumsum(head) - 1
        first_id, first_start = r["id"][at], r["start"][at].astype(np.int64)
        repeated = (np.maximum.reduceat(r["id"], at) > first_id) | (np.maximum.reduceat(r["more"], at) > 0)
        occurs = repeated[kind]
        gram = r["gram"][at]
        new = np.ones(len(gram), bool)
        new[1:] = gram[1:] != gram[:-1]
        start = np.flatnonzero(new)
        many = (np.diff(np.append(start, len(gram))) > 1) & (np.maximum.reduceat(first_id, start) > np.minimum.reduceat(first_id, start))
        crowd = many[np.cumsum(new) - 1][kind] & (r["id"] == first_id[kind])
        parts = []
        for code, rows, own in ((KIND, r[at][repeated], kind[at][repeated]), (OCCURRENCE, r[occurs], kind[occurs]), (CROWD, r[crowd], kind[crowd])):
            parts.append(pa.table([pa.array(np.full(len(rows), code, np.int32)), *_edge_columns(rows), pa.array(first_id[own]), pa.array(first_start[own])],
                                  names=["what", "gram", "text", "id", "seq", "start", "windows", "first_id", "first_start"]))
        return pa.concat_tables(parts)

    return packed.groupBy("shard").applyInArrow(run, f"what int, {_EDGE}, first_id long, first_start long")


def paths(repeats: DataFrame, scratch: Scratch) -> DataFrame:
    """(gram, text, head, rank): the compacted path of each repeated edge and its place on it."""
    u = F.struct("gram", "text")
    follow = Window.partitionBy("id").orderBy("seq")
    pair = repeats.select(u.alias("u"), "first_id", "first_start", "seq",
                          F.lead(F.struct(u.alias("v"), "first_id", "first_start", "seq")).over(follow).alias("next"))
    # an occurrence without a repeated successor right behind it is an end, not a branch
    pair = pair.filter((F.col("next.seq") == F.col("seq") + 1)).select(
        "u", F.col("next.v").alias("v"),
        ((F.col("next.first_id") == F.col("first_id")) & (F.col("next.first_start") > F.col("first_start"))).alias("same")).distinct()
    pair = scratch.save(pair)
    out = pair.groupBy("u").agg(F.count(F.lit(1)).alias("out")).filter("out = 1").select("u")
    into = pair.groupBy("v").agg(F.count(F.lit(1)).alias("into")).filter("into = 1").select("v")
    step = pair.filter("same").join(out, "u", "left_semi").join(into, "v", "left_semi").select(F.col("v").alias("node"), F.col("u").alias("ptr"))
    nodes = repeats.select(u.alias("node")).distinct()
    # starts rise along a path, so there is no cycle and doubling ends
    chain = scratch.save(nodes.join(step, "node", "left").select(
        "node", F.coalesce("ptr", "node").alias("ptr"), F.when(F.col("ptr").isNull(), 0).otherwise(1).alias("rank")))
    heads = chain.filter("rank = 0").select(F.col("node").alias("ptr"), F.lit(True).alias("at_head"))
    moved = scratch.save(chain.filter("rank > 0").join(heads, "ptr", "left").select("node", "ptr", "rank", F.coalesce("at_head", F.lit(False)).alias("at_head")))
    # nodes that have reached the head are set aside; the others point 2, 4, 8 ... back, no two to one node
    done = chain.filter("rank = 0").select("node", "ptr", "rank", F.lit(True).alias("at_head")).unionByName(moved.filter("at_head"))
    active = moved.filter("not at_head")
    while not active.isEmpty():
        far = done.filter("rank > 0").unionByName(active).select(
            F.col("node").alias("ptr"), F.col("ptr").alias("far"), F.col("rank").alias("more"), F.col("at_head").alias("far_head"))
        moved = scratch.save(active.join(far, "ptr").select("node", F.col("far").alias("ptr"), (F.col("rank") + F.col("more")).alias("rank"),
                                                            F.col("far_head").alias("at_head")))
        done, active = done.unionByName(moved.filter("at_head")), moved.filter("not at_head")
    return done.select(F.col("node.gram").alias("gram"), F.col("node.text").alias("text"), F.col("ptr").alias("head"), "rank")


def path_spans(repeats: DataFrame, compact: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, start, end): what later documents lose to the first document of their paths.

    A document's run on a path is one span if it is whole and as long as the same ranks are in the
    first document; the edges of other runs are spans of their own."""
    end = F.col("start") + F.col("windows") + F.lit(WINDOW - 1)
    placed = scratch.save(repeats.join(compact, ["gram", "text"]).select(
        "id", "first_id", "first_start", "windows", "head", "rank", "start", end.alias("end"), (F.col("seq") - F.col("rank")).alias("line")))
    run = placed.filter("id > first_id").groupBy("id", "head", "line").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("rank").alias("low"), F.max("rank").alias("high"),
        F.size(F.collect_set("rank")).alias("ranks"),
        # where the first document has the ends of the run: every occurrence carries its edge's first start
        F.min_by("first_start", "rank").alias("at"), F.max_by(F.col("first_start") + F.col("windows") + F.lit(WINDOW - 1), "rank").alias("to"))
    verified = (F.col("ranks") == F.col("high") - F.col("low") + 1) & (F.col("to") - F.col("at") == F.col("end") - F.col("start"))
    run = scratch.save(run.select("id", "head", "line", "start", "end", verified.alias("verified")))
    single = placed.join(run.filter("not verified").select("id", "head", "line"), ["id", "head", "line"], "left_semi")
    return run.filter("verified").select("id", "start", "end").unionByName(single.filter("id > first_id").select("id", "start", "end"))


def _firsts(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by kind and document; which belong to the first document of their kind."""
    rows = rows[np.lexsort((rows["start"], rows["id"], rows["b"], rows["a"]))]
    head = np.ones(len(rows), bool)
    head[1:] = (rows["a"][1:] != rows["a"][:-1]) | (rows["b"][1:] != rows["b"][:-1])
    first = np.maximum.accumulate(np.where(head, np.arange(len(rows)), 0))
    return rows, rows["id"] == rows["id"][first]


def _window_spans(rows: np.ndarray, buckets: int) -> pa.RecordBatch:
    out = np.zeros(len(rows), A.SPAN)
    out["id"], out["start"] = rows["id"], rows["start"]
    out["end"] = rows["start"] + WINDOW
    return A.span_batch(A.merged(out), buckets)


def window_rows(pieces: DataFrame, shards: int, buckets: int) -> DataFrame:
    """Rows with a shard: windows, the first document's of each kind in the task; with a bucket: spans of the others."""
    schema = "shard long, rows binary, " + A.SPANS

    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        rows, first = _firsts(np.concatenate(held))
        spans = _window_spans(rows[~first], buckets)
        rows = rows[first]
        kept = list(A.split(rows, (rows["a"] % np.uint64(shards)).astype(np.int64)))
        k, m = len(kept), spans.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in kept] + [None] * m, pa.int64()), pa.array([T.packed(x) for _, x in kept] + [None] * m, pa.binary()),
             pa.array([None] * k + spans["bucket"].to_pylist(), pa.int64()), pa.array([None] * k + spans["spans"].to_pylist(), pa.binary())],
            names=["shard", "rows", "bucket", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            starts, counts = batch["starts"].to_pylist(), batch["windows"].to_pylist()
            data, offsets = T.string_buffers(batch["text"])
            ids = batch["id"].to_numpy()
            for at in range(0, len(ids)):
                w = T.words(data[offsets[at]:offsets[at + 1]], np.array([0, offsets[at + 1] - offsets[at]]))
                if len(w.hash) < WINDOW:
                    continue
                a = T.gram_hashes(w.hash, WINDOW)
                b = T.gram_hashes(T.mix(w.hash ^ np.uint64(0x5851F42D4C957F2D)), WINDOW)
                begin, size = np.array(starts[at], np.int64), np.array(counts[at], np.int64)
                spot = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
                spot = np.unique(spot[spot < len(a)])
                rows = np.zeros(len(spot), _KIND)
                rows["a"], rows["b"], rows["id"], rows["start"] = a[spot], b[spot], ids[at], spot
                held.append(rows)
                n += len(rows)
                if n >= HELD:
                    yield from flush(held)
                    held, n = [], 0
        yield from flush(held)

    return pieces.mapInArrow(run, schema)


def shard_spans(packed: DataFrame, buckets: int) -> DataFrame:
    """Spans of windows whose kind another shard row has in a smaller document."""
    def run(key, table):
        rows, first = _firsts(np.concatenate([np.frombuffer(x.as_py(), _KIND) for x in table["rows"]]))
        return pa.Table.from_batches([_window_spans(rows[~first], buckets)])

    return packed.groupBy("shard").applyInArrow(run, A.SPANS)


def _packed(spans: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.zeros(batch.num_rows, A.SPAN)
            for name in ("id", "start", "end"):
                rows[name] = batch[name].to_numpy()
            yield A.span_batch(A.merged(rows), buckets)

    return spans.select("id", "start", "end").mapInArrow(run, A.SPANS)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept`` (the words that stay, joined by one space)."""
    key = T.free_name(docs, "_path_key")
    docs = docs.withColumn(key, T.row_key(id_col, text_col))
    plain = docs.select(F.col(key).alias("doc_id"), F.col(text_col).alias("text"))
    total = A.sizes(docs, text_col)
    buckets = max(8, total // BUCKET_BYTES + 1)
    with Scratch(docs.sparkSession) as scratch:
        every = scratch.save(edges(plain, max(8, total // 100 // A.SHARD + 1)))
        kinds = scratch.save(repeated_edges(every.filter(F.col("shard").isNotNull()).select("shard", "records")))
        columns = ["gram", "text", "id", "seq", "start", "windows", "first_id", "first_start"]
        later = every.filter(F.col("shard").isNull()).select(*columns[:6]) \
            .join(kinds.filter(F.col("what") == KIND).select("gram", "text", "first_id", "first_start"), ["gram", "text"])
        repeats = scratch.save(kinds.filter(F.col("what") == OCCURRENCE).select(*columns).unionByName(later.select(*columns)))
        spans = _packed(path_spans(repeats, paths(repeats, scratch), scratch), buckets)

        # grams with several edges: their first documents' windows one by one
        firsts = kinds.filter(F.col("what") == CROWD).groupBy("id").agg(
            F.collect_list("start").alias("starts"), F.collect_list("windows").alias("windows"))  # of one document
        texts = plain.select(T.id_key("doc_id").alias("id"), "text")
        # the list of firsts grows with the corpus: one plan at every size, no broadcast
        pieces = texts.join(firsts.hint("merge"), "id").select("id", "text", "starts", "windows")
        rows = scratch.save(window_rows(pieces, max(8, total // 36 // HELD + 1), buckets))
        spans = spans.unionByName(rows.filter(F.col("bucket").isNotNull()).select("bucket", "spans"))
        spans = settle(spans.unionByName(shard_spans(rows.filter(F.col("shard").isNotNull()).select("shard", "rows"), buckets)))

    def cut(table: pa.Table, own: np.ndarray) -> pa.Table:
        data, offsets = T.string_buffers(table[text_col])
        start, end = T.word_ranges(data, offsets)
        bounds = np.searchsorted(start, offsets)
        gone = A.cover(T.id_values(table[key]), bounds, own)
        removed, _ = A.span_counts(gone, bounds)
        # kept words with one space after each, and the last space of each document taken off
        stay = ~gone
        size = np.where(stay, end - start + 1, 0)
        upto = np.concatenate([[0], np.cumsum(size)])
        out = np.full(int(upto[-1]), 0x20, np.uint8)
        inside = np.zeros(len(data) + 1, np.int8)
        inside[start[stay]] += 1
        inside[end[stay]] -= 1
        letters = data[np.cumsum(inside[:-1]) > 0] if len(data) else data
        place = np.ones(len(out), bool)
        place[upto[1:][stay] - 1] = False
        out[place] = letters
        doc_end = upto[bounds[1:]]
        doc_start = upto[bounds[:-1]]
        ends = np.where(doc_end > doc_start, doc_end - 1, doc_end)
        kept = [out[a:b].tobytes() for a, b in zip(doc_start.tolist(), ends.tolist())]
        return table.append_column("n_words", pa.array(np.diff(bounds))).append_column("n_removed", pa.array(removed)) \
            .append_column("kept", pa.array(kept, pa.binary()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return A.apply_spans(docs, spans, buckets, cut, f"{fields}, n_words long, n_removed long, kept binary", key).drop(key)


def report(cut: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return cut.select(id_col, "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
