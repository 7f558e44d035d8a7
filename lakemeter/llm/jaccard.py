"""N-gram Jaccard join in the Jaccard metric (operator 9): regions, pivots, triangle windows, links.

A document's set holds its distinct ``SHINGLE``-word shingles; the Jaccard distance
``1 - |x & y| / |x | y|`` is a metric, and documents link at distance <= 1/5.

In shingle space nearly all distances are 1, so pivots drawn from the whole corpus divide nothing.
Regions are therefore opened around shared content first, without loss:

1. One class per distinct set (equal sets link at once); classes are compared, copies are not.
2. Every set lists its rarest shingles first (by a fixed-size table of counts; the order decides
   only the work).  Linked sets share several of their first ``front(n)`` shingles (see ``regions``).
   Sets that share a listed shingle form its group; the group's least set is its *pivot*, and the
   region of a pivot holds the sets of all groups it stands for - boundary sets lie in several.
   A set with too few shared shingles in its list can link with nothing and leaves.
3. In a region a central member becomes pivot: its exact distances to the others link those within
   reach; a pair is tried later only if its distances to every earlier pivot differ by at most the
   radius (triangle inequality) and it is not connected yet; the rest join recursively.  A region too
   large for one task is joined the same way over many: its pivot's ball over salted shares, then
   what the ball leaves, in blocks against all members that the triangle windows allow.
4. Components of the links by repeated hooking to the smallest neighbour.

Every pair at or above the threshold lies in one component; no set, group or link is capped.

Cases: null or empty text, or no words: an empty set, linked with nothing; fewer words than a
shingle: the whole sequence as one shingle; rows that repeat an id are one document, each with a
row of its own (and its own set size); rows without an id are documents by their text, after all others, and
a component without any id is null; a very long text is one set in one block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemeter.llm import texts as T
from lakemeter.session import Scratch, settle

SHINGLE = 5
#: link when OF * intersection >= NEAR * union
NEAR, OF = 80, 100
#: slots of the table of counts (fixed size: 8 MB), slices of it in a shuffle
SLOT_BITS = 21
SLOTS = 1 << SLOT_BITS
SLICES = 64
#: listed shingles in a shard; a shingle whose slot counts more than this is dealt over several
SHARD = 300_000
HOT = 200_000
#: members of a region joined in one task
REGION = 768
_RADIUS = 1 - NEAR / OF


def front(n: np.ndarray) -> np.ndarray:
    """How many of its rarest shingles a set of ``n`` lists: n - ceil(0.8 n) + 1 + n // 20."""
    return np.minimum(n, n + (-n * NEAR // OF) + 1 + n // 20)


def linked(inter, a, b):
    return OF * inter >= NEAR * (a + b - inter)


# -- sets --------------------------------------------------------------------------------
def _sets(block: T.Block):
    """(document, shingle) sorted by document, set sizes, and two hashes of each set."""
    w = T.words(block.data, block.offsets, lower=True)
    doc, value = T.shingle_sets(w, len(block), SHINGLE)
    n = np.bincount(doc, minlength=len(block))
    bounds = np.concatenate([[0], np.cumsum(n)])

    def total(x):
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])
        return T.mix(upto[bounds[1:]] - upto[bounds[:-1]] + n.astype(np.uint64))

    return doc, value, n, bounds, total(value), total(T.mix(value ^ np.uint64(0xA5A5A5A5DEADBEEF)))


def slots(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


_PROFILE = "kind int, id long, hash long, n long, set1 long, set2 long, slice int, counts binary"


def profile(docs: DataFrame) -> DataFrame:
    """Rows of kind 0: each document's set size and set hashes; of kind 1: counts of shingles by slot.  ``docs``:
    (doc_id, hash of the text, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.uint32)
        for block in T.blocks(batches):
            doc, value, n, _, one, two = _sets(block)
            np.add.at(counts, slots(value), np.uint32(1))
            k = len(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(k, np.int32)), pa.array(block.ids), block.batch["hash"].slice(block.first_row, k), pa.array(n),
                 pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())],
                names=["kind", "id", "hash", "n", "set1", "set2", "slice", "counts"])
        parts = [T.packed(x) for x in np.split(np.minimum(counts, 0xFFFF).astype(np.uint16), SLICES)]
        long, task = pa.nulls(SLICES, pa.int64()), pa.array([TaskContext.get().partitionId()] * SLICES, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(SLICES, np.int32)), long, long, task, long, long, pa.array(np.arange(SLICES, dtype=np.int32)), pa.array(parts, pa.binary())],
            names=["kind", "id", "hash", "n", "set1", "set2", "slice", "counts"])

    return docs.select("doc_id", "hash", "text").mapInArrow(T.tidy_batches(run), _PROFILE)


def slot_counts(profiled: DataFrame) -> np.ndarray:
    """The summed table of counts (SLOTS numbers, whatever the input)."""
    def adder(kind):
        def add(key, table):
            total = np.zeros(SLOTS // SLICES, np.int64)
            for x in table["counts"]:
                total += np.frombuffer(x.as_py(), kind)
            return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([T.packed(total)], pa.binary())})
        return add

    # summed in two steps, so no task meets the parts of all tasks
    parts = profiled.filter("kind = 1").select("slice", F.pmod("n", F.lit(1024)).alias("part"), "counts")
    parts = parts.groupBy("slice", "part").applyInArrow(T.tidy_group(adder(np.uint16)), "slice int, counts binary")
    rows = parts.groupBy("slice").applyInArrow(adder(np.int64), "slice int, counts binary").collect()  # SLICES rows
    out = np.zeros((SLICES, SLOTS // SLICES), np.int64)
    for r in rows:
        out[r["slice"]] = np.frombuffer(r["counts"], np.int64)
    return np.minimum(out.ravel(), 0xFFFFFFFF).astype(np.uint32)


# -- groups of sets that share a listed shingle ------------------------------------------
def shared_lists(docs: DataFrame, counts: np.ndarray, shards: int) -> DataFrame:
    """(pivot, member, shingle): for each group with two sets or more, its members under its least
    set, a row for each group they share.  Shingles dealt over several shards keep their members
    one by one (pivot null), to be grouped by a join-free aggregate."""
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, None] = {}
        for block in T.blocks(batches):
            doc, value, n, bounds, one, two = _sets(block)
            fresh = np.zeros(len(n), bool)
            for i in np.flatnonzero(n):
                key = int(one[i])
                if key not in seen:
                    if len(seen) > 500_000:
                        seen.clear()
                    seen[key] = None
                    fresh[i] = True
            keep = fresh[doc]
            doc, value = doc[keep], value[keep]
            slot = slots(value)
            order = np.lexsort((value, counts[slot], doc))
            doc, value, slot = doc[order], value[order], slot[order]
            first = np.searchsorted(doc, doc)
            keep = np.arange(len(doc)) - first < front(n[doc])
            doc, value, slot = doc[keep], value[keep], slot[keep]
            salt = T.mix(one[doc]) % (counts[slot] // HOT + 1).astype(np.uint64)
            shard = (T.mix(value + salt * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            edges = np.flatnonzero(np.diff(shard[order])) + 1
            if not len(order):
                continue
            rows = np.rec.fromarrays([value[order], one[doc][order]], names="v,s")
            parts = np.split(rows, edges)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[order][np.concatenate([[0], edges])], pa.int64()), pa.array([T.packed(x) for x in parts], pa.binary())],
                names=["shard", "rows"])

    kind = np.dtype([("v", np.uint64), ("s", np.uint64)])

    def group(key, table):
        rows = np.concatenate([np.frombuffer(x.as_py(), kind) for x in table["rows"]])
        rows = rows[np.lexsort((rows["s"], rows["v"]))]
        new = np.ones(len(rows), bool)
        new[1:] = (rows["v"][1:] != rows["v"][:-1]) | (rows["s"][1:] != rows["s"][:-1])
        rows = rows[new]
        hot = counts[slots(rows["v"])] >= HOT
        alone, many = rows[~hot], rows[hot]
        head = np.ones(len(alone), bool)
        head[1:] = alone["v"][1:] != alone["v"][:-1]
        at = np.flatnonzero(head)
        size = np.diff(np.append(at, len(alone)))
        pivot = np.repeat(alone["s"][at], size)
        shared = np.repeat(size, size) > 1
        pivot, member = pivot[shared], alone["s"][shared]
        return pa.table({
            "pivot": pa.chunked_array([pa.array(pivot.view(np.int64)), pa.nulls(len(many), pa.int64())]),
            "member": pa.chunked_array([pa.array(np.ascontiguousarray(member).view(np.int64)), pa.array(np.ascontiguousarray(many["s"]).view(np.int64))]),
            "shingle": pa.chunked_array([pa.nulls(len(pivot), pa.int64()), pa.array(np.ascontiguousarray(many["v"]).view(np.int64))])})

    lists = docs.select("doc_id", "text").mapInArrow(T.tidy_batches(listed), "shard long, rows binary")
    return lists.groupBy("shard").applyInArrow(T.tidy_group(group), "pivot long, member long, shingle long")


def regions(groups: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(region, id, hash, n): the members of each region that can link with something, by their class's least document."""
    dealt = groups.filter(F.col("pivot").isNull()).select("shingle", "member")
    heads = dealt.groupBy("shingle").agg(F.min("member").alias("pivot"), F.max("member").alias("last"))
    dealt = dealt.join(heads.filter("pivot < last"), "shingle").select("pivot", "member")
    pairs = groups.filter(F.col("pivot").isNotNull()).select("pivot", "member").unionByName(dealt)
    pairs = scratch.save(pairs.groupBy("pivot", "member").agg(F.count(F.lit(1)).alias("shared")))
    totals = pairs.groupBy("member").agg(F.sum("shared").alias("shared"))
    n = F.col("n")
    # a linked set has at least 0.8 n shingles; both lists then share 1 + (0.8 n) // 20 at least
    least = F.lit(1) + F.floor(F.floor(n * NEAR / OF) / 20)
    alive = totals.join(classes.withColumnRenamed("set1", "member"), "member").filter(F.col("shared") >= least).select("member", "id", "hash", "n")
    members = pairs.select(F.col("pivot").alias("region"), "member").join(alive, "member").select("region", "id", "hash", "n")
    crowd = members.groupBy("region").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    return members.join(crowd, "region")


# -- joins inside a region ----------------------------------------------------------------
@dataclass
class Members:
    """Sets of a region: ``value[bounds[i]:bounds[i+1]]`` sorted, of document ``ids[i]``."""
    ids: np.ndarray
    value: np.ndarray
    bounds: np.ndarray

    @property
    def n(self) -> np.ndarray:
        return np.diff(self.bounds)


def members_of(ids: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> Members:
    doc, value = T.shingle_sets(T.words(data, offsets, lower=True), len(ids), SHINGLE)
    return Members(ids, value, np.searchsorted(doc, np.arange(len(ids) + 1)))


def intersections(m: Members, pivot: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sorted set ``pivot`` with members ``at``."""
    size = m.n[at]
    upto = np.concatenate([[0], np.cumsum(size)])
    spot = np.repeat(m.bounds[at] - upto[:-1], size) + np.arange(upto[-1])
    value = m.value[spot]
    place = np.minimum(np.searchsorted(pivot, value), len(pivot) - 1)
    hit = np.concatenate([[0], np.cumsum(pivot[place] == value)])
    return hit[upto[1:]] - hit[upto[:-1]]


def central_order(m: Members) -> np.ndarray:
    """Members by how common their shingles are in the region, most common first, ties by id."""
    _, inverse, count = np.unique(m.value, return_inverse=True, return_counts=True)
    upto = np.concatenate([[0], np.cumsum(count[inverse])])
    weight = (upto[m.bounds[1:]] - upto[m.bounds[:-1]]) / np.maximum(m.n, 1)
    return np.lexsort((m.ids, -weight))


def pivot_join(m: Members, active: np.ndarray | None = None, block: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (pairs of positions) that connect every linked pair of the region.

    Members are pivots in turn, central ones first.  A pivot is compared with the members that
    were no pivots yet, are not connected with it already, and lie within the triangle windows of
    the earlier pivots.  ``active``: only these become pivots; ``block``: if given, only pairs
    across its two values are tried."""
    n = m.n
    links: list[tuple[int, int]] = []
    rows: list[np.ndarray] = []  # distances to earlier pivots; NaN where none was computed
    group = np.arange(len(n))
    open_ = n > 0
    may = open_ if active is None else open_ & active
    may = may.copy()
    for p in central_order(m):
        if not may[p]:
            continue
        open_[p] = False
        rest = np.flatnonzero(open_ & (group != group[p]))
        if not len(rest):
            if len(np.unique(group[n > 0])) == 1:
                break
            continue
        rest = rest[(n[rest] * OF >= n[p] * NEAR) & (n[rest] * NEAR <= n[p] * OF)]
        if block is not None:
            rest = rest[block[rest] != block[p]]
        for d in rows:
            if not np.isnan(d[p]):
                rest = rest[~(np.abs(d[rest] - d[p]) > _RADIUS + 1e-9)]
        if not len(rest):
            continue
        inter = intersections(m, m.value[m.bounds[p]:m.bounds[p + 1]], rest)
        if len(rows) < 32:
            distance = np.full(len(n), np.nan)
            distance[rest] = 1 - inter / (n[rest] + n[p] - inter)
            rows.append(distance)
        near = rest[linked(inter, n[rest], n[p])]
        if len(near):
            links.extend((int(p), int(x)) for x in near)
            group[np.isin(group, group[near])] = group[p]
    return links


_LINK = "a long, b long"


def _links(pairs: list[tuple[int, int]], ids: np.ndarray) -> pa.Table:
    a = np.array([x for x, _ in pairs], np.int64)
    b = np.array([y for _, y in pairs], np.int64)
    return pa.table({"a": pa.array(ids[a] if len(a) else a, pa.int64()), "b": pa.array(ids[b] if len(b) else b, pa.int64())})


def _from_table(table: pa.Table) -> Members:
    ids = table["id"].to_numpy()
    data, offsets = T.string_buffers(table["text"])
    return members_of(ids, data, offsets)


def small_regions(rows: DataFrame) -> DataFrame:
    """Links of the regions that one task can hold; ``rows``: (region, id, members, text)."""
    def run(key, table):
        m = _from_table(table)
        return _links(pivot_join(m), m.ids)

    return rows.filter(F.col("members") <= REGION).select("region", "id", "text").groupBy("region").applyInArrow(T.tidy_group(run), _LINK)


def large_regions(every: DataFrame, scratch: Scratch) -> DataFrame | None:
    """Links of the others: the ball of a central pivot first, then what it leaves, in blocks."""
    large = every.filter(F.col("members") > REGION)
    if not large.limit(1).count():
        return None
    shares = F.ceil(F.col("members") / (REGION // 4)).cast("int")
    rows = scratch.save(large.select("region", "id", "text", shares.alias("shares"), F.pmod(F.xxhash64("id"), shares).alias("share")))

    # a central member of one share (a bounded sample) is the pivot of the region
    def centre(key, table):
        m = _from_table(table)
        p = int(central_order(m)[0])
        return pa.table({"region": pa.array([key[0].as_py()], pa.int64()), "p_id": pa.array([m.ids[p]], pa.int64()),
                         "p_text": pa.array([table["text"][p].as_py()], pa.string())})

    sample = rows.join(rows.groupBy("region").agg(F.min("share").alias("share")), ["region", "share"]).select("region", "id", "text")
    # saved: in one stage with ``ball`` each task would hold two Python workers, and an executor keeps all it has had
    pivots = scratch.save(sample.groupBy("region").applyInArrow(T.tidy_group(centre), "region long, p_id long, p_text string"))

    def ball(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                m = _from_table(some)
                data, offsets = T.string_buffers(some["p_text"])
                p = members_of(some["p_id"].to_numpy(), data, offsets)
                inter = np.array([intersections(m, p.value[p.bounds[i]:p.bounds[i + 1]], np.array([i]))[0] if p.n[i] else 0
                                  for i in range(len(m.ids))], np.int64)
                near = linked(inter, m.n, p.n)
                distance = 1 - inter / np.maximum(m.n + p.n - inter, 1)
                yield pa.RecordBatch.from_arrays(
                    [some["region"], some["id"], some["p_id"], pa.array(near), pa.array(distance)],
                    names=["region", "id", "p_id", "near", "distance"])

    tried = scratch.save(rows.join(pivots, "region").select("region", "id", "text", "p_id", "p_text")
                        .mapInArrow(T.tidy_batches(ball), "region long, id long, p_id long, near boolean, distance double"))
    links = tried.filter("near and id != p_id").select(F.col("p_id").alias("a"), F.col("id").alias("b"))
    # outside the ball: each against all that its distance to the pivot allows
    left = tried.filter("not near").groupBy("region").agg(
        F.count(F.lit(1)).alias("left"), F.min("distance").alias("nearest"))
    side = (tried.join(left, "region").filter((~F.col("near")) | (F.col("distance") >= F.col("nearest") - F.lit(_RADIUS + 1e-9)))
            .select("region", "id", "near", "left"))
    half = REGION // 2
    side = side.withColumn("blocks", F.ceil(F.col("left") / half).cast("int"))
    outside = side.filter("not near").withColumn("row", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    inside = side.filter("near").groupBy("region").agg(F.count(F.lit(1)).alias("boundary"))
    column = F.when(F.col("near"), F.col("blocks") + F.pmod(F.xxhash64("id"), F.ceil(F.col("boundary") / half)).cast("int")) \
        .otherwise(F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    every = side.join(inside, "region", "left").withColumn("column", column)
    # a tile (row, column): pairs of an outside block with a later outside block or a boundary block
    as_row = outside.join(inside, "region", "left").select(
        "region", "id", F.col("row").alias("own"), "row",
        F.explode(F.sequence(F.col("row"), F.col("blocks") + F.coalesce(F.ceil(F.col("boundary") / half), F.lit(0)).cast("int") - 1)).alias("column"))
    as_column = every.select(
        "region", "id", F.col("column").alias("own"),
        F.explode(F.sequence(F.lit(0), F.least(F.col("column"), F.col("blocks") - 1))).alias("row"), "column").filter("row != column")
    tiles = as_row.unionByName(as_column)

    def tile(key, table):
        m = _from_table(table)
        row, column = key[1].as_py(), key[2].as_py()
        own = table["own"].to_numpy()
        if row == column:
            return _links(pivot_join(m), m.ids)
        return _links(pivot_join(m, active=own == row, block=own), m.ids)

    found = tiles.join(rows.select("region", "id", "text"), ["region", "id"]).select("region", "row", "column", "own", "id", "text") \
        .groupBy("region", "row", "column").applyInArrow(T.tidy_group(tile), _LINK)
    return links.unionByName(found)


# -- components ---------------------------------------------------------------------------
def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component): the least id reachable, for every id in a link.

    Each round joins every node's least neighbour to its neighbours' (large star, then small
    star); the links of a component become a star round its least id after logarithmically many."""
    edges = scratch.save(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        new = scratch.save(small.select("e.*").filter("a != b").distinct())
        if not new.exceptAll(edges).limit(1).count() and not edges.exceptAll(new).limit(1).count():
            return new.select(F.col("a").alias("id"), F.col("b").alias("component"))
        edges = new


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of each row of ``docs``."""
    with Scratch(docs.sparkSession) as scratch:
        keyed = docs.select(T.row_key(id_col, text_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("hash"), F.col(text_col).alias("text"))
        profiled = scratch.save(profile(keyed))
        sets = profiled.filter("kind = 0").select("id", "hash", "n", "set1", "set2")
        counts = slot_counts(profiled)
        key = ["n", "set1", "set2"]
        classes = scratch.save(sets.filter("n > 0").groupBy(*key).agg(F.min(F.struct("id", "hash")).alias("least")).select(*key, "least.*"))
        shards = max(8, int(counts.sum(dtype=np.int64)) // 4 // SHARD + 1)
        groups = scratch.save(shared_lists(keyed, counts, shards))
        members = scratch.save(regions(groups, classes.select("set1", "id", "hash", "n"), scratch))
        # one text for each class, however many rows share its id.  The list of members grows with the
        # corpus: one plan at every size, no broadcast
        one = ["id", "hash"]
        texts = keyed.withColumnRenamed("doc_id", "id").join(members.select(*one).distinct().hint("merge"), one, "left_semi").dropDuplicates(one)
        rows = scratch.save(texts.join(members.select("region", *one, "members").hint("merge"), one).drop("hash"))
        links = small_regions(rows)
        more = large_regions(rows, scratch)
        if more is not None:
            links = links.unionByName(more)
        # rows that repeat an id with other texts hang together through the id
        several = sets.filter("n > 0").groupBy("id").agg(F.min(F.struct(*key)).alias("x"), F.max(F.struct(*key)).alias("y")).filter("x < y")
        same = sets.join(several.select("id"), "id").join(classes.drop("hash").withColumnRenamed("id", "b"), key).select(F.col("id").alias("a"), "b")
        of_class = components(links.unionByName(same), scratch)
        classed = classes.join(of_class, "id", "left").select(*key, F.coalesce("component", "id").alias("component_id"))
        out = sets.join(classed, key, "left")
        component = F.coalesce("component_id", "id")
        return settle(out.select(T.key_id("id").alias(id_col), F.col("n").alias("n_shingles"),
                                 T.key_id(component).alias("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without near duplicates: of each component the document of the smallest id stays (null ids
    last, ties by a hash of the text).

    A document is an id with its text, so rows that share an id are near duplicates only if their texts are; equal
    documents are one, the row with the least other columns.  Sets that are empty link with nothing, so texts
    without words stay, every one of them."""
    key, component, least = (T.free_name(docs, x) for x in ("_jaccard_key", "_jaccard_component", "_jaccard_least"))
    words = F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    document = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(id_col).cast("long"), F.lit(T.NULL_ID)), F.col(text_col)), 3)
    keyed = docs.withColumn(key, document)
    some = keyed.filter(words)
    linked_docs = join(some.select(key, id_col, text_col), key, text_col).select(F.col(key), F.col("component_id").alias(component)).distinct()
    # everything but the texts, a row for each document; combined map-side, as are the components below
    rest = F.struct(F.lit(0).alias("_none"), *[c for c in docs.columns if c not in (id_col, text_col)])
    light = some.groupBy(F.col(key).alias("_other")).agg(F.min(T.id_key(id_col)).alias("_id"), F.min(rest).alias(least))
    place = F.struct("_id", F.col(key).alias("k"))
    best = linked_docs.join(light, F.col(key) == F.col("_other")).groupBy(component).agg(F.min(place).alias("_best"), F.min_by(least, place).alias(least))
    chosen = best.select(F.col("_best.k").alias("_chosen"), F.col(least))
    # the chosen documents' rows; those that are left are equal in all columns
    kept = some.join(chosen.hint("merge"), F.col(key) == F.col("_chosen")).filter(rest.eqNullSafe(F.col(least))).dropDuplicates([key])
    return kept.select(*docs.columns).unionByName(keyed.filter(~words).select(*docs.columns))
