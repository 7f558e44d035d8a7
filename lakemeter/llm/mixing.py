"""Mixing sources to target weights (operator 7), with DataFrame functions only.

1. Targets.  Sources in code-point order (null last) take ``WEIGHTS`` in turn and share the size of
   all documents by weight; a source stops at ``MOST`` times its own size and its excess goes to
   the others by weight (one sorted pass over the table of sources).
2. Draws.  A 60-bit hash of (id, text, number among equal rows) permutes a source's documents.  The mix takes every document
   ``floor(target / source size)`` times and, for the rest, the documents whose hash lies below
   the source's threshold.  The threshold is found on a tree of ``FAN`` hash blocks a node, only
   the block that holds it being opened at each level; the last block, of a bounded number of
   documents, fills what is left by taking its documents largest first where they still fit.
3. Splitting tree.  The blocks drawn of every source (repeats are further blocks) are divided
   among the output shards: a node splits its exact quotas between its two children by
   multivariate-hypergeometric draws, down to one shard.  A source's drawn blocks, in an order
   permuted by hash, go to the shards in runs of those quotas, so draws are disjoint; rows of a
   shard are shuffled by a hash of (row hash, copy).

The only single-task steps are over the table of sources and the tree's nodes.  Nothing random is
drawn: all choices are hashes, so reruns agree.

Cases: null text has size 0; the null source is a source of its own; a document of size 0 is taken
like others but adds no words; rows that share an id, or have none, are documents of their own, each
with its own place in the order; no rows or only empty texts: targets 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemeter.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
#: blocks of a source (children of a node of the threshold tree), documents of a leaf
FAN_BITS = 6
FAN = 1 << FAN_BITS
BITS = 60
LEAF = 256
SHARDS = 8


def count_words(text: str) -> Column:
    """Number of runs of characters other than the six ASCII white-space characters."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """``sources`` (source, source_size) with ``weight`` and ``target``."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    s = sources.withColumn("place", place).withColumn("weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")))
    s = s.withColumn("_limit", F.col("source_size") * F.lit(float(most)))
    by_ratio = Window.orderBy(F.col("_limit") / F.col("weight"), "place")
    above, below = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # if every source of smaller limit / weight is full, the others share what is left
    s = s.withColumn("_total", F.sum("source_size").over(whole).cast("double"))
    s = s.withColumn("_rate", (F.col("_total") - F.coalesce(F.sum("_limit").over(above), F.lit(0.0))) / F.sum("weight").over(below))
    s = s.withColumn("_full", F.col("_limit") <= F.col("weight") * F.col("_rate"))
    s = s.withColumn("_share", F.min(F.when(~F.col("_full"), F.struct(F.col("_limit") / F.col("weight"), "place", F.col("_rate").alias("rate")))).over(whole))
    target = F.when(F.col("_full"), F.col("_limit")).otherwise(F.least("_limit", F.col("weight") * F.col("_share.rate")))
    return s.withColumn("target", F.coalesce(target, F.lit(0.0))).drop("_limit", "_total", "_rate", "_full", "_share")


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def thresholds(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` with ``low``: documents of smaller hash are taken once more; ``high``: end of the
    leaf; ``chosen``: hashes taken in the leaf.  One pass a level, each over a FANth of the last."""
    size = F.col("source_size").cast("double")
    whole = F.when(size > 0, F.least(F.lit(float(MOST)), F.floor(F.col("target") / size))).otherwise(F.lit(0.0))
    node = plan.withColumn("whole", whole.cast("int")).withColumn(
        "rest", F.when(F.col("whole") < MOST, F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * size)).otherwise(F.lit(0.0)))
    node = materialize(node.withColumn("low", F.lit(0).cast("long")).withColumn("high", F.lit(1 << BITS).cast("long"))
                       .withColumn("held", F.col("documents")))
    shift = BITS
    while shift >= 2 * FAN_BITS and node.filter((F.col("held") > LEAF) & (F.col("rest") > 0)).limit(1).count():
        shift -= FAN_BITS
        open_ = node.filter((F.col("held") > LEAF) & (F.col("rest") > 0)).select(
            F.col("source").alias("_s"), F.col("low").alias("_low"), F.col("high").alias("_high"), F.col("rest").alias("_rest"))
        inside = sizes.join(open_, _same("source", "_s")).filter((F.col("hash") >= F.col("_low")) & (F.col("hash") < F.col("_high")))
        children = (inside.groupBy("source", "_low", "_rest", F.shiftright("hash", shift).alias("child"))
                    .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")))
        upto = Window.partitionBy("source").orderBy("child").rowsBetween(Window.unboundedPreceding, 0)
        children = children.withColumn("upto", F.sum("words").over(upto))
        # the first child that holds more than what is left; without one, everything is taken
        edge = children.groupBy(F.col("source").alias("_s")).agg(
            F.min(F.when(F.col("upto") > F.col("_rest"), F.struct("child", "n", (F.col("_rest") - (F.col("upto") - F.col("words"))).alias("rest")))).alias("edge"))
        node = node.join(edge, _same("source", "_s"), "left")
        step = F.col("edge.child")
        opened = F.col("_s").isNotNull() | F.col("edge").isNotNull()
        node = materialize(node.select(
            *[c for c in node.columns if c not in ("low", "high", "rest", "held", "_s", "edge")],
            F.when(F.col("edge").isNotNull(), F.shiftleft(step, shift)).when(opened, F.col("high")).otherwise(F.col("low")).alias("low"),
            F.when(F.col("edge").isNotNull(), F.shiftleft(step + 1, shift)).otherwise(F.col("high")).alias("high"),
            F.when(F.col("edge").isNotNull(), F.col("edge.rest")).when(opened, F.lit(0.0)).otherwise(F.col("rest")).alias("rest"),
            F.when(F.col("edge").isNotNull(), F.col("edge.n")).when(opened, F.lit(0)).otherwise(F.col("held")).alias("held")))
    leaf = node.filter(F.col("rest") > 0).select(F.col("source").alias("_s"), "low", "high", "rest")
    inside = sizes.join(leaf, _same("source", "_s")).filter((F.col("hash") >= F.col("low")) & (F.col("hash") < F.col("high")))
    largest_first = F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("size"), "hash")))
    empty = F.array().cast("array<bigint>")
    start = F.struct(F.col("rest").alias("rest"), empty.alias("taken"))

    def fit(acc, x):
        own = -x["size"]
        # taken if it fits, or if going over by it is nearer than stopping short
        fits = own.cast("double") <= acc["rest"]
        return F.when(fits, F.struct((acc["rest"] - own).alias("rest"), F.concat(acc["taken"], F.array(x["hash"])).alias("taken"))).otherwise(acc)

    chosen = (inside.groupBy("source", "rest").agg(largest_first.alias("docs"))
              .select(F.col("source").alias("_s"), F.aggregate("docs", start, fit, lambda acc: acc["taken"]).alias("chosen")))
    return node.join(chosen, _same("source", "_s"), "left").drop("_s").withColumn("chosen", F.coalesce("chosen", empty))


def _uniform(*cols) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(float(1 << 53))


def _hypergeometric(total: Column, own: Column, draws: Column, u: Column) -> Column:
    """How many of ``own`` among ``total`` blocks are in a sample of ``draws``, by inversion at ``u``."""
    low = F.greatest(F.lit(0), draws - (total - own))
    high = F.least(own, draws)
    start = F.struct(F.lit(1.0).alias("w"), F.array(F.lit(1.0)).alias("upto"))

    def step(acc, k):
        ratio = ((own - k) * (draws - k)).cast("double") / ((k + 1) * (total - own - draws + k + 1)).cast("double")
        w = acc["w"] * ratio
        return F.struct(w.alias("w"), F.concat(acc["upto"], F.array(F.element_at(acc["upto"], -1) + w)).alias("upto"))

    ks = F.when(high > low, F.sequence(low, high - 1)).otherwise(F.array().cast("array<int>"))
    upto = F.aggregate(ks, start, step, lambda acc: acc["upto"])
    return F.least(high, low + F.size(F.filter(upto, lambda c: c <= u * F.element_at(upto, -1)))).cast("int")


def splitting_tree(quotas: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(shard, counts): blocks of each source (array in source order) that each shard gets.

    ``quotas`` is one row with ``counts``, the blocks drawn of each source."""
    nodes = quotas.select(F.lit(0).alias("shard"), F.lit(shards).alias("width"), "counts")
    while shards > 1:
        half = F.floor(F.col("width") / 2).cast("int")
        all_ = F.aggregate("counts", F.lit(0), lambda a, x: a + x)
        draws = F.floor(all_ * half / F.col("width")).cast("int")
        start = F.struct(all_.alias("total"), draws.alias("draws"), F.array().cast("array<int>").alias("left"))

        def give(acc, own):
            u = _uniform(F.col("shard"), F.col("width"), F.size(acc["left"]))
            k = _hypergeometric(acc["total"], own, acc["draws"], u)
            return F.struct((acc["total"] - own).alias("total"), (acc["draws"] - k).alias("draws"), F.concat(acc["left"], F.array(k)).alias("left"))

        left = F.aggregate("counts", start, give, lambda acc: acc["left"])
        split = nodes.filter("width > 1").withColumn("left", left)
        nodes = materialize(nodes.filter("width = 1").unionByName(split.select(F.explode(F.array(
            F.struct(F.col("shard"), half.alias("width"), F.col("left").alias("counts")),
            F.struct((F.col("shard") + half).alias("shard"), (F.col("width") - half).alias("width"),
                     F.zip_with("counts", "left", lambda a, b: a - b).alias("counts")))).alias("n")).select("n.*")))
        shards = -(-shards // 2)
    return nodes.select("shard", "counts")


def _equal_rows(id_col: str, text_col: str, source_col: str) -> Column:
    """A hash that rows of equal id, text and source share."""
    return F.xxhash64(*[x for c in (id_col, text_col, source_col) for x in (F.col(c).isNull(), F.col(c))])


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (key, part, row: fixed values) with ``nth``, a number from 0 among the rows of a key.

    A key's rows are numbered part by part, so a key of many rows is not sorted in one task."""
    counts = rows.groupBy(F.col("key").alias("_k"), F.col("part").alias("_p")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("_k").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))).filter("_before > 0").drop("n")
    inside = F.row_number().over(Window.partitionBy("key", "part").orderBy("row")) - 1
    out = rows.withColumn("nth", inside).join(counts, (F.col("key") == F.col("_k")) & (F.col("part") == F.col("_p")), "left")
    return out.withColumn("nth", F.col("nth") + F.coalesce("_before", F.lit(0))).drop("_k", "_p", "_before")


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             shards: int = SHARDS) -> DataFrame:
    """(id, source, size, source_size, target, copies, shards): how often each document is taken and
    the output shard of each copy."""
    rows = materialize(docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("source"), count_words(text_col).alias("size"),
        _equal_rows(id_col, text_col, source_col).alias("key"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")))
    return _plan(rows, shards).select(F.col("_id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "copies", "shards")


def _plan(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` (_id, source, size, key, part, row) with ``hash``, ``source_size``, ``target``, ``copies`` and ``shards``."""
    sizes = materialize(numbered(rows).withColumn("hash", F.shiftrightunsigned(F.xxhash64("key", "nth"), 64 - BITS))
                        .select("_id", "source", "size", "row", "hash"))
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    plan = materialize(thresholds(sizes, targets(sources)))
    # drawn blocks: every block once for each whole pass, and those at or below the threshold once more
    block = F.col("block")
    reached = F.when(F.size("chosen") > 0, F.shiftright("high", BITS - FAN_BITS) + F.when(F.pmod("high", F.lit(1 << (BITS - FAN_BITS))) > 0, 1).otherwise(0)) \
        .otherwise(F.shiftright("low", BITS - FAN_BITS) + F.when(F.pmod("low", F.lit(1 << (BITS - FAN_BITS))) > 0, 1).otherwise(0))
    drawn = (plan.withColumn("_reached", reached).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(FAN - 1))))
             .withColumn("passes", F.col("whole") + F.when(block < F.col("_reached"), 1).otherwise(0))
             .filter("passes > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("passes"))))
             .select("source", "place", "block", "copy"))
    order = Window.partitionBy("source").orderBy(F.xxhash64("place", "block", "copy"), "block", "copy")
    drawn = materialize(drawn.withColumn("turn", F.row_number().over(order)))
    per_source = plan.select("source", "place").join(
        drawn.groupBy(F.col("place").alias("_p")).agg(F.count(F.lit(1)).cast("int").alias("n")), F.col("place") == F.col("_p"), "left")
    quotas = per_source.agg(F.transform(F.array_sort(F.collect_list(F.struct("place", F.coalesce("n", F.lit(0)).alias("n")))), lambda x: x["n"]).alias("counts"))
    parts = splitting_tree(quotas, shards).select("shard", F.posexplode("counts").alias("place", "n"))
    runs = parts.withColumn("upto", F.sum("n").over(Window.partitionBy("place").orderBy("shard"))).filter("n > 0")
    runs = runs.groupBy(F.col("place").alias("_p")).agg(F.array_sort(F.collect_list(F.struct("upto", "shard"))).alias("runs"))
    # the shard whose run of the source's permuted blocks holds this block's turn
    of_block = (drawn.join(runs, F.col("place") == F.col("_p"))
                .withColumn("shard", F.element_at(F.filter("runs", lambda r: r["upto"] >= F.col("turn")), 1)["shard"])
                .groupBy("place", "block").agg(F.transform(F.array_sort(F.collect_list(F.struct("copy", "shard"))), lambda x: x["shard"]).alias("shards")))
    of_source = of_block.groupBy(F.col("place").alias("_p")).agg(F.map_from_entries(F.collect_list(F.struct("block", "shards"))).alias("blocks"))
    plan = plan.join(of_source, F.col("place") == F.col("_p"), "left").select(
        F.col("source").alias("_s"), "source_size", "target", "whole", "low", "chosen", "blocks")
    extra = (F.col("hash") < F.col("low")) | F.array_contains("chosen", F.col("hash"))
    copies = F.col("whole") + F.when(extra & (F.col("whole") < MOST), 1).otherwise(0)
    out = sizes.join(plan, _same("source", "_s")).withColumn("copies", copies)
    of_doc = F.element_at("blocks", F.shiftright("hash", BITS - FAN_BITS).cast("int"))
    return out.select("_id", "source", "size", "row", "hash", "source_size", "target", "copies",
                      F.coalesce(F.slice(of_doc, F.lit(1), F.col("copies")), F.array().cast("array<int>")).alias("shards"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        shards: int = SHARDS) -> DataFrame:
    """The mixed rows: each document of ``docs``, all columns, once for each copy, with ``_mix_shard`` and
    ``_mix_position`` (the order inside the shard)."""
    fixed = materialize(docs.withColumn("_mix_part", F.spark_partition_id()).withColumn("_mix_row", F.monotonically_increasing_id()))
    rows = fixed.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"), count_words(text_col).alias("size"),
                        _equal_rows(id_col, text_col, source_col).alias("key"), F.col("_mix_part").alias("part"), F.col("_mix_row").alias("row"))
    plan = _plan(rows, shards).filter("copies > 0").select(F.col("row").alias("_mix_row"), F.col("hash").alias("_mix_hash"), F.col("shards").alias("_mix_shards"))
    out = fixed.join(plan, "_mix_row").select(*docs.columns, "_mix_hash", F.posexplode("_mix_shards").alias("_mix_copy", "_mix_shard"))
    return out.withColumn("_mix_position", F.xxhash64("_mix_hash", "_mix_copy")).drop("_mix_copy", "_mix_hash")


def report(plan: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, size, source_size, target, taken, copies, shards) of ``plan_mix``'s rows."""
    return plan.select(id_col, "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "shards")
