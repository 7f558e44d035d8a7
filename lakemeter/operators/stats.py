"""Exact interpolated percentiles that hold up when one group holds most of the rows.

1. Count rows per (group, value): combines map-side, so repeated values cost nothing.
2. Range-partition the distinct (group, value) pairs: a large group is cut into several
   contiguous value slices, each handled by its own task; a running count inside each
   slice gives local positions.
3. Slice totals (one row per group and slice, so bounded by groups x slices) give each
   slice its offset inside its group and the group size.
4. Each requested position is read off with a conditional ``max`` per group, which is
   combined map-side again, so no task ever holds a whole group.

Interpolation matches ``percentile``: position p * (n - 1) between neighbouring values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemeter.session import materialize

def exact_percentiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                      probs: Sequence[float], names: Sequence[str] | None = None,
                      slices: int | None = None) -> DataFrame:
    names = list(names or [f"p{int(round(p * 100)):02d}" for p in probs])
    g = list(group_cols)
    n_slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    v = F.col(value_col)

    counts = df.where(v.isNotNull()).groupBy(*g, value_col).agg(F.count(F.lit(1)).alias("_c"))
    # written once: both uses below must see the same slices, whatever the planner reuses
    ranged = materialize(counts.repartitionByRange(n_slices, *[F.col(c).asc_nulls_first() for c in g], v.asc())
                         .withColumn("_slice", F.spark_partition_id()))
    upto_here = Window.partitionBy(*g, "_slice").orderBy(value_col) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumn("_hi_local", F.sum("_c").over(upto_here))

    totals = ranged.groupBy(*g, "_slice").agg(F.sum("_c").alias("_t"))
    before = Window.partitionBy(*g).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(g)], F.col("_slice").alias("_s"),
        F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"),
        F.sum("_t").over(Window.partitionBy(*g)).alias("_n"))
    cond = [local[c].eqNullSafe(offsets[f"_g{i}"]) for i, c in enumerate(g)] + \
        [local["_slice"] == offsets["_s"]]
    placed = (local.join(offsets, cond, "inner")
              .withColumn("_hi", F.col("_off") + F.col("_hi_local"))
              .withColumn("_lo", F.col("_hi") - F.col("_c")))

    aggs = []
    for p, name in zip(probs, names):
        pos = (F.col("_n") - 1) * F.lit(float(p))
        def at(i):
            return F.max(F.when((F.col("_lo") <= i) & (i < F.col("_hi")), v))
        aggs += [at(F.floor(pos)).alias(f"_{name}_lo"), at(F.ceil(pos)).alias(f"_{name}_hi"),
                 F.max(pos).alias(f"_{name}_pos")]
    out = placed.groupBy(*g).agg(*aggs)
    cols = [F.col(c) for c in g]
    for name in names:
        lo, hi, pos = F.col(f"_{name}_lo"), F.col(f"_{name}_hi"), F.col(f"_{name}_pos")
        fl, ce = F.floor(pos), F.ceil(pos)
        cols.append(F.when(fl == ce, lo).otherwise((ce - pos) * lo + (pos - fl) * hi).alias(name))
    return out.select(*cols)
