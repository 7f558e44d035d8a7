"""Latest-wins deduplication on a business key.

Written as aggregations, not as a window: a window puts every row of one key into one task,
while ``max``/``max_by`` combine map-side first, so a key holding a third of all rows is
reduced before the shuffle.  The order is a list of columns compared as a tuple, greatest
wins, NULL ranks lowest (the ``DESC NULLS LAST`` of a ranking window).  It must end with a
column that makes rows of one key distinct (e.g. file and record position), otherwise two
rows can tie as latest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(items) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in items]


def order_tuple(order: Sequence) -> Column:
    return F.struct(*_cols(order))


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per key: the row whose order tuple is greatest."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return (df.groupBy(*keys)
            .agg(F.max_by(row, order_tuple(order)).alias("_latest"))
            .select("_latest.*"))


def flag_latest(df: DataFrame, keys: Sequence[str], order: Sequence,
                flag: str = "is_latest") -> DataFrame:
    """Every row, with ``flag`` true on the latest row of its key (NULL keys form one group).

    The per-key maximum is a map-side-combined aggregate; joining it back is a many-to-one
    join that AQE splits when one key is skewed, and turns into a broadcast when the key
    set is small at run time.
    """
    tagged = df.withColumn("_ord", order_tuple(order))
    alias = {k: f"_key{i}" for i, k in enumerate(keys)}
    best = (tagged.groupBy(*[F.col(k).alias(a) for k, a in alias.items()])
            .agg(F.max("_ord").alias("_best")))
    cond = [tagged[k].eqNullSafe(best[a]) for k, a in alias.items()]
    return (tagged.join(best, cond, "left")
            .withColumn(flag, F.coalesce(F.col("_ord") == F.col("_best"), F.lit(False)))
            .drop("_ord", "_best", *alias.values()))


# -- on a layout by key ---------------------------------------------------------------------
STAGED_KEY = "_business_key"


def stage_by_key(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write ``df`` as a table bucketed by its business key, for ``latest_staged`` and ``flag_staged``.

    The key is one text column that is never NULL (NULL parts included), so equality on it is the null-safe
    equality of the parts.  This is the only shuffle: whatever groups or joins by the key afterwards reads
    buckets as they lie.  A bucket is read by one task, so the layout suits keys of which none holds a large
    share of all rows; ``flag_latest`` takes the others."""
    text = F.to_json(F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]), {"ignoreNullFields": "false"})
    keyed = df.withColumn(STAGED_KEY, text).repartition(buckets, STAGED_KEY)
    keyed.write.format("parquet").bucketBy(buckets, STAGED_KEY).saveAsTable(table)
    return df.sparkSession.table(table)


def flag_staged(staged: DataFrame, order: Sequence, flag: str = "is_latest") -> DataFrame:
    """``flag_latest`` of a staged table: maxima and join back without an exchange on either side."""
    tagged = staged.withColumn("_ord", order_tuple(order))
    best = tagged.groupBy(F.col(STAGED_KEY).alias("_best_key")).agg(F.max("_ord").alias("_best"))
    # merge join: both sides come out of the same buckets
    return (tagged.hint("merge").join(best, tagged[STAGED_KEY] == best["_best_key"])
            .withColumn(flag, F.col("_ord") == F.col("_best")).drop("_ord", "_best", "_best_key", STAGED_KEY))


def latest_staged(staged: DataFrame, order: Sequence) -> DataFrame:
    """``latest_rows`` of a staged table, without an exchange."""
    return latest_rows(staged, [STAGED_KEY], order).drop(STAGED_KEY)
