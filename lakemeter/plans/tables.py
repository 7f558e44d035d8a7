"""Keyed writes as pure DataFrame functions, and catalog tables that they are applied to.

``insert_only``, ``upsert`` and ``delete_matching`` take (target, source) frames and return
the new table content; keys match null-safely (``<=>``), which Catalyst plans as an
ordinary hash/sort-merge equi-join.

``TableStore`` keeps managed parquet tables in the session's catalog, which holds their schemas and
partitions: a write touches only the partitions it must (dynamic partition overwrite), partitions
left without rows are dropped by ``ALTER TABLE``, and an unpartitioned table is replaced by writing its
successor beside it and renaming, so readers find the old table or the new one.  New partition content is written to the
shared checkpoint folder first: the overwrite never reads what it replaces, and a lost executor recomputes
from there.  Insert-only writes are plain appends.  One writer per table at a time.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemeter.domain import LAYERS
from lakemeter.operators.dedup import latest_rows
from lakemeter.session import Scratch, checkpoint_dir


def _key_match(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    return [left[k].eqNullSafe(right[f"_src_{k}"]) for k in keys]


def _renamed_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{k}`").alias(f"_src_{k}") for k in keys])


def unique_per_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Deterministic one-row-per-key reduction (greatest row wins)."""
    return latest_rows(source, keys, [F.col(f"`{c}`") for c in source.columns])


def insert_only(target: DataFrame | None, source: DataFrame, keys: Sequence[str],
                new_only: bool = False) -> DataFrame:
    """Source rows whose key is not yet in the target are added; existing rows never change.
    Repeats of one key inside the source are reduced to one row.  ``new_only`` returns just
    the rows to append."""
    src = unique_per_key(source, keys)
    if target is None:
        return src
    tgt_keys = _renamed_keys(target, keys)
    fresh = src.join(tgt_keys, _key_match(src, tgt_keys, keys), "left_anti")
    return fresh if new_only else target.unionByName(fresh)


def upsert(target: DataFrame | None, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key occurs in the source are replaced by the source row; new keys are
    inserted.  The source must be unique per key (checked by ``TableStore``)."""
    if target is None:
        return source
    src_keys = _renamed_keys(source, keys)
    kept = target.join(src_keys, [target[k].eqNullSafe(F.col(f"_src_{k}")) for k in keys], "left_anti")
    return kept.unionByName(source.select(*target.columns))


def delete_matching(target: DataFrame, values: DataFrame, column: str,
                    value_column: str | None = None) -> DataFrame:
    """Target rows whose ``column`` equals one of the distinct non-NULL ``values`` are removed."""
    vc = value_column or column
    vals = values.select(F.col(vc).alias("_del")).where(F.col("_del").isNotNull()).distinct()
    return target.join(vals, target[column] == F.col("_del"), "left_anti")


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    return source.groupBy(*keys).count().where(F.col("count") > 1)


class DuplicateKeyError(ValueError):
    pass


class TableStore:
    """Managed tables named ``layer.table``: database ``<prefix>_<layer>`` at ``root/layer``.

    The catalog is the session's; several applications share tables where it is persistent (a metastore).
    ``partitions`` names the partition column of each partitioned table; NULL is a partition of its own (and,
    as in every such table, the empty string is NULL)."""

    #: partitions dropped by one statement
    DROPPED = 200

    def __init__(self, spark: SparkSession, root: str, partitions: dict[str, str] | None = None, prefix: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.partitions = dict(partitions or {})
        self.prefix = prefix or "lakemeter_" + hashlib.md5(self.root.encode()).hexdigest()[:12]
        self._layers: set[str] = set()

    # -- names and existence ------------------------------------------------------------
    def _database(self, layer: str) -> str:
        if layer not in self._layers:
            location = f"{self.root}/{layer}".replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.prefix}_{layer}` LOCATION '{location}'")
            self._layers.add(layer)
        return f"{self.prefix}_{layer}"

    def name(self, table: str, suffix: str = "") -> str:
        layer, name = table.split(".", 1)
        return f"`{self._database(layer)}`.`{name}{suffix}`"

    def exists(self, table: str) -> bool:
        """A table exists once a write has committed.  A swap that was cut short is finished here."""
        if self.spark.catalog.tableExists(self.name(table)):
            return True
        layer, name = table.split(".", 1)
        ready = self.spark.sql(f"SHOW TABLES IN `{self._database(layer)}` LIKE '{name}__next*'").collect()
        if not ready:
            return False
        self.spark.sql(f"ALTER TABLE `{self._database(layer)}`.`{ready[0]['tableName']}` RENAME TO {self.name(table)}")
        return True

    def read(self, table: str) -> DataFrame:
        """The table as the catalog describes it; empty when every partition has been dropped."""
        self.exists(table)
        return self.spark.table(self.name(table))

    def ensure_layers(self, layers: Sequence[str] = LAYERS) -> None:
        for layer in layers:
            self._database(layer)

    def drop(self) -> None:
        """Drop all tables of the store."""
        for layer in sorted(self._layers):
            self.spark.sql(f"DROP DATABASE IF EXISTS `{self.prefix}_{layer}` CASCADE")
        self._layers.clear()

    # -- writes -----------------------------------------------------------------------
    def _laid_out(self, table: str, df: DataFrame) -> DataFrame:
        """Rows of one partition value together, so that it gets few files; adaptive execution cuts a value
        that holds much and joins those that hold little."""
        part = self.partitions.get(table)
        return df.hint("rebalance", F.col(f"`{part}`")) if part else df

    def _into(self, table: str, df: DataFrame, mode: str) -> None:
        columns = self.spark.table(self.name(table)).columns  # the catalog puts the partition column last
        writer = self._laid_out(table, df.select(*[F.col(f"`{c}`") for c in columns])).write.mode(mode)
        writer.option("partitionOverwriteMode", "dynamic").insertInto(self.name(table))

    def overwrite(self, table: str, df: DataFrame) -> None:
        """Make the whole table hold ``df`` (which may read the table): a partitioned table partition by
        partition, another by a successor that is written beside it and then renamed."""
        part = self.partitions.get(table)
        if part:
            if self.exists(table):
                self._replace(table, df, self.read(table).select(part))
            else:  # the definition first: an attempt that fails leaves an empty table, not a folder without one
                df.limit(0).write.format("parquet").partitionBy(part).saveAsTable(self.name(table))
                self._into(table, df, "append")
            return
        staged, old = (self.name(table, f"__{x}{uuid.uuid4().hex[:8]}") for x in ("next", "old"))
        there = self.exists(table)
        df.write.format("parquet").saveAsTable(staged)
        if there:
            self.spark.sql(f"ALTER TABLE {self.name(table)} RENAME TO {old}")
        self.spark.sql(f"ALTER TABLE {staged} RENAME TO {self.name(table)}")
        if there:
            self.spark.sql(f"DROP TABLE {old}")

    def append(self, table: str, df: DataFrame) -> None:
        if self.exists(table):
            self._into(table, df, "append")
        else:
            self.overwrite(table, df)

    def _drop_partitions(self, table: str, values: DataFrame) -> None:
        """Drop the partitions of the given values (one row a value, sent in bounded statements)."""
        part = self.partitions[table]
        rows = values.select(F.col(f"`{part}`").cast("string")).distinct().toLocalIterator()
        specs = ["null" if r[0] is None else "'" + r[0].replace("\\", "\\\\").replace("'", "\\'") + "'" for r in rows]
        for at in range(0, len(specs), self.DROPPED):
            some = ", ".join(f"PARTITION (`{part}` = {x})" for x in specs[at:at + self.DROPPED])
            self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS {some}")

    def _replace(self, table: str, content: DataFrame, affected: DataFrame | None = None) -> None:
        """Make the table, or only the affected partitions of a partitioned one, hold ``content``."""
        part = self.partitions.get(table)
        if not part:
            self.overwrite(table, content)
            return
        with Scratch(self.spark) as scratch:
            content, affected = scratch.save(content), scratch.save(affected.select(part).distinct())
            # the overwrite replaces the partitions that ``content`` has; the others of ``affected`` go
            kept = content.select(F.col(part).alias("_kept")).distinct()
            emptied = scratch.save(affected.join(kept, affected[part].eqNullSafe(kept["_kept"]), "left_anti"))
            self._into(table, content, "overwrite")
            self._drop_partitions(table, emptied)

    def insert_only(self, table: str, source: DataFrame, keys: Sequence[str], keep_repeats: bool = False,
                    before: Callable[[DataFrame], None] | None = None) -> dict:
        """Append the rows whose key is not yet in the table; returns the rows seen and inserted.

        A key repeated inside the source is reduced to its greatest row (``keep_repeats``: all its rows are
        appended).  Only keys are shuffled to find those that are held or repeated; whole rows are shuffled and
        written again only where there are some.  ``before`` gets the new rows ahead of the append: what it
        writes is there before the rows are."""
        with Scratch(self.spark) as scratch:
            rows = scratch.save(source)
            seen = rows.count()
            named = [F.col(f"_src_{k}") for k in keys]
            fresh, there = rows, self.exists(table)
            if there or not keep_repeats:
                tags = _renamed_keys(rows, keys).withColumn("_new", F.lit(1))
                if there:
                    tags = tags.unionByName(_renamed_keys(self.read(table), keys).withColumn("_new", F.lit(0)))
                odd = tags.groupBy(*named).agg(F.sum("_new").alias("_rows"), (F.min("_new") == 0).alias("_held"))
                odd = scratch.save(odd.where("_rows > 0").where("_held" if keep_repeats else "_held or _rows > 1"))
                held = odd.where("_held")
                if not held.isEmpty():
                    fresh = fresh.join(held.select(*named), [fresh[k].eqNullSafe(F.col(f"_src_{k}")) for k in keys], "left_anti")
                if not keep_repeats and not odd.where("_rows > 1").isEmpty():
                    fresh = unique_per_key(fresh, keys)
            if fresh is not rows:
                fresh = scratch.save(fresh)
            inserted = fresh.count()
            if inserted and before:
                before(fresh)
            if inserted or not self.exists(table):
                self.append(table, fresh)
        return {"seen": int(seen), "inserted": int(inserted)}

    def upsert(self, table: str, source: DataFrame, keys: Sequence[str], check_unique: bool = True) -> None:
        if check_unique and not duplicate_keys(source, keys).isEmpty():
            raise DuplicateKeyError(f"source for {table} repeats a key of {list(keys)}")
        if not self.exists(table):
            self.overwrite(table, source)
            return
        part = self.partitions.get(table)
        target = self.read(table)
        if not part:
            self._replace(table, upsert(target, source, keys), None)
            return
        with Scratch(self.spark) as scratch:
            # the source's partitions and those that hold matched keys (a key may change partition)
            keyed = _renamed_keys(source, keys)
            held = target.join(keyed, _key_match(target, keyed, keys), "left_semi").select(part)
            touched = scratch.save(source.select(part).unionByName(held).distinct())
            same = touched.select(F.col(part).alias("_touched"))
            target = target.join(same, target[part].eqNullSafe(same["_touched"]), "left_semi")
            self._replace(table, upsert(target, source, keys), touched)

    def delete_matching(self, table: str, values: DataFrame, column: str) -> None:
        if not self.exists(table):
            return
        vals = values.select(column).where(F.col(column).isNotNull()).distinct()
        part = self.partitions.get(table)
        if part == column:
            self._drop_partitions(table, vals)  # whole partitions go, nothing is rewritten
            return
        target = self.read(table)
        if not part:
            self._replace(table, delete_matching(target, vals, column), None)
            return
        with Scratch(self.spark) as scratch:
            touched = scratch.save(target.join(vals, column, "left_semi").select(part).distinct())
            same = touched.select(F.col(part).alias("_touched"))
            target = target.join(same, target[part].eqNullSafe(same["_touched"]), "left_semi")
            self._replace(table, delete_matching(target, vals, column), touched)

    def replace_partitions(self, table: str, content: DataFrame, affected: DataFrame) -> None:
        """Make the ``affected`` partitions hold exactly ``content`` (delete, then upsert in one write)."""
        if self.exists(table):
            self._replace(table, content, affected)
        else:
            self.overwrite(table, content)


@contextmanager
def scratch_store(spark: SparkSession, partitions: dict[str, str] | None = None) -> Iterator[TableStore]:
    """A store under the shared checkpoint folder, dropped at the end: ``settle`` what is to outlive it."""
    store = TableStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/lakemeter-store-{uuid.uuid4().hex}", partitions)
    try:
        yield store
    finally:
        store.drop()
