"""Source contracts over landed payloads, and manifest reconciliation.

The payload contract is evaluated inside each row with higher-order functions over the
parsed ``data`` array, so it needs no shuffle: every file is checked where it is read.
The raw JSON type of each value is read from a VARIANT, which (unlike a typed
``from_json``) tells numbers, booleans, strings and missing fields apart.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemeter.functions.hashing import checksum

# fixed values: contract violation labels
DATA_NOT_NONEMPTY_LIST = "DATA_NOT_NONEMPTY_LIST"
RECORD_NOT_OBJECT = "RECORD_NOT_OBJECT"
NO_INTERVAL_START = "NO_INTERVAL_START"
VALUE_NOT_NUMERIC = "VALUE_NOT_NUMERIC"
VALUE_INVALID = "VALUE_INVALID"

_NUMERIC = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$"


def _record_fields(value_field: str) -> str:
    """SQL lambda body: what the contract asks about one record ``x``, each path read once."""
    return (f"named_struct('x', x, 'start', try_variant_get(x, '$.timeInterval.start', 'string'), "
            f"'value', variant_get(x, '$.{value_field}'))")


#: SQL lambda body: first violated clause of a record's fields ``f`` (NULL when it passes).  A record with an interval
#: start is an object; NaN and infinity lie outside the range of finite values
_VIOLATION = f"""CASE
  WHEN f.start IS NULL AND NOT startswith(coalesce(schema_of_variant(f.x), ''), 'OBJECT') THEN '{RECORD_NOT_OBJECT}'
  WHEN coalesce(f.start, '') = '' THEN '{NO_INTERVAL_START}'
  WHEN f.value IS NULL OR is_variant_null(f.value) OR NOT regexp_like(schema_of_variant(f.value), '{_NUMERIC}') THEN '{VALUE_NOT_NUMERIC}'
  WHEN NOT coalesce(try_variant_get(f.value, '$', 'double') BETWEEN 0 AND 1.7976931348623157E308D, false) THEN '{VALUE_INVALID}'
END"""


def check_payloads(bronze: DataFrame, value_field: str, payload_col: str = "raw_payload",
                   keep=("raw_file_name",)) -> DataFrame:
    """Per payload: record count, first violating record (0-based) and its violation.

    Contract: ``data`` is a non-empty list; each record is an object with a non-empty
    interval start and a numeric (not boolean), finite, non-negative value.
    Each expensive value (the parsed array, the first violation) is computed once in its
    own projection and then referenced, so the optimizer never re-evaluates it per field.
    """
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", value_field):
        raise ValueError(f"not a field name: {value_field!r}")
    data = F.expr(f"try_variant_get(try_parse_json({payload_col}), '$.data', 'array<variant>')")
    labelled = F.expr(
        f"filter(transform(transform(_data, x -> {_record_fields(value_field)}), (f, i) -> named_struct('i', i, 'r', {_VIOLATION})), s -> s.r IS NOT NULL)")
    parsed = bronze.select(*keep, data.alias("_data"))
    checked = parsed.select(*keep, F.coalesce(F.size("_data"), F.lit(0)).alias("_n"),
                            F.try_element_at(labelled, F.lit(1)).alias("_first"))
    empty = F.col("_n") <= 0
    return checked.select(
        *keep,
        F.when(empty, 0).otherwise(F.col("_n")).alias("record_count"),
        F.when(~empty, F.col("_first.i")).alias("violation_index"),
        F.when(empty, F.lit(DATA_NOT_NONEMPTY_LIST)).otherwise(F.col("_first.r")).alias("violation"),
    ).withColumn("is_valid", F.col("violation").isNull())


def manifest_entries(manifests: DataFrame, payload_col: str = "raw_payload", keep=()) -> DataFrame:
    """Landing manifests -> one row per (dataset, file) with declared rows and checksum.

    Both layouts are read with one schema: ``pages[]{file, records, sha256}`` and
    ``files[]{file, rows, sha256}``.
    """
    entry = "array<struct<file: string, records: bigint, rows: bigint, sha256: string>>"
    schema = (f"market_date string, batch_id string, datasets map<string, struct<endpoint: string, "
              f"records: bigint, pages: {entry}, files: {entry}>>")
    p = F.from_json(F.col(payload_col), schema)
    per_set = manifests.select(*keep, p["market_date"].alias("market_date"),
                               F.explode_outer(p["datasets"]).alias("dataset", "_d"))
    files = per_set.select(*keep, "market_date", "dataset",
                           F.explode_outer(F.coalesce(F.col("_d.pages"), F.col("_d.files"))).alias("_f"))
    return files.select(*keep, "market_date", "dataset",
                        F.col("_f.file").alias("file_name"),
                        F.coalesce(F.col("_f.records"), F.col("_f.rows")).alias("declared_rows"),
                        F.lower(F.col("_f.sha256")).alias("declared_sha256"))


def landed_files(bronze: DataFrame, payload_col: str = "raw_payload", file_col: str = "raw_file_name") -> DataFrame:
    """Per landed file: the date folder it lies in (NULL without one), its dataset where Bronze names one,
    base name, record count of ``data`` and raw-byte checksum."""
    data = F.expr(f"try_variant_get(try_parse_json(`{payload_col}`), '$.data', 'array<variant>')")
    day = F.regexp_extract(F.col(file_col), r"/(\d{4}-\d{2}-\d{2})/", 1)
    return bronze.select(
        F.when(day != "", day).alias("market_date"),
        *([F.col("dataset_name").alias("dataset")] if "dataset_name" in bronze.columns else []),
        F.regexp_extract(F.col(file_col), r"([^/]+)$", 1).alias("file_name"),
        F.coalesce(F.size(data), F.lit(0)).cast("bigint").alias("landed_rows"),
        checksum(payload_col).alias("landed_sha256"),
    )


RECONCILE_KEYS = ("market_date", "dataset", "file_name")


def _per_key(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """One row per key: the greatest row count and checksum, and how often the key occurs."""
    return df.groupBy(*[F.col(k).alias(f"_{prefix}_{k}") for k in keys]).agg(
        F.max(f"{prefix}_rows").alias(f"{prefix}_rows"), F.max(f"{prefix}_sha256").alias(f"{prefix}_sha256"),
        F.count(F.lit(1)).alias(f"{prefix}_files"))


def reconcile(declared: DataFrame, landed: DataFrame, key: str | Sequence[str] | None = None) -> DataFrame:
    """Full outer comparison of what manifests declare with what landed.

    Every day's pages have the same base names, so the default key is those of (market date, dataset, file) that
    both sides have.  A key is compared once however often it occurs: both sides are reduced to one row per key
    first, so the join never multiplies rows, and a key that occurs more than once on a side is a
    DUPLICATE.  NULL parts of a key match each other."""
    keys = [key] if isinstance(key, str) else list(key or [k for k in RECONCILE_KEYS if k in declared.columns and k in landed.columns])
    d, l = _per_key(declared, keys, "declared"), _per_key(landed, keys, "landed")
    same = [d[f"_declared_{k}"].eqNullSafe(l[f"_landed_{k}"]) for k in keys]
    j = d.join(l, same, "full")
    status = (F.when(F.col("declared_files").isNull(), "UNLISTED")
              .when(F.col("landed_files").isNull(), "MISSING")
              .when((F.col("declared_files") > 1) | (F.col("landed_files") > 1), "DUPLICATE")
              .when(~F.col("declared_rows").eqNullSafe(F.col("landed_rows")), "ROW_COUNT_MISMATCH")
              .when(~F.col("declared_sha256").eqNullSafe(F.col("landed_sha256")), "CHECKSUM_MISMATCH")
              .otherwise("OK"))
    return j.select(*[F.coalesce(f"_declared_{k}", f"_landed_{k}").alias(k) for k in keys], "declared_rows", "declared_sha256",
                    "landed_rows", "landed_sha256", F.coalesce("declared_files", F.lit(0)).alias("declared_files"),
                    F.coalesce("landed_files", F.lit(0)).alias("landed_files"), status.alias("status"))
