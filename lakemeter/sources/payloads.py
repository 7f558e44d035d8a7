"""Bronze rows: one row per landed file, with lineage and a content checksum.

Files are scanned by the executors (``wholetext`` text source, file path from the hidden
``_metadata`` column); nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemeter.functions.hashing import checksum
from lakemeter.functions.timeutil import utc_now

BRONZE_COLUMNS = ("source_name", "dataset_name", "ingestion_timestamp_utc", "batch_id",
                  "raw_file_name", "raw_payload", "record_checksum")


def with_lineage(df: DataFrame, source_name: str, dataset_name: str, batch_id: str,
                 ingested_at=None, file_col: str = "raw_file_name",
                 payload_col: str = "raw_payload") -> DataFrame:
    """The seven Bronze columns over any frame holding a file name and its payload text."""
    return df.select(
        F.lit(source_name).alias("source_name"),
        F.lit(dataset_name).alias("dataset_name"),
        utc_now(ingested_at).alias("ingestion_timestamp_utc"),
        F.lit(batch_id).alias("batch_id"),
        F.col(file_col).alias("raw_file_name"),
        F.col(payload_col).alias("raw_payload"),
        checksum(payload_col).alias("record_checksum"),
    )


def scan_payloads(spark: SparkSession, path: str, source_name: str, dataset_name: str,
                  batch_id: str, ingested_at=None, glob: str | None = None) -> DataFrame:
    """Whole-file text scan of landing files (one row per file, never per line)."""
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    raw = reader.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("raw_file_name"), F.col("value").alias("raw_payload"))
    return with_lineage(raw, source_name, dataset_name, batch_id, ingested_at)
