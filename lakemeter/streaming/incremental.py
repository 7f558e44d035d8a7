"""Incremental landing and streaming interval aggregates (Structured Streaming).

``start_landing`` watches a landing folder: every micro-batch of new files is appended to
Bronze (insert-only on the checksum) and, optionally, Silver is rebuilt for the market
dates those files touch, over *all* Bronze rows of those dates (latest-wins and
completeness are facts about whole dates).  The stream's checkpoint makes a restarted
job resume after the last committed batch.  A batch that failed half-way is replayed under its epoch: a
ledger table holds the steps that each epoch has finished, these are not repeated, and the step
that was cut short is keyed (Bronze by checksum, Silver and Gold by date, outcomes by run), so doing it again
gives what an undisturbed run would have given.

``interval_aggregate`` is the streaming counterpart of the per-interval roll-up: a
watermark bounds the state, repeats of a key within the watermark are dropped, and
tumbling windows are emitted once they can no longer change.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampNTZType

from lakemeter import domain as D
from lakemeter.functions.timeutil import instant_to_ntz, ntz_to_instant
from lakemeter.operators.quality import BlockingFailure
from lakemeter.plans.lakehouse import Lakehouse
from lakemeter.plans.tables import TableStore
from lakemeter.sources.payloads import with_lineage


def landing_stream(spark: SparkSession, path: str, glob: str | None = None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming whole-file scan of a landing folder: (raw_file_name, raw_payload)."""
    reader = spark.readStream.format("text").option("wholetext", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).select(F.col("_metadata.file_path").alias("raw_file_name"),
                                    F.col("value").alias("raw_payload"))


class BatchLedger:
    """Steps that each epoch of a query has finished, one row each in a table of the store.

    ``once`` runs a step unless the ledger has it, and enters it afterwards: a failure before the entry repeats the
    step (so steps must be idempotent), one after it does not."""

    TABLE = D.table_name("ops", "landing_batches")
    SCHEMA = "query string, epoch long, step string"

    def __init__(self, store: TableStore, query: str):
        self.store, self.query = store, query

    def finished(self, epoch: int) -> set[str]:
        if not self.store.exists(self.TABLE):
            return set()
        mine = (F.col("query") == self.query) & (F.col("epoch") == epoch)
        return {r["step"] for r in self.store.read(self.TABLE).where(mine).select("step").collect()}  # a handful

    def once(self, epoch: int, step: str, work: Callable[[], None]) -> bool:
        if step in self.finished(epoch):
            return False
        work()
        self.store.append(self.TABLE, self.store.spark.createDataFrame([(self.query, epoch, step)], self.SCHEMA))
        return True


def start_landing(house: Lakehouse, path: str, dataset: str, checkpoint: str,
                  source_name: str = "market", rebuild_silver: bool = False,
                  rebuild_gold: bool = False,
                  batch_prefix: str = "stream-", available_now: bool = True,
                  on_batch: Callable[[int, dict], None] | None = None,
                  glob: str | None = None, query: str | None = None) -> StreamingQuery:
    """``query`` names the stream in the ledger (default: its dataset and checkpoint)."""
    spark = house.store.spark
    ledger = BatchLedger(house.store, query or f"{dataset}:{checkpoint}")

    def handle(batch: DataFrame, epoch_id: int) -> None:
        batch_id = f"{batch_prefix}{epoch_id:08d}"
        counts = {"seen": 0, "inserted": 0}

        def bronze() -> None:
            counts.update(house.ingest_frame(with_lineage(batch, source_name, dataset, batch_id), dataset))

        def silver() -> None:
            if house.store.exists(house.ACTUAL_RAW) and house.store.exists(house.FORECAST_RAW):
                # by what Bronze holds of this batch, not by what this attempt inserted
                touched = house.batch_dates(dataset, batch_id)
                if not touched.isEmpty():
                    house.build_silver(run_id=batch_id, dates=touched)

        def gold() -> None:
            if house.store.exists(house.QUALITY):
                touched = house.batch_dates(dataset, batch_id)
                if not touched.isEmpty():
                    try:
                        house.build_gold(dates=touched)
                    except BlockingFailure:
                        pass  # Gold stays as it was; the failing outcome is in the quality table

        ledger.once(epoch_id, "bronze", bronze)
        if rebuild_silver:
            ledger.once(epoch_id, "silver", silver)
            if rebuild_gold:
                ledger.once(epoch_id, "gold", gold)
        if on_batch:
            on_batch(epoch_id, counts)

    writer = (landing_stream(spark, path, glob).writeStream.foreachBatch(handle)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def interval_aggregate(stream: DataFrame, time_col: str, keys: Sequence[str], value_col: str,
                       window: str = "1 hour", watermark: str = "2 hours",
                       dedup_cols: Sequence[str] | None = None) -> DataFrame:
    """Per tumbling window and key: rows, sum, max of ``value_col`` (append mode).

    Event time may be a UTC-wall ``timestamp_ntz``; it is turned into an instant for the
    watermark and the window bounds come back as ``timestamp_ntz``.
    """
    if isinstance(stream.schema[time_col].dataType, TimestampNTZType):
        stream = stream.withColumn(time_col, ntz_to_instant(time_col))
    s = stream.withWatermark(time_col, watermark)
    if dedup_cols:
        s = s.dropDuplicatesWithinWatermark(list(dedup_cols))
    return (s.groupBy(F.window(time_col, window).alias("window"), *keys)
            .agg(F.count(F.lit(1)).alias("rows"), F.sum(value_col).alias("total"),
                 F.max(value_col).alias("peak"))
            .select(instant_to_ntz("window.start").alias("window_start"),
                    instant_to_ntz("window.end").alias("window_end"),
                    *keys, "rows", "total", "peak"))
