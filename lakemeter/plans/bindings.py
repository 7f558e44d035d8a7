"""The driver's tables seen through the lakehouse's data model.

``events`` stands in for landed interval measurements: the event type is the region, the
event time (read as market-local time) is binned into intervals, the value is the load,
and the event id is the arrival order.  The same events, moved one day ahead and keyed by
a user zone ``Z1``..``Z10``, are the published forecasts for the next day.  ``lineitem``
exercises latest-wins on a repeated business key, ``orders`` the keyed writes and
``documents`` the payload checksums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemeter.functions.text import normalise_label
from lakemeter.functions.timeutil import floor_hours, local_to_utc, utc_now
from lakemeter.plans.lakehouse import MarketDomain

# fixed values of this binding
EVENT_REGIONS = ("CLICK", "PURCHASE", "VIEW")
EVENT_ZONES = ("Z1", "Z2", "Z3", "Z4", "Z5", "Z6", "Z7", "Z8", "Z9", "Z10")
BIN_HOURS = 3
AS_OF = "2024-02-15 00:00:00"
EVENTS_DOMAIN = MarketDomain(tz="America/New_York", regions=EVENT_REGIONS, zones=EVENT_ZONES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_between(events: DataFrame, start: str | None, end: str | None, days_later: int = 0) -> DataFrame:
    """Events whose market date, ``days_later`` after the event, lies in the range: a filter on the event
    time itself, so it reaches the scan (and prunes where events are partitioned or sorted by time)."""
    shift = F.make_dt_interval(F.lit(days_later))
    if start is not None:
        events = events.where(F.col("ts") >= F.lit(start).cast("timestamp_ntz") - shift)
    if end is not None:
        events = events.where(F.col("ts") < F.lit(end).cast("timestamp_ntz") + F.make_dt_interval(F.lit(1)) - shift)
    return events


def _lineage(events: DataFrame):
    return [F.concat(F.lit("events-"), F.date_format(F.col("ts").cast("date"), "yyyyMMdd")).alias("batch_id"),
            F.lit("events").alias("raw_file_name"),
            F.col("ts").alias("ingestion_timestamp_utc"),
            F.col("event_id").alias("record_index")]


def events_actual(events: DataFrame, tz: str = EVENTS_DOMAIN.tz, bin_hours: int = BIN_HOURS,
                  as_of=AS_OF) -> DataFrame:
    """Parsed-actual shape: one measurement per event, interval = ``bin_hours`` local bin."""
    local = floor_hours("ts", bin_hours)
    return events.select(
        local.cast("date").alias("market_date"),
        local_to_utc(local, tz).alias("interval_start_utc"),
        local_to_utc(F.timestamp_add("HOUR", F.lit(bin_hours), local), tz).alias("interval_end_utc"),
        (F.hour(local) / bin_hours + 1).cast("smallint").alias("hour_ending"),
        normalise_label("event_type").alias("region"),
        F.col("value").alias("actual_load_mw"),
        *_lineage(events),
        utc_now(as_of).alias("processed_timestamp_utc"),
    )


def events_forecast(events: DataFrame, tz: str = EVENTS_DOMAIN.tz, bin_hours: int = BIN_HOURS,
                    as_of=AS_OF) -> DataFrame:
    """Parsed-forecast shape: each event forecasts the same bin of the next day for its zone."""
    local = F.timestamp_add("DAY", F.lit(1), floor_hours("ts", bin_hours))
    return events.select(
        local.cast("date").alias("market_date"),
        F.col("ts").cast("date").alias("forecast_init_date"),
        local_to_utc(local, tz).alias("interval_start_utc"),
        local_to_utc(F.timestamp_add("HOUR", F.lit(bin_hours), local), tz).alias("interval_end_utc"),
        (F.hour(local) / bin_hours + 1).cast("smallint").alias("hour_ending"),
        normalise_label("event_type").alias("region"),
        F.concat(F.lit("Z"), (F.col("user_id") % 10 + 1).cast("string")).alias("local_resource_zone"),
        F.col("value").alias("load_forecast_mw"),
        *_lineage(events),
        utc_now(as_of).alias("processed_timestamp_utc"),
    )
