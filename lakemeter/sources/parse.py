"""Payload parsing under explicit schemas.

``from_json`` runs in permissive mode: a malformed payload gives one all-NULL record (it is
then rejected by the rules), a wrong-typed field alone becomes NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemeter.domain import actual_payload_schema, forecast_payload_schema
from lakemeter.functions.text import clean_number, normalise_label
from lakemeter.functions.timeutil import local_to_utc, parse_local_timestamp, utc_now

LINEAGE = ("batch_id", "raw_file_name", "ingestion_timestamp_utc")


def explode_records(bronze: DataFrame, schema: StructType, array_field: str = "data",
                    payload_col: str = "raw_payload", keep: Sequence[str] = LINEAGE) -> DataFrame:
    """One row per array element (``r``) with its position; a missing array keeps one NULL row."""
    parsed = F.from_json(F.col(payload_col), schema)
    return bronze.select(*keep, F.posexplode_outer(parsed[array_field]).alias("record_index", "r"))


def record_dates(bronze: DataFrame, schema: StructType, keep: Sequence[str] = ("record_checksum",),
                 unique: bool = False) -> DataFrame:
    """Distinct (file, market date) pairs of a payload table, the file by the columns of ``keep``; a file
    whose records have no parsable start contributes a NULL date.  ``unique``: no two rows are equal in
    ``keep``, so the dates are made distinct inside each row, without a shuffle."""
    if unique:
        starts = F.from_json(F.col("raw_payload"), schema)["data"]["timeInterval"]["start"]
        dates = F.array_distinct(F.transform(starts, lambda x: parse_local_timestamp(x).cast("date")))
        return bronze.select(*keep, F.explode_outer(dates).alias("market_date"))
    return (explode_records(bronze, schema, keep=keep)
            .select(*keep, parse_local_timestamp("r.timeInterval.start").cast("date").alias("market_date"))
            .distinct())


def _interval_columns(tz: str) -> dict[str, Column]:
    start = parse_local_timestamp("r.timeInterval.start")
    end = parse_local_timestamp("r.timeInterval.end")
    return {
        "market_date": start.cast("date"),
        "interval_start_utc": local_to_utc(start, tz),
        "interval_end_utc": local_to_utc(end, tz),
        "hour_ending": F.col("r.timeInterval.value").try_cast("smallint"),
    }


def parse_actual(bronze: DataFrame, tz: str, as_of=None) -> DataFrame:
    """Silver actual-load columns (+ ``record_index`` for a deterministic latest-wins order)."""
    cols = _interval_columns(tz)
    return explode_records(bronze, actual_payload_schema()).select(
        cols["market_date"].alias("market_date"),
        cols["interval_start_utc"].alias("interval_start_utc"),
        cols["interval_end_utc"].alias("interval_end_utc"),
        cols["hour_ending"].alias("hour_ending"),
        normalise_label("r.region").alias("region"),
        F.col("r.load").alias("actual_load_mw"),
        *LINEAGE, "record_index",
        utc_now(as_of).alias("processed_timestamp_utc"),
    )


def parse_forecast(bronze: DataFrame, tz: str, as_of=None) -> DataFrame:
    cols = _interval_columns(tz)
    return explode_records(bronze, forecast_payload_schema()).select(
        cols["market_date"].alias("market_date"),
        F.col("r.init").try_cast("date").alias("forecast_init_date"),
        cols["interval_start_utc"].alias("interval_start_utc"),
        cols["interval_end_utc"].alias("interval_end_utc"),
        cols["hour_ending"].alias("hour_ending"),
        normalise_label("r.region").alias("region"),
        normalise_label("r.localResourceZone").alias("local_resource_zone"),
        F.col("r.loadForecast").alias("load_forecast_mw"),
        *LINEAGE, "record_index",
        utc_now(as_of).alias("processed_timestamp_utc"),
    )


def parse_parallel_arrays(df: DataFrame, struct_col: str, time_field: str,
                          value_fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Parallel arrays (``hourly.time`` + one array per variable) -> one row per position.

    ``arrays_length_ok`` is false when the arrays of a row differ in length; positions
    beyond a shorter array come out NULL rather than being dropped.
    """
    base = F.col(struct_col)
    fields = [time_field, *value_fields]
    sizes = [F.size(base[f]) for f in fields]
    same = F.lit(True)
    for s in sizes[1:]:
        same = same & (s == sizes[0])
    zipped = F.arrays_zip(*[base[f].alias(f) for f in fields])
    return df.select(*keep, same.alias("arrays_length_ok"),
                     F.posexplode_outer(zipped).alias("position", "_z")) \
             .select(*keep, "arrays_length_ok", "position", *[F.col(f"_z.{f}").alias(f) for f in fields])


def parse_fuel_mix(df: DataFrame, payload_col: str = "raw_payload", tz_offset: str = "-05:00",
                   keep: Sequence[str] = ()) -> DataFrame:
    """Fuel-mix payload -> one row per fuel with MW as a number and its share of the total.

    The source labels its clock "EST" all year, i.e. a fixed offset, not New York civil time.
    """
    schema = ("RefId string, TotalMW string, "
              "Fuel struct<Type: array<struct<INTERVALEST: string, CATEGORY: string, ACT: string>>>")
    p = F.from_json(F.col(payload_col), schema)
    rows = df.select(*keep, p["TotalMW"].alias("_total"), F.explode_outer(p["Fuel"]["Type"]).alias("_f"))
    mw = clean_number("_f.ACT")
    total = clean_number("_total")
    return rows.select(
        *keep,
        _fixed_offset_to_utc(F.col("_f.INTERVALEST"), "yyyy-MM-dd h:mm:ss a", tz_offset).alias("interval_start_utc"),
        F.col("_f.CATEGORY").alias("fuel_category"),
        mw.alias("generation_mw"),
        total.alias("total_mw"),
        F.when(total > 0, mw / total * 100).alias("share_percent"),
    )


def _fixed_offset_to_utc(text: Column, pattern: str, offset: str) -> Column:
    """Local text with a fixed UTC offset -> UTC ``timestamp_ntz``."""
    ts = F.try_to_timestamp(F.concat(text, F.lit(" " + offset)), F.lit(pattern + " XXX"))
    return F.convert_timezone(None, F.lit("UTC"), ts)


def parse_snapshot(df: DataFrame, payload_col: str = "raw_payload", tz_offset: str = "-05:00",
                   keep: Sequence[str] = ()) -> DataFrame:
    """Operations snapshot ``[{t, v, d, id}]`` -> metric rows with numeric values.

    Displayed numbers lose ``$`` and thousands separators; the trailing zone label is
    dropped and the fixed offset applied instead.
    """
    p = F.from_json(F.col(payload_col), "array<struct<t: string, v: string, d: string, id: string>>")
    rows = df.select(*keep, F.explode_outer(p).alias("_m"))
    stamp = F.regexp_replace(F.col("_m.d"), r"\s+[A-Za-z]{2,4}$", "")
    return rows.select(
        *keep,
        F.col("_m.id").alias("metric_id"),
        F.col("_m.t").alias("metric_name"),
        clean_number("_m.v").alias("metric_value"),
        F.col("_m.v").alias("raw_value"),
        _fixed_offset_to_utc(stamp, "M/d/yyyy h:mm:ss a", tz_offset).alias("observed_at_utc"),
    )
