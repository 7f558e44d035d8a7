"""Fixed values of the electricity-market instance and its payload schemas.

The operators never hard-code these; they are passed in.  This module only binds the
instance the pipeline was built for.
"""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

# --- fixed values (must equal the source system's for identical results) -------------
MARKET_TIMEZONE = "America/New_York"
EXPECTED_REGIONS = ("CENTRAL", "NORTH", "SOUTH")
EXPECTED_ZONES = ("Z1", "Z2", "Z3", "Z4", "Z5", "Z6", "Z7", "Z8", "Z9", "Z10")
LAYERS = ("bronze", "silver", "gold", "ops")

ACTUAL_DATASET = "actual_load"
FORECAST_DATASET = "load_forecast"

INVALID_TIMESTAMP = "INVALID_TIMESTAMP"
MISSING_MEASUREMENT = "MISSING_MEASUREMENT"
NEGATIVE_LOAD = "NEGATIVE_LOAD"
NEGATIVE_FORECAST = "NEGATIVE_FORECAST"
UNEXPECTED_REGION = "UNEXPECTED_REGION"
UNEXPECTED_ZONE = "UNEXPECTED_ZONE"
DUPLICATE_BUSINESS_KEY = "DUPLICATE_BUSINESS_KEY"
INCOMPLETE_MARKET_DATE = "INCOMPLETE_MARKET_DATE"
NON_FINITE = "NON_FINITE_MEASUREMENT"

# day parts of the local hour: 6-11 Morning, 12-17 Afternoon, 18-21 Evening, else Night
DAY_PARTS = (("Morning", 6, 11), ("Afternoon", 12, 17), ("Evening", 18, 21))
NIGHT = "Night"
# ---------------------------------------------------------------------------------------

ACTUAL_KEYS = ("interval_start_utc", "region")
FORECAST_KEYS = ("forecast_init_date", "interval_start_utc", "local_resource_zone")
QUARANTINE_KEYS = ("dataset_name", "batch_id", "raw_file_name", "interval_start_utc", "region",
                   "local_resource_zone", "quarantine_reason")
QUALITY_KEYS = ("run_id", "dataset_name", "rule_name")


def _interval_struct() -> StructType:
    return StructType([StructField(n, StringType()) for n in ("resolution", "start", "end", "value")])


def actual_payload_schema() -> StructType:
    record = StructType([
        StructField("timeInterval", _interval_struct()),
        StructField("region", StringType()),
        StructField("load", DoubleType()),
    ])
    return StructType([StructField("data", ArrayType(record))])


def forecast_payload_schema() -> StructType:
    record = StructType([
        StructField("timeInterval", _interval_struct()),
        StructField("region", StringType()),
        StructField("localResourceZone", StringType()),
        StructField("loadForecast", DoubleType()),
        StructField("init", StringType()),
    ])
    return StructType([StructField("data", ArrayType(record))])


def table_name(layer: str, name: str) -> str:
    """``layer.table``; the built-in catalog takes a single-part namespace."""
    if layer not in LAYERS:
        raise ValueError(f"unsupported layer: {layer}")
    return f"{layer}.{name}"
