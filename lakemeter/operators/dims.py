"""Date, entity and time-of-day dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemeter.domain import DAY_PARTS, NIGHT
from lakemeter.functions.hashing import surrogate_key
from lakemeter.functions.timeutil import date_key


def dim_date(df: DataFrame, date_col: str = "market_date") -> DataFrame:
    """One row per distinct date; weekend = Sunday or Saturday, ISO week number."""
    d = F.col(date_col)
    return df.select(d.alias(date_col)).where(d.isNotNull()).distinct().select(
        date_key(date_col).alias("date_key"),
        d.alias("market_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


def dim_entity(df: DataFrame, col: str = "region", key_col: str = "region_key") -> DataFrame:
    return (df.select(col).where(F.col(col).isNotNull()).distinct()
            .select(surrogate_key(col).alias(key_col), F.col(col)))


def day_part(hour_col) -> F.Column:
    h = F.col(hour_col) if isinstance(hour_col, str) else hour_col
    expr = None
    for name, lo, hi in DAY_PARTS:
        expr = F.when(h.between(lo, hi), name) if expr is None else expr.when(h.between(lo, hi), name)
    return expr.otherwise(NIGHT)


def dim_time(source: DataFrame | SparkSession, hour_col: str = "hour") -> DataFrame:
    """Hour-of-day dimension: from a frame's distinct hours, or all 24 hours from a session."""
    if isinstance(source, SparkSession):
        hours = source.range(24).select(F.col("id").alias(hour_col))
    else:
        hours = source.select(hour_col).where(F.col(hour_col).isNotNull()).distinct()
    return hours.select(
        F.col(hour_col).cast("smallint").alias("hour"),
        F.format_string("%02d:00", F.col(hour_col).cast("int")).alias("hour_label"),
        day_part(F.col(hour_col)).alias("day_part"),
    )
