"""Parameterised report queries over the Gold, Silver and ops tables.

Date ranges are inclusive at both ends and become pushed-down (and, on partitioned
tables, partition-pruning) filters.  Sorting happens last, on the reduced result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemeter.functions.timeutil import floor_hours, hours_between, utc_now
from lakemeter.operators.quality import latest_run
from lakemeter.operators.stats import exact_percentiles


def _in_range(df: DataFrame, start, end, date_col: str = "market_date") -> DataFrame:
    if start is None and end is None:
        return df
    c = F.col(date_col)
    lo = F.lit(start).cast("date") if start is not None else None
    hi = F.lit(end).cast("date") if end is not None else None
    cond = c.between(lo, hi) if lo is not None and hi is not None else (c >= lo if lo is not None else c <= hi)
    return df.where(cond)


def _regions(df: DataFrame, regions: Sequence[str] | None) -> DataFrame:
    return df.where(F.col("region").isin(list(regions))) if regions else df


def _selected(df: DataFrame, start, end, regions: Sequence[str] | None) -> DataFrame:
    return _regions(_in_range(df, start, end), regions)


def actual_vs_forecast(fact: DataFrame, start=None, end=None,
                       regions: Sequence[str] | None = None) -> DataFrame:
    return (_selected(fact, start, end, regions)
            .select("interval_start_utc", "region", "actual_load_mw", "forecast_load_mw")
            .orderBy("interval_start_utc", "region"))


def error_trend(fact: DataFrame, start=None, end=None,
                regions: Sequence[str] | None = None) -> DataFrame:
    return (_selected(fact, start, end, regions)
            .select("interval_start_utc", "region", "forecast_error_mw", "absolute_percentage_error")
            .orderBy("interval_start_utc", "region"))


def daily_peak(peak: DataFrame, start=None, end=None,
               regions: Sequence[str] | None = None) -> DataFrame:
    return (_selected(peak, start, end, regions)
            .select("market_date", "region", "peak_demand_mw", "peak_interval_utc")
            .orderBy("market_date", "region"))


def scorecard(performance: DataFrame, start=None, end=None, rank: bool = True,
              regions: Sequence[str] | None = None) -> DataFrame:
    """Unweighted average of the daily measures per region (RMSE = mean of daily RMSEs).

    The rank window runs after aggregation, over one row per region; it ranks the selected regions."""
    out = _selected(performance, start, end, regions).groupBy("region").agg(
        F.avg("mae_mw").alias("mean_absolute_error_mw"),
        F.avg("mape_percent").alias("mean_absolute_percentage_error"),
        F.avg("rmse_mw").alias("root_mean_squared_error_mw"),
    )
    if rank:
        out = out.withColumn("performance_rank",
                             F.rank().over(Window.orderBy(F.col("mean_absolute_error_mw").desc())))
    return out.orderBy(F.col("mean_absolute_error_mw").desc())


def hour_profile(fact: DataFrame, start=None, end=None,
                 regions: Sequence[str] | None = None) -> DataFrame:
    return (_selected(fact, start, end, regions).groupBy(F.col("hour").alias("market_hour"), "region")
            .agg(F.avg("actual_load_mw").alias("average_load_mw"),
                 F.max("actual_load_mw").alias("maximum_load_mw"))
            .orderBy("market_hour", "region"))


def quality_status(results: DataFrame) -> DataFrame:
    return (latest_run(results)
            .select("evaluated_at_utc", "dataset_name", "rule_name", "failed_row_count", "status",
                    "is_blocking")
            .orderBy(F.col("is_blocking").desc(), F.col("status").desc(), "dataset_name", "rule_name"))


def freshness(silver_actual: DataFrame, as_of=None, time_col: str = "interval_start_utc",
              regions: Sequence[str] | None = None) -> DataFrame:
    """Newest accepted measurement and its age in whole hours."""
    return _regions(silver_actual, regions).agg(F.max(time_col).alias("latest_measurement_utc")).select(
        "latest_measurement_utc",
        hours_between(F.col("latest_measurement_utc"), utc_now(as_of)).alias("age_hours"))


def weather_vs_demand(fact: DataFrame, weather: DataFrame, time_col: str = "interval_start_utc",
                      start=None, end=None, regions: Sequence[str] | None = None) -> DataFrame:
    """Hourly demand next to hourly weather, joined on the interval start; range and regions select facts.

    Averages run over all pairs of a fact and a weather row of one interval.  Both sides are summed up per
    interval first and weighted by each other's row counts, so the join is one to one however many regions or
    locations share an interval."""
    def sums(df: DataFrame, columns: Sequence[str], rows: str) -> DataFrame:
        return df.groupBy(time_col).agg(F.count(F.lit(1)).alias(rows), *[f(c).alias(f"{k}_{c}") for c in columns
                                                                        for k, f in (("sum", F.sum), ("n", F.count))])

    demand = sums(_selected(fact, start, end, regions), ["actual_load_mw"], "_facts")
    air = sums(weather, ["temperature_2m_c", "relative_humidity_percent"], "_reports")
    mean = lambda c, other: F.try_divide(F.sum(F.col(f"sum_{c}") * F.col(other)), F.sum(F.col(f"n_{c}") * F.col(other)))
    return (demand.join(air, time_col, "inner").groupBy(floor_hours(time_col, 1).alias("interval_hour"))
            .agg(mean("actual_load_mw", "_reports").alias("demand_mw"),
                 mean("temperature_2m_c", "_facts").alias("temperature_c"),
                 mean("relative_humidity_percent", "_facts").alias("relative_humidity_percent")))


def price_distribution(prices: DataFrame, time_col: str = "interval_start_utc",
                       value_col: str = "lmp_usd_per_mwh",
                       probs: Sequence[float] = (0.05, 0.5, 0.95),
                       approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """Hourly percentiles (exact and interpolated, or a mergeable sketch), minimum and maximum."""
    hourly = prices.select(floor_hours(time_col, 1).alias("interval_hour"), F.col(value_col))
    names = [f"p{int(round(p * 100)):02d}" for p in probs]
    if approx:
        sketch = F.percentile_approx(value_col, list(probs), accuracy)
        pct = hourly.groupBy("interval_hour").agg(sketch.alias("_p")).select(
            "interval_hour", *[F.col("_p")[i].alias(n) for i, n in enumerate(names)])
    else:
        pct = exact_percentiles(hourly, ["interval_hour"], value_col, probs, names)
    span = hourly.groupBy("interval_hour").agg(F.min(value_col).alias("min_value"),
                                               F.max(value_col).alias("max_value"))
    return span.join(pct, "interval_hour", "left")


def kpis(fact: DataFrame, peak: DataFrame, performance: DataFrame, quarantine: DataFrame,
         start=None, end=None, regions: Sequence[str] | None = None) -> DataFrame:
    """KPI row: latest measurement, peak demand, mean regional MAE and quarantined rows,
    for one date range and region selection.

    Each measure is a one-row aggregate of its own table; the four partial rows are stacked
    and folded by one more aggregate, so no join (let alone a cross join) is involved.
    """
    blank = {"latest_measurement_utc": F.lit(None).cast("timestamp_ntz"),
             "peak_demand_mw": F.lit(None).cast("double"),
             "mean_mae_mw": F.lit(None).cast("double"),
             "quarantined_rows": F.lit(None).cast("bigint")}

    def part(df: DataFrame, name: str, measure) -> DataFrame:
        one = _selected(df, start, end, regions).agg(measure.alias(name))
        return one.select(*[F.col(name) if k == name else v.alias(k) for k, v in blank.items()])

    stacked = (part(fact, "latest_measurement_utc", F.max("interval_start_utc"))
               .unionByName(part(peak, "peak_demand_mw", F.max("peak_demand_mw")))
               .unionByName(part(performance, "mean_mae_mw", F.avg("mae_mw")))
               .unionByName(part(quarantine, "quarantined_rows", F.count(F.lit(1)))))
    return stacked.agg(*[F.max(k).alias(k) for k in blank])
