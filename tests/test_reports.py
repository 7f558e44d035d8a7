import datetime as dt

from pyspark.sql import functions as F

from lakemeter.plans import reports


def test_weather_vs_demand_and_prices_and_freshness(spark):
    t0 = dt.datetime(2024, 1, 1, 5)
    fact = spark.createDataFrame([(t0, 100.0), (t0, 300.0), (t0 + dt.timedelta(hours=1), 50.0)],
                                 "interval_start_utc timestamp_ntz, actual_load_mw double")
    weather = spark.createDataFrame([(t0, -3.0, 80.0), (t0, -1.0, 60.0)],
                                    "interval_start_utc timestamp_ntz, temperature_2m_c double, relative_humidity_percent double")
    r = reports.weather_vs_demand(fact, weather).collect()
    assert len(r) == 1 and r[0].demand_mw == 200.0 and r[0].temperature_c == -2.0
    prices = spark.range(0, 12).select((F.lit(t0) + F.make_interval(mins=F.col("id") * 5)).alias("interval_start_utc"),
                                       (F.col("id") * 10.0).alias("lmp_usd_per_mwh"))
    p = reports.price_distribution(prices).first()
    assert p.min_value == 0.0 and p.max_value == 110.0 and abs(p.p50 - 55.0) < 1e-9 and abs(p.p05 - 5.5) < 1e-9
    f = reports.freshness(fact, as_of="2024-01-01 08:59:00").first()
    assert f.latest_measurement_utc == t0 + dt.timedelta(hours=1) and f.age_hours == 2


def test_price_distribution_sketch_is_close(spark):
    t0 = dt.datetime(2024, 1, 1, 5)
    prices = spark.range(0, 5000).select((F.lit(t0) + F.make_interval(secs=F.col("id") % 3600)).alias("interval_start_utc"),
                                         (F.col("id") % 1000 * 1.0).alias("lmp_usd_per_mwh"))
    exact = reports.price_distribution(prices).first()
    approx = reports.price_distribution(prices, approx=True).first()
    assert abs(exact.p50 - approx.p50) <= 2.0 and exact.max_value == approx.max_value


def test_reports_of_selected_regions(spark):
    t0, day = dt.datetime(2024, 1, 1, 5), dt.date(2024, 1, 1)
    fact = spark.createDataFrame(
        [(t0, day, 0, r, 100.0 * i, 90.0, -10.0, 10.0) for i, r in enumerate("ABC", 1)],
        "interval_start_utc timestamp_ntz, market_date date, hour int, region string, actual_load_mw double, "
        "forecast_load_mw double, forecast_error_mw double, absolute_percentage_error double")
    daily = spark.createDataFrame(
        [(day, r, 1.0 * i, t0, 5.0 * i, 1.0, 6.0) for i, r in enumerate("ABC", 1)],
        "market_date date, region string, peak_demand_mw double, peak_interval_utc timestamp_ntz, "
        "mae_mw double, mape_percent double, rmse_mw double")
    for report, source in ((reports.actual_vs_forecast, fact), (reports.error_trend, fact),
                           (reports.hour_profile, fact), (reports.daily_peak, daily), (reports.scorecard, daily)):
        assert {r.region for r in report(source, regions=["A", "C"]).collect()} == {"A", "C"}
        assert {r.region for r in report(source).collect()} == {"A", "B", "C"}
        assert not report(source, "2024-01-02", "2024-01-03", regions=["A"]).collect()
    assert {r.region: r.performance_rank for r in reports.scorecard(daily, regions=["A", "B"]).collect()} == {"A": 2, "B": 1}
    weather = spark.createDataFrame([(t0, -3.0, 80.0)], "interval_start_utc timestamp_ntz, temperature_2m_c double, "
                                                        "relative_humidity_percent double")
    assert reports.weather_vs_demand(fact, weather, regions=["A", "C"]).first().demand_mw == 200.0
    assert reports.freshness(fact, as_of="2024-01-01 08:59:00", regions=["X"]).first().latest_measurement_utc is None


def test_ensure_layers(spark, scratch):
    import os

    from lakemeter.plans.tables import TableStore
    TableStore(spark, scratch).ensure_layers()
    assert sorted(os.listdir(scratch)) == ["bronze", "gold", "ops", "silver"]
