import datetime as dt

from lakemeter.operators import dims, facts

TZ = "America/New_York"


def test_compare_errors_peak_and_accuracy(spark):
    d = dt.date(2024, 1, 1)
    t = [dt.datetime(2024, 1, 1, 5 + h) for h in range(3)]
    actual = spark.createDataFrame([(d, t[0], "A", 100.0), (d, t[1], "A", 150.0), (d, t[2], "A", 150.0),
                                    (d, t[0], "B", 0.0)],
                                   "market_date date, interval_start_utc timestamp_ntz, region string, actual_load_mw double")
    fc = spark.createDataFrame([(d, dt.date(2023, 12, 31), t[0], "A", "Z1", 60.0), (d, dt.date(2023, 12, 31), t[0], "A", "Z2", 50.0),
                                (d, dt.date(2023, 12, 31), t[1], "A", "Z1", 140.0), (d, dt.date(2023, 12, 31), t[2], "A", "Z1", 150.0),
                                (d, dt.date(2023, 12, 31), t[0], "B", "Z9", 5.0), (d, dt.date(2023, 12, 31), t[0], "C", "Z8", 5.0)],
                               "market_date date, forecast_init_date date, interval_start_utc timestamp_ntz, region string, "
                               "local_resource_zone string, load_forecast_mw double")
    fact = facts.compare(actual, fc, TZ, as_of="2024-02-01 00:00:00")
    rows = {(r.region, r.interval_start_utc): r for r in fact.collect()}
    assert len(rows) == 4  # region C has no actual: dropped
    a0 = rows[("A", t[0])]
    assert a0.forecast_load_mw == 110.0 and a0.forecast_error_mw == 10.0
    assert abs(a0.absolute_percentage_error - 10.0) < 1e-12 and a0.hour == 0 and a0.date_key == 20240101
    assert rows[("B", t[0])].absolute_percentage_error is None  # actual 0 -> no percentage
    peak = {r.region: r for r in facts.daily_peak(fact).collect()}
    assert peak["A"].peak_demand_mw == 150.0 and peak["A"].peak_interval_utc == t[1]  # tie -> earliest
    acc = {r.region: r for r in facts.accuracy(fact).collect()}
    assert acc["A"].hour_count == 3 and abs(acc["A"].mae_mw - (10 + 10 + 0) / 3) < 1e-9
    assert abs(acc["A"].rmse_mw - ((100 + 100) / 3) ** 0.5) < 1e-9
    stats_peak, stats_perf = facts.split_daily_stats(facts.daily_stats(fact))
    assert {r.region: r.peak_interval_utc for r in stats_peak.collect()}["A"] == t[1]
    assert stats_perf.count() == 2


def test_dimensions(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 6),), (dt.date(2024, 1, 8),), (dt.date(2024, 1, 8),)], "market_date date")
    rows = {r.date_key: r for r in dims.dim_date(df).collect()}
    assert set(rows) == {20240106, 20240108}
    sat, mon = rows[20240106], rows[20240108]
    assert sat.is_weekend and sat.day_name == "Saturday" and sat.day_of_week == 7
    assert not mon.is_weekend and mon.week_of_year == 2 and mon.month_name == "January" and mon.quarter == 1
    t = {r.hour: r for r in dims.dim_time(spark).collect()}
    assert len(t) == 24 and t[5].day_part == "Night" and t[6].day_part == "Morning" and t[12].day_part == "Afternoon"
    assert t[21].day_part == "Evening" and t[22].day_part == "Night" and t[7].hour_label == "07:00"
    ent = dims.dim_entity(spark.createDataFrame([("A",), ("A",), (None,)], "region string")).collect()
    assert len(ent) == 1 and ent[0].region_key is not None
