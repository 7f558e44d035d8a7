import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakemeter.operators import quality
from lakemeter.operators.stats import exact_percentiles


def test_evaluate_and_gate(spark):
    a = spark.range(5)
    empty = spark.range(0)
    q = spark.range(3)
    ok = quality.evaluate(a, a, empty, "r1", "2024-01-01 00:00:00")
    rows = {r.dataset_name: r for r in ok.collect()}
    assert rows["historical_load"].status == "PASS" and rows["actual_load_hourly"].failed_row_count == 0
    assert quality.gate(ok) == 3
    bad = quality.evaluate(a, empty, q, "r2", "2024-01-02 00:00:00")
    both = ok.unionByName(bad)
    latest = quality.latest_run(both).collect()
    assert {r.run_id for r in latest} == {"r2"}
    assert {r.status for r in latest} == {"PASS", "FAIL", "WARN"}
    with pytest.raises(quality.BlockingFailure):
        quality.gate(both)
    with pytest.raises(quality.BlockingFailure):
        quality.gate(both.where("false"))  # no run at all
    # an older failing run does not block once a newer run passes
    newer = quality.evaluate(a, a, empty, "r3", "2024-01-03 00:00:00")
    assert quality.gate(both.unionByName(newer)) == 3


def test_evaluate_runs_fills_missing_datasets(spark):
    a = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 2),)], "d date")
    f = spark.createDataFrame([(dt.date(2024, 1, 1),)], "d date")
    q = spark.createDataFrame([(dt.date(2024, 1, 2),)], "d date")
    out = quality.evaluate_runs(a, f, q, "d", F.col("d").cast("timestamp_ntz")).collect()
    assert len(out) == 6
    day2 = {r.dataset_name: r.status for r in out if r.run_id == "2024-01-02"}
    assert day2 == {"actual_load_hourly": "PASS", "load_forecast_hourly": "FAIL", "historical_load": "WARN"}


def test_exact_percentiles_match_builtin(spark):
    df = spark.range(0, 2000).select((F.col("id") % 7).alias("g"), ((F.col("id") * 37) % 101 / 4.0).alias("v"))
    probs = [0.0, 0.05, 0.5, 0.95, 1.0]
    ours = {r.g: r for r in exact_percentiles(df, ["g"], "v", probs).collect()}
    ref = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("p")).collect()}
    for g, expected in ref.items():
        got = [ours[g][n] for n in ("p00", "p05", "p50", "p95", "p100")]
        assert all(abs(x - y) < 1e-9 for x, y in zip(got, expected))


def test_error_observations(spark):
    fact = spark.range(0, 1000).select(F.lit("A").alias("region"), (F.col("id") / 10.0).alias("absolute_error_mw"))
    th = quality.error_thresholds(fact, quantile=0.99)
    flagged = quality.observations(fact, th).count()
    assert 5 <= flagged <= 15


def test_exact_percentiles_on_a_hot_group_and_null_group(spark):
    hot = spark.range(0, 30000).select(F.lit(1).alias("g"), ((F.col("id") * 7919) % 10007 / 3.0).alias("v"))
    cold = spark.range(0, 300).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 3 + 1).alias("g"),
                                      (F.col("id") / 7.0).alias("v"))
    df = hot.unionByName(cold)
    probs = [0.05, 0.5, 0.95]
    ours = {r.g: r for r in exact_percentiles(df, ["g"], "v", probs, slices=16).collect()}
    ref = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("p")).collect()}
    assert set(ours) == set(ref)
    for gkey, expected in ref.items():
        got = [ours[gkey][n] for n in ("p05", "p50", "p95")]
        assert all(abs(x - y) < 1e-9 for x, y in zip(got, expected)), (gkey, got, expected)


def test_exact_percentiles_do_not_need_exchange_reuse(spark):
    from pyspark.sql import functions as F

    from lakemeter.operators.stats import exact_percentiles
    df = spark.range(200_000).select((F.col("id") % 3).alias("g"), F.rand(7).alias("v"))
    df = df.withColumn("v", F.round("v", 9))
    want = {r["g"]: r["m"] for r in df.groupBy("g").agg(F.percentile("v", F.lit(0.5)).alias("m")).collect()}
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = {r["g"]: r["p50"] for r in exact_percentiles(df, ["g"], "v", [0.5], slices=7).collect()}
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
    assert got.keys() == want.keys() and all(abs(got[g] - want[g]) < 1e-9 for g in want)
