"""End-to-end runs over synthetic landing files (cases of the fixture plan)."""

import os

import pytest
from pyspark.sql import functions as F

from lakemeter import domain as D
from lakemeter.operators.quality import BlockingFailure
from lakemeter.plans import reports
from lakemeter.plans.lakehouse import Lakehouse, MarketDomain, QualityOptions, RuleOptions
from tests import payloads as P

DAY = "2023-09-01T00:00:00"


def _land(scratch, sub, name, records=None, raw=None):
    return P.write(os.path.join(scratch, sub), name, records, raw)


def _house(spark, scratch):
    return Lakehouse.at(spark, os.path.join(scratch, "lake"), MarketDomain(regions=D.EXPECTED_REGIONS))


def _reasons(v):
    return {(r.dataset_name, r.quarantine_reason): r["count"]
            for r in v.quarantine.groupBy("dataset_name", "quarantine_reason").count().collect()}


def test_complete_day_then_gold(spark, scratch):
    _land(scratch, "a1", "actual_load_page_0001.json", P.actual_records(DAY))
    _land(scratch, "f1", "load_forecast_page_0001.json", P.forecast_records(DAY))
    house = _house(spark, scratch)
    assert house.ingest(os.path.join(scratch, "a1"), D.ACTUAL_DATASET, "b1") == {"seen": 1, "inserted": 1}
    house.ingest(os.path.join(scratch, "f1"), D.FORECAST_DATASET, "b1")
    v = house.build_silver("run1", as_of="2024-01-01 00:00:00")
    assert v.valid_actual.count() == 72 and v.valid_forecast.count() == 240 and v.quarantine.count() == 0
    assert house.store.read(Lakehouse.ACTUAL).count() == 72
    fact = house.build_gold(as_of="2024-01-01 00:00:00")
    assert fact.count() == 72
    peak = house.store.read(Lakehouse.PEAK)
    assert peak.count() == 3 and house.store.read(Lakehouse.DIM_TIME).count() == 24
    status = reports.quality_status(house.store.read(Lakehouse.QUALITY)).collect()
    assert {r.status for r in status} == {"PASS"}
    score = reports.scorecard(house.store.read(Lakehouse.PERFORMANCE), "2023-09-01", "2023-09-01").collect()
    assert [r.performance_rank for r in score] == [1, 2, 3]
    # re-ingesting the same file inserts nothing; rebuilding gives the same tables
    assert house.ingest(os.path.join(scratch, "a1"), D.ACTUAL_DATASET, "b2")["inserted"] == 0
    house.build_silver("run2", as_of="2024-01-01 00:00:00")
    assert house.store.read(Lakehouse.ACTUAL).count() == 72
    assert house.store.read(Lakehouse.QUALITY).count() == 6


def test_missing_record_quarantines_whole_date(spark, scratch):
    recs = P.actual_records(DAY)[:-1]
    _land(scratch, "a", "a.json", recs)
    _land(scratch, "f", "f.json", P.forecast_records(DAY))
    house = _house(spark, scratch)
    house.ingest(os.path.join(scratch, "a"), D.ACTUAL_DATASET, "b1")
    house.ingest(os.path.join(scratch, "f"), D.FORECAST_DATASET, "b1")
    v = house.build_silver("run1", as_of="2024-01-01 00:00:00")
    assert v.valid_actual.count() == 0 and v.valid_forecast.count() == 0
    assert _reasons(v) == {("actual_load", D.INCOMPLETE_MARKET_DATE): 71,
                           ("load_forecast", D.INCOMPLETE_MARKET_DATE): 240}
    with pytest.raises(BlockingFailure):
        house.build_gold()


def test_rules_duplicates_and_correction(spark, scratch):
    house = _house(spark, scratch)
    _land(scratch, "f", "f.json", P.forecast_records(DAY))
    house.ingest(os.path.join(scratch, "f"), D.FORECAST_DATASET, "b1")
    _land(scratch, "a1", "a.json", P.actual_records(DAY))
    house.ingest(os.path.join(scratch, "a1"), D.ACTUAL_DATASET, "b1", ingested_at="2024-01-01 00:00:00")
    # a newer batch repeats two keys: one with a new value, one negative
    newer = P.actual_records(DAY, hours=[0], load=lambda h, r: -5.0 if r == "North" else 999.0)
    _land(scratch, "a2", "a.json", newer[:2])
    house.ingest(os.path.join(scratch, "a2"), D.ACTUAL_DATASET, "b2", ingested_at="2024-01-02 00:00:00")
    v = house.build_silver("run1", as_of="2024-01-03 00:00:00")
    r = _reasons(v)
    # rank before rules: the newer negative row wins its key and is rejected; the older valid
    # copy is a duplicate, so the cell is lost and the date is incomplete
    assert r[("actual_load", D.NEGATIVE_LOAD)] == 1 and r[("actual_load", D.DUPLICATE_BUSINESS_KEY)] == 2
    assert r[("actual_load", D.INCOMPLETE_MARKET_DATE)] == 71
    # the other order keeps the older valid row, so the date is complete again
    v2 = house.build_silver("run2", as_of="2024-01-03 00:00:00", options=RuleOptions(rank_before_rules=False))
    assert v2.valid_actual.count() == 72
    central = v2.valid_actual.where("region = 'CENTRAL' AND hour_ending = 1").first()
    assert central.actual_load_mw == 999.0 and central.batch_id == "b2"
    assert house.store.read(Lakehouse.ACTUAL).count() == 72
    # back to the default order: the date turns incomplete and loses its Silver rows
    house.build_silver("run3", as_of="2024-01-03 00:00:00")
    assert house.store.read(Lakehouse.ACTUAL).count() == 0
    assert house.store.read(Lakehouse.FORECAST).count() == 0


def test_bad_values_and_domains(spark, scratch):
    recs = P.actual_records(DAY)
    recs[0]["load"] = None
    recs[1]["load"] = "abc"
    recs[2]["region"] = "Elsewhere"
    recs[3]["region"] = None
    recs[4]["timeInterval"]["start"] = "yesterday"
    house = _house(spark, scratch)
    _land(scratch, "a", "a.json", recs)
    _land(scratch, "f", "f.json", P.forecast_records(DAY))
    _land(scratch, "a", "broken.json", raw='{"data": [')
    house.ingest(os.path.join(scratch, "a"), D.ACTUAL_DATASET, "b1")
    house.ingest(os.path.join(scratch, "f"), D.FORECAST_DATASET, "b1")
    v = house.build_silver("run1", as_of="2024-01-01 00:00:00")
    r = _reasons(v)
    assert r[("actual_load", D.MISSING_MEASUREMENT)] == 2
    assert r[("actual_load", D.UNEXPECTED_REGION)] == 1
    assert r[("actual_load", D.INVALID_TIMESTAMP)] == 2  # bad start + malformed payload
    strict = house.build_silver("run2", as_of="2024-01-01 00:00:00", options=RuleOptions(strict_domain=True))
    assert _reasons(strict)[("actual_load", D.UNEXPECTED_REGION)] == 2


def test_per_publication_completeness(spark, scratch):
    house = _house(spark, scratch)
    _land(scratch, "a", "a.json", P.actual_records(DAY))
    _land(scratch, "f", "f1.json", P.forecast_records(DAY, init="2023-08-31"))
    _land(scratch, "f", "f2.json", P.forecast_records(DAY, init="2023-08-30", hours=range(12)))
    house.ingest(os.path.join(scratch, "a"), D.ACTUAL_DATASET, "b1")
    house.ingest(os.path.join(scratch, "f"), D.FORECAST_DATASET, "b1")
    v = house.build_silver("run1", as_of="2024-01-01 00:00:00", options=RuleOptions(per_publication=True))
    assert v.valid_actual.count() == 72
    assert {str(r.forecast_init_date) for r in v.valid_forecast.collect()} == {"2023-08-31"}
    assert v.valid_forecast.count() == 240
    assert _reasons(v) == {("load_forecast", D.INCOMPLETE_MARKET_DATE): 120}


def test_two_forecast_publications_make_date_incomplete(spark, scratch):
    house = _house(spark, scratch)
    _land(scratch, "a", "a.json", P.actual_records(DAY))
    _land(scratch, "f", "f1.json", P.forecast_records(DAY, init="2023-08-31"))
    _land(scratch, "f", "f2.json", P.forecast_records(DAY, init="2023-08-30"))
    house.ingest(os.path.join(scratch, "a"), D.ACTUAL_DATASET, "b1")
    house.ingest(os.path.join(scratch, "f"), D.FORECAST_DATASET, "b1")
    v = house.build_silver("run1", as_of="2024-01-01 00:00:00")
    prof = v.completeness.first()
    assert prof.forecast_rows == 480 and not prof.is_complete


def test_spring_clock_change_day(spark, scratch):
    """2024-03-10 local: 02:00 does not exist and maps onto 03:00's instant."""
    house = _house(spark, scratch)
    day = "2024-03-10T00:00:00"
    _land(scratch, "a", "a.json", P.actual_records(day))
    _land(scratch, "f", "f.json", P.forecast_records(day))
    house.ingest(os.path.join(scratch, "a"), D.ACTUAL_DATASET, "b1")
    house.ingest(os.path.join(scratch, "f"), D.FORECAST_DATASET, "b1")
    v = house.build_silver("run1", as_of="2024-04-01 00:00:00")
    prof = v.completeness.first()
    assert prof.actual_intervals == 23 and prof.is_complete
    assert _reasons(v)[("actual_load", D.DUPLICATE_BUSINESS_KEY)] == 3


def test_incremental_dates_restriction(spark, scratch):
    house = _house(spark, scratch)
    for day in ("2023-09-01T00:00:00", "2023-09-02T00:00:00"):
        _land(scratch, "a", f"a{day[:10]}.json", P.actual_records(day))
        _land(scratch, "f", f"f{day[:10]}.json", P.forecast_records(day))
    house.ingest(os.path.join(scratch, "a"), D.ACTUAL_DATASET, "b1")
    house.ingest(os.path.join(scratch, "f"), D.FORECAST_DATASET, "b1")
    house.build_silver("run1", as_of="2024-01-01 00:00:00")
    assert house.store.read(Lakehouse.ACTUAL).count() == 144
    only = spark.createDataFrame([("2023-09-02",)], "market_date string").select(F.col("market_date").cast("date"))
    files = [r.raw_file_name for r in house.bronze_for_dates(D.ACTUAL_DATASET, only).collect()]
    assert len(files) == 1 and files[0].endswith("a2023-09-02.json")
    v = house.build_silver("run2", as_of="2024-01-01 00:00:00", dates=only)
    assert v.valid_actual.count() == 72
    assert house.store.read(Lakehouse.ACTUAL).count() == 144


def test_optional_blocking_checks(spark, scratch):
    house = _house(spark, scratch)
    _land(scratch, "a", "a.json", P.actual_records(DAY))
    _land(scratch, "f", "f.json", P.forecast_records(DAY))
    house.ingest(os.path.join(scratch, "a"), D.ACTUAL_DATASET, "b1")
    house.ingest(os.path.join(scratch, "f"), D.FORECAST_DATASET, "b1")
    house.build_silver("run1", as_of="2024-01-01 00:00:00")
    # a later batch with only a bad record: old dates stay valid, the default gate passes
    bad = P.actual_records("2023-09-02T00:00:00", hours=[0], regions=["Central"], load=lambda h, r: -1.0)
    _land(scratch, "a2", "a.json", bad)
    house.ingest(os.path.join(scratch, "a2"), D.ACTUAL_DATASET, "b2")
    house.build_silver("run2", as_of="2024-01-02 00:00:00")
    assert house.gate() == 3
    house.build_silver("run3", as_of="2024-01-03 00:00:00", batch_id="b2",
                       checks=QualityOptions(batch_nonempty=True, quarantine_blocking=True))
    latest = {(r.dataset_name, r.rule_name): r.status
              for r in reports.quality_status(house.store.read(Lakehouse.QUALITY)).collect()}
    assert latest[("actual_load_hourly", "nonempty_batch_output")] == "FAIL"
    assert latest[("historical_load", "quarantined_rows")] == "FAIL"
    with pytest.raises(BlockingFailure):
        house.gate()


def test_incremental_gold(spark, scratch):
    house = _house(spark, scratch)
    d1, d2 = "2023-09-01T00:00:00", "2023-09-02T00:00:00"
    _land(scratch, "a1", "a1.json", P.actual_records(d1))
    _land(scratch, "f1", "f1.json", P.forecast_records(d1))
    house.ingest(os.path.join(scratch, "a1"), D.ACTUAL_DATASET, "b1")
    house.ingest(os.path.join(scratch, "f1"), D.FORECAST_DATASET, "b1")
    house.build_silver("run1", as_of="2024-01-01 00:00:00")
    house.build_gold(as_of="2024-01-01 00:00:00")
    _land(scratch, "a2", "a2.json", P.actual_records(d2))
    _land(scratch, "f2", "f2.json", P.forecast_records(d2))
    house.ingest(os.path.join(scratch, "a2"), D.ACTUAL_DATASET, "b2")
    house.ingest(os.path.join(scratch, "f2"), D.FORECAST_DATASET, "b2")
    day2 = house.batch_dates(D.ACTUAL_DATASET, "b2")
    house.build_silver("run2", as_of="2024-01-02 00:00:00", dates=day2)
    house.build_gold(as_of="2024-01-02 00:00:00", dates=day2)
    assert house.store.read(Lakehouse.FACT).count() == 144
    assert house.store.read(Lakehouse.PEAK).count() == 6 and house.store.read(Lakehouse.DIM_DATE).count() == 2
    # a correction batch repeats one day-2 record with a negative load: day 2 turns incomplete
    bad = P.actual_records(d2, hours=[5], regions=["North"], load=lambda h, r: -1.0)
    _land(scratch, "a3", "a3.json", bad)
    house.ingest(os.path.join(scratch, "a3"), D.ACTUAL_DATASET, "b3")
    day2 = house.batch_dates(D.ACTUAL_DATASET, "b3")
    house.build_silver("run3", as_of="2024-01-03 00:00:00", dates=day2)
    house.build_gold(as_of="2024-01-03 00:00:00", dates=day2)
    fact = house.store.read(Lakehouse.FACT)
    assert fact.count() == 72 and {str(r.market_date) for r in fact.select("market_date").distinct().collect()} == {"2023-09-01"}
    assert house.store.read(Lakehouse.PERFORMANCE).count() == 3


def test_whole_partitions_and_new_rows_are_not_shuffled(spark, scratch, monkeypatch):
    """Bronze rows of dates that fill their landing partitions come without a join, others by their file; files that
    are all new are written as they came; the index is made without a shuffle."""
    from lakemeter.plans import tables
    from lakemeter.sources.parse import record_dates

    house = _house(spark, scratch)
    days = {"a": ("2023-09-01", "2024-01-01"), "b": ("2023-09-02", "2024-01-01"), "c": ("2023-09-03", "2024-01-02")}
    monkeypatch.setattr(tables, "unique_per_key", lambda *x: pytest.fail("no key is repeated"))
    for name, (day, landed) in days.items():
        _land(scratch, name, f"{name}.json", P.actual_records(f"{day}T00:00:00", hours=range(2)))
        house.ingest(os.path.join(scratch, name), D.ACTUAL_DATASET, name, ingested_at=f"{landed} 00:00:00")
    monkeypatch.undo()
    _land(scratch, "d", "bad.json", raw="{not json")
    house.ingest(os.path.join(scratch, "d"), D.ACTUAL_DATASET, "d", ingested_at="2024-01-03 00:00:00")

    def wanted(*dates):
        rows = house.bronze_for_dates(D.ACTUAL_DATASET, spark.createDataFrame([(x,) for x in dates], "d string").select(
            F.col("d").cast("date").alias("market_date")))
        return sorted(r.batch_id for r in rows.collect()), "Join" in rows._jdf.queryExecution().optimizedPlan().toString()

    assert wanted("2023-09-03") == (["c", "d"], False)
    assert wanted("2023-09-01", "2023-09-02") == (["a", "b", "d"], False)
    assert wanted("2023-09-01") == (["a", "d"], True)
    assert wanted(None) == (["d"], False)
    raw = house.store.read(Lakehouse.ACTUAL_RAW)
    made = record_dates(raw, D.actual_payload_schema(), unique=True)
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    assert sorted(made.collect(), key=str) == sorted(record_dates(raw, D.actual_payload_schema()).collect(), key=str)


def test_insert_only_of_held_and_repeated_keys(spark, scratch):
    """Held keys stay, repeated ones come once with the greatest row, null keys are a key."""
    store = _house(spark, scratch).store
    put = lambda rows, **how: store.insert_only("silver.keyed", spark.createDataFrame(rows, "k string, v int"), ["k"], **how)
    held = lambda: sorted(map(tuple, store.read("silver.keyed").collect()), key=str)
    assert put([("a", 1), (None, 2)]) == {"seen": 2, "inserted": 2}
    assert put([("a", 9), (None, 9), ("b", 1), ("b", 3), ("c", 4)]) == {"seen": 5, "inserted": 2}
    assert held() == [("a", 1), ("b", 3), ("c", 4), (None, 2)]
    assert put([("c", 5), ("d", 6), ("d", 6), ("d", 7)], keep_repeats=True) == {"seen": 4, "inserted": 3}
    assert held() == [("a", 1), ("b", 3), ("c", 4), ("d", 6), ("d", 6), ("d", 7), (None, 2)]
