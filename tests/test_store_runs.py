"""Stored tables: swaps, pruned reads, kept states, layouts by key, replays after failures."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lakemeter import domain as D
from lakemeter.operators import completeness as C
from lakemeter.operators import dedup, quality
from lakemeter.plans import reports
from lakemeter.plans import tables as T
from lakemeter.plans.bindings import events_between
from lakemeter.plans.lakehouse import Lakehouse
from lakemeter.sources.contracts import check_payloads, reconcile
from lakemeter.streaming.incremental import BatchLedger, start_landing
from tests import payloads as P

D1, D2 = "2023-09-01T00:00:00", "2023-09-02T00:00:00"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def house_of(spark, scratch, days=(D1, D2)):
    house = Lakehouse.at(spark, os.path.join(scratch, "lake"))
    for i, day in enumerate(days):
        P.write(os.path.join(scratch, f"a{i}"), f"a{i}.json", P.actual_records(day))
        P.write(os.path.join(scratch, f"f{i}"), f"f{i}.json", P.forecast_records(day))
        house.ingest(os.path.join(scratch, f"a{i}"), D.ACTUAL_DATASET, f"b{i}", ingested_at=f"2024-01-0{i + 1} 00:00:00")
        house.ingest(os.path.join(scratch, f"f{i}"), D.FORECAST_DATASET, f"b{i}", ingested_at=f"2024-01-0{i + 1} 00:00:00")
    return house


# -- tables -----------------------------------------------------------------------------------
def test_a_swap_that_was_cut_short_is_finished(spark, scratch):
    store = T.TableStore(spark, scratch)
    rows = lambda v: spark.createDataFrame([(1, v)], "k int, v string")
    store.overwrite("gold.t", rows("old"))
    # the old table has been renamed away, the new one is written but not in its place yet
    rows("new").write.saveAsTable(store.name("gold.t", "__next0000"))
    spark.sql(f"ALTER TABLE {store.name('gold.t')} RENAME TO {store.name('gold.t', '__old0000')}")
    assert store.exists("gold.t") and store.read("gold.t").first()["v"] == "new"
    assert not store.exists("gold.other")


def test_a_failed_overwrite_leaves_the_old_table(spark, scratch):
    store = T.TableStore(spark, scratch)
    store.overwrite("gold.t", spark.range(5).toDF("k"))
    broken = spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("k"))
    with pytest.raises(Exception):
        store.overwrite("gold.t", broken)
    assert store.read("gold.t").count() == 5


def test_partition_values_that_need_quoting(spark, scratch):
    store = T.TableStore(spark, scratch, {"silver.t": "p"})
    values = ["it's", "a/b", "50%", "x y", "b\\s", None]
    store.overwrite("silver.t", spark.createDataFrame([(i, p) for i, p in enumerate(values)], "k int, p string"))
    assert {r["p"] for r in store.read("silver.t").collect()} == set(values)
    gone = spark.createDataFrame([(p,) for p in values[:5]], "p string")
    store.delete_matching("silver.t", gone, "p")
    assert [r["p"] for r in store.read("silver.t").collect()] == [None]
    store.replace_partitions("silver.t", store.read("silver.t").limit(0), store.read("silver.t"))
    assert store.read("silver.t").count() == 0


# -- pruned reads -------------------------------------------------------------------------------
def test_rebuild_of_one_date_reads_its_landing_partitions(spark, scratch):
    house = house_of(spark, scratch)
    only = spark.createDataFrame([(dt.date(2023, 9, 2),)], "market_date date")
    some = house.bronze_for_dates(D.ACTUAL_DATASET, only)
    filters = [x for x in plan_of(some).splitlines() if "raw_payload" in x and "FileScan" in x]
    assert len(filters) == 1 and "PartitionFilters: [isnotnull(landing_date" in filters[0] and "landing_date" in filters[0]
    assert sum(f.endswith(".parquet") for f in some.select("raw_payload").inputFiles()) > 0
    assert {r["batch_id"] for r in some.collect()} == {"b1"}
    house.build_silver("run1", as_of="2024-02-01 00:00:00")
    whole = {t: sorted(map(str, house.store.read(t).collect())) for t in (house.ACTUAL, house.FORECAST)}
    house.build_silver("run2", as_of="2024-02-01 00:00:00", dates=only)
    assert {t: sorted(map(str, house.store.read(t).collect())) for t in (house.ACTUAL, house.FORECAST)} == whole


def test_reports_of_a_range_prune_stored_partitions(spark, scratch):
    house = house_of(spark, scratch)
    house.build_silver("run1", as_of="2024-02-01 00:00:00")
    house.build_gold(as_of="2024-02-01 00:00:00")
    day = "2023-09-02"
    stored = house.store.read(house.FACT)
    for report in (reports.actual_vs_forecast, reports.error_trend, reports.hour_profile):
        scans = [x for x in plan_of(report(stored, day, day)).splitlines() if "FileScan" in x]
        assert scans and all("market_date" in x.split("PartitionFilters:")[1].split("]")[0] for x in scans)
    ranged = house.fact_between(day, day, as_of="2024-02-01 00:00:00")
    scans = [x for x in plan_of(ranged).splitlines() if "FileScan" in x]
    assert len(scans) >= 2 and all("market_date" in x.split("PartitionFilters:")[1].split("]")[0] for x in scans)
    same = stored.where(F.col("market_date") == day)
    assert sorted(map(str, ranged.select(*stored.columns).collect())) == sorted(map(str, same.collect()))


def test_event_range_reaches_the_scan(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    scan = plan_of(events_between(ev, "2024-01-05", "2024-01-06", 1))
    assert "2024-01-04" in scan and "2024-01-06" in scan
    kept = events_between(ev, "2024-01-05", "2024-01-06", 1).select(F.min("ts"), F.max("ts")).first()
    assert kept[0] >= dt.datetime(2024, 1, 4) and kept[1] < dt.datetime(2024, 1, 6)


# -- kept states ----------------------------------------------------------------------------------
def labelled(spark, rows):
    make = [(dt.date(2024, 1, d), dt.datetime(2024, 1, d, h), e, r) for d, h, e, r in rows]
    return spark.createDataFrame(make, "market_date date, interval_start_utc timestamp_ntz, region string, quarantine_reason string")


def test_bitmaps_merge_batch_by_batch(spark):
    names = ("rows", "intervals", "entities")
    first = labelled(spark, [(1, h, e, None) for h in range(24) for e in "AB"] + [(1, 3, "A", "DUPLICATE_BUSINESS_KEY"), (2, 0, None, None)])
    second = labelled(spark, [(1, 5, "A", "NEGATIVE_LOAD"), (1, 6, "B", None), (2, 1, "C", "MISSING_MEASUREMENT")])
    third = labelled(spark, [(1, 5, "A", None), (1, 7, "A", "NEGATIVE_LOAD"), (2, 0, None, "NEGATIVE_LOAD"), (3, 0, "A", None)])
    parts = [C.cell_bitmaps(x, i, entity_col="region") for i, x in enumerate((first, second, third))]
    at_once = C.merge_bitmaps(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    stepwise = C.merge_bitmaps(C.merge_bitmaps(parts[0].unionByName(parts[1])).unionByName(parts[2]))
    want = {dt.date(2024, 1, 1): (47, 24, 2), dt.date(2024, 1, 3): (1, 1, 1)}
    for merged in (at_once, stepwise):
        got = {r["market_date"]: (r["rows"], r["intervals"], r["entities"]) for r in C.bitmap_profile(merged, names).collect()}
        assert got == want
    after_two = C.bitmap_profile(C.merge_bitmaps(parts[0].unionByName(parts[1])), names).collect()
    assert {r["market_date"].day: (r["rows"], r["entities"]) for r in after_two} == {1: (47, 2), 2: (1, 0)}


def test_sketch_thresholds_stay_within_their_bound(spark):
    fact = spark.range(40_000).select(F.lit("HOT").alias("region"), F.expr("date_add(DATE'2024-01-01', cast(id % 40 as int))").alias("market_date"),
                                      F.pow(F.rand(7) * 10, F.lit(3)).alias("absolute_error_mw"))
    fact = fact.unionByName(spark.range(50).select(F.lit("COLD"), F.lit(dt.date(2024, 1, 1)), F.col("id").cast("double"))
                            .toDF("region", "market_date", "absolute_error_mw")).cache()
    sketches = quality.error_sketches(fact)
    assert sketches.count() == 41
    for q in (0.1, 0.5, 0.9, 0.99):
        for r in quality.thresholds_from_sketches(sketches, quantile=q).collect():
            rows = fact.where(F.col("region") == r["region"])
            n, low, high = rows.count(), *(rows.where(c).count() for c in (F.col("absolute_error_mw") < r["error_threshold_mw"],
                                                                          F.col("absolute_error_mw") <= r["error_threshold_mw"]))
            bound = quality.SKETCH_ERROR / 400 + 1 / n
            assert r["error_rows"] == n and low / n <= q + bound and high / n >= q - bound


def test_staged_layout_needs_no_exchange(spark, scratch):
    store = T.TableStore(spark, scratch)
    rows = [(1, "a", 1, 10), (1, "a", 3, 30), (1, None, 2, 20), (1, None, 2, 25), (None, None, 5, 50), (2, "b", None, 60)]
    df = spark.createDataFrame(rows, "k int, z string, t int, v int")
    staged = dedup.stage_by_key(df, store.name("silver.staged"), ["k", "z"], 4)
    flagged = dedup.flag_staged(staged, ["t", "v"])
    assert "Exchange" not in plan_of(flagged) and "Exchange" not in plan_of(dedup.latest_staged(staged, ["t", "v"]))
    want = sorted(map(tuple, dedup.flag_latest(df, ["k", "z"], ["t", "v"]).collect()), key=repr)
    assert sorted(map(tuple, flagged.select("k", "z", "t", "v", "is_latest").collect()), key=repr) == want
    assert sorted(r["v"] for r in dedup.latest_staged(staged, ["t", "v"]).collect()) == [25, 30, 50, 60]


# -- source checks ---------------------------------------------------------------------------------
def test_reconcile_counts_a_repeated_key_once(spark):
    declared = spark.createDataFrame([("d1", "p", 1, "x"), ("d1", "q", 1, "x"), ("d1", "q", 1, "x"), (None, "n", 2, "y")],
                                     "market_date string, file_name string, declared_rows long, declared_sha256 string")
    landed = spark.createDataFrame([("d1", "p", 1, "x")] * 1000 + [("d1", "q", 1, "x"), ("d2", "p", 1, "x"), (None, "n", 2, "y")],
                                   "market_date string, file_name string, landed_rows long, landed_sha256 string")
    got = {(r["market_date"], r["file_name"]): (r["status"], r["declared_files"], r["landed_files"]) for r in reconcile(declared, landed).collect()}
    assert got == {("d1", "p"): ("DUPLICATE", 1, 1000), ("d1", "q"): ("DUPLICATE", 2, 1), ("d2", "p"): ("UNLISTED", 0, 1), (None, "n"): ("OK", 1, 1)}
    with pytest.raises(ValueError):
        check_payloads(landed.withColumn("raw_payload", F.lit("{}")).withColumn("raw_file_name", F.lit("f")), "load') OR ('")


def test_weather_of_several_locations_does_not_multiply_demand(spark):
    t = dt.datetime(2024, 1, 1, 5)
    fact = spark.createDataFrame([(t, dt.date(2024, 1, 1), "A", 10.0), (t, dt.date(2024, 1, 1), "B", 30.0), (t.replace(minute=30), dt.date(2024, 1, 1), "A", 100.0)],
                                 "interval_start_utc timestamp_ntz, market_date date, region string, actual_load_mw double")
    weather = spark.createDataFrame([(t, 1.0, None), (t, 3.0, 50.0), (t.replace(minute=30), 5.0, 70.0), (t.replace(hour=9), 9.0, 9.0)],
                                    "interval_start_utc timestamp_ntz, temperature_2m_c double, relative_humidity_percent double")
    got = reports.weather_vs_demand(fact, weather).collect()
    pairs = fact.join(weather, "interval_start_utc").agg(F.avg("actual_load_mw"), F.avg("temperature_2m_c"), F.avg("relative_humidity_percent")).first()
    assert len(got) == 1 and tuple(got[0])[1:] == pytest.approx(tuple(pairs))


# -- replays -----------------------------------------------------------------------------------------
class Broken(RuntimeError):
    pass


def landing(spark, scratch, house):
    P.write(os.path.join(scratch, "f"), "f.json", P.forecast_records(D1))
    house.ingest(os.path.join(scratch, "f"), D.FORECAST_DATASET, "b0", ingested_at="2024-01-01 00:00:00")
    P.write(os.path.join(scratch, "land"), "a1.json", P.actual_records(D1, hours=range(23)) + [{"timeInterval": {"start": "nonsense"}, "region": "x", "load": 1.0}])
    P.write(os.path.join(scratch, "land"), "a2.json", P.actual_records(D1, hours=[23]))
    return lambda: start_landing(house, os.path.join(scratch, "land"), D.ACTUAL_DATASET, os.path.join(scratch, "ckpt"), rebuild_silver=True,
                                 rebuild_gold=True)


def tables_of(house):
    out = {}
    for t in (house.ACTUAL_RAW, house.ACTUAL, house.FORECAST, house.QUARANTINE, house.QUALITY, house.FACT, house.PEAK, house.DIM_DATE):
        df = house.store.read(t)
        keep = [c for c in df.columns if not c.endswith(("_timestamp_utc", "_at_utc", "landing_date", "raw_file_name"))]
        out[t] = sorted(map(str, df.select(*keep).collect()))
    return out


@pytest.fixture(scope="module")
def undisturbed(spark, tmp_path_factory):
    scratch = str(tmp_path_factory.mktemp("undisturbed"))
    house = Lakehouse.at(spark, os.path.join(scratch, "lake"))
    landing(spark, scratch, house)().awaitTermination(300)
    want = tables_of(house)
    assert len(want[house.ACTUAL]) == 72 and len(want[house.FACT]) == 72 and len(want[house.QUARANTINE]) == 1
    return want


@pytest.mark.parametrize("owner,method,call", [("house", "ingest_frame", 1), ("store", "replace_partitions", 1), ("store", "replace_partitions", 2),
                                               ("house", "build_silver", 1), ("store", "append", 2), ("house", "build_gold", 1)])
def test_replay_after_a_failure_gives_the_undisturbed_tables(spark, tmp_path, monkeypatch, undisturbed, owner, method, call):
    """The step is done, then the job dies before anything is entered: the replay neither repeats nor loses rows."""
    scratch = str(tmp_path)
    house = Lakehouse.at(spark, os.path.join(scratch, "lake"))
    start = landing(spark, scratch, house)
    target = house if owner == "house" else house.store
    real, calls = getattr(target, method), []

    def failing(*args, **kwargs):
        out = real(*args, **kwargs)
        calls.append(1)
        if len(calls) == call:
            raise Broken()
        return out

    monkeypatch.setattr(target, method, failing)
    with pytest.raises(Exception):
        start().awaitTermination(300)
    assert len(calls) == call
    start().awaitTermination(300)
    assert tables_of(house) == undisturbed


def test_ledger_enters_each_step_once(spark, scratch):
    ledger = BatchLedger(T.TableStore(spark, scratch), "q")
    ran = []
    assert ledger.once(1, "a", lambda: ran.append("a")) and not ledger.once(1, "a", lambda: ran.append("again"))
    with pytest.raises(Broken):
        ledger.once(1, "b", lambda: (_ for _ in ()).throw(Broken()))
    assert ledger.finished(1) == {"a"} and ledger.finished(2) == set() and ran == ["a"]
    assert BatchLedger(ledger.store, "other").finished(1) == set()
