import json
import os

from pyspark.sql import functions as F

from lakemeter.sources import contracts
from lakemeter.sources.parse import (parse_actual, parse_forecast, parse_fuel_mix, parse_parallel_arrays,
                                     parse_snapshot)
from lakemeter.sources.payloads import scan_payloads, with_lineage
from tests import payloads as P

TZ = "America/New_York"


def test_scan_is_one_row_per_file_with_checksum(spark, scratch):
    P.write(scratch, "a.json", P.actual_records("2023-09-01T00:00:00"))
    P.write(scratch, "b.json", P.actual_records("2023-09-02T00:00:00", hours=range(3)))
    bronze = scan_payloads(spark, scratch, "src", "actual_load", "b1", ingested_at="2024-01-01 00:00:00")
    rows = bronze.collect()
    assert len(rows) == 2
    assert all(len(r.record_checksum) == 64 and r.dataset_name == "actual_load" for r in rows)
    with open(os.path.join(scratch, "a.json"), encoding="utf-8") as fh:
        text = fh.read()
    a = [r for r in rows if r.raw_file_name.endswith("a.json")][0]
    assert a.raw_payload == text


def test_parse_actual_and_forecast(spark):
    pay = json.dumps({"data": P.actual_records("2023-09-01T00:00:00")})
    fpay = json.dumps({"data": P.forecast_records("2023-09-01T00:00:00")})
    df = spark.createDataFrame([("f1", pay), ("f2", fpay), ("bad", "{not json"), ("empty", '{"data": []}')],
                               "raw_file_name string, raw_payload string")
    bronze = with_lineage(df, "s", "d", "b1", ingested_at="2024-01-01 00:00:00")
    a = parse_actual(bronze.where("raw_file_name in ('f1','bad','empty')"), TZ).collect()
    good = [r for r in a if r.raw_file_name == "f1"]
    assert len(good) == 72 and len(a) == 74  # malformed and empty each give one NULL record
    first = min(good, key=lambda r: (r.interval_start_utc, r.region))
    assert first.region == "CENTRAL" and first.hour_ending == 1 and str(first.market_date) == "2023-09-01"
    assert str(first.interval_start_utc) == "2023-09-01 04:00:00"
    assert all(r.interval_start_utc is None for r in a if r.raw_file_name != "f1")
    f = parse_forecast(bronze.where("raw_file_name = 'f2'"), TZ).collect()
    assert len(f) == 240 and {r.local_resource_zone for r in f} == {f"Z{i}" for i in range(1, 11)}
    assert {str(r.forecast_init_date) for r in f} == {"2023-08-31"}


def test_payload_contract(spark):
    good = {"data": [{"timeInterval": {"start": "2023-09-01T00:00:00"}, "load": 1.5},
                     {"timeInterval": {"start": "2023-09-01T01:00:00"}, "load": 2}]}
    rows = [("ok", json.dumps(good)),
            ("bool", json.dumps({"data": [good["data"][0], {"timeInterval": {"start": "x"}, "load": True}]})),
            ("neg", json.dumps({"data": [{"timeInterval": {"start": "x"}, "load": -1}]})),
            ("str", json.dumps({"data": [{"timeInterval": {"start": "x"}, "load": "12"}]})),
            ("nostart", json.dumps({"data": [{"timeInterval": {"start": ""}, "load": 1}]})),
            ("notobj", json.dumps({"data": [5]})),
            ("empty", json.dumps({"data": []})), ("nodata", json.dumps({"x": 1})), ("broken", "{")]
    df = spark.createDataFrame(rows, "raw_file_name string, raw_payload string")
    out = {r.raw_file_name: r for r in contracts.check_payloads(df, "load").collect()}
    assert out["ok"].is_valid and out["ok"].record_count == 2
    assert (out["bool"].violation, out["bool"].violation_index) == ("VALUE_NOT_NUMERIC", 1)
    assert out["neg"].violation == "VALUE_INVALID" and out["str"].violation == "VALUE_NOT_NUMERIC"
    assert out["nostart"].violation == "NO_INTERVAL_START" and out["notobj"].violation == "RECORD_NOT_OBJECT"
    for k in ("empty", "nodata", "broken"):
        assert out[k].violation == "DATA_NOT_NONEMPTY_LIST" and out[k].record_count == 0


def test_manifest_reconcile_both_layouts(spark):
    pay = json.dumps({"data": P.actual_records("2023-09-01T00:00:00")})
    sha = spark.createDataFrame([(pay,)], "p string").select(F.sha2("p", 256)).first()[0]
    sample_layout = {"market_date": "2023-09-01", "datasets": {
        "actual": {"records": 72, "pages": [{"file": "actual_load_page_0001.json", "records": 72, "sha256": sha}]},
        "forecast": {"records": 240, "pages": [{"file": "load_forecast_page_0001.json", "records": 240, "sha256": "00"}]}}}
    code_layout = {"market_date": "2023-09-02", "batch_id": "b", "datasets": {
        "actual_load": {"files": [{"file": "other.json", "rows": 5, "sha256": "ab"}]}}}
    man = spark.createDataFrame([(json.dumps(sample_layout),), (json.dumps(code_layout),)], "raw_payload string")
    declared = contracts.manifest_entries(man)
    assert declared.count() == 3
    bronze = spark.createDataFrame([("/x/2023-09-01/actual_load_page_0001.json", pay),
                                    ("/x/extra.json", '{"data": [1, 2]}')], "raw_file_name string, raw_payload string")
    out = {r.file_name: r.status for r in contracts.reconcile(declared.drop("market_date", "dataset"),
                                                              contracts.landed_files(bronze)).collect()}
    assert out == {"actual_load_page_0001.json": "OK", "load_forecast_page_0001.json": "MISSING",
                   "other.json": "MISSING", "extra.json": "UNLISTED"}


def test_parallel_arrays_fuel_mix_and_snapshot(spark):
    w = {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.5, 2.5],
                    "relative_humidity_2m": [80.0]}}
    df = spark.createDataFrame([("chicago", json.dumps(w))], "location string, p string").select(
        "location", F.from_json("p", "hourly struct<time: array<string>, temperature_2m: array<double>, "
                                     "relative_humidity_2m: array<double>>").alias("w"))
    rows = parse_parallel_arrays(df, "w.hourly", "time", ["temperature_2m", "relative_humidity_2m"],
                                 keep=["location"]).collect()
    assert len(rows) == 2 and rows[1].relative_humidity_2m is None and not rows[0].arrays_length_ok
    fuel = {"RefId": "x", "TotalMW": "1,000", "Fuel": {"Type": [
        {"INTERVALEST": "2026-08-22 9:15:00 PM", "CATEGORY": "Coal", "ACT": "250", "FUEL_CATEGORY": "Coal"},
        {"INTERVALEST": "2026-08-22 9:15:00 PM", "CATEGORY": "Wind", "ACT": "750", "FUEL_CATEGORY": "Wind"}]}}
    f = parse_fuel_mix(spark.createDataFrame([(json.dumps(fuel),)], "raw_payload string")).collect()
    assert [r.share_percent for r in f] == [25.0, 75.0]
    assert str(f[0].interval_start_utc) == "2026-08-23 02:15:00"  # fixed -05:00, not New York summer time
    snap = [{"t": "Demand", "v": "87,490", "d": "8/22/2026 9:15:00 PM EST", "id": "1"},
            {"t": "Cost", "v": "$30.92", "d": "8/22/2026 9:15:00 PM EST", "id": "2"}]
    s = parse_snapshot(spark.createDataFrame([(json.dumps(snap),)], "raw_payload string")).collect()
    assert [r.metric_value for r in s] == [87490.0, 30.92]
    assert str(s[0].observed_at_utc) == "2026-08-23 02:15:00"


def test_reconcile_several_days_with_equal_page_names(spark):
    import hashlib
    body = '{"data": [{"x": 1}]}'
    sha = hashlib.sha256(body.encode()).hexdigest()
    days = ["2023-09-01", "2023-09-02", "2023-09-03", "2023-09-04"]
    declared = spark.createDataFrame(
        [(days[0], "p_0001.json", 1, sha), (days[1], "p_0001.json", 2, sha), (days[2], "p_0001.json", 1, "0" * 64), (days[2], "p_0002.json", 1, sha)],
        "market_date string, file_name string, declared_rows long, declared_sha256 string")
    bronze = spark.createDataFrame([(f"/land/{d}/p_0001.json", body) for d in days], "raw_file_name string, raw_payload string")
    got = {(r["market_date"], r["file_name"]): r["status"]
           for r in contracts.reconcile(declared, contracts.landed_files(bronze), ["market_date", "file_name"]).collect()}
    assert got == {(days[0], "p_0001.json"): "OK", (days[1], "p_0001.json"): "ROW_COUNT_MISMATCH", (days[2], "p_0001.json"): "CHECKSUM_MISMATCH",
                   (days[2], "p_0002.json"): "MISSING", (days[3], "p_0001.json"): "UNLISTED"}
