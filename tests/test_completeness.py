import datetime as dt

from lakemeter.operators import completeness as C


def _rows(day, hours, entities, col):
    d = dt.datetime.fromisoformat(day)
    return [(d.date(), d + dt.timedelta(hours=h), e) for h in hours for e in entities]


def test_paired_completeness(spark):
    regions, zones = ["A", "B", "C"], [f"Z{i}" for i in range(1, 11)]
    a = _rows("2024-01-01", range(24), regions, "region") + _rows("2024-01-02", range(24), regions, "region")[:-1]
    f = _rows("2024-01-01", range(24), zones, "zone") + _rows("2024-01-02", range(24), zones, "zone") \
        + _rows("2024-01-03", range(24), zones, "zone")
    A = spark.createDataFrame(a, "market_date date, interval_start_utc timestamp_ntz, region string")
    F_ = spark.createDataFrame(f, "market_date date, interval_start_utc timestamp_ntz, local_resource_zone string")
    prof = {r.market_date.isoformat(): r for r in C.paired_completeness(A, F_).collect()}
    bounded = {r.market_date.isoformat(): r for r in C.paired_completeness(A, F_, bounded=True).collect()}
    assert bounded == prof
    assert prof["2024-01-01"].is_complete
    assert prof["2024-01-01"].actual_rows == 72 and prof["2024-01-01"].forecast_rows == 240
    assert not prof["2024-01-02"].is_complete          # one actual record missing
    assert not prof["2024-01-03"].is_complete          # forecast only
    assert prof["2024-01-03"].actual_rows is None


def test_ordinary_days_requires_exact_set(spark):
    rows = _rows("2024-01-01", range(24), ["A", "B", "C"], "r") + _rows("2024-01-02", range(24), ["A", "B", "D"], "r") \
        + _rows("2024-01-03", range(24), ["A", "B", "C"], "r") + [(dt.date(2024, 1, 3), dt.datetime(2024, 1, 3), "A")]
    df = spark.createDataFrame(rows, "d date, t timestamp_ntz, r string")
    out = {r.d.isoformat(): r.is_ordinary for r in C.ordinary_days(
        df, date_col="d", interval_col="t", entity_col="r", expected_entities=["A", "B", "C"]).collect()}
    assert out == {"2024-01-01": True, "2024-01-02": False, "2024-01-03": False}


def test_ordinary_day_on_parsed_payloads(spark):
    """A complete synthetic day: 72 actual and 240 forecast keys, exact sets; one missing
    record or one repeated key makes it not ordinary."""
    import json

    from lakemeter.sources.parse import parse_actual, parse_forecast
    from lakemeter.sources.payloads import with_lineage
    from tests import payloads as P
    day = "2023-09-01T00:00:00"
    recs = P.actual_records(day)
    rows = [("full", json.dumps({"data": recs})), ("missing", json.dumps({"data": recs[1:]})),
            ("repeat", json.dumps({"data": recs + recs[:1]}))]
    bronze = with_lineage(spark.createDataFrame(rows, "raw_file_name string, raw_payload string"), "s", "a", "b")
    a = parse_actual(bronze, "America/New_York")
    out = {}
    for name, _ in rows:
        r = C.ordinary_days(a.where(f"raw_file_name = '{name}'"), date_col="market_date",
                            interval_col="interval_start_utc", entity_col="region",
                            expected_entities=["CENTRAL", "NORTH", "SOUTH"]).first()
        out[name] = (r.keys, r.is_ordinary)
    assert out == {"full": (72, True), "missing": (71, False), "repeat": (72, False)}
    f = parse_forecast(with_lineage(spark.createDataFrame(
        [("f", json.dumps({"data": P.forecast_records(day)}))], "raw_file_name string, raw_payload string"),
        "s", "f", "b"), "America/New_York")
    r = C.ordinary_days(f, date_col="market_date", interval_col="interval_start_utc",
                        entity_col="local_resource_zone", expected_entities=[f"Z{i}" for i in range(1, 11)]).first()
    assert r.keys == 240 and r.is_ordinary
