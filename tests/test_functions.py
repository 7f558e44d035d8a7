import datetime as dt

from pyspark.sql import functions as F

from lakemeter.functions import (checksum, clean_number, date_key, floor_hours, hours_between,
                                 local_hour, local_to_utc, normalise_label, parse_local_timestamp)

TZ = "America/New_York"


def test_local_to_utc_winter_summer_and_clock_changes(spark):
    df = spark.createDataFrame([("2024-01-10T10:00:00",), ("2023-09-01T00:00:00",),
                                ("2024-03-10T02:00:00",), ("2024-03-10T03:00:00",),
                                ("2024-11-03T01:00:00",), ("not a time",)], "s string")
    rows = df.select(local_to_utc(parse_local_timestamp("s"), TZ).alias("u")).collect()
    got = [r.u for r in rows]
    assert got[0] == dt.datetime(2024, 1, 10, 15)
    assert got[1] == dt.datetime(2023, 9, 1, 4)
    # spring gap: 02:00 does not exist and lands on the same instant as 03:00
    assert got[2] == got[3] == dt.datetime(2024, 3, 10, 7)
    assert got[4] is not None and got[5] is None


def test_local_hour_and_floor_and_keys(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5, 30),)], "u timestamp_ntz")
    r = df.select(local_hour("u", TZ).alias("h"), floor_hours("u", 3).alias("b"),
                  date_key(F.col("u").cast("date")).alias("k"),
                  hours_between(F.lit(dt.datetime(2024, 1, 1, 2, 1)), F.col("u")).alias("age")).first()
    assert r.h == 0 and r.b == dt.datetime(2024, 1, 1, 3) and r.k == 20240101 and r.age == 3


def test_text_helpers(spark):
    df = spark.createDataFrame([("99,657", " central "), ("$30.92", "North"), ("-4,843", None), ("n/a", "x")],
                               "v string, r string")
    rows = df.select(clean_number("v").alias("n"), normalise_label("r").alias("r"),
                     checksum("v").alias("c")).collect()
    assert [r.n for r in rows] == [99657.0, 30.92, -4843.0, None]
    assert [r.r for r in rows] == ["CENTRAL", "NORTH", None, "X"]
    assert len(rows[0].c) == 64


def test_utc_now_and_instant_round_trip(spark):
    from lakemeter.functions.timeutil import instant_to_ntz, ntz_to_instant, utc_now
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    r = spark.range(1).select(utc_now().alias("n")).first()
    assert abs((r.n - now).total_seconds()) < 120
    t = dt.datetime(2024, 7, 1, 12, 30, 15, 123456)
    back = spark.createDataFrame([(t,)], "t timestamp_ntz").select(instant_to_ntz(ntz_to_instant("t")).alias("x")).first()
    assert back.x == t


def test_layer_names():
    import pytest

    from lakemeter.domain import table_name
    assert table_name("silver", "actual_load_hourly") == "silver.actual_load_hourly"
    with pytest.raises(ValueError):
        table_name("platinum", "x")
