"""Registered queries of feeds and source checks: weather, fuel mix, snapshots, faulty payloads, manifests.

The payloads are made from the driver's events by Spark, in the shape of each feed, and then go through the
parsers like landed files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemeter import domain as D
from lakemeter.functions.timeutil import local_hour, local_to_utc
from lakemeter.operators import completeness as C
from lakemeter.operators import facts, quality
from lakemeter.plans import reports
from lakemeter.plans.bindings import AS_OF, BIN_HOURS, EVENTS_DOMAIN, events_actual, events_forecast, table
from lakemeter.plans.lakehouse import RuleOptions, label_rows, measurement_rules, validate_pair
from lakemeter.session import materialize
from lakemeter.sources.contracts import landed_files, manifest_entries, reconcile
from lakemeter.sources.parse import parse_actual, parse_forecast, parse_fuel_mix, parse_parallel_arrays, parse_snapshot
from lakemeter.sources.payloads import with_lineage

# fixed values of these queries
SUMMER_DAYS = 180                   # moves the events' days into daylight-saving time
LOCATIONS = 3
WEATHER = ("time array<string>, temperature_2m array<double>, relative_humidity_2m array<double>")


def _iso(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), " ", "T")


def _bin(days: int = 0, hours: int = 0) -> Column:
    start = F.make_timestamp_ntz(F.year("ts"), F.month("ts"), F.dayofmonth("ts"), F.hour("ts") - F.hour("ts") % BIN_HOURS, F.lit(0), F.lit(0))
    return F.timestamp_add("HOUR", F.lit(24 * days + hours), start)


# -- weather ------------------------------------------------------------------------------------
def _weather_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One payload of parallel hourly arrays per location and day; where the day's count of events divides by
    four, the humidity array lacks its last hour."""
    days = table(spark, sf, "events").groupBy(F.col("ts").cast("date").alias("d"), F.concat(F.lit("L"), (F.col("user_id") % LOCATIONS).cast("string"))
                                              .alias("location")).agg(F.count(F.lit(1)).alias("n"))
    hours = F.sequence(F.lit(0), F.lit(23))
    time = F.transform(hours, lambda h: F.concat(F.col("d").cast("string"), F.lit("T"), F.lpad(h.cast("string"), 2, "0"), F.lit(":00")))
    warm = F.transform(hours, lambda h: F.col("n") % 30 + h * 0.5)
    wet = F.transform(F.slice(hours, 1, F.when(F.col("n") % 4 == 0, 23).otherwise(24)), lambda h: (40 + (F.col("n") + h) % 50).cast("double"))
    hourly = F.struct(time.alias("time"), warm.alias("temperature_2m"), wet.alias("relative_humidity_2m"))
    payloads = days.select("location", F.to_json(F.struct(hourly.alias("hourly"))).alias("raw_payload"))
    parsed = payloads.select("location", F.from_json("raw_payload", f"hourly struct<{WEATHER.replace(' array', ': array')}>").alias("w"))
    rows = parse_parallel_arrays(parsed, "w.hourly", "time", ["temperature_2m", "relative_humidity_2m"], keep=["location"])
    return rows.select("location", "position", F.col("time").try_cast("timestamp_ntz").alias("interval_start_utc"),
                       F.col("temperature_2m").alias("temperature_2m_c"), F.col("relative_humidity_2m").alias("relative_humidity_percent"), "arrays_length_ok")


def q_weather_rows(spark, sf):
    return _weather_rows(spark, sf)


def q_weather_vs_demand(spark, sf):
    """Three locations report each hour: the join is one to one after both sides are summed per interval."""
    ev = table(spark, sf, "events")
    v = validate_pair(events_actual(ev), events_forecast(ev), EVENTS_DOMAIN, RuleOptions(), AS_OF, persist=True)
    fact = facts.compare(v.valid_actual, v.valid_forecast, EVENTS_DOMAIN.tz, AS_OF)
    out = reports.weather_vs_demand(fact, _weather_rows(spark, sf))
    return out.select("interval_hour", *[F.round(c, 6).alias(c) for c in ("demand_mw", "temperature_c", "relative_humidity_percent")])


# -- near-real-time feeds --------------------------------------------------------------------------
def q_fuel_mix(spark, sf):
    ev = table(spark, sf, "events")
    each = ev.groupBy(F.col("ts").cast("date").alias("d"), "event_type").agg((F.count(F.lit(1)) * 137).alias("mw"))
    shown = F.date_format(F.timestamp_add("MINUTE", F.lit(21 * 60 + 15), F.col("d").cast("timestamp_ntz")), "yyyy-MM-dd h:mm:ss a")
    entry = F.struct(shown.alias("INTERVALEST"), F.col("event_type").alias("CATEGORY"), F.format_number("mw", 0).alias("ACT"))
    # at most one entry per event type
    payload = each.groupBy("d").agg(F.to_json(F.struct(F.lit("x").alias("RefId"), F.format_number(F.sum("mw"), 0).alias("TotalMW"),
                                                       F.struct(F.collect_list(entry).alias("Type")).alias("Fuel"))).alias("raw_payload"))
    return parse_fuel_mix(payload).withColumn("share_percent", F.round("share_percent", 6))


def q_snapshot(spark, sf):
    ev = table(spark, sf, "events")
    days = ev.groupBy(F.col("ts").cast("date").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    shown = F.concat(F.date_format(F.timestamp_add("MINUTE", F.lit(21 * 60 + 15), F.col("d").cast("timestamp_ntz")), "M/d/yyyy h:mm:ss a"), F.lit(" EST"))
    metric = lambda i, name, value: F.struct(F.lit(name).alias("t"), value.alias("v"), shown.alias("d"), F.lit(str(i)).alias("id"))
    payload = days.select("d", F.to_json(F.array(
        metric(1, "Demand", F.format_number(F.col("n") * 1234, 0)), metric(2, "Cost", F.concat(F.lit("$"), F.format_number(F.col("n") / 8, 2))),
        metric(3, "Flow", F.concat(F.lit("-"), F.format_number(F.col("n") * 7, 0))), metric(4, "State", F.lit("n/a")))).alias("raw_payload"))
    return parse_snapshot(payload)


# -- faulty payloads --------------------------------------------------------------------------------
def _faulty(spark: SparkSession, sf: str, dataset: str) -> DataFrame:
    """Payloads of two records in summer: the first is sound, the second has a fault that the event id picks;
    some payloads are cut off."""
    ev = table(spark, sf, "events")
    fault = F.col("event_id") % 8
    forecast = dataset == D.FORECAST_DATASET

    def record(start, region, zone, value):
        fields = [F.struct(start.alias("start")).alias("timeInterval"), region.alias("region")]
        fields += [zone.alias("localResourceZone"), value.alias("loadForecast"), F.col("ts").cast("date").cast("string").alias("init")] if forecast \
            else [value.alias("load")]
        return F.struct(*fields)

    region, zone, value = F.col("event_type"), F.concat(F.lit(" z"), (F.col("user_id") % 10 + 1).cast("string")), F.col("value").cast("string")
    good = record(_iso(_bin(SUMMER_DAYS)), region, zone, value)
    bad = record(F.when(fault == 0, F.lit("yesterday")).otherwise(_iso(_bin(SUMMER_DAYS, BIN_HOURS))),
                 F.when(fault == 3, F.lit("elsewhere")).otherwise(region), F.when(fault == 3, F.lit("z99")).otherwise(zone),
                 F.when(fault == 1, F.lit(None)).when(fault == 2, F.concat(F.lit("-1"), value)).when(fault == 4, F.lit("abc")).otherwise(value))
    text = F.to_json(F.struct(F.array(good, bad).alias("data")))
    # measurements are numbers in the payload: the quotes around them go, except around text
    text = F.regexp_replace(text, r'"(load|loadForecast)":"(-?[0-9.E-]+)"', '"$1":$2')
    payload = F.when(F.col("event_id") % 97 == 0, F.lit('{"data": [')).otherwise(text)
    rows = ev.select(F.lpad(F.col("event_id").cast("string"), 12, "0").alias("raw_file_name"), payload.alias("raw_payload"), "ts")
    return with_lineage(rows, "events", dataset, "batch-0", ingested_at=AS_OF)


def q_rule_labels_faults(spark, sf):
    """Every reason of measurements occurs."""
    rules = measurement_rules("actual_load_mw", D.NEGATIVE_LOAD, "region", EVENTS_DOMAIN.regions, D.UNEXPECTED_REGION, RuleOptions())
    rows = label_rows(parse_actual(_faulty(spark, sf, D.ACTUAL_DATASET), EVENTS_DOMAIN.tz, AS_OF), D.ACTUAL_KEYS, rules, RuleOptions())
    return rows.select(F.col("raw_file_name").cast("bigint").alias("event_id"), "record_index", "market_date", "interval_start_utc", "region",
                       "actual_load_mw", "quarantine_reason")


def q_forecast_labels_faults(spark, sf):
    """Every reason of forecasts occurs."""
    rules = measurement_rules("load_forecast_mw", D.NEGATIVE_FORECAST, "local_resource_zone", EVENTS_DOMAIN.zones, D.UNEXPECTED_ZONE, RuleOptions())
    rows = label_rows(parse_forecast(_faulty(spark, sf, D.FORECAST_DATASET), EVENTS_DOMAIN.tz, AS_OF), D.FORECAST_KEYS, rules, RuleOptions())
    return rows.select(F.col("raw_file_name").cast("bigint").alias("event_id"), "record_index", "market_date", "forecast_init_date",
                       "interval_start_utc", "region", "local_resource_zone", "load_forecast_mw", "quarantine_reason")


def q_utc_normalise_year(spark, sf):
    """Local hours spread over a year, both clock changes included."""
    ev = table(spark, sf, "events")
    moved = F.timestamp_add("DAY", (F.col("event_id") % 12 * 30).cast("int"), F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    rows = ev.select("event_id", moved.alias("local"))
    utc = local_to_utc("local", EVENTS_DOMAIN.tz)
    return rows.select("event_id", "local", utc.alias("ts_utc"), local_hour(utc, EVENTS_DOMAIN.tz).alias("local_hour"))


# -- manifests, ordinary days, outcomes --------------------------------------------------------------
def q_manifest_statuses(spark, sf):
    """Files of several days with equal page names: every status occurs."""
    ev = table(spark, sf, "events")
    day = F.col("ts").cast("date")
    files = ev.groupBy(day.alias("d"), (F.col("event_id") % 5).alias("page")).agg(F.count(F.lit(1)).alias("n"))
    files = files.withColumns({"kind": (F.dayofmonth("d") * 5 + F.col("page")) % 7,
                               "file": F.concat(F.lit("page_"), F.lpad(F.col("page").cast("string"), 4, "0"), F.lit(".json")),
                               "body": F.concat(F.lit('{"data":[1'), F.repeat(F.lit(",1"), (F.col("n") - 1).cast("int")), F.lit("]}"))})
    kind = F.col("kind")
    rows = F.when(kind == 2, F.col("n") + 1).otherwise(F.col("n"))
    sha = F.when(kind == 3, F.sha2(F.lit("other"), 256)).otherwise(F.sha2("body", 256))
    even = F.dayofmonth("d") % 2 == 0
    entry = F.struct(F.col("file"), F.when(even, rows).alias("records"), F.when(~even, rows).alias("rows"), sha.alias("sha256"))
    listed = files.where(kind != 1).groupBy("d", even.alias("even")).agg(F.collect_list(entry).alias("entries"))  # at most five pages a day
    pages = F.struct(F.when(F.col("even"), F.col("entries")).alias("pages"), F.when(~F.col("even"), F.col("entries")).alias("files"))
    manifests = listed.select(F.to_json(F.struct(F.col("d").cast("string").alias("market_date"),
                                                 F.create_map(F.lit("actual"), pages).alias("datasets"))).alias("raw_payload"))
    copies = F.when(kind == 0, 0).when(kind == 4, 2).otherwise(1)
    landed = files.select(F.concat(F.lit("/landing/"), F.col("d").cast("string"), F.lit("/"), F.col("file")).alias("raw_file_name"),
                          F.col("body").alias("raw_payload"), F.lit("actual").alias("dataset_name"),
                          F.explode(F.array_repeat(F.lit(1), copies)).alias("copy"))
    return reconcile(manifest_entries(manifests), landed_files(landed)).drop("declared_sha256", "landed_sha256")


def q_ordinary_pairs(spark, sf):
    ev = table(spark, sf, "events")
    first = lambda df: df.dropDuplicates(["market_date", "interval_start_utc", "_entity"]).drop("_entity")
    a = first(events_actual(ev).where(F.col("region").isin(*EVENTS_DOMAIN.regions)).withColumn("_entity", F.col("region")))
    f = first(events_forecast(ev).withColumn("_entity", F.col("local_resource_zone")))
    return C.ordinary_pairs(a, f, expected_actual=EVENTS_DOMAIN.regions, expected_forecast=EVENTS_DOMAIN.zones,
                            expected_intervals=24 // BIN_HOURS).select("market_date", "actual_rows", "forecast_rows", "actual_is_ordinary",
                                                                       "forecast_is_ordinary", "is_ordinary")


def q_evaluate_gate(spark, sf):
    """The outcomes of one run over all rows, and the gate's verdict on them as one more row."""
    ev = table(spark, sf, "events")
    v = validate_pair(events_actual(ev), events_forecast(ev), EVENTS_DOMAIN, RuleOptions(), AS_OF, persist=True)
    results = materialize(quality.evaluate(v.valid_actual, v.valid_forecast, v.quarantine, "run1", AS_OF))
    gate = quality.gate_status(results)
    row = gate.select(F.lit("run1").alias("run_id"), F.lit("gate").alias("dataset_name"), F.lit("no_blocking_failure").alias("rule_name"),
                      F.col("failures").alias("failed_row_count"), F.when(F.col("is_open"), "PASS").otherwise("FAIL").alias("status"),
                      F.lit(True).alias("is_blocking"), F.lit(AS_OF).cast("timestamp_ntz").alias("evaluated_at_utc"))
    return results.unionByName(row)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "weather_rows": q_weather_rows,
    "weather_vs_demand": q_weather_vs_demand,
    "fuel_mix": q_fuel_mix,
    "snapshot": q_snapshot,
    "rule_labels_faults": q_rule_labels_faults,
    "forecast_labels_faults": q_forecast_labels_faults,
    "utc_normalise_year": q_utc_normalise_year,
    "manifest_statuses": q_manifest_statuses,
    "ordinary_pairs": q_ordinary_pairs,
    "evaluate_gate": q_evaluate_gate,
}
