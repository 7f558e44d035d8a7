"""Registered queries: each inventory operator run over the driver's whole tables.

Every callable takes (spark, sf_dir) and returns a lazy DataFrame.  Floating results that
come from sums or averages are rounded to 6 decimals for comparison with the SQL
equivalents (summation order differs between engines); nothing else is altered.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemeter import domain as D
from lakemeter.functions.hashing import checksum
from lakemeter.functions.text import clean_number
from lakemeter.functions.timeutil import local_hour, local_to_utc
from lakemeter.operators import completeness as C
from lakemeter.operators import dims, facts, quality
from lakemeter.operators.dedup import flag_latest, latest_rows
from lakemeter.plans import reports, tables
from lakemeter.plans.bindings import (AS_OF, BIN_HOURS, EVENTS_DOMAIN, events_actual, events_between,
                                      events_forecast, table)
from lakemeter.plans.lakehouse import RuleOptions, label_rows, measurement_rules, validate_pair
from lakemeter.session import materialize
from lakemeter.sources.contracts import check_payloads, reconcile
from lakemeter.sources.parse import parse_actual, parse_forecast
from lakemeter.sources.payloads import with_lineage

RANGE = ("2024-01-05", "2024-01-20")
LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey"]


def _r(col, n: int = 6):
    return F.round(F.col(col) if isinstance(col, str) else col, n)


def _validation(spark: SparkSession, sf: str, between: tuple[str, str] | None = None):
    """Events -> labelled, routed datasets.  The labelled frames feed several consumers,
    so they are written once to the checkpoint folder (as the lakehouse run does).

    Every verdict (latest row, first failing rule, completeness) is a fact about one market date, so a
    date range is taken below the validation, at the scan."""
    ev = table(spark, sf, "events")
    start, end = between or (None, None)
    return validate_pair(events_actual(events_between(ev, start, end)), events_forecast(events_between(ev, start, end, 1)),
                         EVENTS_DOMAIN, RuleOptions(), AS_OF, persist=True)


def _fact(spark: SparkSession, sf: str, v=None, between: tuple[str, str] | None = None) -> DataFrame:
    v = v or _validation(spark, sf, between)
    return facts.compare(v.valid_actual, v.valid_forecast, EVENTS_DOMAIN.tz, AS_OF)


def _round_fact(fact: DataFrame) -> DataFrame:
    return fact.select(
        "market_date", "forecast_init_date", "interval_start_utc", "region", "actual_load_mw",
        _r("forecast_load_mw").alias("forecast_load_mw"), _r("forecast_error_mw").alias("forecast_error_mw"),
        _r("absolute_error_mw").alias("absolute_error_mw"),
        _r("absolute_percentage_error").alias("absolute_percentage_error"), "date_key", "hour")


# -- minimal slice: daily peak over raw events ------------------------------------------
def q_daily_peak(spark, sf):
    ev = table(spark, sf, "events").select(
        F.col("ts").cast("date").alias("market_date"), F.upper(F.trim("event_type")).alias("region"),
        "value", "ts")
    return facts.daily_peak(ev, value_col="value", time_col="ts").drop("updated_at_utc")


# -- latest-wins ------------------------------------------------------------------------
def q_dedup_latest(spark, sf):
    return latest_rows(table(spark, sf, "lineitem"), LINE_KEYS, LINE_ORDER)


def q_dedup_flags(spark, sf):
    li = table(spark, sf, "lineitem")
    return flag_latest(li, LINE_KEYS, LINE_ORDER).select(*LINE_KEYS, *LINE_ORDER, "is_latest")


# -- rules, split, completeness, quarantine -----------------------------------------------
def _labelled(spark, sf, forecast: bool = False):
    """One dataset's labels only (no routing, nothing materialized)."""
    ev = table(spark, sf, "events")
    opts = RuleOptions()
    if forecast:
        rules = measurement_rules("load_forecast_mw", D.NEGATIVE_FORECAST, "local_resource_zone",
                                  EVENTS_DOMAIN.zones, D.UNEXPECTED_ZONE, opts)
        return label_rows(events_forecast(ev), D.FORECAST_KEYS, rules, opts)
    rules = measurement_rules("actual_load_mw", D.NEGATIVE_LOAD, "region", EVENTS_DOMAIN.regions,
                              D.UNEXPECTED_REGION, opts)
    return label_rows(events_actual(ev), D.ACTUAL_KEYS, rules, opts)


def q_rule_labels(spark, sf):
    return _labelled(spark, sf).select(
        F.col("record_index").alias("event_id"), "market_date", "interval_start_utc", "region",
        "actual_load_mw", "quarantine_reason")


def q_forecast_labels(spark, sf):
    return _labelled(spark, sf, forecast=True).select(
        F.col("record_index").alias("event_id"), "market_date", "forecast_init_date",
        "interval_start_utc", "local_resource_zone", "region", "load_forecast_mw", "quarantine_reason")


def q_rule_split_counts(spark, sf):
    a = _labelled(spark, sf).select(F.lit(D.ACTUAL_DATASET).alias("dataset_name"), "quarantine_reason")
    f = _labelled(spark, sf, forecast=True).select(F.lit(D.FORECAST_DATASET).alias("dataset_name"), "quarantine_reason")
    return (a.unionByName(f).groupBy("dataset_name", F.coalesce("quarantine_reason", F.lit("VALID")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("row_count")))


def q_complete_days(spark, sf):
    return _validation(spark, sf).completeness


def q_valid_actual(spark, sf):
    return _validation(spark, sf).valid_actual.drop("processed_timestamp_utc")


def q_valid_forecast(spark, sf):
    return _validation(spark, sf).valid_forecast.drop("processed_timestamp_utc")


def q_quarantine_rows(spark, sf):
    return _validation(spark, sf).quarantine.drop("quarantined_at_utc")


def q_incomplete_rows(spark, sf):
    q = _validation(spark, sf).quarantine
    return (q.where(F.col("quarantine_reason") == D.INCOMPLETE_MARKET_DATE)
            .groupBy("dataset_name", "market_date").agg(F.count(F.lit(1)).alias("row_count")))


def q_ordinary_days(spark, sf):
    a = events_actual(table(spark, sf, "events"))
    return C.ordinary_days(a, date_col="market_date", interval_col="interval_start_utc",
                           entity_col="region", expected_entities=EVENTS_DOMAIN.regions,
                           expected_intervals=24 // BIN_HOURS)


# -- facts, aggregates, dimensions ------------------------------------------------------
def q_fact_compare(spark, sf):
    return _round_fact(_fact(spark, sf))


def q_daily_peak_fact(spark, sf):
    return facts.daily_peak(_fact(spark, sf), as_of=AS_OF).drop("updated_at_utc")


def q_accuracy_daily(spark, sf):
    acc = facts.accuracy(_fact(spark, sf), as_of=AS_OF)
    return acc.select("market_date", "region", _r("mae_mw").alias("mae_mw"),
                      _r("mape_percent").alias("mape_percent"), _r("rmse_mw").alias("rmse_mw"),
                      "hour_count")


def _performance(spark, sf, fact=None):
    stats = facts.daily_stats(fact if fact is not None else _fact(spark, sf))
    return facts.split_daily_stats(stats, AS_OF)


def q_scorecard(spark, sf):
    _, perf = _performance(spark, sf, _fact(spark, sf, between=RANGE))
    out = reports.scorecard(perf, *RANGE)
    return out.select("region", *[_r(c).alias(c) for c in ("mean_absolute_error_mw",
                      "mean_absolute_percentage_error", "root_mean_squared_error_mw")],
                      "performance_rank")


def q_hour_profile(spark, sf):
    out = reports.hour_profile(_fact(spark, sf, between=RANGE), *RANGE)
    return out.select("market_hour", "region", _r("average_load_mw").alias("average_load_mw"),
                      "maximum_load_mw")


def q_actual_vs_forecast(spark, sf):
    out = reports.actual_vs_forecast(_fact(spark, sf, between=RANGE), *RANGE)
    return out.select("interval_start_utc", "region", "actual_load_mw",
                      _r("forecast_load_mw").alias("forecast_load_mw"))


def q_error_trend(spark, sf):
    out = reports.error_trend(_fact(spark, sf, between=RANGE), *RANGE)
    return out.select("interval_start_utc", "region", _r("forecast_error_mw").alias("forecast_error_mw"),
                      _r("absolute_percentage_error").alias("absolute_percentage_error"))


def q_peak_report(spark, sf):
    peak, _ = _performance(spark, sf, _fact(spark, sf, between=RANGE))
    return reports.daily_peak(peak, *RANGE)


def q_kpis(spark, sf):
    v = _validation(spark, sf, RANGE)
    fact = materialize(_fact(spark, sf, v))  # three of the four measures read it
    peak, perf = _performance(spark, sf, fact)
    q = v.quarantine
    out = reports.kpis(fact, peak, perf, q, *RANGE, regions=["CLICK", "VIEW"])
    return out.select("latest_measurement_utc", "peak_demand_mw", _r("mean_mae_mw").alias("mean_mae_mw"),
                      "quarantined_rows")


def q_freshness(spark, sf):
    return reports.freshness(_validation(spark, sf).valid_actual, as_of=AS_OF)


def _quality_runs(spark, sf):
    v = _validation(spark, sf)
    return quality.evaluate_runs(v.valid_actual, v.valid_forecast, v.quarantine, "market_date",
                                 F.timestamp_add("DAY", F.lit(1), F.col("market_date").cast("timestamp_ntz")))


def q_quality_outcomes(spark, sf):
    return _quality_runs(spark, sf)


def q_unmatched_fact_rows(spark, sf):
    v = _validation(spark, sf)
    return quality.unmatched_rows(v.valid_actual, v.valid_forecast, "r1", AS_OF)


def q_quality_status(spark, sf):
    return reports.quality_status(materialize(_quality_runs(spark, sf)))


def q_dim_date(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("market_date"))
    return dims.dim_date(orders)


def q_dim_time(spark, sf):
    hours = table(spark, sf, "events").select(F.hour("ts").alias("hour"))
    return dims.dim_time(hours)


def q_dim_entity(spark, sf):
    return dims.dim_entity(_fact(spark, sf)).drop("region_key")


# -- keyed writes -----------------------------------------------------------------------
def _orders_target_source(spark, sf):
    o = table(spark, sf, "orders")
    target = o.where(F.col("o_orderstatus").isin("F", "O"))
    source = (o.where(F.col("o_orderstatus").isin("O", "P"))
              .withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1.0))
              .withColumn("o_orderpriority", F.concat(F.col("o_orderpriority"), F.lit("*"))))
    return o, target, source


def q_insert_only(spark, sf):
    _, target, source = _orders_target_source(spark, sf)
    return tables.insert_only(target, source, ["o_orderkey"])


def q_upsert(spark, sf):
    _, target, source = _orders_target_source(spark, sf)
    return tables.upsert(target, source, ["o_orderkey"])


def q_delete_matching(spark, sf):
    o = table(spark, sf, "orders")
    urgent_dates = o.where(F.col("o_orderpriority") == "1-URGENT").select("o_orderdate")
    return tables.delete_matching(o, urgent_dates, "o_orderdate")


# -- payloads -------------------------------------------------------------------------
def _document_payloads(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.concat(F.lit("documents/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("raw_file_name"),
        F.col("text").alias("raw_payload"))
    return with_lineage(docs, "documents", "documents", "batch-0", ingested_at=AS_OF)


def q_payload_dedup(spark, sf):
    bronze = _document_payloads(spark, sf)
    kept = tables.insert_only(None, bronze, ["record_checksum"])
    return kept.select("record_checksum", "raw_file_name", F.length("raw_payload").alias("payload_chars"))


def q_manifest_reconcile(spark, sf):
    bronze = _document_payloads(spark, sf)
    lines = lambda c: F.size(F.split(F.col(c), "\n")).cast("bigint")
    declared = bronze.select(F.col("raw_file_name").alias("file_name"),
                             lines("raw_payload").alias("declared_rows"),
                             checksum("raw_payload").alias("declared_sha256"))
    landed = tables.insert_only(None, bronze, ["record_checksum"]).select(
        F.col("raw_file_name").alias("file_name"), lines("raw_payload").alias("landed_rows"),
        F.col("record_checksum").alias("landed_sha256"))
    return reconcile(declared, landed).select("file_name", "declared_rows", "landed_rows", "status")


def _iso_local(col: str = "ts"):
    """ISO text of a ``timestamp_ntz`` without going through the session time zone."""
    return F.regexp_replace(F.col(col).cast("string"), " ", "T")


def _event_payload(with_second: bool = True):
    start = _iso_local("ts")
    first = F.to_json(F.struct(F.struct(start.alias("start")).alias("timeInterval"),
                               F.col("event_type").alias("region"), F.col("value").alias("load")))
    return first, start


def q_parse_payloads(spark, sf):
    ev = table(spark, sf, "events")
    first, _ = _event_payload()
    bronze = ev.select(F.col("event_id").cast("string").alias("raw_file_name"),
                       F.concat(F.lit('{"data":['), first, F.lit("]}")).alias("raw_payload"))
    bronze = with_lineage(bronze, "events", D.ACTUAL_DATASET, "batch-0", ingested_at=AS_OF)
    return parse_actual(bronze, EVENTS_DOMAIN.tz, AS_OF).select(
        F.col("raw_file_name").cast("bigint").alias("event_id"), "record_index", "market_date",
        "interval_start_utc", "region", "actual_load_mw")


def q_parse_forecast_payloads(spark, sf):
    ev = table(spark, sf, "events")
    start = _iso_local("ts")
    rec = F.to_json(F.struct(
        F.struct(start.alias("start")).alias("timeInterval"), F.col("event_type").alias("region"),
        F.concat(F.lit("z"), (F.col("user_id") % 10 + 1).cast("string")).alias("localResourceZone"),
        F.col("value").alias("loadForecast"), F.col("ts").cast("date").cast("string").alias("init")))
    bronze = ev.select(F.col("event_id").cast("string").alias("raw_file_name"),
                       F.concat(F.lit('{"data":['), rec, F.lit("]}")).alias("raw_payload"))
    bronze = with_lineage(bronze, "events", D.FORECAST_DATASET, "batch-0", ingested_at=AS_OF)
    return parse_forecast(bronze, EVENTS_DOMAIN.tz, AS_OF).select(
        F.col("raw_file_name").cast("bigint").alias("event_id"), "market_date", "forecast_init_date",
        "interval_start_utc", "region", "local_resource_zone", "load_forecast_mw")


def q_error_observations(spark, sf):
    fact = materialize(_fact(spark, sf))  # read by the thresholds and by the rows held against them
    th = quality.error_thresholds(fact, quantile=0.9, exact=True)
    out = quality.observations(fact, th)
    return out.select("market_date", "interval_start_utc", "region", _r("absolute_error_mw").alias("absolute_error_mw"),
                      _r("error_threshold_mw").alias("error_threshold_mw"))


def q_payload_contract(spark, sf):
    ev = table(spark, sf, "events")
    first, start = _event_payload()
    ti = F.concat(F.lit('{"timeInterval":{"start":"'), start, F.lit('"},'))
    v = F.col("value").cast("string")
    second = (F.when(F.col("event_type") == "error", F.lit('{"region":"x","load":1}'))
              .when(F.col("event_type") == "signup", F.concat(ti, F.lit('"load":"'), v, F.lit('"}')))
              .when((F.col("event_type") == "click") & (F.col("value") > 400), F.concat(ti, F.lit('"load":true}')))
              .when(F.col("event_type") == "purchase", F.concat(ti, F.lit('"load":-'), v, F.lit("}")))
              .otherwise(F.concat(ti, F.lit('"load":'), v, F.lit("}"))))
    payload = (F.when(F.col("value") < 1, F.lit('{"data":[]}'))
               .otherwise(F.concat(F.lit('{"data":['), first, F.lit(","), second, F.lit("]}"))))
    bronze = ev.select(F.col("event_id").alias("raw_file_name"), payload.alias("raw_payload"))
    out = check_payloads(bronze, "load")
    return out.select(F.col("raw_file_name").alias("event_id"), "record_count", "violation_index",
                      "violation", "is_valid")


def q_utc_normalise(spark, sf):
    ev = table(spark, sf, "events")
    utc = local_to_utc("ts", EVENTS_DOMAIN.tz)
    return ev.select("event_id", utc.alias("ts_utc"), local_hour(utc, EVENTS_DOMAIN.tz).alias("local_hour"),
                     utc.cast("date").alias("utc_date"))


def q_price_distribution(spark, sf):
    ev = table(spark, sf, "events").select(F.col("ts").alias("interval_start_utc"),
                                           F.col("value").alias("lmp_usd_per_mwh"))
    out = reports.price_distribution(ev)
    return out.select("interval_hour", "min_value", "max_value",
                      *[_r(c).alias(c) for c in ("p05", "p50", "p95")])


def q_display_numbers(spark, sf):
    o = table(spark, sf, "orders")
    shown = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    return o.select("o_orderkey", shown.alias("shown"), clean_number(shown).alias("parsed_value"))


def q_coverage(spark, sf):
    """Locations = nations mapped to zones = regions; observations = customers by segment."""
    nation = table(spark, sf, "nation")
    customer = table(spark, sf, "customer")
    return facts.coverage(
        customer.select(F.col("c_nationkey").alias("location"), "c_mktsegment"),
        nation.select(F.col("n_nationkey").alias("location"), F.col("n_regionkey").alias("zone")),
        location_col="location", zone_col="zone", by=["c_mktsegment"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "daily_peak": q_daily_peak,
    "dedup_latest": q_dedup_latest,
    "dedup_flags": q_dedup_flags,
    "rule_labels": q_rule_labels,
    "forecast_labels": q_forecast_labels,
    "rule_split_counts": q_rule_split_counts,
    "complete_days": q_complete_days,
    "valid_actual": q_valid_actual,
    "valid_forecast": q_valid_forecast,
    "quarantine_rows": q_quarantine_rows,
    "incomplete_rows": q_incomplete_rows,
    "ordinary_days": q_ordinary_days,
    "fact_compare": q_fact_compare,
    "daily_peak_fact": q_daily_peak_fact,
    "accuracy_daily": q_accuracy_daily,
    "scorecard": q_scorecard,
    "hour_profile": q_hour_profile,
    "actual_vs_forecast": q_actual_vs_forecast,
    "error_trend": q_error_trend,
    "peak_report": q_peak_report,
    "kpis": q_kpis,
    "freshness": q_freshness,
    "quality_outcomes": q_quality_outcomes,
    "quality_status": q_quality_status,
    "unmatched_fact_rows": q_unmatched_fact_rows,
    "dim_date": q_dim_date,
    "dim_time": q_dim_time,
    "dim_entity": q_dim_entity,
    "insert_only": q_insert_only,
    "upsert": q_upsert,
    "delete_matching": q_delete_matching,
    "payload_dedup": q_payload_dedup,
    "manifest_reconcile": q_manifest_reconcile,
    "parse_payloads": q_parse_payloads,
    "parse_forecast_payloads": q_parse_forecast_payloads,
    "payload_contract": q_payload_contract,
    "error_observations": q_error_observations,
    "utc_normalise": q_utc_normalise,
    "price_distribution": q_price_distribution,
    "display_numbers": q_display_numbers,
    "coverage": q_coverage,
}

# the write path, streams and staged layouts; feeds and faulty payloads
from lakemeter.plans import registry_feeds, registry_store  # noqa: E402

QUERIES.update(registry_store.QUERIES)
QUERIES.update(registry_feeds.QUERIES)
