"""Registered queries of stored tables: keyed writes, the whole lakehouse run, kept states, streams."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemeter import domain as D
from lakemeter.operators import completeness as C
from lakemeter.operators import facts, quality
from lakemeter.operators.dedup import flag_staged, stage_by_key
from lakemeter.operators.quality import BlockingFailure
from lakemeter.plans.bindings import (AS_OF, BIN_HOURS, EVENTS_DOMAIN, events_actual, events_forecast, table)
from lakemeter.plans.lakehouse import (Lakehouse, RuleOptions, label_rows, measurement_rules, validate_pair)
from lakemeter.plans.tables import scratch_store
from lakemeter.session import Scratch, checkpoint_dir, materialize, settle
from lakemeter.sources.parse import parse_actual, parse_forecast
from lakemeter.sources.payloads import with_lineage
from lakemeter.streaming.incremental import interval_aggregate

# fixed values of these queries
ORDERS = "silver.orders"
FIRST_BATCH_END = "2024-01-16"     # market data that the first ingest holds
HELD_BACK = 50                     # one event id in so many of the first days arrives with the second ingest
HELD_BACK_END = "2024-01-06"
STATE_HOURS = 7                    # width of a batch of the kept completeness state; cuts through intervals
STREAM_CUTS = ("2024-01-11", "2024-01-21")
STREAM_LATE = 10                   # one event id in so many of the first stretch arrives with the last
SKETCH_SIZE = 400
LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey"]


# -- keyed writes, written to catalog tables and read back ------------------------------------
def _orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with the year that partitions them; some have none."""
    year = F.when(F.col("o_orderpriority") != "5-LOW", F.year("o_orderdate"))
    return table(spark, sf, "orders").withColumn("o_year", year.cast("int"))


def _changes(orders: DataFrame) -> DataFrame:
    """Changed rows: new values, and for some another year or none."""
    key = F.col("o_orderkey")
    year = F.when(key % 7 == 0, F.lit(None)).when(key % 3 == 0, F.col("o_year") + 1).otherwise(F.col("o_year"))
    return orders.where(F.col("o_orderstatus").isin("O", "P")).withColumns(
        {"o_totalprice": F.col("o_totalprice") + 1.0, "o_year": year.cast("int")})


def _written(spark: SparkSession, sf: str, change: Callable) -> DataFrame:
    orders = _orders(spark, sf)
    with scratch_store(spark, {ORDERS: "o_year"}) as store:
        store.overwrite(ORDERS, orders.where(F.col("o_orderstatus").isin("F", "O")))
        change(store, orders)
        return settle(store.read(ORDERS))


def q_store_upsert(spark, sf):
    """Changed rows replace stored ones, also where the key has moved to another partition or to none."""
    return _written(spark, sf, lambda store, orders: store.upsert(ORDERS, _changes(orders), ["o_orderkey"]))


def q_store_insert_only(spark, sf):
    """New keys are appended; a key that the source repeats comes once, with its greatest row."""
    def change(store, orders):
        new = _changes(orders)
        again = new.where(F.col("o_orderkey") % 5 == 0).withColumn("o_totalprice", F.col("o_totalprice") + 2.0)
        store.insert_only(ORDERS, new.unionByName(again), ["o_orderkey"])
    return _written(spark, sf, change)


def q_store_replace(spark, sf):
    """Affected partitions hold exactly the new content: some are rewritten, some vanish, others stay."""
    def change(store, orders):
        held = store.read(ORDERS)
        affected = held.where(F.col("o_year").isNull() | (F.col("o_year") % 3 == 0))
        content = held.where((F.col("o_year") % 6 == 0) & (F.col("o_orderstatus") == "O")).withColumn(
            "o_totalprice", F.col("o_totalprice") * 2)
        store.replace_partitions(ORDERS, content, affected)
    return _written(spark, sf, change)


def q_store_delete(spark, sf):
    """Rows of some dates go (only their partitions are rewritten), then whole partitions."""
    def change(store, orders):
        store.delete_matching(ORDERS, orders.where(F.col("o_orderpriority") == "1-URGENT"), "o_orderdate")
        store.delete_matching(ORDERS, orders.where(F.col("o_year") % 4 == 1), "o_year")
    return _written(spark, sf, change)


def q_store_overwrite(spark, sf):
    """A table replaced by a frame that reads it, partitioned and not."""
    with scratch_store(spark, {ORDERS: "o_year"}) as store:
        for name in (ORDERS, "gold.orders"):
            store.overwrite(name, _orders(spark, sf))
            held = store.read(name)
            store.overwrite(name, held.where((F.col("o_year") % 2 == 0) | F.col("o_year").isNull()))
        both = [store.read(n).select(F.lit(n).alias("stored"), "o_orderkey", "o_totalprice", "o_year") for n in (ORDERS, "gold.orders")]
        return settle(both[0].unionByName(both[1]))


# -- the lakehouse run --------------------------------------------------------------------------
def _payload_events(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Events as landed payloads of one record: Bronze of measurements and of forecasts."""
    ev = table(spark, sf, "events")
    shown = lambda c: F.regexp_replace(c.cast("string"), " ", "T")
    bin_ = F.make_timestamp_ntz(F.year("ts"), F.month("ts"), F.dayofmonth("ts"), F.hour("ts") - F.hour("ts") % BIN_HOURS, F.lit(0), F.lit(0))
    next_day = F.timestamp_add("DAY", F.lit(1), bin_)

    def interval(start):
        return F.struct(shown(start).alias("start"), shown(F.timestamp_add("HOUR", F.lit(BIN_HOURS), start)).alias("end"),
                        (F.hour(start) / BIN_HOURS + 1).cast("int").cast("string").alias("value")).alias("timeInterval")

    actual = F.struct(interval(bin_), F.col("event_type").alias("region"), F.col("value").alias("load"))
    forecast = F.struct(interval(next_day), F.col("event_type").alias("region"),
                        F.concat(F.lit("z"), (F.col("user_id") % 10 + 1).cast("string")).alias("localResourceZone"),
                        F.col("value").alias("loadForecast"), F.col("ts").cast("date").cast("string").alias("init"))
    out = []
    for dataset, record in ((D.ACTUAL_DATASET, actual), (D.FORECAST_DATASET, forecast)):
        payload = F.to_json(F.struct(F.array(record).alias("data"), F.col("event_id").alias("page")))
        rows = ev.select(F.concat(F.lit("events/"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("raw_file_name"),
                         payload.alias("raw_payload"), "ts", "event_id")
        bronze = with_lineage(rows, "events", dataset, "-")
        day = F.date_format(rows["ts"].cast("date"), "yyyyMMdd")
        out.append(rows.select(*[F.lit(x).alias(n) for n, x in (("source_name", "events"), ("dataset_name", dataset))],
                               F.col("ts").alias("ingestion_timestamp_utc"), F.concat(F.lit("events-"), day).alias("batch_id"),
                               "raw_file_name", "raw_payload", F.sha2("raw_payload", 256).alias("record_checksum"), "event_id")
                   .select(*bronze.columns, "event_id"))
    return out[0], out[1]


def _is_first(bronze: DataFrame) -> DataFrame:
    ts = F.col("ingestion_timestamp_utc")
    held = (F.col("event_id") % HELD_BACK == 0) & (ts < F.lit(HELD_BACK_END).cast("timestamp_ntz"))
    return (ts < F.lit(FIRST_BATCH_END).cast("timestamp_ntz")) & ~held


def run_lakehouse(spark: SparkSession, sf: str, house: Lakehouse) -> None:
    """Two ingests of payloads; the second brings new dates and late rows of old ones.  Silver is built
    whole, then for the dates that the second ingest touches; Gold follows where the gate is open."""
    bronze = dict(zip((D.ACTUAL_DATASET, D.FORECAST_DATASET), _payload_events(spark, sf)))
    parse = {D.ACTUAL_DATASET: parse_actual, D.FORECAST_DATASET: parse_forecast}
    for run in (1, 2):
        dates = None
        for dataset, rows in bronze.items():
            some = rows.where(_is_first(rows) if run == 1 else ~_is_first(rows)).drop("event_id")
            house.ingest_frame(some, dataset)
            if run == 2:
                touched = parse[dataset](some, house.dom.tz, AS_OF).select("market_date").distinct()
                dates = touched if dates is None else dates.unionByName(touched)
        dates = None if dates is None else materialize(dates.distinct())
        house.build_silver(f"run{run}", as_of=f"2024-02-{14 + run:02d} 00:00:00", dates=dates)
        try:
            house.build_gold(AS_OF, dates)
        except BlockingFailure:
            pass  # no complete date yet


def _house(spark: SparkSession, store) -> Lakehouse:
    store.partitions.update(Lakehouse.partitioning())
    return Lakehouse(store, EVENTS_DOMAIN)


def q_lakehouse_fact(spark, sf):
    """Landed payloads -> Bronze -> Silver in two increments -> Gold: the stored fact."""
    with scratch_store(spark) as store:
        house = _house(spark, store)
        run_lakehouse(spark, sf, house)
        fact = store.read(house.FACT) if store.exists(house.FACT) else house.fact_between(as_of=AS_OF).limit(0)
        r = lambda c: F.round(c, 6).alias(c)
        return settle(fact.select("market_date", "forecast_init_date", "interval_start_utc", "region", "actual_load_mw", r("forecast_load_mw"),
                                  r("forecast_error_mw"), r("absolute_error_mw"), r("absolute_percentage_error"), "date_key", "hour"))


def q_lakehouse_quality(spark, sf):
    """The outcomes that both runs have stored, and what the gate says after the last."""
    with scratch_store(spark) as store:
        house = _house(spark, store)
        run_lakehouse(spark, sf, house)
        results = store.read(house.QUALITY)
        gate = quality.gate_status(results).select(
            F.lit("gate").alias("run_id"), F.lit("gate").alias("dataset_name"), F.lit("no_blocking_failure").alias("rule_name"),
            F.col("failures").alias("failed_row_count"), F.when(F.col("is_open"), "PASS").otherwise("FAIL").alias("status"),
            F.lit(True).alias("is_blocking"), F.lit(AS_OF).cast("timestamp_ntz").alias("evaluated_at_utc"))
        return settle(results.unionByName(gate))


# -- kept states -----------------------------------------------------------------------------------
def q_complete_days_kept(spark, sf):
    """Completeness from bitmaps that batches of events add to a table; no batch reads older rows."""
    ev = table(spark, sf, "events")
    opts = RuleOptions()
    batch = F.floor(F.timestamp_diff("HOUR", F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'"), F.col("ingestion_timestamp_utc")) / STATE_HOURS)
    a_rules = measurement_rules("actual_load_mw", D.NEGATIVE_LOAD, "region", EVENTS_DOMAIN.regions, D.UNEXPECTED_REGION, opts)
    f_rules = measurement_rules("load_forecast_mw", D.NEGATIVE_FORECAST, "local_resource_zone", EVENTS_DOMAIN.zones, D.UNEXPECTED_ZONE, opts)
    with scratch_store(spark) as store:
        # each batch ranks its own rows only: the batch number is part of the business key
        for name, rows, keys, rules, entity, publication in (
                ("silver.actual_cells", events_actual(ev), D.ACTUAL_KEYS, a_rules, "region", None),
                ("silver.forecast_cells", events_forecast(ev), D.FORECAST_KEYS, f_rules, "local_resource_zone", "forecast_init_date")):
            labelled = label_rows(rows.withColumn("_batch", batch), [*keys, "_batch"], rules, opts)
            store.append(name, C.cell_bitmaps(labelled, F.col("_batch"), entity_col=entity, publication_col=publication))
        a = C.bitmap_profile(C.merge_bitmaps(store.read("silver.actual_cells")), ("actual_rows", "actual_intervals", "region_count"))
        f = C.bitmap_profile(C.merge_bitmaps(store.read("silver.forecast_cells")), ("forecast_rows", "forecast_intervals", "zone_count"))
        return settle(C.paired_profile(a, f, len(EVENTS_DOMAIN.regions), len(EVENTS_DOMAIN.zones)))


def q_error_sketches(spark, sf):
    """Thresholds from sketches stored per region and date, held against exact percentiles: the share of rows
    at or below each threshold is within the sketch's bound of the quantile."""
    ev = table(spark, sf, "events")
    v = validate_pair(events_actual(ev), events_forecast(ev), EVENTS_DOMAIN, RuleOptions(), AS_OF, persist=True)
    fact = materialize(facts.compare(v.valid_actual, v.valid_forecast, EVENTS_DOMAIN.tz, AS_OF))
    with scratch_store(spark) as store:
        store.append("ops.error_sketches", quality.error_sketches(fact, size=SKETCH_SIZE))
        parts = []
        for q in (0.5, 0.9, 0.99):
            found = quality.thresholds_from_sketches(store.read("ops.error_sketches"), quantile=q, size=SKETCH_SIZE)
            parts.append(found.withColumn("quantile", F.lit(q)))
        found = parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumnRenamed("region", "_region")
        below = (F.col("absolute_error_mw") < F.col("error_threshold_mw")).cast("int")
        upto = (F.col("absolute_error_mw") <= F.col("error_threshold_mw")).cast("int")
        held = fact.where(F.col("absolute_error_mw").isNotNull()).join(found, fact["region"] == found["_region"])
        ranks = held.groupBy("region", "quantile", "error_rows").agg(F.avg(below).alias("low"), F.avg(upto).alias("high"), F.count(F.lit(1)).alias("rows"))
        bound = quality.SKETCH_ERROR / SKETCH_SIZE + 1 / F.col("rows")
        within = (F.col("low") <= F.col("quantile") + bound) & (F.col("high") >= F.col("quantile") - bound)
        return settle(ranks.select("region", "quantile", "error_rows", within.alias("within_bound")))


def q_dedup_staged(spark, sf):
    """Latest rows of a table laid out by business key: no exchange after the staging."""
    with scratch_store(spark) as store:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        staged = stage_by_key(table(spark, sf, "lineitem").select(*LINE_KEYS, *LINE_ORDER), store.name("silver.lines"), LINE_KEYS, buckets)
        return settle(flag_staged(staged, LINE_ORDER))


# -- streams ---------------------------------------------------------------------------------------
def q_stream_intervals(spark, sf):
    """Daily aggregates of a replayed stream: three stretches of events as three micro-batches.  The
    second repeats rows of the first, which the state store drops; the third brings rows of the first, which
    are too late where the watermark has passed them."""
    ev = table(spark, sf, "events")
    at = lambda day: F.lit(day).cast("timestamp_ntz")
    one = F.col("ts") < at(STREAM_CUTS[0])
    two = (F.col("ts") >= at(STREAM_CUTS[0])) & (F.col("ts") < at(STREAM_CUTS[1]))
    late = F.col("event_id") % STREAM_LATE == 0
    near = (F.col("ts") >= F.timestamp_add("HOUR", F.lit(-20), at(STREAM_CUTS[0]))) & one & ~late
    stretches = (ev.where(one & ~late), ev.where(two).unionByName(ev.where(near)),
                 ev.where(~one & ~two).unionByName(ev.where(one & late)))
    root = f"{checkpoint_dir(spark).rstrip('/')}/lakemeter-stream-{uuid.uuid4().hex}"
    with Scratch(spark) as scratch:
        scratch.root = root
        for rows in stretches:  # one file each, in this order
            rows.coalesce(1).write.mode("append").parquet(f"{root}/landed")
        stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/landed")
        agg = interval_aggregate(stream, "ts", ["event_type"], "value", window="1 day", watermark="1 day", dedup_cols=["event_id"])
        query = (agg.writeStream.outputMode("append").format("parquet").option("path", f"{root}/intervals")
                 .option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start())
        query.awaitTermination()
        out = spark.read.schema(agg.schema).parquet(f"{root}/intervals")
        return settle(out.select("window_start", "event_type", "rows", F.round("total", 6).alias("total"), "peak"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "store_upsert": q_store_upsert,
    "store_insert_only": q_store_insert_only,
    "store_replace": q_store_replace,
    "store_delete": q_store_delete,
    "store_overwrite": q_store_overwrite,
    "lakehouse_fact": q_lakehouse_fact,
    "lakehouse_quality": q_lakehouse_quality,
    "complete_days_kept": q_complete_days_kept,
    "error_sketches": q_error_sketches,
    "dedup_staged": q_dedup_staged,
    "stream_intervals": q_stream_intervals,
}
