"""The lakehouse: Bronze -> Silver -> gate -> Gold, composed from the operators.

Silver is validated over every Bronze row of the dates in scope, because latest-wins and
completeness are facts about a whole date, not about one batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemeter import domain as D
from lakemeter.operators import completeness as C
from lakemeter.operators import dims, facts, quality
from lakemeter.operators.dedup import flag_latest
from lakemeter.operators.rules import REASON, first_failure, non_finite, outside_domain, to_quarantine
from lakemeter.plans.tables import TableStore
from lakemeter.session import materialize, materialize_all
from lakemeter.sources.parse import parse_actual, parse_forecast, record_dates
from lakemeter.sources.payloads import scan_payloads

# greatest wins: newest ingestion (NULL last), then batch, file and record position
LATEST_ORDER = ("ingestion_timestamp_utc", "batch_id", "raw_file_name", "record_index")


@dataclass(frozen=True)
class MarketDomain:
    tz: str = D.MARKET_TIMEZONE
    regions: tuple = D.EXPECTED_REGIONS
    zones: tuple = D.EXPECTED_ZONES


@dataclass(frozen=True)
class RuleOptions:
    rank_before_rules: bool = True   # a newer invalid row still outranks an older valid one
    strict_domain: bool = False      # flag NULL region/zone as unexpected
    non_finite: bool = False         # reject NaN / infinite measurements
    per_publication: bool = False    # judge completeness per forecast publication


@dataclass(frozen=True)
class QualityOptions:
    batch_nonempty: bool = False      # also require valid rows from this run's own batch
    quarantine_blocking: bool = False  # treat any quarantined row as a blocking failure


@dataclass
class Validation:
    labelled_actual: DataFrame
    labelled_forecast: DataFrame
    valid_actual: DataFrame
    valid_forecast: DataFrame
    quarantine: DataFrame
    completeness: DataFrame


def measurement_rules(value_col: str, negative_name: str, entity_col: str, allowed: Sequence[str],
                      unexpected_name: str, options: RuleOptions) -> list[tuple[str, Column]]:
    v = F.col(value_col)
    rules = [(D.INVALID_TIMESTAMP, F.col("interval_start_utc").isNull()),
             (D.MISSING_MEASUREMENT, v.isNull())]
    if options.non_finite:
        rules.append((D.NON_FINITE, non_finite(v)))
    rules += [(negative_name, v < 0),
              (unexpected_name, outside_domain(entity_col, allowed, options.strict_domain))]
    return rules


def label_rows(rows: DataFrame, keys: Sequence[str], rules: list[tuple[str, Column]],
               options: RuleOptions, order: Sequence[str] = LATEST_ORDER) -> DataFrame:
    """Rows with ``quarantine_reason`` (first failing rule, duplicates last)."""
    dup = (D.DUPLICATE_BUSINESS_KEY, ~F.col("is_latest"))
    if options.rank_before_rules:
        return flag_latest(rows, keys, order).withColumn(REASON, first_failure([*rules, dup])) \
            .drop("is_latest")
    pre = rows.withColumn(REASON, first_failure(rules))
    passing = flag_latest(pre.where(F.col(REASON).isNull()), keys, order) \
        .withColumn(REASON, first_failure([dup])).drop("is_latest")
    return passing.unionByName(pre.where(F.col(REASON).isNotNull()))


def validate_pair(actual: DataFrame, forecast: DataFrame, dom: MarketDomain = MarketDomain(),
                  options: RuleOptions = RuleOptions(), as_of=None,
                  persist: bool = False) -> Validation:
    """Label both datasets, find the complete dates, and route every row exactly once.

    Each labelled frame has two consumers only: the per-date profile (a small aggregate)
    and one left join with the complete-date set, which gives rule-passing rows on other
    dates the reason ``INCOMPLETE_MARKET_DATE``.  Valid and quarantined rows are then two
    filters of the same frame.
    """
    a_rules = measurement_rules("actual_load_mw", D.NEGATIVE_LOAD, "region", dom.regions,
                                D.UNEXPECTED_REGION, options)
    f_rules = measurement_rules("load_forecast_mw", D.NEGATIVE_FORECAST, "local_resource_zone",
                                dom.zones, D.UNEXPECTED_ZONE, options)
    a_lab = label_rows(actual, D.ACTUAL_KEYS, a_rules, options)
    f_lab = label_rows(forecast, D.FORECAST_KEYS, f_rules, options)
    if persist:  # reused by the profile and the routing join: compute once
        a_lab, f_lab = materialize_all(a_lab, f_lab)
    passing = F.col(REASON).isNull()
    # rule-passing rows: entities are in the domain (or NULL), intervals within one day
    if options.per_publication:
        profile = C.publication_completeness(a_lab.where(passing), f_lab.where(passing),
                                             expected_actual=len(dom.regions),
                                             expected_forecast=len(dom.zones))
        pubs = profile.where("is_complete").select("market_date", "forecast_init_date")
        f_keys = pubs.withColumn("_complete", F.lit(True))  # publications a day have no bound: no hint
        dates = C.date_set(pubs.select("market_date").distinct().withColumn("_complete", F.lit(True)))
    else:
        profile = C.paired_completeness(a_lab.where(passing), f_lab.where(passing),
                                        expected_actual=len(dom.regions), expected_forecast=len(dom.zones),
                                        bounded=True)
        dates = C.date_set(C.complete_dates(profile).withColumn("_complete", F.lit(True)))
        f_keys = dates

    def route(labelled: DataFrame, keys: DataFrame) -> DataFrame:
        reason = F.when(F.col(REASON).isNull() & F.col("_complete").isNull(),
                        F.lit(D.INCOMPLETE_MARKET_DATE)).otherwise(F.col(REASON))
        on = [c for c in keys.columns if c != "_complete"]
        return (labelled.join(keys, on, "left")
                .withColumn(REASON, reason).drop("_complete", "record_index"))

    a_all, f_all = route(a_lab, dates), route(f_lab, f_keys)
    rejected = F.col(REASON).isNotNull()
    quarantine = to_quarantine(a_all.where(rejected), D.ACTUAL_DATASET, "actual_load_mw",
                               as_of=as_of).unionByName(
        to_quarantine(f_all.where(rejected), D.FORECAST_DATASET, "load_forecast_mw",
                      zone_col="local_resource_zone", as_of=as_of))
    return Validation(a_lab, f_lab, a_all.where(passing).drop(REASON),
                      f_all.where(passing).drop(REASON), quarantine, profile)


@dataclass
class Lakehouse:
    """Table names of one deployment on a ``TableStore``."""
    store: TableStore
    dom: MarketDomain = field(default_factory=MarketDomain)

    ACTUAL_RAW = D.table_name("bronze", "actual_load_raw")
    FORECAST_RAW = D.table_name("bronze", "load_forecast_raw")
    ACTUAL_FILE_DATES = D.table_name("bronze", "actual_load_file_dates")
    FORECAST_FILE_DATES = D.table_name("bronze", "load_forecast_file_dates")
    ACTUAL = D.table_name("silver", "actual_load_hourly")
    FORECAST = D.table_name("silver", "load_forecast_hourly")
    QUARANTINE = D.table_name("silver", "quarantined_records")
    QUALITY = D.table_name("ops", "data_quality_results")
    FACT = D.table_name("gold", "fact_energy_load")
    DIM_DATE = D.table_name("gold", "dim_date")
    DIM_REGION = D.table_name("gold", "dim_region")
    DIM_TIME = D.table_name("gold", "dim_time")
    PEAK = D.table_name("gold", "daily_peak_demand")
    PERFORMANCE = D.table_name("gold", "regional_forecast_performance")

    @staticmethod
    def partitioning() -> dict[str, str]:
        return {Lakehouse.ACTUAL_RAW: "landing_date", Lakehouse.FORECAST_RAW: "landing_date",
                Lakehouse.ACTUAL_FILE_DATES: "market_date", Lakehouse.FORECAST_FILE_DATES: "market_date",
                Lakehouse.ACTUAL: "market_date", Lakehouse.FORECAST: "market_date",
                Lakehouse.FACT: "market_date"}

    @classmethod
    def at(cls, spark: SparkSession, root: str, dom: MarketDomain = MarketDomain()) -> Lakehouse:
        return cls(TableStore(spark, root, cls.partitioning()), dom)

    def _raw(self, dataset: str) -> tuple[str, str]:
        if dataset == D.ACTUAL_DATASET:
            return self.ACTUAL_RAW, self.ACTUAL_FILE_DATES
        return self.FORECAST_RAW, self.FORECAST_FILE_DATES

    # -- Bronze -------------------------------------------------------------------------
    def ingest(self, path: str, dataset: str, batch_id: str, source_name: str = "market",
               ingested_at=None) -> dict:
        frame = scan_payloads(self.store.spark, path, source_name, dataset, batch_id, ingested_at)
        return self.ingest_frame(frame, dataset)

    def ingest_frame(self, bronze: DataFrame, dataset: str) -> dict:
        """Insert-only on the checksum into Bronze, partitioned by landing date.

        The index (market date -> files and their landing dates) is written before the rows: an attempt that
        fails in between leaves entries without rows, which select nothing, and its replay adds its own."""
        table, index = self._raw(dataset)
        schema = D.actual_payload_schema() if dataset == D.ACTUAL_DATASET else D.forecast_payload_schema()
        landed = bronze.withColumn("landing_date", F.col("ingestion_timestamp_utc").cast("date"))
        return self.store.insert_only(table, landed, ["record_checksum"], before=lambda rows: self.store.append(
            index, record_dates(rows, schema, keep=("record_checksum", "landing_date", "batch_id"), unique=True)))

    def bronze_for_dates(self, dataset: str, dates: DataFrame) -> DataFrame:
        """Bronze rows of the files holding any of ``dates`` (a file with a NULL date, i.e.
        unparsable, is included whenever it exists, so its evidence is never lost).

        The index gives the landing dates of those files; only these partitions of Bronze are read.  A partition
        whose files all hold such dates is taken whole, without a join.  All lists hold calendar dates, so they
        are as small as ``completeness.date_set``."""
        table, index = self._raw(dataset)
        bronze = self.store.read(table)
        if not self.store.exists(index):
            return bronze
        wanted = [r[0] for r in dates.select("market_date").where(F.col("market_date").isNotNull()).distinct().collect()]
        day = F.col("market_date")
        of_dates = day.isNull() | (day.isin(wanted) if wanted else F.lit(False))
        entries = self.store.read(index)
        landed = entries.groupBy("landing_date").agg(F.max(of_dates).alias("some"), F.min(of_dates).alias("all")).where("some").collect()
        whole, part = ([r["landing_date"] for r in landed if r["landing_date"] is not None and r["all"] == x] for x in (True, False))
        on = F.col("landing_date")
        rows = bronze.where((on.isin(whole) if whole else F.lit(False)) & F.col("record_checksum").isNotNull())
        if not part:
            return rows
        files = entries.where(on.isin(part) & of_dates)
        return rows.unionByName(bronze.where(on.isin(part)).join(files.select("record_checksum").distinct(), "record_checksum", "left_semi")
                                .select(*bronze.columns))

    def batch_dates(self, dataset: str, batch_id: str) -> DataFrame:
        """Market dates touched by the files of one Bronze batch."""
        if not self.store.exists(self._raw(dataset)[1]):
            return self.store.spark.createDataFrame([], "market_date date")
        index = self.store.read(self._raw(dataset)[1])
        return index.where(F.col("batch_id") == batch_id).select("market_date").distinct()

    # -- Silver -------------------------------------------------------------------------
    def build_silver(self, run_id: str, as_of=None, options: RuleOptions = RuleOptions(),
                     dates: DataFrame | None = None, checks: QualityOptions = QualityOptions(),
                     batch_id: str | None = None) -> Validation:
        """Validate Bronze (all of it, or every row of the given market dates) and publish."""
        if dates is None:
            a_raw, f_raw = self.store.read(self.ACTUAL_RAW), self.store.read(self.FORECAST_RAW)
        else:  # only the files holding those dates are parsed
            a_raw = self.bronze_for_dates(D.ACTUAL_DATASET, dates)
            f_raw = self.bronze_for_dates(D.FORECAST_DATASET, dates)
        actual = parse_actual(a_raw, self.dom.tz, as_of)
        forecast = parse_forecast(f_raw, self.dom.tz, as_of)
        if dates is not None:
            # rows without a date are evidence of every run: quarantine keeps them once
            wanted = C.date_set(dates.select("market_date").where(F.col("market_date").isNotNull())
                                .distinct().withColumn("_wanted", F.lit(True)))
            of_run = F.col("_wanted") | F.col("market_date").isNull()
            actual = actual.join(wanted, "market_date", "left").where(of_run).drop("_wanted")
            forecast = forecast.join(wanted, "market_date", "left").where(of_run).drop("_wanted")
        v = validate_pair(actual, forecast, self.dom, options, as_of, persist=True)
        valid_a, valid_f, quarantine = materialize_all(v.valid_actual, v.valid_forecast, v.quarantine)
        v = Validation(v.labelled_actual, v.labelled_forecast, valid_a, valid_f, quarantine, v.completeness)
        self.publish_silver(v)
        # non-empty output is judged on the published Silver tables (all dates), as in a full
        # rebuild; the quarantine count is this run's
        results = quality.evaluate(self.store.read(self.ACTUAL), self.store.read(self.FORECAST),
                                   quarantine, run_id, as_of)
        if checks.quarantine_blocking:
            results = results.where(F.col("rule_name") != "quarantined_rows").unionByName(
                quality.count_rule(quarantine, run_id, "historical_load", "quarantined_rows",
                                   blocking=True, fail_when_empty=False, evaluated_at=as_of))
        if checks.batch_nonempty and batch_id is not None:
            for name, valid in (("actual_load_hourly", valid_a), ("load_forecast_hourly", valid_f)):
                results = results.unionByName(quality.count_rule(
                    valid.where(F.col("batch_id") == batch_id), run_id, name, "nonempty_batch_output",
                    blocking=True, fail_when_empty=True, evaluated_at=as_of))
        self.store.insert_only(self.QUALITY, results, list(D.QUALITY_KEYS))
        return v

    def publish_silver(self, v: Validation) -> None:
        q = v.quarantine
        for table, valid, name in ((self.ACTUAL, v.valid_actual, D.ACTUAL_DATASET),
                                   (self.FORECAST, v.valid_forecast, D.FORECAST_DATASET)):
            affected = valid.select("market_date").unionByName(
                q.where(F.col("dataset_name") == name).select("market_date")) \
                .where(F.col("market_date").isNotNull()).distinct()
            # delete the affected dates, then upsert the valid rows == make those dates hold them
            self.store.replace_partitions(table, valid, affected)
        if not q.isEmpty():
            # every rejected row is evidence: rows that share a key are all kept, a rerun adds none
            self.store.insert_only(self.QUARANTINE, q, list(D.QUARANTINE_KEYS), keep_repeats=True)

    def fact_between(self, start=None, end=None, as_of=None) -> DataFrame:
        """The fact of a date range straight from Silver, ahead of Gold: the range prunes the partitions of
        both sides."""
        day = F.col("market_date")
        sides = []
        for table in (self.ACTUAL, self.FORECAST):
            rows = self.store.read(table)
            rows = rows if start is None else rows.where(day >= F.lit(start).cast("date"))
            sides.append(rows if end is None else rows.where(day <= F.lit(end).cast("date")))
        return facts.compare(*sides, self.dom.tz, as_of)

    # -- gate + Gold --------------------------------------------------------------------
    def gate(self) -> int:
        return quality.gate(self.store.read(self.QUALITY))

    def build_gold(self, as_of=None, dates: DataFrame | None = None) -> DataFrame:
        """Gate, then build Gold from Silver: everything, or only the given market dates.

        With ``dates`` only those Silver partitions are read (the date set is broadcast, so
        the scan is pruned), their fact partitions are replaced (a date that left Silver
        leaves Gold), the small daily tables are rewritten without those dates plus their
        new rows, and the dimensions are upserted.
        """
        self.gate()
        spark = self.store.spark
        actual, forecast = self.store.read(self.ACTUAL), self.store.read(self.FORECAST)
        wanted = None
        if dates is not None and self.store.exists(self.FACT):
            wanted = C.date_set(dates.select("market_date").where(F.col("market_date").isNotNull()).distinct())
            actual = actual.join(wanted, "market_date", "left_semi")
            forecast = forecast.join(wanted, "market_date", "left_semi")
        fact = materialize(facts.compare(actual, forecast, self.dom.tz, as_of))
        stats = materialize(facts.daily_stats(fact))  # small; feeds two tables
        peak, perf = facts.split_daily_stats(stats, as_of)
        if wanted is None:
            self.store.overwrite(self.FACT, fact)
            self.store.overwrite(self.DIM_DATE, dims.dim_date(fact))
            self.store.overwrite(self.DIM_REGION, dims.dim_entity(fact))
            self.store.overwrite(self.DIM_TIME, dims.dim_time(spark))
            self.store.overwrite(self.PEAK, peak)
            self.store.overwrite(self.PERFORMANCE, perf)
            return fact
        self.store.replace_partitions(self.FACT, fact, wanted)
        for table, frame in ((self.PEAK, peak), (self.PERFORMANCE, perf)):
            kept = self.store.read(table).join(wanted, "market_date", "left_anti")
            self.store.overwrite(table, kept.unionByName(frame))
        self.store.upsert(self.DIM_DATE, dims.dim_date(fact), ["date_key"])
        self.store.upsert(self.DIM_REGION, dims.dim_entity(fact), ["region_key"])
        if not self.store.exists(self.DIM_TIME):
            self.store.overwrite(self.DIM_TIME, dims.dim_time(spark))
        return fact
