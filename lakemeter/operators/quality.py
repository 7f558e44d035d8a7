"""Rule outcomes, latest-run selection, the blocking gate and non-blocking observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemeter.functions.timeutil import utc_now

RESULT_COLUMNS = ("run_id", "dataset_name", "rule_name", "failed_row_count", "status",
                  "is_blocking", "evaluated_at_utc")


#: normalised rank error of a sketch times its size, one quantile
SKETCH_ERROR = 2.3


class BlockingFailure(RuntimeError):
    """The latest quality run has a blocking failure (or there is no run at all)."""


def _count(df: DataFrame, tag: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(tag).alias("tag"), "n")


def evaluate(valid_actual: DataFrame, valid_forecast: DataFrame, quarantine: DataFrame,
             run_id, evaluated_at=None, actual_name: str = "actual_load_hourly",
             forecast_name: str = "load_forecast_hourly",
             quarantine_name: str = "historical_load") -> DataFrame:
    """Three outcome rows from one job: non-empty valid output per dataset (blocking) and the
    quarantined row count (warning only).  ``run_id`` may be a string or a column."""
    counts = _count(valid_actual, "a").unionByName(_count(valid_forecast, "f")).unionByName(_count(quarantine, "q"))
    tag, n = F.col("tag"), F.col("n")
    is_q = tag == "q"
    rid = F.lit(run_id) if isinstance(run_id, str) else run_id
    return counts.select(
        rid.cast("string").alias("run_id"),
        F.when(tag == "a", actual_name).when(tag == "f", forecast_name).otherwise(quarantine_name).alias("dataset_name"),
        F.when(is_q, "quarantined_rows").otherwise("nonempty_valid_output").alias("rule_name"),
        F.when(is_q, n).otherwise(F.when(n > 0, 0).otherwise(1)).cast("bigint").alias("failed_row_count"),
        F.when(is_q, F.when(n == 0, "PASS").otherwise("WARN"))
         .otherwise(F.when(n > 0, "PASS").otherwise("FAIL")).alias("status"),
        (~is_q).alias("is_blocking"),
        (evaluated_at if isinstance(evaluated_at, Column) else utc_now(evaluated_at)).alias("evaluated_at_utc"),
    )


def latest_run(results: DataFrame, time_col: str = "evaluated_at_utc") -> DataFrame:
    """Rows of the most recent evaluation.  The maximum is a one-row aggregate, so
    broadcasting it is bounded by construction; no unpartitioned window is needed."""
    newest = results.agg(F.max(time_col).alias("_newest"))
    return (results.join(F.broadcast(newest), F.col(time_col) == F.col("_newest"), "inner")
            .drop("_newest"))


def gate_status(results: DataFrame) -> DataFrame:
    """One row about the latest run: its rules, its blocking failures, and whether publication may go on."""
    failed = F.when((F.col("status") == "FAIL") & F.col("is_blocking"), 1).otherwise(0)
    counts = latest_run(results).agg(F.count(F.lit(1)).alias("rules"), F.coalesce(F.sum(failed), F.lit(0)).cast("long").alias("failures"))
    return counts.withColumn("is_open", (F.col("rules") > 0) & (F.col("failures") == 0))


def gate(results: DataFrame) -> int:
    """Raise if the latest run has a blocking FAIL, or if no run exists; else return its size."""
    row = gate_status(results).first()
    if not row["rules"]:
        raise BlockingFailure("no evaluated data-quality run")
    if row["failures"]:
        raise BlockingFailure(f"data quality failed with {row['failures']} blocking rule(s)")
    return int(row["rules"])


def error_thresholds(fact: DataFrame, keys=("region",), quantile: float = 0.99,
                     accuracy: int = 10000, exact: bool = False) -> DataFrame:
    """Per key: the ``quantile`` of absolute error from history.

    Default is a mergeable sketch (``percentile_approx``), combined map-side however hot a
    key is; ``exact`` gives the interpolated percentile (see ``stats.exact_percentiles``).
    """
    if exact:
        from lakemeter.operators.stats import exact_percentiles
        return exact_percentiles(fact, list(keys), "absolute_error_mw", [quantile], ["error_threshold_mw"])
    return fact.groupBy(*keys).agg(
        F.percentile_approx("absolute_error_mw", quantile, accuracy).alias("error_threshold_mw"))


def error_sketches(fact: DataFrame, keys=("region",), by=("market_date",), size: int = 400) -> DataFrame:
    """A quantile sketch (KLL) of the absolute error per key and ``by`` (a date), to be stored: later
    dates are added without reading older facts, and a corrected date replaces its own sketches.

    Combined map-side, so a hot key costs one sketch per task; a sketch holds a few times ``size`` values
    however many rows it stands for, and is exact up to ``size`` of them."""
    return fact.where(F.col("absolute_error_mw").isNotNull()).groupBy(*keys, *by).agg(
        F.kll_sketch_agg_double("absolute_error_mw", F.lit(size)).alias("error_sketch"))


def thresholds_from_sketches(sketches: DataFrame, keys=("region",), quantile: float = 0.99, size: int = 400) -> DataFrame:
    """Per key: the ``quantile`` over all stored sketches, an observed value whose rank is within the sketch's
    bound (``SKETCH_ERROR / size`` of the rows, about 99 % sure) of the one asked for."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("error_sketch", F.lit(size)).alias("_sketch"))
    return merged.select(*keys, F.kll_sketch_get_quantile_double("_sketch", F.lit(quantile)).alias("error_threshold_mw"),
                         F.kll_sketch_get_n_double("_sketch").alias("error_rows"))


def observations(fact: DataFrame, thresholds: DataFrame, keys=("region",)) -> DataFrame:
    """Non-blocking: fact rows whose absolute error exceeds their key's threshold."""
    return (fact.join(thresholds, list(keys), "inner")
            .where(F.col("absolute_error_mw") > F.col("error_threshold_mw")))


def evaluate_runs(valid_actual: DataFrame, valid_forecast: DataFrame, quarantine: DataFrame,
                  run_col: str, evaluated_at: Column, actual_name: str = "actual_load_hourly",
                  forecast_name: str = "load_forecast_hourly",
                  quarantine_name: str = "historical_load") -> DataFrame:
    """``evaluate`` for many runs at once: each distinct non-NULL ``run_col`` value is one run.

    One aggregate gives the three counts per run (a dataset without rows in a run counts
    0, i.e. a blocking FAIL for the valid outputs); the three outcome rows of a run are
    then generated from that single row, so no join back is needed.
    ``evaluated_at`` is an expression of ``run_col``.
    """
    tagged = (valid_actual.select(F.col(run_col).alias("_run"), F.lit("a").alias("tag"))
              .unionByName(valid_forecast.select(F.col(run_col).alias("_run"), F.lit("f").alias("tag")))
              .unionByName(quarantine.select(F.col(run_col).alias("_run"), F.lit("q").alias("tag"))))
    per_run = (tagged.where(F.col("_run").isNotNull()).groupBy("_run")
               .agg(*[F.count(F.when(F.col("tag") == t, 1)).alias(t) for t in ("a", "f", "q")]))
    outcomes = F.array(*[F.struct(F.lit(t).alias("tag"), F.col(t).alias("n")) for t in ("a", "f", "q")])
    full = per_run.select("_run", F.explode(outcomes).alias("_o")).select("_run", "_o.tag", "_o.n")
    tag, n = F.col("tag"), F.col("n")
    is_q = tag == "q"
    return full.select(
        F.col("_run").cast("string").alias("run_id"),
        F.when(tag == "a", actual_name).when(tag == "f", forecast_name).otherwise(quarantine_name).alias("dataset_name"),
        F.when(is_q, "quarantined_rows").otherwise("nonempty_valid_output").alias("rule_name"),
        F.when(is_q, n).otherwise(F.when(n > 0, 0).otherwise(1)).cast("bigint").alias("failed_row_count"),
        F.when(is_q, F.when(n == 0, "PASS").otherwise("WARN"))
         .otherwise(F.when(n > 0, "PASS").otherwise("FAIL")).alias("status"),
        (~is_q).alias("is_blocking"),
        F.col("_run").alias(run_col),
    ).withColumn("evaluated_at_utc", evaluated_at).drop(run_col)


def unmatched_rows(valid_actual: DataFrame, valid_forecast: DataFrame, run_id, evaluated_at=None,
                   keys=("market_date", "interval_start_utc", "region")) -> DataFrame:
    """Non-blocking outcomes: actual rows with no forecast, and forecast roll-up rows with no
    actual (both vanish in the inner fact join).  One full outer join on the fact keys,
    then one aggregate."""
    a = valid_actual.select(*keys).distinct().withColumn("_a", F.lit(True))
    f = valid_forecast.select(*keys).distinct().withColumn("_f", F.lit(True))
    j = a.join(f, list(keys), "full")
    counts = j.agg(F.count(F.when(F.col("_f").isNull(), 1)).alias("actual_without_forecast"),
                   F.count(F.when(F.col("_a").isNull(), 1)).alias("forecast_without_actual"))
    rid = F.lit(run_id) if isinstance(run_id, str) else run_id
    ts = evaluated_at if isinstance(evaluated_at, Column) else utc_now(evaluated_at)
    rows = F.array(F.struct(F.lit("actual_load_hourly").alias("d"), F.col("actual_without_forecast").alias("n")),
                   F.struct(F.lit("load_forecast_hourly").alias("d"), F.col("forecast_without_actual").alias("n")))
    return counts.select(F.explode(rows).alias("_o")).select(
        rid.cast("string").alias("run_id"), F.col("_o.d").alias("dataset_name"),
        F.lit("unmatched_fact_rows").alias("rule_name"), F.col("_o.n").cast("bigint").alias("failed_row_count"),
        F.when(F.col("_o.n") == 0, "PASS").otherwise("WARN").alias("status"),
        F.lit(False).alias("is_blocking"), ts.alias("evaluated_at_utc"))


def count_rule(df: DataFrame, run_id, dataset_name: str, rule_name: str, *, blocking: bool,
               fail_when_empty: bool, evaluated_at=None) -> DataFrame:
    """One outcome row from a row count: ``fail_when_empty`` rules fail on 0 rows (non-empty
    output), the others fail (blocking) or warn (non-blocking) on any row."""
    n = F.col("n")
    rid = F.lit(run_id) if isinstance(run_id, str) else run_id
    ts = evaluated_at if isinstance(evaluated_at, Column) else utc_now(evaluated_at)
    bad = F.lit("FAIL") if blocking else F.lit("WARN")
    failed = F.when(n > 0, 0).otherwise(1) if fail_when_empty else n
    status = (F.when(n > 0, "PASS").otherwise(bad) if fail_when_empty
              else F.when(n == 0, "PASS").otherwise(bad))
    return df.agg(F.count(F.lit(1)).alias("n")).select(
        rid.cast("string").alias("run_id"), F.lit(dataset_name).alias("dataset_name"),
        F.lit(rule_name).alias("rule_name"), failed.cast("bigint").alias("failed_row_count"),
        status.alias("status"), F.lit(blocking).alias("is_blocking"), ts.alias("evaluated_at_utc"))
