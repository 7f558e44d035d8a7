"""Completeness of interval groups (market dates).

Profiles are built in two phases: first per (date, interval, entity) cell, which combines
map-side however skewed a date is, then per date over the cells only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def day_profile(df: DataFrame, date_col: str, interval_col: str, entity_col: str,
                names: tuple[str, str, str], bounded: bool = False) -> DataFrame:
    """Per date: rows, distinct intervals, distinct entities (NULLs are not counted as values).

    ``bounded=True`` is for inputs whose entities already passed a domain rule: then the
    distinct entities of a date are at most the domain, and its distinct intervals at most
    the intervals of one calendar day, so per-date sets of them are small by construction.
    They are built with map-side-combined ``collect_set`` and one shuffle by date (no
    Expand, no cell stage).  Otherwise cells are counted first and dates second.
    """
    rows, intervals, entities = names
    if bounded:
        return df.groupBy(date_col).agg(
            F.count(F.lit(1)).alias(rows),
            F.size(F.collect_set(interval_col)).cast("bigint").alias(intervals),
            F.size(F.collect_set(entity_col)).cast("bigint").alias(entities))
    cells = df.groupBy(date_col, interval_col, entity_col).agg(F.count(F.lit(1)).alias("_n"))
    return cells.groupBy(date_col).agg(
        F.sum("_n").alias(rows),
        F.count_distinct(interval_col).alias(intervals),
        F.count_distinct(entity_col).alias(entities),
    )


def paired_completeness(actual: DataFrame, forecast: DataFrame, *, date_col: str = "market_date",
                        interval_col: str = "interval_start_utc", actual_entity: str = "region",
                        forecast_entity: str = "local_resource_zone", expected_actual: int = 3,
                        expected_forecast: int = 10, bounded: bool = False) -> DataFrame:
    """Per date of either side: both profiles and ``is_complete``.

    Complete iff each side has the expected number of entities, every interval carries all
    of them (rows = intervals x entities) and both sides have the same number of intervals.
    The hour count itself is not fixed, so clock-change days can pass.
    """
    a = day_profile(actual, date_col, interval_col, actual_entity,
                    ("actual_rows", "actual_intervals", "region_count"), bounded)
    f = day_profile(forecast, date_col, interval_col, forecast_entity,
                    ("forecast_rows", "forecast_intervals", "zone_count"), bounded)
    return paired_profile(a, f, expected_actual, expected_forecast, date_col)


def complete_dates(profile: DataFrame, date_col: str = "market_date") -> DataFrame:
    return profile.where("is_complete").select(date_col)


def date_set(dates: DataFrame) -> DataFrame:
    """Broadcast a set of calendar dates.

    Size bound: one row per distinct calendar date, i.e. at most 366 rows per year the
    data spans (a millennium of dates is < 400k rows, a few MB), however many rows each
    date holds.  Broadcasting it keeps the big side of a date join from being shuffled
    by date, a key on which one day may hold a large share of all rows.
    """
    return F.broadcast(dates)


def keep_dates(df: DataFrame, dates: DataFrame, date_col: str = "market_date") -> DataFrame:
    """Rows on the given dates (a date set, see ``date_set``)."""
    return df.join(date_set(dates), date_col, "left_semi")


def drop_dates(df: DataFrame, dates: DataFrame, date_col: str = "market_date") -> DataFrame:
    """Rows not on the given dates (NULL dates are kept, i.e. treated as not complete)."""
    return df.join(date_set(dates), date_col, "left_anti")


def ordinary_days(df: DataFrame, *, date_col: str, interval_col: str, entity_col: str,
                  expected_entities: Sequence[str], expected_intervals: int = 24,
                  prefix: str = "") -> DataFrame:
    """Strict per-date check on raw records: no repeated key, exactly ``expected_intervals``
    x entities distinct keys, and the entity set equal to the expected one.

    Set equality is tested by counts (distinct entities = distinct in-domain entities =
    domain size), so no set is ever collected.
    """
    allowed = list(expected_entities)
    n = len(allowed)
    cells = df.groupBy(date_col, interval_col, entity_col).agg(F.count(F.lit(1)).alias("_n"))
    return cells.groupBy(date_col).agg(
        F.sum("_n").alias(f"{prefix}rows"),
        F.count(F.lit(1)).alias(f"{prefix}keys"),
        F.count_distinct(entity_col).alias(f"{prefix}entities"),
        F.count_distinct(F.when(F.col(entity_col).isin(allowed), F.col(entity_col))).alias(f"{prefix}known_entities"),
    ).withColumn(
        f"{prefix}is_ordinary",
        (F.col(f"{prefix}rows") == F.col(f"{prefix}keys"))
        & (F.col(f"{prefix}keys") == expected_intervals * n)
        & (F.col(f"{prefix}entities") == n)
        & (F.col(f"{prefix}known_entities") == n),
    )


def publication_completeness(actual: DataFrame, forecast: DataFrame, *, date_col: str = "market_date",
                             publication_col: str = "forecast_init_date",
                             interval_col: str = "interval_start_utc", actual_entity: str = "region",
                             forecast_entity: str = "local_resource_zone", expected_actual: int = 3,
                             expected_forecast: int = 10) -> DataFrame:
    """Per (date, forecast publication): both profiles and ``is_complete``.

    The completeness test of ``paired_completeness``, but the forecast side is profiled per
    publication, so a second (partial or complete) publication no longer spoils a date.
    Inputs are rule-passing rows, so the per-group sets are bounded (see ``day_profile``).
    """
    a = day_profile(actual, date_col, interval_col, actual_entity,
                    ("actual_rows", "actual_intervals", "region_count"), bounded=True)
    f = forecast.groupBy(date_col, publication_col).agg(
        F.count(F.lit(1)).alias("forecast_rows"),
        F.size(F.collect_set(interval_col)).cast("bigint").alias("forecast_intervals"),
        F.size(F.collect_set(forecast_entity)).cast("bigint").alias("zone_count"))
    return paired_profile(a, f, expected_actual, expected_forecast, date_col)


def ordinary_pairs(actual: DataFrame, forecast: DataFrame, *, date_col: str = "market_date",
                   interval_col: str = "interval_start_utc", actual_entity: str = "region",
                   forecast_entity: str = "local_resource_zone", expected_actual: Sequence[str],
                   expected_forecast: Sequence[str], expected_intervals: int = 24) -> DataFrame:
    """Per date of either side: both ``ordinary_days`` checks and ``is_ordinary`` of the pair (a date that
    one side lacks is not ordinary)."""
    a = ordinary_days(actual, date_col=date_col, interval_col=interval_col, entity_col=actual_entity,
                      expected_entities=expected_actual, expected_intervals=expected_intervals, prefix="actual_")
    f = ordinary_days(forecast, date_col=date_col, interval_col=interval_col, entity_col=forecast_entity,
                      expected_entities=expected_forecast, expected_intervals=expected_intervals, prefix="forecast_")
    both = F.coalesce(F.col("actual_is_ordinary") & F.col("forecast_is_ordinary"), F.lit(False))
    f = f.withColumnRenamed(date_col, "_forecast_date")
    j = a.join(f, a[date_col].eqNullSafe(f["_forecast_date"]), "full")
    return j.select(F.coalesce(date_col, "_forecast_date").alias(date_col),
                    *[c for c in [*a.columns, *f.columns] if c not in (date_col, "_forecast_date")], both.alias("is_ordinary"))


# -- completeness kept as mergeable bitmaps ---------------------------------------------------
#: intervals of one bitmap word
WORD_BITS = 60


def cell_bitmaps(labelled: DataFrame, batch, *, entity_col: str, reason_col: str = "quarantine_reason",
                 duplicate: str = "DUPLICATE_BUSINESS_KEY", date_col: str = "market_date",
                 interval_col: str = "interval_start_utc", publication_col: str | None = None,
                 unit_seconds: int = 3600) -> DataFrame:
    """What one batch says about the (interval, entity) cells of each date, as bitmaps.

    ``touched``: cells for which the batch has a row, ``passing``: those whose latest row in the batch passes the
    rules.  An interval is a bit, counted in ``unit_seconds`` (interval starts must be multiples of it), a word
    holds ``WORD_BITS`` of them; ``bit_or`` combines map-side.  ``batch`` is a number, or a column of the rows'
    batch numbers, rising in the order in which rows outrank each other.  A day of hourly intervals is a word or
    two per entity, whatever the number of rows."""
    slot = F.floor(F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col(interval_col)) / unit_seconds).cast("long")
    bit = F.expr(f"shiftleft(1L, cast(pmod(_slot, {WORD_BITS}) as int))")
    latest = F.coalesce(F.col(reason_col) != duplicate, F.lit(True))
    rows = labelled.where(latest & F.col(interval_col).isNotNull()).select(
        F.col(date_col), (F.col(publication_col) if publication_col else F.lit(None).cast("date")).alias("publication"),
        F.col(entity_col).alias("entity"), slot.alias("_slot"), F.col(reason_col).isNull().alias("_passes"),
        (F.lit(batch) if isinstance(batch, int) else batch).cast("long").alias("batch"))
    return rows.groupBy(date_col, "publication", "entity", F.floor(F.col("_slot") / WORD_BITS).alias("word"), "batch").agg(
        F.bit_or(bit).alias("touched"), F.bit_or(F.when(F.col("_passes"), bit).otherwise(F.lit(0).cast("long"))).alias("passing"))


def merge_bitmaps(bitmaps: DataFrame, date_col: str = "market_date") -> DataFrame:
    """One row per date, publication, entity and word: the cells that pass after all batches.

    A later batch decides the cells that it touches: ``(cells & ~touched) | passing``, folded in batch order.
    The result is itself a bitmap (its batch is the last one), so state and new batches merge the same way."""
    steps = F.array_sort(F.collect_list(F.struct("batch", "touched", "passing")))
    rows = bitmaps.groupBy(date_col, "publication", "entity", "word").agg(steps.alias("_steps"))
    fold = lambda field, rule: F.aggregate("_steps", F.lit(0).cast("long"), rule).alias(field)
    return rows.select(
        date_col, "publication", "entity", "word", F.element_at("_steps", -1)["batch"].alias("batch"),
        fold("touched", lambda acc, x: acc.bitwiseOR(x["touched"])),
        fold("passing", lambda acc, x: acc.bitwiseAND(F.bitwise_not(x["touched"])).bitwiseOR(x["passing"])))


def bitmap_profile(merged: DataFrame, names: tuple[str, str, str], date_col: str = "market_date") -> DataFrame:
    """``day_profile`` of merged bitmaps: rows, distinct intervals, distinct entities (NULL is none) of passing cells."""
    rows, intervals, entities = names
    live = merged.where(F.col("passing") != 0)
    words = live.groupBy(date_col, "word").agg(
        F.sum(F.bit_count("passing").cast("long")).alias("_rows"), F.bit_count(F.bit_or("passing")).cast("long").alias("_intervals"),
        F.collect_set("entity").alias("_entities"))
    return words.groupBy(date_col).agg(
        F.sum("_rows").alias(rows), F.sum("_intervals").alias(intervals),
        F.size(F.array_distinct(F.flatten(F.collect_list("_entities")))).cast("long").alias(entities))


def paired_profile(a: DataFrame, f: DataFrame, expected_actual: int, expected_forecast: int, date_col: str = "market_date") -> DataFrame:
    """``paired_completeness`` of two day profiles."""
    ok = ((F.col("region_count") == expected_actual)
          & (F.col("zone_count") == expected_forecast)
          & (F.col("actual_rows") == F.col("actual_intervals") * expected_actual)
          & (F.col("forecast_rows") == F.col("forecast_intervals") * expected_forecast)
          & (F.col("actual_intervals") == F.col("forecast_intervals")))
    return a.join(f, date_col, "full").withColumn("is_complete", F.coalesce(ok, F.lit(False)))
