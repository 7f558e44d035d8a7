"""ANSI SQL (DuckDB dialect) equivalents of the registered queries.

Each statement recomputes its query from the raw tables independently of the Spark code:
ranking windows instead of aggregates, ``NOT EXISTS`` instead of anti joins, and so on.
Column names and types follow the Spark results; sums and averages are rounded to 6
decimals as on the Spark side.
"""

from __future__ import annotations

TZ = "America/New_York"
AS_OF = "TIMESTAMP '2024-02-15 00:00:00'"
RANGE = "DATE '2024-01-05' AND DATE '2024-01-20'"
REGIONS = "('CLICK', 'PURCHASE', 'VIEW')"
ZONES = "('Z1', 'Z2', 'Z3', 'Z4', 'Z5', 'Z6', 'Z7', 'Z8', 'Z9', 'Z10')"


def _utc(expr: str) -> str:
    return f"timezone('UTC', timezone('{TZ}', {expr}))"


def _local(expr: str) -> str:
    return f"timezone('{TZ}', timezone('UTC', {expr}))"


# events read as market-local measurements in 3-hour bins, and as next-day forecasts
_EVENTS = f"""
ev AS (
  SELECT *, date_trunc('hour', ts) - to_hours(hour(ts) % 3) AS local_start FROM events
),
act AS (
  SELECT CAST(local_start AS DATE) AS market_date,
         {_utc('local_start')} AS interval_start_utc,
         {_utc("local_start + INTERVAL 3 HOUR")} AS interval_end_utc,
         CAST(hour(local_start) // 3 + 1 AS SMALLINT) AS hour_ending,
         upper(trim(event_type)) AS region,
         value AS actual_load_mw,
         'events-' || strftime(ts, '%Y%m%d') AS batch_id,
         'events' AS raw_file_name,
         ts AS ingestion_timestamp_utc,
         event_id AS record_index
  FROM ev
),
fc AS (
  SELECT CAST(local_start + INTERVAL 1 DAY AS DATE) AS market_date,
         CAST(ts AS DATE) AS forecast_init_date,
         {_utc("local_start + INTERVAL 1 DAY")} AS interval_start_utc,
         {_utc("local_start + INTERVAL 1 DAY + INTERVAL 3 HOUR")} AS interval_end_utc,
         CAST(hour(local_start) // 3 + 1 AS SMALLINT) AS hour_ending,
         upper(trim(event_type)) AS region,
         'Z' || CAST(user_id % 10 + 1 AS VARCHAR) AS local_resource_zone,
         value AS load_forecast_mw,
         'events-' || strftime(ts, '%Y%m%d') AS batch_id,
         'events' AS raw_file_name,
         ts AS ingestion_timestamp_utc,
         event_id AS record_index
  FROM ev
),
act_rank AS (
  SELECT *, row_number() OVER (PARTITION BY interval_start_utc, region ORDER BY
         ingestion_timestamp_utc DESC NULLS LAST, batch_id DESC, raw_file_name DESC, record_index DESC) AS rn
  FROM act
),
act_lab AS (
  SELECT * EXCLUDE (rn), CASE
      WHEN interval_start_utc IS NULL THEN 'INVALID_TIMESTAMP'
      WHEN actual_load_mw IS NULL THEN 'MISSING_MEASUREMENT'
      WHEN actual_load_mw < 0 THEN 'NEGATIVE_LOAD'
      WHEN NOT (region IN {REGIONS}) THEN 'UNEXPECTED_REGION'
      WHEN rn > 1 THEN 'DUPLICATE_BUSINESS_KEY'
    END AS quarantine_reason
  FROM act_rank
),
fc_rank AS (
  SELECT *, row_number() OVER (PARTITION BY forecast_init_date, interval_start_utc, local_resource_zone
         ORDER BY ingestion_timestamp_utc DESC NULLS LAST, batch_id DESC, raw_file_name DESC,
         record_index DESC) AS rn
  FROM fc
),
fc_lab AS (
  SELECT * EXCLUDE (rn), CASE
      WHEN interval_start_utc IS NULL THEN 'INVALID_TIMESTAMP'
      WHEN load_forecast_mw IS NULL THEN 'MISSING_MEASUREMENT'
      WHEN load_forecast_mw < 0 THEN 'NEGATIVE_FORECAST'
      WHEN NOT (local_resource_zone IN {ZONES}) THEN 'UNEXPECTED_ZONE'
      WHEN rn > 1 THEN 'DUPLICATE_BUSINESS_KEY'
    END AS quarantine_reason
  FROM fc_rank
),
act_ok AS (SELECT * EXCLUDE (quarantine_reason, record_index) FROM act_lab WHERE quarantine_reason IS NULL),
fc_ok AS (SELECT * EXCLUDE (quarantine_reason, record_index) FROM fc_lab WHERE quarantine_reason IS NULL),
a_day AS (
  SELECT market_date, count(*) AS actual_rows, count(DISTINCT interval_start_utc) AS actual_intervals,
         count(DISTINCT region) AS region_count
  FROM act_ok GROUP BY market_date
),
f_day AS (
  SELECT market_date, count(*) AS forecast_rows, count(DISTINCT interval_start_utc) AS forecast_intervals,
         count(DISTINCT local_resource_zone) AS zone_count
  FROM fc_ok GROUP BY market_date
),
days AS (
  SELECT market_date, actual_rows, actual_intervals, region_count, forecast_rows, forecast_intervals,
         zone_count,
         coalesce(region_count = 3 AND zone_count = 10 AND actual_rows = actual_intervals * 3
                  AND forecast_rows = forecast_intervals * 10 AND actual_intervals = forecast_intervals,
                  false) AS is_complete
  FROM a_day FULL OUTER JOIN f_day USING (market_date)
),
good_days AS (SELECT market_date FROM days WHERE is_complete),
valid_act AS (SELECT * FROM act_ok WHERE market_date IN (SELECT market_date FROM good_days)),
valid_fc AS (SELECT * FROM fc_ok WHERE market_date IN (SELECT market_date FROM good_days)),
quarantine AS (
  SELECT 'actual_load' AS dataset_name, market_date, interval_start_utc, coalesce(region, '') AS region,
         '' AS local_resource_zone, CAST(actual_load_mw AS VARCHAR) AS rejected_value, quarantine_reason,
         batch_id, raw_file_name
  FROM act_lab WHERE quarantine_reason IS NOT NULL
  UNION ALL
  SELECT 'actual_load', market_date, interval_start_utc, coalesce(region, ''), '',
         CAST(actual_load_mw AS VARCHAR), 'INCOMPLETE_MARKET_DATE', batch_id, raw_file_name
  FROM act_ok a WHERE NOT EXISTS (SELECT 1 FROM good_days g WHERE g.market_date = a.market_date)
  UNION ALL
  SELECT 'load_forecast', market_date, interval_start_utc, coalesce(region, ''),
         coalesce(local_resource_zone, ''), CAST(load_forecast_mw AS VARCHAR), quarantine_reason,
         batch_id, raw_file_name
  FROM fc_lab WHERE quarantine_reason IS NOT NULL
  UNION ALL
  SELECT 'load_forecast', market_date, interval_start_utc, coalesce(region, ''),
         coalesce(local_resource_zone, ''), CAST(load_forecast_mw AS VARCHAR), 'INCOMPLETE_MARKET_DATE',
         batch_id, raw_file_name
  FROM fc_ok f WHERE NOT EXISTS (SELECT 1 FROM good_days g WHERE g.market_date = f.market_date)
),
regional AS (
  SELECT market_date, interval_start_utc, region, forecast_init_date,
         sum(load_forecast_mw) AS forecast_load_mw
  FROM valid_fc GROUP BY market_date, interval_start_utc, region, forecast_init_date
),
fact AS (
  SELECT a.market_date, r.forecast_init_date, a.interval_start_utc, a.region, a.actual_load_mw,
         r.forecast_load_mw,
         r.forecast_load_mw - a.actual_load_mw AS forecast_error_mw,
         abs(r.forecast_load_mw - a.actual_load_mw) AS absolute_error_mw,
         CASE WHEN a.actual_load_mw > 0
              THEN abs(r.forecast_load_mw - a.actual_load_mw) / a.actual_load_mw * 100 END
           AS absolute_percentage_error,
         CAST(strftime(a.market_date, '%Y%m%d') AS INTEGER) AS date_key,
         CAST(hour({_local('a.interval_start_utc')}) AS SMALLINT) AS hour
  FROM valid_act a JOIN regional r
    ON a.market_date = r.market_date AND a.interval_start_utc = r.interval_start_utc AND a.region = r.region
),
peak_rank AS (
  SELECT market_date, region, actual_load_mw, interval_start_utc,
         max(actual_load_mw) OVER (PARTITION BY market_date, region) AS peak_demand_mw,
         row_number() OVER (PARTITION BY market_date, region
                            ORDER BY actual_load_mw DESC NULLS LAST, interval_start_utc ASC) AS rn
  FROM fact
),
peak AS (
  SELECT market_date, region, peak_demand_mw, interval_start_utc AS peak_interval_utc
  FROM peak_rank WHERE rn = 1
),
perf AS (
  SELECT market_date, region, avg(absolute_error_mw) AS mae_mw, avg(absolute_percentage_error) AS mape_percent,
         sqrt(avg(forecast_error_mw * forecast_error_mw)) AS rmse_mw, count(*) AS hour_count
  FROM fact GROUP BY market_date, region
)"""


def _with(body: str) -> str:
    return f"WITH {_EVENTS}\n{body}"


SQL: dict[str, str] = {}

SQL["daily_peak"] = """
WITH e AS (SELECT CAST(ts AS DATE) AS market_date, upper(trim(event_type)) AS region, value, ts FROM events),
r AS (
  SELECT *, max(value) OVER (PARTITION BY market_date, region) AS peak_demand_mw,
         row_number() OVER (PARTITION BY market_date, region ORDER BY value DESC NULLS LAST, ts ASC) AS rn
  FROM e
)
SELECT market_date, region, peak_demand_mw, ts AS peak_interval_utc FROM r WHERE rn = 1
"""

_LINE_ORDER = "l_shipdate DESC, l_extendedprice DESC, l_partkey DESC, l_suppkey DESC"

SQL["dedup_latest"] = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) AS rn
  FROM lineitem) WHERE rn = 1
"""

SQL["dedup_flags"] = f"""
SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_partkey, l_suppkey,
       row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) = 1 AS is_latest
FROM lineitem
"""

SQL["rule_labels"] = _with("""
SELECT record_index AS event_id, market_date, interval_start_utc, region, actual_load_mw, quarantine_reason
FROM act_lab""")

SQL["forecast_labels"] = _with("""
SELECT record_index AS event_id, market_date, forecast_init_date, interval_start_utc, local_resource_zone,
       region, load_forecast_mw, quarantine_reason
FROM fc_lab""")

SQL["rule_split_counts"] = _with("""
SELECT dataset_name, outcome, count(*) AS row_count FROM (
  SELECT 'actual_load' AS dataset_name, coalesce(quarantine_reason, 'VALID') AS outcome FROM act_lab
  UNION ALL
  SELECT 'load_forecast', coalesce(quarantine_reason, 'VALID') FROM fc_lab
) GROUP BY dataset_name, outcome""")

SQL["complete_days"] = _with("SELECT * FROM days")

SQL["valid_actual"] = _with("SELECT * FROM valid_act")

SQL["valid_forecast"] = _with("SELECT * FROM valid_fc")

SQL["quarantine_rows"] = _with("SELECT * FROM quarantine")

SQL["incomplete_rows"] = _with("""
SELECT dataset_name, market_date, count(*) AS row_count FROM quarantine
WHERE quarantine_reason = 'INCOMPLETE_MARKET_DATE' GROUP BY dataset_name, market_date""")

SQL["ordinary_days"] = _with(f"""
SELECT market_date, CAST(count(*) AS BIGINT) AS rows,
       count(DISTINCT (interval_start_utc, region)) AS keys,
       count(DISTINCT region) AS entities,
       count(DISTINCT CASE WHEN region IN {REGIONS} THEN region END) AS known_entities,
       count(*) = count(DISTINCT (interval_start_utc, region))
         AND count(DISTINCT (interval_start_utc, region)) = 24
         AND count(DISTINCT region) = 3
         AND count(DISTINCT CASE WHEN region IN {REGIONS} THEN region END) = 3 AS is_ordinary
FROM act GROUP BY market_date""")

SQL["fact_compare"] = _with("""
SELECT market_date, forecast_init_date, interval_start_utc, region, actual_load_mw,
       round(forecast_load_mw, 6) AS forecast_load_mw, round(forecast_error_mw, 6) AS forecast_error_mw,
       round(absolute_error_mw, 6) AS absolute_error_mw,
       round(absolute_percentage_error, 6) AS absolute_percentage_error, date_key, hour
FROM fact""")

SQL["daily_peak_fact"] = _with("SELECT * FROM peak")

SQL["accuracy_daily"] = _with("""
SELECT market_date, region, round(mae_mw, 6) AS mae_mw, round(mape_percent, 6) AS mape_percent,
       round(rmse_mw, 6) AS rmse_mw, hour_count
FROM perf""")

SQL["scorecard"] = _with(f"""
SELECT region, round(mae, 6) AS mean_absolute_error_mw, round(mape, 6) AS mean_absolute_percentage_error,
       round(rmse, 6) AS root_mean_squared_error_mw,
       CAST(rank() OVER (ORDER BY mae DESC) AS INTEGER) AS performance_rank
FROM (SELECT region, avg(mae_mw) AS mae, avg(mape_percent) AS mape, avg(rmse_mw) AS rmse
      FROM perf WHERE market_date BETWEEN {RANGE} GROUP BY region)""")

SQL["hour_profile"] = _with(f"""
SELECT hour AS market_hour, region, round(avg(actual_load_mw), 6) AS average_load_mw,
       max(actual_load_mw) AS maximum_load_mw
FROM fact WHERE market_date BETWEEN {RANGE} GROUP BY hour, region""")

SQL["actual_vs_forecast"] = _with(f"""
SELECT interval_start_utc, region, actual_load_mw, round(forecast_load_mw, 6) AS forecast_load_mw
FROM fact WHERE market_date BETWEEN {RANGE}""")

SQL["error_trend"] = _with(f"""
SELECT interval_start_utc, region, round(forecast_error_mw, 6) AS forecast_error_mw,
       round(absolute_percentage_error, 6) AS absolute_percentage_error
FROM fact WHERE market_date BETWEEN {RANGE}""")

SQL["peak_report"] = _with(f"SELECT * FROM peak WHERE market_date BETWEEN {RANGE}")

SQL["kpis"] = _with(f"""
SELECT (SELECT max(interval_start_utc) FROM fact
        WHERE market_date BETWEEN {RANGE} AND region IN ('CLICK', 'VIEW')) AS latest_measurement_utc,
       (SELECT max(peak_demand_mw) FROM peak
        WHERE market_date BETWEEN {RANGE} AND region IN ('CLICK', 'VIEW')) AS peak_demand_mw,
       (SELECT round(avg(mae_mw), 6) FROM perf
        WHERE market_date BETWEEN {RANGE} AND region IN ('CLICK', 'VIEW')) AS mean_mae_mw,
       (SELECT count(*) FROM quarantine
        WHERE market_date BETWEEN {RANGE} AND region IN ('CLICK', 'VIEW')) AS quarantined_rows""")

SQL["freshness"] = _with(f"""
SELECT max(interval_start_utc) AS latest_measurement_utc,
       CAST(trunc(epoch({AS_OF} - max(interval_start_utc)) / 3600) AS BIGINT) AS age_hours
FROM valid_act""")

_QUALITY = """
counts AS (
  SELECT market_date, tag, count(*) AS n FROM (
    SELECT market_date, 'a' AS tag FROM valid_act
    UNION ALL SELECT market_date, 'f' FROM valid_fc
    UNION ALL SELECT market_date, 'q' FROM quarantine) GROUP BY market_date, tag
),
grid AS (
  SELECT d.market_date, t.tag FROM (SELECT DISTINCT market_date FROM counts WHERE market_date IS NOT NULL) d,
       (VALUES ('a'), ('f'), ('q')) t(tag)
),
outcomes AS (
  SELECT CAST(g.market_date AS VARCHAR) AS run_id,
         CASE g.tag WHEN 'a' THEN 'actual_load_hourly' WHEN 'f' THEN 'load_forecast_hourly'
                    ELSE 'historical_load' END AS dataset_name,
         CASE WHEN g.tag = 'q' THEN 'quarantined_rows' ELSE 'nonempty_valid_output' END AS rule_name,
         CAST(CASE WHEN g.tag = 'q' THEN coalesce(c.n, 0) WHEN coalesce(c.n, 0) > 0 THEN 0 ELSE 1 END
              AS BIGINT) AS failed_row_count,
         CASE WHEN g.tag = 'q' THEN (CASE WHEN coalesce(c.n, 0) = 0 THEN 'PASS' ELSE 'WARN' END)
              ELSE (CASE WHEN coalesce(c.n, 0) > 0 THEN 'PASS' ELSE 'FAIL' END) END AS status,
         g.tag <> 'q' AS is_blocking,
         CAST(g.market_date AS TIMESTAMP) + INTERVAL 1 DAY AS evaluated_at_utc
  FROM grid g LEFT JOIN counts c ON c.market_date = g.market_date AND c.tag = g.tag
)"""

SQL["quality_outcomes"] = _with(f""",{_QUALITY}
SELECT * FROM outcomes""").replace("\n,\ncounts", ",\ncounts")

SQL["quality_status"] = _with(f""",{_QUALITY}
SELECT evaluated_at_utc, dataset_name, rule_name, failed_row_count, status, is_blocking
FROM outcomes WHERE evaluated_at_utc = (SELECT max(evaluated_at_utc) FROM outcomes)""")

SQL["dim_date"] = """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS market_date,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
       CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
       strftime(d, '%A') AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate IS NOT NULL)
"""

SQL["dim_time"] = """
SELECT CAST(h AS SMALLINT) AS hour, lpad(CAST(h AS VARCHAR), 2, '0') || ':00' AS hour_label,
       CASE WHEN h BETWEEN 6 AND 11 THEN 'Morning' WHEN h BETWEEN 12 AND 17 THEN 'Afternoon'
            WHEN h BETWEEN 18 AND 21 THEN 'Evening' ELSE 'Night' END AS day_part
FROM (SELECT DISTINCT hour(ts) AS h FROM events WHERE ts IS NOT NULL)
"""

SQL["dim_entity"] = _with("SELECT DISTINCT region FROM fact WHERE region IS NOT NULL")

_ORDERS_SOURCE = """
src AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice, o_orderdate,
         o_orderpriority || '*' AS o_orderpriority
  FROM orders WHERE o_orderstatus IN ('O', 'P')
),
tgt AS (SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O'))"""

SQL["insert_only"] = f"""
WITH {_ORDERS_SOURCE}
SELECT * FROM tgt
UNION ALL
SELECT * FROM src s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.o_orderkey IS NOT DISTINCT FROM s.o_orderkey)
"""

SQL["upsert"] = f"""
WITH {_ORDERS_SOURCE}
SELECT * FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.o_orderkey IS NOT DISTINCT FROM t.o_orderkey)
UNION ALL
SELECT * FROM src
"""

SQL["delete_matching"] = """
SELECT * FROM orders o WHERE NOT EXISTS (
  SELECT 1 FROM orders u WHERE u.o_orderpriority = '1-URGENT' AND u.o_orderdate = o.o_orderdate)
"""

_DOCS = """
docs AS (
  SELECT 'documents/' || CAST(doc_id AS VARCHAR) || '.txt' AS raw_file_name, text, sha256(text) AS sha
  FROM documents
),
kept AS (SELECT sha, max(raw_file_name) AS raw_file_name FROM docs GROUP BY sha)"""

SQL["payload_dedup"] = f"""
WITH {_DOCS}
SELECT k.sha AS record_checksum, k.raw_file_name, CAST(length(d.text) AS INTEGER) AS payload_chars
FROM kept k JOIN docs d ON d.raw_file_name = k.raw_file_name
"""

SQL["manifest_reconcile"] = f"""
WITH {_DOCS}
SELECT d.raw_file_name AS file_name, CAST(len(string_split(d.text, chr(10))) AS BIGINT) AS declared_rows,
       CASE WHEN k.raw_file_name IS NULL THEN NULL
            ELSE CAST(len(string_split(d.text, chr(10))) AS BIGINT) END AS landed_rows,
       CASE WHEN k.raw_file_name IS NULL THEN 'MISSING' ELSE 'OK' END AS status
FROM docs d LEFT JOIN kept k ON k.raw_file_name = d.raw_file_name
"""

SQL["parse_payloads"] = f"""
SELECT event_id, CAST(0 AS INTEGER) AS record_index, CAST(ts AS DATE) AS market_date,
       {_utc('ts')} AS interval_start_utc, upper(trim(event_type)) AS region, value AS actual_load_mw
FROM events
"""

SQL["payload_contract"] = """
SELECT event_id,
       CAST(CASE WHEN value < 1 THEN 0 ELSE 2 END AS INTEGER) AS record_count,
       CAST(CASE WHEN value < 1 THEN NULL
                 WHEN event_type IN ('error', 'signup', 'purchase')
                      OR (event_type = 'click' AND value > 400) THEN 1 END AS INTEGER) AS violation_index,
       CASE WHEN value < 1 THEN 'DATA_NOT_NONEMPTY_LIST'
            WHEN event_type = 'error' THEN 'NO_INTERVAL_START'
            WHEN event_type = 'signup' THEN 'VALUE_NOT_NUMERIC'
            WHEN event_type = 'click' AND value > 400 THEN 'VALUE_NOT_NUMERIC'
            WHEN event_type = 'purchase' THEN 'VALUE_INVALID' END AS violation,
       NOT (value < 1 OR event_type IN ('error', 'signup', 'purchase')
            OR (event_type = 'click' AND value > 400)) AS is_valid
FROM events
"""

SQL["utc_normalise"] = f"""
SELECT event_id, {_utc('ts')} AS ts_utc, CAST(hour({_local(_utc('ts'))}) AS SMALLINT) AS local_hour,
       CAST({_utc('ts')} AS DATE) AS utc_date
FROM events
"""

SQL["price_distribution"] = """
SELECT date_trunc('hour', ts) AS interval_hour, min(value) AS min_value, max(value) AS max_value,
       round(quantile_cont(value, 0.05), 6) AS p05, round(quantile_cont(value, 0.5), 6) AS p50,
       round(quantile_cont(value, 0.95), 6) AS p95
FROM events WHERE ts IS NOT NULL GROUP BY date_trunc('hour', ts)
"""

SQL["display_numbers"] = """
SELECT o_orderkey, '$' || format('{:,.2f}', o_totalprice) AS shown,
       CAST(replace(replace('$' || format('{:,.2f}', o_totalprice), '$', ''), ',', '') AS DOUBLE) AS parsed_value
FROM orders
"""

SQL["parse_forecast_payloads"] = f"""
SELECT event_id, CAST(ts AS DATE) AS market_date, CAST(ts AS DATE) AS forecast_init_date,
       {_utc('ts')} AS interval_start_utc, upper(trim(event_type)) AS region,
       'Z' || CAST(user_id % 10 + 1 AS VARCHAR) AS local_resource_zone, value AS load_forecast_mw
FROM events
"""

SQL["error_observations"] = _with("""
, th AS (SELECT region, quantile_cont(absolute_error_mw, 0.9) AS error_threshold_mw FROM fact GROUP BY region)
SELECT f.market_date, f.interval_start_utc, f.region, round(f.absolute_error_mw, 6) AS absolute_error_mw,
       round(th.error_threshold_mw, 6) AS error_threshold_mw
FROM fact f JOIN th ON f.region = th.region
WHERE f.absolute_error_mw > th.error_threshold_mw""")

SQL["coverage"] = """
WITH expected AS (SELECT n_regionkey AS zone, count(DISTINCT n_nationkey) AS expected_locations
                  FROM nation GROUP BY n_regionkey),
seen AS (SELECT DISTINCT c_nationkey AS location, c_mktsegment FROM customer WHERE c_nationkey IS NOT NULL),
reporting AS (
  SELECT n.n_regionkey AS zone, s.c_mktsegment, count(DISTINCT s.location) AS reporting_locations
  FROM seen s JOIN nation n ON n.n_nationkey = s.location GROUP BY n.n_regionkey, s.c_mktsegment
)
SELECT r.zone, r.c_mktsegment, r.reporting_locations, e.expected_locations,
       r.reporting_locations / e.expected_locations AS coverage
FROM reporting r JOIN expected e ON e.zone = r.zone
"""

SQL["unmatched_fact_rows"] = _with("""
, a AS (SELECT DISTINCT market_date, interval_start_utc, region FROM valid_act),
f AS (SELECT DISTINCT market_date, interval_start_utc, region FROM valid_fc),
c AS (
  SELECT count(*) FILTER (WHERE f.region IS NULL AND f.market_date IS NULL) AS actual_without_forecast,
         count(*) FILTER (WHERE a.region IS NULL AND a.market_date IS NULL) AS forecast_without_actual
  FROM a FULL OUTER JOIN f
    ON a.market_date = f.market_date AND a.interval_start_utc = f.interval_start_utc AND a.region = f.region
)
SELECT 'r1' AS run_id, 'actual_load_hourly' AS dataset_name, 'unmatched_fact_rows' AS rule_name,
       actual_without_forecast AS failed_row_count,
       CASE WHEN actual_without_forecast = 0 THEN 'PASS' ELSE 'WARN' END AS status, false AS is_blocking,
       TIMESTAMP '2024-02-15 00:00:00' AS evaluated_at_utc FROM c
UNION ALL
SELECT 'r1', 'load_forecast_hourly', 'unmatched_fact_rows', forecast_without_actual,
       CASE WHEN forecast_without_actual = 0 THEN 'PASS' ELSE 'WARN' END, false,
       TIMESTAMP '2024-02-15 00:00:00' FROM c""")


# -- stored tables ---------------------------------------------------------------------------
_STORED = """
o AS (SELECT *, CAST(CASE WHEN o_orderpriority <> '5-LOW' THEN year(o_orderdate) END AS INTEGER) AS o_year FROM orders),
tgt AS (SELECT * FROM o WHERE o_orderstatus IN ('F', 'O')),
src AS (
  SELECT * REPLACE (o_totalprice + 1.0 AS o_totalprice,
         CAST(CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN o_year + 1 ELSE o_year END AS INTEGER) AS o_year)
  FROM o WHERE o_orderstatus IN ('O', 'P')
)"""

SQL["store_upsert"] = f"""
WITH {_STORED}
SELECT * FROM src UNION ALL SELECT * FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)
"""

SQL["store_insert_only"] = f"""
WITH {_STORED}
SELECT * FROM tgt UNION ALL
SELECT * REPLACE (CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 2.0 ELSE o_totalprice END AS o_totalprice)
FROM src WHERE o_orderkey NOT IN (SELECT o_orderkey FROM tgt)
"""

SQL["store_replace"] = f"""
WITH {_STORED}
SELECT * FROM tgt WHERE o_year % 3 <> 0 UNION ALL
SELECT * REPLACE (o_totalprice * 2 AS o_totalprice) FROM tgt WHERE o_year % 6 = 0 AND o_orderstatus = 'O'
"""

SQL["store_delete"] = f"""
WITH {_STORED}
SELECT * FROM tgt WHERE (o_year IS NULL OR o_year % 4 <> 1)
  AND NOT EXISTS (SELECT 1 FROM orders u WHERE u.o_orderpriority = '1-URGENT' AND u.o_orderdate = tgt.o_orderdate)
"""

SQL["store_overwrite"] = f"""
WITH {_STORED}
SELECT n AS stored, o_orderkey, o_totalprice, o_year FROM o, (VALUES ('silver.orders'), ('gold.orders')) names(n)
WHERE o_year IS NULL OR o_year % 2 = 0
"""

SQL["lakehouse_fact"] = SQL["fact_compare"]

_FIRST = "(ts < TIMESTAMP '2024-01-16' AND NOT (event_id % 50 = 0 AND ts < TIMESTAMP '2024-01-06'))"


def _outcomes(run: str, at: str, quarantined: str) -> str:
    """The three outcome rows of a run; ``quarantined`` counts its rejected rows."""
    return f"""
SELECT '{run}' AS run_id, d AS dataset_name, 'nonempty_valid_output' AS rule_name,
       CAST(CASE WHEN n > 0 THEN 0 ELSE 1 END AS BIGINT) AS failed_row_count, CASE WHEN n > 0 THEN 'PASS' ELSE 'FAIL' END AS status,
       true AS is_blocking, {at} AS evaluated_at_utc
FROM (SELECT 'actual_load_hourly' AS d, count(*) AS n FROM valid_act
      UNION ALL SELECT 'load_forecast_hourly', count(*) FROM valid_fc)
UNION ALL
SELECT '{run}', 'historical_load', 'quarantined_rows', n, CASE WHEN n = 0 THEN 'PASS' ELSE 'WARN' END, false, {at}
FROM (SELECT CAST(({quarantined}) AS BIGINT) AS n)"""


_FIRST_EVENTS = _EVENTS.replace("FROM events", f"FROM (SELECT * FROM events WHERE {_FIRST})")
_TOUCHED = f"""(SELECT CAST(ts AS DATE) FROM events WHERE NOT {_FIRST}
                UNION SELECT CAST(ts + INTERVAL 1 DAY AS DATE) FROM events WHERE NOT {_FIRST})"""

SQL["lakehouse_quality"] = f"""
WITH one AS (WITH {_FIRST_EVENTS}
{_outcomes('run1', "TIMESTAMP '2024-02-15'", 'SELECT count(*) FROM quarantine')}),
two AS (WITH {_EVENTS}
{_outcomes('run2', "TIMESTAMP '2024-02-16'", f'SELECT count(*) FROM quarantine WHERE market_date IN {_TOUCHED}')})
SELECT * FROM one UNION ALL SELECT * FROM two UNION ALL
SELECT 'gate', 'gate', 'no_blocking_failure', count(*), CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, true, {AS_OF}
FROM two WHERE is_blocking AND status = 'FAIL'
"""

SQL["complete_days_kept"] = SQL["complete_days"]

SQL["error_sketches"] = _with("""
SELECT region, q.quantile, CAST(count(absolute_error_mw) AS BIGINT) AS error_rows, true AS within_bound
FROM fact, (VALUES (CAST(0.5 AS DOUBLE)), (CAST(0.9 AS DOUBLE)), (CAST(0.99 AS DOUBLE))) q(quantile) GROUP BY region, q.quantile""")

SQL["dedup_staged"] = SQL["dedup_flags"]

# rows of the first stretch that come with the third are too late up to the watermark that the first batch
# left (a batch drops by the watermark of the batch before the last); those that come with the second as well
# are repeats.  Windows that the last watermark has not passed stay open.
SQL["stream_intervals"] = """
WITH first AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY AS watermark FROM events
               WHERE ts < TIMESTAMP '2024-01-11' AND event_id % 10 <> 0),
seen AS (SELECT events.* FROM events, first WHERE ts >= TIMESTAMP '2024-01-11' OR event_id % 10 <> 0 OR ts > watermark)
SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS rows, round(sum(value), 6) AS total, max(value) AS peak
FROM seen
WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM seen) - INTERVAL 1 DAY
GROUP BY date_trunc('day', ts), event_type
"""

# -- feeds ---------------------------------------------------------------------------------------
_WEATHER = """
weather_days AS (
  SELECT CAST(ts AS DATE) AS d, 'L' || CAST(user_id % 3 AS VARCHAR) AS location, count(*) AS n FROM events GROUP BY 1, 2
),
weather AS (
  SELECT location, CAST(h AS INTEGER) AS position, CAST(d AS TIMESTAMP) + to_hours(CAST(h AS INTEGER)) AS interval_start_utc,
         CAST(n % 30 + h * 0.5 AS DOUBLE) AS temperature_2m_c,
         CASE WHEN n % 4 = 0 AND h = 23 THEN NULL ELSE CAST(40 + (n + h) % 50 AS DOUBLE) END AS relative_humidity_percent,
         n % 4 <> 0 AS arrays_length_ok
  FROM weather_days, range(24) hours(h)
)"""

SQL["weather_rows"] = f"WITH {_WEATHER} SELECT * FROM weather"

SQL["weather_vs_demand"] = _with(f""",{_WEATHER}
SELECT date_trunc('hour', f.interval_start_utc) AS interval_hour, round(avg(f.actual_load_mw), 6) AS demand_mw,
       round(avg(w.temperature_2m_c), 6) AS temperature_c, round(avg(w.relative_humidity_percent), 6) AS relative_humidity_percent
FROM fact f JOIN weather w ON f.interval_start_utc = w.interval_start_utc
GROUP BY date_trunc('hour', f.interval_start_utc)""")

SQL["fuel_mix"] = """
WITH each AS (SELECT CAST(ts AS DATE) AS d, event_type, CAST(count(*) * 137 AS DOUBLE) AS mw FROM events GROUP BY 1, 2),
total AS (SELECT d, sum(mw) AS total_mw FROM each GROUP BY d)
SELECT CAST(d AS TIMESTAMP) + INTERVAL 26 HOUR + INTERVAL 15 MINUTE AS interval_start_utc, event_type AS fuel_category, mw AS generation_mw,
       total_mw, round(mw / total_mw * 100, 6) AS share_percent
FROM each JOIN total USING (d)
"""

SQL["snapshot"] = """
WITH days AS (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1),
shown AS (
  SELECT d, '1' AS id, 'Demand' AS t, format('{:,}', n * 1234) AS v FROM days
  UNION ALL SELECT d, '2', 'Cost', '$' || format('{:,.2f}', n / 8) FROM days
  UNION ALL SELECT d, '3', 'Flow', '-' || format('{:,}', n * 7) FROM days
  UNION ALL SELECT d, '4', 'State', 'n/a' FROM days
)
SELECT id AS metric_id, t AS metric_name, TRY_CAST(replace(replace(v, '$', ''), ',', '') AS DOUBLE) AS metric_value, v AS raw_value,
       CAST(d AS TIMESTAMP) + INTERVAL 26 HOUR + INTERVAL 15 MINUTE AS observed_at_utc
FROM shown
"""

_FAULTS = f"""
e AS (SELECT *, date_trunc('hour', ts) - to_hours(hour(ts) % 3) + INTERVAL 180 DAY AS b, 'Z' || CAST(user_id % 10 + 1 AS VARCHAR) AS zone,
             upper(trim(event_type)) AS r FROM events),
recs AS (
  SELECT event_id, ts, CAST(0 AS INTEGER) AS record_index, b AS local_start, CAST(ts AS DATE) AS init, r AS region, zone, value AS v
  FROM e WHERE event_id % 97 <> 0
  UNION ALL
  SELECT event_id, ts, 1, CASE WHEN event_id % 8 <> 0 THEN b + INTERVAL 3 HOUR END, CAST(ts AS DATE),
         CASE WHEN event_id % 8 = 3 THEN 'ELSEWHERE' ELSE r END, CASE WHEN event_id % 8 = 3 THEN 'Z99' ELSE zone END,
         CASE WHEN event_id % 8 IN (1, 4) THEN NULL WHEN event_id % 8 = 2 THEN CAST('-1' || CAST(value AS VARCHAR) AS DOUBLE) ELSE value END
  FROM e WHERE event_id % 97 <> 0
  UNION ALL
  SELECT event_id, ts, NULL, NULL, NULL, NULL, NULL, NULL FROM e WHERE event_id % 97 = 0
),
placed AS (SELECT *, CAST(local_start AS DATE) AS market_date, {_utc('local_start')} AS interval_start_utc FROM recs)"""

SQL["rule_labels_faults"] = f"""
WITH {_FAULTS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY interval_start_utc, region ORDER BY event_id DESC, record_index DESC NULLS LAST) AS rn FROM placed)
SELECT event_id, record_index, market_date, interval_start_utc, region, v AS actual_load_mw,
       CASE WHEN interval_start_utc IS NULL THEN 'INVALID_TIMESTAMP' WHEN v IS NULL THEN 'MISSING_MEASUREMENT' WHEN v < 0 THEN 'NEGATIVE_LOAD'
            WHEN NOT (region IN {REGIONS}) THEN 'UNEXPECTED_REGION' WHEN rn > 1 THEN 'DUPLICATE_BUSINESS_KEY' END AS quarantine_reason
FROM ranked
"""

SQL["forecast_labels_faults"] = f"""
WITH {_FAULTS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY init, interval_start_utc, zone ORDER BY event_id DESC, record_index DESC NULLS LAST) AS rn FROM placed)
SELECT event_id, record_index, market_date, init AS forecast_init_date, interval_start_utc, region, zone AS local_resource_zone, v AS load_forecast_mw,
       CASE WHEN interval_start_utc IS NULL THEN 'INVALID_TIMESTAMP' WHEN v IS NULL THEN 'MISSING_MEASUREMENT' WHEN v < 0 THEN 'NEGATIVE_FORECAST'
            WHEN NOT (zone IN {ZONES}) THEN 'UNEXPECTED_ZONE' WHEN rn > 1 THEN 'DUPLICATE_BUSINESS_KEY' END AS quarantine_reason
FROM ranked
"""

SQL["utc_normalise_year"] = f"""
WITH moved AS (SELECT event_id, date_trunc('hour', ts) + to_days(CAST(event_id % 12 * 30 AS INTEGER)) AS local FROM events),
last AS (SELECT event_id, local, {_utc('local')} AS later FROM moved),
-- an hour that occurs twice is the first of the two
utc AS (SELECT event_id, local, CASE WHEN {_local('later - INTERVAL 1 HOUR')} = local THEN later - INTERVAL 1 HOUR ELSE later END AS ts_utc FROM last)
SELECT event_id, local, ts_utc, CAST(hour({_local('ts_utc')}) AS SMALLINT) AS local_hour FROM utc
"""

SQL["manifest_statuses"] = """
WITH files AS (
  SELECT CAST(ts AS DATE) AS d, event_id % 5 AS page, count(*) AS n FROM events GROUP BY 1, 2
),
kinds AS (SELECT *, (day(d) * 5 + page) % 7 AS kind, 'page_' || lpad(CAST(page AS VARCHAR), 4, '0') || '.json' AS file_name FROM files)
SELECT CAST(d AS VARCHAR) AS market_date, 'actual' AS dataset, file_name,
       CASE WHEN kind <> 1 THEN n + CASE WHEN kind = 2 THEN 1 ELSE 0 END END AS declared_rows, CASE WHEN kind <> 0 THEN n END AS landed_rows,
       CAST(CASE WHEN kind = 1 THEN 0 ELSE 1 END AS BIGINT) AS declared_files,
       CAST(CASE kind WHEN 0 THEN 0 WHEN 4 THEN 2 ELSE 1 END AS BIGINT) AS landed_files,
       CASE kind WHEN 0 THEN 'MISSING' WHEN 1 THEN 'UNLISTED' WHEN 2 THEN 'ROW_COUNT_MISMATCH' WHEN 3 THEN 'CHECKSUM_MISMATCH'
                 WHEN 4 THEN 'DUPLICATE' ELSE 'OK' END AS status
FROM kinds
"""

SQL["ordinary_pairs"] = _with(f"""
, a AS (SELECT DISTINCT market_date, interval_start_utc, region FROM act WHERE region IN {REGIONS}),
f AS (SELECT DISTINCT market_date, interval_start_utc, local_resource_zone AS zone FROM fc),
pa AS (SELECT market_date, count(*) AS actual_rows, count(*) = 24 AND count(DISTINCT region) = 3 AS actual_is_ordinary FROM a GROUP BY market_date),
pf AS (SELECT market_date, count(*) AS forecast_rows,
              count(*) = 80 AND count(DISTINCT zone) = 10 AND count(DISTINCT CASE WHEN zone IN {ZONES} THEN zone END) = 10 AS forecast_is_ordinary
       FROM f GROUP BY market_date)
SELECT market_date, actual_rows, forecast_rows, actual_is_ordinary, forecast_is_ordinary,
       coalesce(actual_is_ordinary AND forecast_is_ordinary, false) AS is_ordinary
FROM pa FULL OUTER JOIN pf USING (market_date)""")

SQL["evaluate_gate"] = f"""
WITH runs AS (WITH {_EVENTS}
{_outcomes('run1', AS_OF, 'SELECT count(*) FROM quarantine')})
SELECT * FROM runs UNION ALL
SELECT 'run1', 'gate', 'no_blocking_failure', count(*), CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, true, {AS_OF}
FROM runs WHERE is_blocking AND status = 'FAIL'
"""
