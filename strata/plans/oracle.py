"""Independent DuckDB SQL for every query in ``strata.plans.queries``.

The statements spell each rule out in plain SQL over the registered views
(``orders``, ``customer`` ...); they share no code with the Spark plans except
the fixed parameters (dates, ids, thresholds) imported from ``specs``.
"""

from __future__ import annotations

from strata.plans import specs
from strata.spec import Settings

# ---------------------------------------------------------------- SQL helpers


def _text(c: str, upper: bool = False) -> str:
    e = f"trim(regexp_replace(coalesce(CAST({c} AS VARCHAR), ''), '\\s+', ' ', 'g'))"
    return f"upper({e})" if upper else e


def _esc(e: str) -> str:
    return f"replace(replace({e}, '\\', '\\\\'), '|', '\\|')"


def _part(c: str, kind: str) -> str:
    if kind == "key":
        e = _text(c, upper=True)
    elif kind == "number":
        e = f"coalesce(format('{{:,.6f}}', TRY_CAST({c} AS DOUBLE)), {_text(c)})"
    elif kind == "date":
        e = f"coalesce(strftime(TRY_CAST({c} AS DATE), '%Y-%m-%d'), {_text(c)})"
    else:
        e = _text(c)
    return _esc(f"coalesce({e}, '')")


def _hash(parts) -> str:
    return "sha256(concat_ws('||', " + ", ".join(_part(c, k) for c, k in parts) + "))"


def _initcap(c: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({c}), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


ORDERS_STAGED = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
       upper(CAST(o_custkey AS VARCHAR)) AS customer_id,
       CAST(o_orderdate AS DATE) AS business_date,
       CAST(o_totalprice AS DOUBLE) AS total_price,
       lower(o_orderpriority) AS order_priority,
       o_orderstatus AS order_status,
       CAST(NULL AS INTEGER) AS ship_priority
FROM orders"""

ORDERS_REASON = """
CASE WHEN order_id IS NULL THEN 'missing_order_id'
     WHEN customer_id IS NULL THEN 'missing_customer_id'
     WHEN business_date IS NULL THEN 'missing_business_date'
     WHEN total_price IS NULL THEN 'null_total_price'
     WHEN NOT isfinite(total_price) THEN 'not_finite_total_price'
     WHEN NOT coalesce(total_price >= 0, false) THEN 'negative_total_price'
END"""

CUSTOMER_CLASSIFIED = f"""
SELECT *, CASE WHEN customer_id IS NULL THEN 'missing_customer_id'
     WHEN customer_name IS NULL THEN 'missing_customer_name'
     WHEN nation_key IS NULL THEN 'null_nation_key'
     WHEN account_balance IS NULL THEN 'null_account_balance'
     WHEN NOT isfinite(account_balance) THEN 'not_finite_account_balance'
     WHEN NOT coalesce(nation_key BETWEEN 0 AND 24, false) THEN 'nation_out_of_range'
     WHEN NOT coalesce(account_balance >= 0, false) THEN 'negative_account_balance'
END AS _reject_reason
FROM (SELECT upper(CAST(c_custkey AS VARCHAR)) AS customer_id,
             {_initcap('c_name')} AS customer_name,
             CAST(c_nationkey AS INTEGER) AS nation_key,
             CAST(c_acctbal AS DOUBLE) AS account_balance,
             lower(c_mktsegment) AS market_segment
      FROM customer)"""

CUSTOMER_COLS = "customer_id, customer_name, nation_key, account_balance, market_segment"

LINES_CLASSIFIED = """
SELECT *, CASE WHEN order_id IS NULL THEN 'missing_order_id'
     WHEN line_number IS NULL THEN 'missing_line_number'
     WHEN business_date IS NULL THEN 'missing_business_date'
     WHEN quantity IS NULL THEN 'null_quantity'
     WHEN discount IS NULL THEN 'null_discount'
     WHEN extended_price IS NULL THEN 'null_extended_price'
     WHEN NOT isfinite(quantity) THEN 'not_finite_quantity'
     WHEN NOT isfinite(discount) THEN 'not_finite_discount'
     WHEN NOT isfinite(extended_price) THEN 'not_finite_extended_price'
     WHEN NOT coalesce(quantity BETWEEN 1 AND 50, false) THEN 'quantity_out_of_range'
     WHEN NOT coalesce(discount BETWEEN 0 AND 0.1, false) THEN 'discount_out_of_range'
     WHEN NOT coalesce(extended_price >= 0, false) THEN 'negative_extended_price'
     WHEN _is_late_arrival IS NULL THEN 'late_arrival_unknown'
     WHEN _is_late_arrival THEN 'late_arrival'
END AS _reject_reason
FROM (SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
             CAST(l_linenumber AS INTEGER) AS line_number,
             CAST(l_partkey AS VARCHAR) AS part_id,
             CAST(l_suppkey AS VARCHAR) AS supplier_id,
             l_quantity AS quantity, l_discount AS discount, l_extendedprice AS extended_price,
             CAST(o_orderdate AS DATE) AS business_date,
             CAST(l_shipdate AS DATE) AS _ingest_date,
             CAST(o_orderdate AS DATE) < CAST(l_shipdate AS DATE) - 7 AS _is_late_arrival
      FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)"""

HISTORY = """
SELECT user_id, event_type, ts AS __START_AT,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS __END_AT
FROM (SELECT user_id, ts, event_id, event_type,
             lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev,
             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
      FROM events)
WHERE rn = 1 OR prev IS DISTINCT FROM event_type"""

CALENDAR_FACTS = """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date,
       CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       CAST(day(d) AS INTEGER) AS day
FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)),
                                    INTERVAL 1 DAY)) AS d FROM orders)"""

WITH_BASE = f"""
WITH o AS ({ORDERS_STAGED}),
ov AS (SELECT * FROM o WHERE ({ORDERS_REASON}) IS NULL),
cc AS ({CUSTOMER_CLASSIFIED}),
cv AS (SELECT * FROM cc WHERE _reject_reason IS NULL),
cal AS ({CALENDAR_FACTS}),
fact AS (SELECT ov.order_id, ov.customer_id, cal.date_key, cal.year, cal.month,
                CAST(1 AS INTEGER) AS order_count, ov.total_price, ov.order_priority, ov.order_status
         FROM ov JOIN cv USING (customer_id) JOIN cal ON ov.business_date = cal.date)"""

ASOF = f"""
WITH hist AS ({HISTORY}),
p AS (SELECT event_id, user_id, date_trunc('hour', ts) AS probe_ts FROM events)
SELECT p.event_id, p.user_id, p.probe_ts, h.event_type AS event_type_asof
FROM p JOIN hist h ON p.user_id = h.user_id AND p.probe_ts >= h.__START_AT
 AND (h.__END_AT IS NULL OR p.probe_ts < h.__END_AT)"""

ORDERS_TEXT = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
       o_orderpriority, o_orderstatus, 'r' || CAST(year(o_orderdate) AS VARCHAR) AS run
FROM orders"""

_DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "date": "DATE", "double": "DOUBLE",
               "timestamp": "TIMESTAMP", "string": "VARCHAR"}


def _type_drift_sql() -> str:
    parts = []
    for f, t in specs.ORDERS.drift_fields:
        parts.append(
            f"SELECT 'orders' AS dataset, '{f}' AS field, '{t}' AS expected_type, run AS ingest_run_id, "
            f"CAST(sum(CASE WHEN {f} IS NOT NULL AND TRY_CAST({f} AS {_DUCK_TYPES[t]}) IS NULL "
            f"THEN 1 ELSE 0 END) AS BIGINT) AS type_drift_rows, count(*) AS rows_checked FROM t GROUP BY run")
    return f"WITH t AS ({ORDERS_TEXT}) " + " UNION ALL ".join(parts)


TYPE_DRIFT = _type_drift_sql()

EVENTS_BRONZE = """
SELECT 'events' AS dataset, 'r' || strftime(ts, '%Y%m%d') AS ingest_run_id, ts AS ingest_ts,
       props AS rescued, CAST(NULL AS VARCHAR) AS corrupt,
       'events/' || strftime(ts, '%Y%m%d') || '/' || event_type || '.csv' AS source_file
FROM events"""

RESCUED_FLAG = "(rescued IS NOT NULL AND regexp_replace(rescued, '\\s', '', 'g') <> '{}')"


def _rate(num: str, den: str) -> str:
    return f"round(CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) ELSE 0.0 END, 6)"


_NOW = Settings(now=specs.EVENTS_NOW.now)

JOIN_DROP = f"""
{WITH_BASE},
asofj AS ({ASOF.replace('WITH hist AS', 'SELECT * FROM (WITH hist AS').rstrip()})),
cur AS (SELECT count(*) AS facts_in,
               count(*) FILTER (WHERE customer_id IN (SELECT customer_id FROM cv)
                                AND business_date IN (SELECT date FROM cal)) AS facts_matched FROM ov),
aso AS (SELECT (SELECT count(*) FROM events) AS facts_in, (SELECT count(*) FROM asofj) AS facts_matched)
SELECT 'current' AS model, CAST(facts_in AS BIGINT) AS facts_in, CAST(facts_matched AS BIGINT) AS facts_matched,
       {_rate('facts_in - facts_matched', 'facts_in')} AS drop_rate FROM cur
UNION ALL
SELECT 'asof', CAST(facts_in AS BIGINT), CAST(facts_matched AS BIGINT),
       {_rate('facts_in - facts_matched', 'facts_in')} FROM aso"""

DATA_QUALITY = f"""
WITH cc AS ({CUSTOMER_CLASSIFIED}),
r AS (SELECT coalesce(_reject_reason, 'valid') AS reason, count(*) AS rows FROM cc GROUP BY 1)
SELECT 'customer' AS dataset, reason, rows,
       {_rate('rows', 'sum(rows) OVER ()')} AS share,
       {_rate("sum(CASE WHEN reason <> 'valid' THEN rows ELSE 0 END) OVER ()", 'sum(rows) OVER ()')}
         AS quarantine_rate
FROM r"""

FRESHNESS = f"""
WITH u AS (SELECT 'events' AS dataset, max(ts) AS last_ingest_ts FROM events
           UNION ALL SELECT 'lines', max(l_shipdate) FROM lineitem),
l AS (SELECT *, (epoch_us(TIMESTAMP '{specs.EVENTS_NOW.now}') - epoch_us(last_ingest_ts)) / 3.6e9 AS lag FROM u)
SELECT dataset, last_ingest_ts, round(lag, 3) AS lag_hours, lag <= {Settings().freshness_sla_hours} AS within_sla
FROM l"""

RETENTION = f"""
WITH lc AS ({LINES_CLASSIFIED})
SELECT 'lines' AS dataset, _reject_reason AS reason, _ingest_date AS ingest_date, count(*) AS rows
FROM lc
WHERE _reject_reason IS NOT NULL
  AND _ingest_date < CAST(TIMESTAMP '{specs.LINES_NOW.now}' AS DATE) - {Settings().quarantine_retention_days}
GROUP BY 1, 2, 3"""


def _guardrails_sql() -> str:
    s = Settings()
    td = f"SELECT * FROM ({TYPE_DRIFT})"
    return f"""
WITH dq AS ({DATA_QUALITY}),
jd AS ({JOIN_DROP}),
td AS ({td}),
tdr AS (SELECT dataset, ingest_run_id, sum(type_drift_rows) AS d, max(rows_checked) * count(*) AS n
        FROM td GROUP BY 1, 2),
eb AS ({EVENTS_BRONZE}),
fr AS ({FRESHNESS})
SELECT 'max_quarantine_rate' AS "check", CAST((SELECT max(quarantine_rate) FROM dq) AS DOUBLE) AS observed,
       CAST({s.max_quarantine_rate} AS DOUBLE) AS threshold
UNION ALL SELECT 'max_join_drop_rate_current', (SELECT drop_rate FROM jd WHERE model = 'current'),
       {s.max_join_drop_rate_current}
UNION ALL SELECT 'max_join_drop_rate_asof', (SELECT drop_rate FROM jd WHERE model = 'asof'),
       {s.max_join_drop_rate_asof}
UNION ALL SELECT 'max_type_drift_rate', (SELECT round(CAST(sum(d) AS DOUBLE) / CAST(sum(n) AS DOUBLE), 6)
       FROM tdr), {s.max_type_drift_rate}
UNION ALL SELECT 'max_corrupt_rate', (SELECT round(avg(CASE WHEN corrupt IS NOT NULL THEN 1.0 ELSE 0.0 END), 6)
       FROM eb), {s.max_corrupt_rate}
UNION ALL SELECT 'max_rescued_rate', (SELECT round(avg(CASE WHEN {RESCUED_FLAG} THEN 1.0 ELSE 0.0 END), 6)
       FROM eb), {s.max_rescued_rate}
UNION ALL SELECT 'freshness_lag_hours', (SELECT lag_hours FROM fr WHERE dataset = 'events'),
       {float(s.freshness_sla_hours)}"""


def _with_passed(sql: str) -> str:
    return (f"SELECT \"check\", observed, threshold, coalesce(observed <= threshold, false) AS passed "
            f"FROM ({sql})")


ORACLE = {
    "contract_projection": ORDERS_STAGED,
    "initcap_transform": f"SELECT p_partkey, {_initcap('p_name')} AS part_name, "
                         f"{_initcap('p_type')} AS part_type FROM part",
    "record_hash": f"SELECT c_custkey, {_hash([(h.column, h.kind) for h in specs.CUSTOMER.hash_parts])} "
                   f"AS _record_hash FROM customer",
    "content_dedupe": f"SELECT DISTINCT l_orderkey, l_linenumber, "
                      f"{_hash([(h.column, h.kind) for h in specs.LINE_CONTENT])} AS _record_hash "
                      f"FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem)",
    "record_hash_dates": f"SELECT o_orderkey, {_hash([(h.column, h.kind) for h in specs.ORDERS.hash_parts])} "
                         f"AS _record_hash FROM orders",
    "rules_valid": f"SELECT {CUSTOMER_COLS} FROM ({CUSTOMER_CLASSIFIED}) WHERE _reject_reason IS NULL",
    "quarantine_reason": f"SELECT {CUSTOMER_COLS}, _reject_reason FROM ({CUSTOMER_CLASSIFIED}) "
                         f"WHERE _reject_reason IS NOT NULL",
    "quarantine_null_safe": """
SELECT doc_id, lang, quality, toxic, _reject_reason FROM (
  SELECT *, CASE WHEN doc_id IS NULL THEN 'missing_doc_id'
                 WHEN quality IS NULL THEN 'null_quality'
                 WHEN toxic IS NULL THEN 'null_toxic'
                 WHEN NOT coalesce(quality = 1, false) THEN 'low_quality'
                 WHEN NOT coalesce(toxic = 0, false) THEN 'toxic' END AS _reject_reason
  FROM (SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, lower(d.lang) AS lang,
               CAST(l.quality AS INTEGER) AS quality, CAST(l.toxic AS INTEGER) AS toxic
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id))
WHERE _reject_reason IS NOT NULL""",
    "late_flag": f"SELECT order_id, line_number, part_id, supplier_id, business_date, _ingest_date, "
                 f"_is_late_arrival FROM ({LINES_CLASSIFIED})",
    "late_replay": f"SELECT order_id, line_number, part_id, supplier_id, business_date, _ingest_date, "
                   f"'{specs.REPLAY.replay_id}' AS _replay_id FROM ({LINES_CLASSIFIED}) "
                   f"WHERE _reject_reason = 'late_arrival'",
    "backfill_window": f"SELECT *, '{specs.BACKFILL.backfill_id}' AS _backfill_id, "
                       f"'{specs.BACKFILL.backfill_reason}' AS _backfill_reason FROM ({ORDERS_STAGED}) "
                       f"WHERE business_date BETWEEN DATE '{specs.BACKFILL.backfill_start}' "
                       f"AND DATE '{specs.BACKFILL.backfill_end}' AND ({ORDERS_REASON}) IS NULL",
    "change_feed_union": f"WITH lc AS ({LINES_CLASSIFIED}) "
                         f"SELECT order_id, line_number, business_date, _ingest_date, "
                         f"CAST(NULL AS VARCHAR) AS _replay_id, CAST(NULL AS VARCHAR) AS _backfill_id "
                         f"FROM lc WHERE _reject_reason IS NULL UNION ALL "
                         f"SELECT order_id, line_number, business_date, _ingest_date, "
                         f"'{specs.REPLAY.replay_id}', CAST(NULL AS VARCHAR) FROM lc "
                         f"WHERE _reject_reason = 'late_arrival'",
    "scd1_latest": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
             l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
  FROM lineitem) WHERE rn = 1""",
    "scd2_history": HISTORY,
    "dim_current": f"SELECT user_id, event_type FROM ({HISTORY}) WHERE __END_AT IS NULL",
    "calendar": """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date,
       CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day
FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)),
                                    INTERVAL 1 DAY)) AS d FROM orders)""",
    "fact_current": f"{WITH_BASE} SELECT * FROM fact",
    "fact_asof": ASOF,
    "fact_asof_bucketed": ASOF,
    "fact_asof_sweep": ASOF,
    "unmatched": f"{WITH_BASE} SELECT order_id, customer_id FROM ov WHERE NOT EXISTS "
                 f"(SELECT 1 FROM cv WHERE cv.customer_id = ov.customer_id)",
    "fact_daily": f"{WITH_BASE} SELECT date_key, order_priority, CAST(sum(order_count) AS BIGINT) AS order_count, "
                  f"CAST(sum(CAST(total_price AS DECIMAL(18,2))) AS DOUBLE) AS total_price, "
                  f"max(total_price) AS max_total_price FROM fact GROUP BY 1, 2",
    "type_drift": f"SELECT dataset, field, expected_type, ingest_run_id, type_drift_rows FROM ({TYPE_DRIFT})",
    "type_drift_rollup": f"SELECT dataset, ingest_run_id, CAST(sum(type_drift_rows) AS BIGINT) AS type_drift_rows "
                         f"FROM ({TYPE_DRIFT}) GROUP BY 1, 2",
    "rescued_profile": "SELECT k AS rescued_key, count(*) AS count "
                       "FROM (SELECT unnest(json_keys(props)) AS k FROM events) GROUP BY 1",
    "rescued_promote": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, "
                       "TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NOT NULL AS _k_from_rescued "
                       "FROM events",
    "rescued_keys": """
SELECT rescued_key, count(*) AS count FROM (
  SELECT 'segment' AS rescued_key FROM customer WHERE c_mktsegment IS NOT NULL
  UNION ALL SELECT 'debt' FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT 'nation' FROM customer WHERE c_nationkey > 9) GROUP BY 1""",
    "backfill_quarantine": f"""
SELECT order_id, business_date, coalesce(r, 'outside_backfill_window') AS _reject_reason,
       '{specs.BACKFILL.backfill_id}' AS _backfill_id
FROM (SELECT *, {ORDERS_REASON} AS r FROM ({ORDERS_STAGED}))
WHERE r IS NOT NULL OR NOT coalesce(business_date BETWEEN DATE '{specs.BACKFILL.backfill_start}'
                                    AND DATE '{specs.BACKFILL.backfill_end}', false)""",
    "replay_registry": f"""
SELECT '{specs.REPLAY.replay_id}' AS _replay_id, sha256(order_id || '|' || CAST(line_number AS VARCHAR)) AS _record_hash,
       count(*) AS rows FROM ({LINES_CLASSIFIED}) WHERE _reject_reason = 'late_arrival' GROUP BY 2""",
    "retention_kept": f"""
SELECT order_id, line_number, _reject_reason, CASE WHEN line_number <> 7 THEN _ingest_date END AS _ingest_date
FROM ({LINES_CLASSIFIED}) WHERE _reject_reason IS NOT NULL AND (line_number = 7 OR _ingest_date IS NULL
  OR _ingest_date >= CAST(TIMESTAMP '{specs.LINES_NOW.now}' AS DATE) - {Settings().quarantine_retention_days})""",
    "ingest_quality": f"""
WITH eb AS ({EVENTS_BRONZE})
SELECT dataset, ingest_run_id, count(*) AS rows,
       CAST(sum(CASE WHEN corrupt IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS corrupt_rows,
       CAST(sum(CASE WHEN {RESCUED_FLAG} THEN 1 ELSE 0 END) AS BIGINT) AS rescued_rows,
       {_rate('sum(CASE WHEN corrupt IS NOT NULL THEN 1 ELSE 0 END)', 'count(*)')} AS corrupt_rate,
       {_rate(f'sum(CASE WHEN {RESCUED_FLAG} THEN 1 ELSE 0 END)', 'count(*)')} AS rescued_rate
FROM eb GROUP BY 1, 2""",
    "join_drop": JOIN_DROP,
    "data_quality": DATA_QUALITY,
    "freshness": FRESHNESS,
    "run_audit": f"""
WITH eb AS ({EVENTS_BRONZE})
SELECT dataset, ingest_run_id, count(*) AS rows, count(DISTINCT source_file) AS files,
       CAST((SELECT sum(length(f) * 100) FROM (SELECT DISTINCT source_file AS f, ingest_run_id AS r FROM eb) x
             WHERE x.r = eb.ingest_run_id) AS BIGINT) AS bytes,
       min(ingest_ts) AS first_ingest_ts, max(ingest_ts) AS last_ingest_ts
FROM eb GROUP BY 1, 2""",
    "retention": RETENTION,
    "guardrails": _with_passed(_guardrails_sql()),
}

# Streaming twins compute the same rows as their batch operators.
ORACLE.update({
    "stream_dedupe": ORACLE["content_dedupe"],
    "stream_scd1": ORACLE["scd1_latest"],
    "stream_scd2": ORACLE["scd2_history"],
    "stream_profile": ORACLE["rescued_profile"],
    "stream_quarantine": ORACLE["quarantine_reason"],
    "stream_type_drift": ORACLE["type_drift"],
})
ORACLE["csv_ingest"] = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment, CAST(c_acctbal AS VARCHAR) AS c_acctbal,
       CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY')
            THEN '{"c_nationkey":"' || CAST(c_nationkey AS VARCHAR) || '"}' END AS _rescued_data,
       CAST(NULL AS VARCHAR) AS _corrupt_record
FROM customer"""


def _findings(dataset: str, spec, layouts) -> str:
    """One row per (columns, condition) layout that has a row in the table."""
    req = list(spec.required_columns)
    allowed = req + list(spec.known_columns)
    rows = []
    for cols, where in layouts:
        missing = [c for c in req if c not in cols]
        unexpected = [c for c in cols if c not in allowed]
        rows.append(
            f"SELECT '{dataset}' AS dataset, 'bronze' AS layer, 'manual_run' AS ingest_run_id, "
            f"'{','.join(cols)}' AS actual_cols, '{','.join(req)}' AS required_cols, "
            f"'{','.join(missing)}' AS missing_required_cols, '{','.join(unexpected)}' AS unexpected_cols, "
            f"{'true' if missing else 'false'} AS is_breaking_drift "
            f"WHERE EXISTS (SELECT 1 FROM {dataset} WHERE {where})")
    return " UNION ALL ".join(rows)


def _drift_files_sql() -> str:
    from strata.plans.drop_queries import NARROW_COLUMNS, WIDE_COLUMNS, WIDE_SEGMENTS
    segments = ", ".join(f"'{x}'" for x in WIDE_SEGMENTS)
    return _findings("customer", specs.CUSTOMER, [
        (NARROW_COLUMNS, f"NOT (c_mktsegment IN ({segments}))"), (WIDE_COLUMNS, f"c_mktsegment IN ({segments})")])


ORACLE["schema_drift_files"] = _drift_files_sql()
ORACLE["schema_drift"] = _findings("orders", specs.ORDERS, [
    (("o_orderkey", "o_custkey", "o_totalprice_eur", "o_orderstatus"), "o_orderstatus = 'F'"),
    (("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority"), "o_orderstatus IS DISTINCT FROM 'F'")])
ORACLE["replay_rerun"] = ORACLE["change_feed_union"]
ORACLE["csv_malformed"] = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
       CASE WHEN c_custkey % 5 = 0 THEN c_name || ' "the second"' || chr(10) || 'of, two lines' ELSE c_name END AS c_name,
       CASE WHEN c_nationkey <> 7 THEN c_mktsegment END AS c_mktsegment,
       c_nationkey = 7 AS is_corrupt, true AS own_file, true AS has_size, true AS has_time
FROM customer"""
ORACLE["bronze_append"] = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, 'customer' AS _dataset,
       CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 20240205 ELSE 20240105 END AS _ingest_yyyymmdd
FROM customer"""

_WINDOWS = [(f"business_date BETWEEN DATE '{x.backfill_start}' AND DATE '{x.backfill_end}'", x.backfill_id, x.backfill_reason)
            for x in (specs.BACKFILL, specs.LATER_BACKFILL)]
ORACLE["backfill_rerun"] = f"""
SELECT order_id, business_date,
       CASE WHEN r IS NOT NULL THEN NULL {' '.join(f"WHEN {w} THEN '{i}'" for w, i, _ in _WINDOWS)} END AS _backfill_id,
       CASE WHEN r IS NOT NULL THEN NULL {' '.join(f"WHEN {w} THEN '{why}'" for w, _, why in _WINDOWS)} END AS _backfill_reason,
       CASE WHEN r IS NOT NULL THEN r {' '.join(f"WHEN {w} THEN NULL" for w, _, _ in _WINDOWS)}
            ELSE 'outside_backfill_window' END AS _reject_reason
FROM (SELECT *, {ORDERS_REASON} AS r FROM ({ORDERS_STAGED}))"""

ORACLE["scd2_effective"] = """
WITH e AS (
  SELECT *, date_trunc('day', CAST(ts AS TIMESTAMP) - to_days(CAST(event_id * 7 % 31 AS INTEGER))) AS effective FROM events
), m AS (
  SELECT to_timestamp((CAST(epoch(min(CAST(ts AS TIMESTAMP))) AS BIGINT) + CAST(epoch(max(CAST(ts AS TIMESTAMP))) AS BIGINT)) // 2)
           AT TIME ZONE 'UTC' AS middle FROM events
), known AS (
  SELECT e.*, true AS known_now FROM e UNION ALL SELECT e.*, false FROM e, m WHERE CAST(ts AS TIMESTAMP) <= middle
), latest AS (
  SELECT * FROM known QUALIFY row_number() OVER (PARTITION BY known_now, user_id, effective ORDER BY ts DESC, event_id DESC) = 1
), changes AS (
  SELECT * FROM latest WINDOW w AS (PARTITION BY known_now, user_id ORDER BY effective)
  QUALIFY lag(event_type) OVER w IS DISTINCT FROM event_type OR row_number() OVER w = 1
)
SELECT user_id, event_type, effective AS __START_AT,
       lead(effective) OVER (PARTITION BY known_now, user_id ORDER BY effective) AS __END_AT,
       CAST(ts AS TIMESTAMP) AS _known_from, known_now FROM changes"""

# the reader by byte ranges gives the same rows
ORACLE["csv_split"] = ORACLE["csv_malformed"]
