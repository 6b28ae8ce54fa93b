"""SQL twins of the registered queries, for DuckDB over the same tables.

``SHARED`` holds the derived inputs as common table expressions; a query is given the ones
it mentions, directly or through another.
"""

from __future__ import annotations

import re

KEY = "dt, product_id, app_store, country, device"
MEASURES = (
    "downloads_total, downloads_featured, downloads_organic, downloads_paid_featured, "
    "downloads_paid_organic, downloads_unpaid_featured, downloads_unpaid_organic"
)
PAID = "downloads_paid_featured + downloads_paid_organic"
UNPAID = "downloads_unpaid_featured + downloads_unpaid_organic"
SPLIT = "downloads_featured + downloads_organic"


def _sum_if(condition: str, name: str) -> str:
    return f"CAST(SUM(CASE WHEN {condition} THEN downloads ELSE 0 END) AS BIGINT) AS {name}"


def _pivot(source: str) -> str:
    """Wide rows with shares from a narrow source."""
    return f"""
    SELECT {KEY}, {MEASURES},
      TRY_CAST(CAST({PAID} AS DOUBLE) / NULLIF(downloads_total, 0) AS DECIMAL(6,4)) AS paid_share,
      TRY_CAST(CAST(downloads_featured AS DOUBLE) / NULLIF(downloads_total, 0) AS DECIMAL(6,4)) AS featured_share,
      is_estimate_final
    FROM (SELECT {KEY},
      CAST(SUM(downloads) AS BIGINT) AS downloads_total,
      {_sum_if("channel IN ('paid_featured', 'unpaid_featured')", "downloads_featured")},
      {_sum_if("channel IN ('paid_organic', 'unpaid_organic')", "downloads_organic")},
      {_sum_if("channel = 'paid_featured'", "downloads_paid_featured")},
      {_sum_if("channel = 'paid_organic'", "downloads_paid_organic")},
      {_sum_if("channel = 'unpaid_featured'", "downloads_unpaid_featured")},
      {_sum_if("channel = 'unpaid_organic'", "downloads_unpaid_organic")},
      MIN(COALESCE(is_estimate_final, FALSE)) AS is_estimate_final
      FROM {source} GROUP BY {KEY})"""


def _stamped(source: str) -> str:
    return f"SELECT *, TIMESTAMP '2024-01-31 10:00:00' AS ingest_ts FROM ({_pivot(source)})"


def _first(source: str, key: str, order: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1"""


WIDE_COLUMNS = f"{KEY}, {MEASURES}, paid_share, featured_share, is_estimate_final, ingest_ts"
VERSION_ORDER = (
    "_loaded_at DESC, downloads_total DESC, downloads_featured DESC, downloads_organic DESC, "
    "downloads_paid_featured DESC"
)
BULK_DESC = "l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC, downloads DESC, is_estimate_final DESC"

SHARED = {
    "ev_raw": """
      SELECT CAST(ts AS DATE) AS dt, user_id AS product_id,
        CASE WHEN user_id % 2 = 0 THEN 'ios' ELSE 'google-play' END AS app_store,
        CASE user_id % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'GB' WHEN 2 THEN 'DE' WHEN 3 THEN 'JP' ELSE 'BR' END AS country,
        CASE user_id % 4 WHEN 0 THEN 'iphone' WHEN 1 THEN 'android-phone' WHEN 2 THEN 'ipad' ELSE 'android-tablet' END AS device,
        CASE event_type WHEN 'click' THEN 'paid_featured' WHEN 'view' THEN 'paid_organic'
          WHEN 'signup' THEN 'unpaid_featured' WHEN 'purchase' THEN 'unpaid_organic' ELSE event_type END AS channel,
        CAST(FLOOR(value) AS BIGINT) AS downloads, event_id % 10 <> 0 AS is_estimate_final,
        ts AS ingest_ts, event_id,
        CASE WHEN user_id % 2 = 0 THEN 'ios' ELSE 'google-play' END AS store
      FROM events""",
    "ev_bronze": _first("ev_raw", f"{KEY}, channel", "ingest_ts DESC, event_id DESC"),
    "ev_narrow": f"""
      SELECT *, TRY_CAST(CAST(downloads AS DOUBLE) / NULLIF(SUM(downloads) OVER (PARTITION BY {KEY}), 0) AS DECIMAL(6,4)) AS share_pct
      FROM ev_bronze""",
    "ev_drop": f"""
      SELECT {KEY}, channel, downloads,
        TRY_CAST(CAST(downloads AS DOUBLE) / NULLIF(SUM(downloads) OVER (PARTITION BY {KEY}), 0) AS DECIMAL(6,4)) AS share_pct,
        is_estimate_final, ingest_ts AS delivered_at, event_id, store
      FROM ev_raw""",
    "wide_now": _stamped("ev_bronze"),
    "ev_oldest": _first("ev_raw", f"{KEY}, channel", "ingest_ts, event_id"),
    "wide_lag": f"SELECT * FROM ({_stamped('ev_oldest')}) WHERE dt < DATE '2024-01-30'",
    "narrow_cut": "SELECT * FROM ev_narrow WHERE dt > DATE '2024-01-01'",
    "restated": f"""
      SELECT *, TRY_CAST(CAST({PAID} AS DOUBLE) / NULLIF(downloads_total, 0) AS DECIMAL(6,4)) AS paid_share,
        TRY_CAST(CAST(downloads_featured AS DOUBLE) / NULLIF(downloads_total, 0) AS DECIMAL(6,4)) AS featured_share
      FROM (SELECT {KEY},
        downloads_total + CASE WHEN device = 'iphone' THEN 1 ELSE 0 END AS downloads_total,
        downloads_featured + CASE WHEN device = 'iphone' THEN 1 ELSE 0 END AS downloads_featured,
        downloads_organic,
        downloads_paid_featured + CASE WHEN device = 'iphone' THEN 1 ELSE 0 END AS downloads_paid_featured,
        downloads_paid_organic, downloads_unpaid_featured, downloads_unpaid_organic,
        TRUE AS is_estimate_final, ingest_ts
        FROM wide_now WHERE app_store = 'ios' AND dt >= DATE '2024-01-24')""",
    "versions": f"""
      SELECT {WIDE_COLUMNS}, TIMESTAMP '2024-01-31 10:05:00' AS _loaded_at FROM wide_now
      UNION ALL SELECT {WIDE_COLUMNS}, TIMESTAMP '2024-02-01 10:05:00' FROM restated
      UNION ALL SELECT {WIDE_COLUMNS}, TIMESTAMP '2024-02-01 10:05:00' FROM wide_now
        WHERE app_store = 'ios' AND dt < DATE '2024-01-10'""",
    "latest": _first("versions", KEY, VERSION_ORDER),
    "ev_checked": "SELECT * FROM ev_bronze WHERE channel <> 'error' OR dt < DATE '2024-01-26'",
    "wide_checked": _stamped("ev_checked"),
    "dirty": f"""
      SELECT dt AS partition_dt, app_store AS store,
        CASE WHEN dt BETWEEN DATE '2024-01-01' AND DATE '2024-01-05' AND device = 'ipad'
          THEN CAST(dt + INTERVAL 30 DAY AS DATE) ELSE dt END AS dt,
        CASE WHEN dt BETWEEN DATE '2024-01-06' AND DATE '2024-01-10' AND app_store = 'google-play' AND country = 'JP'
          THEN NULL ELSE product_id END AS product_id,
        app_store, country, device,
        CASE WHEN dt BETWEEN DATE '2024-01-11' AND DATE '2024-01-15' AND app_store = 'ios' AND country = 'US'
          THEN -downloads_total ELSE downloads_total END AS downloads_total,
        downloads_featured, downloads_organic, downloads_paid_featured, downloads_paid_organic,
        downloads_unpaid_featured, downloads_unpaid_organic, paid_share, featured_share, is_estimate_final, ingest_ts
      FROM wide_checked
      WHERE NOT (dt BETWEEN DATE '2024-01-16' AND DATE '2024-01-20' AND device = 'android-tablet')""",
    "expected": """
      SELECT dt AS partition_dt, app_store AS store, COUNT(*) AS expected_count FROM wide_checked GROUP BY ALL""",
    "dq_counts": """
      SELECT e.partition_dt, e.store, e.expected_count, COALESCE(n, 0) AS n, COALESCE(np, 0) AS np, COALESCE(nd, 0) AS nd,
        COALESCE(nc, 0) AS nc, COALESCE(ns, 0) AS ns, COALESCE(oor, 0) AS oor, COALESCE(neg, 0) AS neg, COALESCE(uneq, 0) AS uneq
      FROM expected e FULL JOIN (
        SELECT partition_dt, store, COUNT(*) AS n,
          COUNT(*) - COUNT(product_id) AS np, COUNT(*) - COUNT(dt) AS nd, COUNT(*) - COUNT(country) AS nc,
          COUNT(*) - COUNT(app_store) AS ns,
          COUNT(*) FILTER (WHERE dt < partition_dt - INTERVAL 7 DAY OR dt > partition_dt + INTERVAL 7 DAY) AS oor,
          COUNT(*) FILTER (WHERE LEAST(downloads_total, downloads_featured, downloads_organic, downloads_paid_featured,
            downloads_paid_organic, downloads_unpaid_featured, downloads_unpaid_organic) < 0) AS neg,
          COUNT(*) FILTER (WHERE downloads_total <> downloads_featured + downloads_organic) AS uneq
        FROM dirty GROUP BY partition_dt, store) c
      ON e.partition_dt = c.partition_dt AND e.store = c.store""",
    "dq": """
      SELECT partition_dt, store, 'row_count' AS check_name,
        CASE WHEN expected_count = 0 THEN n = 0 ELSE ABS(n - expected_count) / CAST(expected_count AS DOUBLE) <= 0.01 END AS passed,
        TRUE AS blocking, 'expected ' || expected_count || ', found ' || n AS detail,
        CAST(ABS(n - expected_count) AS BIGINT) AS violation_count, n AS total_count FROM dq_counts
      UNION ALL SELECT partition_dt, store, 'null_rate_product_id', COALESCE(np / CAST(NULLIF(n, 0) AS DOUBLE), 0) <= 0.001,
        TRUE, np || ' of ' || n || ' rows', np, n FROM dq_counts
      UNION ALL SELECT partition_dt, store, 'null_rate_dt', COALESCE(nd / CAST(NULLIF(n, 0) AS DOUBLE), 0) <= 0.001,
        TRUE, nd || ' of ' || n || ' rows', nd, n FROM dq_counts
      UNION ALL SELECT partition_dt, store, 'null_rate_country', COALESCE(nc / CAST(NULLIF(n, 0) AS DOUBLE), 0) <= 0.001,
        TRUE, nc || ' of ' || n || ' rows', nc, n FROM dq_counts
      UNION ALL SELECT partition_dt, store, 'null_rate_app_store', COALESCE(ns / CAST(NULLIF(n, 0) AS DOUBLE), 0) <= 0.001,
        TRUE, ns || ' of ' || n || ' rows', ns, n FROM dq_counts
      UNION ALL SELECT partition_dt, store, 'date_range', oor = 0, TRUE, oor || ' of ' || n || ' rows', oor, n FROM dq_counts
      UNION ALL SELECT partition_dt, store, 'non_negative_downloads', neg = 0, FALSE, neg || ' of ' || n || ' rows', neg, n FROM dq_counts
      UNION ALL SELECT partition_dt, store, 'equation_total_eq_featured_plus_organic',
        COALESCE(uneq / CAST(NULLIF(n, 0) AS DOUBLE), 0) <= 0.001, FALSE, uneq || ' of ' || n || ' rows', uneq, n FROM dq_counts""",
    "gate": """
      SELECT partition_dt, store,
        CASE WHEN BOOL_OR(NOT passed AND blocking) THEN 'block' WHEN BOOL_OR(NOT passed) THEN 'warn' ELSE 'pass' END AS verdict,
        COUNT(*) FILTER (WHERE NOT passed AND blocking) AS blocking_failures,
        COUNT(*) FILTER (WHERE NOT passed AND NOT blocking) AS warnings,
        COALESCE(STRING_AGG(check_name, '; ' ORDER BY check_name) FILTER (WHERE NOT passed), '') AS failures
      FROM dq GROUP BY partition_dt, store""",
    "copy_l": "SELECT * FROM wide_now WHERE dt <> DATE '2024-01-11'",
    "copy_r": f"""
      SELECT {KEY}, downloads_total, downloads_featured,
        downloads_organic + CASE WHEN dt = DATE '2024-01-05' AND country = 'BR' THEN 1 ELSE 0 END AS downloads_organic,
        downloads_paid_featured, downloads_paid_organic, downloads_unpaid_featured, downloads_unpaid_organic,
        CASE WHEN dt <> DATE '2024-01-07' THEN paid_share END AS paid_share,
        CAST(CASE WHEN dt = DATE '2024-01-09' THEN featured_share + 0.0001 ELSE featured_share END AS DECIMAL(6,4)) AS featured_share,
        is_estimate_final, ingest_ts
      FROM wide_now WHERE NOT (dt = DATE '2024-01-03' AND device = 'ipad')""",
    "bulk_raw": """
      SELECT CAST(l_shipdate AS DATE) AS dt, l_suppkey AS product_id,
        CASE l_linestatus WHEN 'O' THEN 'ios' ELSE 'google-play' END AS app_store, n_name AS country,
        CASE WHEN l_linestatus = 'O' THEN (CASE WHEN l_suppkey % 2 = 0 THEN 'iphone' ELSE 'ipad' END)
          ELSE (CASE WHEN l_suppkey % 2 = 0 THEN 'android-phone' ELSE 'android-tablet' END) END AS device,
        CASE l_linenumber % 4 WHEN 0 THEN 'paid_featured' WHEN 1 THEN 'paid_organic'
          WHEN 2 THEN 'unpaid_featured' ELSE 'unpaid_organic' END AS channel,
        CAST(l_quantity AS BIGINT) AS downloads, l_returnflag <> 'N' AS is_estimate_final,
        l_orderkey, l_linenumber, l_extendedprice
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "bulk_bronze": _first("bulk_raw", f"{KEY}, channel", BULK_DESC),
    "bulk_oldest": _first("bulk_raw", f"{KEY}, channel", BULK_DESC.replace("DESC", "ASC")),
    "bulk_stale": _stamped("bulk_oldest"),
    "files_now": """
      SELECT dt, store, 'part-' || channel AS file_path, md5(COUNT(*) || ':' || SUM(downloads)) AS fingerprint
      FROM ev_raw GROUP BY dt, store, channel""",
    "files_seen": """
      SELECT dt, store, 'part-' || channel AS file_path, md5(COUNT(*) || ':' || SUM(downloads)) AS fingerprint
      FROM ev_raw WHERE ingest_ts < TIMESTAMP '2024-01-25 12:00:00' GROUP BY dt, store, channel""",
    "files_was": """
      SELECT * FROM files_seen
      UNION ALL SELECT DISTINCT dt, store, 'part-withdrawn', 'x' FROM files_seen WHERE dt = DATE '2024-01-10'""",
    "ledger": """
      SELECT 'bronze' AS layer, dt, store, CASE WHEN dt = DATE '2024-01-20' THEN 'failed' ELSE 'succeeded' END AS status,
        COUNT(*) AS in_count, COUNT(DISTINCT (product_id, country, device, channel)) AS out_count,
        CAST(0 AS BIGINT) AS dlq_rows, CAST(0 AS BIGINT) AS dlq_files, 'run-1' AS job_run_id,
        TIMESTAMP '2024-01-25 12:00:00' AS recorded_at, CAST(NULL AS TIMESTAMP) AS lock_expires_at
      FROM ev_raw WHERE ingest_ts < TIMESTAMP '2024-01-25 12:00:00' GROUP BY dt, store
      UNION ALL SELECT 'silver', dt, store, 'succeeded', COUNT(*), COUNT(DISTINCT (product_id, country, device, channel)),
        0, 0, 'run-1s', TIMESTAMP '2024-01-25 13:00:00', NULL
      FROM ev_raw WHERE ingest_ts < TIMESTAMP '2024-01-25 12:00:00' GROUP BY dt, store
      UNION ALL SELECT 'bronze', dt, store, 'succeeded', COUNT(*), COUNT(DISTINCT (product_id, country, device, channel)),
        0, 0, 'run-2', TIMESTAMP '2024-01-31 10:00:00', NULL
      FROM ev_raw WHERE dt >= DATE '2024-01-17' GROUP BY dt, store
      UNION ALL SELECT 'bronze', dt, store, 'running', COUNT(*), COUNT(DISTINCT (product_id, country, device, channel)),
        0, 0, 'run-3', TIMESTAMP '2024-02-01 09:00:00', TIMESTAMP '2024-02-01 11:00:00'
      FROM ev_raw WHERE dt = DATE '2024-01-30' GROUP BY dt, store""",
    "state": _first("ledger", "layer, dt, store", "recorded_at DESC"),
    "hist": """
      SELECT strftime(dt, '%Y-%m-%d') || '/' || app_store || '/' || strftime(_loaded_at, '%Y%m%d%H%M') AS file_name, dt,
        CASE WHEN errors > 0 THEN 'Partially loaded' ELSE 'Loaded' END AS status,
        n - errors AS row_count, n AS row_parsed, errors AS error_count,
        CASE WHEN errors > 0 THEN errors || ' rows do not fit the contract' END AS first_error_message,
        _loaded_at AS last_load_time
      FROM (SELECT dt, app_store, _loaded_at, COUNT(*) AS n, COUNT(*) - COUNT(paid_share) AS errors
        FROM versions GROUP BY ALL)""",
    "refr": """
      SELECT name,
        CASE WHEN second AND name = 'paid_vs_organic_trend' THEN 'FAILED' WHEN endless THEN 'EXECUTING' ELSE 'SUCCEEDED' END AS state,
        'INCREMENTAL' AS refresh_action, start AS refresh_start_time,
        CASE WHEN NOT endless THEN start + INTERVAL 30 SECOND END AS refresh_end_time
      FROM (SELECT name, second, start, second AND name = 'daily_by_country' AND dt = DATE '2024-01-30' AS endless
        FROM (SELECT dt, _loaded_at = TIMESTAMP '2024-02-01 10:05:00' AS second,
            _loaded_at + to_minutes(CAST(3 * day(dt) AS BIGINT)) AS start
          FROM versions GROUP BY dt, _loaded_at),
        (SELECT UNNEST(['daily_by_app', 'daily_by_country', 'paid_vs_organic_trend']) AS name))""",
    "errlog": """
      SELECT CASE WHEN day(dt) = 24 THEN 'SCHEMA_MISMATCH' WHEN day(dt) = 28 THEN 'PROCESSING_ERROR'
          WHEN day(dt) < 24 THEN 'DQ_BLOCK' END AS error_type,
        strftime(dt, '%Y-%m-%d') || '/' || store || '/' || file_path AS source_file,
        CAST(dt AS TIMESTAMP) + INTERVAL 34 HOUR AS recorded_at, day(dt) <> 30 AS readable
      FROM files_now""",
}


def _with(sql: str) -> str:
    """Prefix a query with the shared expressions it needs, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in SHARED:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(SHARED[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({SHARED[n]})" for n in needed) + "\n" + sql


def _pct(num: str, den: str, digits: int) -> str:
    return f"ROUND(100.0::DOUBLE * ({num}) / NULLIF({den}, 0), {digits})"


GOLD_SUMS = (
    "CAST(SUM(downloads_total) AS BIGINT) AS downloads_total, CAST(SUM(downloads_featured) AS BIGINT) AS downloads_featured, "
    "CAST(SUM(downloads_organic) AS BIGINT) AS downloads_organic"
)
LEAF_SUMS = ", ".join(
    f"CAST(SUM(downloads_{c}) AS BIGINT) AS downloads_{c}"
    for c in ("paid_featured", "paid_organic", "unpaid_featured", "unpaid_organic")
)


def _gold_app(source: str) -> str:
    return f"""SELECT dt, product_id, app_store, {GOLD_SUMS},
      CAST(SUM(paid_share) AS DOUBLE) / NULLIF(COUNT(paid_share), 0) AS avg_paid_share,
      CAST(SUM(featured_share) AS DOUBLE) / NULLIF(COUNT(featured_share), 0) AS avg_featured_share, COUNT(*) AS row_count
      FROM {source} GROUP BY dt, product_id, app_store"""


def _gold_country(source: str) -> str:
    return f"SELECT dt, country, app_store, {GOLD_SUMS}, COUNT(*) AS row_count FROM {source} GROUP BY dt, country, app_store"


def _gold_trend(source: str) -> str:
    return f"""SELECT *, ROUND(CAST({PAID} AS DOUBLE) / NULLIF(downloads_total, 0), 6) AS paid_ratio,
      ROUND(CAST(downloads_featured AS DOUBLE) / NULLIF(downloads_total, 0), 6) AS featured_ratio
      FROM (SELECT dt, app_store, {GOLD_SUMS}, {LEAF_SUMS} FROM {source} GROUP BY dt, app_store)"""


def _dq_only(prefix: str) -> str:
    return f"SELECT * FROM dq WHERE check_name LIKE '{prefix}%'"


def _recalc(column: str, num: str) -> str:
    return f"ROUND(CAST({num} AS DOUBLE) / NULLIF(downloads_total, 0), 4)"


PAID_AGAIN = _recalc("paid_share", PAID)
FEATURED_AGAIN = _recalc("featured_share", "downloads_featured")
PAID_OFF = f"ABS(CAST(paid_share AS DOUBLE) - {PAID_AGAIN})"
FEATURED_OFF = f"ABS(CAST(featured_share AS DOUBLE) - {FEATURED_AGAIN})"


def _join_on(left: str, right: str) -> str:
    return " AND ".join(f"{left}.{c} = {right}.{c}" for c in KEY.split(", "))


def _recon_pivot(narrow: str, wide: str) -> str:
    return f"""SELECT s.dt, s.product_id, s.app_store, s.country, s.device,
      s.downloads_total AS s_total, b.downloads_total AS b_total,
      s.downloads_total - b.downloads_total AS d_total, s.downloads_featured - b.downloads_featured AS d_featured,
      s.downloads_organic - b.downloads_organic AS d_organic,
      s.downloads_paid_featured - b.downloads_paid_featured AS d_pf,
      s.downloads_paid_organic - b.downloads_paid_organic AS d_po,
      s.downloads_unpaid_featured - b.downloads_unpaid_featured AS d_uf,
      s.downloads_unpaid_organic - b.downloads_unpaid_organic AS d_uo,
      s.is_estimate_final AS s_final, b.is_estimate_final AS b_final
      FROM {wide} s JOIN ({_pivot(narrow)}) b ON {_join_on("s", "b")}
      WHERE s.downloads_total <> b.downloads_total OR s.downloads_featured <> b.downloads_featured
        OR s.downloads_organic <> b.downloads_organic OR s.downloads_paid_featured <> b.downloads_paid_featured
        OR s.downloads_paid_organic <> b.downloads_paid_organic OR s.downloads_unpaid_featured <> b.downloads_unpaid_featured
        OR s.downloads_unpaid_organic <> b.downloads_unpaid_organic OR s.is_estimate_final <> b.is_estimate_final"""


def _profile(source: str) -> str:
    exact = ["product_id", "app_store", "RTRIM(country)", "device", *MEASURES.split(", "), "is_estimate_final",
             "strftime(date_trunc('second', ingest_ts), '%Y-%m-%d %H:%M:%S')"]
    text = " || '|' || ".join(f"COALESCE(CAST({c} AS VARCHAR), '__NULL__')" for c in exact)
    stats = ", ".join(
        f"SUM(CAST({c} AS DOUBLE)) AS {c}_sum, SUM(CAST({c} AS DOUBLE) * CAST({c} AS DOUBLE)) AS {c}_sumsq, "
        f"MIN(CAST({c} AS DOUBLE)) AS {c}_min, MAX(CAST({c} AS DOUBLE)) AS {c}_max, COUNT(*) - COUNT({c}) AS {c}_null_cnt"
        for c in ("paid_share", "featured_share")
    )
    return f"""SELECT dt, COUNT(*) AS row_cnt,
      CAST(SUM(CAST('0x' || SUBSTR(md5({text}), 1, 15) AS HUGEINT)) AS VARCHAR) AS row_checksum, {stats}
      FROM {source} GROUP BY dt"""


def _compare() -> str:
    rows = [
        ("L1", "row_cnt", "l.row_cnt IS DISTINCT FROM r.row_cnt"),
        ("L1", "row_checksum", "l.row_checksum IS DISTINCT FROM r.row_checksum"),
    ]
    for c in ("paid_share", "featured_share"):
        rows.append(("L2", f"{c}_null_cnt", f"l.{c}_null_cnt IS DISTINCT FROM r.{c}_null_cnt"))
        for s in ("min", "max"):
            a, b = f"l.{c}_{s}", f"r.{c}_{s}"
            rows.append(("L2", f"{c}_{s}", f"(({a} IS NULL) <> ({b} IS NULL)) OR ABS({a} - {b}) > 1e-9"))
        for s in ("sum", "sumsq"):
            a, b = f"COALESCE(l.{c}_{s}, 0)", f"COALESCE(r.{c}_{s}, 0)"
            rows.append(("L2", f"{c}_{s}", f"ABS({a} - {b}) / GREATEST(ABS({a}), ABS({b}), 1) > 1e-6"))
    parts = [
        f"SELECT COALESCE(l.dt, r.dt) AS dt, '{level}' AS level, '{name}' AS issue "
        f"FROM prof_l l FULL JOIN prof_r r ON l.dt = r.dt WHERE {wrong}"
        for level, name, wrong in rows
    ]
    return " UNION ALL ".join(parts)


SHARED["prof_l"] = _profile("copy_l")
SHARED["prof_r"] = _profile("copy_r")


def _diff_rows() -> str:
    parts = [
        f"SELECT {KEY}, 'only_left' AS issue FROM copy_l l WHERE NOT EXISTS (SELECT 1 FROM copy_r r WHERE {_join_on('l', 'r')})",
        f"SELECT {KEY}, 'only_right' FROM copy_r r WHERE NOT EXISTS (SELECT 1 FROM copy_l l WHERE {_join_on('l', 'r')})",
    ]
    both = f"FROM copy_l l JOIN copy_r r ON {_join_on('l', 'r')}"
    key = ", ".join(f"l.{c}" for c in KEY.split(", "))
    for c in [*MEASURES.split(", "), "is_estimate_final", "ingest_ts"]:
        parts.append(f"SELECT {key}, 'value_diff:{c}' {both} WHERE l.{c} IS DISTINCT FROM r.{c}")
    for c in ("paid_share", "featured_share"):
        a, b = f"CAST(l.{c} AS DOUBLE)", f"CAST(r.{c} AS DOUBLE)"
        far = f"ABS({a} - {b}) / GREATEST(ABS({a}), ABS({b}), 1) > 1e-6"
        parts.append(f"SELECT {key}, 'tolerance_diff:{c}' {both} WHERE ((l.{c} IS NULL) <> (r.{c} IS NULL)) OR {far}")
    return " UNION ALL ".join(parts)


# Files with any bad row, by number of bad rows.
BAD_FILES = "SELECT dt, app_store FROM wide_now WHERE downloads_total = 0 GROUP BY dt, app_store HAVING COUNT(*) > {limit}"
LOADED = f"""SELECT strftime(dt, '%Y-%m-%d') || '/' || app_store AS _source_file, {WIDE_COLUMNS} FROM wide_now
  WHERE downloads_total <> 0"""


def _seed() -> str:
    def draw(salt: str, below: int) -> str:
        return f"(CAST('0x' || SUBSTR(md5('2024-01-15/ios/{salt}/' || id), 1, 12) AS BIGINT) % {below})"

    pool = "['US', 'GB', 'DE', 'FR', 'JP', 'BR', 'IN', 'MX', 'KR', 'ID']"
    groups = f"""SELECT id, 1000000 + {draw('product', 9000000)} AS product_id,
      ({pool})[1 + {draw('country', 10)}] AS country, (['iphone', 'ipad'])[1 + {draw('device', 2)}] AS device,
      50 + {draw('total', 49951)} AS total, {draw('final', 10)} < 7 AS is_estimate_final,
      1 + {draw('paid_featured', 1000)} AS a, 1 + {draw('paid_organic', 1000)} AS b,
      1 + {draw('unpaid_featured', 1000)} AS c, 1 + {draw('unpaid_organic', 1000)} AS d
      FROM (SELECT c_custkey AS id FROM customer)"""
    parts = {
        "paid_organic": "(total * b) // (a + b + c + d)",
        "unpaid_featured": "(total * c) // (a + b + c + d)",
        "unpaid_organic": "(total * d) // (a + b + c + d)",
    }
    parts["paid_featured"] = "total - " + " - ".join(f"({p})" for p in parts.values())
    return " UNION ALL ".join(
        f"""SELECT DATE '2024-01-15' AS dt, product_id, 'ios' AS app_store, country, device, '{name}' AS channel,
        CAST({value} AS BIGINT) AS downloads, CAST(CAST({value} AS DOUBLE) / total AS DECIMAL(6,4)) AS share_pct, is_estimate_final
        FROM ({groups})"""
        for name, value in parts.items()
    )




_COUNT = "COUNT(*) FILTER (WHERE {0}) AS {1}"


def _count(condition: str, name: str) -> str:
    return _COUNT.format(condition, name)


NEGATIVES = ", ".join(
    _count(f"{c} < 0", c.replace("downloads", "neg")) for c in MEASURES.split(", ")
)
LEAVES = f"{PAID} + {UNPAID}"

RAW_SQL: dict[str, str] = {
    # sources and sinks
    "scan_drop": f"SELECT {KEY}, channel, downloads, share_pct, is_estimate_final, store FROM ev_drop",
    "scan_drop_csv": f"SELECT {KEY}, channel, downloads, share_pct, is_estimate_final, store FROM ev_drop",
    "partition_window": f"SELECT {KEY}, channel, downloads, event_id, store FROM ev_raw WHERE dt >= DATE '2024-01-17'",
    "partition_window_target": f"SELECT {KEY}, channel, downloads, event_id, store FROM ev_raw WHERE dt = DATE '2024-01-03' AND store = 'ios'",
    "backfill_range": f"SELECT {KEY}, channel, downloads, event_id, store FROM ev_raw WHERE dt BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'",
    "file_manifest": """SELECT dt, store, TRUE AS all_hashed, COUNT(*) AS row_count,
      CAST(SUM(downloads) AS BIGINT) AS downloads, TRUE AS all_different FROM ev_raw GROUP BY dt, store""",
    "restate_detect": """
      SELECT dt, store, files, added, removed, changed,
        CASE WHEN dt = DATE '2024-01-30' THEN 'locked' WHEN status IS NULL THEN 'new' WHEN status <> 'succeeded' THEN 'failed'
          WHEN added + removed + changed > 0 THEN 'changed' ELSE 'unchanged' END AS reason,
        dt <> DATE '2024-01-30' AND (status IS NULL OR status <> 'succeeded' OR added + removed + changed > 0) AS needs_work
      FROM (SELECT COALESCE(n.dt, p.dt) AS dt, COALESCE(n.store, p.store) AS store,
          COUNT(n.fingerprint) AS files, COUNT(*) FILTER (WHERE p.fingerprint IS NULL) AS added,
          COUNT(*) FILTER (WHERE n.fingerprint IS NULL) AS removed,
          COUNT(*) FILTER (WHERE n.fingerprint <> p.fingerprint) AS changed
        FROM files_now n FULL JOIN files_was p ON n.dt = p.dt AND n.store = p.store AND n.file_path = p.file_path
        GROUP BY ALL) f
      LEFT JOIN (SELECT dt AS sdt, store AS sstore, status FROM ledger WHERE job_run_id = 'run-1') s
        ON f.dt = s.sdt AND f.store = s.sstore
      WHERE files > 0""",
    "run_ledger": "SELECT * FROM state",
    "upstream_gate": """SELECT r.dt, r.store, product_id, channel, downloads, event_id FROM ev_raw r
      WHERE (r.dt, r.store) IN (SELECT (dt, store) FROM state WHERE layer = 'bronze' AND status = 'succeeded')""",
    "stale_silver": """SELECT b.dt, b.store FROM state b LEFT JOIN
      (SELECT dt, store, recorded_at FROM state WHERE layer = 'silver' AND status = 'succeeded') s
      ON b.dt = s.dt AND b.store = s.store
      WHERE b.layer = 'bronze' AND b.status = 'succeeded' AND (s.recorded_at IS NULL OR b.recorded_at > s.recorded_at)""",
    "empty_partition": """SELECT DISTINCT dt, store, 'succeeded' AS status, CAST(0 AS BIGINT) AS in_count, CAST(0 AS BIGINT) AS out_count
      FROM ev_raw WHERE (dt, store) NOT IN (SELECT (dt, store) FROM files_seen)""",
    "overwrite_partition": f"""SELECT {WIDE_COLUMNS} FROM restated
      UNION ALL SELECT {WIDE_COLUMNS} FROM wide_now WHERE NOT (app_store = 'ios' AND dt >= DATE '2024-01-24')""",
    "register_table": "SELECT DISTINCT 'dt=' || strftime(dt, '%Y-%m-%d') || '/store=' || app_store AS partition FROM wide_now",
    "append_load": f"SELECT {WIDE_COLUMNS}, _loaded_at FROM versions",
    "append_load_after_crash": f"SELECT {WIDE_COLUMNS}, _loaded_at FROM versions WHERE _loaded_at = TIMESTAMP '2024-01-31 10:05:00'",
    "load_cast": f"SELECT {WIDE_COLUMNS} FROM wide_now",
    "load_on_error_continue": LOADED,
    "load_on_error": f"{LOADED} AND (dt, app_store) NOT IN ({BAD_FILES.format(limit=0).replace('SELECT dt, app_store', 'SELECT (dt, app_store)')})",
    "load_on_error_skip_file_n": f"{LOADED} AND (dt, app_store) NOT IN ({BAD_FILES.format(limit=1).replace('SELECT dt, app_store', 'SELECT (dt, app_store)')})",
    "load_history_of_load": """
      SELECT strftime(dt, '%Y-%m-%d') || '/' || app_store AS file_name, dt,
        CASE WHEN bad = 0 THEN 'Loaded' ELSE 'Load failed' END AS status,
        CASE WHEN bad = 0 THEN n ELSE 0 END AS row_count, n AS row_parsed, bad AS error_count,
        CASE WHEN bad > 0 THEN bad || ' rows do not fit the contract; first: is_estimate_final is ''N/A''' END AS first_error_message,
        TIMESTAMP '2024-01-31 10:05:00' AS last_load_time
      FROM (SELECT dt, app_store, COUNT(*) AS n, COUNT(*) FILTER (WHERE downloads_total = 0) AS bad
        FROM wide_now GROUP BY dt, app_store)""",
    "bool_cast_matrix": """
      SELECT raw_text, raw_int,
        CASE WHEN LOWER(raw_text) IN ('true', 't', 'yes', 'y', 'on', '1') THEN TRUE
          WHEN LOWER(raw_text) IN ('false', 'f', 'no', 'n', 'off', '0') THEN FALSE END AS from_text,
        CASE raw_int WHEN 1 THEN TRUE WHEN 0 THEN FALSE END AS from_int, COUNT(*) AS n
      FROM (SELECT CASE event_type WHEN 'click' THEN 'TRUE' WHEN 'view' THEN 'no' WHEN 'signup' THEN ' YES '
          WHEN 'purchase' THEN 'maybe' ELSE '' END AS raw_text, CAST(user_id % 4 AS INTEGER) - 1 AS raw_int FROM events)
      GROUP BY raw_text, raw_int""",
    "load_history": "SELECT * FROM hist WHERE last_load_time >= TIMESTAMP '2024-02-01 00:00:00'",
    "load_history_by_day": """SELECT CAST(last_load_time AS DATE) AS load_day, COUNT(*) AS files_loaded,
      CAST(SUM(row_count) AS BIGINT) AS rows_loaded FROM hist GROUP BY 1""",
    "pending_files": """SELECT dt, store, file_path FROM files_now n WHERE NOT EXISTS
      (SELECT 1 FROM files_seen s WHERE s.dt = n.dt AND s.store = n.store AND s.file_path = n.file_path)""",
    "reload_missing": """SELECT dt, store, 'part-' || channel AS file_path FROM ev_raw r GROUP BY dt, store, channel
      HAVING MAX(ingest_ts) > TIMESTAMP '2024-01-28 00:00:00' AND (dt, store, 'part-' || channel) NOT IN
        (SELECT (dt, store, file_path) FROM files_seen)""",
    "quarantine_files": """SELECT dt, store, 'failed' AS status, COUNT(*) AS in_count, CAST(0 AS BIGINT) AS out_count, COUNT(*) AS dlq_rows
      FROM ev_raw WHERE dt IN (DATE '2024-01-05', DATE '2024-01-06') GROUP BY dt, store
      UNION ALL SELECT dt, store, 'succeeded', COUNT(*), COUNT(DISTINCT (product_id, country, device, channel)), 0
      FROM ev_raw WHERE dt NOT IN (DATE '2024-01-05', DATE '2024-01-06') GROUP BY dt, store""",
    "error_records": """SELECT 'DQ_BLOCK' AS error_type, failures AS error_message, TIMESTAMP '2024-01-31 10:00:00' AS recorded_at,
        'run-1' AS job_run_id, 'silver/' || store AS source_file,
        'dt=' || strftime(partition_dt, '%Y-%m-%d') || '/store=' || store AS original_key,
        partition_dt AS dt, store, DATE '2024-01-31' AS failed_at
      FROM gate WHERE verdict = 'block'""",
    "quarantine_frame": """SELECT d.*, 'DQ_BLOCK' AS _dlq_error_type, 'run-1' AS _dlq_job_run_id,
        TIMESTAMP '2024-01-31 10:00:00' AS _dlq_timestamp, DATE '2024-01-31' AS failed_at
      FROM dirty d JOIN gate g ON d.partition_dt = g.partition_dt AND d.store = g.store WHERE g.verdict = 'block'""",
    "dlq_replay": """SELECT DATE '2024-01-31' AS failed_at, 'raw' AS kind, 'run-1' AS job_run_id, dt, store, COUNT(*) AS row_count,
        CASE dt WHEN DATE '2024-01-05' THEN 'replay' ELSE 'present' END AS action
      FROM ev_raw WHERE dt IN (DATE '2024-01-05', DATE '2024-01-06') GROUP BY dt, store
      UNION ALL SELECT DISTINCT DATE '2024-01-31', 'error', 'run-1', dt, store, CAST(1 AS BIGINT), 'archive_only'
      FROM ev_raw WHERE dt IN (DATE '2024-01-05', DATE '2024-01-06')""",
    "dlq_replay_rows": """SELECT dt, store, event_id, downloads,
        CASE dt WHEN DATE '2024-01-06' THEN CAST(is_estimate_final AS VARCHAR) END AS is_estimate_final
      FROM ev_raw WHERE dt IN (DATE '2024-01-05', DATE '2024-01-06')""",
    "backfill_build": " UNION ALL ".join(
        f"""SELECT '{layer}' AS layer, dt, store, 'succeeded' AS status, {read} AS in_count, {left} AS out_count,
        CASE WHEN dt BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' THEN 'run-2' ELSE '{first}' END AS job_run_id
      FROM (SELECT dt, store, COUNT(*) AS n, COUNT(DISTINCT (product_id, country, device, channel)) AS kept,
          COUNT(DISTINCT (product_id, country, device)) AS wide FROM ev_raw GROUP BY dt, store)"""
        for layer, read, left, first in (("bronze", "n", "kept", "run-1"), ("silver", "kept", "wide", "silver-1"))
    ),
    "fold_ledgers": """SELECT 'bronze' AS layer, dt, store, 'succeeded' AS status, COUNT(*) AS in_count,
        COUNT(DISTINCT (product_id, country, device, channel)) AS out_count, 'run-2' AS job_run_id FROM ev_raw GROUP BY dt, store""",
    "schema_evolution": f"""SELECT {KEY}, channel, downloads, CASE WHEN day(dt) % 2 = 1 THEN event_id % 7 END AS campaign, event_id
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {KEY}, channel ORDER BY delivered_at DESC, event_id DESC) AS rn FROM ev_drop)
      WHERE rn = 1""",
    "dlq_replay_plan": """SELECT failed_at, kind, source_file, CASE WHEN kind = 'raw' THEN 'replay' ELSE 'archive_only' END AS action
      FROM (SELECT CAST(recorded_at AS DATE) AS failed_at, source_file,
          CASE error_type WHEN 'SCHEMA_MISMATCH' THEN 'raw' WHEN 'PROCESSING_ERROR' THEN 'raw' WHEN 'DQ_BLOCK' THEN 'wide' ELSE 'error' END AS kind
        FROM errlog) WHERE failed_at = DATE '2024-01-25'""",
    "seed_narrow": _seed(),
    # contract and cleaning
    "schema_missing_cols": "SELECT DISTINCT dt, store, 'is_estimate_final' AS column_name FROM ev_raw WHERE dt = DATE '2024-01-05'",
    "schema_type_mismatch": """SELECT DISTINCT dt, store, 'is_estimate_final' AS column_name, 'string' AS got, 'boolean' AS want
      FROM ev_raw WHERE dt = DATE '2024-01-06'""",
    "schema_gate": """SELECT DISTINCT dt, store, dt NOT IN (DATE '2024-01-05', DATE '2024-01-06') AS passed,
      CASE dt WHEN DATE '2024-01-05' THEN 'missing is_estimate_final'
        WHEN DATE '2024-01-06' THEN 'is_estimate_final is string, not boolean' END AS error_message FROM ev_raw""",
    "cast_contract": f"SELECT {KEY}, channel, downloads, is_estimate_final, event_id FROM ev_raw",
    "trim_strings": f"SELECT {KEY}, channel, downloads, event_id FROM ev_raw",
    "stamp_ingest": f"SELECT {KEY}, channel, downloads, event_id, TIMESTAMP '2024-01-31 10:00:00' AS ingest_ts FROM ev_raw",
    "dedup_pk": f"SELECT {KEY}, channel, downloads, share_pct, is_estimate_final, ingest_ts FROM ev_narrow",
    "dedup_pk_bulk": f"SELECT {KEY}, channel, downloads, is_estimate_final, l_orderkey, l_linenumber, l_extendedprice FROM bulk_bronze",
    "dedup_metrics": """SELECT dt, store, CAST(SUM(n) AS BIGINT) AS in_count, COUNT(*) AS out_count,
      CAST(SUM(n) - COUNT(*) AS BIGINT) AS dedup_removed
      FROM (SELECT dt, store, product_id, app_store, country, device, channel, COUNT(*) AS n FROM ev_raw GROUP BY ALL)
      GROUP BY dt, store""",
    "bronze_build": f"""SELECT {KEY}, channel, downloads, share_pct, is_estimate_final, ingest_at AS ingest_ts, store
      FROM (SELECT *, TIMESTAMP '2024-01-31 10:00:00' AS ingest_at,
        ROW_NUMBER() OVER (PARTITION BY {KEY}, channel ORDER BY delivered_at DESC, event_id DESC) AS rn FROM ev_drop)
      WHERE rn = 1""",
    # pivot
    "pivot_wide": f"SELECT {KEY}, {MEASURES}, is_estimate_final FROM wide_now",
    "pivot_wide_bulk": f"SELECT {KEY}, {MEASURES}, paid_share, featured_share, is_estimate_final FROM ({_pivot('bulk_bronze')})",
    "finalized_flag": f"SELECT {KEY}, is_estimate_final FROM wide_now",
    "paid_share": f"SELECT {KEY}, paid_share FROM wide_now",
    "featured_share": f"SELECT {KEY}, featured_share FROM wide_now",
    "expected_wide_keys": "SELECT dt AS partition_dt, app_store AS store, COUNT(*) AS expected_count FROM wide_now GROUP BY ALL",
    "conform_columns": f"SELECT {WIDE_COLUMNS} FROM wide_now",
    "silver_build": f"SELECT {WIDE_COLUMNS}, app_store AS store FROM wide_now",
    "silver_build_bulk": """SELECT dt AS partition_dt, app_store AS store, 'pass' AS verdict, CAST(0 AS BIGINT) AS blocking_failures,
      CAST(0 AS BIGINT) AS warnings, '' AS failures FROM bulk_bronze GROUP BY dt, app_store""",
    "silver_build_bulk_rows": f"SELECT {KEY}, {MEASURES}, paid_share, featured_share, is_estimate_final, app_store AS store FROM ({_pivot('bulk_bronze')})",
    # quality
    "dq_row_count": _dq_only("row_count"),
    "dq_null_rate": _dq_only("null_rate"),
    "dq_date_range": _dq_only("date_range"),
    "dq_non_negative": _dq_only("non_negative"),
    "dq_equation": _dq_only("equation"),
    "dq_run_all": "SELECT * FROM dq",
    "dq_gate": "SELECT * FROM gate",
    "alert_records": """SELECT partition_dt, store,
        'Daily counters: quality ' || verdict || ' ' || strftime(partition_dt, '%Y-%m-%d') || '/' || store AS subject,
        'Partition ' || strftime(partition_dt, '%Y-%m-%d') || '/' || store
          || CASE verdict WHEN 'block' THEN ' kept out' ELSE ' written' END || ' (' || failures || ')' AS message
      FROM gate WHERE verdict <> 'pass'""",
    # versions and gold
    "dedup_versions": """SELECT * FROM latest WHERE dt >= DATE '2024-01-21'
      UNION ALL SELECT * FROM versions WHERE dt < DATE '2024-01-21'""",
    "dedup_versions_in_place": """SELECT * FROM latest WHERE dt >= DATE '2024-01-21'
      UNION ALL SELECT * FROM versions WHERE dt < DATE '2024-01-21'""",
    "latest_view": "SELECT * FROM latest",
    "gold_daily_by_app": _gold_app("versions"),
    "gold_daily_by_country": _gold_country("versions"),
    "gold_paid_vs_organic_trend": f"SELECT * FROM ({_gold_trend('versions')}) WHERE dt >= DATE '2024-01-01'",
    "gold_trend_all_days": _gold_trend("versions"),
    "gold_from_latest": _gold_app("latest"),
    "gold_from_latest_country": _gold_country("latest"),
    "gold_refresh_incremental": _gold_app("versions"),
    "gold_refresh_incremental_country": _gold_country("versions"),
    "gold_refresh_incremental_trend": _gold_trend("versions"),
    "force_refresh": _gold_country("versions"),
    "force_refresh_app": _gold_app("versions"),
    "force_refresh_trend": _gold_trend("versions"),
    "refresh_history": _first("refr", "name", "refresh_end_time DESC NULLS LAST, refresh_start_time DESC"),
    "gold_staleness": f"""SELECT name, state, refresh_start_time, refresh_end_time,
        refresh_end_time IS NULL OR refresh_end_time + INTERVAL 61 MINUTE <= TIMESTAMP '2024-02-01 12:00:00' AS is_stale
      FROM ({_first("refr", "name", "refresh_end_time DESC NULLS LAST, refresh_start_time DESC")})""",
    # audits
    "audit_total_split": f"""SELECT {KEY}, downloads_total, downloads_featured, downloads_organic, {SPLIT} AS sum_split,
        downloads_total - ({SPLIT}) AS delta FROM wide_now WHERE downloads_total <> {SPLIT}
      ORDER BY ABS(delta) DESC, {KEY}""",
    "audit_paid_unpaid_split": f"""SELECT {KEY}, downloads_total, {PAID} AS paid_total, {UNPAID} AS unpaid_total,
        downloads_total - ({PAID}) - ({UNPAID}) AS delta FROM wide_now WHERE downloads_total <> {LEAVES}
      ORDER BY ABS(delta) DESC, {KEY}""",
    "audit_featured_leaves": "SELECT " + _count("downloads_featured <> downloads_paid_featured + downloads_unpaid_featured", "featured_eq_violations") + " FROM dirty",
    "audit_organic_leaves": "SELECT " + _count("downloads_organic <> downloads_paid_organic + downloads_unpaid_organic", "organic_eq_violations") + " FROM copy_r",
    "audit_violation_rate_by_dt": f"""SELECT dt, COUNT(*) AS total_rows, {_count(f"downloads_total <> {SPLIT}", "eq1_violations")},
        {_count("downloads_featured <> downloads_paid_featured + downloads_unpaid_featured", "eq2_violations")},
        {_count("downloads_organic <> downloads_paid_organic + downloads_unpaid_organic", "eq3_violations")},
        {_pct(f"COUNT(*) FILTER (WHERE downloads_total <> {SPLIT})", "COUNT(*)", 4)} AS eq1_violation_pct
      FROM wide_now WHERE dt >= DATE '2024-01-17' GROUP BY dt""",
    "audit_paid_share_recalc": f"""SELECT {KEY}, downloads_total, downloads_paid_featured, downloads_paid_organic,
        paid_share AS paid_share_stored, {PAID_AGAIN} AS paid_share_recomputed, ROUND({PAID_OFF}, 6) AS delta
      FROM mixed WHERE downloads_total > 0 AND {PAID_OFF} > 1e-4 ORDER BY delta DESC, {KEY}""",
    "audit_featured_share_recalc": f"""SELECT {KEY}, downloads_total, downloads_featured, featured_share AS featured_share_stored,
        {FEATURED_AGAIN} AS featured_share_recomputed
      FROM mixed WHERE downloads_total > 0 AND {FEATURED_OFF} > 1e-4""",
    "audit_both_shares_recalc": f"""SELECT {KEY}, paid_share, {PAID_AGAIN} AS paid_share_recalc, featured_share,
        {FEATURED_AGAIN} AS featured_share_recalc
      FROM mixed WHERE downloads_total > 0 AND ({PAID_OFF} > 1e-4 OR {FEATURED_OFF} > 1e-4)""",
    "audit_share_bounds": f"""SELECT {_count("paid_share < 0 OR paid_share > 1", "paid_share_oob")},
        {_count("featured_share < 0 OR featured_share > 1", "featured_share_oob")}, {_count("paid_share IS NULL", "paid_share_null")},
        {_count("featured_share IS NULL", "featured_share_null")}, {_count("downloads_total = 0", "zero_total_rows")} FROM copy_r""",
    "audit_wide_duplicates": f"""SELECT {KEY}, COUNT(*) AS dup_count FROM versions GROUP BY {KEY} HAVING COUNT(*) > 1
      ORDER BY dup_count DESC, {KEY}""",
    "audit_wide_null_pct": "SELECT COUNT(*) AS total_rows, " + ", ".join(
        f"{_pct(f'COUNT(*) - COUNT({c})', 'COUNT(*)', 6)} AS pct_null_{n}"
        for n, c in (("product", "product_id"), ("country", "country"), ("store", "app_store"), ("device", "device"), ("dt", "dt"))
    ) + " FROM dirty",
    "audit_dt_profile": f"""SELECT dt, COUNT(*) AS row_count, MIN(ingest_ts) AS first_write, MAX(ingest_ts) AS last_write,
        MAX(_loaded_at) AS last_load, CAST(SUM(downloads_total) AS BIGINT) AS total_downloads,
        {_count("is_estimate_final", "finalized_rows")}, {_count("NOT is_estimate_final", "preview_rows")}
      FROM versions GROUP BY dt""",
    "audit_wide_negatives": f"SELECT {NEGATIVES} FROM dirty",
    "audit_narrow_coverage": f"""SELECT dt, store, COUNT(*) AS row_count, COUNT(DISTINCT product_id) AS distinct_products,
        COUNT(DISTINCT country) AS distinct_countries, MIN(ingest_ts) AS first_ingest, MAX(ingest_ts) AS last_ingest,
        {_count("store <> app_store", "misplaced_rows")}
      FROM ev_bronze WHERE dt >= DATE '2024-01-17' GROUP BY dt, store""",
    "audit_channel_domain": """SELECT channel, COUNT(*) AS row_count,
        channel IN ('paid_featured', 'paid_organic', 'unpaid_featured', 'unpaid_organic') AS in_domain
      FROM ev_bronze GROUP BY channel""",
    "audit_channel_completeness": f"""SELECT channel_count, COUNT(*) AS group_count
      FROM (SELECT {KEY}, COUNT(DISTINCT channel) AS channel_count FROM ev_raw GROUP BY {KEY}) GROUP BY channel_count""",
    "audit_channel_completeness_bulk": f"""SELECT channel_count, COUNT(*) AS group_count
      FROM (SELECT {KEY}, COUNT(DISTINCT channel) AS channel_count FROM bulk_raw GROUP BY {KEY}) GROUP BY channel_count""",
    "audit_share_sum": f"""SELECT {KEY}, CAST(SUM(share_pct) AS DOUBLE) AS share_sum, COUNT(*) AS channel_count
      FROM ev_narrow GROUP BY {KEY} HAVING ABS(CAST(SUM(share_pct) AS DOUBLE) - 1) > 1e-3""",
    "audit_narrow_quality": f"""SELECT COUNT(*) AS total, {_pct("COUNT(*) - COUNT(product_id)", "COUNT(*)", 6)} AS pct_null_product,
        {_pct("COUNT(*) - COUNT(channel)", "COUNT(*)", 6)} AS pct_null_channel,
        {_pct("COUNT(*) - COUNT(downloads)", "COUNT(*)", 6)} AS pct_null_downloads,
        {_count("downloads < 0", "neg_downloads")}, {_count("share_pct < 0 OR share_pct > 1", "oob_share")}
      FROM (SELECT product_id, NULLIF(channel, 'error') AS channel, downloads, share_pct FROM ev_narrow)""",
    "audit_narrow_duplicates": f"SELECT {KEY}, channel, COUNT(*) AS dup_count FROM ev_raw GROUP BY {KEY}, channel HAVING COUNT(*) > 1",
    "audit_wide_key_summary": f"""SELECT CAST(SUM(n) AS BIGINT) AS total_rows, COUNT(*) AS distinct_groups, {_count("n > 1", "duplicate_groups")}
      FROM (SELECT {KEY}, COUNT(*) AS n FROM versions GROUP BY {KEY})""",
    "audit_equations": f"""SELECT COUNT(*) AS total_rows, {_count(f"downloads_total <> {SPLIT}", "eq1_violations")},
        {_count(f"downloads_total <> {LEAVES}", "eq2_violations")},
        {_count("downloads_featured <> downloads_paid_featured + downloads_unpaid_featured", "eq3_violations")},
        {_count("downloads_organic <> downloads_paid_organic + downloads_unpaid_organic", "eq4_violations")} FROM copy_r""",
    "smoke_wide": " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, COUNT(*) AS n FROM mixed WHERE {wrong}"
        for name, wrong in (
            ("eq_total_split1", f"downloads_total <> {SPLIT}"),
            ("eq_total_split2", f"downloads_total <> {LEAVES}"),
            ("eq_featured", "downloads_featured <> downloads_paid_featured + downloads_unpaid_featured"),
            ("eq_organic", "downloads_organic <> downloads_paid_organic + downloads_unpaid_organic"),
            ("paid_share_oob", "paid_share < 0 OR paid_share > 1"),
            ("featured_share_oob", "featured_share < 0 OR featured_share > 1"),
            ("null_product", "product_id IS NULL"),
        )
    ) + f""" UNION ALL SELECT 'duplicate_pk', COUNT(*) FROM
      (SELECT {KEY} FROM mixed GROUP BY {KEY} HAVING COUNT(*) > 1)""",
    # reconciliation
    "recon_row_count": f"""SELECT b AS bronze_distinct_groups, s AS silver_rows, b - s AS delta
      FROM (SELECT COUNT(DISTINCT ({KEY})) AS b FROM narrow_cut), (SELECT COUNT(*) AS s FROM wide_lag)""",
    "recon_pivot_rows": _recon_pivot("ev_bronze", "wide_lag"),
    "recon_pivot_rows_bulk": _recon_pivot("bulk_bronze", "bulk_stale"),
    "recon_missing_in_silver": f"SELECT DISTINCT {KEY} FROM narrow_cut b WHERE NOT EXISTS (SELECT 1 FROM wide_lag s WHERE {_join_on('s', 'b')})",
    "recon_extra_in_silver": f"SELECT {KEY} FROM wide_lag s WHERE NOT EXISTS (SELECT 1 FROM narrow_cut b WHERE {_join_on('s', 'b')})",
    "recon_share_sums": f"""SELECT s.dt, s.product_id, s.app_store, s.country, s.device, paid_share, ROUND(b_paid, 4) AS b_paid_share,
        featured_share, ROUND(b_featured, 4) AS b_featured_share,
        ROUND(ABS(CAST(paid_share AS DOUBLE) - b_paid), 6) AS d_paid, ROUND(ABS(CAST(featured_share AS DOUBLE) - b_featured), 6) AS d_featured
      FROM wide_lag s JOIN (SELECT {KEY},
          CAST(SUM(CASE WHEN channel IN ('paid_featured', 'paid_organic') THEN share_pct ELSE 0 END) AS DOUBLE) AS b_paid,
          CAST(SUM(CASE WHEN channel IN ('paid_featured', 'unpaid_featured') THEN share_pct ELSE 0 END) AS DOUBLE) AS b_featured
        FROM ev_narrow GROUP BY {KEY}) b ON {_join_on("s", "b")}
      WHERE ABS(CAST(paid_share AS DOUBLE) - b_paid) > 2e-4 OR ABS(CAST(featured_share AS DOUBLE) - b_featured) > 2e-4""",
    "recon_counts_by_dt": """SELECT COALESCE(s.dt, v.dt) AS dt, silver_rows, loaded_rows,
        COALESCE(loaded_rows, 0) - COALESCE(silver_rows, 0) AS d_rows, silver_total, loaded_total,
        COALESCE(loaded_total, 0) - COALESCE(silver_total, 0) AS d_total
      FROM (SELECT dt, COUNT(*) AS silver_rows, CAST(SUM(downloads_total) AS BIGINT) AS silver_total FROM wide_lag GROUP BY dt) s
      FULL JOIN (SELECT dt, COUNT(*) AS loaded_rows, CAST(SUM(downloads_total) AS BIGINT) AS loaded_total FROM versions GROUP BY dt) v
      ON s.dt = v.dt""",
    "recon_gold_app": """SELECT dt, product_id, app_store, g_total, s_total, g_rows, s_rows
      FROM (SELECT dt, product_id, app_store, CAST(SUM(downloads_total) AS BIGINT) AS g_total, COUNT(*) AS g_rows FROM versions GROUP BY ALL)
      JOIN (SELECT dt, product_id, app_store, CAST(SUM(downloads_total) AS BIGINT) AS s_total, COUNT(*) AS s_rows FROM latest GROUP BY ALL)
      USING (dt, product_id, app_store) WHERE g_total <> s_total OR g_rows <> s_rows""",
    "recon_gold_country": """SELECT dt, country, app_store, downloads_total, recalc
      FROM (SELECT dt, country, app_store, CAST(SUM(downloads_total) AS BIGINT) AS downloads_total FROM versions GROUP BY ALL)
      JOIN (SELECT dt, country, app_store, CAST(SUM(downloads_total) AS BIGINT) AS recalc FROM latest GROUP BY ALL)
      USING (dt, country, app_store) WHERE downloads_total <> recalc""",
    "recon_gold_trend": f"""SELECT dt, app_store, downloads_total, {PAID} AS recalc_paid, paid_ratio,
        ROUND(CAST({PAID} AS DOUBLE) / NULLIF(downloads_total, 0), 4) AS recalc_paid_ratio, featured_ratio,
        ROUND(CAST(downloads_featured AS DOUBLE) / NULLIF(downloads_total, 0), 4) AS recalc_featured_ratio
      FROM ({_gold_trend('versions')}) WHERE dt >= DATE '2024-01-01' ORDER BY dt DESC, app_store""",
    "recon_smoke_pivot": f"""SELECT COUNT(*) AS pivot_mismatch FROM wide_lag s JOIN ({_pivot('ev_bronze')}) b ON {_join_on("s", "b")}
      WHERE s.downloads_total <> b.downloads_total OR s.downloads_featured <> b.downloads_featured
        OR s.downloads_paid_featured <> b.downloads_paid_featured OR s.downloads_paid_organic <> b.downloads_paid_organic
        OR s.downloads_unpaid_featured <> b.downloads_unpaid_featured OR s.downloads_unpaid_organic <> b.downloads_unpaid_organic""",
    "recon_load_vs_table": """SELECT COALESCE(h.dt, t.dt) AS dt, COALESCE(files, 0) AS files, COALESCE(history_rows, 0) AS history_rows,
        COALESCE(table_rows, 0) AS table_rows, COALESCE(history_rows, 0) - COALESCE(table_rows, 0) AS delta
      FROM (SELECT dt, COUNT(*) AS files, CAST(SUM(row_count) AS BIGINT) AS history_rows FROM hist GROUP BY dt) h
      FULL JOIN (SELECT dt, COUNT(*) AS table_rows FROM latest GROUP BY dt) t ON h.dt = t.dt""",
    "recon_file_manifest": """SELECT w.dt, files_written, COALESCE(files_loaded, 0) AS files_loaded, COALESCE(rows_loaded, 0) AS rows_loaded,
        files_written - COALESCE(files_loaded, 0) AS files_missing
      FROM (SELECT dt, COUNT(*) AS files_written FROM files_now GROUP BY dt) w
      LEFT JOIN (SELECT dt, COUNT(DISTINCT file_name) AS files_loaded, CAST(SUM(row_count) AS BIGINT) AS rows_loaded FROM hist GROUP BY dt) h
      ON w.dt = h.dt""",
    # business reports
    "bi_top_apps": f"""SELECT dt, app_store, product_id, total_dl, paid_dl, {_pct("paid_dl", "total_dl", 2)} AS paid_pct
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY dt, app_store ORDER BY total_dl DESC, product_id) AS rn
        FROM (SELECT dt, app_store, product_id, CAST(SUM(downloads_total) AS BIGINT) AS total_dl,
          CAST(SUM({PAID}) AS BIGINT) AS paid_dl FROM latest GROUP BY ALL)) WHERE rn <= 10""",
    "bi_country_store_matrix": """SELECT country,
        CAST(SUM(CASE WHEN app_store = 'ios' THEN downloads_total END) AS BIGINT) AS ios_total,
        CAST(SUM(CASE WHEN app_store = 'google-play' THEN downloads_total END) AS BIGINT) AS gp_total
      FROM latest GROUP BY country ORDER BY ios_total DESC NULLS LAST, country LIMIT 20""",
    "bi_weekly_paid_trend": f"""SELECT CAST(date_trunc('week', dt) AS DATE) AS week_start, app_store,
        CAST(SUM(downloads_total) AS BIGINT) AS total, {_pct(f"SUM({PAID})", "SUM(downloads_total)", 2)} AS paid_pct
      FROM latest WHERE dt >= DATE '2023-12-06' GROUP BY 1, 2""",
    "bi_wow": f"""SELECT product_id, app_store, this_week, prior_week, {_pct("this_week - prior_week", "prior_week", 2)} AS wow_pct
      FROM (SELECT product_id, app_store,
          CAST(SUM(CASE WHEN dt BETWEEN DATE '2024-01-24' AND DATE '2024-01-30' THEN downloads_total END) AS BIGINT) AS this_week,
          CAST(SUM(CASE WHEN dt BETWEEN DATE '2024-01-17' AND DATE '2024-01-23' THEN downloads_total END) AS BIGINT) AS prior_week
        FROM latest GROUP BY product_id, app_store)
      WHERE this_week IS NOT NULL ORDER BY wow_pct DESC NULLS LAST, product_id, app_store LIMIT 20""",
    "bi_dod7": f"""SELECT c.dt, c.product_id, c.app_store, c.total AS this_dt, p.total AS prior_dt, {_pct("c.total - p.total", "p.total", 2)} AS dow7_pct
      FROM daily c LEFT JOIN daily p ON p.product_id = c.product_id AND p.app_store = c.app_store AND p.dt = c.dt - INTERVAL 7 DAY""",
    "bi_rolling7": "SELECT * FROM rolling",
    "bi_rolling7_vs_prior": """SELECT c.dt, c.product_id, c.app_store, c.rolling7, p.rolling7 AS prior_rolling7,
        ROUND(c.rolling7 - p.rolling7, 4) AS rolling7_delta
      FROM rolling c LEFT JOIN rolling p ON p.product_id = c.product_id AND p.app_store = c.app_store AND p.dt = c.dt - INTERVAL 7 DAY""",
    "bi_finalization": f"""SELECT dt, {_count("is_estimate_final", "finalized_rows")}, {_count("NOT is_estimate_final", "preview_rows")},
        {_pct("COUNT(*) FILTER (WHERE is_estimate_final)", "COUNT(*)", 1)} AS pct_finalized FROM versions GROUP BY dt""",
    "bi_finalized_only": "SELECT * FROM latest WHERE is_estimate_final",
    "finalized_changed": f"""
      SELECT v.dt, v.product_id, v.app_store, v.country, v.device, f._loaded_at AS final_loaded_at, f.downloads_total AS final_total,
        v._loaded_at, v.downloads_total, v.downloads_total - f.downloads_total AS delta
      FROM versions v JOIN ({_first("(SELECT * FROM versions WHERE is_estimate_final)", KEY, "_loaded_at, downloads_total")}) f
        ON {_join_on("v", "f")}
      WHERE v._loaded_at > f._loaded_at AND ({" OR ".join(f"v.{c} <> f.{c}" for c in MEASURES.split(", "))})""",
    "enrich_country": """SELECT b.dt, b.product_id, b.app_store, b.country, b.device, b.channel, b.downloads, r.r_name AS region
      FROM bulk_raw b LEFT JOIN (SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) r ON b.country = r.n_name""",
    # parity
    "parity_checksum": "SELECT dt, row_cnt, row_checksum FROM prof_l",
    "parity_checksum_bulk": "SELECT dt, row_cnt, row_checksum FROM prof_bulk",
    "parity_stats": "SELECT dt, " + ", ".join(
        f"ROUND({c}_sum, 6) AS {c}_sum, ROUND({c}_sumsq, 8) AS {c}_sumsq, {c}_min, {c}_max, {c}_null_cnt"
        for c in ("paid_share", "featured_share")
    ) + " FROM prof_r",
    "parity_compare": _compare(),
    "parity_diff_rows": _diff_rows(),
    "parity_leaves": f"SELECT dt, issue FROM ({_diff_rows()})",
    "parity_validate": _diff_rows(),
    # monitors
    "mon_missing_partitions": """SELECT d AS dt, s AS store FROM
      (SELECT UNNEST([DATE '2024-01-28', DATE '2024-01-29', DATE '2024-01-30', DATE '2024-01-31']) AS d),
      (SELECT UNNEST(['ios', 'google-play']) AS s)
      WHERE (d, s) NOT IN (SELECT (dt, store) FROM files_now)""",
    "mon_stale_runs": """SELECT layer, dt, store, job_run_id, recorded_at, lock_expires_at FROM state
      WHERE status = 'running' AND lock_expires_at < TIMESTAMP '2024-02-01 12:00:00'""",
    "mon_dlq_weekly": """SELECT CASE WHEN NOT readable THEN 'READ_ERROR' ELSE COALESCE(error_type, 'UNKNOWN') END AS error_type,
        COUNT(*) AS records, MAX(recorded_at) AS last_seen
      FROM errlog WHERE recorded_at >= TIMESTAMP '2024-01-25 10:00:00' GROUP BY 1""",
    "mon_dlq_entries": " UNION ALL ".join(
        f"""SELECT '{kind}' AS kind, COUNT(*) AS entries, CAST({held} AS BIGINT) AS rows_held, CAST(1 AS BIGINT) AS runs,
        DATE '2024-01-31' AS last_failed
      FROM (SELECT dt, store, COUNT(*) AS n FROM ev_raw WHERE dt IN (DATE '2024-01-05', DATE '2024-01-06') GROUP BY dt, store)"""
        for kind, held in (("raw", "SUM(n)"), ("error", "COUNT(*)"))
    ),
    "mon_dlq_recent": """SELECT error_type, source_file, recorded_at, GREATEST(total - 20, 0) AS more
      FROM (SELECT *, COUNT(*) OVER () AS total FROM errlog WHERE recorded_at >= TIMESTAMP '2024-01-25 10:00:00')
      ORDER BY recorded_at DESC, source_file, error_type LIMIT 20""",
    "mon_load_freshness": """SELECT DATE '2024-02-02' AS day, COUNT(*) AS loads_today FROM hist
      WHERE CAST(last_load_time AS DATE) = DATE '2024-02-02' HAVING COUNT(*) = 0""",
    "mon_refresh_failed": "SELECT * FROM refr WHERE state = 'FAILED' AND refresh_start_time >= TIMESTAMP '2024-02-01 11:00:00'",
    "mon_load_errors": "SELECT * FROM hist WHERE status <> 'Loaded'",
    "mon_key_skew": """SELECT CAST(COUNT(*) AS BIGINT) AS keys, MAX(n) AS max_rows, CAST(MEDIAN(n) AS DOUBLE) AS median_rows,
        MAX(n) >= 10 * MEDIAN(n) AS suspicious
      FROM (SELECT product_id, country, COUNT(*) AS n FROM ev_raw GROUP BY product_id, country)""",
}

# The wide table with three days of wrong shares, for the share audits.
SHARED["mixed"] = f"""
  SELECT {KEY}, downloads_total, downloads_featured, downloads_organic, downloads_paid_featured, downloads_paid_organic,
    downloads_unpaid_featured, downloads_unpaid_organic,
    CAST(CASE WHEN dt = DATE '2024-01-12' THEN paid_share + 0.0200 WHEN dt = DATE '2024-01-13' THEN 1.5 ELSE paid_share END AS DECIMAL(6,4)) AS paid_share,
    CAST(CASE WHEN dt = DATE '2024-01-14' THEN featured_share - 0.0300 ELSE featured_share END AS DECIMAL(6,4)) AS featured_share,
    is_estimate_final FROM versions"""
SHARED["daily"] = """SELECT dt, product_id, app_store, CAST(SUM(downloads_total) AS BIGINT) AS total FROM latest
  GROUP BY dt, product_id, app_store"""
SHARED["rolling"] = """SELECT dt, product_id, app_store, total, ROUND(AVG(total) OVER (PARTITION BY product_id, app_store
  ORDER BY dt ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS rolling7 FROM daily"""
SHARED["prof_bulk"] = _profile("bulk_stale")


def oracle_sql() -> dict[str, str]:
    return {name: _with(sql) for name, sql in RAW_SQL.items()}
