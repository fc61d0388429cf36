"""SQL answers of the queries over stored tables and flows."""

from __future__ import annotations

from indicora import vocab

_DIRECTED = set().union(*vocab.DIRECTIONS.values())


def answers(sensor: str, checked: str, routed: str, ops: str, obs: str, series: str, full: str) -> dict[str, str]:
    """``sensor`` to ``obs``: common table expressions; ``full``: the format of shown times."""
    raw = """raw AS (
      SELECT CASE c_nationkey % 6 WHEN 0 THEN 'Vietnam' WHEN 1 THEN 'Laos' WHEN 2 THEN 'Thailand' WHEN 3 THEN 'Brunei' WHEN 4 THEN 'Myanmar' END AS country,
        CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, count(*) AS n
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""
    return {
        "concurrent_versions": """SELECT o_orderkey % 4 AS writer, count(*) AS n, round(sum(o_totalprice), 2) AS total, 4 AS versions
            FROM orders GROUP BY 1""",
        "ledger_known": f"""WITH {sensor} SELECT strftime(seen_at, '%Y-%m-%d') AS event_day, count(*) AS asked,
            count(*) FILTER (seq % 5 < 3) AS known FROM sensor GROUP BY 1""",
        "fact_load_incremental": f"""WITH {checked}, f AS (SELECT seq % 3 AS k FROM checked WHERE fine),
            n AS (SELECT count(*) AS n, count(*) FILTER (k < 2) AS a, count(*) FILTER (k > 0) AS b, count(*) FILTER (k = 2) AS c FROM f)
            SELECT 'first' AS load, a AS input, a AS inserted, CAST(0 AS BIGINT) AS duplicates FROM n UNION ALL SELECT 'second', b, c, b - c FROM n
            UNION ALL SELECT 'second again', b, c, b - c FROM n UNION ALL SELECT 'late copy', b, 0, b FROM n UNION ALL SELECT 'stored', n, n, 0 FROM n""",
        "health_load_incremental": f"WITH {obs} SELECT year, count(*) AS n, round(sum(value), 2) AS total FROM obs GROUP BY 1",
        "outbox_sync": f"""WITH {sensor}, n AS (SELECT count(*) FILTER (seq % 4 = 3) AS w, count(*) FILTER (seq % 4 < 3) AS a FROM sensor)
            SELECT 'unsynchronised' AS status, CAST(1 AS BIGINT) AS chunks, w AS records FROM n UNION ALL SELECT 'pending', 0, 0
            UNION ALL SELECT 'acknowledged', 3, a FROM n UNION ALL SELECT 'received, distinct', a, a FROM n""",
        "corrected_replay": f"""WITH {checked}, n AS (SELECT count(*) FILTER (fine) AS f, count(*) FILTER (NOT fine AND retry_count < 5) AS r,
              count(*) FILTER (NOT fine AND retry_count >= 5) AS d, count(*) FILTER (NOT fine AND retry_count = 6) AS x FROM checked)
            SELECT f + x AS accepted, CAST(0 AS BIGINT) AS duplicate, r AS retry, d AS dlq, d AS letters, x AS resolved,
              CASE WHEN x > 0 THEN 'corrected' END AS note FROM n""",
        "latency_stream": f"""WITH w AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS b, count(*) AS events, quantile_disc(value / 100, 0.95) AS q FROM events GROUP BY 1)
            SELECT strftime(b, {full}) AS window_start, events, round(q, 6) AS p95, q > 2.0 AS alerting FROM w
            WHERE b + INTERVAL '1 hour' <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'""",
        "late_data": f"""WITH {ops}, w AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS b, count(*) AS events, count(*) FILTER (status = 'failed') AS errors FROM ops GROUP BY 1)
            SELECT count(*) AS windows, count(*) AS starts, CAST(sum(events) AS BIGINT) AS events, CAST(sum(errors) AS BIGINT) AS errors FROM w
            WHERE b + INTERVAL '1 hour' <= (SELECT max(ts) FROM ops) - INTERVAL '10 minutes'""",
        "dlq_growth": f"""WITH {routed}, w AS (SELECT time_bucket(INTERVAL '1 hour', seen_at) AS b, count(*) AS n FROM routed WHERE outcome = 'dlq' GROUP BY 1),
            p AS (SELECT w.b, w.n, CAST(coalesce(sum(e.n), 0) AS BIGINT) AS before FROM w LEFT JOIN w e ON e.b < w.b AND e.b >= w.b - INTERVAL '3 hours' GROUP BY 1, 2)
            SELECT strftime(b, {full}) AS window_start, n AS letters, before, n >= 2 AND n * 3 > before * 1.5 AS alerting FROM p""",
        "deep_page": """WITH o AS (SELECT *, row_number() OVER (ORDER BY l_returnflag, l_shipdate, l_orderkey, l_linenumber) AS row_number, count(*) OVER () AS n FROM lineitem)
            SELECT row_number, l_returnflag, l_orderkey, l_linenumber FROM o WHERE row_number > n // 2 AND row_number <= n // 2 + 200""",
        "output_order": f"""WITH {obs} SELECT row_number() OVER (ORDER BY indicator, country, year, sub_indicator) AS row_number,
            indicator, country, year, sub_indicator, round(value, 2) AS value FROM obs""",
        "retention_job": """WITH l AS (SELECT strftime(l_shipdate, '%Y-%m') AS month, l_orderkey, l_linestatus = 'F' AS closed,
              l_shipdate > TIMESTAMP '2001-06-15' - INTERVAL 12 MONTH AS young FROM lineitem)
            SELECT month, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS order_keys, 'accepted' AS kind FROM l WHERE young GROUP BY 1
            UNION ALL SELECT month, count(*), CAST(sum(l_orderkey) AS BIGINT), 'dlq' FROM l WHERE young OR NOT closed GROUP BY 1""",
        "raw_folder_etl": f"""WITH {raw} SELECT 'open_orders_total' AS indicator, country, year, CAST(NULL AS VARCHAR) AS unit, CAST(n AS DOUBLE) AS value
            FROM raw WHERE country IS NOT NULL AND o_orderstatus = 'O'
            UNION ALL SELECT 'filled_orders', country, year, 'orders', CAST(n AS DOUBLE) FROM raw WHERE country IS NOT NULL AND o_orderstatus = 'F'""",
        "raw_folder_report": f"""WITH {raw}, k AS (SELECT * FROM raw WHERE country IS NOT NULL)
            SELECT 'Open  Orders (Total).csv' AS file_name, 'processed' AS status, count(*) FILTER (o_orderstatus = 'O') AS rows, FALSE AS has_reason FROM k
            UNION ALL SELECT 'filled_orders.csv', 'processed', count(*) FILTER (o_orderstatus = 'F'), FALSE FROM k
            UNION ALL SELECT 'no_place.csv', 'skipped', 0, TRUE UNION ALL SELECT 'no_rows.csv', 'skipped', 0, TRUE""",
        "raw_folder_charsets": "SELECT * FROM (VALUES ('Open  Orders (Total).csv', 'windows-1252'), ('filled_orders.csv', 'UTF-8')) v(file_name, charset)",
        "typed_scan": """SELECT o_orderstatus AS country, o_orderpriority AS indicator, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n,
            round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0 GROUP BY 1, 2, 3""",
        "tree_samples": """WITH r AS (SELECT count(*) AS n FROM (SELECT DISTINCT o_custkey, year(o_orderdate) FROM orders))
            SELECT CAST(tree AS INTEGER) AS tree, least(256, n) AS n, least(256, n) AS most, CAST(1 AS BIGINT) AS samples FROM r, range(2) t(tree)""",
        "regression_stump": """WITH f AS (SELECT 0 AS i, 'l_tax' AS feature, l_tax AS v, l_extendedprice AS y FROM lineitem
              UNION ALL SELECT 1, 'l_quantity', l_quantity, l_extendedprice FROM lineitem UNION ALL SELECT 2, 'l_discount', l_discount, l_extendedprice FROM lineitem),
            c AS (SELECT i, feature, v AS cut, count(*) AS n, sum(y) AS s FROM f GROUP BY ALL),
            r AS (SELECT *, lead(cut) OVER b AS past, sum(n) OVER b AS nl, sum(s) OVER b AS sl, sum(n) OVER w AS na, sum(s) OVER w AS sa FROM c
                  WINDOW b AS (PARTITION BY i ORDER BY cut), w AS (PARTITION BY i))
            SELECT feature, (cut + past) / 2 AS cut, round(sl / nl, 2) AS value_low, round((sa - sl) / (na - nl), 2) AS value_high, CAST(2 AS BIGINT) AS leaves
            FROM r WHERE nl < na ORDER BY sl * sl / nl + (sa - sl) * (sa - sl) / (na - nl) DESC, i LIMIT 1""",
        "importance_facts": f"""WITH {series}, n AS (SELECT country, indicator FROM ser GROUP BY 1, 2 HAVING count(*) >= 4),
            k AS (SELECT count(DISTINCT country) + count(DISTINCT indicator) + 6 AS k FROM n)
            SELECT k AS features, CAST(0 AS BIGINT) AS negative, 1.0::DOUBLE AS total, CAST(least(15, k) AS INTEGER) AS top, TRUE AS in_order FROM k""",
        "direction_union": f"""SELECT o_orderkey % {len(_DIRECTED) + 2} AS slot, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
            WHERE o_orderkey % {len(_DIRECTED) + 2} < {len(_DIRECTED)} GROUP BY 1""",
        "registry_entries": f"""WITH {series} SELECT 'forecast' AS kind, 'forecast-2' AS version, count(*) AS rows, count(DISTINCT country) AS countries,
            count(DISTINCT indicator) AS indicators, min(year) AS year_min, max(year) AS year_max, CAST(3 AS BIGINT) AS entries FROM ser WHERE year <= 1996""",
        "metadata_scan": "SELECT TRUE AS present, p_type AS kind, count(*) AS n, count(*) AS whole FROM part GROUP BY 2",
    }
