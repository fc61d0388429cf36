"""Reference answers in SQL, written from the meaning of each query, not from its plan."""

from __future__ import annotations

from indicora import vocab
from indicora.plans.table_oracles import answers

_BASE = """orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey"""

OBS = f"""obs AS (
  SELECT n.n_name AS country, CAST(year(o.o_orderdate) AS INTEGER) AS year,
         o.o_orderpriority AS indicator, o.o_orderstatus AS sub_indicator,
         avg(o.o_totalprice) AS value
  FROM {_BASE} GROUP BY 1, 2, 3, 4)"""
SERIES = f"""ser AS (
  SELECT n.n_name AS country, o.o_orderpriority AS indicator,
         CAST(year(o.o_orderdate) AS INTEGER) AS year, avg(o.o_totalprice) AS value
  FROM {_BASE} GROUP BY 1, 2, 3)"""
MONTHLY = f"""mon AS (
  SELECT n.n_name AS country, o.o_orderpriority AS indicator,
         CAST(year(o.o_orderdate) * 12 + month(o.o_orderdate) AS INTEGER) AS year,
         avg(o.o_totalprice) AS value
  FROM {_BASE} GROUP BY 1, 2, 3)"""
SENSOR = """sensor AS (
  SELECT e.event_id AS seq, CAST(e.event_id AS VARCHAR) AS event_id,
         'NA-STN-' || lpad(CAST(e.user_id % 100 AS VARCHAR), 2, '0') AS station_id,
         n.n_name AS country, strftime(e.ts, '%Y-%m-%dT%H:%M:%SZ') AS stamp,
         date_trunc('second', e.ts) AS seen_at,
         e.value AS temperature_c,
         CAST(json_extract_string(e.props, '$.k') AS DOUBLE) AS humidity_pct,
         e.value AS rainfall_mm, CAST(e.event_id % 8 AS INTEGER) AS retry_count
  FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 25)"""
CHECKED = SENSOR + """, checked AS (
  SELECT *, (regexp_matches(station_id, '^[A-Z]{2}-[A-Z]{3}-[0-9]{2}$')
     AND temperature_c BETWEEN -20 AND 60 AND humidity_pct BETWEEN 0 AND 100
     AND rainfall_mm >= 0 AND length(stamp) >= 10) AS fine,
     sha256(event_id || '|' || station_id || '|' || country || '|' || stamp) AS fp
  FROM sensor)"""
ROUTED = CHECKED + """, replay AS (
  SELECT *, 0 AS copy FROM checked
  UNION ALL SELECT *, 1 AS copy FROM checked WHERE seq % 10 = 0),
routed AS (
  SELECT *, CASE
    WHEN fine AND row_number() OVER (PARTITION BY fp, fine ORDER BY copy, seq) = 1 THEN 'accepted'
    WHEN fine THEN 'duplicate'
    WHEN retry_count < 5 THEN 'retry' ELSE 'dlq' END AS outcome
  FROM replay)"""
DIRECTION = """CASE WHEN indicator IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 1 ELSE -1 END"""
COMPONENTS = OBS + f""", newest AS (
  SELECT * FROM obs QUALIFY row_number() OVER (
    PARTITION BY country, indicator, sub_indicator ORDER BY year DESC) = 1),
per_country AS (
  SELECT country, indicator, avg(value) AS latest_value FROM newest GROUP BY 1, 2),
peer AS (
  SELECT country, indicator, value FROM obs QUALIFY row_number() OVER (
    PARTITION BY country, indicator ORDER BY year DESC, sub_indicator DESC) = 1),
spread AS (SELECT indicator, min(value) AS low, max(value) AS high FROM peer GROUP BY 1),
placed AS (
  SELECT country, indicator, latest_value,
    CASE WHEN high = low THEN 0.5 ELSE (latest_value - low) / (high - low) END AS place
  FROM per_country JOIN spread USING (indicator)),
components AS (
  SELECT country, indicator, round(latest_value, 3) AS latest_value,
    round(greatest(0.0, least(100.0,
      100 * CASE WHEN {DIRECTION} = 1 THEN place ELSE 1 - place END)), 2) AS risk_contribution
  FROM placed),
scored AS (
  SELECT country, round(avg(risk_contribution), 2) AS risk_score, count(*) AS indicators_used
  FROM components GROUP BY 1)"""


def _band(column: str, first: float, second: float) -> str:
    return f"CASE WHEN {column} < {first} THEN 'low' WHEN {column} < {second} THEN 'moderate' ELSE 'high' END"


def _jumps(threshold: float) -> str:
    return MONTHLY + f""", moved AS (
  SELECT *, lag(value) OVER w AS prev, value - lag(value) OVER w AS chg FROM mon
  WINDOW w AS (PARTITION BY country, indicator ORDER BY year)),
graded AS (
  SELECT *, count(value) OVER p AS points, avg(chg) OVER p AS m, stddev_pop(chg) OVER p AS s
  FROM moved WINDOW p AS (PARTITION BY country, indicator)),
zs AS (SELECT *, abs((chg - m) / s) AS z FROM graded WHERE points >= 4 AND s > 0 AND chg IS NOT NULL),
jumps AS (
  SELECT country, indicator, year, round(value, 3) AS value, round(prev, 3) AS previous_value,
    round(chg, 3) AS absolute_change, round(chg / nullif(abs(prev), 0) * 100, 2) AS percentage_change,
    round(z, 2) AS z_score,
    CASE WHEN z >= {threshold} + 1 THEN 'high' ELSE 'moderate' END AS severity
  FROM zs WHERE z >= {threshold})"""


FRAME = SERIES + """, lagged AS (
  SELECT *, lag(value, 1) OVER w AS lag1, lag(value, 2) OVER w AS lag2,
    avg(value) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS rolling_mean_3,
    stddev_pop(value) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS rolling_std_3,
    row_number() OVER (PARTITION BY country, indicator ORDER BY year DESC) = 1 AS held_out
  FROM ser WINDOW w AS (PARTITION BY country, indicator ORDER BY year)),
frame AS (SELECT *, lag1 - lag2 AS trend_delta FROM lagged WHERE lag2 IS NOT NULL)"""
CHANGES = SERIES + """, changes AS (
  SELECT *, lag(value) OVER (PARTITION BY country, indicator ORDER BY year) AS previous_value FROM ser),
stats AS (
  SELECT indicator, avg(value) AS vm, CASE WHEN stddev_samp(value) > 0 THEN stddev_samp(value) ELSE 1 END AS vs,
    count(value) AS vc, coalesce(avg(value - previous_value), 0) AS dm,
    CASE WHEN stddev_samp(value - previous_value) > 0 THEN stddev_samp(value - previous_value) ELSE 1 END AS ds,
    count(value - previous_value) AS dc,
    CASE WHEN stddev_pop(value) > 0 THEN stddev_pop(value) ELSE 1 END AS ps,
    min(value) AS lo, max(value) AS hi
  FROM changes GROUP BY 1)"""
DRIFT = SERIES + """, before AS (SELECT * FROM ser WHERE year <= 1997 AND indicator <> '5-LOW'),
base AS (SELECT indicator, avg(value) AS m,
    CASE WHEN stddev_pop(value) > 0 THEN stddev_pop(value) ELSE 1 END AS s,
    count(*) AS n, max(year) AS y FROM before GROUP BY 1),
cur AS (SELECT indicator, avg(value) AS m, count(*) AS n, max(year) AS y FROM ser WHERE year > 1997 GROUP BY 1),
shifted AS (SELECT cur.indicator, abs(cur.m - base.m) / greatest(base.s, 1e-9) AS shift, base.m AS bm,
    base.n AS bn, cur.n AS cn, base.y AS by_, cur.y AS cy FROM cur LEFT JOIN base USING (indicator)),
details AS (SELECT indicator,
    CASE WHEN bm IS NULL THEN 'new_indicator' WHEN shift >= 1 THEN 'drift'
         WHEN shift >= 0.5 THEN 'watch' ELSE 'stable' END AS status,
    round(shift, 4) AS standardized_mean_shift, bn AS baseline_count, cn AS current_count,
    by_ AS baseline_latest_year, cy AS current_latest_year FROM shifted)"""
_METRICS = """round(avg(abs(value - lag1)), 6) AS mae,
  round(sqrt(avg((value - lag1) * (value - lag1))), 6) AS rmse,
  round(1 - sum((value - lag1) * (value - lag1)) / (var_pop(value) * count(*)), 6) AS r2,
  round(avg(CASE WHEN abs(value) + abs(lag1) > 1e-9
    THEN 2 * abs(value - lag1) / (abs(value) + abs(lag1)) ELSE 0 END) * 100, 6) AS smape_pct,
  round(stddev_pop(value - lag1), 6) AS residual_std, count(*) AS test_rows"""
QUALITY = OBS + """, quality AS (
  SELECT count(*) AS record_count, count(DISTINCT country) AS country_count,
    count(DISTINCT indicator) AS indicator_count, min(year) AS year_min, max(year) AS year_max,
    CAST(0 AS BIGINT) AS duplicate_records, CAST(0 AS BIGINT) AS required_field_failures,
    'pass' AS status FROM obs)"""
OPS = """ops AS (
  SELECT event_id, 'svc' || CAST(user_id % 10 AS VARCHAR) AS source, event_type AS kind, ts, value,
    CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'recovered' WHEN 'view' THEN 'info'
      WHEN 'click' THEN 'warning' ELSE 'critical' END AS status FROM events)"""
GRADED = OPS + """, graded AS (
  SELECT *, substr(sha256('api_health|' || source || '|global|general'), 1, 20) AS dedup_key,
    CASE WHEN status = 'critical' THEN 'critical' WHEN value / 100 >= 1.5 THEN 'critical'
      WHEN value / 100 >= 1 THEN 'high' WHEN status = 'failed' THEN 'high'
      WHEN status = 'warning' THEN 'medium' ELSE 'info' END AS severity
  FROM ops)"""
EPISODES = GRADED + """, numbered AS (
  SELECT *, coalesce(sum(CASE WHEN status = 'recovered' THEN 1 ELSE 0 END) OVER (
    PARTITION BY dedup_key ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ep
  FROM graded),
episodes AS (
  SELECT dedup_key, ep, max(source) AS source, 'API availability or latency incident' AS title,
    arg_max(severity, (ts, event_id)) AS severity,
    CASE WHEN bool_or(status = 'recovered') THEN 'resolved' ELSE 'open' END AS status,
    arg_max('signal ' || kind, (ts, event_id)) AS message, arg_max(value, (ts, event_id)) AS value,
    min(ts) AS created, max(ts) AS seen, count(*) AS occurrences
  FROM numbered GROUP BY 1, 2)"""
_FULL = "'%Y-%m-%d %H:%M:%S.%f'"
_EPISODE_COLUMNS = f"""dedup_key, source, title, severity, status, message, value,
  strftime(created, {_FULL}) AS created_at, strftime(seen, {_FULL}) AS last_seen_at, occurrences"""
_RANK = """CASE severity WHEN 'critical' THEN 4 WHEN 'high' THEN 3 WHEN 'medium' THEN 2
  WHEN 'low' THEN 1 ELSE 0 END"""


def _snapped(sql: str) -> str:
    """Make every ``round(x, n)`` round half up on a decimal, free of summation noise."""
    out, at = "", 0
    while (hit := sql.find("round(", at)) >= 0:
        depth, comma, end = 1, -1, hit + 6
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            if sql[end] == "," and depth == 1:
                comma = end
            end += 1
        inner, digits = _snapped(sql[hit + 6 : comma]), int(sql[comma + 1 : end - 1])
        out += sql[at:hit] + f"CAST(round(CAST({inner} AS DECIMAL(30, {digits + 4})), {digits}) AS DOUBLE)"
        at = end
    return out + sql[at:]


def _values(rows: list[tuple]) -> str:
    def cell(item) -> str:
        return "'" + item.replace("'", "''") + "'" if isinstance(item, str) else str(item)

    return ", ".join("(" + ", ".join(cell(i) for i in row) + ")" for row in rows)


_TYPES = "CASE event_id % 6 " + " ".join(
    f"WHEN {i} THEN '{t}'" for i, t in enumerate(vocab.EVENT_TYPES)
) + " END"
_CAUSES = _values(
    [(t, rule[0], rank, cause) for t, rule in vocab.ROOT_CAUSES.items()
     for rank, (cause, _) in enumerate(rule[1], 1)]
)
_PAYLOAD = """'{"event_id":"' || event_id || '","station_id":"' || station_id || '","country":"' || country
  || '","timestamp":"' || stamp || '","temperature_c":' || CAST(temperature_c AS VARCHAR)
  || ',"humidity_pct":' || CAST(humidity_pct AS VARCHAR) || ',"rainfall_mm":' || CAST(rainfall_mm AS VARCHAR)
  || ',"retry_count":' || CAST(retry_count AS VARCHAR) || '}'"""
_OUTCOMES = """count(*) AS input, count(*) FILTER (outcome = 'accepted') AS accepted,
  count(*) FILTER (outcome = 'duplicate') AS duplicate, count(*) FILTER (outcome = 'retry') AS retry,
  count(*) FILTER (outcome = 'dlq') AS dlq,
  greatest(count(*) FILTER (outcome = 'accepted') - count(*), 0) AS recovered,
  count(*) FILTER (outcome = 'accepted') >= count(*) AND count(*) FILTER (outcome = 'dlq') >= 1 AS zero_data_loss"""
_DELAY = "CASE retry_count WHEN 0 THEN 5 WHEN 1 THEN 15 WHEN 2 THEN 45 WHEN 3 THEN 120 ELSE 300 END"


def _violations(source: str, rules: dict[str, str], contract: str | None = None) -> str:
    label = f", '{contract}' AS contract" if contract else ""
    parts = [
        f"SELECT '{name}' AS rule_name, count(*) AS n{label} FROM {source} "
        f"WHERE NOT coalesce({holds}, FALSE) HAVING count(*) > 0"
        for name, holds in rules.items()
    ]
    return " UNION ALL ".join(parts)


_SENSOR_RULES = {
    "station_id_pattern": "regexp_matches(station_id, '^[A-Z]{2}-[A-Z]{3}-[0-9]{2}$')",
    "timestamp_length": "length(stamp) >= 10",
    "temperature_c_range": "temperature_c BETWEEN -20 AND 60",
    "humidity_pct_range": "humidity_pct BETWEEN 0 AND 100",
    "rainfall_mm_range": "rainfall_mm >= 0",
}


def _scenario_rules(low: int, high: int, rain: int) -> dict[str, str]:
    return {
        "country_length": "length(country) BETWEEN 2 AND 80",
        "disease_allowed": "seq % 4 <> 0",
        "temperature_c_range": f"temperature_c BETWEEN {low} AND {high}",
        "rainfall_mm_range": f"rainfall_mm BETWEEN 0 AND {rain}",
        "humidity_pct_range": "humidity_pct BETWEEN 0 AND 100",
    }


_LINE_RULES = {
    "well_formed": "seq % 10 <> 3",
    "known_fields": "seq % 10 NOT IN (3, 7)",
    "event_id_length": "seq % 10 <> 3",
    **{k: f"seq % 10 <> 3 AND {v}" for k, v in _SENSOR_RULES.items()},
}

ORACLES: dict[str, str] = {
    "latest_by_series": f"""WITH {OBS} SELECT country, year, indicator, sub_indicator, round(value, 4) AS value
        FROM obs QUALIFY row_number() OVER (PARTITION BY country, indicator, sub_indicator ORDER BY year DESC) = 1""",
    "latest_by_peer": f"""WITH {OBS} SELECT country, year, indicator, sub_indicator, round(value, 4) AS value
        FROM obs QUALIFY row_number() OVER (PARTITION BY country, indicator ORDER BY year DESC, sub_indicator DESC) = 1""",
    "peer_compare": f"""WITH {OBS}, newest AS (SELECT * FROM obs QUALIFY row_number() OVER (
          PARTITION BY country, indicator ORDER BY year DESC, sub_indicator DESC) = 1),
        peers AS (SELECT indicator, round(avg(value), 3) AS average, round(min(value), 3) AS minimum,
          round(max(value), 3) AS maximum, count(*) AS countries FROM newest GROUP BY 1)
        SELECT indicator, country, year, round(value, 3) AS value, average, minimum, maximum, countries
        FROM newest JOIN peers USING (indicator)""",
    "country_profile": f"""WITH {OBS} SELECT country, max(year) AS latest_year,
        count(DISTINCT indicator) AS indicator_count, count(DISTINCT indicator || '#' || sub_indicator) AS series_count
        FROM obs GROUP BY 1""",
    "country_profile_rows": f"""WITH {OBS} SELECT country, indicator, sub_indicator, year, round(value, 3) AS value
        FROM obs QUALIFY row_number() OVER (PARTITION BY country, indicator, sub_indicator ORDER BY year DESC) = 1""",
    "trend_all": f"""WITH {OBS}, ends AS (SELECT country, indicator,
          arg_min(value, (year, sub_indicator)) AS f, arg_max(value, (year, sub_indicator)) AS l,
          min(year) AS start_year, max(year) AS end_year FROM obs GROUP BY 1, 2)
        SELECT country, indicator, start_year, end_year,
          CASE WHEN l - f > greatest(abs(f) * 0.01, 1e-9) THEN 'increasing'
               WHEN l - f < -greatest(abs(f) * 0.01, 1e-9) THEN 'decreasing' ELSE 'stable' END AS trend,
          round(l - f, 3) AS absolute_change, round((l - f) / nullif(abs(f), 0) * 100, 3) AS percentage_change
        FROM ends""",
    "recent_history": f"""WITH {SERIES}, tail AS (SELECT * FROM ser QUALIFY row_number() OVER (
          PARTITION BY country, indicator ORDER BY year DESC) <= 5)
        SELECT country, indicator, string_agg(year || ':' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR), ' ' ORDER BY year) AS history
        FROM tail GROUP BY 1, 2""",
    "distinct_names": f"WITH {OBS} SELECT DISTINCT country FROM obs ORDER BY 1",
    "filter_page": f"""WITH {OBS}, hits AS (SELECT * FROM obs WHERE lower(indicator) = '2-high' AND lower(country) = 'nation_7')
        SELECT country, indicator, year, sub_indicator, round(value, 2) AS value, (SELECT count(*) FROM hits) AS total
        FROM hits ORDER BY year, sub_indicator LIMIT 10 OFFSET 3""",
    "filter_first_records": f"""WITH {OBS} SELECT country, year, indicator, round(value, 2) AS value
        FROM obs WHERE year = 1997 AND country = 'NATION_3'""",
    "name_resolution": """WITH asked AS (SELECT user_id % 30 AS k, event_id FROM events),
        named AS (SELECT k, n_name, CASE WHEN event_id % 2 = 0 THEN ' nation_' || k ELSE 'Nation_' || k || ' ' END AS typed
          FROM asked LEFT JOIN nation ON lower(n_name) = 'nation_' || k)
        SELECT coalesce(n_name, typed) AS country, n_name IS NOT NULL AS known, count(*) AS n FROM named GROUP BY 1, 2""",
    "risk_score": f"""WITH {COMPONENTS} SELECT country, risk_score, indicators_used,
        {_band('risk_score', 34, 67)} AS risk_level FROM scored""",
    "risk_components": f"WITH {COMPONENTS} SELECT * FROM components",
    "risk_drivers_top3": f"""WITH {COMPONENTS}, ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY country
          ORDER BY risk_contribution DESC, indicator) AS INTEGER) AS driver_rank FROM components)
        SELECT country, indicator, latest_value, risk_contribution, driver_rank FROM ranked WHERE driver_rank <= 3""",
    "risk_legacy": f"""WITH {OBS}, newest AS (SELECT * FROM obs WHERE {DIRECTION} = 1 QUALIFY row_number() OVER (
          PARTITION BY country, indicator ORDER BY year DESC, sub_indicator) = 1),
        spread AS (SELECT indicator, min(value) AS lo, max(value) AS hi FROM newest GROUP BY 1),
        parts AS (SELECT country, round((value - lo) / (hi - lo) * 100, 1) AS part FROM newest JOIN spread USING (indicator) WHERE hi > lo),
        means AS (SELECT country, avg(part) AS s, count(*) AS indicators_used FROM parts GROUP BY 1)
        SELECT country, round(s, 1) AS risk_score, {_band('s', 33.3, 66.7)} AS risk_level, indicators_used FROM means""",
    "disease_risk": f"""WITH {COMPONENTS}, {SENSOR}, scen AS (
          SELECT *, CASE seq % 3 WHEN 0 THEN 'Dengue' WHEN 1 THEN 'Malaria' ELSE 'Mosquito-borne disease' END AS disease
          FROM sensor WHERE temperature_c BETWEEN -20 AND 60 AND rainfall_mm BETWEEN 0 AND 5000 AND humidity_pct BETWEEN 0 AND 100),
        parts AS (SELECT *,
          CASE WHEN disease = 'Dengue' THEN greatest(0.0, 1 - abs(temperature_c - 29) / 12.0) ELSE greatest(0.0, 1 - abs(temperature_c - 27) / 13.0) END AS t,
          CASE WHEN disease = 'Dengue' THEN least(rainfall_mm / 200.0, 1.0) ELSE least(rainfall_mm / 160.0, 1.0) END AS r,
          CASE WHEN disease = 'Dengue' THEN least(greatest((humidity_pct - 45) / 45.0, 0.0), 1.0)
               ELSE least(greatest((humidity_pct - 40) / 50.0, 0.0), 1.0) END AS h FROM scen),
        prob AS (SELECT parts.*, scored.risk_score / 100 AS base, CAST(0.4 AS DOUBLE) * t + CAST(0.35 AS DOUBLE) * r + CAST(0.25 AS DOUBLE) * h AS w FROM parts JOIN scored USING (country)),
        fin AS (SELECT *, greatest(0.0, least(1.0, CAST(0.7 AS DOUBLE) * w + CAST(0.3 AS DOUBLE) * base)) AS p FROM prob)
        SELECT event_id, country, disease, round(p, 4) AS risk_probability, round(p * 100, 2) AS risk_score,
          {_band('p', 0.34, 0.67)} AS risk_level, round(w * 100, 2) AS climate_suitability,
          round(base * 100, 2) AS health_vulnerability,
          concat_ws('|', CASE WHEN t >= 0.7 THEN 'temperature is favorable for mosquito activity' END,
            CASE WHEN r >= 0.65 THEN 'high rainfall may increase mosquito breeding habitat' END,
            CASE WHEN h >= 0.65 THEN 'high humidity may support mosquito survival' END) AS weather_evidence,
          'Strengthen vector surveillance and remove standing-water breeding sites.|' ||
          CASE WHEN p < 0.34 THEN 'Continue routine monitoring and prevention communication.'
            ELSE 'Prepare targeted public-health messaging and clinical readiness.' END AS recommendations
        FROM fin""",
    "yoy_anomalies": f"WITH {_jumps(2.0)} SELECT * FROM jumps",
    "yoy_top10": f"WITH {_jumps(1.5)} SELECT * FROM jumps ORDER BY z_score DESC, country, indicator, year LIMIT 10",
    "ols_forecast": f"""WITH {SERIES}, fits AS (SELECT country, indicator, count(*) AS n, max(year) AS y,
          regr_slope(value, year) AS b, regr_intercept(value, year) AS a, greatest(regr_r2(value, year), 0.0) AS r
          FROM ser GROUP BY 1, 2 HAVING count(*) >= 2)
        SELECT country, indicator, CAST(y + h.step AS INTEGER) AS year, round(b * (y + h.step) + a, 3) AS predicted_value,
          CASE WHEN b > 1e-9 THEN 'increasing' WHEN b < -1e-9 THEN 'decreasing' ELSE 'stable' END AS trend,
          CASE WHEN abs(b) <= 1e-9 THEN 'neutral' WHEN b * {DIRECTION} > 0 THEN 'worsening' ELSE 'improving' END AS implication,
          round(b, 6) AS annual_slope, round(r, 4) AS r_squared,
          CASE WHEN n < 5 OR r < 0.35 THEN 'low' WHEN n >= 8 AND r >= 0.75 THEN 'high' ELSE 'moderate' END AS confidence,
          n AS history_points
        FROM fits, (VALUES (1), (2), (3)) AS h(step)""",
    "customer_trend": """WITH s AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, sum(o_totalprice) AS value FROM orders GROUP BY 1, 2)
        SELECT o_custkey, count(*) AS points, max(year) AS last_year, round(regr_slope(value, year), 3) AS slope,
          round(greatest(regr_r2(value, year), 0.0), 6) AS r_squared FROM s GROUP BY 1 HAVING count(*) >= 2""",
    "lag_features": f"""WITH {FRAME} SELECT country, indicator, year, held_out, round(value, 4) AS value, round(lag1, 4) AS lag1,
        round(lag2, 4) AS lag2, round(rolling_mean_3, 4) AS rolling_mean_3, round(rolling_std_3, 4) AS rolling_std_3,
        round(trend_delta, 4) AS trend_delta FROM frame""",
    "holdout_split": f"""WITH {FRAME} SELECT indicator, count(*) FILTER (NOT held_out) AS train_rows,
        count(*) FILTER (held_out) AS test_rows FROM frame GROUP BY 1""",
    "anomaly_features": f"""WITH {CHANGES}, span AS (SELECT min(year) AS y0, greatest(max(year) - min(year), 1) AS w FROM ser)
        SELECT country, indicator, year, round((value - vm) / vs, 6) AS value_zscore,
          round(coalesce((value - previous_value - dm) / ds, 0), 6) AS delta_zscore,
          round((year - y0) / CAST(w AS DOUBLE), 6) AS year_scaled,
          CASE WHEN previous_value IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS has_previous_value
        FROM changes JOIN stats USING (indicator), span""",
    "previous_value_fallback": f"""WITH {SERIES}, old AS (SELECT country, indicator, arg_max(value, year) AS v FROM ser WHERE year < 2000 GROUP BY 1, 2)
        SELECT s.country, s.indicator, s.year,
          CASE WHEN s.indicator <> '1-URGENT' AND v IS NOT NULL THEN 'training_baseline' ELSE 'request' END AS previous_value_source,
          round(CASE WHEN s.indicator = '1-URGENT' THEN 1000.0::DOUBLE ELSE v END, 4) AS previous_value
        FROM ser s LEFT JOIN old ON s.country = old.country AND s.indicator = old.indicator WHERE s.year >= 2000""",
    "indicator_stats": f"""WITH {CHANGES} SELECT indicator, vc AS value_count, dc AS delta_count,
        (SELECT min(year) FROM ser) AS year_min, (SELECT max(year) FROM ser) AS year_max,
        round(vm, 4) AS value_mean, round(vs, 4) AS value_std, round(dm, 4) AS delta_mean, round(ds, 4) AS delta_std,
        round(ps, 4) AS reference_std, round(lo, 4) AS minimum, round(hi, 4) AS maximum FROM stats""",
    "drift_report": f"""WITH {DRIFT} SELECT indicator, status, standardized_mean_shift, CAST(baseline_count AS DOUBLE) AS baseline_count,
        current_count, CAST(baseline_latest_year AS DOUBLE) AS baseline_latest_year, current_latest_year FROM details""",
    "drift_summary": f"""WITH {DRIFT}, c AS (SELECT count(*) FILTER (status IN ('drift', 'new_indicator')) AS drifted_indicators,
          count(*) FILTER (status = 'watch') AS watched_indicators FROM details)
        SELECT drifted_indicators, watched_indicators, CASE WHEN drifted_indicators > 0 THEN 'drift'
          WHEN watched_indicators > 0 THEN 'watch' ELSE 'stable' END AS status FROM c""",
    "quantile_calibration": """SELECT round(quantile_cont(l_extendedprice, 0.05), 4) AS q05,
        round(quantile_cont(l_extendedprice, 0.5), 4) AS q50, round(quantile_cont(l_extendedprice, 0.95), 4) AS q95 FROM lineitem""",
    "calibrated_scores": """WITH m AS (SELECT quantile_cont(value, 0.05) AS a, quantile_cont(value, 0.95) AS b FROM events),
        s AS (SELECT event_type, value > b AS flagged, least(greatest((value - a) / greatest(b - a, 1e-9) * 100, 0.0), 100.0) AS sc
          FROM events, m)
        SELECT event_type, CASE WHEN flagged OR sc >= 75 THEN 'high' WHEN sc >= 45 THEN 'review' ELSE 'low' END AS review_level,
          count(*) AS n, round(avg(sc), 4) AS mean_score FROM s GROUP BY 1, 2""",
    "error_metrics": f"WITH {FRAME} SELECT {_METRICS} FROM frame",
    "error_metrics_by_indicator": f"WITH {FRAME} SELECT indicator, {_METRICS} FROM frame GROUP BY 1",
    "dataset_digest": "SELECT count(*) AS rows, TRUE AS same_content FROM orders",
    "quality_profile": f"WITH {QUALITY} SELECT * FROM quality",
    "null_counts": f"""WITH {OBS} SELECT c.column_name, CASE WHEN c.column_name = 'sex' THEN (SELECT count(*) FROM obs) ELSE 0 END AS null_count
        FROM (VALUES ('country'), ('year'), ('indicator'), ('sub_indicator'), ('sex'), ('unit'), ('value')) AS c(column_name)""",
    "dup_counts": f"""WITH {OBS}, {SENSOR}, g AS (SELECT count(*) AS n FROM obs GROUP BY country, year, indicator),
        r AS (SELECT CASE WHEN seq % 10 = 0 THEN 2 ELSE 1 END AS n FROM sensor)
        SELECT CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS all_members, CAST(sum(n - 1) AS BIGINT) AS extra_copies, 'long_table' AS dataset FROM g
        UNION ALL SELECT CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT), CAST(sum(n - 1) AS BIGINT), 'sensor_replay' FROM r""",
    "contract_violations": f"WITH {SENSOR} {_violations('sensor', _SENSOR_RULES)}",
    "contract_rows": f"""WITH {SENSOR} SELECT event_id, concat_ws(',', """
    + ", ".join(f"CASE WHEN NOT ({v}) THEN '{k}' END" for k, v in _SENSOR_RULES.items())
    + ") AS broken_rules FROM sensor",
    "request_contracts": f"WITH {OBS}, {SENSOR} "
    + " UNION ALL ".join(
        [
            _violations("sensor", _scenario_rules(-10, 55, 2000), "scenario_strict"),
            _violations("sensor", _scenario_rules(-20, 60, 5000), "scenario_wide"),
            _violations("events", {"status_allowed": "event_id % 5 <> 0"}, "operational_event"),
            _violations("obs", {"horizon_years_range": "year - 1994 BETWEEN 1 AND 5"}, "forecast_request"),
            _violations("obs", {"value_present": "value IS NOT NULL"}, "anomaly_request"),
        ]
    ),
    "validation_report": f"""WITH {OBS}, g AS (SELECT count(*) AS n FROM obs GROUP BY country, year, indicator)
        SELECT 'nulls' AS rule, 'warning' AS severity, count(*) AS n, 'Dataset contains missing values.' AS detail FROM obs HAVING count(*) > 0
        UNION ALL SELECT 'duplicates', 'warning', CAST(sum(n - 1) AS BIGINT), 'Dataset contains ' || CAST(CAST(sum(n - 1) AS BIGINT) AS VARCHAR) || ' duplicate records.' FROM g HAVING sum(n - 1) > 0
        UNION ALL SELECT 'countries', 'warning', count(*), 'Unsupported country names found: ' || country FROM obs
          WHERE country NOT IN (SELECT n_name FROM nation WHERE n_regionkey < 4) GROUP BY country""",
    "unsupported_names": f"""WITH {OBS} SELECT DISTINCT country FROM obs
        WHERE country NOT IN (SELECT n_name FROM nation WHERE n_regionkey < 4)""",
    "readiness": f"""WITH {QUALITY} SELECT record_count > 0 AS processed_data_available, required_field_failures = 0 AS required_fields_valid,
        duplicate_records = 0 AS duplicates_absent, country_count > 0 AS countries_available, indicator_count > 0 AS indicators_available,
        CASE WHEN record_count > 0 THEN 'ready' ELSE 'not_ready' END AS status FROM quality""",
    "pipeline_status": f"""WITH {QUALITY} SELECT CASE WHEN record_count > 0 THEN 'healthy' ELSE 'degraded' END AS status,
        'ready' AS batch_status, record_count, status AS quality_status, year_max AS latest_data_year FROM quality""",
    "freshness": f"""WITH {OPS}, l AS (SELECT source, max(ts) AS t FROM ops GROUP BY 1)
        SELECT source, strftime(t, {_FULL}) AS last_seen,
          round((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(t)) / 3600000000.0::DOUBLE, 4) AS age_hours,
          (epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(t)) / 3600000000.0::DOUBLE > 24 AS stale FROM l""",
    "melt_years": f"""WITH {SERIES}
        SELECT country, CAST(year AS INTEGER) AS year, round(sum(value), 2) AS value FROM ser GROUP BY 1, 2""",
    "number_clean": """WITH raw AS (SELECT l_returnflag, l_linenumber, CASE l_linenumber % 5
          WHEN 0 THEN '< ' || l_partkey WHEN 1 THEN l_partkey || ',' || lpad(CAST(l_suppkey AS VARCHAR), 3, '0')
          WHEN 2 THEN l_partkey || ' ' || lpad(CAST(l_suppkey AS VARCHAR), 3, '0') || ' '
          WHEN 3 THEN 'n/a ' || l_partkey ELSE '  ' END AS v FROM lineitem),
        c AS (SELECT l_returnflag, l_linenumber, TRY_CAST(nullif(regexp_replace(v, '[<,\\s]', '', 'g'), '') AS DOUBLE) AS x FROM raw)
        SELECT l_returnflag, l_linenumber, count(*) AS n, count(x) AS numbers, sum(x) AS total FROM c GROUP BY 1, 2""",
    "header_key_clean": """WITH m AS (SELECT lower(p_type || ' (%) / ' || p_brand || '*') AS t FROM part)
        SELECT trim(regexp_replace(t, '[^a-z0-9]+', '_', 'g'), '_') AS header,
          trim(regexp_replace(t, '[^a-z0-9]+', ' ', 'g')) AS words, count(*) AS n FROM m GROUP BY 1, 2""",
    "alias_lookup": """SELECT CASE user_id % 8 WHEN 0 THEN 'Brunei' WHEN 1 THEN 'Brunei' WHEN 2 THEN 'Laos' WHEN 3 THEN 'Vietnam'
          WHEN 4 THEN 'Thailand' WHEN 5 THEN 'Timor-Leste' WHEN 6 THEN 'Atlantis' ELSE 'Laos' END AS country,
        count(*) AS n, max(value) AS top FROM events GROUP BY 1""",
    "alias_explode": """WITH k(slot, indicator, label) AS (VALUES
          (0, 'malaria_prevalence', 'Prevalence of malaria and TB (percentage)'), (0, 'tb_prevalence', 'Prevalence of malaria and TB (percentage)'),
          (1, 'death_by_hiv_aids', 'Deaths due to HIV/AIDS'), (2, 'crude_birth_ratio', 'Crude birth ratio'),
          (3, 'immunization_dpt', 'Immunization against measles and DPT among children of 1 year old (percentage)'),
          (3, 'immunization_measless', 'Immunization against measles and DPT among children of 1 year old (percentage)')),
        f AS (SELECT user_id % 4 AS slot, min(event_id) AS e, arg_min(event_type, event_id) AS d FROM events GROUP BY 1)
        SELECT indicator, label AS indicator_label, d AS description, CAST(e AS VARCHAR) AS source_url FROM k JOIN f USING (slot)""",
    "union_dedupe": """WITH u AS (SELECT 'a' AS file_name, l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem WHERE l_returnflag = 'R'
          UNION ALL SELECT 'b', l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem),
        k AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY file_name, l_quantity, l_returnflag) = 1)
        SELECT file_name, l_returnflag, count(*) AS n, sum(l_quantity) AS quantity FROM k GROUP BY 1, 2""",
    "json_lines_parse": f"WITH {SENSOR} {_violations('sensor', _LINE_RULES)}",
    "event_routing": f"WITH {ROUTED} SELECT event_id, copy, outcome FROM routed",
    "event_dedupe": f"WITH {ROUTED} SELECT fp AS fingerprint, event_id, country FROM routed WHERE outcome = 'accepted'",
    "fingerprints": f"WITH {CHECKED} SELECT event_id, fp AS fingerprint FROM checked",
    "retry_schedule": f"""WITH {ROUTED} SELECT event_id, copy, retry_count + 1 AS retry_count,
        strftime(seen_at + to_seconds({_DELAY}), {_FULL}) AS next_attempt_at FROM routed WHERE outcome = 'retry'""",
    "dlq_envelope": f"""WITH {ROUTED} SELECT {_PAYLOAD} AS original_payload, 'SchemaError' AS error_type,
        concat_ws('; ', CASE WHEN NOT temperature_c BETWEEN -20 AND 60 THEN 'temperature_c must be in -20..60' END,
          CASE WHEN NOT humidity_pct BETWEEN 0 AND 100 THEN 'humidity_pct must be in 0..100' END) AS error_message,
        retry_count, strftime(seen_at, {_FULL}) AS failed_at, 'weather-events' AS source_topic FROM routed WHERE outcome = 'dlq'""",
    "routing_counts": f"WITH {ROUTED} SELECT {_OUTCOMES} FROM routed",
    "tolerant_lines": f"""WITH {SENSOR} SELECT country, count(*) AS n, round(sum(temperature_c), 2) AS temperature_total
        FROM sensor WHERE seq % 10 <> 3 GROUP BY 1""",
    "file_checksums": """SELECT variant, CAST(files AS BIGINT) AS files, CAST(CASE variant WHEN 'reversed' THEN 0 WHEN 'changed'
          THEN files - (SELECT count(*) FROM orders WHERE o_orderkey = 1) ELSE files END AS BIGINT) AS same
        FROM (VALUES ('first', 4), ('again', 4), ('reversed', 4), ('changed', 4)) v(variant, files)""",
    "versioned_read": """SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
        WHERE o_orderstatus <> 'P' GROUP BY 1""",
    "append_new": """SELECT count(*) AS n, count(*) AS orders, CAST(sum(first_line) AS BIGINT) AS line_numbers
        FROM (SELECT l_orderkey, min(l_linenumber) AS first_line FROM lineitem GROUP BY 1)""",
    "routing_with_ledger": f"""WITH {ROUTED}, early AS (SELECT DISTINCT fp FROM replay WHERE fine AND copy = 0 AND seq % 2 = 0),
        late AS (SELECT r.*, CASE WHEN fine AND e.fp IS NULL AND row_number() OVER (PARTITION BY r.fp, fine ORDER BY copy, seq) = 1 THEN 'accepted'
            WHEN fine THEN 'duplicate' WHEN retry_count < 5 THEN 'retry' ELSE 'dlq' END AS result
          FROM replay r LEFT JOIN early e ON r.fp = e.fp WHERE NOT (copy = 0 AND seq % 2 = 0))
        SELECT {_OUTCOMES} FROM (SELECT result AS outcome FROM late)""",
    "forecast_facts": f"""WITH {SERIES}, last AS (SELECT country, indicator, max(year) AS y FROM ser GROUP BY 1, 2 HAVING count(*) >= 2)
        SELECT indicator, 3 * count(*) AS n, count(*) AS series, CAST(min(y) + 1 AS INTEGER) AS first_year,
          CAST(max(y) + 3 AS INTEGER) AS last_year, 3 * count(*) AS ordered, 3 * count(*) AS inside FROM last GROUP BY 1""",
    "isolation_facts": f"""WITH {SERIES} SELECT count(*) AS n, count(*) - 1 - CAST(floor((count(*) - 1) * 0.97) AS BIGINT) AS flagged,
        count(*) AS within, CAST(0 AS BIGINT) AS contradictory FROM ser""",
    "replay_due": f"""WITH {ROUTED} SELECT retry_count + 1 AS retry_count, count(*) AS n FROM routed
        WHERE outcome = 'retry' AND seen_at + to_seconds({_DELAY}) <= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1""",
    "dlq_resolution": f"""WITH {ROUTED} SELECT retry_count, retry_count = 6 AS is_resolved, count(*) AS n
        FROM routed WHERE outcome = 'dlq' GROUP BY 1, 2""",
    "dim_date": """SELECT DISTINCT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key, strftime(ts, '%Y-%m-%d') AS full_date,
        CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
        CAST(quarter(ts) AS INTEGER) AS quarter FROM events""",
    "dim_station": f"WITH {SENSOR} SELECT station_id, arg_max(country, seq) AS country_name FROM sensor GROUP BY 1",
    "fact_load_new_only": f"""WITH {CHECKED} SELECT event_id, CAST(strftime(seen_at, '%Y%m%d') AS INTEGER) AS date_key, temperature_c, humidity_pct, rainfall_mm,
        strftime(seen_at, {_FULL}) AS observed_at FROM checked WHERE fine AND seq % 3 <> 0""",
    "load_counts": f"""WITH {SENSOR}, r AS (SELECT seq FROM sensor UNION ALL SELECT seq FROM sensor WHERE seq % 10 = 0)
        SELECT count(*) AS input, count(DISTINCT CASE WHEN seq % 3 <> 0 THEN seq END) AS inserted,
          count(*) - count(DISTINCT CASE WHEN seq % 3 <> 0 THEN seq END) AS duplicates FROM r""",
    "star_rollup": f"""WITH {CHECKED} SELECT country AS country_name, CAST(strftime(seen_at, '%Y%m') AS BIGINT) AS month_key, count(*) AS n,
        round(avg(temperature_c), 4) AS mean_temperature, max(rainfall_mm) AS top_rainfall FROM checked WHERE fine GROUP BY 1, 2""",
    "health_fact_load": f"""WITH {OBS} SELECT year, year * 10000 + 101 AS date_key, count(*) AS n, round(sum(value), 2) AS total
        FROM obs WHERE year >= 1998 GROUP BY 1""",
    "alert_severity": f"""WITH {OPS}, typed AS (SELECT *, {_TYPES} AS event_type FROM ops)
        SELECT event_id, substr(sha256(event_type || '|' || source || '|global|general'), 1, 20) AS dedup_key,
          CASE WHEN status = 'critical' OR value / 100 >= 1.5 THEN 'critical' WHEN value / 100 >= 1 OR status = 'failed' THEN 'high'
            WHEN status = 'warning' THEN 'medium' WHEN event_type IN ('climate_risk', 'disease_risk') THEN 'medium' ELSE 'info' END AS severity,
          status = 'recovered' AS resolves FROM typed""",
    "alert_episodes": f"WITH {EPISODES} SELECT {_EPISODE_COLUMNS} FROM episodes",
    "alert_summary": f"""WITH {EPISODES}, a AS (SELECT *, CAST(substr(source, 4, 1) AS INTEGER) % 2 = 1 AS acked FROM episodes),
        s AS (SELECT severity, CASE WHEN status = 'resolved' AND NOT (acked AND created + INTERVAL 1 HOUR >= seen) THEN 'resolved'
          WHEN acked THEN 'acknowledged' ELSE 'open' END AS st FROM a)
        SELECT count(*) AS total_alerts, count(*) FILTER (st = 'open') AS open_alerts, """
    + ", ".join(f"count(*) FILTER (severity = '{s}') AS severity_{s}" for s in vocab.SEVERITIES)
    + ", "
    + ", ".join(f"count(*) FILTER (st = '{s}') AS status_{s}" for s in ("open", "acknowledged", "resolved"))
    + f""", coalesce(arg_max(severity, {_RANK}) FILTER (st = 'open'), 'none') AS highest_open_severity,
        CASE WHEN count(*) FILTER (st = 'open') > 0 THEN 'attention_required' ELSE 'stable' END AS operational_state FROM s""",
    "alert_list": f"""WITH {EPISODES} SELECT {_EPISODE_COLUMNS} FROM episodes WHERE status = 'open'
        ORDER BY {_RANK} DESC, seen DESC LIMIT 5""",
    "root_cause": f"""WITH {OPS}, c(event_type, summary, rank, cause) AS (VALUES {_CAUSES})
        SELECT event_id, summary, 'Source: ' || source AS first_evidence, 5 AS evidence_lines, rank, cause
        FROM (SELECT *, {_TYPES} AS event_type FROM ops) JOIN c USING (event_type)""",
    "state_alerts": f"""WITH {_jumps(2.0)}, {ROUTED}, {OBS},
        top AS (SELECT * FROM jumps ORDER BY z_score DESC, country, indicator, year LIMIT 10),
        dup AS (SELECT coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS d FROM (SELECT count(*) AS n FROM obs GROUP BY country, year, indicator)),
        age AS (SELECT round((epoch_us(TIMESTAMP '2024-06-01') - epoch_us(max(ts))) / 3600000000.0::DOUBLE, 4) AS h FROM events),
        sig AS (
          SELECT 'pipeline_failure' AS event_type, 'streaming_pipeline' AS source, 'Streaming events failed and require retry or DLQ review.' AS message,
            CAST(NULL AS VARCHAR) AS country, 'failed_events' AS metric, CAST(count(*) AS DOUBLE) AS value, CAST(1.0 AS DOUBLE) AS threshold FROM routed WHERE outcome = 'dlq' HAVING count(*) > 0
          UNION ALL SELECT 'data_quality', 'batch_pipeline', 'The processed health dataset is older than the configured freshness threshold.', NULL, 'dataset_age_hours', round(h, 2), 720.0 FROM age WHERE h > 720
          UNION ALL SELECT 'data_quality', 'phase3_quality_service', 'The processed health dataset failed one or more quality checks.', NULL, 'quality_failures', CAST(d AS DOUBLE), 0.0 FROM dup WHERE d > 0
          UNION ALL SELECT 'disease_risk', 'phase3_anomaly_service', 'unusual year-over-year movement versus the historical series', country, indicator, z_score, 2.5 FROM top WHERE severity = 'high')
        SELECT event_type, source, 'warning' AS status, message, country, metric, value, threshold,
          CASE WHEN threshold = 0 AND value > 0 THEN 'high' WHEN value / nullif(threshold, 0) >= 1.5 THEN 'critical'
            WHEN value / nullif(threshold, 0) >= 1 THEN 'high' ELSE 'medium' END AS severity,
          substr(sha256(event_type || '|' || source || '|' || lower(coalesce(country, 'global')) || '|' || lower(metric)), 1, 20) AS dedup_key
        FROM sig""",
    "request_rollup": """SELECT CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
        CASE WHEN event_type = 'view' THEN '/api/v1/countries/{country}/risk' ELSE '/api/v1/' || event_type END AS path,
        CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status_code, count(*) AS requests,
        round(sum(value / 100), 4) AS duration_seconds FROM events GROUP BY 1, 2, 3""",
    "error_rate_5min": f"""WITH {OPS}, w AS (SELECT time_bucket(INTERVAL '5 minutes', ts) AS b, count(*) AS events,
          count(*) FILTER (status = 'failed') AS errors FROM ops GROUP BY 1)
        SELECT strftime(b, {_FULL}) AS window_start, events, errors, round(errors / CAST(events AS DOUBLE), 6) AS error_rate,
          errors / CAST(events AS DOUBLE) > 0.01 AS alerting FROM w""",
    "latency_p95": f"""WITH w AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS b, quantile_cont(value / 100, 0.95) AS q FROM events GROUP BY 1)
        SELECT strftime(b, {_FULL}) AS window_start, round(q, 6) AS p95, q > 2.0 AS alerting FROM w""",
    "slo_report": f"""WITH {ROUTED}, runs AS (SELECT o_orderdate AS s, count(*) AS n, count(*) FILTER (o_orderstatus <> 'P') AS good,
          count(*) FILTER (o_orderstatus = 'P' AND o_orderkey % 64 > 0) AS bad, max(o_custkey % 90) AS secs FROM orders GROUP BY 1),
        m AS (SELECT 'batch_success_rate_pct' AS name, count(*) FILTER (bad <= good) * 100.0::DOUBLE / count(*) AS value, 99.0::DOUBLE AS target FROM runs
          UNION ALL SELECT 'freshness_hours', (epoch_us(TIMESTAMP '2002-01-01') - max(epoch_us(s) + secs * 1000000)) / 3600000000.0::DOUBLE, 24.0 FROM runs
          UNION ALL SELECT 'event_latency_seconds', max(secs)::DOUBLE, 60.0 FROM runs
          UNION ALL SELECT 'accepted_loss', sum(n - good - bad)::DOUBLE, 0.0 FROM runs
          UNION ALL SELECT 'dlq_review_hours', max(CASE WHEN l_linestatus = 'F' THEN l_linenumber
            ELSE (epoch_us(TIMESTAMP '2002-01-01') - epoch_us(l_shipdate)) / 3600000000.0::DOUBLE END), 24.0 FROM lineitem WHERE l_returnflag = 'R'
          UNION ALL SELECT 'duplicate_rate_pct', count(*) FILTER (outcome = 'duplicate') * 100.0::DOUBLE / count(*), 1.0 FROM routed)
        SELECT name, round(value, 4) AS value, target, CASE name WHEN 'batch_success_rate_pct' THEN value >= target
          WHEN 'freshness_hours' THEN value <= target WHEN 'accepted_loss' THEN value <= target ELSE value < target END AS ok FROM m""",
    "retention_keep": """WITH l AS (SELECT l_returnflag, l_shipdate AS shipped, CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS closed FROM lineitem)
        SELECT l_returnflag, count(*) FILTER (shipped > TIMESTAMP '2001-06-01' - INTERVAL 12 MONTH) AS accepted_kept,
          count(*) FILTER (closed IS NULL OR closed > TIMESTAMP '2001-06-01' - INTERVAL 30 DAY) AS retry_kept,
          count(*) FILTER (closed IS NULL OR shipped > TIMESTAMP '2001-06-01' - INTERVAL 12 MONTH) AS dlq_kept,
          count(*) FILTER (shipped > TIMESTAMP '2001-06-01' - INTERVAL 24 MONTH) AS metrics_kept, count(*) AS n
        FROM l GROUP BY 1""",
    "alert_stream": f"WITH {EPISODES} SELECT {_EPISODE_COLUMNS} FROM episodes",
    "event_stream": f"WITH {ROUTED} SELECT {_OUTCOMES} FROM routed",
}

ORACLES |= answers(SENSOR, CHECKED, ROUTED, OPS, OBS, SERIES, _FULL)
ORACLES = {name: _snapped(sql) for name, sql in ORACLES.items()}
