"""Every operator as a query over the given tables: name -> callable(spark, folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicora import vocab
from indicora.functions import keys, scoring, text
from indicora.functions.numbers import rounded
from indicora.functions.quantiles import exact_quantiles
from indicora.learning import features, forest, isolation
from indicora.operators import alerts, contracts, events, filters, profile, risk, series, service
from indicora.operators import warehouse
from indicora.plans import etl, monitor, views
from indicora.scaling import constant_table, keep_extreme
from indicora.session import scratch_path
from indicora.sources import csv_folder, json_lines, tables

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

NOW = "2024-02-01 00:00:00"
ARRIVAL = ["arrival"]
ONCE = ["seq"]


def query(make: Query) -> Query:
    REGISTRY[make.__name__] = make
    return make


def _now() -> Column:
    return F.lit(NOW).cast("timestamp")


def _shown(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _directions(spark: SparkSession) -> DataFrame:
    known = views.DIRECTIONS
    return constant_table(
        spark, {"indicator": list(known), "direction": list(known.values())}
    )


def _stamp() -> Column:
    return F.to_timestamp("timestamp")


def _rules() -> list[contracts.Rule]:
    return contracts.sensor_event(None)


def _routed(spark: SparkSession, folder: str) -> DataFrame:
    return events.routed(views.sensor_replay(spark, folder), _rules(), ARRIVAL)


# --- latest values, peers, trends ---------------------------------------------------------------
@query
def latest_by_series(spark, folder):
    rows = views.indicator_obs(spark, folder).drop("sex", "unit")
    newest = series.latest(rows, ["country", "indicator", "sub_indicator"])
    return newest.withColumn("value", rounded("value", 4))


@query
def latest_by_peer(spark, folder):
    rows = views.indicator_obs(spark, folder).drop("sex", "unit")
    return series.latest(rows, series.SERIES).withColumn("value", rounded("value", 4))


@query
def peer_compare(spark, folder):
    rows = series.peer_comparison(views.indicator_obs(spark, folder))
    return rows.withColumn("value", rounded("value", 3))


@query
def country_profile(spark, folder):
    return series.country_profile(views.indicator_obs(spark, folder)).drop("data")


@query
def country_profile_rows(spark, folder):
    rows = series.country_profile(views.indicator_obs(spark, folder))
    return rows.select("country", F.inline("data")).select(
        "country", "indicator", "sub_indicator", "year", rounded("value", 3).alias("value")
    )


@query
def trend_all(spark, folder):
    return series.trends(views.indicator_obs(spark, folder))


@query
def recent_history(spark, folder):
    rows = series.recent_history(views.indicator_series(spark, folder))
    shown = F.transform(
        "history", lambda h: F.concat_ws(":", h["year"], F.floor(h["value"]).cast("string"))
    )
    return rows.select("country", "indicator", F.concat_ws(" ", shown).alias("history"))


@query
def distinct_names(spark, folder):
    return series.distinct_names(views.indicator_obs(spark, folder), "country")


@query
def filter_page(spark, folder):
    rows = filters.matching(
        views.indicator_obs(spark, folder), indicator=" 2-high ", country="nation_7"
    )
    order = [F.col("year"), F.col("sub_indicator")]
    shown = filters.page_with_total(rows, order, offset=3, limit=10)
    return shown.select("country", "indicator", "year", "sub_indicator", rounded("value", 2).alias("value"), "total")


@query
def filter_first_records(spark, folder):
    rows = filters.matching(views.indicator_obs(spark, folder), year=1997, country="NATION_3")
    return filters.first_records(rows, 100).withColumn("value", rounded("value", 2))


@query
def name_resolution(spark, folder):
    nations = views.table(spark, folder, "nation").select(F.col("n_name").alias("country"))
    number = F.col("user_id") % 30
    asked = views.table(spark, folder, "events").select(
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(" nation_"), number.cast("string")))
        .otherwise(F.concat(F.lit("Nation_"), number.cast("string"), F.lit(" ")))
        .alias("country")
    )
    resolved, unknown = series.with_names_of(asked, nations, "country")
    both = resolved.withColumn("known", F.lit(True)).unionByName(
        unknown.withColumn("known", F.lit(False))
    )
    return both.groupBy("country", "known").agg(F.count(F.lit(1)).alias("n"))


# --- risk -----------------------------------------------------------------------------------------
@query
def risk_score(spark, folder):
    parts = risk.score_components(views.indicator_obs(spark, folder), _directions(spark))
    return risk.scores(parts)


@query
def risk_components(spark, folder):
    return risk.score_components(views.indicator_obs(spark, folder), _directions(spark))


@query
def risk_drivers_top3(spark, folder):
    return risk.top_drivers(risk_components(spark, folder))


@query
def risk_legacy(spark, folder):
    return risk.comparative_scores(views.indicator_obs(spark, folder), _directions(spark))


@query
def disease_risk(spark, folder):
    diseases = F.array(*[F.lit(d) for d in vocab.DISEASES])
    scenarios = views.sensor_events(spark, folder).select(
        "event_id",
        "country",
        "temperature_c",
        "rainfall_mm",
        "humidity_pct",
        F.element_at(diseases, (F.col("seq") % 3 + 1).cast("int")).alias("disease"),
    )
    fine, _ = contracts.split(scenarios, contracts.scenario(strict=False))
    nations = views.table(spark, folder, "nation")
    scored = risk.disease_risk(fine, risk_score(spark, folder))
    return scored.select(
        "event_id",
        "country",
        "disease",
        "risk_probability",
        "risk_score",
        "risk_level",
        "climate_suitability",
        "health_vulnerability",
        F.concat_ws("|", "weather_evidence").alias("weather_evidence"),
        F.concat_ws("|", "recommendations").alias("recommendations"),
    )


# --- jumps and lines ----------------------------------------------------------------------------
@query
def yoy_anomalies(spark, folder):
    return series.yearly_jumps(views.monthly_series(spark, folder), 2.0)


@query
def yoy_top10(spark, folder):
    return series.top_jumps(series.yearly_jumps(views.monthly_series(spark, folder), 1.5), 10)


@query
def ols_forecast(spark, folder):
    return series.line_forecasts(views.indicator_series(spark, folder), _directions(spark), 3)


@query
def customer_trend(spark, folder):
    fits = series.line_fits(views.customer_series(spark, folder), ["o_custkey"])
    return fits.select(
        "o_custkey",
        "points",
        F.col("last_x").alias("last_year"),
        rounded("slope", 3).alias("slope"),
        rounded("r_squared", 6).alias("r_squared"),
    )


# --- features, drift, metrics -----------------------------------------------------------------------
@query
def lag_features(spark, folder):
    frame = features.forecast_frame(views.indicator_series(spark, folder))
    numbers = ["value", "lag1", "lag2", "rolling_mean_3", "rolling_std_3", "trend_delta"]
    return frame.select(
        "country", "indicator", "year", "held_out", *[rounded(c, 4).alias(c) for c in numbers]
    )


@query
def holdout_split(spark, folder):
    frame = features.forecast_frame(views.indicator_series(spark, folder))
    return frame.groupBy("indicator").agg(
        F.count_if(~F.col("held_out")).alias("train_rows"),
        F.count_if(F.col("held_out")).alias("test_rows"),
    )


def _anomaly_frame(spark, folder):
    changes = features.with_changes(views.indicator_series(spark, folder))
    return features.anomaly_features(changes, features.indicator_statistics(changes))


@query
def anomaly_features(spark, folder):
    rows = _anomaly_frame(spark, folder)
    return rows.select(
        "country", "indicator", "year", *[rounded(c, 6).alias(c) for c in features.ANOMALY_FEATURES]
    )


@query
def previous_value_fallback(spark, folder):
    annual = views.indicator_series(spark, folder)
    records = annual.where("year >= 2000").withColumn(
        "previous_value", F.when(F.col("indicator") == "1-URGENT", F.lit(1000.0))
    )
    filled = features.with_previous(records, annual.where("year < 2000"))
    return filled.select(
        "country", "indicator", "year", "previous_value_source",
        rounded("previous_value", 4).alias("previous_value"),
    )


@query
def indicator_stats(spark, folder):
    stats = features.indicator_statistics(
        features.with_changes(views.indicator_series(spark, folder))
    )
    numbers = [
        "value_mean", "value_std", "delta_mean", "delta_std", "reference_std", "minimum", "maximum",
    ]
    return stats.select(
        "indicator",
        "value_count",
        "delta_count",
        "year_min",
        "year_max",
        *[rounded(c, 4).alias(c) for c in numbers],
    )


def _drift(spark, folder):
    annual = views.indicator_series(spark, folder)
    before = annual.where("year <= 1997 AND indicator <> '5-LOW'")
    baseline = features.indicator_statistics(features.with_changes(before))
    return features.drift_details(annual.where("year > 1997"), baseline)


@query
def drift_report(spark, folder):
    rows = features.largest_first(_drift(spark, folder))
    partly_missing = ["baseline_count", "baseline_latest_year"]
    return rows.withColumns({c: F.col(c).cast("double") for c in partly_missing})


@query
def drift_summary(spark, folder):
    return features.drift_summary(_drift(spark, folder))


@query
def quantile_calibration(spark, folder):
    values = views.table(spark, folder, "lineitem").select("l_extendedprice")
    marks = exact_quantiles(
        values, [], "l_extendedprice", {"q05": 0.05, "q50": 0.5, "q95": 0.95}
    )
    return marks.select(*[rounded(c, 4).alias(c) for c in marks.columns])


@query
def calibrated_scores(spark, folder):
    values = views.table(spark, folder, "events").select("event_type", "value")
    marks = exact_quantiles(values, [], "value", {"q05": 0.05, "q95": 0.95})
    # one row of marks, read by every task as a scalar subquery
    both = values.withColumn("_m", marks.select(F.struct("q05", "q95")).scalar())
    score = features.calibrated(F.col("value"), F.col("_m.q05"), F.col("_m.q95"))
    flagged = F.col("value") > F.col("_m.q95")
    return both.groupBy("event_type", features.review_level(score, flagged).alias("review_level")).agg(
        F.count(F.lit(1)).alias("n"), rounded(F.avg(score), 4).alias("mean_score")
    )


def _naive(spark, folder):
    frame = features.forecast_frame(views.indicator_series(spark, folder))
    return frame.withColumn("prediction", F.col("lag1"))


@query
def error_metrics(spark, folder):
    return features.error_metrics(_naive(spark, folder))


@query
def error_metrics_by_indicator(spark, folder):
    return features.error_metrics(_naive(spark, folder), ["indicator"])


@query
def dataset_digest(spark, folder):
    orders = views.table(spark, folder, "orders")
    mixed = orders.where("o_orderkey % 2 = 1").unionByName(orders.where("o_orderkey % 2 = 0"))
    first = keys.table_digest(orders)
    second = keys.table_digest(mixed).select(F.col("rows").alias("_r"), F.col("digest").alias("_d"))
    return first.join(second, F.col("rows") == F.col("_r")).select(
        "rows", (F.col("digest") == F.col("_d")).alias("same_content")
    )


# --- profiles and contracts ---------------------------------------------------------------------------
@query
def quality_profile(spark, folder):
    return profile.quality_profile(views.indicator_obs(spark, folder))


@query
def null_counts(spark, folder):
    return profile.null_counts(views.indicator_obs(spark, folder))


@query
def dup_counts(spark, folder):
    long = profile.duplicate_counts(
        views.indicator_obs(spark, folder), ["country", "year", "indicator"]
    )
    replay = profile.duplicate_counts(views.sensor_replay(spark, folder), ["event_id"])
    return long.withColumn("dataset", F.lit("long_table")).unionByName(
        replay.withColumn("dataset", F.lit("sensor_replay"))
    )


@query
def contract_violations(spark, folder):
    return contracts.violation_counts(views.sensor_events(spark, folder), _rules())


@query
def contract_rows(spark, folder):
    marked = contracts.checked(views.sensor_events(spark, folder), _rules())
    return marked.select("event_id", F.concat_ws(",", "broken_rules").alias("broken_rules"))


@query
def request_contracts(spark, folder):
    sensors = views.sensor_events(spark, folder).withColumn(
        "disease", F.when(F.col("seq") % 4 == 0, "flu").otherwise("malaria")
    )
    ops = views.typed_ops_events(spark, folder).withColumn(
        "status", F.when(F.col("event_id") % 5 == 0, "broken").otherwise(F.col("status"))
    )
    requests = views.indicator_obs(spark, folder).withColumn("horizon_years", F.col("year") - 1994)
    profiles = {
        "scenario_strict": (sensors, contracts.scenario(strict=True)),
        "scenario_wide": (sensors, contracts.scenario(strict=False)),
        "operational_event": (ops, contracts.operational_event()),
        "forecast_request": (requests, contracts.forecast_request()),
        "anomaly_request": (requests, contracts.anomaly_request()),
    }
    found = [
        contracts.violation_counts(df, rules).withColumn("contract", F.lit(name))
        for name, (df, rules) in profiles.items()
    ]
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def _supported(spark, folder):
    nations = views.table(spark, folder, "nation").where("n_regionkey < 4")
    return nations.select(F.col("n_name").alias("country"))


@query
def validation_report(spark, folder):
    return profile.validation_report(
        views.indicator_obs(spark, folder),
        _supported(spark, folder),
        key=["country", "year", "indicator"],
    )


@query
def unsupported_names(spark, folder):
    names = views.indicator_obs(spark, folder).select("country").distinct()
    return names.join(_supported(spark, folder), "country", "left_anti")


@query
def readiness(spark, folder):
    return profile.readiness(quality_profile(spark, folder))


@query
def pipeline_status(spark, folder):
    return profile.pipeline_status(quality_profile(spark, folder))


@query
def freshness(spark, folder):
    rows = profile.freshness(
        views.ops_events(spark, folder), "observed_at", _now(), ["source"], 24.0
    )
    return rows.withColumn("last_seen", _shown(F.col("last_seen")))


# --- cleaning and reshaping -------------------------------------------------------------------------------
@query
def melt_years(spark, folder):
    wide = views.wide_orders(spark, folder)
    cells = wide.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(wide.columns)],
        F.lit("orders.csv").alias("file_name"),
        F.lit(0).alias("block"),
        F.lit(0).alias("row"),
    )
    roles = etl.roles_of(text.unique_headers(wide.columns))
    long = etl.melted(cells, roles)
    return long.select("country", "year", text.number(F.col("raw_value")).alias("value")).where(
        "value IS NOT NULL"
    )


@query
def number_clean(spark, folder):
    part, sup = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    messy = (
        F.when(F.col("l_linenumber") % 5 == 0, F.concat(F.lit("< "), part))
        .when(F.col("l_linenumber") % 5 == 1, F.concat(part, F.lit(","), F.lpad(sup, 3, "0")))
        .when(F.col("l_linenumber") % 5 == 2, F.concat(part, F.lit(" "), F.lpad(sup, 3, "0"), F.lit(" ")))
        .when(F.col("l_linenumber") % 5 == 3, F.concat(F.lit("n/a "), part))
        .otherwise(F.lit("  "))
    )
    rows = views.table(spark, folder, "lineitem").select("l_returnflag", "l_linenumber", messy.alias("raw"))
    return (
        rows.withColumn("clean", text.number(F.col("raw")))
        .groupBy("l_returnflag", "l_linenumber")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("clean").alias("numbers"),
            F.sum("clean").alias("total"),
        )
    )


@query
def header_key_clean(spark, folder):
    parts = views.table(spark, folder, "part")
    messy = F.concat(F.lit(" "), "p_type", F.lit(" (%) / "), "p_brand", F.lit("* "))
    return (
        parts.select(text.snake_case_col(messy).alias("header"), text.country_key(messy).alias("words"))
        .groupBy("header", "words")
        .agg(F.count(F.lit(1)).alias("n"))
    )


# messy country spellings used to exercise the lookup
SPELLINGS = [
    "Brunei Darussalam*", "Brunnei Darussalam", "Lao's PDR", "Viet Nam", " THAILAND ", "Timor-Leste",
    "Atlantis", "Lao People's Democratic Republic",
]
LABELS = [
    "Prevalence of malaria and TB (percentage)",
    "Deaths due to HIV/AIDS",
    "Crude birth ratio",
    "Immunization against measles and DPT among children of 1 year old (percentage)",
]


def _picked(values: list[str], number: Column) -> Column:
    chosen = F.array(*[F.lit(v) for v in values])
    return F.element_at(chosen, (number % len(values) + 1).cast("int"))


@query
def alias_lookup(spark, folder):
    rows = views.table(spark, folder, "events").select(
        text.canonical_country(_picked(SPELLINGS, F.col("user_id"))).alias("country"), "value"
    )
    return rows.groupBy("country").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top"))


@query
def alias_explode(spark, folder):
    raw = views.table(spark, folder, "events").select(
        _picked(LABELS, F.col("user_id")).alias("Cleansed data"),
        F.col("event_type").alias("Description"),
        F.col("event_id").cast("string").alias("Source link"),
        F.col("event_id").alias("row_number"),
    )
    return etl.metadata_table(raw).select("indicator", "indicator_label", "description", "source_url")


@query
def union_dedupe(spark, folder):
    lines = views.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity"
    )
    first = lines.where("l_returnflag = 'R'").withColumn("file_name", F.lit("a"))
    second = lines.withColumn("file_name", F.lit("b"))
    both = first.unionByName(second)
    order = F.struct("file_name", "l_quantity", "l_returnflag")
    kept = keep_extreme(both, ["l_orderkey", "l_linenumber"], order)
    return kept.groupBy("file_name", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")
    )


@query
def json_lines_parse(spark, folder):
    sensors = views.sensor_events(spark, folder)
    line = F.to_json(F.struct(*events.EVENT_COLUMNS))
    odd = F.regexp_replace(line, r"^\{", '{"note":"x",')
    raw = (
        F.when(F.col("seq") % 10 == 3, F.substring(line, 1, 20))
        .when(F.col("seq") % 10 == 7, odd)
        .otherwise(line)
    )
    parsed = json_lines.parsed(sensors.select(raw.alias("raw"), "country_known"))
    rules = [*json_lines.line_rules()[:2], *_rules()]
    return contracts.violation_counts(parsed, rules)


@query
def tolerant_lines(spark, folder):
    """The same lines, unreadable ones skipped."""
    line = F.to_json(F.struct(*events.EVENT_COLUMNS))
    raw = F.when(F.col("seq") % 10 == 3, F.substring(line, 1, 20)).otherwise(line)
    kept = json_lines.tolerant(views.sensor_events(spark, folder).select(raw.alias("raw")))
    return kept.groupBy("country").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.sum("temperature_c"), 2).alias("temperature_total")
    )


@query
def file_checksums(spark, folder):
    """Orders as text files: written again, with rows in another order, and with one cell changed."""
    orders = views.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    dealt = orders.repartition(4, "o_orderkey")
    swapped = F.when(F.col("o_orderkey") == F.lit(1), -1).otherwise(F.col("o_custkey"))
    variants = {
        "first": dealt.sortWithinPartitions("o_orderkey"),
        "again": dealt.sortWithinPartitions("o_orderkey"),
        "reversed": dealt.sortWithinPartitions(F.desc("o_orderkey")),
        "changed": dealt.sortWithinPartitions("o_orderkey").withColumn("o_custkey", swapped),
    }
    sums = None
    for name, rows in variants.items():
        path = scratch_path(spark, f"checksums-{name}")
        rows.write.csv(path, header=True)
        part = F.regexp_extract("file_name", r"^part-(\d+)", 1).alias("part")
        own = csv_folder.checksums(spark, path).select(F.lit(name).alias("variant"), part, "checksum")
        sums = own if sums is None else sums.unionByName(own)
    first = sums.where("variant = 'first'").select("part", F.col("checksum").alias("known"))
    return sums.join(first, "part").groupBy("variant").agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("checksum") == F.col("known")).alias("same")
    )


@query
def versioned_read(spark, folder):
    """A table published twice; readers see the second version only."""
    orders = views.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(spark, "versioned")
    tables.replace_table(orders.where("o_orderstatus = 'O'"), path)
    tables.replace_table(orders.where("o_orderstatus <> 'P'"), path, ["o_orderstatus"])
    current = spark.read.parquet(tables.current_version(spark, path))
    return current.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.sum("o_totalprice"), 2).alias("total")
    )


@query
def append_new(spark, folder):
    """Line items appended by order twice, in overlapping loads: one row per order stays."""
    lines = views.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    path = scratch_path(spark, "appended")
    tables.append_new(lines.where("l_orderkey % 3 < 2"), path, "l_orderkey")
    tables.append_new(lines.where("l_orderkey % 3 > 0"), path, "l_orderkey")
    return spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("l_orderkey").alias("orders"),
        F.sum("l_linenumber").alias("line_numbers"),
    )


# --- event routing -----------------------------------------------------------------------------------------
@query
def event_routing(spark, folder):
    return _routed(spark, folder).select("event_id", "copy", "outcome")


@query
def event_dedupe(spark, folder):
    return events.accepted(_routed(spark, folder)).select("fingerprint", "event_id", "country")


@query
def fingerprints(spark, folder):
    return views.sensor_events(spark, folder).select(
        "event_id", keys.event_fingerprint().alias("fingerprint")
    )


@query
def retry_schedule(spark, folder):
    again = events.retries(_routed(spark, folder), _stamp(), keep=["copy"])
    return again.select(
        "event_id", "copy", "retry_count", _shown(F.col("next_attempt_at")).alias("next_attempt_at")
    )


@query
def dlq_envelope(spark, folder):
    letters = events.dead_letters(_routed(spark, folder), _rules(), _stamp())
    return letters.withColumn("failed_at", _shown(F.col("failed_at")))


@query
def routing_counts(spark, folder):
    return events.outcome_counts(_routed(spark, folder))


@query
def routing_with_ledger(spark, folder):
    """A second batch, routed against what the first one accepted."""
    both = views.sensor_replay(spark, folder)
    early = (F.col("copy") == 0) & (F.col("seq") % 2 == 0)
    first = events.accepted(events.routed(both.where(early), _rules(), ARRIVAL))
    second = events.routed(both.where(~early), _rules(), ARRIVAL, accepted_before=first)
    return events.outcome_counts(second)


@query
def replay_due(spark, folder):
    again = events.retries(_routed(spark, folder), _stamp())
    when = F.lit("2024-01-15 00:00:00").cast("timestamp")
    due = events.due(again, when)
    return due.groupBy("retry_count").agg(F.count(F.lit(1)).alias("n"))


@query
def dlq_resolution(spark, folder):
    letters = events.dead_letters(_routed(spark, folder), _rules(), _stamp()).withColumns(
        {
            "resolved_at": F.lit(None).cast("timestamp"),
            "resolution_notes": F.lit(None).cast("string"),
        }
    )
    fixes = letters.where("retry_count = 6").select(
        "original_payload",
        F.regexp_replace("original_payload", '"temperature_c":[0-9.]+', '"temperature_c":30.0').alias(
            "new_payload"
        ),
    ).distinct()
    marked = events.resolved(letters, fixes, _now(), "corrected")
    return marked.groupBy("retry_count", F.col("resolved_at").isNotNull().alias("is_resolved")).agg(
        F.count(F.lit(1)).alias("n")
    )


# --- warehouse ---------------------------------------------------------------------------------------------
def _accepted(spark, folder):
    once = events.routed(views.sensor_events(spark, folder), _rules(), ONCE)
    return once.where("outcome = 'accepted'").select("seq", *events.EVENT_COLUMNS)


@query
def dim_date(spark, folder):
    stamped = views.sensor_events(spark, folder).select(_stamp().alias("at"))
    rows = warehouse.dim_date(stamped, "at")
    return rows.withColumn("full_date", F.col("full_date").cast("string"))


@query
def dim_station(spark, folder):
    return warehouse.dim_station(views.sensor_events(spark, folder), ONCE).select(
        "station_id", "country_name"
    )


@query
def fact_load_new_only(spark, folder):
    incoming = _accepted(spark, folder)
    held = views.table(spark, folder, "events").where("event_id % 3 = 0").select(
        F.col("event_id").cast("string").alias("event_id")
    )
    new = warehouse.new_rows(incoming, held, [F.col("event_id")], F.col("seq"))
    facts = warehouse.with_weather_keys(new)
    return facts.select(
        "event_id", "date_key", "temperature_c", "humidity_pct", "rainfall_mm",
        _shown(F.col("observed_at")).alias("observed_at"),
    )


@query
def load_counts(spark, folder):
    incoming = views.sensor_replay(spark, folder)
    held = views.table(spark, folder, "events").where("event_id % 3 = 0").select(
        F.col("event_id").cast("string").alias("event_id")
    )
    return warehouse.load_counts(incoming, held, "event_id")


@query
def star_rollup(spark, folder):
    incoming = _accepted(spark, folder)
    facts = warehouse.with_weather_keys(incoming)
    countries = warehouse.dim_country(
        views.table(spark, folder, "nation").select(F.col("n_name").alias("country"))
    )
    # facts are grouped by key first; names are joined to the small result
    grouped = facts.groupBy("country_key", F.floor(F.col("date_key") / 100).alias("month_key")).agg(
        F.count(F.lit(1)).alias("n"),
        rounded(F.avg("temperature_c"), 4).alias("mean_temperature"),
        F.max("rainfall_mm").alias("top_rainfall"),
    )
    return grouped.join(countries, "country_key").select(
        "country_name", "month_key", "n", "mean_temperature", "top_rainfall"
    )


@query
def health_fact_load(spark, folder):
    rows = views.indicator_obs(spark, folder)
    held = warehouse.with_health_keys(rows.where("year < 1998"))
    key = [F.col(c) for c in ("country_key", "indicator_key", "year", "sub_indicator", "sex")]
    new = warehouse.new_rows(warehouse.with_health_keys(rows), held, key, F.col("value"))
    return new.groupBy("year", "date_key").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.sum("value"), 2).alias("total")
    )


# --- alerts -------------------------------------------------------------------------------------------------
@query
def alert_severity(spark, folder):
    rows = alerts.keyed(views.typed_ops_events(spark, folder))
    return rows.select("event_id", "dedup_key", "severity", "resolves")


def _episode_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "dedup_key",
        "source",
        "title",
        "severity",
        "status",
        "message",
        "value",
        _shown(F.col("created_at")).alias("created_at"),
        _shown(F.col("last_seen_at")).alias("last_seen_at"),
        "occurrences",
    )


@query
def alert_episodes(spark, folder):
    return _episode_columns(alerts.episodes(views.ops_events(spark, folder)))


def _acknowledgements(rows: DataFrame) -> DataFrame:
    """Alerts of odd services are acknowledged an hour after they were opened."""
    odd = F.substring("source", 4, 1).cast("int") % 2 == 1
    return rows.where(odd).select(
        "alert_id",
        F.lit("public-health-operations").alias("owner"),
        F.lit(None).cast("string").alias("note"),
        (F.col("created_at") + F.expr("INTERVAL 1 HOUR")).alias("acknowledged_at"),
    )


@query
def alert_summary(spark, folder):
    segments = alerts.segments(alerts.keyed(views.ops_events(spark, folder)))
    acknowledged = _acknowledgements(alerts.alerts_of(segments))
    return alerts.summary(alerts.alerts_of(segments, acknowledged))


@query
def alert_list(spark, folder):
    rows = alerts.episodes(views.ops_events(spark, folder))
    return _episode_columns(alerts.listed(rows, status="open", limit=5))


@query
def root_cause(spark, folder):
    reports = alerts.root_causes(views.typed_ops_events(spark, folder))
    return reports.select(
        "event_id", "summary", F.element_at("evidence", 1).alias("first_evidence"),
        F.size("evidence").alias("evidence_lines"), F.inline("probable_causes"),
    ).drop("confidence").withColumn("rank", F.col("rank").cast("int"))


@query
def state_alerts(spark, folder):
    jumps = series.top_jumps(
        series.yearly_jumps(views.monthly_series(spark, folder), 2.0), 10
    )
    quality = profile.quality_profile(
        views.indicator_obs(spark, folder).drop("sub_indicator", "sex")
    )
    age = profile.freshness(views.ops_events(spark, folder), "observed_at", F.lit("2024-06-01").cast("timestamp"), [], 720.0)
    signals = monitor.state_events(
        monitor.pipeline_events(quality),
        monitor.failed_event_events(routing_counts(spark, folder)),
        monitor.stale_events(age),
        monitor.quality_events(quality),
        monitor.jump_events(jumps),
    )
    rows = signals.withColumn("severity", scoring.severity()).withColumn("dedup_key", keys.alert_key())
    return rows.select(*rows.columns[:8], "severity", "dedup_key")


# --- service objectives ---------------------------------------------------------------------------------------
@query
def request_rollup(spark, folder):
    kind = F.col("event_type")
    rows = views.table(spark, folder, "events").select(
        F.when(kind.isin("purchase", "signup"), "POST").otherwise("GET").alias("method"),
        F.when(kind == "view", F.concat(F.lit("/api/v1/countries/"), F.col("user_id").cast("string"), F.lit("/risk")))
        .otherwise(F.concat(F.lit("/api/v1/"), kind))
        .alias("path"),
        F.when(kind == "error", 500).otherwise(200).alias("status_code"),
        (F.col("value") / 100).alias("duration_seconds"),
    )
    rolled = service.request_rollup(rows)
    return rolled.withColumn("duration_seconds", rounded("duration_seconds", 4))


@query
def error_rate_5min(spark, folder):
    rows = service.window_health(
        views.ops_events(spark, folder), F.col("status") == "failed", "5 minutes"
    )
    return rows.withColumn("window_start", _shown(F.col("window_start")))


@query
def latency_p95(spark, folder):
    rows = views.ops_events(spark, folder).withColumn("latency", F.col("value") / 100)
    found = service.window_latency(rows, "latency", "1 hour", 2.0)
    return found.select(
        _shown(F.col("window_start")).alias("window_start"), rounded("p95", 6).alias("p95"), "alerting"
    )


def _runs(spark, folder):
    """Every order day as one pipeline run."""
    pending = F.col("o_orderstatus") == "P"
    return (
        views.table(spark, folder, "orders")
        .groupBy(F.col("o_orderdate").cast("timestamp").alias("started_at"))
        .agg(
            F.count(F.lit(1)).alias("record_count_in"),
            F.count_if(~pending).alias("record_count_valid"),
            F.count_if(pending & (F.col("o_orderkey") % 64 > 0)).alias("record_count_rejected"),
            F.max(F.col("o_custkey") % 90).alias("seconds"),
        )
        .select(
            "started_at",
            (F.col("started_at") + F.make_dt_interval(secs="seconds")).alias("completed_at"),
            F.when(F.col("record_count_rejected") > F.col("record_count_valid"), "failed")
            .otherwise("completed")
            .alias("status"),
            "record_count_in",
            "record_count_valid",
            "record_count_rejected",
            F.lit(0).cast("long").alias("record_count_dlq"),
        )
    )


@query
def slo_report(spark, folder):
    now = F.lit("2002-01-01").cast("timestamp")
    measures = service.run_measures(_runs(spark, folder), now)
    copies = routing_counts(spark, folder).select(
        F.lit("duplicate_rate_pct").alias("name"),
        (F.col("duplicate") * 100.0 / F.nullif(F.col("input"), F.lit(0))).alias("value"),
    )
    letters = views.table(spark, folder, "lineitem").where("l_returnflag = 'R'").select(
        F.col("l_shipdate").cast("timestamp").alias("failed_at"),
        F.when(
            F.col("l_linestatus") == "F",
            F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(hours=F.col("l_linenumber")),
        ).alias("resolved_at"),
    )
    waits = service.review_measures(letters, now)
    report = service.objective_report(measures.unionByName(copies).unionByName(waits))
    return report.withColumn("value", rounded("value", 4))


@query
def retention_keep(spark, folder):
    lines = views.table(spark, folder, "lineitem").select(
        "l_returnflag", F.col("l_shipdate").cast("timestamp").alias("at"), "l_linestatus"
    )
    now = F.lit("2001-06-01").cast("timestamp")
    closed = F.when(F.col("l_linestatus") == "F", F.col("at"))
    stamped = lines.withColumns(
        {"accepted_at": F.col("at"), "replayed_at": closed, "failed_at": F.col("at"),
         "resolved_at": closed, "recorded_at": F.col("at")}
    )
    kinds = ["accepted", "retry", "dlq", "metrics"]
    kept = stamped.groupBy("l_returnflag").agg(
        *[F.count_if(filters.retained(k, now)).alias(f"{k}_kept") for k in kinds],
        F.count(F.lit(1)).alias("n"),
    )
    return kept


# --- models and streams -------------------------------------------------------------------------------------------
@query
def forest_metrics(spark, folder):
    frame = features.forecast_frame(views.indicator_series(spark, folder))
    training, testing = features.holdout(frame)
    model = forest.train(training)
    return features.error_metrics(model.predicted(testing), ["indicator"])


@query
def forest_forecast(spark, folder):
    annual = views.indicator_series(spark, folder)
    training, testing = features.holdout(features.forecast_frame(annual))
    model = forest.train(training)
    residuals = features.error_metrics(model.predicted(testing), ["indicator"])
    statistics = features.indicator_statistics(features.with_changes(annual))
    return forest.forecasts(model, series.recent_history(annual), statistics, residuals, 3)


@query
def forecast_facts(spark, folder):
    """What every forecast must hold: its years, the order of its bounds, the plausible range."""
    annual = views.indicator_series(spark, folder)
    statistics = features.indicator_statistics(features.with_changes(annual))
    reach = F.col("reference_std") * forest.PLAUSIBLE_SPREADS
    ranges = statistics.select(
        "indicator", F.greatest(F.lit(0.0), F.col("minimum") - reach).alias("low"),
        (F.col("maximum") + reach).alias("high"),
    )
    made = forest_forecast(spark, folder).join(ranges, "indicator")
    ordered = (F.col("lower") <= F.col("predicted_value") + 1e-3) & (F.col("lower") <= F.col("upper"))
    inside = F.col("predicted_value").between(F.col("low") - 1e-3, F.col("high") + 1e-3)
    return made.groupBy("indicator").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("country").alias("series"),
        F.min("year").alias("first_year"), F.max("year").alias("last_year"),
        F.count_if(ordered).alias("ordered"), F.count_if(inside).alias("inside"),
    )


@query
def isolation_facts(spark, folder):
    """What every scoring must hold: all rows, flags above the 97 % mark, scores within 0..100."""
    made = iforest_scores(spark, folder)
    return made.agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_anomaly").alias("flagged"),
        F.count_if(F.col("anomaly_score").between(0, 100)).alias("within"),
        F.count_if(F.col("is_anomaly") & (F.col("decision_function") > 0)).alias("contradictory"),
    )


@query
def iforest_scores(spark, folder):
    frame = _anomaly_frame(spark, folder)
    model = isolation.fit(frame, ["country", "indicator", "year"])
    scored = model.scored(frame)
    return scored.select(
        "country", "indicator", "year", "decision_function", "is_anomaly", "anomaly_score", "review_level"
    )


@query
def alert_stream(spark, folder):
    from indicora.streaming import alert_flow

    root = scratch_path(spark, "alert-stream")
    signals = views.table(spark, folder, "events")
    first, last = signals.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("t")).agg(F.min("t"), F.max("t")).first()
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    quarter = F.floor((at - F.lit(first)) * 4 / (F.lit(last) - F.lit(first) + 1))
    for batch in range(4):  # the signals arrive in four parts, each a micro-batch
        signals.where(quarter == batch).write.mode("append").parquet(f"{root}/incoming")
        incoming = spark.readStream.schema(signals.schema).parquet(f"{root}/incoming")
        flow = alert_flow.start(views.as_ops_events(incoming), root, f"{root}/progress")
        flow.awaitTermination()
    return _episode_columns(alert_flow.alert_table(spark, root))


@query
def event_stream(spark, folder):
    """The sensor events as JSON lines, taken in by the streaming flow."""
    from indicora.streaming import event_flow

    root = scratch_path(spark, "event-stream")
    known = views.table(spark, folder, "nation").select(F.col("n_name").alias("country"))
    names = [r["country"] for r in known.collect()]
    line = F.to_json(F.struct(*events.EVENT_COLUMNS, "retry_count"))
    # copies lie in other files than their originals, and so mostly in other micro-batches
    dealt = views.sensor_replay(spark, folder).repartition(8, "arrival")
    dealt.select(line).write.text(f"{root}/incoming")
    flow = event_flow.start(
        spark, f"{root}/incoming", f"{root}/out", f"{root}/progress", countries=names, files_per_batch=2
    )
    flow.awaitTermination()
    return event_flow.counts(spark, f"{root}/out")


from indicora.plans import table_queries  # noqa: E402,F401  registers its queries
