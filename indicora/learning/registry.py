"""Training runs and their registry table."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicora.functions.keys import table_digest
from indicora.learning import features, forest, isolation
from indicora.sources.tables import exists

_ENTRY = (
    "kind string, version string, trained_at timestamp, location string, digest string, "
    "rows long, countries long, indicators long, year_min int, year_max int, "
    "metrics map<string,double>, quality_gates map<string,boolean>"
)


@dataclass
class Trained:
    forecaster: forest.Forecaster
    detector: isolation.IsolationModel
    statistics: DataFrame
    residuals: DataFrame
    metrics: DataFrame
    registry: DataFrame


def _numbers(row, skip: tuple[str, ...] = ()) -> dict[str, float]:
    return {k: float(v) for k, v in row.asDict().items() if v is not None and k not in skip}


def lineage(annual: DataFrame) -> tuple:
    """What a model learned from: digest, rows, countries, indicators, first and last year."""
    facts = annual.agg(
        F.count_distinct("country").alias("countries"),
        F.count_distinct("indicator").alias("indicators"),
        F.min("year").alias("year_min"),
        F.max("year").alias("year_max"),
    ).first()
    digest = table_digest(annual.select("country", "indicator", "year", "value")).first()
    return (digest["digest"], digest["rows"], *facts)


def append(spark: SparkSession, root: str, entries: list[tuple]) -> None:
    """Add entries: kind, version, location, lineage, metrics, quality gates."""
    untimed = ", ".join(p for p in _ENTRY.split(", ") if not p.startswith("trained_at"))
    stamped = spark.createDataFrame(entries, untimed).withColumn("trained_at", F.current_timestamp())
    stamped.write.mode("append").parquet(f"{root}/registry")


def train_all(spark: SparkSession, annual: DataFrame, root: str, trees: int | None = None) -> Trained:
    """Train both models, save them under ``root`` and append two registry rows.

    Saved next to the models: the reference statistics, which later drift checks and scoring
    join with (tables, not nested maps).
    """
    run = uuid.uuid4().hex[:8]
    frame = features.forecast_frame(annual)
    training, testing = features.holdout(frame)
    forecaster = forest.train(training, trees or forest.TREES)
    tested = forecaster.predicted(testing)
    overall = features.error_metrics(tested)
    per_indicator = features.error_metrics(tested, ["indicator"])

    changes = features.with_changes(annual)
    statistics = features.indicator_statistics(changes)
    ready = features.anomaly_features(changes, statistics)
    detector = isolation.fit(ready, ["country", "indicator", "year"])

    tables = {"statistics": statistics, "residuals": per_indicator}
    for name, table in tables.items():
        table.write.parquet(f"{root}/{name}/{run}")
    forecaster.preparation.write().save(f"{root}/forecast_preparation/{run}")
    forecaster.forest.table(spark).write.parquet(f"{root}/forecast_forest/{run}")
    nodes = [
        (i, t["split"].tolist(), t["cut"].tolist(), t["low"].tolist(), t["high"].tolist(), t["length"].tolist())
        for i, t in enumerate(detector.trees)
    ]
    spark.createDataFrame(nodes, isolation._TREE).write.parquet(f"{root}/isolation_trees/{run}")

    shared = lineage(annual)
    written = [f"{root}/{n}/{run}" for n in (*tables, "forecast_preparation", "forecast_forest", "isolation_trees")]
    series = ["country", "indicator"]
    learned = training.groupBy(*series).agg(F.max("year").alias("_learned"))
    leaks = testing.join(learned, series).where(F.col("year") <= F.col("_learned")).limit(1).count()
    quality = {
        "artifacts_written": all(exists(spark, path) for path in written),
        "time_based_forecast_holdout": leaks == 0,
        "model_versioning": read(spark, root).where(F.col("version").endswith(run)).limit(1).count() == 0,
        "lineage_hash_recorded": bool(shared[0]),
        "drift_baseline_recorded": statistics.limit(1).count() > 0,
    }
    flagged = isolation.metrics(detector.scored(ready)).first()
    entries = [
        ("forecast", f"forecast-rf-{shared[0][:8]}-{run}", f"{root}/forecast_forest/{run}",
         *shared, _numbers(overall.first()), quality),
        ("anomaly", f"anomaly-iforest-{shared[0][:8]}-{run}", f"{root}/isolation_trees/{run}",
         *shared, {**_numbers(flagged), "cut": detector.cut, "q05": detector.q05,
                   "q50": detector.q50, "q95": detector.q95}, quality),
    ]
    append(spark, root, entries)
    stored = {n: spark.read.parquet(f"{root}/{n}/{run}") for n in tables}
    return Trained(
        forecaster, detector, stored["statistics"], stored["residuals"], overall, read(spark, root)
    )


def read(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/registry"
    if not exists(spark, path):
        return spark.createDataFrame([], _ENTRY)
    return spark.read.schema(_ENTRY).parquet(path)


def newest(registry: DataFrame) -> DataFrame:
    """The latest entry per kind of model."""
    columns = [c for c in registry.columns if c != "kind"]
    picked = registry.groupBy("kind").agg(F.max_by(F.struct(*columns), "trained_at").alias("e"))
    return picked.select("kind", "e.*")
