"""Random-forest forecasts of annual series."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicora.functions.numbers import rounded
from indicora.learning import histogram_forest
from indicora.learning.features import FORECAST_NUMBERS
from indicora.learning.histogram_forest import Forest
from indicora.operators.series import SERIES
from indicora.scaling import constant_table

# --- fixed values: forest settings ----------------------------------------------------------
TREES, DEPTH, LEAF_ROWS, SEED = 240, 14, 2, 42
HISTORY = 5
PLAUSIBLE_SPREADS, RESIDUAL_SHARE = 3.0, 0.25


def preprocessing() -> Pipeline:
    """One-hot names (unknown names give zeros) and scaled numbers."""
    return Pipeline(
        stages=[
            StringIndexer(inputCols=SERIES, outputCols=["_ci", "_ii"], handleInvalid="keep"),
            OneHotEncoder(inputCols=["_ci", "_ii"], outputCols=["_cv", "_iv"], dropLast=True),
            VectorAssembler(inputCols=FORECAST_NUMBERS, outputCol="_numbers"),
            StandardScaler(withMean=True, inputCol="_numbers", outputCol="_scaled"),
            VectorAssembler(inputCols=["_cv", "_iv", "_scaled"], outputCol="features"),
        ]
    )


@dataclass
class Forecaster:
    preparation: PipelineModel
    forest: Forest

    def predicted(self, frame: DataFrame) -> DataFrame:
        scored = self.forest.transform(self.preparation.transform(frame))
        return scored.select(*frame.columns, "prediction")

    def feature_names(self) -> list[str]:
        countries, indicators = self.preparation.stages[0].labelsArray
        return [
            *[f"country={c}" for c in countries],
            *[f"indicator={i}" for i in indicators],
            *FORECAST_NUMBERS,
        ]

    def importances(self, spark, top: int = 15) -> DataFrame:
        weights = self.forest.importances
        table = constant_table(
            spark, {"feature": self.feature_names(), "importance": [float(w) for w in weights]}
        )
        return (
            table.withColumn("importance", rounded("importance", 6))
            .orderBy(F.col("importance").desc(), "feature")
            .limit(top)
        )

    def node_arrays(self, spark) -> list[dict[str, np.ndarray]]:
        """Trees as arrays. Their size is bounded by the number of trees and the depth, not by
        the data that is scored."""
        return self.forest.trees


def train(frame: DataFrame, trees: int = TREES) -> Forecaster:
    """Rows are told apart by series and year; they decide which trees draw a row how often."""
    frame = frame.select(*SERIES, "year", *[c for c in FORECAST_NUMBERS if c != "year"], "value").persist()
    try:
        preparation = preprocessing().fit(frame)
        ready = preparation.transform(frame).select("features", "value", F.xxhash64(*SERIES, "year").alias("key"))
        return Forecaster(preparation, histogram_forest.fit(ready, trees, DEPTH, LEAF_ROWS, SEED))
    finally:
        frame.unpersist()


def _tree_values(shared):
    @F.pandas_udf("mean double, q10 double, q90 double")
    def spread(features: pd.Series, low: pd.Series, high: pd.Series) -> pd.DataFrame:
        points = np.stack(features.to_numpy()) if len(features) else np.zeros((0, 1))
        rows = np.arange(len(points))
        values = np.empty((len(points), len(shared.value)))
        for slot, tree in enumerate(shared.value):
            at = np.zeros(len(points), dtype=np.int64)
            while len(points):
                inner = tree["low"][at] >= 0
                if not inner.any():
                    break
                value = points[rows, np.where(inner, tree["split"][at], 0)]
                cut = tree["cut"][at]
                goes_low = np.where(tree["named"][at], value == cut, value <= cut)
                step = np.where(goes_low, tree["low"][at], tree["high"][at])
                at = np.where(inner, step, at)
            values[:, slot] = tree["value"][at]
        clipped = np.clip(values, low.to_numpy()[:, None], high.to_numpy()[:, None])
        low_q, high_q = np.quantile(clipped, [0.1, 0.9], axis=1) if len(points) else ([], [])
        return pd.DataFrame({"mean": values.mean(axis=1), "q10": low_q, "q90": high_q})

    return spread


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / F.size(values)


def forecasts(
    model: Forecaster,
    histories: DataFrame,
    statistics: DataFrame,
    residuals: DataFrame,
    horizon: int = 3,
) -> DataFrame:
    """Recursive forecast of every series with an 80 % interval.

    ``histories``: (country, indicator, history), oldest first; ``statistics``: indicator ranges;
    ``residuals``: (indicator, residual_std). Every step predicts all series at once; the series
    never leave their tasks between steps.
    """
    if not 1 <= horizon <= 5:
        raise ValueError("horizon must be between 1 and 5")
    spark = histories.sparkSession
    spread = _tree_values(spark.sparkContext.broadcast(model.node_arrays(spark)))
    reach = PLAUSIBLE_SPREADS * F.col("reference_std")
    limits = statistics.select(
        "indicator",
        F.greatest(F.lit(0.0), F.col("minimum") - reach).alias("_floor"),
        (F.col("maximum") + reach).alias("_ceiling"),
    )
    state = (
        histories.where(F.size("history") >= 2)
        .join(limits, "indicator")
        .join(residuals.select("indicator", "residual_std"), "indicator", "left")
        .select(
            *SERIES,
            "_floor",
            "_ceiling",
            (F.coalesce("residual_std", F.lit(0.0)) * RESIDUAL_SHARE).alias("_margin"),
            F.transform("history", lambda h: h["value"]).alias("_values"),
            F.element_at("history", -1)["year"].alias("_year"),
            F.array().cast("array<struct<year:int,value:double,lower:double,upper:double>>").alias("_out"),
        )
    )
    carried = state.columns
    for _ in range(horizon):
        recent = F.slice(F.col("_values"), F.greatest(F.size("_values") - 2, F.lit(1)), 3)
        lag1, lag2 = F.element_at("_values", -1), F.element_at("_values", -2)
        numbers = (
            state.withColumn("_recent", recent)
            .withColumn("year", (F.col("_year") + 1).cast("int"))
            .withColumn("lag1", lag1)
            .withColumn("lag2", lag2)
            .withColumn("rolling_mean_3", _mean(F.col("_recent")))
            .withColumn(
                "rolling_std_3",
                F.sqrt(
                    _mean(
                        F.transform(
                            "_recent", lambda v: F.pow(v - F.col("rolling_mean_3"), F.lit(2.0))
                        )
                    )
                ),
            )
            .withColumn("trend_delta", F.col("lag1") - F.col("lag2"))
        )
        ready = model.preparation.transform(numbers).withColumn(
            "_p", spread(vector_to_array("features"), F.col("_floor"), F.col("_ceiling"))
        )
        value = F.least(F.greatest(F.col("_p.mean"), F.col("_floor")), F.col("_ceiling"))
        lower = F.greatest(F.col("_floor"), F.col("_p.q10") - F.col("_margin"))
        upper = F.least(F.col("_ceiling"), F.greatest(lower, F.col("_p.q90") + F.col("_margin")))
        point = F.struct(
            F.col("year").alias("year"),
            value.alias("value"),
            lower.alias("lower"),
            upper.alias("upper"),
        )
        kept = F.concat("_values", F.array(value))
        state = (
            ready.withColumn("_out", F.concat("_out", F.array(point)))
            .withColumn("_values", F.slice(kept, F.greatest(F.size(kept) - HISTORY + 1, F.lit(1)), HISTORY))
            .withColumn("_year", F.col("year"))
            .select(*carried)
        )
    return state.select(*SERIES, F.inline("_out")).select(
        *SERIES,
        "year",
        rounded("value", 4).alias("predicted_value"),
        rounded("lower", 4).alias("lower"),
        rounded("upper", 4).alias("upper"),
    )


def recent_direction(histories: DataFrame) -> DataFrame:
    change = F.element_at("history", -1)["value"] - F.element_at("history", -2)["value"]
    return histories.where(F.size("history") >= 2).select(
        *SERIES,
        F.when(change > 0, "increasing").when(change < 0, "decreasing").otherwise("stable").alias(
            "recent_direction"
        ),
    )
