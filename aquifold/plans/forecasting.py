"""Forecast and anomaly-scoring pipelines over stored tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aquifold.functions import drop_suspect
from aquifold.operators import curated, features, forecast, forest
from aquifold.operators.boosting import BoostedModel
from aquifold.session import Staging, stage
from aquifold.sources.store import write_output


@dataclass
class ForecastRun:
    model: BoostedModel
    predictions: DataFrame
    metrics: DataFrame


def _daily_rain(rainfall: DataFrame, staging: Staging) -> DataFrame:
    """Rain per area and day, broadcast while that is small so that readings stay where they are."""
    return staging.write(curated.area_rainfall_unfiltered(rainfall), "daily_rain")


def run_forecast(
    wells: DataFrame, readings: DataFrame, rainfall: DataFrame, horizon: int = 30, **model_options
) -> ForecastRun:
    """Features, purged split, fit, test predictions and metrics.

    Cuts, fit and predictions read the features, so they are written first.
    """
    with Staging(readings.sparkSession) as staging:
        rain = _daily_rain(rainfall, staging)
        frame = staging.write(
            features.forecast_features(wells, drop_suspect(readings), rain, horizon), "features"
        )
        train, test, _ = features.purged_time_split(frame)
        model = forecast.fit_forecast(train, **model_options)
        predictions = stage(forecast.predict(model, test), "predictions")
        n_train = train.count()
    metrics = forecast.forecast_metrics(predictions).select(
        F.lit(horizon).alias("horizon_days"), F.lit(n_train).alias("n_train"), "*"
    )
    return ForecastRun(model, predictions, metrics)


def save_forecast(run: ForecastRun, folder: str) -> None:
    run.model.save(run.predictions.sparkSession, f"{folder}/forecast_model")
    write_output(run.predictions, f"{folder}/forecast_predictions")
    write_output(run.metrics, f"{folder}/forecast_metrics", "json")


@dataclass
class AnomalyRun:
    model: forest.IsolationForestModel
    scores: DataFrame


def run_anomalies(wells: DataFrame, readings: DataFrame, rainfall: DataFrame, **forest_options) -> AnomalyRun:
    """Isolation forest over every reading with complete features, and its scores; each row is scored once."""
    with Staging(readings.sparkSession) as staging:
        rain = _daily_rain(rainfall, staging)
        frame = staging.write(features.anomaly_features(wells, drop_suspect(readings), rain), "anomaly_features")
        model, scores = forest.fit_and_score(frame, features.ANOMALY_FEATURES, **forest_options)
        return AnomalyRun(model, scores)


def save_anomalies(run: AnomalyRun, folder: str, top: int = 10) -> None:
    """Persist the forest, all scores, and the worst rows as CSV."""
    run.model.save(f"{folder}/anomaly_model")
    write_output(run.scores, f"{folder}/anomaly_scores", "parquet")
    write_output(forest.top_anomalies(run.scores, top), f"{folder}/top_anomalies")


def save_sweep(sweep: DataFrame, folder: str) -> None:
    write_output(sweep, f"{folder}/forecast_horizon_sweep")


def score_anomalies(
    wells: DataFrame, readings: DataFrame, rainfall: DataFrame, **forest_options
) -> DataFrame:
    """Isolation-forest score of every reading with complete features."""
    return run_anomalies(wells, readings, rainfall, **forest_options).scores
