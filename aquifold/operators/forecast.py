"""Gradient-boosted level forecast and its evaluation against persistence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aquifold import schemas
from aquifold.functions import as_double, by_bore, rounded
from aquifold.operators import features as feat
from aquifold.operators.boosting import BoostedModel, fit_boosted
from aquifold.session import Staging

SWEEP_HORIZONS = (7, 14, 30, 45, 60)


def fit_forecast(
    train: DataFrame,
    trees: int = 300,
    learning_rate: float = 0.05,
    depth: int = 3,
    subsample: float = 0.8,
    seed: int = 0,
) -> BoostedModel:
    """Fit the model; a missing feature value is an error, not a guess."""
    return fit_boosted(
        train, feat.feature_columns(train), trees=trees, learning_rate=learning_rate, depth=depth,
        subsample=subsample, seed=seed,
    )[0]


def predict(model: BoostedModel, test: DataFrame) -> DataFrame:
    return model.transform(test).withColumn("actual", F.col("target")).select(*schemas.names(schemas.FORECASTS))


def forecast_metrics(predictions: DataFrame) -> DataFrame:
    """MAE and RMSE of the model and of persistence, in one pass."""
    error = F.col("actual") - F.col("predicted")
    naive = F.col("actual") - F.col("level_now")
    return (
        predictions.agg(
            F.count(F.lit(1)).alias("n_test"),
            F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"),
            F.avg(F.abs(naive)).alias("base_mae"), F.sqrt(F.avg(naive * naive)).alias("base_rmse"),
        )
        .select(
            "n_test",
            rounded(F.col("mae"), 4).alias("model_mae_m"),
            rounded(F.col("rmse"), 4).alias("model_rmse_m"),
            rounded(F.col("base_mae"), 4).alias("baseline_mae_m"),
            rounded(F.col("base_rmse"), 4).alias("baseline_rmse_m"),
            rounded(
                100 * (F.col("base_mae") - F.col("mae")) / F.nullif(F.col("base_mae"), F.lit(0.0)), 1
            ).alias("mae_improvement_pct"),
        )
    )


def horizon_targets(readings: DataFrame, horizons: tuple[int, ...] = SWEEP_HORIZONS) -> DataFrame:
    """Level now and ``h`` rows later for every horizon, from one window pass.

    Same rows as the feature frames: a level 30 rows back and a target exist.
    """
    bore = by_bore()
    level = as_double("water_level_mbgl")
    pairs = F.array(*[
        F.struct(F.lit(h).alias("horizon_days"), F.lead(level, h).over(bore).alias("actual")) for h in horizons
    ])
    return (
        readings.select(
            "well_id", "reading_date", level.alias("level_now"),
            F.lag(level, max(feat.LAGS)).over(bore).alias("far_lag"), pairs.alias("pairs"),
        )
        .filter(F.col("far_lag").isNotNull())
        .select("well_id", "reading_date", "level_now", F.inline("pairs"))
        .filter(F.col("actual").isNotNull())
    )


def persistence_baseline(
    readings: DataFrame, horizons: tuple[int, ...] = SWEEP_HORIZONS, test_fraction: float = 0.2
) -> DataFrame:
    """Test-set error of "no change" per horizon.

    Errors are summed per horizon and day in one pass over the readings; the split
    then works on that small table.
    """
    error = F.col("actual") - F.col("level_now")
    daily = horizon_targets(readings, horizons).groupBy("horizon_days", "reading_date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.abs(error)).alias("absolute"), F.sum(error * error).alias("squared")
    )
    of_horizon = Window.partitionBy("horizon_days")
    first_test = F.floor(F.count(F.lit(1)).over(of_horizon) * F.lit(1 - test_fraction)) + 1
    return (
        daily.withColumn("first_test", first_test)
        .withColumn("place", F.row_number().over(of_horizon.orderBy("reading_date")))
        .filter(F.col("place") >= F.col("first_test"))
        .groupBy("horizon_days")
        .agg(
            F.sum("rows").alias("n_test"),
            rounded(F.sum("absolute") / F.sum("rows"), 4).alias("baseline_mae_m"),
            rounded(F.sqrt(F.sum("squared") / F.sum("rows")), 4).alias("baseline_rmse_m"),
        )
    )


def horizon_sweep(
    wells: DataFrame,
    readings: DataFrame,
    rainfall: DataFrame,
    horizons: tuple[int, ...] = SWEEP_HORIZONS,
    **model_options,
) -> DataFrame:
    """Model against persistence for each horizon: one feature pass, and one fit that grows a model per horizon."""
    with Staging(readings.sparkSession) as staging:
        frame = staging.write(feat.history_features(wells, readings, rainfall, horizons), "history")
        rows = [feat.at_horizon(frame, h) for h in horizons]
        # One date per horizon, found once for the training rows and the metrics.
        dates = readings.sparkSession.range(1).select(*[feat.split_cutoff(r).alias(f"cutoff_{h}") for h, r in zip(horizons, rows)])
        cutoffs = [F.lit(date).cast("date") for date in dates.first()]
        # The rows of all training sets, each with the targets of the horizons that may learn from it.
        targets = {
            f"target_{h}": F.when(F.date_add("reading_date", h) < cutoff, F.col(f"target_{h}"))
            for h, cutoff in zip(horizons, cutoffs)
        }
        train = staging.write(
            frame.withColumns(targets).filter(F.coalesce(*targets).isNotNull()), "train"
        )
        inputs = [c for c in feat.feature_columns(train) if c not in targets]
        models = fit_boosted(train, inputs, tuple(targets), **model_options)
        outcomes = []
        for horizon, model, r, cutoff in zip(horizons, models, rows, cutoffs):
            metrics = forecast_metrics(predict(model, r.filter(F.col("reading_date") >= cutoff))).first()
            outcomes.append((horizon, metrics.model_mae_m, metrics.baseline_mae_m, metrics.mae_improvement_pct))
    return readings.sparkSession.createDataFrame(
        outcomes, "horizon_days int, model_mae_m double, baseline_mae_m double, improvement_pct double"
    )


def feature_importance(model: BoostedModel, top: int = 6) -> DataFrame:
    """The most important inputs of a fitted model (one number per feature)."""
    pairs = [(name, float(weight)) for name, weight in zip(model.features, model.importances)]
    return (
        SparkSession.active().createDataFrame(pairs, "feature string, importance double")
        .orderBy(F.col("importance").desc(), "feature").limit(top)
    )
