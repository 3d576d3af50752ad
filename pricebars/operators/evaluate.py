"""Forecast quality: metrics, hold-out back-test, reports."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebars.functions.numeric import divide, exact_mean
from pricebars.operators.forecast import forecast
from pricebars.operators.series import eligible, split
from pricebars.schema import HORIZON, INDICATORS, MIN_OBS, SERIES_KEY, TEST_SIZE


def _metric_columns(matched: Column) -> dict[str, Column]:
    """Aggregates over ``actual`` and ``predicted`` of the matched rows."""
    actual = F.when(matched, F.col("actual"))
    error = F.when(matched, F.col("actual") - F.col("predicted"))
    squared, n = exact_mean(error * error), F.count(actual)
    # n times the variance of the actuals, from sums that don't depend on the order of the rows
    total = F.sum(actual.cast("decimal(28,8)")).cast("double")
    spread = F.sum((actual * actual).cast("decimal(38,8)")).cast("double") - divide(total * total, n)
    varies = F.max(actual) > F.min(actual)
    return {
        "mae": F.round(exact_mean(F.abs(error)), 4),
        "rmse": F.round(F.sqrt(squared), 4),
        "mape": F.round(exact_mean(F.abs(divide(error, actual))) * 100, 4),
        "r2": F.round(F.when(varies, 1 - divide(squared * n, spread)), 4),
    }


def metrics(pairs: DataFrame, by: list[str]) -> DataFrame:
    """MAE, RMSE, MAPE and R2 of ``actual`` against ``predicted`` per group.

    A zero actual does not count for MAPE; R2 is NULL where the actuals do not vary.
    """
    both = F.col("actual").isNotNull() & F.col("predicted").isNotNull()
    return pairs.filter(both).groupBy(*by).agg(*[c.alias(n) for n, c in _metric_columns(F.lit(True)).items()])


def evaluate(predictions: DataFrame, actuals: DataFrame) -> DataFrame:
    """Report per model, timeframe and indicator.

    ``n_series`` counts the symbols predicted, ``n_matched`` the forecasts that met an actual; groups
    without a match are left out.
    """
    known = actuals.select(*SERIES_KEY, F.col("time_index").alias("predicted_time"), F.col("value").alias("actual"))
    joined = predictions.join(known, [*SERIES_KEY, "predicted_time"], "left").withColumnRenamed(
        "predicted_value", "predicted"
    )
    matched = F.col("actual").isNotNull()
    return (
        joined.groupBy("model_name", "timeframe", "indicator")
        .agg(
            *[c.alias(n) for n, c in _metric_columns(matched).items()],
            F.countDistinct("symbol").alias("n_series"),
            F.count_if(matched).alias("n_matched"),
        )
        .filter(F.col("n_matched") > 0)
    )


def model_report(evaluation: DataFrame) -> DataFrame:
    return evaluation.groupBy("model_name").agg(
        *[F.round(exact_mean(F.col(m)), 4).alias(f"avg_{m}") for m in ("mae", "rmse", "r2")]
    )


def holdout_forecast(
    series: DataFrame, test_size: int = TEST_SIZE, horizon: int = HORIZON, min_obs: int = MIN_OBS
) -> DataFrame:
    """Forecasts refitted without the last ``test_size`` points of each eligible series."""
    return forecast(split(eligible(series, min_obs), test_size), horizon, min_obs=1)


def score(
    predictions: DataFrame, series: DataFrame, test_size: int = TEST_SIZE, min_obs: int = MIN_OBS
) -> DataFrame:
    """Errors of hold-out forecasts at the points held out.

    A point is scored when its date is one of the projected dates.  Both sides have a few rows per
    series.  Fitting costs more than scoring: pass stored predictions when they are needed again.
    """
    held = split(eligible(series, min_obs), test_size).select(*SERIES_KEY, F.explode("test").alias("p")).select(
        *SERIES_KEY, F.col("p.time_index").alias("predicted_time"), F.col("p.value").alias("actual")
    )
    error = F.abs(F.col("actual") - F.col("predicted_value"))
    return predictions.join(held, [*SERIES_KEY, "predicted_time"]).select(
        *SERIES_KEY, "model_name", "predicted_time", "actual", "predicted_value",
        F.round(error, 4).alias("mae"),
        F.round(error, 4).alias("rmse"),
        F.round(divide(error, F.abs("actual")) * 100, 4).alias("mape"),
        F.lit(None).cast("double").alias("r2"),
    )


def backtest(
    series: DataFrame, test_size: int = TEST_SIZE, horizon: int = HORIZON, min_obs: int = MIN_OBS
) -> tuple[DataFrame, DataFrame]:
    """Hold-out forecasts and their scores."""
    predictions = holdout_forecast(series, test_size, horizon, min_obs)
    return predictions, score(predictions, series, test_size, min_obs)


def backtest_summary(scores: DataFrame) -> DataFrame:
    """Mean of the hold-out scores per model and timeframe."""
    return scores.groupBy("model_name", "timeframe").agg(
        *[F.round(exact_mean(F.col(m)), 6).alias(f"avg_{m}") for m in ("mae", "rmse", "mape", "r2")],
        F.count(F.lit(1)).alias("n_points"),
    )


def run_metrics(
    series: DataFrame,
    predictions: DataFrame,
    scores: DataFrame,
    test_size: int = TEST_SIZE,
    horizon: int = HORIZON,
    min_obs: int = MIN_OBS,
) -> DataFrame:
    """One record per (model, timeframe) run: parameters, counts and mean scores."""
    total = series.groupBy("timeframe").agg(
        F.count(F.lit(1)).alias("n_series_total"), F.countDistinct("symbol").alias("n_symbols")
    )
    fitted = (
        predictions.groupBy("model_name", *SERIES_KEY).agg(F.count(F.lit(1)).alias("n"))
        .groupBy("model_name", "timeframe")
        .agg(F.count(F.lit(1)).alias("n_series_fitted"), F.sum("n").alias("n_predictions"))
    )
    return (
        fitted.join(total, "timeframe")
        .join(backtest_summary(scores), ["model_name", "timeframe"], "left")
        .select(
            "model_name", "timeframe",
            F.lit(horizon).cast("bigint").alias("horizon"),
            F.lit(min_obs).cast("bigint").alias("min_obs"),
            F.lit(test_size).cast("bigint").alias("test_size"),
            "n_symbols",
            F.lit(len(INDICATORS)).cast("bigint").alias("n_indicators"),
            F.lit(",".join(INDICATORS)).alias("indicators"),
            "n_series_total", "n_series_fitted", "n_predictions",
            "avg_mae", "avg_rmse", "avg_mape", "avg_r2",
        )
    )
