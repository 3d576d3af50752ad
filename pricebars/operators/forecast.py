"""Two forecasting models per series, with approximate 95 % intervals.

``linear_trend`` is ordinary least squares on the index 0..n-1, all in built-in functions.
``holt_smoothing`` is damped additive trend smoothing whose parameters are the best of a fixed grid; the
grid loop is a vectorised Arrow function, since each step needs the state of the step before.
"""

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebars.functions.numeric import divide
from pricebars.functions.periods import project_date
from pricebars.operators.series import eligible
from pricebars.schema import HORIZON, MIN_OBS, SERIES_KEY

# --- fixed values -----------------------------------------------------------
Z95 = 1.96
MIN_VARIANCE = 1e-4
MIN_RMSE = 0.01
ALPHAS = [0.1, 0.3, 0.5, 0.7, 0.9]
BETAS = [0.05, 0.1, 0.2, 0.3]
PHIS = [0.80, 0.85, 0.90, 0.95, 0.98]
# ----------------------------------------------------------------------------

GRID = list(product(ALPHAS, BETAS, PHIS))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def _values() -> Column:
    return F.transform("points", lambda p: p["value"])


def _with_last(series: DataFrame) -> DataFrame:
    return series.withColumns(
        {"n": F.size("points").cast("bigint"), "last": F.element_at("points", -1)["time_index"], "y": _values()}
    )


def ols_fit(series: DataFrame) -> DataFrame:
    """Slope, intercept and residual variance per series.

    The index has a closed-form mean and spread.  Residuals are summed in a second pass over the array,
    since the one-pass formula cancels on near-linear series.
    """
    n = F.col("n").cast("double")  # n cubed does not fit an integer for long series
    sxy = _sum(F.transform("y", lambda y, i: (i - F.col("x_mean")) * (y - F.col("y_mean"))))
    residuals = F.transform("y", lambda y, i: y - (F.col("beta0") + F.col("beta1") * i))
    ssr = F.aggregate(residuals, F.lit(0.0), lambda total, r: total + r * r)
    raw = F.when(n > 2, divide(F.col("ssr"), n - 2)).otherwise(MIN_VARIANCE)
    return (
        _with_last(series)
        .withColumns({"x_mean": (n - 1) / 2, "sxx": n * (n * n - 1) / 12, "y_mean": divide(_sum(F.col("y")), n)})
        .withColumn("beta1", F.coalesce(divide(sxy, F.col("sxx")), F.lit(0.0)))
        .withColumn("beta0", F.col("y_mean") - F.col("beta1") * F.col("x_mean"))
        .withColumn("ssr", ssr)
        .withColumn("s2", F.when(raw > 0, raw).otherwise(MIN_VARIANCE))
        .select(*SERIES_KEY, "n", "last", "x_mean", "sxx", "beta0", "beta1", "s2")
    )


def repair_interval(df: DataFrame) -> DataFrame:
    """Prices are not negative and have 4 digits; the interval holds the prediction."""
    def price(name: str) -> Column:
        return F.round(F.greatest(F.lit(0.0), F.col(name)), 4)

    return df.withColumns({c: price(c) for c in ("predicted_value", "confidence_low", "confidence_high")}).withColumns(
        {
            "confidence_low": F.least("confidence_low", "predicted_value"),
            "confidence_high": F.greatest("confidence_high", "predicted_value"),
        }
    )


def _forecast_rows(fits: DataFrame, model: str, horizon: int, value: Column, margin: Column) -> DataFrame:
    """One row per series and step; ``value`` and ``margin`` may refer to the step ``k``."""
    steps = fits.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    rows = steps.withColumns({"predicted_value": value, "margin": margin}).select(
        *SERIES_KEY,
        F.lit(model).alias("model_name"),
        project_date(F.col("timeframe"), F.col("last"), F.col("k")).alias("predicted_time"),
        "predicted_value",
        (F.col("predicted_value") - F.col("margin")).alias("confidence_low"),
        (F.col("predicted_value") + F.col("margin")).alias("confidence_high"),
    )
    return repair_interval(rows)


def linear_trend(series: DataFrame, horizon: int = HORIZON) -> DataFrame:
    step = F.col("n") - 1 + F.col("k")
    away = step - F.col("x_mean")
    spread = F.when(F.col("sxx") > 0, F.col("sxx")).otherwise(MIN_VARIANCE)
    error = F.sqrt(F.col("s2") * (1 + 1.0 / F.col("n") + away * away / spread))
    return _forecast_rows(
        ols_fit(series), "linear_trend", horizon, F.col("beta0") + F.col("beta1") * step, Z95 * error
    )


_HOLT = "sse DOUBLE, alpha DOUBLE, beta DOUBLE, phi DOUBLE, level DOUBLE, trend DOUBLE"


def _holt_function(grid: list[tuple[float, float, float]], block: int = 256):
    """The Arrow function that fits a batch of value arrays.

    It carries its helper inside: nothing of this package has to be installed on the executors.
    ``block`` series are fitted side by side, which bounds the padded value matrix.
    """
    alpha, beta, phi = (np.array(axis) for axis in zip(*grid))

    def fit_block(values: list[np.ndarray]) -> list[tuple]:
        """Best grid point of each series.  The series come by falling length, so those still running
        at a step are the first rows and no masking is needed."""
        lengths = np.array([len(v) for v in values])
        y = np.zeros((len(values), lengths[0]))
        for row, v in zip(y, values):
            row[: len(v)] = v
        level = np.repeat(y[:, :1], len(alpha), axis=1)
        trend = np.repeat(y[:, 1:2] - y[:, :1], len(alpha), axis=1)
        sse = np.zeros_like(level)
        for t in range(1, lengths[0]):
            live = np.count_nonzero(lengths > t)
            now = y[:live, t : t + 1]
            damped = phi * trend[:live]
            expected = level[:live] + damped
            error = now - expected
            sse[:live] += error * error
            new_level = alpha * now + (1.0 - alpha) * expected
            trend[:live] = beta * (new_level - level[:live]) + (1.0 - beta) * damped
            level[:live] = new_level
        best = sse.argmin(axis=1)  # the first of equals, that is the smallest (alpha, beta, phi)
        rows = np.arange(len(values))
        return list(zip(sse[rows, best], alpha[best], beta[best], phi[best], level[rows, best], trend[rows, best]))

    @F.pandas_udf(_HOLT)
    def fit(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            values = list(series)
            order = sorted(range(len(values)), key=lambda i: -len(values[i]))
            out: list[tuple] = [()] * len(order)
            for start in range(0, len(order), block):
                picked = order[start : start + block]
                for i, fitted in zip(picked, fit_block([values[i] for i in picked])):
                    out[i] = fitted
            yield pd.DataFrame(out, columns=["sse", "alpha", "beta", "phi", "level", "trend"])

    return fit


def holt_fit(series: DataFrame, grid: list[tuple[float, float, float]] = GRID) -> DataFrame:
    """Level and trend after the last point, for the grid point with the least squared one-step error.

    Starts at level = y1, trend = y2 - y1; errors count from the second point; ties go to the smaller
    (alpha, beta, phi).
    """
    usable = _with_last(series).filter(F.col("n") >= 2).withColumn("fit", _holt_function(grid)("y"))
    rmse = F.sqrt(F.col("fit.sse") / (F.col("n") - 1))
    return usable.select(
        *SERIES_KEY, "n", "last", "fit.*", F.when(rmse > 0, rmse).otherwise(MIN_RMSE).alias("rmse")
    )


def holt_smoothing(
    series: DataFrame, horizon: int = HORIZON, grid: list[tuple[float, float, float]] = GRID
) -> DataFrame:
    damping = F.aggregate(
        F.sequence(F.lit(1), F.col("k")), F.lit(0.0), lambda total, i: total + F.pow("phi", i.cast("double"))
    )
    return _forecast_rows(
        holt_fit(series, grid), "holt_smoothing", horizon,
        F.col("level") + damping * F.col("trend"),
        Z95 * F.col("rmse") * F.sqrt(F.col("k")),
    )


def forecast(series: DataFrame, horizon: int = HORIZON, min_obs: int = MIN_OBS) -> DataFrame:
    """Both models over every eligible series; the shuffle that builds the series is shared."""
    fit_on = eligible(series, min_obs)
    return linear_trend(fit_on, horizon).unionByName(holt_smoothing(fit_on, horizon))


def confidence_spread(predictions: DataFrame) -> DataFrame:
    """Width of the interval in percent of the prediction; NULL for a prediction of 0."""
    width = F.col("confidence_high") - F.col("confidence_low")
    return predictions.withColumn("spread_pct", divide(width, F.col("predicted_value")) * 100)
