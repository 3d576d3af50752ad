import math
import os
import subprocess
import sys
from datetime import date, timedelta

import numpy as np
import pytest
from helpers import BARS, D, SERIES, bar, one, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.cloudpickle import dumps
from pyspark.sql import functions as F

from pricebars.functions.periods import project_date
from pricebars.operators import backcast, evaluate, forecast, series

MODELS = {"linear_trend": forecast.linear_trend, "holt_smoothing": forecast.holt_smoothing}


def make(spark, *value_lists, timeframe="year", start=2000):
    def points(values):
        if timeframe == "year":
            return [(date(start + i, 1, 1), v) for i, v in enumerate(values)]
        return [(date(2024, 1, 1) + timedelta(i), v) for i, v in enumerate(values)]

    return spark.createDataFrame([(f"S{k}", timeframe, "close_price", points(v)) for k, v in enumerate(value_lists)], SERIES)


def noisy(slope, level, noise, seed, n=15):
    rng = np.random.default_rng(seed)
    return [float(v) for v in level + slope * np.arange(n) + rng.normal(0, noise, n)]


RISING, FLAT = noisy(2, 5, 0.1, 42), noisy(0, 3, 0.05, 0)


@pytest.mark.parametrize("model", MODELS)
def test_forecast_shape_and_order(spark, model):
    got = MODELS[model](make(spark, RISING)).orderBy("predicted_time").collect()
    assert [r.predicted_time for r in got] == [D("2015-01-01"), D("2016-01-01"), D("2017-01-01")]
    assert all(r.confidence_low < r.predicted_value < r.confidence_high for r in got)
    values = [r.predicted_value for r in got]
    assert values == sorted(values) and len(set(values)) == 3
    widths = [r.confidence_high - r.confidence_low for r in got]
    assert widths == sorted(widths) and widths[0] < widths[-1]
    assert {r.model_name for r in got} == {model}


@pytest.mark.parametrize("model", MODELS)
def test_flat_series_stays_flat(spark, model):
    got = MODELS[model](make(spark, FLAT)).collect()
    values = [r.predicted_value for r in got]
    assert max(values) - min(values) < 1 and all(abs(v - 3) < 1 for v in values)


@pytest.mark.parametrize("model", MODELS)
@pytest.mark.parametrize("values", [[94.0, 96.0, 98.0, 100.0], [6.0, 4.0, 2.0, 0.0], [8.0, 6.0, 4.0, 2.0, 0.0], [92.0, 94.0, 96.0, 98.0, 100.0]])
def test_prices_are_never_negative(spark, model, values):
    got = MODELS[model](make(spark, values)).collect()
    assert all(0 <= r.confidence_low <= r.predicted_value <= r.confidence_high for r in got)
    assert not any(math.isnan(r.predicted_value) for r in got)
    if values[-1] == 0:
        assert all(r.predicted_value == 0 and r.confidence_low == 0 for r in got)


def test_exact_line_and_constant(spark):
    line, flat = forecast.ols_fit(make(spark, [1.0, 3.0, 5.0, 7.0], [4.0, 4.0, 4.0])).orderBy("symbol").collect()
    assert (line.beta0, line.beta1) == (1.0, 2.0) and line.s2 == pytest.approx(1e-4)
    assert (flat.beta0, flat.beta1, flat.s2) == (4.0, 0.0, 1e-4)


def test_two_and_one_points(spark):
    two, one_ = forecast.ols_fit(make(spark, [1.0, 3.0], [5.0])).orderBy("symbol").collect()
    assert (two.beta1, two.s2) == (2.0, 1e-4)
    assert (one_.beta0, one_.beta1, one_.s2) == (5.0, 0.0, 1e-4)
    assert forecast.holt_fit(make(spark, [5.0])).count() == 0


def test_linear_interval_by_hand(spark):
    y = [1.0, 2.0, 4.0, 4.0, 7.0]
    x = np.arange(5)
    b1, b0 = np.polyfit(x, y, 1)
    s2 = ((y - (b0 + b1 * x)) ** 2).sum() / 3
    for k, r in enumerate(forecast.linear_trend(make(spark, y)).orderBy("predicted_time").collect(), start=1):
        t = 4 + k
        margin = 1.96 * math.sqrt(s2 * (1 + 1 / 5 + (t - 2) ** 2 / 10))
        assert r.predicted_value == pytest.approx(b0 + b1 * t, abs=1e-4)
        assert r.confidence_high - r.predicted_value == pytest.approx(margin, abs=2e-4)


def best_by_brute_force(y):
    best = None
    for a, b, p in forecast.GRID:
        level, trend, sse = y[0], y[1] - y[0], 0.0
        for v in y[1:]:
            expected = level + p * trend
            sse += (v - expected) * (v - expected)
            new = a * v + (1.0 - a) * expected
            level, trend = new, b * (new - level) + (1.0 - b) * (p * trend)
        if best is None or (sse, a, b, p) < best[:4]:
            best = (sse, a, b, p, level, trend)
    return best


def test_smoother_finds_the_best_grid_point(spark):
    rng = np.random.default_rng(7)
    lists = [[float(v) for v in rng.uniform(1, 100, n)] for n in (2, 3, 5, 8, 13, 13, 40, 3)]
    got = {r.symbol: r for r in forecast.holt_fit(make(spark, *lists, timeframe="day").repartition(3)).collect()}
    for k, y in enumerate(lists):
        r = got[f"S{k}"]
        assert (r.sse, r.alpha, r.beta, r.phi, r.level, r.trend) == best_by_brute_force(y)
        assert r.rmse == math.sqrt(r.sse / (len(y) - 1))


def test_smoother_on_an_exact_constant(spark):
    r = one(forecast.holt_fit(make(spark, [3.0, 3.0, 3.0, 3.0])))
    assert (r.alpha, r.beta, r.phi, r.level, r.trend, r.rmse) == (0.1, 0.05, 0.8, 3.0, 0.0, 0.01)


def test_smoother_forecast_is_damped(spark):
    r = one(forecast.holt_fit(make(spark, RISING)))
    values = [x.predicted_value for x in forecast.holt_smoothing(make(spark, RISING)).orderBy("predicted_time").collect()]
    for h, v in enumerate(values, start=1):
        assert v == pytest.approx(r.level + sum(r.phi**i for i in range(1, h + 1)) * r.trend, abs=1e-4)


def test_smoother_needs_no_package_on_the_executors(tmp_path):
    """Unpickled and run by a Python that does not know this package, as on an executor."""
    (tmp_path / "fit.pickle").write_bytes(dumps(forecast._holt_function(forecast.GRID).func))
    script = (
        "import numpy, pandas; from pyspark.cloudpickle import loads; fit = loads(open('fit.pickle', 'rb').read());"
        "print(next(fit(iter([pandas.Series([numpy.array([3.0, 3.0, 3.0])])]))).level[0])"
    )
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=environment, capture_output=True, text=True)
    assert run.stdout.strip() == "3.0", run.stderr


def test_eligibility(spark):
    df = make(spark, [1.0, 2.0], [1.0, 2.0, 3.0])
    assert [r.symbol for r in series.eligible(df).collect()] == ["S1"]
    assert forecast.forecast(df).count() == 6


@pytest.mark.parametrize(
    "timeframe, last, expected",
    [
        ("day", "2024-02-28", ["2024-02-29", "2024-03-01", "2024-03-02"]),
        ("week", "2024-12-23", ["2024-12-30", "2025-01-06", "2025-01-13"]),
        ("month", "2024-12-01", ["2025-01-01", "2025-02-01", "2025-03-01"]),
        ("month", "2024-01-31", ["2024-02-01", "2024-03-01", "2024-04-01"]),
        ("year", "2024-01-01", ["2025-01-01", "2026-01-01", "2027-01-01"]),
        ("decade", "2024-01-01", ["2024-01-02", "2024-01-03", "2024-01-04"]),
    ],
)
def test_projected_dates(spark, timeframe, last, expected):
    df = spark.range(1, 4).select(project_date(F.lit(timeframe), F.lit(D(last)), F.col("id")).alias("d"))
    assert [r.d for r in df.orderBy("d").collect()] == [D(e) for e in expected]


def test_series_from_bars_and_from_rows_agree(spark):
    days = spark.createDataFrame(
        [bar("A", "day", "2024-01-02", None, 2.0, 1.0, 1.5), bar("A", "day", "2024-01-01", 1.0, 3.0, 1.0, 2.0)], BARS
    )
    points = series.to_series(days)
    assert one(points.filter("indicator = 'open_price'")).points == [(D("2024-01-01"), 1.0)]
    assert [v for _, v in one(points.filter("indicator = 'close_price'")).points] == [2.0, 1.5]
    index = series.series_index(points)
    again = series.rows_to_series(index.unionByName(index).drop("t"))
    assert rows(points, "indicator") == rows(again, "indicator")
    assert [r.t for r in index.filter("indicator = 'close_price'").orderBy("t").collect()] == [0, 1]


def test_rows_to_series_drops_missing_and_takes_one_value_per_date(spark):
    df = spark.createDataFrame(
        [("A", "day", "close_price", D("2024-01-01"), v) for v in (2.0, 1.0, None, float("nan"))],
        "symbol STRING, timeframe STRING, indicator STRING, time_index DATE, value DOUBLE",
    )
    assert one(series.rows_to_series(df)).points == [(D("2024-01-01"), 1.0)]


def test_split(spark):
    df = make(spark, [1.0, 2.0, 3.0, 4.0], [1.0])
    long, short = series.split(df, 1).orderBy("symbol").collect()
    assert [v for _, v in long.points] == [1.0, 2.0, 3.0] and [v for _, v in long.test] == [4.0]
    assert len(short.points) == 1 and short.test == []
    assert [r.part for r in series.split_rows(df, 3).filter("symbol = 'S0'").orderBy("time_index").collect()] == ["train", "test", "test", "test"]


def test_backtest_scores_only_equal_dates(spark):
    gap = spark.createDataFrame(
        [
            ("FRI", "day", "close_price", [(D("2024-01-03"), 1.0), (D("2024-01-04"), 2.0), (D("2024-01-05"), 3.0), (D("2024-01-08"), 9.0)]),
            ("GAP", "day", "close_price", [(D("2024-01-03"), 1.0), (D("2024-01-04"), 2.0), (D("2024-01-05"), 3.0), (D("2024-02-08"), 9.0)]),
        ],
        SERIES,
    )
    predictions, scores = evaluate.backtest(gap)
    assert predictions.count() == 12
    linear = one(scores.filter("model_name = 'linear_trend'"))
    assert (linear.symbol, linear.predicted_value, linear.mae, linear.rmse, linear.mape, linear.r2) == ("FRI", 6.0, 3.0, 3.0, 33.3333, None)
    assert one(evaluate.backtest_summary(scores).filter("model_name = 'linear_trend'")).avg_mae == 3.0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.floats(0, 1000, width=32), min_size=3, max_size=30), min_size=1, max_size=6))
def test_intervals_hold_for_any_series(spark, lists):
    got = forecast.forecast(make(spark, *lists)).collect()
    assert len(got) == 6 * len(lists)
    assert all(0 <= r.confidence_low <= r.predicted_value <= r.confidence_high for r in got)


def test_spread(spark):
    df = spark.createDataFrame([(10.0, 9.0, 12.0), (0.0, 0.0, 1.0)], "predicted_value DOUBLE, confidence_low DOUBLE, confidence_high DOUBLE")
    assert sorted((r.spread_pct for r in forecast.confidence_spread(df).collect()), key=str) == [30.0, None]


def test_both_models_share_one_shuffle(spark):
    days = spark.createDataFrame([bar("A", "day", f"2024-01-{i:02d}", 1.0, 1.0, 1.0, float(i)) for i in range(1, 9)], BARS)
    both = forecast.forecast(series.to_series(days.repartition(4)))
    both.collect()
    assert "ReusedExchange" in both._jdf.queryExecution().executedPlan().toString()


QUOTES = "symbol STRING, name STRING, timeframe STRING, time_index DATE, open_price DOUBLE, high_price DOUBLE, low_price DOUBLE, close_price DOUBLE, latest_price DOUBLE"


def test_backcast(spark):
    quotes = spark.createDataFrame([("AB", "ab", "day", D("2024-03-31"), 9.0, 11.0, 8.0, 9.5, 10.0)], QUOTES)
    got = backcast.backcast(quotes, D("2024-03-31"), 5)
    counts = {r.timeframe: r["count"] for r in got.groupBy("timeframe").count().collect()}
    assert counts == {"day": 91, "week": 104, "month": 36, "year": 5}
    seed = ord("A") + ord("B")
    step = (seed % 9 - 4) * 0.02
    row = one(got.filter("timeframe = 'month' AND time_index = date'2024-02-01'"))
    close = 10 / (1 + step)
    open_ = close * (0.97 + (seed % 5) * 0.012)
    assert row.close_price == pytest.approx(close) and row.open_price == pytest.approx(open_)
    assert row.high_price == pytest.approx(max(open_, close) * 1.03) and row.low_price == pytest.approx(min(open_, close) * 0.97)
    assert one(got.filter("source = 'quote'")).close_price == 9.5
    weeks = got.filter("timeframe = 'week'")
    assert weeks.filter("weekday(time_index) <> 0").count() == 0
    assert weeks.agg(F.max("time_index")).collect()[0][0] == D("2024-03-18")
    assert got.filter("timeframe = 'year'").agg(F.min("time_index")).collect()[0][0] == D("2019-01-01")


def test_backcast_floor(spark):
    quotes = spark.createDataFrame([("AB", "ab", "day", D("2024-03-31"), 0.001, 0.001, 0.001, 0.001, 0.001)], QUOTES)
    assert backcast.backcast(quotes, D("2024-03-31")).filter("source <> 'quote'").agg(F.min("close_price")).collect()[0][0] == 0.01


def test_symbols_without_history(spark):
    quotes = spark.createDataFrame([("A",), ("B",)], "symbol STRING")
    bars_ = spark.createDataFrame([("A",), ("A",)], "symbol STRING")
    assert rows(backcast.symbols_without_history(quotes, bars_), "symbol") == [("B",)]
