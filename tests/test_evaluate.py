import pytest
from helpers import D, one, rows

from pricebars.operators import evaluate


def score(spark, actual, predicted):
    pairs = [("g", a, p) for a, p in zip(actual, predicted)]
    return evaluate.metrics(spark.createDataFrame(pairs, "g STRING, actual DOUBLE, predicted DOUBLE"), ["g"])


@pytest.mark.parametrize(
    "actual, predicted, expected",
    [
        ([1.0, 2.0, 3.0], [1.0, 2.0, 3.0], (0.0, 0.0, 0.0, 1.0)),
        ([1.0, 2.0, 4.0, 5.0], [2.0, 1.0, 5.0, 4.0], (1.0, 1.0, 48.75, 0.6)),
        ([0.0, 2.0], [1.0, 1.0], (1.0, 1.0, 50.0, 0.0)),
        ([0.0, 0.0], [1.0, 1.0], (1.0, 1.0, None, None)),
        ([5.0], [4.0], (1.0, 1.0, 20.0, None)),
        ([1.0, 2.0, 3.0], [3.0, 2.0, 1.0], (1.3333, 1.633, 88.8889, -3.0)),
        ([1.0, 2.0, None], [1.0, 2.0, 9.0], (0.0, 0.0, 0.0, 1.0)),
    ],
)
def test_metrics(spark, actual, predicted, expected):
    assert tuple(one(score(spark, actual, predicted)))[1:] == expected


def test_no_pairs_no_row(spark):
    assert score(spark, [], []).count() == 0


PREDS = "symbol STRING, timeframe STRING, indicator STRING, model_name STRING, predicted_time DATE, predicted_value DOUBLE"
ACTUALS = "symbol STRING, timeframe STRING, indicator STRING, time_index DATE, value DOUBLE"


def test_evaluate(spark):
    preds = spark.createDataFrame(
        [
            ("A", "year", "close_price", "linear_trend", D("2020-01-01"), 10.0),
            ("A", "year", "close_price", "linear_trend", D("2021-01-01"), 11.0),
            ("B", "year", "close_price", "linear_trend", D("2020-01-01"), 20.0),
            ("B", "year", "close_price", "holt_smoothing", D("2030-01-01"), 20.0),
        ],
        PREDS,
    )
    actuals = spark.createDataFrame(
        [
            ("A", "year", "close_price", D("2020-01-01"), 12.0),
            ("A", "year", "close_price", D("2021-01-01"), 10.0),
            ("A", "week", "close_price", D("2020-01-01"), 99.0),
        ],
        ACTUALS,
    )
    report = evaluate.evaluate(preds, actuals)
    row = one(report)
    assert (row.model_name, row.timeframe, row.mae, row.rmse, row.mape, row.r2, row.n_series, row.n_matched) == (
        "linear_trend", "year", 1.5, 1.5811, 13.3333, -1.5, 2, 2,
    )
    assert rows(evaluate.model_report(report), "model_name") == [("linear_trend", 1.5, 1.5811, -1.5)]


def test_evaluate_without_input_keeps_the_columns(spark):
    empty = evaluate.evaluate(spark.createDataFrame([], PREDS), spark.createDataFrame([], ACTUALS))
    assert empty.count() == 0
    assert empty.columns == ["model_name", "timeframe", "indicator", "mae", "rmse", "mape", "r2", "n_series", "n_matched"]
