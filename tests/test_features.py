import pytest
from helpers import BARS, D, bar, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricebars.operators import features
from pricebars.plans.queries import canonical_name_table

PROFILES = "symbol STRING, name STRING, category STRING"


def closes(spark, *values, symbol="A"):
    return spark.createDataFrame(
        [bar(symbol, "day", f"2024-01-{i + 1:02d}", v, v, v, v) for i, v in enumerate(values)], BARS
    )


def test_movement(spark):
    got = features.price_movement(closes(spark, 100.0, 101.0, 99.99, 100.0, 0.0, 5.0))
    assert [(r.price_change, r.price_change_pct, r.price_trend) for r in got.orderBy("time_index").collect()] == [
        (None, None, "new"), (1.0, 1.0, "up"), (-1.01, -1.0, "down"), (0.01, 0.01, "flat"),
        (-100.0, -100.0, "down"), (5.0, None, "new"),
    ]


def test_movement_after_a_missing_close(spark):
    got = features.price_movement(closes(spark, 1.0, None, 2.0))
    assert [r.price_trend for r in got.orderBy("time_index").collect()] == ["new", "new", "new"]


def test_movement_keeps_symbols_and_timeframes_apart(spark):
    df = closes(spark, 1.0, 2.0).unionByName(closes(spark, 5.0, symbol="B"))
    df = df.unionByName(df.withColumn("timeframe", F.lit("week")))
    assert features.price_movement(df).filter("price_trend = 'new'").count() == 4


def test_volatility(spark):
    df = spark.createDataFrame(
        [
            bar("A", "day", "2024-01-01", 1.0, 108.0, 100.0, 100.0), bar("A", "day", "2024-01-02", 1.0, 103.0, 100.0, 100.0),
            bar("A", "day", "2024-01-03", 1.0, 102.0, 100.0, 100.0), bar("A", "day", "2024-01-04", 1.0, 2.0, 1.0, 0.0),
            bar("A", "day", "2024-01-05", 1.0, None, 1.0, 1.0),
        ],
        BARS,
    )
    assert [(r.intraday_range, r.intraday_range_pct, r.volatility_level) for r in features.volatility(df).orderBy("time_index").collect()] == [
        (8.0, 8.0, "high"), (3.0, 3.0, "medium"), (2.0, 2.0, "low"), (1.0, None, None), (None, None, None),
    ]


@pytest.mark.parametrize(
    "operator, added",
    [
        (features.price_movement, ["price_change", "price_change_pct", "price_trend"]),
        (features.volatility, ["intraday_range", "intraday_range_pct", "volatility_level"]),
        (features.with_category_average, ["category_avg_close", "category_count"]),
    ],
)
def test_missing_input_gives_typed_nulls(spark, operator, added):
    got = operator(spark.createDataFrame([("A",)], "symbol STRING"))
    assert got.columns == ["symbol", *added] and got.collect()[0][1:] == (None,) * len(added)
    assert "void" not in dict(got.dtypes).values()


def test_drop_missing_price(spark):
    assert features.drop_missing_price(closes(spark, 1.0, None, float("nan"))).count() == 1
    other = spark.range(3)
    assert features.drop_missing_price(other).count() == 3


def test_unknown_symbol_is_other(spark):
    profiles = spark.createDataFrame([("A", "a", "Tech")], PROFILES)
    got = features.with_category(closes(spark, 1.0).unionByName(closes(spark, 1.0, symbol="Z")), profiles)
    assert rows(got.select("symbol", "category"), "symbol") == [("A", "Tech"), ("Z", "Other")]


def test_category_average_equals_the_window(spark):
    profiles = spark.createDataFrame([("A", "a", "X"), ("B", "b", "X"), ("C", "c", "Y")], PROFILES)
    df = closes(spark, 1.0, 2.0, 4.0)
    for symbol, shift in (("B", 0.3), ("C", 7.0)):
        df = df.unionByName(closes(spark, 1.0 + shift, None, 2.0 + shift, symbol=symbol))
    df = features.with_category(df, profiles.drop("name"))
    joined = features.with_category_average(df).select("symbol", "time_index", "category_avg_close", "category_count")
    group = Window.partitionBy(*features.PERIOD)
    window = df.select(
        "symbol", "time_index", F.round(F.avg("close_price").over(group), 4).alias("a"), F.count("*").over(group).alias("n")
    )
    assert rows(joined, "symbol", "time_index") == rows(window, "symbol", "time_index")


def test_trend_distribution(spark):
    got = features.trend_distribution(features.price_movement(closes(spark, 1.0, 2.0, 2.0, 1.0, 2.0)))
    assert rows(got, "price_trend") == [("down", 1), ("flat", 1), ("new", 1), ("up", 2)]


def test_canonical_names(spark):
    df = spark.createDataFrame([("KOR", "Korea, Rep."), ("USA", "United States")], "symbol STRING, name STRING")
    assert rows(features.canonical_names(df, canonical_name_table(spark)), "symbol") == [
        ("KOR", "South Korea"), ("USA", "United States"),
    ]
    assert canonical_name_table(spark).count() == 41


def test_input_order_does_not_matter(spark):
    profiles = spark.createDataFrame([("A", "a", "X")], PROFILES)
    df = closes(spark, *[float(i * 37 % 11) + 0.1 for i in range(28)])
    a = features.enrich(df, profiles)
    b = features.enrich(df.orderBy(F.rand(1)).repartition(7), profiles)
    assert rows(a, "time_index") == rows(b.select(a.columns), "time_index")
    assert a.filter(F.col("time_index") == F.lit(D("2024-01-01"))).count() == 1
