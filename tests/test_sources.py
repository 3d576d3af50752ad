import json
from datetime import date

import pytest
from helpers import BARS, D, bar, one, rows
from pyspark.sql import functions as F

from pricebars.functions.text import symbol_list
from pricebars.operators import bars, reshape, series
from pricebars.schema import FACT_SCHEMA, LONG_SCHEMA
from pricebars.sources import payloads, store, tables

DAY = 86400


def candles(spark, **payload):
    text = payload.pop("text", None) or json.dumps(payload)
    return payloads.explode_candles(spark.createDataFrame([("A", text)], "symbol STRING, payload STRING"))


def test_candles_become_daily_rows(spark):
    got = candles(spark, s="ok", t=[0, DAY + 5], o=[1, 2], h=[3, 4], l=[0.5, 1], c=[2, 3])
    assert rows(got.drop("seq"), "ts") == [
        ("A", D("1970-01-01"), 1.0, 3.0, 0.5, 2.0),
        ("A", D("1970-01-02"), 2.0, 4.0, 1.0, 3.0),
    ]


@pytest.mark.parametrize(
    "payload",
    [
        dict(s="no_data", t=[0], o=[1], h=[1], l=[1], c=[1]),
        dict(t=[0], o=[1], h=[1], l=[1], c=[1]),
        dict(s="ok", t=[0], o=[1], h=[1], l=[1]),
        dict(s="ok", t=[0], o=[1], h=[1], l=7, c=[1]),
        dict(s="ok", t=[], o=[], h=[], l=[], c=[]),
        dict(text="not json"),
    ],
)
def test_unusable_candles_are_rejected(spark, payload):
    assert candles(spark, **payload).count() == 0


def test_shortest_array_decides(spark):
    got = candles(spark, s="ok", t=[0, DAY, 2 * DAY], o=[1, 2, 3], h=[1, 2], l=[1, 2, 3], c=[1, 2, 3])
    assert got.count() == 2


def test_null_close_drops_the_candle_and_text_becomes_null(spark):
    got = candles(spark, s="ok", t=[0, DAY, 2 * DAY], o=["x", None, "2.5"], h=[1, 2, 3], l=[1, 2, 3], c=[5, None, "6"])
    assert [(r["open"], r["close"]) for r in got.orderBy("ts").collect()] == [(None, 5.0), (2.5, 6.0)]


def test_packed_candles_come_back(spark):
    days = spark.createDataFrame(
        [bar("A", "day", "2024-01-02", 1.5, 2.0, 1.0, 1.25), bar("A", "day", "2024-01-01", 1.0, 1.0, 1.0, 1.0)], BARS
    )
    back = bars.candle_bars(payloads.explode_candles(payloads.pack_candles(days)))
    assert rows(back.select(days.columns), "time_index") == rows(days, "time_index")


def quote(spark, name="Acme", **fields):
    df = spark.createDataFrame([("A", name, json.dumps(fields))], "symbol STRING, name STRING, payload STRING")
    return payloads.quote_snapshot(df, F.lit(date(2024, 1, 31)))


def test_quote(spark):
    row = one(quote(spark, c=10, o=9, h=11, l=8, pc=9.5))
    assert (row.timeframe, row.time_index, row.open_price, row.close_price, row.latest_price) == (
        "day", D("2024-01-31"), 9.0, 9.5, 10.0,
    )


@pytest.mark.parametrize("fields", [dict(c=0, pc=5), dict(c=None, pc=5), dict(pc=5)])
def test_quote_without_price_is_dropped(spark, fields):
    assert quote(spark, **fields).count() == 0


@pytest.mark.parametrize("pc", [0, None])
def test_missing_previous_close_gives_way_to_the_price(spark, pc):
    assert one(quote(spark, c=10, pc=pc)).close_price == 10.0


def test_quote_name_falls_back_to_symbol(spark):
    assert one(quote(spark, name=None, c=1)).name == "A"
    assert one(quote(spark, name="", c=1)).name == "A"


def test_profile_fallbacks(spark):
    symbols = spark.createDataFrame([(s,) for s in "ABCDE"], "symbol STRING")
    landed = spark.createDataFrame(
        [
            ("A", json.dumps(dict(name="Alpha", ticker="AA", industry="Tech", exchange="X"))),
            ("B", json.dumps(dict(name="", ticker="BB", exchange="X"))),
            ("C", json.dumps({})),
            ("D", "broken"),
        ],
        "symbol STRING, payload STRING",
    )
    defaults = spark.createDataFrame([("C", "Gamma", "Energy")], "symbol STRING, name STRING, category STRING")
    assert rows(payloads.resolve_profile(symbols, landed, defaults), "symbol") == [
        ("A", "Alpha", "Tech"), ("B", "BB", "X"), ("C", "Gamma", "Energy"), ("D", "D", "Equity"), ("E", "E", "Equity"),
    ]


def test_default_profiles(spark):
    known = payloads.default_profiles(spark)
    assert known.count() == 13
    assert one(known.filter("symbol = 'V'")).name == "Visa Inc"


def test_symbol_list():
    assert symbol_list(" aapl, ,Msft,") == ["AAPL", "MSFT"]
    assert symbol_list("  ")[:2] == ["AAPL", "MSFT"]
    assert len(symbol_list(None)) == 13


def test_conform_long(spark):
    raw = spark.createDataFrame(
        [("nan", None, "close_price", "day", "2024-01-01", "1.5", "x"), ("A", "NaN", "close_price", "day", "2024-01-02", "bad", "x"),
         ("B", "b", "close_price", "day", "2024-01-03", "NaN", "x")],
        "symbol STRING, name STRING, indicator STRING, timeframe STRING, time_index STRING, value STRING, source STRING",
    )
    got = reshape.conform_long(raw)
    assert got.columns == LONG_SCHEMA.names
    assert [(r.symbol, r.name, r.value) for r in got.orderBy("time_index").collect()] == [
        ("", "", 1.5), ("A", "", None), ("B", "b", None),
    ]


def test_missing_table_reads_as_empty(spark, tmp_path):
    empty = tables.read_or_empty(spark, str(tmp_path / "none"), FACT_SCHEMA)
    assert empty.count() == 0 and empty.columns == FACT_SCHEMA.names


def test_history_window(spark):
    df = spark.createDataFrame([(D(f"{y}-01-01"),) for y in range(1990, 2026)], "time_index DATE")
    years = lambda n: [r[0].year for r in series.in_history(df, D("2024-06-30"), n).orderBy("time_index").collect()]
    assert years(5) == [2020, 2021, 2022, 2023, 2024]
    assert years(1) == [2024]
    assert years(30)[0] == 1995
    with pytest.raises(ValueError):
        years(0)


def test_candles_of_one_date_keep_their_order(spark):
    got = candles(spark, s="ok", t=[7200, 3600, 1e20, 3600], o=[2, 1, 9, 5], h=[2, 3, 9, 1], l=[2, 1, 9, 1], c=[8, 7, 9, 6])
    for parts in (1, 7):
        day = one(bars.candle_bars(got.repartition(parts, "seq")))
        assert (day.open_price, day.high_price, day.low_price, day.close_price) == (1.0, 3.0, 1.0, 8.0)


def test_history_window_reaches_the_scan(spark):
    ticks = tables.order_ticks(spark, "/root/testdata/sf0.001")
    plan = series.in_history(ticks, D("2000-12-31"), 2, "ts")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_written_layer_prunes_partitions_and_pushes_filters(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "if(id % 2 = 0, 'day', 'week') AS timeframe", "date'2024-01-01' AS time_index")
    store.write_served(df, str(tmp_path / "t"), ["id", "time_index"])
    read = spark.read.parquet(str(tmp_path / "t")).filter("timeframe = 'day' AND id = 10")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(timeframe" in plan and "EqualTo(id,10)" in plan
    assert read.count() == 1


def test_shared_folder_is_the_session_setting(spark, tmp_path):
    assert store.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert store.new_folder(spark, "x").startswith(store.shared_folder(spark))


def test_csv_export(spark, tmp_path):
    df = spark.createDataFrame([("A", "day", "linear_trend", 1.0)], "symbol STRING, timeframe STRING, model_name STRING, v DOUBLE")
    store.export_csv(df, str(tmp_path / "csv"))
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "csv")), "symbol") == [("A", "1.0", "linear_trend", "day")]
