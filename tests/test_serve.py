import pytest
from helpers import D, TS, one, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricebars.functions.periods import to_local
from pricebars.operators import live, serve
from pricebars.schema import DIM_SCHEMA, FACT_COLUMNS, PREDICTION_SCHEMA, struct

FACT = [
    # id, timeframe, date, open, high, low, close, latest, change, pct, trend, range, range pct, level, avg, count
    (1, "day", D("2024-01-01"), 1.0, 1.0, 1.0, 10.0, 10.0, None, None, "new", 1.0, 10.0, "high", 1.0, 1),
    (1, "day", D("2024-01-02"), 1.0, 1.0, 1.0, 12.0, 12.0, 2.0, 20.0, "up", 0.0, 0.0, "low", 1.0, 1),
    (2, "day", D("2024-01-01"), 1.0, 1.0, 1.0, 30.0, 30.0, None, None, "new", 1.0, 5.0, "medium", 1.0, 1),
    (2, "day", D("2024-01-02"), 1.0, 1.0, 1.0, 12.0, 12.0, -18.0, -60.0, "down", 4.0, 33.0, "high", 1.0, 1),
    (3, "week", D("2024-01-01"), 1.0, 1.0, 1.0, 5.0, 5.0, None, None, "new", None, None, None, 1.0, 1),
]


@pytest.fixture(scope="module")
def gold(spark):
    fact = spark.createDataFrame(FACT, struct(FACT_COLUMNS))
    dim = spark.createDataFrame([(1, "AAA", "Alpha", "X"), (2, "BBB", "a.c corp", "X"), (3, "CCC", None, "Y")], DIM_SCHEMA)
    return fact, dim


@pytest.fixture(scope="module")
def prices(gold):
    return serve.prices(*gold)


def keys(df):
    return [(r.symbol, str(r.time_index)) for r in df.collect()]


def test_filters(gold):
    assert serve.prices_filtered(*gold).count() == 5
    assert keys(serve.prices_filtered(*gold, "X", "UP")) == [("AAA", "2024-01-02")]
    assert keys(serve.prices_filtered(*gold, volatility="High")) == [("BBB", "2024-01-02"), ("AAA", "2024-01-01")]
    assert serve.prices_filtered(*gold, "x").count() == 0


def test_symbol_lookup(gold, prices):
    assert keys(serve.price_history(*gold, "aaa")) == [("AAA", "2024-01-02"), ("AAA", "2024-01-01")]
    assert serve.price_history(*gold, "nope").count() == 0
    assert keys(serve.compare(*gold, " ccc,aaa,,")) == [("AAA", "2024-01-02"), ("AAA", "2024-01-01"), ("CCC", "2024-01-01")]
    with pytest.raises(ValueError):
        serve.compare(*gold, " , ")
    many = ",".join(["aaa", "ccc", *[f"x{i}" for i in range(20)]])
    assert serve.compare(*gold, many).count() == 3
    assert {(r.symbol, r.timeframe) for r in serve.default_compare(*gold, "day", 2).collect()} == {("AAA", "day"), ("BBB", "day")}


def test_top_n(prices):
    assert [r.close_price for r in serve.top_n(prices, n=2).collect()] == [30.0, 12.0]
    assert keys(serve.top_n(prices, n=3))[1:] == [("AAA", "2024-01-02"), ("BBB", "2024-01-02")]
    assert [r.price_change_pct for r in serve.top_n(prices, "price_change_pct", 99, "ASC").collect()] == [-60.0, 20.0]
    assert serve.top_n(prices, "intraday_range", 99).count() == 4
    assert [r.close_price for r in serve.top_n(prices, n=9, latest="day").collect()] == [12.0, 12.0]
    with pytest.raises(ValueError):
        serve.top_n(prices, "symbol")


def test_search(gold):
    symbols = lambda df: {r.symbol for r in df.collect()}
    assert symbols(serve.search(*gold, "day", "A.C")) == {"BBB"}
    assert symbols(serve.search(*gold, "day", "a.c", regex=False)) == {"BBB"}
    assert symbols(serve.search(*gold, "day", "al.ha")) == {"AAA"}
    assert symbols(serve.search(*gold, "day", "al.ha", regex=False)) == set()
    assert one(serve.search_count(*gold, "day", "^(a|c)")).n_symbols == 2


def test_dates(gold, prices):
    assert serve.between_dates(*gold, "day", D("2024-01-01"), D("2024-01-01")).count() == 2
    assert tuple(one(serve.date_domain(prices, "day"))) == (D("2024-01-01"), D("2024-01-02"))
    assert tuple(one(serve.date_domain(prices, "week"))) == (D("2024-01-01"), D("2024-01-02"))


def test_latest_kpi_and_sectors(prices):
    latest = serve.latest_snapshot(prices, "day")
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "rangepartitioning" not in plan
    assert sorted(keys(latest)) == [("AAA", "2024-01-02"), ("BBB", "2024-01-02")]
    assert tuple(one(serve.kpi(latest))) == (12.0, -20.0, 1, 1, 1, 2)
    assert rows(serve.sector_breakdown(latest), "category") == [("X", 2)]


def test_live_quote(spark):
    df = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "symbol STRING, latest_price DOUBLE")
    assert one(serve.live_quote(df, "b")).latest_price == 2.0


def test_lists(gold):
    assert [r.symbol for r in serve.list_symbols(gold[1]).collect()] == ["AAA", "BBB", "CCC"]
    assert [r.category for r in serve.categories(gold[1]).collect()] == ["X", "Y"]
    assert serve.category_prices(*gold, "X").count() == 4


def test_predictions_and_forecast_view(spark, gold, prices):
    from decimal import Decimal

    preds = spark.createDataFrame(
        [
            (1, "day", "close_price", m, D("2024-01-03"), Decimal(14), Decimal(13), Decimal(16), "full", TS("2024-01-03T00:00:00"))
            for m in ("linear_trend", "holt_smoothing")
        ],
        PREDICTION_SCHEMA,
    )
    assert serve.symbol_predictions(preds, gold[1], "aaa").count() == 2
    assert one(serve.symbol_predictions(preds, gold[1], "aaa", "linear_trend")).predicted_value == 14.0
    fact, dim = gold
    view = serve.forecast_view(fact, preds, dim, "AAA", "day", "close_price", "linear_trend")
    assert rows(view, "time", "part") == [
        ("history", D("2024-01-01"), 10.0, None, None, None),
        ("bridge", D("2024-01-02"), 12.0, 12.0, 12.0, 0.0),
        ("history", D("2024-01-02"), 12.0, None, None, None),
        ("forecast", D("2024-01-03"), 14.0, 13.0, 16.0, 21.4286),
    ]
    assert serve.forecast_view(fact, preds, dim, "BBB", "day", "close_price", "linear_trend").count() == 2
    assert serve.forecast_view(fact, preds, dim, "ZZZ", "day", "close_price", "linear_trend").count() == 0


def test_lookup_pushes_the_id_to_the_scan(spark, gold, tmp_path):
    fact, dim = gold
    fact.write.parquet(str(tmp_path / "fact"))
    dim.write.parquet(str(tmp_path / "dim"))
    stored = spark.read.parquet(str(tmp_path / "fact")), spark.read.parquet(str(tmp_path / "dim"))
    plan = serve.price_history(*stored, "aaa")._jdf.queryExecution().executedPlan().toString()
    assert "In(id, [1])" in plan or "EqualTo(id,1)" in plan
    plan = serve.compare(*stored, "aaa,bbb")._jdf.queryExecution().executedPlan().toString()
    assert "In(id, [1,2])" in plan


def scanned(df):
    """Rows that the scans of a plan have brought up, after files and row groups were skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    todo, total = [plan], 0
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "FileSourceScanExec":
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_look_ups_read_few_row_groups(spark, tmp_path):
    """By id, category, model and date, of files with small row groups."""
    from pricebars.sources import store

    n, per = 400, 25
    rows_ = spark.range(n).withColumnRenamed("id", "row")
    row = F.col("row")
    fact = rows_.select(
        (row % 100 + 1).alias("id"), F.lit("day").alias("timeframe"), F.date_add(F.lit(D("2024-01-01")), (row / 100).cast("int")).alias("time_index"),
        *[row.cast("double").alias(c) for c in FACT_COLUMNS if c in ("open_price", "high_price", "low_price", "close_price", "latest_price")],
    )
    for c in FACT_COLUMNS:
        if c not in fact.columns:
            fact = fact.withColumn(c, F.lit(None).cast(struct([c])[0].dataType))
    dim = spark.createDataFrame([(i, f"S{i:03d}", f"name {i}", f"C{i % 10}") for i in range(1, 101)], DIM_SCHEMA)
    path = str(tmp_path / "fact")
    settings = {"parquet.block.row.count.limit": str(per), "parquet.block.size.row.check.min": "1"}
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for k, v in settings.items():
        conf.set(k, v)
    try:
        store.write_served(fact.join(dim.select("id", "category"), "id"), path, ["category", "id", "time_index"], ("id",))
    finally:
        for k in settings:
            conf.unset(k)
    stored = spark.read.parquet(path)
    assert scanned(stored) == n
    category = serve.category_prices(stored, dim, "C3")
    assert category.count() == 40 and scanned(category) <= 40 + 2 * per
    one_symbol = serve.price_history(stored, dim, "s042")
    assert one_symbol.count() == 4 and scanned(one_symbol) <= 2 * per
    few = serve.search(stored, dim, "day", "name 4[23]$")
    assert few.count() == 8 and scanned(few) <= 4 * per
    pushed = serve.between_dates(stored, dim, "day", D("2024-01-02"), D("2024-01-03"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(time_index,2024-01-02)" in pushed


def test_many_ids_are_narrowed_by_their_range(spark, gold, monkeypatch):
    fact, dim = gold
    monkeypatch.setattr(serve, "LISTED", 1)
    got = serve.search(fact, dim, "day", "a")
    assert sorted(keys(got)) == sorted(keys(serve.prices(fact, dim).filter("timeframe = 'day'")))
    assert serve.search(fact, dim, "day", "zzz").count() == 0


def test_local_time(spark):
    df = spark.createDataFrame([(TS("2024-01-01T20:00:00"),)], "t TIMESTAMP")
    assert one(df.select(to_local(F.col("t"), "Asia/Phnom_Penh").alias("t"))).t == TS("2024-01-02T03:00:00")


TICKS = "symbol STRING, ts TIMESTAMP, price DOUBLE"


def ticks(spark, *data):
    return spark.createDataFrame([(s, TS(f"2024-01-01T{t}"), p) for s, t, p in data], TICKS)


def test_tick_change(spark):
    df = ticks(
        spark, ("A", "10:00:00", 1.0), ("A", "10:00:30", 3.0), ("A", "11:59:59", 2.0), ("B", "10:00:00", 5.0),
        ("A", "12:00:00", 2.0), ("C", "10:00:00", None), ("A", "10:00:10", float("nan")),
    )
    assert [(r.symbol, r.tick_change, r.tick_status) for r in live.tick_change(df).orderBy("symbol", "ts").collect()] == [
        ("A", 0.0, "flat"), ("A", 2.0, "up"), ("A", -1.0, "down"), ("A", 0.0, "flat"), ("B", 0.0, "flat"),
    ]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_splitting_by_time_changes_nothing(spark, kind, monkeypatch):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), F.col("id") % 50)).alias("symbol"),
        F.timestamp_seconds(F.col("id") * 7).alias("ts"), F.col("id").alias("seq"),
        F.round(F.rand(3) * 100, 2).alias("price"),
    )
    stored = spark.createDataFrame(df.collect(), df.schema).withColumn("ts", F.col("ts").cast(kind))
    monkeypatch.setattr(live, "SLOT", 100)
    got = live.tick_change(stored)
    before = F.lag("price").over(Window.partitionBy("symbol").orderBy("ts", "seq"))
    want = stored.withColumn("tick_change", F.coalesce(F.col("price") - before, F.lit(0.0)))
    assert rows(got.drop("tick_status"), "symbol", "ts", "seq") == rows(want, "symbol", "ts", "seq")
    assert got.count() == 5000


def test_recent_ticks(spark):
    df = ticks(spark, ("A", "10:00:00", 1.0), ("A", "10:00:30", 3.0), ("B", "10:00:10", 5.0))
    assert [r.price for r in live.recent_ticks(df, 2).collect()] == [3.0, 5.0]
    plan = live.recent_ticks_per_symbol(df, 1)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert rows(live.recent_ticks_per_symbol(df, 1).select("symbol", "price"), "symbol") == [("A", 3.0), ("B", 5.0)]


def test_quote_fallback_and_day_change(spark):
    schema = "symbol STRING, open_price DOUBLE, high_price DOUBLE, low_price DOUBLE, close_price DOUBLE, latest_price DOUBLE"
    df = spark.createDataFrame(
        [("A", 1.0, 2.0, 0.5, 4.0, 5.0), ("B", None, 2.0, 0.5, 4.0, 0.0), ("C", 1.0, None, None, None, None), ("D", 1.0, 1.0, 1.0, 0.0, 3.0)],
        schema,
    )
    quotes = live.quote_fallback(df)
    assert rows(quotes.select("symbol", "live_price", "open", "high", "previous_close"), "symbol") == [
        ("A", 5.0, 1.0, 2.0, 4.0), ("B", 4.0, 0.0, 2.0, 4.0), ("C", 0.0, 1.0, 0.0, 0.0), ("D", 3.0, 1.0, 1.0, 0.0),
    ]
    changed = live.day_change(quotes)
    assert rows(changed.select("symbol", "day_change", "day_change_pct", "direction"), "symbol") == [
        ("A", 1.0, 25.0, "up"), ("B", 0.0, 0.0, "flat"), ("C", 0.0, 0.0, "flat"), ("D", 0.0, 0.0, "flat"),
    ]
    assert tuple(one(live.live_counts(changed))) == (4, 1, 0, 3)


def test_selection_composes_and_never_mixes_timeframes(gold):
    assert {r.timeframe for r in serve.select_prices(*gold, "day").collect()} == {"day"}
    got = serve.select_prices(*gold, "day", ["X"], D("2024-01-02"), D("2024-01-02"), "alpha")
    assert keys(got) == [("AAA", "2024-01-02")]
