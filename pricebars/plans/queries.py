"""One query per operator, over the given tables.

Queries about the gold layer read a warehouse of all orders, which the first of them builds in the shared
folder; the others run straight from the tables.
"""

import math
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebars.functions.periods import to_local
from pricebars.functions.reference_data import CANONICAL_NAMES
from pricebars.operators import (
    backcast, bars, evaluate, features, forecast, layers, live, quality, reshape, serve, series,
)
from pricebars.plans.warehouse import Warehouse, holdout_predictions, load, predict
from pricebars.schema import BAR_KEY, BRONZE_COLUMNS, FACT_COLUMNS, INDICATORS, NOT_NULL, SERIES_KEY, SILVER_COLUMNS
from pricebars.sources import payloads, store, tables
from pricebars.streaming import bars as stream_bars
from pricebars.streaming import tables as stream_tables
from pricebars.streaming import ticks as stream_ticks

AT = datetime(2024, 1, 31)
TODAY = date(2024, 1, 31)
HISTORY_END = date(2001, 8, 1)
SYMBOL = "NATION_7"
CATEGORY = "ASIA"
COMPARE = " nation_3, NATION_11,,nation_20 "

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_WAREHOUSES: dict[tuple, Warehouse] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _long(rows: DataFrame, profiles: DataFrame, source: str) -> DataFrame:
    named = rows.join(profiles.select("symbol", "name"), "symbol", "left")
    return reshape.to_long(named).withColumn("source", F.lit(source)).select(*BRONZE_COLUMNS)


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse of all orders, built on first use and again when the tables have changed."""
    inputs = ["orders", "customer", "nation", "region"]
    key = (spark.sparkContext.applicationId, folder, tables.fingerprint(spark, folder, inputs))
    if key not in _WAREHOUSES or not _WAREHOUSES[key].has("gold/predictions"):
        built = Warehouse(spark, store.new_folder(spark, "warehouse"))
        profiles = tables.nation_profiles(spark, folder)
        source = _long(bars.ohlc_all(tables.order_ticks(spark, folder)), profiles, "orders")
        with built.change() as new:
            load(new, [source], profiles, AT)
            predict(new, AT)
        _WAREHOUSES[key] = built
    return _WAREHOUSES[key]


def _order_bars(spark: SparkSession, folder: str) -> DataFrame:
    return bars.ohlc_all(tables.order_ticks(spark, folder))


def _stored_order_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Bars written once, for queries that read them twice: bars are far smaller than the ticks behind them."""
    return store.materialise(_order_bars(spark, folder), "bars")


def _event_days(spark: SparkSession, folder: str) -> DataFrame:
    return bars.day_bars(tables.event_ticks(spark, folder))


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- sources ----------------------------------------------------------------


@_query
def candle_explode(spark, folder):
    days = bars.day_bars(tables.order_ticks(spark, folder))
    return payloads.explode_candles(payloads.pack_candles(days)).drop("seq")


def _quotes(spark: SparkSession, folder: str) -> DataFrame:
    """Quote payloads of the last event day of each user, with the day before as previous close."""
    days = live.board(_event_days(spark, folder)).select("symbol", "time_index", "previous_close")
    last = _event_days(spark, folder).join(days, ["symbol", "time_index"])
    payload = F.to_json(
        F.struct(
            F.col("close_price").alias("c"), F.col("open_price").alias("o"), F.col("high_price").alias("h"),
            F.col("low_price").alias("l"), F.col("previous_close").alias("pc"),
        )
    )
    names = tables.customer_profiles(spark, folder).select("symbol", "name")
    return last.select("symbol", payload.alias("payload")).join(names, "symbol", "left")


@_query
def quote_snapshot(spark, folder):
    return payloads.quote_snapshot(_quotes(spark, folder), F.lit(TODAY))


@_query
def profile_fallback(spark, folder):
    customer = tables.table(spark, folder, "customer")
    nation = tables.table(spark, folder, "nation")
    rich, known = F.col("c_acctbal") > 0, F.col("c_acctbal") > -500

    def text(condition: Column, value: Column) -> Column:
        return F.when(condition, value).otherwise("")

    payload = F.to_json(
        F.struct(
            text(rich, F.col("c_name")).alias("name"),
            F.when(known, F.concat(F.lit("T"), F.col("c_custkey"))).alias("ticker"),
            F.when(rich, F.col("c_mktsegment")).alias("vendorIndustry"),
            text(known, F.col("n_name")).alias("exchange"),
        )
    )
    landed = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("symbol"), payload.alias("payload")
    )
    symbols = tables.customer_profiles(spark, folder).select("symbol").unionByName(
        tables.table(spark, folder, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey")).alias("symbol"))
    )
    return payloads.resolve_profile(symbols, landed, tables.part_profiles(spark, folder))


@_query
def json_props(spark, folder):
    props = F.from_json("props", "k BIGINT")
    return tables.table(spark, folder, "events").select("event_id", props["k"].alias("k"))


@_query
def conform_long(spark, folder):
    long = _long(_order_bars(spark, folder), tables.nation_profiles(spark, folder), "orders")
    raw = long.withColumns(
        {
            "name": F.when(F.col("timeframe") == "year", F.lit("nan")).otherwise(F.col("name")),
            "time_index": F.col("time_index").cast("string"),
            "value": F.when(F.col("indicator") == "latest_price", F.lit("n/a")).otherwise(F.col("value").cast("string")),
        }
    )
    return reshape.conform_long(raw)


@_query
def history_window(spark, folder):
    ticks = series.in_history(tables.order_ticks(spark, folder), HISTORY_END, 5, "ts")
    return bars.day_bars(ticks)


@_query
def gold_prices_scan(spark, folder):
    return warehouse(spark, folder).prices


@_query
def gold_predictions_scan(spark, folder):
    return warehouse(spark, folder).predictions.drop("run_at")


# --- layers -----------------------------------------------------------------


@_query
def bronze_rows(spark, folder):
    return warehouse(spark, folder).bronze.select(*BRONZE_COLUMNS)


@_query
def silver_rows(spark, folder):
    return warehouse(spark, folder).silver.select(*SILVER_COLUMNS)


@_query
def gold_fact_rows(spark, folder):
    return warehouse(spark, folder).fact.select(*FACT_COLUMNS)


@_query
def dim_symbol(spark, folder):
    ticks, profiles = tables.event_ticks(spark, folder), tables.customer_profiles(spark, folder)
    return layers.build_dim(bars.day_bars(ticks).join(profiles, "symbol"))


# --- bars and shapes --------------------------------------------------------


@_query
def ohlc_day(spark, folder):
    return bars.ohlc(tables.event_ticks(spark, folder), "day")


@_query
def ohlc_week(spark, folder):
    return bars.ohlc(tables.order_ticks(spark, folder), "week")


@_query
def ohlc_month(spark, folder):
    return bars.ohlc(tables.order_ticks(spark, folder), "month")


@_query
def ohlc_year(spark, folder):
    return bars.ohlc(tables.order_ticks(spark, folder), "year")


@_query
def ohlc_all(spark, folder):
    return _order_bars(spark, folder)


@_query
def ohlc_month_parts(spark, folder):
    return _rounded(bars.ohlc(tables.lineitem_ticks(spark, folder), "month"), 4, *INDICATORS)


@_query
def bars_unpivot(spark, folder):
    return reshape.to_long(_order_bars(spark, folder))


def _two_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Bars of all orders, and of the orders by date alone as a second source of the same symbols."""
    profiles = tables.nation_profiles(spark, folder)
    ticks = tables.order_ticks(spark, folder)
    reversed_ticks = ticks.withColumn("seq", -F.col("seq"))
    return reshape.union_sources(
        [
            _long(bars.ohlc_all(ticks), profiles, "orders"),
            _long(bars.ohlc_all(reversed_ticks), profiles, "orders reversed"),
            _long(bars.ohlc_all(tables.event_ticks(spark, folder)), tables.customer_profiles(spark, folder), "events"),
        ]
    )


@_query
def union_sources(spark, folder):
    return _two_sources(spark, folder)


@_query
def bars_pivot(spark, folder):
    return reshape.to_wide(store.materialise(_two_sources(spark, folder), "long"), {"orders reversed": 1})


@_query
def series_long(spark, folder):
    return reshape.to_series_rows(warehouse(spark, folder).prices)


# --- features ---------------------------------------------------------------


@_query
def drop_missing_price(spark, folder):
    """Bars of both tick sources, where a zero price counts as missing."""
    rows = bars.ohlc_all(tables.event_ticks(spark, folder)).withColumn(
        "close_price", F.nullif(F.col("close_price"), F.lit(0.0))
    )
    return features.drop_missing_price(rows.unionByName(_order_bars(spark, folder)))


def canonical_name_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(CANONICAL_NAMES.items()), "symbol STRING, canonical_name STRING")


@_query
def canonical_names(spark, folder):
    """Order bars whose symbols are country codes, one per nation, as far as there are codes."""
    codes = list(CANONICAL_NAMES)
    code = F.element_at(F.array(*[F.lit(c) for c in codes]), F.col("n_nationkey") + 1)
    nation = tables.table(spark, folder, "nation").select(F.col("n_name").alias("name"), code.alias("code"))
    rows = _order_bars(spark, folder).withColumnRenamed("symbol", "name").join(nation, "name")
    half = F.when(F.col("timeframe") == "day", F.col("name")).otherwise(F.col("code"))
    return features.canonical_names(
        rows.select(half.alias("symbol"), "name", "timeframe", "time_index", "close_price"),
        canonical_name_table(spark),
    )


@_query
def category_map(spark, folder):
    """Order bars with a category table that does not know the nations of one region."""
    profiles = tables.nation_profiles(spark, folder)
    known = profiles.filter(F.col("category") != "AFRICA")
    return features.with_category(_order_bars(spark, folder), known).select(*BAR_KEY, "close_price", "category")


@_query
def price_movement(spark, folder):
    return features.price_movement(_order_bars(spark, folder))


@_query
def volatility(spark, folder):
    return features.volatility(_order_bars(spark, folder))


@_query
def category_avg(spark, folder):
    rows = features.with_category(_order_bars(spark, folder), tables.nation_profiles(spark, folder))
    return features.category_average(rows)


@_query
def category_avg_join(spark, folder):
    profiles = tables.nation_profiles(spark, folder).drop("name")
    rows = features.with_category(_stored_order_bars(spark, folder), profiles)
    return features.with_category_average(rows)


@_query
def category_avg_window(spark, folder):
    """The average over (category, timeframe, date) on every bar of the part table's many symbols.

    The roll-up makes four rows of one and holds them by key, so its tasks are kept small; the category is joined there, once.
    """
    rows = bars.ohlc_all(tables.lineitem_ticks(spark, folder))
    with store.small_tasks(spark):
        rows = store.materialise(features.with_category(rows, tables.part_profiles(spark, folder).drop("name")), "bars")
        averages = store.materialise(features.category_average(rows), "averages")
    rows = features.with_category_average(rows, averages)
    return rows.select(*BAR_KEY, "category", "category_avg_close", "category_count")


@_query
def trend_distribution(spark, folder):
    return features.trend_distribution(features.price_movement(_order_bars(spark, folder)))


@_query
def enriched_bars(spark, folder):
    return features.enrich(_stored_order_bars(spark, folder), tables.nation_profiles(spark, folder))


# --- serving ----------------------------------------------------------------


@_query
def list_symbols(spark, folder):
    return serve.list_symbols(warehouse(spark, folder).dim)


@_query
def categories(spark, folder):
    return serve.categories(warehouse(spark, folder).dim)


@_query
def prices_filtered(spark, folder):
    built = warehouse(spark, folder).snapshot()
    return serve.prices_filtered(built.served, built.dim, CATEGORY, "UP", "High")


@_query
def prices_for_symbol(spark, folder):
    built = warehouse(spark, folder)
    return serve.price_history(built.fact, built.dim, SYMBOL.lower())


@_query
def predictions_for_symbol(spark, folder):
    built = warehouse(spark, folder)
    return serve.symbol_predictions(built.prediction_fact, built.dim, SYMBOL, "holt_smoothing").drop("run_at")


@_query
def category_prices(spark, folder):
    built = warehouse(spark, folder).snapshot()
    return serve.category_prices(built.served, built.dim, CATEGORY)


@_query
def model_lookup(spark, folder):
    """The forecasts of one model for all weeks."""
    built = warehouse(spark, folder).snapshot()
    return serve.model_predictions(built.prediction_fact, built.dim, "holt_smoothing", "week").drop("run_at")


@_query
def no_forecasts_yet(spark, folder):
    """The number of forecasts per symbol in a warehouse whose forecasts nobody has written."""
    built = warehouse(spark, folder).snapshot()
    fresh = Warehouse(spark, built.root, {name: path for name, path in built.tables.items() if name != "gold/predictions"})
    counts = fresh.predictions.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    return fresh.dim.select("symbol").join(counts, "symbol", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@_query
def top_n(spark, folder):
    return serve.top_n(warehouse(spark, folder).prices, "intraday_range_pct", 25)


@_query
def compare_symbols(spark, folder):
    built = warehouse(spark, folder)
    return serve.compare(built.fact, built.dim, COMPARE)


@_query
def compare_many(spark, folder):
    """More symbols than anyone compares by hand."""
    built = warehouse(spark, folder)
    return serve.compare(built.fact, built.dim, ",".join(f"nation_{i}" for i in range(22)))


@_query
def default_compare(spark, folder):
    built = warehouse(spark, folder)
    return serve.default_compare(built.fact, built.dim, "week")


@_query
def dashboard_filter(spark, folder):
    built = warehouse(spark, folder).snapshot()
    sectors, low, high = ["ASIA", "EUROPE"], date(1997, 3, 1), date(1999, 6, 30)
    return serve.select_prices(built.fact, built.dim, "month", sectors, low, high, "nation_.?2")


@_query
def search_symbols(spark, folder):
    built = warehouse(spark, folder).snapshot()
    return serve.search(built.fact, built.dim, "week", "nation_1.?$").select(*BAR_KEY, "name", "close_price")


@_query
def search_count(spark, folder):
    built = warehouse(spark, folder).snapshot()
    return serve.search_count(built.fact, built.dim, "week", "nation_1.?$")


@_query
def date_range_filter(spark, folder):
    built = warehouse(spark, folder).snapshot()
    return serve.between_dates(built.fact, built.dim, "day", date(1998, 1, 1), date(1998, 12, 31))


@_query
def date_domain(spark, folder):
    return serve.date_domain(warehouse(spark, folder).fact, "week")


@_query
def latest_snapshot(spark, folder):
    """The last week per symbol, dearest first."""
    latest = warehouse(spark, folder).latest.filter("timeframe = 'week'")
    return latest.orderBy(F.desc_nulls_last("close_price"), "symbol")


@_query
def kpi_summary(spark, folder):
    return serve.kpi(warehouse(spark, folder).latest.filter("timeframe = 'week'"))


@_query
def sector_breakdown(spark, folder):
    return serve.sector_breakdown(warehouse(spark, folder).latest.filter("timeframe = 'week'"))


@_query
def forecast_spread(spark, folder):
    rows = forecast.confidence_spread(warehouse(spark, folder).predictions)
    return _rounded(rows, 4, "spread_pct").select(
        *SERIES_KEY, "model_name", "fit_scope", "predicted_time", "spread_pct"
    )


@_query
def forecast_bridge(spark, folder):
    built = warehouse(spark, folder)
    full = built.prediction_fact.filter(F.col("fit_scope") == "full")
    return serve.forecast_view(built.fact, full, built.dim, SYMBOL, "month", "close_price", "holt_smoothing")


# --- live -------------------------------------------------------------------


@_query
def tick_change(spark, folder):
    return _rounded(live.tick_change(tables.event_ticks(spark, folder)), 4, "tick_change")


@_query
def recent_ticks(spark, folder):
    return live.recent_ticks(tables.event_ticks(spark, folder))


@_query
def recent_ticks_per_symbol(spark, folder):
    return live.recent_ticks_per_symbol(tables.event_ticks(spark, folder), 5)


@_query
def quote_fallback(spark, folder):
    return live.quote_fallback(
        _event_days(spark, folder).withColumn("latest_price", F.nullif(F.col("latest_price"), F.col("high_price")))
    )


@_query
def day_change(spark, folder):
    return _rounded(live.tick_board(tables.event_ticks(spark, folder)), 4, "day_change", "day_change_pct")


@_query
def live_counts(spark, folder):
    return live.live_counts(live.tick_board(tables.event_ticks(spark, folder)))


# --- series, models, evaluation ---------------------------------------------


def _series(spark: SparkSession, folder: str) -> DataFrame:
    return series.to_series(warehouse(spark, folder).prices)


@_query
def series_index(spark, folder):
    return series.series_index(_series(spark, folder))


@_query
def series_counts(spark, folder):
    return series.series_counts(reshape.to_series_rows(warehouse(spark, folder).prices))


@_query
def eligible_series(spark, folder):
    """Bars of events: a month of data makes eligible days and weeks, but no months or years."""
    points = series.to_series(bars.ohlc_all(tables.event_ticks(spark, folder)))
    return series.series_lengths(series.eligible(points))


@_query
def holdout_split(spark, folder):
    return series.split_rows(_series(spark, folder), 3)


@_query
def ols_fit(spark, folder):
    fits = forecast.ols_fit(_series(spark, folder))
    return fits.select(
        *SERIES_KEY, F.col("n").cast("bigint").alias("n"), F.round("beta0", 4).alias("beta0"),
        F.round("beta1", 4).alias("beta1"), F.round(F.sqrt("s2"), 4).alias("residual_sd"),
    )


@_query
def linear_trend_forecast(spark, folder):
    return forecast.linear_trend(_series(spark, folder))


@_query
def forecast_dates(spark, folder):
    return forecast.linear_trend(series.eligible(_series(spark, folder))).select(*SERIES_KEY, "predicted_time")


@_query
def holt_fit(spark, folder):
    fits = forecast.holt_fit(_series(spark, folder))
    return _rounded(fits, 4, "level", "trend", "rmse").select(
        *SERIES_KEY, F.col("n").cast("bigint").alias("n"), "alpha", "beta", "phi", "level", "trend", "rmse"
    )


@_query
def holt_forecast(spark, folder):
    return forecast.holt_smoothing(_series(spark, folder))


@_query
def forecast_all(spark, folder):
    return forecast.forecast(_series(spark, folder))


@_query
def holdout_metrics(spark, folder):
    return evaluate.backtest(_series(spark, folder))[1]


@_query
def backtest_summary(spark, folder):
    return evaluate.backtest_summary(evaluate.backtest(_series(spark, folder))[1])


@_query
def regression_metrics(spark, folder):
    scores = evaluate.backtest(_series(spark, folder), test_size=3)[1]
    pairs = scores.select("model_name", "timeframe", "actual", F.col("predicted_value").alias("predicted"))
    return evaluate.metrics(pairs, ["model_name", "timeframe"])


def _evaluation(spark: SparkSession, folder: str) -> DataFrame:
    built = warehouse(spark, folder)
    held_out = built.predictions.filter(F.col("fit_scope") == "holdout")
    return evaluate.evaluate(held_out, reshape.to_series_rows(built.prices))


@_query
def evaluate_models(spark, folder):
    return _evaluation(spark, folder)


@_query
def model_report(spark, folder):
    return evaluate.model_report(_evaluation(spark, folder))


@_query
def run_metrics(spark, folder):
    points, predictions = _series(spark, folder), holdout_predictions(warehouse(spark, folder))
    return evaluate.run_metrics(points, predictions, evaluate.score(predictions, points))


@_query
def symbols_without_history(spark, folder):
    return backcast.symbols_without_history(
        tables.customer_profiles(spark, folder), _event_days(spark, folder)
    )


@_query
def backcast_history(spark, folder):
    quotes = payloads.quote_snapshot(_quotes(spark, folder), F.lit(TODAY))
    return _rounded(backcast.backcast(quotes, TODAY), 4, *INDICATORS)


# --- constraints ------------------------------------------------------------


@_query
def dq_dim_unique(spark, folder):
    """Part names as if they were symbols: names repeat."""
    return quality.violations_unique(tables.table(spark, folder, "part"), ["p_name"])


@_query
def dq_fact_unique(spark, folder):
    """Order lines by the key they should be unique on."""
    return quality.violations_unique(tables.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@_query
def dq_fk_orphans(spark, folder):
    """Order lines whose part number is no customer number."""
    return quality.violations_fk(
        tables.table(spark, folder, "lineitem"), tables.table(spark, folder, "customer"), "l_partkey", "c_custkey"
    )


def _last_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The last tenth of the order lines by order number, as a load that has just been added."""
    lines = tables.table(spark, folder, "lineitem")
    first = quality.quantile(lines, "l_orderkey", 0.9)
    return lines.filter(F.col("l_orderkey") >= F.lit(None if first is None else math.floor(first)))


@_query
def dq_lengths(spark, folder):
    """Texts longer than a column of the warehouse would hold."""
    customer = tables.table(spark, folder, "customer")
    return quality.violations_length(customer, {"c_name": 10, "c_mktsegment": 9})


@_query
def first_lines(spark, folder):
    """One line per order, the cheapest by unit price, with the key columns first."""
    lines = tables.lineitem_ticks(spark, folder).select(
        F.col("seq.l_orderkey").alias("order"), "symbol", F.lit("day").alias("timeframe"), F.col("ts").alias("time_index"),
        "price", F.col("seq.l_linenumber").alias("line"), F.col("seq.l_quantity").alias("quantity"),
    )
    return reshape.order_columns(reshape.dedupe(lines, ["order"], ["price", "symbol", "time_index", "line", "quantity"]))


@_query
def dq_load_unique(spark, folder):
    """Supplier and part pairs that the last order lines repeat, counted in all lines."""
    lines = tables.table(spark, folder, "lineitem")
    return quality.violations_unique(lines, ["l_partkey", "l_suppkey"], _last_orders(spark, folder))


@_query
def dq_load_orphans(spark, folder):
    """Part numbers of the last order lines that are no customer numbers."""
    lines, customer = tables.table(spark, folder, "lineitem"), tables.table(spark, folder, "customer")
    return quality.violations_fk(lines, customer, "l_partkey", "c_custkey", _last_orders(spark, folder))


@_query
def ohlc_hour_ties(spark, folder):
    """Day bars of events whose times are known to the hour, so that the event number orders those of one hour."""
    ticks = tables.table(spark, folder, "events").select(
        F.col("event_type").alias("symbol"), F.date_trunc("hour", "ts").alias("ts"), F.col("event_id").alias("seq"),
        F.col("value").alias("price"),
    )
    return bars.day_bars(ticks)


@_query
def dq_nulls(spark, folder):
    built = warehouse(spark, folder)
    checks = {
        "bronze": built.bronze, "silver": built.silver, "dim": built.dim, "fact": built.fact,
        "predictions": built.prediction_fact,
    }
    required = [
        quality.violations_null(df, NOT_NULL[name]).select(F.lit(name).alias("layer"), "column_name", "n_null")
        for name, df in checks.items()
    ]
    optional = quality.violations_null(built.fact, ["price_change", "price_change_pct"]).select(
        F.lit("fact optional").alias("layer"), "column_name", "n_null"
    )
    return reshape.union_sources([*required, optional])


@_query
def dq_warehouse(spark, folder):
    """All keys of the built warehouse with violations put in: a symbol twice, a symbol's years twice, and another's
    years and forecasts under an id that the dimension doesn't have."""
    built = warehouse(spark, folder)
    years, forecasts = built.fact.filter("timeframe = 'year'"), built.prediction_fact
    unknown = F.lit(-1).cast("bigint")
    dim = built.dim.unionByName(built.dim.filter(F.col("symbol") == SYMBOL))
    fact = (
        built.fact.unionByName(years.filter("id = 1")).unionByName(years.filter("id = 2").withColumn("id", unknown))
    )
    forecasts = forecasts.unionByName(forecasts.filter("id = 2 AND timeframe = 'year'").withColumn("id", unknown))
    return quality.all_violations(
        {
            "dim symbol": quality.violations_unique(dim, ["symbol"]),
            "fact key": quality.violations_unique(fact, ["id", "timeframe", "time_index"]),
            "prediction key": quality.violations_unique(
                forecasts, ["fit_scope", "id", "timeframe", "indicator", "model_name", "predicted_time"]
            ),
            "fact id": quality.violations_fk(fact, dim.distinct(), "id"),
            "prediction id": quality.violations_fk(forecasts, dim.distinct(), "id"),
        }
    )


@_query
def cleaning_counts(spark, folder):
    """Rows before and after each cleaning step of the warehouse job."""
    return warehouse(spark, folder).counts.select("step", "rows")


@_query
def csv_export(spark, folder):
    """The hold-out forecasts as exported, read back from the CSV files."""
    out = store.new_folder(spark, "export")
    store.export_csv(holdout_predictions(warehouse(spark, folder)), out)
    schema = (
        "symbol STRING, indicator STRING, predicted_time DATE, predicted_value DOUBLE, confidence_low DOUBLE, "
        "confidence_high DOUBLE, model_name STRING, timeframe STRING"
    )
    return spark.read.schema(schema).option("header", True).csv(out)


@_query
def live_quote(spark, folder):
    quotes = payloads.quote_snapshot(_quotes(spark, folder), F.lit(TODAY))
    return serve.live_quote(quotes, "7")


@_query
def legacy_names(spark, folder):
    """Bars under the column names of an older layer, without a category."""
    old = _order_bars(spark, folder).withColumnsRenamed({"symbol": "country_code"})
    old = old.withColumns({"country_code": F.lower("country_code"), "commodity_name": F.col("country_code")})
    return reshape.normalise(old, layers.RENAMES)


@_query
def nan_prices(spark, folder):
    """Ticks whose zero prices have become NaN, as NULL."""
    ticks = tables.event_ticks(spark, folder)
    return reshape.nan_to_null(ticks.withColumn("price", F.when(F.col("price") == 0, float("nan")).otherwise(F.col("price"))))


@_query
def local_ticks(spark, folder):
    return tables.event_ticks(spark, folder).withColumn("ts", to_local(F.col("ts"), "America/New_York"))


@_query
def bars_without_prices(spark, folder):
    """Features of bars that lack the prices they need."""
    keys = _order_bars(spark, folder).select(*BAR_KEY, "open_price")
    return features.volatility(features.price_movement(keys))


# --- streams ----------------------------------------------------------------


def _stream(spark: SparkSession, folder: str) -> DataFrame:
    return stream_ticks.tick_stream(spark, folder, "events.parquet")


def _kept_bars(spark: SparkSession, rows: DataFrame) -> DataFrame:
    out = store.new_folder(spark, "stream")
    stream_bars.keep_bars(rows, out, f"{out}/checkpoint").awaitTermination()
    return stream_bars.current_bars(spark, out)


@_query
def stream_day_bars(spark, folder):
    return _kept_bars(spark, stream_bars.stream_bars(_stream(spark, folder), "day"))


@_query
def stream_week_bars(spark, folder):
    return _kept_bars(spark, stream_bars.stream_bars(_stream(spark, folder), "week"))


def _landings(spark: SparkSession, folder: str, parts: list[Column], keep: Callable) -> str:
    """All events as the files of one landing after the other, each read by a micro-batch of its own."""
    events, out = tables.table(spark, folder, "events"), store.new_folder(spark, "stream")
    for i, part in enumerate(parts):
        events.filter(part).write.parquet(f"{out}/landing/part{i}")
        ticks = stream_ticks.tick_stream(spark, f"{out}/landing/*")
        keep(ticks, out, f"{out}/checkpoint").awaitTermination()
    return out


@_query
def stream_rollup(spark, folder):
    """Month and year bars of all events, which land in three parts in the order of their times."""
    ts = F.col("ts")
    cuts = tables.table(spark, folder, "events").agg(F.percentile_approx(ts.cast("timestamp"), [1 / 3, 2 / 3]).alias("c")).select(
        F.transform("c", lambda t: t.cast("timestamp_ntz").cast("string")).alias("c")
    ).first().c
    low, high = (F.lit(c).cast("timestamp_ntz") for c in cuts or ["1970-01-01"] * 2)
    parts = [ts < low, (ts >= low) & (ts < high), (ts >= high) | ts.isNull()]
    out = _landings(spark, folder, parts, stream_bars.keep_rollup)
    return stream_bars.current_bars(spark, out).filter(F.col("timeframe").isin("month", "year"))


@_query
def stream_closed(spark, folder):
    """Day bars whose window the watermark has closed, each once."""
    out = store.new_folder(spark, "stream")
    ticks = _stream(spark, folder)
    stream_bars.closed_bars(ticks, f"{out}/bars", f"{out}/checkpoint").awaitTermination()
    return spark.read.schema(stream_bars.BAR_SCHEMA).parquet(f"{out}/bars")


@_query
def stream_late(spark, folder):
    """The events that are late when all land in four parts, by the remainder of their number."""
    out = _landings(spark, folder, [F.pmod("event_id", F.lit(4)) == i for i in range(4)], stream_ticks.keep_late)
    return stream_ticks.late_ticks(spark, out)


@_query
def stream_board(spark, folder):
    out = store.new_folder(spark, "stream")
    stream_bars.keep_board(_stream(spark, folder), out, f"{out}/checkpoint").awaitTermination()
    return _rounded(stream_bars.current_board(spark, out), 4, "day_change", "day_change_pct")


@_query
def stream_tick_change(spark, folder):
    out = store.new_folder(spark, "stream")
    stream_ticks.stream_tick_change(_stream(spark, folder), out, f"{out}/checkpoint").awaitTermination()
    changes = stream_tables.all_batches(spark, f"{out}/changes", stream_ticks.CHANGE_SCHEMA).drop("batch")
    return _rounded(changes, 4, "tick_change")


@_query
def stream_distinct(spark, folder):
    """Every event landed twice; each is counted once."""
    out = store.new_folder(spark, "stream")
    ticks = _stream(spark, folder)
    query = (
        stream_ticks.distinct_ticks(ticks.unionByName(_stream(spark, folder)))
        .writeStream.format("parquet").option("path", f"{out}/ticks")
        .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{out}/ticks")
