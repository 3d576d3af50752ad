"""The questions users ask of the gold layer.  Every answer is a DataFrame over the Parquet tables."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebars.functions.numeric import divide, exact_mean
from pricebars.functions.text import matches, symbol_list
from pricebars.schema import FEATURES, INDICATORS, RANKABLE

LABELS = ["symbol", "name", "category"]
SUMMARY = [*LABELS, "timeframe", "time_index", "close_price", "price_change_pct", "price_trend", "volatility_level"]


def prices(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Fact with its symbol, name and category.  Catalyst broadcasts the dimension when it is small."""
    return fact.drop("category").join(dim, "id").select(*LABELS, "timeframe", "time_index", *INDICATORS, *FEATURES)


def predictions(preds: DataFrame, dim: DataFrame) -> DataFrame:
    values = [F.col(c).cast("double").alias(c) for c in ("predicted_value", "confidence_low", "confidence_high")]
    return preds.join(dim, "id").select(
        *LABELS, "timeframe", "indicator", "model_name", "predicted_time", *values, "fit_scope", "run_at"
    )


#: Up to so many ids are pushed down one by one; more as their range.
LISTED = 1_000


def narrowed(table: DataFrame, dim: DataFrame) -> DataFrame:
    """Rows of ``table`` for the rows of ``dim``, which has been filtered by whatever it knows.

    The dimension answers first, with a list of ids or, for many, their number and ends; so the scan gets a filter that skips
    files and row groups, instead of the whole history being joined before the dimension's filter tells.  Beyond
    ``LISTED`` ids the join does the rest, where Spark adds a Bloom filter of the ids to the scan when that pays.
    """
    ids = dim.select("id").limit(LISTED + 1).collect()
    if len(ids) <= LISTED:
        return table.filter(F.col("id").isin(sorted(r.id for r in ids)))
    low, high = dim.agg(F.min("id"), F.max("id")).first()
    return table.filter(F.col("id").between(low, high)).join(dim.select("id"), "id", "left_semi")


def only_symbols(table: DataFrame, dim: DataFrame, symbols: list[str]) -> DataFrame:
    """Rows of the named symbols, however many."""
    return narrowed(table, dim.filter(F.col("symbol").isin(symbols)))


def live_quote(snapshots: DataFrame, symbol: str) -> DataFrame:
    """The quote of one symbol as one wide row."""
    return snapshots.filter(F.col("symbol") == symbol.upper())


def list_symbols(dim: DataFrame) -> DataFrame:
    return dim.select("id", *LABELS).orderBy("symbol")


def categories(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("category").isNotNull()).select("category").distinct().orderBy("category")


def prices_filtered(
    fact: DataFrame, dim: DataFrame, category: str | None = None, trend: str | None = None, volatility: str | None = None
) -> DataFrame:
    out = prices(*_of_category(fact, dim, category)) if category else prices(fact, dim)
    if trend:
        out = out.filter(F.col("price_trend") == trend.lower())
    if volatility:
        out = out.filter(F.col("volatility_level") == volatility.lower())
    return out.orderBy(F.desc("time_index"), "symbol", "timeframe")


def _of_category(fact: DataFrame, dim: DataFrame, category: str) -> tuple[DataFrame, DataFrame]:
    """Fact and dimension of one category.  Files of a fact that holds the category are in its order, and the others skipped."""
    wanted = F.col("category") == category
    if "category" in fact.columns:
        return fact.filter(wanted), dim.filter(wanted)
    return narrowed(fact, dim.filter(wanted)), dim.filter(wanted)


def price_history(fact: DataFrame, dim: DataFrame, symbol: str) -> DataFrame:
    return prices(only_symbols(fact, dim, [symbol.upper()]), dim).orderBy(F.desc("time_index"), "timeframe")


def symbol_predictions(preds: DataFrame, dim: DataFrame, symbol: str, model: str | None = None) -> DataFrame:
    rows = predictions(only_symbols(preds, dim, [symbol.upper()]), dim)
    if model:
        rows = rows.filter(F.col("model_name") == model)
    return rows.orderBy("indicator", "model_name", "timeframe", "predicted_time")


def category_prices(fact: DataFrame, dim: DataFrame, category: str) -> DataFrame:
    """The whole history of a category."""
    return prices(*_of_category(fact, dim, category)).select(*SUMMARY).orderBy(F.desc("time_index"), "symbol", "timeframe")


def model_predictions(preds: DataFrame, dim: DataFrame, model: str, timeframe: str) -> DataFrame:
    """All forecasts of a model for one timeframe; the files are in the order of the models."""
    return predictions(preds.filter((F.col("timeframe") == timeframe) & (F.col("model_name") == model)), dim)


def top_n(
    prices: DataFrame, indicator: str = "close_price", n: int = 10, order: str = "desc", latest: str | None = None
) -> DataFrame:
    """The n best rows by a metric; ties go by symbol, timeframe and date.

    ``latest`` names a timeframe of which only the last bars count.  Each task keeps its own n best, so only those reach the final merge.
    """
    if indicator not in RANKABLE:
        raise ValueError(f"indicator must be one of {sorted(RANKABLE)}")
    rows = latest_snapshot(prices, latest) if latest else prices
    by = F.col(indicator).asc_nulls_last() if order.lower() == "asc" else F.col(indicator).desc_nulls_last()
    columns = SUMMARY if indicator in SUMMARY else [*SUMMARY, indicator]
    return (
        rows.filter(F.col(indicator).isNotNull()).select(*columns)
        .orderBy(by, "symbol", "timeframe", "time_index").limit(n)
    )


def compare(fact: DataFrame, dim: DataFrame, symbols: str) -> DataFrame:
    names = symbol_list(symbols) if symbols.strip() else []
    if not names:
        raise ValueError("give at least one symbol")
    return (
        prices(only_symbols(fact, dim, names), dim).select(*SUMMARY)
        .orderBy("symbol", F.desc("time_index"), "timeframe")
    )


def default_compare(fact: DataFrame, dim: DataFrame, timeframe: str, n: int = 4) -> DataFrame:
    """Rows of the first n symbols by name, which the dimension alone tells."""
    first = [r.symbol for r in dim.select("symbol").orderBy("symbol").limit(n).collect()]
    return prices(only_symbols(fact.filter(F.col("timeframe") == timeframe), dim, first), dim)


def search(fact: DataFrame, dim: DataFrame, timeframe: str, text: str, regex: bool = True) -> DataFrame:
    return select_prices(fact, dim, timeframe, text=text, regex=regex)


def search_count(fact: DataFrame, dim: DataFrame, timeframe: str, text: str, regex: bool = True) -> DataFrame:
    found = search(fact, dim, timeframe, text, regex)
    return found.agg(F.countDistinct("symbol").alias("n_symbols"))


def between_dates(fact: DataFrame, dim: DataFrame, timeframe: str, low: date, high: date) -> DataFrame:
    return select_prices(fact, dim, timeframe, low=low, high=high)


def select_prices(
    fact: DataFrame, dim: DataFrame, timeframe: str, sectors: list[str] | None = None, low: date | None = None,
    high: date | None = None, text: str | None = None, regex: bool = True,
) -> DataFrame:
    """Bars of one timeframe, then of some sectors, dates and names: what every other answer starts from.

    Bars of different timeframes have changes and ranges of different size, so no answer mixes them.  Sectors and names are
    looked up in the dimension, whose ids then narrow the scan of the fact.
    """
    out, known = fact.filter(F.col("timeframe") == timeframe), dim
    if sectors:
        known = known.filter(F.col("category").isin(sectors))
    if text:
        known = known.filter(matches(F.col("symbol"), text, regex) | matches(F.col("name"), text, regex))
    if low is not None:
        out = out.filter(F.col("time_index") >= F.lit(low))
    if high is not None:
        out = out.filter(F.col("time_index") <= F.lit(high))
    return prices(narrowed(out, known) if sectors or text else out, known)


def date_domain(prices: DataFrame, timeframe: str) -> DataFrame:
    """First and last date of a timeframe; a single date is stretched by a day."""
    ends = prices.filter(F.col("timeframe") == timeframe).agg(
        F.min("time_index").alias("min_date"), F.max("time_index").alias("max_date")
    )
    single = F.col("min_date") == F.col("max_date")
    return ends.withColumn("max_date", F.when(single, F.date_add("max_date", 1)).otherwise(F.col("max_date")))


def latest_snapshot(prices: DataFrame, timeframe: str) -> DataFrame:
    """The last bar per symbol of a timeframe.

    The last dates come from a hash aggregation, one row per symbol and split, and pick their bars in a join.
    """
    rows = prices.filter(F.col("timeframe") == timeframe)
    last = rows.groupBy("symbol").agg(F.max("time_index").alias("time_index"))
    return rows.join(last, ["symbol", "time_index"]).select(*prices.columns)


def latest_rows(fact: DataFrame) -> DataFrame:
    """The last fact row of every symbol and timeframe: what a load keeps, so that answers need not read the history."""
    last = fact.groupBy("id", "timeframe").agg(F.max("time_index").alias("time_index"))
    return fact.join(last, ["id", "timeframe", "time_index"], "left_semi")


def kpi(latest: DataFrame) -> DataFrame:
    """Means and counts over a snapshot; the means don't depend on the order of the rows."""
    pct = F.col("price_change_pct")
    return latest.agg(
        F.round(exact_mean(F.col("close_price")), 4).alias("avg_close"),
        F.round(exact_mean(pct), 4).alias("avg_change_pct"),
        F.count_if(pct > 0).alias("n_rising"),
        F.count_if(pct < 0).alias("n_falling"),
        F.count_if(F.col("volatility_level") == "high").alias("n_high_volatility"),
        F.count(F.lit(1)).alias("n_symbols"),
    )


def sector_breakdown(latest: DataFrame) -> DataFrame:
    return latest.groupBy("category").agg(F.count("symbol").alias("n_symbols"))


def forecast_view(
    fact: DataFrame, preds: DataFrame, dim: DataFrame, symbol: str, timeframe: str, indicator: str, model: str
) -> DataFrame:
    """History, a zero-width bridge at its last point, and the forecast, as one table with ``part``.

    Without any forecast rows there is nothing to bridge to, and only the history is returned.
    """
    history = only_symbols(fact.filter(F.col("timeframe") == timeframe), dim, [symbol.upper()]).select(
        F.col("time_index").alias("time"), F.col(indicator).alias("value")
    )
    wanted = preds.filter(
        (F.col("timeframe") == timeframe) & (F.col("indicator") == indicator) & (F.col("model_name") == model)
    )
    values = {"value": "predicted_value", "confidence_low": "confidence_low", "confidence_high": "confidence_high"}
    ahead = only_symbols(wanted, dim, [symbol.upper()]).select(
        F.lit("forecast").alias("part"), F.col("predicted_time").alias("time"),
        *[F.col(column).cast("double").alias(name) for name, column in values.items()],
    )
    last = history.agg(F.max(F.struct("time", "value")).alias("p")).filter(F.col("p").isNotNull())
    bridge = last.select(
        F.lit("bridge").alias("part"), "p.time", "p.value",
        F.col("p.value").alias("confidence_low"), F.col("p.value").alias("confidence_high"),
    ).filter(ahead.select("part").limit(1).exists())
    none = F.lit(None).cast("double")
    past = history.select(
        F.lit("history").alias("part"), "time", "value",
        none.alias("confidence_low"), none.alias("confidence_high"),
    )
    rows = past.unionByName(bridge).unionByName(ahead)
    width = F.col("confidence_high") - F.col("confidence_low")
    return rows.withColumn("spread_pct", F.round(divide(width, F.col("value")) * 100, 4))
