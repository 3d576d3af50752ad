"""Bar features: movement, volatility, category averages, names and categories."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricebars.functions.numeric import exact_mean, percent
from pricebars.functions.reference_data import FALLBACK_CATEGORY

PERIOD = ["category", "timeframe", "time_index"]


def _has(df: DataFrame, *needed: str) -> bool:
    return set(needed) <= set(df.columns)


def _nulls(df: DataFrame, **types: str) -> DataFrame:
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in types.items()})


def drop_missing_price(bars: DataFrame) -> DataFrame:
    if not _has(bars, "close_price"):
        return bars
    return bars.filter(F.col("close_price").isNotNull() & ~F.isnan("close_price"))


def canonical_names(df: DataFrame, names: DataFrame) -> DataFrame:
    """Replace ``name`` where ``names`` (symbol, canonical_name) knows the symbol."""
    return (
        df.join(names.select("symbol", "canonical_name"), "symbol", "left")
        .withColumn("name", F.coalesce("canonical_name", "name"))
        .drop("canonical_name")
        .select(*df.columns)
    )


def with_category(df: DataFrame, profiles: DataFrame) -> DataFrame:
    """Category of each symbol; symbols without one fall into the default category.

    ``profiles`` holds symbols in any case of letters; of rows that differ in that alone, the first by its columns counts.  Its name goes before a name that ``df`` brings, and that
    before the symbol.  No broadcast hint: Catalyst broadcasts it when it is small and shuffles when the number of
    symbols makes it large.
    """
    known = [c for c in ("name", "category") if c in profiles.columns]
    first = F.min(F.struct("symbol", *known)).alias("_first")
    found = profiles.groupBy(F.upper("symbol").alias("_symbol")).agg(first)
    found = found.select("_symbol", *[F.col(f"_first.{c}").alias(f"_{c}") for c in known])
    out = df.join(found, F.upper(df["symbol"]) == F.col("_symbol"), "left")

    def filled(column: str, last: Column) -> Column:
        known = [F.nullif(F.col(c), F.lit("")) for c in (f"_{column}", column) if c in out.columns]
        return F.coalesce(*known, last)

    if "_name" in out.columns or "name" in df.columns:
        out = out.withColumn("name", filled("name", F.col("symbol")))
    return out.withColumn("category", filled("category", F.lit(FALLBACK_CATEGORY))).drop("_symbol", "_name", "_category")


def price_movement(bars: DataFrame, up: float = 1, down: float = -1) -> DataFrame:
    """Change against the previous bar of the symbol and timeframe.

    The percentage uses the rounded change; without a usable previous close the trend is ``new``.
    One bar per symbol, timeframe and date: a window holds no more rows than the calendar has periods.
    """
    if not _has(bars, "close_price"):
        return _nulls(bars, price_change="double", price_change_pct="double", price_trend="string")
    history = Window.partitionBy("symbol", "timeframe").orderBy("time_index")
    pct = F.col("price_change_pct")
    return (
        bars.withColumn("previous_close", F.lag("close_price").over(history))
        .withColumn("price_change", F.round(F.col("close_price") - F.col("previous_close"), 4))
        .withColumn("price_change_pct", percent(F.col("price_change"), F.col("previous_close")))
        .withColumn(
            "price_trend",
            F.when(pct >= up, "up").when(pct <= down, "down").when(pct.isNotNull(), "flat").otherwise("new"),
        )
        .drop("previous_close")
    )


def volatility(bars: DataFrame, high: float = 8, medium: float = 3) -> DataFrame:
    if not _has(bars, "high_price", "low_price", "close_price"):
        return _nulls(bars, intraday_range="double", intraday_range_pct="double", volatility_level="string")
    pct = F.col("intraday_range_pct")
    return (
        bars.withColumn("intraday_range", F.round(F.col("high_price") - F.col("low_price"), 4))
        .withColumn("intraday_range_pct", percent(F.col("intraday_range"), F.col("close_price")))
        .withColumn(
            "volatility_level",
            F.when(pct >= high, "high").when(pct >= medium, "medium").when(pct.isNotNull(), "low"),
        )
    )


def category_average(bars: DataFrame) -> DataFrame:
    """Mean close and row count per category, timeframe and date."""
    return bars.groupBy(*PERIOD).agg(
        F.round(exact_mean(F.col("close_price")), 4).alias("category_avg_close"),
        F.count(F.lit(1)).alias("category_count"),
    )


def with_category_average(bars: DataFrame, averages: DataFrame | None = None) -> DataFrame:
    """Put the category average on every bar; ``averages`` are those of ``bars`` if they have been stored.

    Aggregated first and joined back: the averages are one small row per category and period, while a
    window over the category would pull a whole sector's bars of a period into one task.  Catalyst
    broadcasts the averages when they are small; else AQE splits the skewed side of the join.  Averages that are not stored
    are judged by their parts, one of each task, and may be sorted and joined however few they are.
    """
    if not _has(bars, *PERIOD, "close_price"):
        return _nulls(bars, category_avg_close="double", category_count="bigint")
    return bars.join(category_average(bars) if averages is None else averages, PERIOD, "left")


def enrich(bars: DataFrame, profiles: DataFrame) -> DataFrame:
    """All features.  Bars are read twice, for themselves and for the averages: pass a stored table, not
    the plan that builds it from ticks."""
    return with_category_average(volatility(price_movement(with_category(bars, profiles))))


def trend_distribution(bars: DataFrame) -> DataFrame:
    return bars.groupBy("price_trend").agg(F.count(F.lit(1)).alias("n"))
