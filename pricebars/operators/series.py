"""Series: the ordered values of one (symbol, timeframe, indicator).

A series is one row with an array of points.  A symbol has at most one bar per calendar period, so the
array is bounded by the calendar (a 20-year daily history is about 7,300 points), whatever the number of
ticks behind it.  Everything after the one shuffle that builds the arrays -- both models, hold-out,
scoring -- is narrow.
"""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebars.schema import INDICATORS, MIN_OBS, SERIES_KEY, TEST_SIZE


def in_history(df: DataFrame, today: date, years: int = 5, column: str = "time_index") -> DataFrame:
    """Rows from 1 January of the first of ``years`` history years to ``today``."""
    if years < 1:
        raise ValueError("a history has at least one year")
    return df.filter(F.col(column).between(F.lit(date(today.year - years + 1, 1, 1)), F.lit(today)))


def to_series(bars: DataFrame) -> DataFrame:
    """Bars -> ``symbol, timeframe, indicator, points`` with points sorted by date and missing values dropped.

    The five prices of a bar travel together and are split into five series after the shuffle.
    """
    bar = F.struct("time_index", *INDICATORS)
    grouped = bars.groupBy("symbol", "timeframe").agg(F.sort_array(F.collect_list(bar)).alias("bars"))

    def points(indicator: str):
        return F.filter(
            F.transform("bars", lambda b: F.struct(b["time_index"].alias("time_index"), b[indicator].alias("value"))),
            lambda p: p["value"].isNotNull(),
        )

    each = F.array(*[F.struct(F.lit(i).alias("indicator"), points(i).alias("points")) for i in INDICATORS])
    return (
        grouped.select("symbol", "timeframe", F.explode(each).alias("s"))
        .select("symbol", "timeframe", "s.indicator", "s.points")
        .filter(F.size("points") > 0)
    )


def rows_to_series(rows: DataFrame) -> DataFrame:
    """Long rows ``symbol, timeframe, indicator, time_index, value`` -> series; the smallest value wins a tie."""
    clean = rows.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    unique = clean.groupBy(*SERIES_KEY, "time_index").agg(F.min("value").alias("value"))
    points = F.sort_array(F.collect_list(F.struct("time_index", "value")))
    return unique.groupBy(*SERIES_KEY).agg(points.alias("points"))


def series_index(series: DataFrame) -> DataFrame:
    """One row per point with its index 0..n-1."""
    return series.select(*SERIES_KEY, F.posexplode("points").alias("t", "p")).select(
        *SERIES_KEY, F.col("t").cast("bigint").alias("t"), "p.time_index", "p.value"
    )


def eligible(series: DataFrame, min_obs: int = MIN_OBS) -> DataFrame:
    return series.filter(F.size("points") >= min_obs)


def series_lengths(series: DataFrame) -> DataFrame:
    return series.select(*SERIES_KEY, F.size("points").cast("bigint").alias("n"))


def split(series: DataFrame, test_size: int = TEST_SIZE) -> DataFrame:
    """The last ``test_size`` points become ``test``, the others stay ``points``.

    A series that is not longer than ``test_size`` is all training data.
    """
    n = F.size("points")
    cut = F.when(n > test_size, n - test_size).otherwise(n)
    return series.select(
        *SERIES_KEY,
        F.slice("points", F.lit(1), cut).alias("points"),
        F.slice("points", cut + 1, n - cut).alias("test"),
    )


def split_rows(series: DataFrame, test_size: int = TEST_SIZE) -> DataFrame:
    """The same split, one row per point with ``part`` = train or test."""
    parts = split(series, test_size)

    def labelled(column: str, part: str):
        return F.transform(
            column,
            lambda p: F.struct(p["time_index"].alias("time_index"), p["value"].alias("value"), F.lit(part).alias("part")),
        )

    both = F.concat(labelled("points", "train"), labelled("test", "test"))
    return parts.select(*SERIES_KEY, F.explode(both).alias("p")).select(*SERIES_KEY, "p.*")


def series_counts(rows: DataFrame) -> DataFrame:
    """Rows, symbols, indicators and series per timeframe, from long rows."""
    per_series = rows.groupBy("timeframe", "symbol", "indicator").agg(F.count(F.lit(1)).alias("n"))
    return per_series.groupBy("timeframe").agg(
        F.sum("n").alias("n_rows"),
        F.countDistinct("symbol").alias("n_symbols"),
        F.countDistinct("indicator").alias("n_indicators"),
        F.count(F.lit(1)).alias("n_series"),
    )
