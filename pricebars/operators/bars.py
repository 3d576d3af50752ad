"""Open / high / low / close bars from ticks or daily candles.

Bars are decomposable: day bars are built first, with map-side partial aggregation, so however many ticks
one symbol has, a day sends at most one row per input split over the network.  Coarser bars are rolled up
from day bars, of which a symbol has at most one per calendar day.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricebars.functions.periods import period_start
from pricebars.schema import INDICATORS, TIMEFRAMES


def _tick_order(ticks: DataFrame) -> Column:
    """What orders the ticks of one symbol inside one day.

    A scalar wherever that is possible: ``min_by``/``max_by`` on a scalar aggregate in a hash table, on a
    struct they sort all ticks first.  If ``ts`` is a DATE, all ticks of a day share it.  A time stamp with a whole number that
    breaks its ties is one number of 38 digits: the micros of the day, times 2^64, and the number.
    """
    if "seq" not in ticks.columns:
        return F.col("ts")
    if isinstance(ticks.schema["ts"].dataType, T.DateType):
        return F.col("seq")
    if isinstance(ticks.schema["seq"].dataType, T.IntegralType):
        whole = "decimal(38,0)"
        of_day = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.date_trunc("day", F.col("ts").cast("timestamp")))
        # less than 2^37 * 2^64: exact; a missing number comes before all others, as a missing part of a struct does
        number = F.coalesce(F.col("seq").cast(whole), F.lit(str(-(2**63) - 1)).cast(whole))
        return (of_day.cast(whole) * F.lit(str(2**64)).cast("decimal(20,0)")).cast(whole) + number
    return F.struct("ts", "seq")


def day_bars(ticks: DataFrame) -> DataFrame:
    """Ticks ``symbol, ts[, seq], price`` -> one bar per symbol and date.

    A tick without a price (NULL or NaN) is no trade and is left out.
    """
    order = _tick_order(ticks)
    return (
        ticks.filter(F.col("price").isNotNull() & ~F.isnan("price"))
        .groupBy("symbol", F.col("ts").cast("date").alias("time_index"))
        .agg(
            F.min_by("price", order).alias("open_price"),
            F.max("price").alias("high_price"),
            F.min("price").alias("low_price"),
            F.max_by("price", order).alias("close_price"),
        )
        .select("symbol", F.lit("day").alias("timeframe"), "time_index", *_prices())
    )


def candle_bars(candles: DataFrame) -> DataFrame:
    """Candles ``symbol, ts, seq, open, high, low, close`` as day bars: the first open and the last close of a date."""
    return (
        candles.groupBy("symbol", F.col("ts").alias("time_index"))
        .agg(
            F.min_by("open", "seq").alias("open_price"),
            F.max("high").alias("high_price"),
            F.min("low").alias("low_price"),
            F.max_by("close", "seq").alias("close_price"),
        )
        .select("symbol", F.lit("day").alias("timeframe"), "time_index", *_prices())
    )


def _prices() -> list[Column]:
    return [F.col(c) for c in INDICATORS[:4]] + [F.col("close_price").alias("latest_price")]


def roll_up(days: DataFrame, timeframes: list[str]) -> DataFrame:
    """Day bars -> bars of the given timeframes, in one pass and one shuffle.

    The shuffle is by symbol alone: a symbol's bars, of which the calendar bounds the number, are then in one task, so the windows and
    aggregations over (symbol, timeframe) that follow need no shuffle of their own.

    Open and close are those of the first and last day, missing if missing there; high and low ignore
    missing values.  Each day bar is expanded to its week, month and year before the aggregation, so the day bars are
    computed once, not once per timeframe.
    """
    expanded = days.repartition("symbol").select(
        "symbol",
        F.explode(F.array(*[F.lit(t) for t in timeframes])).alias("timeframe"),
        F.col("time_index").alias("date"),
        *INDICATORS[:4],
    )
    return (
        expanded
        .groupBy("symbol", "timeframe", period_start(F.col("timeframe"), F.col("date")).alias("time_index"))
        .agg(
            F.min_by("open_price", "date").alias("open_price"),
            F.max("high_price").alias("high_price"),
            F.min("low_price").alias("low_price"),
            F.max_by("close_price", "date").alias("close_price"),
        )
        .select("symbol", "timeframe", "time_index", *_prices())
    )


def ohlc(ticks: DataFrame, timeframe: str) -> DataFrame:
    days = day_bars(ticks)
    return days if timeframe == "day" else roll_up(days, [timeframe])


def ohlc_all(ticks: DataFrame, timeframes: list[str] = TIMEFRAMES) -> DataFrame:
    return roll_up(day_bars(ticks), timeframes)
