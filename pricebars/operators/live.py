"""Tick-level views: tick change, recent ticks, the up / down / flat board."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricebars.functions.numeric import divide, zero_as_null
from pricebars.operators.bars import day_bars

SLOT = 10_000  # of the numbers that order the ticks of a date, as many make a part


def direction(change: Column) -> Column:
    return F.when(change > 0, "up").when(change < 0, "down").otherwise("flat")


def _order(ticks: DataFrame) -> list[str]:
    return ["ts", "seq"] if "seq" in ticks.columns else ["ts"]


def _slot(ticks: DataFrame) -> list[Column]:
    """Two numbers that ascend with the order of the ticks: the minute, and a part of it.

    Ticks of a DATE have only their day, which ``seq`` (its first field, if it has several) cuts into parts.
    """
    kind = ticks.schema["ts"].dataType
    none = F.lit(0).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return [F.floor(F.unix_seconds("ts") / 60), none]
    day = F.unix_date(F.col("ts").cast("date")).cast("bigint") * 1440
    if not isinstance(kind, T.DateType):
        return [day + F.hour("ts") * 60 + F.minute("ts"), none]
    if "seq" not in ticks.columns:
        return [day, none]
    seq, of = F.col("seq"), ticks.schema["seq"].dataType
    if isinstance(of, T.StructType):
        seq, of = seq[of[0].name], of[0].dataType
    return [day, F.floor(seq / SLOT).cast("bigint") if isinstance(of, T.NumericType) else none]


def tick_change(ticks: DataFrame) -> DataFrame:
    """Price minus the previous tick's price of the symbol, 0 for its first tick; ticks without a price are none.

    Every symbol is split by time, so no task holds all ticks of one.  Each slot is opened by an extra row with the last
    price of the symbol's slot before, taken from a pre-aggregated table of one row per slot.  Ticks are dealt out by slot
    explicitly: those that a join has dealt by symbol would stay so, as that satisfies the windows too.
    """
    order = _order(ticks)
    slot = ["minute", "part"]
    rows = (
        ticks.filter(F.col("price").isNotNull() & ~F.isnan("price"))
        .withColumns({**dict(zip(slot, _slot(ticks))), "is_tick": F.lit(True)})
        .repartition("symbol", *slot)
    )
    last_tick = F.max_by("price", F.col("ts") if order == ["ts"] else F.struct(*order))
    last = rows.groupBy("symbol", *slot).agg(last_tick.alias("last"))
    openers = last.select(
        "symbol", *slot, F.lit(False).alias("is_tick"),
        F.lag("last").over(Window.partitionBy("symbol").orderBy(*slot)).alias("price"),
    ).filter(F.col("price").isNotNull())
    previous = F.lag("price").over(Window.partitionBy("symbol", *slot).orderBy("is_tick", *order))
    return (
        rows.unionByName(openers, allowMissingColumns=True).repartition("symbol", *slot)
        .withColumn("tick_change", F.coalesce(F.col("price") - previous, F.lit(0.0)))
        .filter("is_tick")
        .select(*ticks.columns, "tick_change", direction(F.col("tick_change")).alias("tick_status"))
    )


def recent_ticks(ticks: DataFrame, n: int = 240) -> DataFrame:
    """The last n ticks over all symbols; each task keeps its own n, so only those are merged."""
    order = [*_order(ticks), "symbol"]
    return ticks.orderBy(*[F.desc(c) for c in order]).limit(n)


def recent_ticks_per_symbol(ticks: DataFrame, n: int = 240) -> DataFrame:
    """The last n ticks of each symbol; Spark limits each group per task before the shuffle."""
    latest = Window.partitionBy("symbol").orderBy(*[F.desc(c) for c in _order(ticks)])
    return ticks.withColumn("place", F.row_number().over(latest)).filter(F.col("place") <= n).drop("place")


def quote_fallback(bars: DataFrame) -> DataFrame:
    """A quote made of a stored bar: latest, else close, else 0; a 0 counts as missing."""
    def number(name: str) -> Column:
        return F.coalesce(name, F.lit(0.0))

    return bars.select(
        "symbol",
        F.coalesce(zero_as_null(F.col("latest_price")), zero_as_null(F.col("close_price")), F.lit(0.0)).alias("live_price"),
        number("open_price").alias("open"),
        number("high_price").alias("high"),
        number("low_price").alias("low"),
        number("close_price").alias("previous_close"),
    )


def day_change(quotes: DataFrame) -> DataFrame:
    """``live_price`` against ``previous_close``: difference, percent and direction.

    Without a previous close (missing or 0) the change is 0.
    """
    before = zero_as_null(F.col("previous_close"))
    change = F.coalesce(F.col("live_price") - before, F.lit(0.0))
    pct = F.coalesce(divide(change, before) * 100, F.lit(0.0))
    return quotes.withColumns({"day_change": change, "day_change_pct": pct, "direction": direction(change)})


def board(days: DataFrame) -> DataFrame:
    """The last price per symbol against the close of the bar before it.

    ``days`` are day bars: at most one per symbol and date, so the window is bounded by the calendar.
    """
    history = Window.partitionBy("symbol").orderBy("time_index")
    return day_change(
        days.withColumn("previous_close", F.lag("close_price").over(history))
        .withColumn("next", F.lead("time_index").over(history))
        .filter(F.col("next").isNull())
        .select("symbol", "time_index", F.col("latest_price").alias("live_price"), "previous_close")
    )


def tick_board(ticks: DataFrame) -> DataFrame:
    return board(day_bars(ticks))


def live_counts(board: DataFrame) -> DataFrame:
    return board.agg(
        F.count(F.lit(1)).alias("n_symbols"),
        F.count_if(F.col("direction") == "up").alias("n_up"),
        F.count_if(F.col("direction") == "down").alias("n_down"),
        F.count_if(F.col("direction") == "flat").alias("n_flat"),
    )
