"""Bars of all timeframes and the live board, kept up to date from a tick stream."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pricebars.functions.periods import period_start
from pricebars.operators.bars import roll_up
from pricebars.operators.live import board
from pricebars.schema import BAR_KEY, INDICATORS, struct
from pricebars.streaming.tables import Log
from pricebars.streaming.ticks import Clock, closed, landed, late, put_aside

BAR_SCHEMA = struct([*BAR_KEY, *INDICATORS])
#: A day bar that further ticks can join: it knows when its first and last price were.
DAY_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("time_index", T.DateType()),
        T.StructField("first_ts", T.TimestampType()),
        T.StructField("last_ts", T.TimestampType()),
        *[T.StructField(c, T.DoubleType()) for c in INDICATORS[:4]],
    ]
)
#: The two newest days of a symbol.
LAST_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("days", T.ArrayType(T.StructType([f for f in BAR_SCHEMA.fields if f.name not in ("symbol", "timeframe")]))),
    ]
)
BOARD_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("time_index", T.DateType()),
        T.StructField("live_price", T.DoubleType()),
        T.StructField("previous_close", T.DoubleType()),
        T.StructField("day_change", T.DoubleType()),
        T.StructField("day_change_pct", T.DoubleType()),
        T.StructField("direction", T.StringType()),
    ]
)


def _prices() -> list[Column]:
    return [
        F.min_by("price", "ts").alias("open_price"),
        F.max("price").alias("high_price"),
        F.min("price").alias("low_price"),
        F.max_by("price", "ts").alias("close_price"),
    ]


def _usable(ticks: DataFrame) -> DataFrame:
    return ticks.filter(F.col("price").isNotNull() & ~F.isnan("price"))


def _as_bars(grouped: DataFrame, timeframe: Column, start: Column) -> DataFrame:
    return grouped.select(
        "symbol", timeframe.alias("timeframe"), start.cast("date").alias("time_index"),
        *INDICATORS[:4], F.col("close_price").alias("latest_price"),
    )


def stream_bars(ticks: DataFrame, timeframe: str = "day", watermark: str = "1 day") -> DataFrame:
    """Day or week bars of a tick stream; a bar's state is dropped once the watermark has passed it.

    Partial aggregation keeps a hot symbol's ticks off the network.
    """
    if timeframe == "day":
        window = F.window("ts", "1 day")
    elif timeframe == "week":
        # Windows count from 1970-01-01, a Thursday; four days on they start on Mondays.
        window = F.window("ts", "7 days", "7 days", "4 days")
    else:
        raise ValueError("windows have a fixed length: day or week; use keep_rollup for months and years")
    grouped = _usable(ticks).withWatermark("ts", watermark).groupBy("symbol", window.alias("w")).agg(*_prices())
    return _as_bars(grouped, F.lit(timeframe), F.col("w.start"))


def day_parts(ticks: DataFrame) -> DataFrame:
    """Ticks -> what they say about their days; partial aggregation keeps a hot symbol's ticks off the network."""
    return (
        _usable(ticks).filter(F.col("ts").isNotNull()).groupBy("symbol", F.col("ts").cast("date").alias("time_index"))
        .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), *_prices())
    )


def merge_days(parts: DataFrame, known: DataFrame) -> DataFrame:
    """The days of ``parts``, with what is known of them already."""
    keys = ["symbol", "time_index"]
    rows = parts.unionByName(known.join(parts.select(*keys), keys, "left_semi"))
    return rows.groupBy(*keys).agg(
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
        F.min_by("open_price", "first_ts").alias("open_price"), F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"), F.max_by("close_price", "last_ts").alias("close_price"),
    )


def _rolled(changed: DataFrame, stored: DataFrame, timeframe: str) -> DataFrame:
    """The bars that the changed ones are part of, from all stored bars of their periods."""
    def start(df: DataFrame) -> DataFrame:
        return df.withColumn("start", period_start(F.lit(timeframe), F.col("time_index")))

    keys = ["symbol", "start"]
    touched = start(changed).select(*keys).distinct()
    return roll_up(start(stored).join(touched, keys, "left_semi").drop("start"), [timeframe])


def _months_on(date: Column, unit: str, months: int) -> Column:
    return F.add_months(F.trunc(date, unit), months)


def keep_rollup(ticks: DataFrame, out: str, checkpoint: str, delay: str = "1 day") -> StreamingQuery:
    """Day, week, month and year bars of a tick stream, late ticks aside; see :func:`current_bars`, ``late_ticks``.

    The state expires.  A batch merges its ticks with the days it touches, rolls the touched weeks and months up from the stored
    days, and the touched years from the stored months.  Days are stored until the watermark has passed their week
    and month, months until it has passed their year, so the state is bounded by the open periods however long the stream
    runs.  A tick whose day is closed changes nothing and is put aside.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = landed(batch, out, batch_id)
        mark = put_aside(rows, Clock(spark, out, delay), out, batch_id)
        date = F.col("time_index")
        open_days = ~closed(F.greatest(F.date_add(F.trunc(date, "week"), 7), _months_on(date, "month", 1)), mark)
        open_months = ~closed(_months_on(date, "year", 12), mark)
        days, months = day_log(spark, out), month_log(spark, out)

        days.put(merge_days(day_parts(rows.filter(~late(mark))), days.before(batch_id, open_days)), batch_id, open_days)
        changed, stored = days.written(batch_id), days.before(batch_id + 1, open_days)
        months.put(_rolled(changed, stored, "month"), batch_id, open_months)
        month_bars = months.written(batch_id)
        bars = (
            changed.select("symbol", F.lit("day").alias("timeframe"), "time_index", *INDICATORS[:4], F.col("close_price").alias("latest_price"))
            .unionByName(_rolled(changed, stored, "week")).unionByName(month_bars)
            .unionByName(_rolled(month_bars, months.before(batch_id + 1, open_months), "year"))
        )
        bar_log(spark, out).put(bars, batch_id)

    return (
        ticks.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def day_log(spark: SparkSession, out: str) -> Log:
    return Log(spark, f"{out}/days", DAY_SCHEMA, ["symbol", "time_index"])


def month_log(spark: SparkSession, out: str) -> Log:
    return Log(spark, f"{out}/months", BAR_SCHEMA, BAR_KEY)


def bar_log(spark: SparkSession, out: str) -> Log:
    return Log(spark, f"{out}/bars", BAR_SCHEMA, BAR_KEY)


def last_log(spark: SparkSession, out: str) -> Log:
    return Log(spark, f"{out}/last", LAST_SCHEMA, ["symbol"])


def board_log(spark: SparkSession, out: str) -> Log:
    return Log(spark, f"{out}/board", BOARD_SCHEMA, ["symbol"])


def current_bars(spark: SparkSession, out: str) -> DataFrame:
    return bar_log(spark, out).current()


def current_board(spark: SparkSession, out: str) -> DataFrame:
    return board_log(spark, out).current()


def last_two_days(changed: DataFrame, known: DataFrame) -> DataFrame:
    """``symbol, days``: the two newest day bars of every symbol in ``changed``; a changed bar replaces the known one.

    A batch holds as many days of a symbol as are open, and two are known: the arrays are short.
    """
    bar = F.struct("time_index", *INDICATORS).alias("bar")
    fresh = changed.groupBy("symbol").agg(F.collect_list(bar).alias("fresh"))
    both = fresh.join(known.withColumnRenamed("days", "old"), "symbol", "left")
    dates = F.transform("fresh", lambda b: b["time_index"])
    old = F.filter(F.coalesce("old", F.array().cast(LAST_SCHEMA["days"].dataType)), lambda b: ~F.array_contains(dates, b["time_index"]))
    newest = F.slice(F.sort_array(F.concat("fresh", old), asc=False), 1, 2)
    return both.select("symbol", newest.alias("days"))


def keep_bars(bars: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write the changed bars of each micro-batch under ``out``; see :func:`current_bars`.

    Update mode: a batch holds the new version of every bar it changed, in a segment named by the batch,
    so a batch that is run again leaves the same table.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        bar_log(batch.sparkSession, out).put(batch, batch_id)

    return (
        bars.writeStream.outputMode("update").foreachBatch(handle)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def keep_board(ticks: DataFrame, out: str, checkpoint: str, watermark: str = "1 day") -> StreamingQuery:
    """Day bars as in :func:`keep_bars`, and the live board of the symbols each batch touched.

    The board needs the last two day bars per symbol: a log of one row per symbol, to which a batch adds the symbols it touched.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bars, last = bar_log(spark, out), last_log(spark, out)
        bars.put(batch, batch_id)
        last.put(last_two_days(bars.written(batch_id), last.before(batch_id)), batch_id)
        days = last.written(batch_id).select("symbol", F.lit("day").alias("timeframe"), F.inline("days"))
        board_log(spark, out).put(board(days), batch_id)

    return (
        stream_bars(ticks, "day", watermark)
        .writeStream.outputMode("update").foreachBatch(handle)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def closed_bars(
    ticks: DataFrame, out: str, checkpoint: str, timeframe: str = "day", watermark: str = "1 day"
) -> StreamingQuery:
    """Append mode: each bar once, after the watermark has passed the end of its window."""
    return (
        stream_bars(ticks, timeframe, watermark)
        .writeStream.outputMode("append").format("parquet").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
