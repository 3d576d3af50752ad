"""Tick streams from landed files: source, duplicates, the clock and late rows, tick change."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pricebars.operators.live import tick_change
from pricebars.sources.store import remove, small_tasks
from pricebars.streaming.tables import Log, all_batches, write_batch

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
STATE_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("price", T.DoubleType()),
    ]
)
TICK_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), *STATE_SCHEMA.fields])
CLOCK_SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("latest", T.LongType())])
CHANGE_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        *STATE_SCHEMA.fields,
        T.StructField("tick_change", T.DoubleType()),
        T.StructField("tick_status", T.StringType()),
    ]
)


def tick_stream(
    spark: SparkSession, folder: str, files: str = "*.parquet", max_files: int | None = None
) -> DataFrame:
    """Event files as a stream of ``event_id, symbol, ts, price``.

    Watermarks need TIMESTAMP, and the files hold times without a zone: the session has to be in UTC, or
    days would begin at another hour than in the batch operators.
    """
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "GMT"):
        raise ValueError("set spark.sql.session.timeZone to UTC before streaming")
    reader = spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", files)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder).select(
        "event_id",
        F.col("user_id").cast("string").alias("symbol"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("price"),
    )


def distinct_ticks(ticks: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Each event once; its id is remembered for the length of the watermark."""
    return ticks.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["event_id"])


def landed(batch: DataFrame, out: str, batch_id: int) -> DataFrame:
    """The ticks of a micro-batch, read from their source once and written; those of the batch before go."""
    write_batch(batch.select(*TICK_SCHEMA.names), f"{out}/landed", batch_id)
    remove(batch.sparkSession, f"{out}/landed/batch={batch_id - 1}")
    return batch.sparkSession.read.schema(TICK_SCHEMA).parquet(f"{out}/landed/batch={batch_id}")


class Clock:
    """The event time a stream has reached, as a watermark: the latest time stamp of all batches before, less a delay.

    It is kept as a table of one row, so that a batch that runs again sees the same watermark.  (Spark's own windows judge a tick by
    the watermark of one batch earlier and may still take one that is late here.)
    """

    def __init__(self, spark: SparkSession, out: str, delay: str = "1 day"):
        self.delay, self.log = delay, Log(spark, f"{out}/clock", CLOCK_SCHEMA, ["name"])

    def mark(self, batch_id: int) -> int | None:
        """Microseconds of the watermark of a batch; the first has none."""
        mark = F.expr(f"unix_micros(timestamp_micros(latest) - INTERVAL {self.delay})")
        row = self.log.before(batch_id).select(mark.alias("mark")).first()
        return row.mark if row else None

    def see(self, ticks: DataFrame, batch_id: int) -> None:
        before = self.log.before(batch_id).select("latest")
        now = ticks.agg(F.max(F.unix_micros("ts")).alias("latest")).unionByName(before)
        latest = now.agg(F.max("latest").alias("latest")).filter(F.col("latest").isNotNull())
        self.log.put(latest.select(F.lit("ticks").alias("name"), "latest"), batch_id)


def closed(end: Column, mark: int | None) -> Column:
    """Whether a period that ends at the start of a date is closed; no time stamp is in no period."""
    if mark is None:
        return F.lit(False)
    return F.coalesce(F.unix_micros(end.cast("timestamp")) <= mark, F.lit(False))


def late(mark: int | None) -> Column:
    """Whether a tick comes after its day was closed."""
    return closed(F.date_add(F.col("ts").cast("date"), 1), mark)


def keep_late(ticks: DataFrame, out: str, checkpoint: str, delay: str = "1 day") -> StreamingQuery:
    """Only the late ticks of a stream; the jobs that build bars write the same ones beside their bars."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        put_aside(landed(batch, out, batch_id), Clock(batch.sparkSession, out, delay), out, batch_id)

    return (
        ticks.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def put_aside(rows: DataFrame, clock: Clock, out: str, batch_id: int) -> int | None:
    """Write a batch's late ticks under its number and move the clock; the watermark the batch ran with."""
    mark = clock.mark(batch_id)
    write_batch(rows.filter(late(mark)), f"{out}/late", batch_id)
    clock.see(rows, batch_id)
    return mark


def late_ticks(spark: SparkSession, out: str) -> DataFrame:
    """The ticks that came too late for their day, with the batch they came in."""
    return all_batches(spark, f"{out}/late", TICK_SCHEMA)


def late_counts(spark: SparkSession, out: str) -> DataFrame:
    """Their number per batch."""
    return late_ticks(spark, out).groupBy("batch").agg(F.count(F.lit(1)).alias("n_late"))


def last_ticks(ticks: DataFrame) -> DataFrame:
    return (
        ticks.groupBy("symbol").agg(F.max(F.struct("ts", "event_id", "price")).alias("t"))
        .select("symbol", "t.ts", "t.price")
    )


def change_batch(batch: DataFrame, state: DataFrame) -> DataFrame:
    """Tick changes of one micro-batch.

    ``state`` has the last tick of each symbol so far.  A tick older than that is reported as ``late``
    and changes nothing.  The state rows join the batch as its earliest ticks, so the batch operator
    does the work, which spreads a hot symbol over tasks.
    """
    known = state.select("symbol", F.col("ts").alias("state_ts"))
    ticks = batch.select("event_id", "symbol", "ts", "price").join(known, "symbol", "left")
    is_late = F.coalesce(F.col("ts") < F.col("state_ts"), F.lit(False))
    late = ticks.filter(is_late).select(
        "event_id", "symbol", "ts", "price",
        F.lit(None).cast("double").alias("tick_change"), F.lit("late").alias("tick_status"),
    )
    fresh = ticks.filter(~is_late).drop("state_ts")
    seeds = state.join(fresh.select("symbol").distinct(), "symbol", "left_semi").withColumn(
        "event_id", F.lit(None).cast("bigint")
    )
    # The event id orders ticks that share a time stamp; a state row has none and comes first.
    numbered = fresh.unionByName(seeds).withColumn("seq", F.coalesce("event_id", F.lit(-1)))
    changes = tick_change(numbered).filter(F.col("event_id").isNotNull()).drop("seq")
    return changes.unionByName(late)


def stream_tick_change(ticks: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Tick change per symbol across micro-batches, over all files landed so far.

    A batch is read from its source once and written; the rest works on what was written.  The state, one
    row per symbol, is a :class:`Log`: a batch adds the symbols it moved.  Ticks are sorted in tasks that stay small.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with small_tasks(spark):
            rows = landed(batch, out, batch_id)
            state = Log(spark, f"{out}/state", STATE_SCHEMA, ["symbol"])
            write_batch(change_batch(rows, state.before(batch_id)), f"{out}/changes", batch_id)
            written = spark.read.schema(CHANGE_SCHEMA).parquet(f"{out}/changes/batch={batch_id}")
            fresh = written.filter(F.col("tick_status") != "late").select("event_id", *STATE_SCHEMA.names)
            state.put(last_ticks(fresh), batch_id)

    return (
        ticks.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
