"""Streams against the batch operators on the same rows, over several micro-batches and restarts."""

import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import BARS, D, TS, bar, rows
from pyspark.sql import functions as F

from pricebars.operators import bars, live
from pricebars.sources.tables import event_ticks, table
from pricebars.streaming import bars as stream_bars
from pricebars.streaming import tables as stream_tables
from pricebars.streaming import ticks as stream_ticks

FOLDER = "/root/testdata/sf0.001"


def land(df, folder, name):
    """One more file in the landing folder, newer than those before it."""
    path = folder / name
    df.coalesce(1).write.mode("overwrite").parquet(str(path))
    time.sleep(0.02)


def events(spark, *data):
    return spark.createDataFrame(
        [(i, TS(t), u, "x", p, "{}") for i, t, u, p in data], "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """The event table cut into ten-day files, in time order."""
    folder = tmp_path_factory.mktemp("landing")
    source = table(spark, FOLDER, "events")
    for i in range(3):
        low, high = f"2024-01-{1 + 10 * i:02d}", f"2024-01-{11 + 10 * i:02d}" if i < 2 else "2024-03-01"
        land(source.filter((F.col("ts") >= low) & (F.col("ts") < high)), folder, f"part{i}")
    return folder


def ticks_of(spark, folder):
    return stream_ticks.tick_stream(spark, f"{folder}/*", max_files=1)


def test_several_batches_are_read(spark, landed, tmp_path):
    query = stream_bars.keep_bars(stream_bars.stream_bars(ticks_of(spark, landed)), str(tmp_path / "o"), str(tmp_path / "c"))
    query.awaitTermination()
    assert sum(p.numInputRows > 0 for p in query.recentProgress) == 3


@pytest.mark.parametrize("timeframe", ["day", "week"])
def test_window_bars_equal_batch_bars(spark, landed, tmp_path, timeframe):
    out = str(tmp_path / "o")
    stream_bars.keep_bars(stream_bars.stream_bars(ticks_of(spark, landed), timeframe), out, str(tmp_path / "c")).awaitTermination()
    want = bars.ohlc(event_ticks(spark, FOLDER), timeframe)
    assert rows(stream_bars.current_bars(spark, out), "symbol", "time_index") == rows(want, "symbol", "time_index")


def test_rolled_bars_of_all_timeframes_equal_batch_bars(spark, landed, tmp_path):
    out = str(tmp_path / "o")
    stream_bars.keep_rollup(ticks_of(spark, landed), out, str(tmp_path / "c")).awaitTermination()
    want = bars.ohlc_all(event_ticks(spark, FOLDER))
    order = ["symbol", "timeframe", "time_index"]
    assert rows(stream_bars.current_bars(spark, out), *order) == rows(want, *order)


def test_other_timeframes_have_no_window(spark, landed):
    with pytest.raises(ValueError):
        stream_bars.stream_bars(ticks_of(spark, landed), "month")


def test_streams_need_a_utc_session(spark, landed):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Phnom_Penh")
    try:
        with pytest.raises(ValueError):
            ticks_of(spark, landed)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_append_gives_the_closed_windows_once(spark, landed, tmp_path):
    out = str(tmp_path / "o")
    stream_bars.closed_bars(ticks_of(spark, landed), out, str(tmp_path / "c")).awaitTermination()
    got = spark.read.schema(stream_bars.BAR_SCHEMA).parquet(out)
    last = event_ticks(spark, FOLDER).agg(F.max("ts")).collect()[0][0]
    closed = bars.day_bars(event_ticks(spark, FOLDER)).filter(
        F.to_timestamp(F.date_add("time_index", 1)) <= F.lit(last) - F.expr("INTERVAL 1 DAY")
    )
    assert rows(got, "symbol", "time_index") == rows(closed, "symbol", "time_index")


def test_board_equals_batch_board(spark, landed, tmp_path):
    out = str(tmp_path / "o")
    stream_bars.keep_board(ticks_of(spark, landed), out, str(tmp_path / "c")).awaitTermination()
    assert rows(stream_bars.current_board(spark, out), "symbol") == rows(live.tick_board(event_ticks(spark, FOLDER)), "symbol")


def three_years(spark, landing, months=36):
    """A tick every ten days of two symbols, a quarter of a year to a file."""
    data = []
    for m in range(months):
        for d in (1, 11, 21):
            for u in (7, 8):
                data.append((len(data), f"{2020 + m // 12}-{m % 12 + 1:02d}-{d:02d}T10:00:00", u, float(len(data) * 7 % 101)))
    per = 18
    for i in range(0, len(data), per):
        land(events(spark, *data[i : i + per]), landing, f"part{i // per:03d}")
    return events(spark, *data)


def test_state_is_bounded_by_the_open_periods(spark, tmp_path, monkeypatch):
    """Three years in twelve batches: days of more than a month and months of more than a year ago are not in the state."""
    landing, out = tmp_path / "in", str(tmp_path / "o")
    landing.mkdir()
    monkeypatch.setattr(stream_tables, "FAN", 2)
    source = three_years(spark, landing)
    query = stream_bars.keep_rollup(ticks_of(spark, landing), out, str(tmp_path / "c"))
    query.awaitTermination()
    assert sum(p.numInputRows > 0 for p in query.recentProgress) == 12
    ticks = source.select(F.col("user_id").cast("string").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("price"))
    order = ["symbol", "timeframe", "time_index"]
    assert rows(stream_bars.current_bars(spark, out), *order) == rows(bars.ohlc_all(ticks), *order)
    # what is stored and not read any more goes when its segments are merged; what the last batch read is bounded
    mark = stream_ticks.Clock(spark, out).mark(12)
    alive = ~stream_ticks.closed(F.add_months(F.trunc("time_index", "month"), 1), mark)
    assert stream_bars.day_log(spark, out).current(alive).count() == 2 * 3
    stored = spark.read.parquet(f"{out}/days")
    assert stored.filter("time_index < '2021-09-01'").count() == 0  # of 216 days those of the last merges remain
    assert spark.read.parquet(f"{out}/months").filter("time_index < '2021-01-01'").count() == 0


def test_late_ticks_are_put_aside_and_change_nothing(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "o")
    landing.mkdir()
    batches = [
        [(1, "2024-01-10T10:00:00", 7, 1.0)],
        [(2, "2024-01-08T23:00:00", 7, 50.0), (3, "2024-01-09T09:00:00", 7, 2.0), (4, "2024-01-12T10:00:00", 8, 3.0)],
        [(5, "2024-01-10T11:00:00", 7, 99.0), (6, "2024-01-11T09:00:00", 7, 4.0), (7, "2023-12-31T00:00:00", 7, None)],
    ]
    for i, batch in enumerate(batches):
        land(events(spark, *batch), landing, f"part{i}")
    stream_bars.keep_rollup(ticks_of(spark, landing), out, str(tmp_path / "c")).awaitTermination()
    late = [(r.batch, r.event_id, r.price) for r in stream_ticks.late_ticks(spark, out).orderBy("event_id").collect()]
    assert late == [(1, 2, 50.0), (2, 5, 99.0), (2, 7, None)]
    assert rows(stream_ticks.late_counts(spark, out), "batch") == [(1, 1), (2, 2)]
    days = stream_bars.current_bars(spark, out).filter("timeframe = 'day' AND symbol = '7'").select("time_index", "close_price")
    assert rows(days, "time_index") == [(D("2024-01-09"), 2.0), (D("2024-01-10"), 1.0), (D("2024-01-11"), 4.0)]
    year = stream_bars.current_bars(spark, out).filter("timeframe = 'year' AND symbol = '7'")
    assert [(r.open_price, r.high_price, r.close_price) for r in year.collect()] == [(2.0, 4.0, 4.0)]


def test_late_rows_of_many_batches_are_counted_without_polling(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "o")
    landing.mkdir()
    for i in range(22):
        day = "2024-01-%02dT10:00:00" % (11 if i == 0 else 12 if i == 1 else 2)
        row = {"event_id": [i], "ts": pa.array([TS(day)], pa.timestamp("us")), "user_id": [7], "event_type": ["x"], "value": [1.0], "props": ["{}"]}
        (landing / f"part{i:03d}").mkdir()
        pq.write_table(pa.table(row), str(landing / f"part{i:03d}" / "a.parquet"))
        time.sleep(0.005)
    query = stream_ticks.keep_late(ticks_of(spark, landing), out, str(tmp_path / "c"))
    query.awaitTermination()
    counts = rows(stream_ticks.late_counts(spark, out), "batch")
    assert len(counts) == 20 and all(n == 1 for _, n in counts)


def test_last_two_days(spark):
    days = lambda *d: [(D(day), *[p] * 5) for day, p in d]
    known = spark.createDataFrame([("A", days(("2024-01-02", 2.0), ("2024-01-01", 1.0))), ("Z", days(("2024-01-01", 1.0)))], stream_bars.LAST_SCHEMA)
    changed = spark.createDataFrame(
        [bar("A", "day", "2024-01-02", 9.0, 9.0, 9.0, 9.0), bar("A", "day", "2024-01-05", 5.0, 5.0, 5.0, 5.0), bar("B", "day", "2024-01-05", 5.0, 5.0, 5.0, 5.0)], BARS
    )
    got = {r.symbol: [(d.time_index, d.close_price) for d in r.days] for r in stream_bars.last_two_days(changed, known).collect()}
    assert got == {"A": [(D("2024-01-05"), 5.0), (D("2024-01-02"), 9.0)], "B": [(D("2024-01-05"), 5.0)]}


def test_board_batches_write_touched_symbols_only(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "o")
    landing.mkdir()
    land(events(spark, *[(u, "2024-01-01T10:00:00", u, 1.0) for u in range(50)]), landing, "part0")
    land(events(spark, (60, "2024-01-02T10:00:00", 7, 2.0)), landing, "part1")
    stream_bars.keep_board(ticks_of(spark, landing), out, str(tmp_path / "c")).awaitTermination()
    for log in (stream_bars.board_log(spark, out), stream_bars.last_log(spark, out), stream_bars.bar_log(spark, out)):
        assert [r.symbol for r in log.written(1).collect()] == ["7"] and log.written(0).count() == 50
    assert stream_bars.current_board(spark, out).count() == 50


def changes(spark, out):
    return stream_tables.all_batches(spark, f"{out}/changes", stream_ticks.CHANGE_SCHEMA)


def test_tick_change_over_batches_and_a_restart(spark, tmp_path, monkeypatch):
    landing, out, checkpoint = tmp_path / "in", str(tmp_path / "o"), str(tmp_path / "c")
    landing.mkdir()
    source = table(spark, FOLDER, "events").withColumn("ts", F.col("ts"))
    monkeypatch.setattr(stream_tables, "FAN", 2)
    read = 0
    for i, (low, high) in enumerate([("2024-01-01", "2024-01-08"), ("2024-01-08", "2024-01-20"), ("2024-01-20", "2024-03-01")]):
        land(source.filter((F.col("ts") >= low) & (F.col("ts") < high)), landing, f"part{i}")
        query = stream_ticks.stream_tick_change(ticks_of(spark, landing), out, checkpoint)
        query.awaitTermination()
        read += sum(p.numInputRows for p in query.recentProgress)
    assert read == source.count()  # each batch is read once
    want = live.tick_change(event_ticks(spark, FOLDER))
    got = changes(spark, out)
    assert got.select("batch").distinct().count() == 3
    assert rows(got.select(want.columns), "symbol", "ts") == rows(want, "symbol", "ts")


def test_late_ticks_are_reported_and_change_nothing(spark, tmp_path):
    landing, out, checkpoint = tmp_path / "in", str(tmp_path / "o"), str(tmp_path / "c")
    landing.mkdir()
    batches = [
        events(spark, (1, "2024-01-01T10:00:00", 7, 10.0)),
        events(spark, (2, "2024-01-01T09:00:00", 7, 99.0), (3, "2024-01-01T11:00:00", 7, 12.0), (4, "2024-01-01T10:00:00", 7, 11.0)),
        events(spark, (5, "2024-01-01T12:00:00", 7, 11.0), (6, "2024-01-01T12:00:00", 8, 1.0)),
    ]
    for i, batch in enumerate(batches):
        land(batch, landing, f"part{i}")
        stream_ticks.stream_tick_change(ticks_of(spark, landing), out, checkpoint).awaitTermination()
    got = [(r.event_id, r.tick_change, r.tick_status) for r in changes(spark, out).orderBy("event_id").collect()]
    assert got == [(1, 0.0, "flat"), (2, None, "late"), (3, 1.0, "up"), (4, 1.0, "up"), (5, -1.0, "down"), (6, 0.0, "flat")]


def test_duplicates_count_once(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    first = events(spark, (1, "2024-01-01T10:00:00", 7, 10.0), (1, "2024-01-01T10:00:00", 7, 10.0), (2, "2024-01-01T10:01:00", 7, 11.0))
    land(first, landing, "part0")
    land(events(spark, (2, "2024-01-01T10:01:00", 7, 11.0), (3, "2024-01-01T10:02:00", 7, 12.0)), landing, "part1")
    out = str(tmp_path / "o")
    query = (
        stream_ticks.distinct_ticks(ticks_of(spark, landing)).writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert [r.event_id for r in spark.read.parquet(out).orderBy("event_id").collect()] == [1, 2, 3]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    path, schema = str(tmp_path / "t"), spark.range(1).schema
    for _ in range(2):
        stream_tables.write_batch(spark.range(3), path, 4)
    assert stream_tables.all_batches(spark, path, schema).count() == 3
    assert stream_tables.all_batches(spark, str(tmp_path / "none"), schema).count() == 0


def test_log_keeps_the_last_versions_in_few_segments(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stream_tables, "FAN", 3)
    path = tmp_path / "t"
    schema = spark.createDataFrame([], "k INT, v INT").schema
    log, want = stream_tables.Log(spark, str(path), schema, ["k"]), {}
    frame = lambda data: spark.createDataFrame(data, schema)
    for i in range(20):
        assert {r.k: r.v for r in log.before(i).collect()} == want
        changed = {i % 5: i, 10 + i: i}
        log.put(frame(list(changed.items())), i)
        if i in (4, 8, 9, 17):  # a batch runs again
            assert {r.k: r.v for r in log.before(i).collect()} == want
            log.put(frame(list(changed.items())), i)
        want |= changed
        assert {r.k: r.v for r in log.current().collect()} == want
    segments = sum(1 for _ in path.glob("level=*/segment=*"))
    assert segments <= 12  # of 20, and 8 merged ones


def test_log_forgets_what_is_not_alive(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stream_tables, "FAN", 2)
    schema = spark.createDataFrame([], "k INT, v INT").schema
    log = stream_tables.Log(spark, str(tmp_path / "t"), schema, ["k"])
    for i in range(16):
        log.put(spark.createDataFrame([(i, i)], schema), i, F.col("k") >= i - 2)
    assert sorted(r.k for r in log.before(16, F.col("k") >= 14).collect()) == [14, 15]
    assert spark.read.parquet(str(tmp_path / "t")).filter("level > 0 AND k < 5").count() == 0
