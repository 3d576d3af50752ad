"""Steps whose tasks must not grow with a table."""

from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from pricebars.operators import quality
from pricebars.plans import queries
from pricebars.sources import store
from pricebars.streaming import ticks as stream_ticks


@pytest.mark.parametrize("bits", [3, quality.BITS])
@pytest.mark.parametrize(
    "keys",
    [[7], [3, 3, 3], [-5, -4, None, -4, 9, 12], [-(2**63), 2**63 - 1, 0, 5], list(range(-50, 70, 3)) * 2, [1, 2, 2, 2, 100]],
)
def test_quantile_is_exact(spark, keys, bits):
    df = spark.createDataFrame([(k,) for k in keys], "k BIGINT")
    known = sorted(k for k in keys if k is not None)
    for share in (0.0, 0.3, 1.0):
        place = (len(known) - 1) * Fraction(share)
        low, high = known[int(place)], known[-int(-place // 1)]
        want = float(low + (place - int(place)) * (high - low))
        assert quality.quantile(df, "k", share, bits) == pytest.approx(want, rel=1e-12)


def test_quantile_of_nothing(spark):
    assert quality.quantile(spark.createDataFrame([(None,)], "k BIGINT"), "k", 0.9) is None


def test_last_orders_below_zero(spark, tmp_path):
    """The SQL takes the floor of the quantile; a cast takes -1.9 to -1 and loses a row."""
    spark.createDataFrame([(k,) for k in range(-10, 0)], "l_orderkey BIGINT").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert sorted(r.l_orderkey for r in queries._last_orders(spark, str(tmp_path)).collect()) == [-2, -1]


def test_last_orders_gather_no_keys(spark, tmp_path, monkeypatch):
    """No step may bring all distinct keys into one task, as the exact percentile does."""
    spark.range(1000).withColumnRenamed("id", "l_orderkey").write.parquet(f"{tmp_path}/lineitem.parquet")

    def gathers(*_):
        raise AssertionError("percentile")

    monkeypatch.setattr(queries.F, "percentile", gathers)
    assert queries._last_orders(spark, str(tmp_path)).count() == 101


def test_bars_are_made_in_small_tasks(spark, monkeypatch):
    """The roll-up and the averages run with small tasks, the caller's settings come back, and the result joins stored averages."""
    name, seen, stored = "spark.sql.adaptive.advisoryPartitionSizeInBytes", [], store.materialise
    before = spark.conf.get(name)

    def watched(df, label="table", path=None):
        seen.append((label, spark.conf.get(name)))
        return stored(df, label, path)

    monkeypatch.setattr(store, "materialise", watched)
    assert queries.category_avg_window(spark, "/root/testdata/sf0.001").count() > 0
    assert seen == [("bars", "8m"), ("averages", "8m")]
    assert spark.conf.get(name) == before


def test_small_tasks_put_settings_back(spark):
    name = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(name, "99m")
    try:
        with pytest.raises(ValueError), store.small_tasks(spark):
            assert spark.conf.get(name) == "16m"
            raise ValueError
        assert spark.conf.get(name) == "99m"
    finally:
        spark.conf.unset(name)


def test_first_batch_spreads_a_hot_symbol(spark, tmp_path):
    """Without a state the join by symbol goes, but its shuffle stayed: all ticks of a symbol in one task."""
    ts = F.timestamp_seconds(F.col("id") * 60)
    spark.range(64).select(
        F.col("id").alias("event_id"), F.lit("a").alias("symbol"), ts.alias("ts"), F.col("id").cast("double").alias("price")
    ).write.parquet(f"{tmp_path}/ticks")
    state = spark.createDataFrame([], stream_ticks.STATE_SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        changes = stream_ticks.change_batch(spark.read.parquet(f"{tmp_path}/ticks"), state)
        rows = changes.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r.tick_change for r in rows) == [0.0] + [1.0] * 63
    assert len({r.task for r in rows}) > 1
