from datetime import datetime

import pytest
from helpers import BARS, D, bar, one, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricebars.operators import layers, quality, reshape
from pricebars.plans.warehouse import Warehouse, export, load, predict
from pricebars.schema import BRONZE_COLUMNS, DIM_SCHEMA, FACT_SCHEMA, PREDICTION_SCHEMA, SILVER_COLUMNS

AT = datetime(2024, 1, 31)


def long_source(spark, source="feed", n=10):
    data = [
        (s, s.lower(), i, "day", D(f"2024-01-{k + 1:02d}"), float(k + 1 + shift), source)
        for shift, s in enumerate(("b", "A")) for k in range(n) for i in ("open_price", "high_price", "low_price", "close_price", "latest_price")
    ]
    return spark.createDataFrame(data, "symbol STRING, name STRING, indicator STRING, timeframe STRING, time_index DATE, value DOUBLE, source STRING")


def profiles(spark):
    return spark.createDataFrame([("A", "Alpha", "X"), ("B", "Beta", None)], "symbol STRING, name STRING, category STRING")


def test_bronze_renames_and_upper_cases(spark):
    old = long_source(spark, n=1).withColumnsRenamed({"symbol": "country_code", "name": "country_name"}).withColumn(
        "time_index", F.col("time_index").cast("string")
    )
    got = layers.bronze(old, AT)
    assert got.columns == [*BRONZE_COLUMNS, "ingested_at"]
    assert {r.symbol for r in got.collect()} == {"A", "B"}
    assert got.schema["time_index"].dataType == T.DateType()


def test_silver_keeps_known_columns_in_order(spark):
    df = spark.createDataFrame([bar("a", "day", "2024-01-01", 1.0, 1.0, 1.0, 1.0)], BARS).withColumn("junk", F.lit(1))
    got = layers.silver(df, AT)
    assert got.columns == [c for c in SILVER_COLUMNS if c in got.columns] + ["loaded_at"]
    assert one(got).category == "Other" and one(got).symbol == "A"


def test_normalise_leaves_present_columns_alone(spark):
    df = spark.createDataFrame([("old", "new", "c")], "country_code STRING, symbol STRING, category STRING")
    assert one(reshape.normalise(df, layers.RENAMES)).symbol == "NEW"


def test_dimension_ids_are_dense_and_first_name_wins(spark):
    df = spark.createDataFrame(
        [("B", "late", "x", D("2024-02-01")), ("B", "early", "y", D("2024-01-01")), ("a", "n", "z", D("2024-01-01"))],
        "symbol STRING, name STRING, category STRING, time_index DATE",
    )
    assert rows(layers.build_dim(df), "id") == [(1, "A", "n", "z"), (2, "B", "early", "y")]


def test_dense_ids_over_many_partitions(spark):
    df = spark.range(5000).select(F.format_string("S%05d", F.col("id")).alias("symbol")).repartition(13)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = layers.dense_ids(df, "symbol")
        assert got.agg(F.count_distinct("id"), F.min("id"), F.max("id")).collect()[0][:] == (5000, 1, 5000)
        assert got.filter(F.col("symbol") != F.format_string("S%05d", F.col("id") - 1)).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_fact_drops_unknown_symbols(spark):
    df = spark.createDataFrame([bar(s, "day", "2024-01-01", 1.0, 1.0, 1.0, 1.0) for s in "AZ"], BARS)
    dim = spark.createDataFrame([(1, "A", "a", "x")], DIM_SCHEMA)
    assert [r.id for r in layers.build_fact(df, dim).collect()] == [1]


def test_warehouse_end_to_end(spark, tmp_path):
    built = Warehouse(spark, str(tmp_path / "w"))
    assert built.prices.count() == 0 and built.predictions.count() == 0 and built.bronze.count() == 0
    second = long_source(spark, "better", 1).withColumn("value", F.lit(50.0)).filter("symbol = 'A' AND indicator = 'close_price'")
    upper = long_source(spark).withColumn("symbol", F.upper("symbol"))
    load(built, [upper, second], profiles(spark), AT, priority={"better": 1})
    assert built.bronze.count() == 101
    assert rows(built.dim, "id") == [(1, "A", "Alpha", "X"), (2, "B", "Beta", "Other")]
    first = one(built.prices.filter("symbol = 'A' AND time_index = date'2024-01-01'"))
    assert (first.close_price, first.price_trend) == (50.0, "new")
    assert built.fact.count() == 20
    load(built, [upper], profiles(spark), AT)
    assert built.bronze.count() == 100 and built.fact.count() == 20

    predict(built, AT)
    assert built.prediction_fact.count() == 2 * 5 * 2 * 3 * 2
    assert built.prediction_fact.schema["predicted_value"].dataType == T.DecimalType(18, 4)
    assert built.predictions.filter("run_at = timestamp'2024-01-31 00:00:00'").count() == 120
    full = built.predictions.filter("fit_scope = 'full' AND model_name = 'linear_trend' AND symbol = 'A' AND indicator = 'close_price'")
    assert [r.predicted_value for r in full.orderBy("predicted_time").collect()] == [12.0, 13.0, 14.0]
    held = built.predictions.filter("fit_scope = 'holdout'").agg(F.min("predicted_time")).collect()[0][0]
    assert held == D("2024-01-10")
    keys = ["fit_scope", "id", "timeframe", "indicator", "model_name", "predicted_time"]
    assert quality.violations_unique(built.prediction_fact, keys).count() == 0
    for table, schema in ((built.fact, FACT_SCHEMA), (built.prediction_fact, PREDICTION_SCHEMA)):
        assert dict(table.dtypes) == {f.name: f.dataType.simpleString() for f in schema}

    export(built, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv/predictions"))
    assert back.count() == 60 and {"model_name", "timeframe"} <= set(back.columns)


def test_quality_finds_planted_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "toolong")], "k INT, v STRING")
    assert rows(quality.violations_unique(df, ["k", "v"]), "k") == [(1, "a", 2)]
    parent = spark.createDataFrame([(1,)], "id INT")
    assert rows(quality.violations_fk(df, parent, "k", "id"), "k") == [(2, 1)]
    assert rows(quality.violations_null(df, ["k", "v"]), "column_name") == [("k", 1), ("v", 1)]
    assert rows(quality.violations_length(df, {"v": 3}), "column_name") == [("v", 1)]
    table = quality.all_violations({"u": quality.violations_unique(df, ["k", "v"]), "f": quality.violations_fk(df, parent, "k", "id")})
    assert rows(table, "check_name") == [("f", "2", 1), ("u", "1|a", 2)]


def test_query_warehouse_is_rebuilt_when_tables_change(spark, tmp_path):
    from pricebars.plans import queries
    from pricebars.sources.tables import table

    folder = str(tmp_path / "tables")
    for name in ("customer", "nation", "region"):
        table(spark, "/root/testdata/sf0.001", name).write.parquet(f"{folder}/{name}.parquet")
    orders = table(spark, "/root/testdata/sf0.001", "orders")
    orders.filter("o_orderdate >= timestamp_ntz'2000-01-01'").write.parquet(f"{folder}/orders.parquet")
    first = queries.warehouse(spark, folder)
    assert queries.warehouse(spark, folder) is first
    orders.filter("o_orderdate < timestamp_ntz'2000-01-01'").write.mode("append").parquet(f"{folder}/orders.parquet")
    second = queries.warehouse(spark, folder)
    assert second is not first
    assert second.fact.count() == queries.warehouse(spark, "/root/testdata/sf0.001").fact.count() > first.fact.count()


def small_load(spark, warehouse, value):
    load(warehouse, [long_source(spark, n=3).withColumn("value", F.lit(value))], profiles(spark), AT)


def test_readers_see_one_version_whole(spark, tmp_path):
    """During a load, and after one that failed half-way, readers see the version before; afterwards the new one."""
    built = Warehouse(spark, str(tmp_path / "w"))
    small_load(spark, built, 1.0)
    predict(built, AT)
    closes = lambda df: {r.close_price for r in df.collect()}
    reader = built.snapshot()
    with built.change() as new:
        small_load(spark, new, 2.0)
        assert closes(built.prices) == {1.0} and built.predictions.count() > 0 and closes(new.prices) == {2.0}
    assert closes(built.prices) == {2.0} and closes(built.latest) == {2.0}
    assert built.predictions.count() == 0  # they belong to the ids of the version before
    assert closes(reader.prices) == {1.0} and reader.predictions.count() > 0  # it began before and goes on

    class Killed(Exception):
        pass

    with pytest.raises(Killed):
        with built.change() as new:
            small_load(spark, new, 3.0)
            raise Killed
    assert closes(built.prices) == {2.0} and built.bronze.count() == 30


def test_two_loads_at_once_are_refused_and_old_versions_go(spark, tmp_path):
    from pricebars.sources.store import Versions

    built = Warehouse(spark, str(tmp_path / "w"))
    with pytest.raises(RuntimeError):
        with built.change() as slow:
            small_load(spark, slow, 1.0)
            small_load(spark, built, 2.0)
    assert built.fact.select("close_price").distinct().collect()[0][0] == 2.0
    for value in (3.0, 4.0, 5.0):
        small_load(spark, built, value)
    versions = Versions(spark, built.root)
    assert versions.numbers() == [3, 4]
    assert len(list((tmp_path / "w/gold/fact").iterdir())) == 2 + 1  # two versions, and the load that was refused


def test_latest_rows_are_kept_by_the_load(spark, tmp_path):
    from pricebars.operators import serve

    built = Warehouse(spark, str(tmp_path / "w"))
    load(built, [long_source(spark)], profiles(spark), AT)
    assert rows(built.latest, "symbol") == rows(serve.latest_snapshot(built.prices, "day"), "symbol")
    assert built.latest_fact.count() == 2


def test_constraints_on_a_load_look_at_its_keys_only(spark, tmp_path):
    old = spark.createDataFrame([(i, i % 7) for i in range(100)] + [(3, 3)], "k INT, v INT")
    new = spark.createDataFrame([(98, 5), (200, 1), (None, 1)], "k INT, v INT")
    old.unionByName(new).repartitionByRange(4, "k").write.parquet(str(tmp_path / "t"))
    whole = spark.read.parquet(str(tmp_path / "t"))
    found = quality.violations_unique(whole, ["k"], new)
    assert rows(found, "k") == [(98, 2)]  # 3 was there twice before
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,98)" in plan and "LessThanOrEqual(k,200)" in plan
    parent = spark.range(150).select(F.col("id").cast("int").alias("id"))
    assert rows(quality.violations_fk(whole, parent, "k", "id", new), "k") == [(200, 1)]
    assert quality.violations_unique(whole, ["k"], new.limit(0)).count() == 0


def test_a_constant_key_in_a_union_is_joined_by_equality(spark):
    child = spark.range(5).unionByName(spark.range(2).select(F.lit(-1).cast("long").alias("id")))
    found = quality.violations_fk(child, spark.range(4), "id")
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found, "id") == [(-1, 2), (4, 1)]
