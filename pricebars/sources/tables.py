"""Reading tables, and the three tick sources the queries run on.

A tick table has the columns ``symbol, ts, seq, price``; ``seq`` orders ticks that share a ``ts`` and is
left out where ``ts`` is unique per symbol.  ``ts`` is a DATE for sources that carry no time of day.
A profile table has one row ``symbol, name, category`` per symbol.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_SCHEMAS: dict[tuple[str, str], T.StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table; its schema is read from the files once per application, not by a job in every query."""
    path = f"{folder}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def fingerprint(spark: SparkSession, folder: str, names: list[str]) -> tuple:
    """Number, size and age of the tables' files, from a listing that reads none of them."""
    files = spark.read.format("binaryFile").load([f"{folder}/{name}.parquet" for name in names])
    return tuple(files.agg(F.count("path"), F.sum("length"), F.max("modificationTime")).first())


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, or no rows of the same schema when nothing has been written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def order_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as ticks of the customer's nation; many orders share a date."""
    orders = table(spark, folder, "orders")
    nation_of = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return orders.join(nation_of, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("n_name").alias("symbol"),
        F.col("o_orderdate").cast("date").alias("ts"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_totalprice").alias("price"),
    )


def nation_profiles(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("symbol"), F.col("n_name").alias("name"), F.col("r_name").alias("category")
    )


def event_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Events as ticks of the user; time stamps are unique, so no ``seq``."""
    return table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("symbol"),
        "ts",
        F.col("value").alias("price"),
    )


def customer_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("symbol"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("category"),
    )


def lineitem_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as unit-price ticks of the part; lines repeat, so ``seq`` holds every column that can differ."""
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").cast("string").alias("symbol"),
        F.col("l_shipdate").cast("date").alias("ts"),
        F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity").alias("seq"),
        (F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0))).alias("price"),
    )


def part_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("symbol"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
    )
