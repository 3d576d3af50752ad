"""Bronze, silver and gold tables.  Audit time stamps are parameters; nothing here reads the clock."""

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricebars.operators.reshape import normalise
from pricebars.schema import BRONZE_COLUMNS, FACT_COLUMNS, PREDICTION_COLUMNS, SILVER_COLUMNS
from pricebars.sources.store import materialise

RENAMES = {
    "country_code": "symbol",
    "country_name": "name",
    "commodity_name": "name",
    "commodity_category": "category",
}


def _stamp(df: DataFrame, column: str, at: datetime) -> DataFrame:
    return df.withColumn(column, F.lit(at).cast("timestamp"))


def bronze(long: DataFrame, at: datetime) -> DataFrame:
    """Raw long rows as they came, symbols upper-cased, dates typed."""
    renamed = long.withColumnsRenamed({k: v for k, v in RENAMES.items() if v not in long.columns})
    rows = renamed.withColumns(
        {"symbol": F.upper("symbol"), "time_index": F.col("time_index").cast("date")}
    ).select(*BRONZE_COLUMNS)
    return _stamp(rows, "ingested_at", at)


def silver(enriched: DataFrame, at: datetime) -> DataFrame:
    """Cleaned bars: the known columns that exist, in fixed order."""
    rows = normalise(enriched, RENAMES).withColumn("time_index", F.col("time_index").cast("date"))
    return _stamp(rows.select(*[c for c in SILVER_COLUMNS if c in rows.columns]), "loaded_at", at)


def distinct_symbols(df: DataFrame) -> DataFrame:
    """One row per symbol; name and category of its earliest bar win.

    Distinct (symbol, name, category) come first, in a hash table, which leaves next to nothing for the
    struct minimum to sort.
    """
    seen = normalise(df, RENAMES).groupBy("symbol", "name", "category").agg(F.min("time_index").alias("since"))
    first = F.min(F.struct("since", "name", "category")).alias("first")
    return seen.groupBy("symbol").agg(first).select("symbol", "first.name", "first.category")


def dense_ids(df: DataFrame, order: str) -> DataFrame:
    """``id`` = 1..n in the order of a unique column, without sorting everything in one task.

    Rows are range-partitioned and sorted, then written, which freezes the ranges: a plan that is run
    again samples other ranges.  Only one count per partition then goes through a single-task window.
    """
    position = F.monotonically_increasing_id()
    frozen = materialise(
        df.repartitionByRange(order).sortWithinPartitions(order)
        .withColumns({"part": F.shiftright(position, 33), "row": position.bitwiseAND(F.lit((1 << 33) - 1))}),
        "ids",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = frozen.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")
    )
    # At most one row per shuffle partition, however large the dimension: safe to broadcast.
    return frozen.join(F.broadcast(starts), "part").select(
        (F.col("start") + F.col("row") + 1).alias("id"), *df.columns
    )


def build_dim(df: DataFrame) -> DataFrame:
    return dense_ids(distinct_symbols(df), "symbol").select("id", "symbol", "name", "category")


def build_fact(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Bars keyed by the surrogate id; symbols the dimension does not know are dropped."""
    rows = normalise(df, RENAMES)
    keyed = rows.join(dim.select("id", "symbol"), "symbol")
    return keyed.select(*[c for c in FACT_COLUMNS if c in keyed.columns])


def gold(enriched: DataFrame, dim: DataFrame, at: datetime) -> DataFrame:
    return _stamp(build_fact(enriched, dim), "loaded_at", at)


def prediction_fact(predictions: DataFrame, dim: DataFrame, run_at: datetime) -> DataFrame:
    """Forecasts keyed by the surrogate id, values as DECIMAL(18,4).

    ``fit_scope`` keeps forecasts fitted on the whole history apart from those fitted without the
    hold-out, so that neither replaces the other.
    """
    money = {c: F.col(c).cast("decimal(18,4)") for c in ("predicted_value", "confidence_low", "confidence_high")}
    rows = predictions.join(dim.select("id", "symbol"), "symbol").withColumns(money)
    return _stamp(rows.select(*PREDICTION_COLUMNS, "fit_scope"), "run_at", run_at)
