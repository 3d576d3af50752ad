"""Long <-> wide, unions, schema conformance and deterministic de-duplication."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricebars.functions.numeric import clean_double
from pricebars.schema import BAR_KEY, INDICATORS, LONG_SCHEMA


def to_long(bars: DataFrame) -> DataFrame:
    """Wide bars -> one row per price that is there."""
    ids = [c for c in bars.columns if c not in INDICATORS]
    return bars.unpivot(ids, INDICATORS, "indicator", "value").filter(F.col("value").isNotNull())


def to_series_rows(prices: DataFrame) -> DataFrame:
    """Fact rows -> one row per metric, missing values kept."""
    return prices.select(*BAR_KEY, *INDICATORS).unpivot(BAR_KEY, INDICATORS, "indicator", "value")


def to_wide(long: DataFrame, priority: dict[str, int] | None = None) -> DataFrame:
    """Long -> one bar per symbol, timeframe and time_index, in one shuffle of the rows.

    When several sources report the same price, the one with the highest priority wins, then the last source
    name, then the larger value.  The feeds are few and are asked for first (``long`` should be a stored table, of which that
    reads one column).  Up to ``WIDE_FEEDS`` of them each have their own maximum per price, which is combined before the
    shuffle, and the first feed that has one wins.  More are numbered, and both steps aggregate scalars in
    hash tables.  Names are not part of the key; see ``source_names``.
    """
    prices = sorted(INDICATORS)
    rows = long.withColumn("source", F.coalesce("source", F.lit(""))).filter(F.col("value").isNotNull())
    sources = rows.select("source").distinct()
    names = [r.source for r in sources.limit(WIDE_FEEDS + 1).collect()] or [""]
    rank = priority or {}
    if len(names) <= WIDE_FEEDS:
        feeds = list(enumerate(sorted(names, key=lambda name: (rank.get(name, 0), name.encode()), reverse=True)))
        own = [
            F.max(F.when((F.col("indicator") == i) & (F.col("source") == name), F.col("value"))).alias(f"{i}_{k}")
            for i in prices for k, name in feeds
        ]
        picked = [F.coalesce(*[F.col(f"{i}_{k}") for k, _ in feeds]).alias(i) for i in prices]
        return rows.groupBy(*BAR_KEY).agg(*own).select(*BAR_KEY, *picked)
    weight: Column = F.lit(0)
    for source, given in rank.items():
        weight = F.when(F.col("source") == source, F.lit(given)).otherwise(weight)
    place = F.row_number().over(Window.orderBy(weight, "source"))  # one row per feed
    largest = (
        rows.join(sources.select("source", place.alias("place")), "source").repartition(*BAR_KEY)
        .groupBy(*BAR_KEY, "indicator", "place").agg(F.max("value").alias("value"))
    )
    picked = [F.max_by("value", F.when(F.col("indicator") == i, F.col("place"))).alias(i) for i in prices]
    return largest.groupBy(*BAR_KEY).agg(*picked)


#: Feeds that get maxima of their own in the pivot; its plan has five columns for each.
WIDE_FEEDS = 8


def source_names(long: DataFrame) -> DataFrame:
    """The name that the sources give each symbol: the first by alphabet, of those that aren't empty."""
    named = long.filter(F.col("name") != "").select("symbol", "name").distinct()
    return named.groupBy("symbol").agg(F.min("name").alias("name"))


def union_sources(frames: list[DataFrame]) -> DataFrame:
    if not frames:
        raise ValueError("no sources to union")
    return reduce(lambda a, b: a.unionByName(b), frames)


def conform_long(raw: DataFrame) -> DataFrame:
    """Any seven-column source -> the long schema; text 'nan' in symbol and name is empty text."""
    def text(name: str) -> Column:
        return F.col(name).cast("string").alias(name)

    def label(name: str) -> Column:
        value = F.col(name).cast("string")
        return F.when(value.isNull() | (F.lower(value) == "nan"), F.lit("")).otherwise(value).alias(name)

    return raw.select(
        label("symbol"), label("name"), text("indicator"), text("timeframe"),
        F.col("time_index").try_cast("date").alias("time_index"),
        clean_double(F.col("value")).alias("value"), text("source"),
    ).select(*LONG_SCHEMA.names)


def nan_to_null(df: DataFrame) -> DataFrame:
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floating else F.col(c) for c in df.columns]
    )


def order_columns(df: DataFrame) -> DataFrame:
    """Key columns first, then the rest, each alphabetical."""
    keys = [c for c in ("name", *BAR_KEY) if c in df.columns]
    return df.select(*sorted(keys), *sorted(c for c in df.columns if c not in keys))


def normalise(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Old column names to new ones where the new one is absent; symbols upper-cased; category filled."""
    from pricebars.functions.reference_data import FALLBACK_CATEGORY

    todo = {old: new for old, new in renames.items() if old in df.columns and new not in df.columns}
    out = df.withColumnsRenamed(todo).withColumn("symbol", F.upper("symbol"))
    if "category" not in out.columns:
        out = out.withColumn("category", F.lit(FALLBACK_CATEGORY))
    return out


def dedupe(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key in the given order.

    Reduced on the map side, so a key with many copies sends one row per split.  ``order`` should make
    rows of a key distinguishable, or cover all columns that matter.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min(F.struct(*order, F.struct(*rest).alias("row"))).alias("first")
    return df.groupBy(*keys).agg(first).select(*keys, "first.row.*").select(*df.columns)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as they pass, without a job of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
