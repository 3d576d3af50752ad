"""Constraints as queries: each returns the violating keys, no rows when the table is sound."""

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: A pass of ``quantile`` counts in so many bits of the keys: some 2^14 rows come to the driver, whatever the table's size.
BITS = 14


def quantile(df: DataFrame, column: str, share: float, bits: int = BITS) -> float | None:
    """The exact quantile of a whole-number column, interpolated between two neighbours as ``percentile`` does.

    ``percentile`` brings every distinct value into one task.  Here each pass counts the keys by their leading bits and goes on with
    the one range that holds the wanted place: a pass over 14 bits, so two for a range of 2^28 keys and five for all.
    Nulls don't count; without any value there is no quantile.
    """
    keys = df.select(F.col(column).cast("bigint").alias("k")).filter(F.col("k").isNotNull())
    n, low, high = keys.agg(F.count("k"), F.min("k"), F.max("k")).first()
    if not n:
        return None
    place = (n - 1) * share
    rank, before, same = math.floor(place), 0, n
    while low < high:
        shift = max(0, (high - low).bit_length() - bits)
        near = keys.filter(F.col("k").between(F.lit(low), F.lit(high))).groupBy(F.shiftright("k", shift).alias("range"))
        for key, same in sorted(map(tuple, near.agg(F.count(F.lit(1))).collect())):
            if before + same > rank:
                break
            before += same
        low, high = max(low, key << shift), min(high, (key + 1 << shift) - 1)
    if place == rank or before + same > rank + 1:
        return float(low)
    above = keys.filter(F.col("k") > F.lit(low)).agg(F.min("k")).first()[0]
    return (rank + 1 - place) * low + (place - rank) * above


def touched(df: DataFrame, load: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``df`` whose keys occur in ``load``.

    First a filter that a scan can use: between the least and the greatest first key of the load, which skips the files and row groups
    of a table in the order of that key.  Then the exact semi-join with the load's distinct keys, to whose probe Spark
    adds a Bloom filter when it pays.  No null key: nulls are equal to nothing.
    """
    ends = load.agg(F.min(keys[0]).alias("low"), F.max(keys[0]).alias("high")).first()
    if ends.low is None:
        return df.limit(0)
    near = df.filter(F.col(keys[0]).between(F.lit(ends.low), F.lit(ends.high)))
    return near.join(load.select(*keys).distinct(), keys, "left_semi")


def violations_unique(df: DataFrame, keys: list[str], load: DataFrame | None = None) -> DataFrame:
    """Keys held by more than one row.  Counted on the map side first, so a hot key is one row per split.

    With ``load``, the rows that have just been added to ``df``, only the keys that they touch: what a growing table costs to check then
    follows the load and not the table.
    """
    rows = df if load is None else touched(df, load, keys)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def violations_fk(
    child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None, load: DataFrame | None = None
) -> DataFrame:
    """Child keys without a parent, with the number of rows that carry them.

    The child is reduced to its distinct keys before the join, so no join task sees a hot key's rows.  With ``load`` only the
    child rows that have just been added are looked at, and of the parent only the keys that they use.
    """
    rows = child if load is None else load
    used = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_key or key).alias(key))
    known = (known if load is None else touched(known, load, [key])).distinct().withColumn("_known", F.lit(True))
    # An outer join, as an anti-join would be pushed below the branches of a union, where a constant key leaves no
    # equality to join on.
    return used.join(known, key, "left").filter(F.col("_known").isNull()).drop("_known")


def violations_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of missing values per required column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "n_null")


def violations_length(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Number of texts longer than the warehouse column allows, in one pass."""
    counts = df.agg(*[F.count_if(F.length(c) > n).alias(c) for c, n in limits.items()])
    return counts.unpivot([], list(limits), "column_name", "n_too_long")


def all_violations(parts: dict[str, DataFrame]) -> DataFrame:
    """Several checks as one table ``check_name, key, n``."""
    labelled = []
    for name, part in parts.items():
        keys = [c for c in part.columns if c != "n"]
        key = F.concat_ws("|", *[F.col(c).cast("string") for c in keys])
        labelled.append(part.select(F.lit(name).alias("check_name"), key.alias("key"), "n"))
    return reduce(lambda a, b: a.unionByName(b), labelled)
