"""Mixing sources to target weights: repetition rates per source, whole copies plus one seeded Bernoulli copy.

Native DataFrame work only.  Sizes are added up per source before the shuffle, so a hot source sends one row per
task.  The rates are one row per source; they are broadcast only while their number is proven small, otherwise joined,
where adaptive execution splits a hot source.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricebars.llm.text import WORD
from pricebars.sources.store import materialise

#: Weights of the sources in code-point order (null last), repeating.
WEIGHTS = (3, 1, 2)
#: All targets together, as a share of all words.
SHARE = 1.5
#: A target is at most so many times its source's words.
MOST = 2.0
SEED = "mix-1"
#: Up to so many sources, of at most 1 kB each, the rates are broadcast (some 10 MB).
BROADCAST_SOURCES = 10_000


def size(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def rates(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, source_size, target, rate`` from ``source, size``.

    Targets are ``share`` of all words dealt out by weight; one that passes ``most`` times its source stops there
    and what is left goes to the others by weight, until none passes.  That is the water level L with
    sum(min(cap, weight * L)) = share: sources fill up in the order of cap/weight, so a running sum finds it.
    The running sum is over one row per source.  Sources without words have target and rate 0, a null source is one,
    and no rows give none.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(cycle, (rank % len(weights) + 1).cast("int"))
    capped = total.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("cap"))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) * share
        - F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    ) / F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    # a level holds if it doesn't fill the source it starts from; later sources give lower ones
    levels = capped.withColumn("level", level)
    holds = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    target = F.coalesce(F.least(F.max(holds).over(everything) * F.col("weight"), F.col("cap")), F.col("cap"))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most)))
    return levels.withColumn("target", target).select(
        "source", "source_size", "target", F.coalesce(rate, F.lit(0.0)).alias("rate")
    )


def uniform(seed: str = SEED, doc_id: str = "doc_id") -> Column:
    """A number in [0, 1) from the document's id, the same in every run; 52 bits of MD5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def _rated(docs: DataFrame, found: DataFrame, seed: str) -> DataFrame:
    """``row, source_size, target, rate, copies``: the caller's columns as one struct, which no name of ours can clash with."""
    found = materialise(found.withColumnRenamed("source", "_of"), "rates")
    if found.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        found = F.broadcast(found)
    rows = docs.select(F.struct("*").alias("row"))
    joined = rows.join(found, F.col("row.source").eqNullSafe(F.col("_of")), "left").drop("_of")
    whole = F.floor("rate")
    extra = (uniform(seed, "row.doc_id") < F.col("rate") - whole).cast("long")
    return joined.withColumn("copies", whole + extra)


def copies(docs: DataFrame, found: DataFrame, seed: str = SEED) -> DataFrame:
    """``docs`` with ``source_size, target, rate`` of the source and the number of ``copies`` to emit.

    Rows that share an id are drawn alike, and a null id is one.  A null source is a source; one that ``found`` doesn't know has nulls.
    Texts play no part.  Columns of ``docs`` that have one of these names are replaced; no rows give none.
    """
    new = ["source_size", "target", "rate", "copies"]
    own = [F.col("row")[c].alias(c) for c in docs.columns if c not in new]
    return _rated(docs, found, seed).select(*own, *new)


def mix(docs: DataFrame, found: DataFrame, seed: str = SEED) -> DataFrame:
    """The rows of ``docs``, all columns as they are, each as often as its source's rate asks for."""
    rows = _rated(docs, found, seed).where("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
