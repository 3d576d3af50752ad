"""Connected components by alternating large and small stars, on written edge tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebars.sources.store import materialise

#: Rows of a few numbers that make a file.
FILE_ROWS = 500_000


def files(rows: int) -> int:
    return max(1, -(-rows // FILE_ROWS))


def components(edges: DataFrame, rows: int) -> DataFrame:
    """``node, component`` (smallest node reachable) of every node that has an edge; ``edges`` are ``a, b``, about ``rows``.

    Nulls and loops are ignored, repeated edges count once, no edges give no rows.  Each round writes its
    edges, in files of some ``FILE_ROWS``; the rounds grow with the logarithm of the number of nodes.  A node of very high
    degree is a hot key of a join only, which adaptive execution splits; minima are combined before the shuffle.
    """
    forward = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = materialise(forward.distinct().coalesce(files(rows)), "edges")
    seen = _state(current)
    while seen[0]:
        # a round has no more edges than the one before
        current = materialise(_small_star(_large_star(current)).coalesce(files(seen[0])), "edges")
        state = _state(current)
        if state == seen:
            break
        seen = state
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
