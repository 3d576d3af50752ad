"""Embedding whitening on distributed block matrices.

Entries become whole numbers x = floor(1024 c) + 100000, so that counts and sums are exact.  The centred rows
(n x - S) / n get an index, become an ``IndexedRowMatrix`` and that a ``BlockMatrix`` of ``ROWS`` rows a block.  Its transpose times
itself is the scatter; the product is split along the rows, so that each task multiplies a few blocks and only
d x d sums meet.  The driver solves the eigenvalue problem of that d x d matrix, and one more block product with the
d x k whitening matrix projects the rows.  No vector passes through Python or the driver.

Odd inputs: a row whose vector is null, empty, or holds null or non-finite entries is dropped, and so is one whose
length isn't the commonest (of equally common ones the longer).  Rows may share an id, and a null id stays; each row is fitted and
returned by itself.  Components whose variance is below ``LEAST`` of the largest are noise of double precision and are not returned, so a
table of equal vectors gives no rows, nor does an empty one.  Entries beyond 2^52 are held there.  ``deviation`` is null where it
doesn't fit a long.
"""

from collections.abc import Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricebars.sources.store import materialise

SCALE, SHIFT = 1024.0, 100_000
COMPONENTS = 8
#: Rows of a block: 64 dimensions make half a megabyte.
ROWS = 1024
#: Columns of a block, for long vectors.
COLUMNS = 1024
#: Blocks that a task of the scatter multiplies at most.
SPLIT = 64
#: Variances below this share of the largest have no four digits left in double precision.
LEAST = 1e-10
_MOST = float(1 << 52)


def whole(vector: str | Column) -> Column:
    """The entries as long numbers."""

    def one(c):
        scaled = F.floor(F.lit(SCALE) * c.cast("double"))
        return F.greatest(F.least(scaled.cast("double"), F.lit(_MOST)), F.lit(-_MOST)).cast("long") + F.lit(SHIFT).cast("long")

    return F.transform(vector, one)


def usable(vector: str = "embedding") -> Column:
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.coalesce(F.col(vector).isNotNull() & finite & (F.size(vector) > 0), F.lit(False))


def blocks(rows: DataFrame, number: int, width: int, high: int, wide: int) -> BlockMatrix:
    """``index, values`` as a block matrix of ``high`` times ``wide``; the rows stay in the JVM."""
    vectors = rows.select("index", array_to_vector("values").alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), number, width).toBlockMatrix(high, wide)


def scatter(rows: BlockMatrix, splits: int) -> np.ndarray:
    """The transpose times the rows as a local d x d matrix, from ``splits`` sums of their own."""
    product = rows.transpose()._java_matrix_wrapper.call("multiply", rows._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, COLUMNS, COLUMNS).toLocalMatrix().toArray()


def components(covariance: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and their unit vectors as columns; the largest entry of a vector is positive."""
    value, vector = np.linalg.eigh((covariance + covariance.T) / 2)
    value, vector = value[::-1], vector[:, ::-1]
    use = np.flatnonzero(value > max(LEAST * value.max(initial=0.0), 0.0))[:most]
    value, vector = value[use], vector[:, use]
    return value, vector * np.sign(vector[np.abs(vector).argmax(axis=0), np.arange(len(value))])


def project(rows: BlockMatrix, matrix: np.ndarray) -> DataFrame:
    """``index, values`` of the rows times a local matrix of few columns."""
    spark = SparkSession.active()
    local = spark.createDataFrame(list(enumerate(matrix.tolist())), "index long, values array<double>")
    product = rows.multiply(blocks(local, *matrix.shape, COLUMNS, COLUMNS)).toIndexedRowMatrix()
    found = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
    return found.select("index", vector_to_array("vector").alias("values"))


def _numbered(rows: DataFrame) -> DataFrame:
    """Written ``rows`` with ``index`` = 0, 1, 2 ... from the ``place`` (partition and row in it) they were written with."""
    part = F.shiftright("place", 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each task that wrote
    starts = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    index = F.col("start") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(F.broadcast(starts), part == F.col("part")).withColumn("index", index).drop("part", "start", "place")


def whiten(
    table: DataFrame, carried: Sequence[str] = ("vec_id",), vector: str = "embedding", most: int = COMPONENTS
) -> DataFrame:
    """``row`` (a struct of the ``carried`` columns), ``component, n, deviation, whitened, explained, identity_error``.

    One row for each usable vector and component up to ``most``; the covariance has the divisor n.
    """
    given = table.select(F.struct(*carried).alias("row"), F.col(vector).alias("vector")).where(usable("vector"))
    lengths = given.groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("width")).first()
    width, n = (common.width, common.n) if common else (0, 0)
    x = given.where(F.size("vector") == width).select("row", whole("vector").alias("x"))
    x = materialise(x.withColumn("place", F.monotonically_increasing_id()), "whole")
    sums = x.select(F.posexplode("x")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("sum"))
    total = [int(r["sum"]) for r in sums.orderBy("pos").collect()]  # one for each dimension

    exact = F.array(*[F.lit(s if abs(s) < 1 << 63 else None).cast("long") for s in total])
    count = F.lit(n).cast("long")
    apart = F.zip_with("x", exact, lambda a, s: F.try_subtract(F.try_multiply(count, a), s))
    deviation = F.aggregate("apart", F.lit(0).cast("long"), lambda sum_, a: F.try_add(sum_, F.try_multiply(a, a)))
    mean = F.array(*[F.lit(s / n) for s in total])
    rough = F.zip_with("x", mean, lambda a, m: a.cast("double") - m)
    centred = F.zip_with("apart", rough, lambda a, r: F.coalesce(a.cast("double") / F.lit(float(n)), r))
    if n:
        rows = x.select("row", "place", "x", apart.alias("apart"))
        rows = _numbered(rows.select("row", "place", deviation.alias("deviation"), centred.alias("values")))
        matrix = blocks(rows, n, width, ROWS, COLUMNS)
        number = -(-n // ROWS)
        splits = max(-(-number // SPLIT), min(number, 2 * table.sparkSession.sparkContext.defaultParallelism))
        covariance = scatter(matrix, splits) / n
        value, axes = components(covariance, most)
    if not n or not len(value):
        none = F.lit(None)
        return x.where("false").select(
            "row", none.cast("int").alias("component"), none.cast("long").alias("n"), none.cast("long").alias("deviation"),
            *[none.cast("double").alias(c) for c in ("whitened", "explained", "identity_error")],
        )
    whitened = project(matrix, axes / np.sqrt(value)).withColumnRenamed("values", "whitened")
    found = materialise(rows.select("row", "deviation", "index").join(whitened, "index").drop("index"), "whitened")
    pairs = [(i, j) for i in range(len(value)) for j in range(i + 1)]
    entry = [F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]).alias(f"c{i}_{j}") for i, j in pairs]
    identity_error = max(abs(c - (i == j)) for c, (i, j) in zip(found.agg(*entry).first(), pairs))
    share = F.array(*[F.lit(float(v)) for v in value / np.trace(covariance)])
    return found.select("row", "deviation", F.posexplode("whitened").alias("pos", "whitened")).select(
        "row", (F.col("pos") + 1).alias("component"), count.alias("n"), "deviation", "whitened",
        F.element_at(share, F.col("pos") + 1).alias("explained"), F.lit(float(identity_error)).alias("identity_error"),
    )
