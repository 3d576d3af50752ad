"""Helpers shared by the operators: tables, words, and Arrow batches inside tasks."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the ASCII white space, as ``bytes.split`` has it.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5: the folds of the labelled queries; null without an id, which is learnt from nowhere."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5))


def held_out(fold: int) -> Column:
    """Whether a row is of the fold that a query doesn't learn from; one without an id is."""
    return F.coalesce(remainder() == fold, F.lit(True))


def texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column; null is empty."""
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def words(text: bytes) -> list[bytes]:
    """Words with A-Z in lower case; other letters stay as they are."""
    return text.lower().split()


def pieces(batches: Iterator[pa.RecordBatch], limit: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut so that none has over ``limit`` bytes in ``column``, unless a single row has."""
    for batch in batches:
        start = size = 0
        for i, n in enumerate(pa.compute.binary_length(batch.column(column)).to_pylist()):
            n = n or 0
            if size and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)
