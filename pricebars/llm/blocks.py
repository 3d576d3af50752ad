"""Blocks of numbers: sorted columns packed into one binary value, for rows that carry thousands of keys."""

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession

from pricebars.sources.store import new_folder

#: Spark removes the shuffle files of a query when the query ends, not when the driver happens to collect its garbage
#: (whatever is needed later has been written as a table by then), and sends few megabytes at a time to Python.
_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def pack(*columns: np.ndarray) -> bytes:
    """Columns of one length as one compressed block, byte planes apart, so that sorted keys take little room."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.dtype.itemsize).T).tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(block: bytes, *types: str) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8)
    widths = [np.dtype(t).itemsize for t in types]
    n, at, columns = len(raw) // sum(widths), 0, []
    for t, w in zip(types, widths):
        columns.append(np.ascontiguousarray(raw[at : at + n * w].reshape(w, n).T).view(t).reshape(n))
        at += n * w
    return columns


def stored(df: DataFrame, label: str, reading: dict[str, str] | None = None) -> DataFrame:
    """Write once, compressed well, and read back, with ``reading`` as options if there are any."""
    path = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.options(**reading or {}).schema(df.schema).parquet(path)


@contextmanager
def sparing(spark: SparkSession, more: dict[str, str] | None = None) -> Iterator[None]:
    """Within this block queries that are run keep little in memory and leave no shuffle files behind; ``more`` settings hold, too."""
    settings = _SETTINGS | (more or {})
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
