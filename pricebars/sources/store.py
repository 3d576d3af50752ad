"""Layer files: Parquet laid out for pruning, versions that change as a whole, CSV exports, and the shared scratch folder."""

import json
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if re.match(r"local(\[|$)", spark.sparkContext.master) is None:
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="pricebars-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{_SCRATCH.get() or shared_folder(spark)}/pricebars-{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """New folders of this block are removed at its end; what is to stay is written to a folder named before."""
    folder = new_folder(spark, "scratch")
    token = _SCRATCH.set(folder)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        remove(spark, folder)


def materialise(df: DataFrame, label: str = "table", path: str | None = None) -> DataFrame:
    """Write once and read back: cuts lineage and outlives lost executors."""
    path = path or new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: A task reads some megabytes, of a file or of a shuffle, and there are partitions enough for that in a large table.
_SMALL = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
}


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Queries that are run within this block have many small tasks instead of a few of 64 MB or more.

    For steps that make far more of a row in memory than the compressed bytes by which Spark merges partitions: their tasks would
    grow with the table up to that size.  The caller's settings are put back.
    """
    before = {name: spark.conf.get(name, None) for name in _SMALL}
    for name, value in _SMALL.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _hadoop(spark: SparkSession, path: str):
    """A path and its file system, whatever that is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder; one that isn't there is no error."""
    folder, system = _hadoop(spark, path)
    system.delete(folder, True)


class Versions:
    """Which folders the tables under ``root`` are in, changed as a whole.

    A version is one small file ``root/versions/<number>`` that names the folder of every table.  It is written aside and renamed
    when all its tables are there, so a reader sees the tables of one version or of another, never of a load under way
    or one that failed.  Two writers that start from the same version can't both finish: the second is refused.  Folders that
    only versions before the last ``KEEP`` name are removed; whoever reads for longer than that many loads starts again.
    """

    KEEP = 2

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.folder = spark, root, f"{root}/versions"

    def numbers(self) -> list[int]:
        folder, system = _hadoop(self.spark, self.folder)
        if not system.exists(folder):
            return []
        names = (status.getPath().getName() for status in system.listStatus(folder))
        return sorted(int(name) for name in names if name.isdigit())

    def tables(self, number: int) -> dict[str, str]:
        path, system = _hadoop(self.spark, f"{self.folder}/{number}")
        stream = system.open(path)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict[str, str]]:
        """Number and tables of the last version; version 0 has none."""
        numbers = self.numbers()
        return (numbers[-1], self.tables(numbers[-1])) if numbers else (0, {})

    def commit(self, tables: dict[str, str], after: int) -> None:
        """Make ``tables`` the version that follows ``after``."""
        target, system = _hadoop(self.spark, f"{self.folder}/{after + 1}")
        aside, _ = _hadoop(self.spark, f"{self.folder}/.{uuid.uuid4().hex}")
        stream = system.create(aside, False)
        stream.write(bytearray(json.dumps(tables), "utf-8"))
        stream.close()
        if system.exists(target) or not system.rename(aside, target):
            system.delete(aside, False)
            raise RuntimeError(f"version {after + 1} of {self.root} is there already: another load came first")
        self._forget()

    def _forget(self) -> None:
        numbers = self.numbers()
        old, kept = numbers[: -self.KEEP], numbers[-self.KEEP :]
        needed = {folder for n in kept for folder in self.tables(n).values()}
        for n in old:
            for folder in set(self.tables(n).values()) - needed:
                remove(self.spark, folder)
            remove(self.spark, f"{self.folder}/{n}")


def write_layer(df: DataFrame, path: str) -> None:
    """Full replacement of a layer that is read whole: one folder per timeframe, no extra shuffle."""
    df.write.mode("overwrite").partitionBy("timeframe").parquet(path)


def write_served(df: DataFrame, path: str, keys: list[str], blooms: tuple[str, ...] = ()) -> None:
    """Full replacement of a layer that is looked up by key, one folder per timeframe.

    Rows are range-partitioned and sorted, so a file covers one short key range and its row-group
    statistics prune look-ups by the first keys; no timeframe is written by a single task.  Columns in ``blooms``, which come later
    in that order, get a Bloom filter per row group.  Choosing the ranges samples ``df``, which runs it once more: pass a
    stored table or a cheap plan.
    """
    ordered = ["timeframe", *keys]
    writer = df.repartitionByRange(*ordered).sortWithinPartitions(*ordered).write.mode("overwrite").partitionBy("timeframe")
    for column in blooms:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Predictions or metrics as CSV, one folder per model and timeframe; symbols are spread over all tasks."""
    (
        df.repartition("symbol")
        .write.mode("overwrite").partitionBy("model_name", "timeframe").option("header", True).csv(path)
    )
