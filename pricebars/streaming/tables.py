"""Tables that a stream keeps: folders named by the micro-batch, so that writing a batch again replaces it."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricebars.sources.store import remove
from pricebars.sources.tables import read_or_empty


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def all_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_or_empty(spark, path, T.StructType([*schema.fields, T.StructField("batch", T.LongType())]))


#: So many segments of a level are merged into one of the next.
FAN = 8


class Log:
    """A keyed table as a log of changes that compacts itself.

    A batch writes the rows it changed, and nothing else, as a segment of level 0.  When ``FAN`` segments of a level are
    complete, the last version of each key in them becomes one segment of the next level.  A reader meets some
    FAN * log(batches) segments, and a row is written again log(batches) times, however large the table is.  Which
    segments there are depends on the batch's number alone, so a batch that runs again replaces what it wrote and finds
    what it found before.  Merged segments are removed ``FAN`` batches later, when no reader of the last state needs them.

    ``alive`` says which keys can still be asked for; the others are left out of what is read and of what is merged.  It has to
    be a condition on the keys that, once false for a key, stays false.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str]):
        self.spark, self.path, self.schema, self.keys = spark, path, schema, keys

    def _folder(self, level: int, segment: int) -> str:
        return f"{self.path}/level={level}/segment={segment}"

    def _versions(self) -> DataFrame:
        whole = [T.StructField("level", T.IntegerType()), T.StructField("segment", T.LongType())]
        rows = read_or_empty(self.spark, self.path, T.StructType([*self.schema.fields, *whole]))
        width = F.pow(F.lit(FAN), "level").cast("bigint")
        return rows.withColumn("last", (F.col("segment") + 1) * width - 1)

    def _newest(self, versions: DataFrame, alive: Column | None) -> DataFrame:
        if alive is not None:
            versions = versions.filter(alive)
        # a merged segment ends with the same batch as its last part, and goes before it
        versions = versions.withColumn("version", F.col("last") * 64 + F.col("level"))
        newest = versions.groupBy(*self.keys).agg(F.max("version").alias("version"))
        return versions.join(newest, [*self.keys, "version"]).select(*self.schema.names)

    def before(self, batch_id: int, alive: Column | None = None) -> DataFrame:
        """The last version of every key as it was before a batch."""
        return self._newest(self._versions().filter(F.col("last") < batch_id), alive)

    def current(self, alive: Column | None = None) -> DataFrame:
        return self._newest(self._versions(), alive)

    def written(self, batch_id: int) -> DataFrame:
        """What a batch has put."""
        return self.spark.read.schema(self.schema).parquet(self._folder(0, batch_id))

    def put(self, changed: DataFrame, batch_id: int, alive: Column | None = None) -> None:
        """The new versions of some keys, one row a key; then the merges that this batch completes."""
        changed.select(*self.schema.names).write.mode("overwrite").parquet(self._folder(0, batch_id))
        level, width = 1, FAN
        while (batch_id + 1) % width == 0:
            segment = (batch_id + 1) // width - 1
            parts = self._versions().filter(
                (F.col("level") == level - 1) & F.col("segment").between(segment * FAN, segment * FAN + FAN - 1)
            )
            self._newest(parts, alive).write.mode("overwrite").parquet(self._folder(level, segment))
            level, width = level + 1, width * FAN
        level, width = 1, FAN
        while batch_id >= FAN and (batch_id + 1 - FAN) % width == 0:
            first = ((batch_id + 1 - FAN) // width - 1) * FAN
            for segment in range(first, first + FAN):
                remove(self.spark, self._folder(level - 1, segment))
            level, width = level + 1, width * FAN
