"""Bounded samples for fitting models, chosen by a hash of the id and so the same in every run."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents of more bytes are not sampled: so many documents times this bounds what a sample can hold.
LONGEST = 128 << 10


def bounded(ids: DataFrame, size: int, seed: int) -> DataFrame:
    """``size`` ids (``doc_id``) at most, each once, by hash; every task keeps ``size`` rows at most.

    Other columns are those of one of an id's rows, the greatest; a null id is never sampled.
    """
    more = [F.max(c).alias(c) for c in ids.columns if c != "doc_id"]
    once = ids.where("doc_id is not null").groupBy("doc_id").agg(*more) if more else ids.where("doc_id is not null").distinct()
    return once.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(size)


def with_text(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """The sampled ids with one text each, the least of theirs, if that has at most ``LONGEST`` bytes.

    The sample is bounded and is broadcast; however many rows share an id, one is left of them before anything is
    brought together.  An id whose only text is null has it.
    """
    given = [c for c in sample.columns if c != "doc_id"]
    found = docs.select("doc_id", "text").where(F.coalesce(F.octet_length("text"), F.lit(0)) <= LONGEST)
    found = found.join(F.broadcast(sample), "doc_id")
    return found.groupBy("doc_id", *given).agg(F.min("text").alias("text"))
