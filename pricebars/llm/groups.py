"""Keeping one row of each group of documents."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebars.sources.store import materialise, new_folder


def text_id(text: str = "text") -> list[Column]:
    """128 bits of a text, in two numbers; a null text has its own."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("text"), F.col(text)).alias("h2")]


def first_rows(docs: DataFrame, ids: DataFrame, path: str | None = None) -> DataFrame:
    """The rows of ``docs`` but for those of a group that come after its first.

    ``ids`` says ``id, h1, h2, component`` and the number ``n`` of rows for the ids and texts that are in a group.  A group's first
    row has the smallest id, null ids last, then the first text by hash; of rows with the same id and text the
    least by all columns stays.  Rows that are in no group stay.  The caller's columns, of any type and name, travel inside one
    struct.  What goes is written (to ``path``) and is all that meets the documents: a hot group is many small rows there, never
    one task's.
    """
    rank = F.struct(F.col("id").isNull().alias("nameless"), "id", "h1", "h2")
    first = ids.groupBy("component").agg(F.min(rank).alias("first"))
    ranked = ids.join(first, "component").withColumn("later", ~rank.eqNullSafe(F.col("first")))
    gone = ranked.where("later or n > 1").select("id", "h1", "h2", "later")
    gone = materialise(gone.withColumnsRenamed({"id": "_id", "h1": "_h1", "h2": "_h2"}), path=path or new_folder(docs.sparkSession, "gone"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), *text_id())
    same = F.expr("id <=> _id and h1 = _h1 and h2 = _h2")
    kept = rows.join(gone, same, "left_anti").select("row.*")
    repeated = gone.where("not later")
    if repeated.isEmpty():
        return kept
    one = rows.join(repeated, same, "left_semi").groupBy("id", "h1", "h2").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return kept.unionByName(one.select("row.*"))
