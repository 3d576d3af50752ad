"""Removal of repeated lines with levelled sorted runs of line hashes.  DataFrame functions only.

The runs are tables bucketed and sorted by a 128-bit hash of the line.  Documents come in batches.  A batch counts its
lines (partial sums before the shuffle: a line that is everywhere is one row per task) and is written as one sorted run; merging
it with the runs in an anti-join, bucket by bucket and without a shuffle, parts the lines that are new from those met before.  New lines
become a run of their own, so no line is in two runs; repeats go to runs of counts.  Whenever a level holds
``FANOUT`` runs they are merged into one of the next level, so a store of n batches has some log n runs, and every row is rewritten
log n times.  In the end the counts are added to the runs.

A line that enough documents hold goes wherever it stands but in the largest id.  These lines are joined with the
lines of the documents; the at most ``HEAVY`` lines that make up a thousandth of all copies are salted.  A document brings
back the numbers of its lines that go, never its text.

Odd inputs: every row is a document; rows that share the largest id all keep their lines, and a null id is smaller than any.
Null and empty texts are one empty line.  Lines are read whole, and a line that repeats inside one document counts once there.
An empty table gives no rows.  The caller's columns travel inside the struct ``row``, so no name of theirs can clash.
"""

import string
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebars.sources.store import materialise, new_folder, remove

#: Lines of so many code points count, once so many documents hold them.
SHORTEST, DOCUMENTS = 20, 3
#: Batches that a whole table is dealt in, by falling id, and runs of a level that are merged.
BATCHES, FANOUT = 4, 2
#: Lines that have a share of 1/HEAVY or more of all copies are joined in so many parts.
HEAVY, SALTS = 1_000, 64
_SPACE = " \t\n\x0b\x0c\r"
_HASH = ["h1", "h2"]


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key(line: Column) -> Column:
    """The line stripped of white space at both ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(_SPACE))
    plain = F.octet_length(bare) == F.char_length(bare)  # lower() is quicker, but knows more letters than A-Z
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def _hashes(of: Column) -> list[Column]:
    """128 bits in two numbers."""
    return [F.xxhash64(of).alias("h1"), F.xxhash64(F.lit("line"), of).alias("h2")]


def counted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """``h1, h2, docs, top``: each line's number of documents and their largest id."""
    found = F.filter(F.transform(lines(F.col(text)), key), lambda k: F.char_length(k) >= shortest)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.explode(F.array_distinct(found)).alias("key"))
    return rows.select("id", *_hashes(F.col("key"))).groupBy(*_HASH).agg(
        F.count(F.lit(1)).alias("docs"), F.max("id").alias("top")
    )


class Runs:
    """Sorted runs in levels: ``levels[i]`` are names of bucketed tables, each some ``FANOUT`` ** i batches."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout, self.levels, self.paths = spark, fanout, [], {}
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(self, rows: DataFrame) -> str:
        """A new run; whoever made ``rows`` has each bucket in one task, so a run is one sorted file a bucket."""
        name = f"run_{uuid.uuid4().hex}"
        path = self.paths[name] = new_folder(self.spark, "run")
        rows.write.bucketBy(self.buckets, *_HASH).sortBy(*_HASH).option("path", path).saveAsTable(name)
        return name

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def push(self, name: str, level: int = 0) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = self.merge(self.levels[level]), []
            self.push(merged, level + 1)

    def merge(self, names: Sequence[str]) -> str:
        """One run of several: buckets meet in sorted order, rows of one line are added."""
        rows = self.spark.table(names[0])
        for name in names[1:]:
            rows = added(rows, self.spark.table(name), "full")
        merged = self.write(rows)
        self.drop(names)
        return merged

    def all(self) -> DataFrame | None:
        """Everything as one run, or nothing."""
        names = [name for level in self.levels for name in level]
        if len(names) > 1:
            self.levels = [[self.merge(names)]]
        return self.tables()[0] if names else None

    def drop(self, names: Sequence[str] | None = None) -> None:
        for name in names or list(self.paths):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            remove(self.spark, self.paths.pop(name))


def added(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """Merge of two runs that adds the counts of a line and keeps the larger id."""
    b = b.withColumnsRenamed({"docs": "more", "top": "other"}).hint("merge")
    return a.join(b, _HASH, how).select(
        *_HASH, (F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("docs"), F.greatest("top", "other").alias("top")
    )


class LineStore:
    """Lines of all batches so far: runs of first sightings, no line in two of them, and runs of later counts."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.first, self.later = Runs(spark, fanout), Runs(spark, fanout)

    def add(self, batch: DataFrame) -> None:
        """``batch`` is ``h1, h2, docs, top`` of documents that weren't added before, one row a line."""
        own = self.first.write(batch)
        known = self.first.tables()
        if not known:
            self.first.push(own)
            return
        rows = self.first.spark.table(own)
        new = rows
        for run in known:
            new = new.join(run.select(*_HASH).hint("merge"), _HASH, "left_anti")
        new = self.first.write(new)
        again = rows.join(self.first.spark.table(new).select(*_HASH).hint("merge"), _HASH, "left_anti")
        self.later.push(self.later.write(again))
        self.first.push(new)
        self.first.drop([own])

    def lines(self, least: int = 1) -> DataFrame | None:
        """``h1, h2, docs, top`` of the lines that at least so many documents hold, written as a table of its own."""
        first, later = self.first.all(), self.later.all()
        if first is None:
            return None
        return materialise((added(first, later, "left") if later is not None else first).where(F.col("docs") >= least), "lines")

    def drop(self) -> None:
        self.first.drop()
        self.later.drop()


def batches(docs: DataFrame, number: int = BATCHES, doc_id: str = "doc_id") -> Iterator[DataFrame]:
    """The rows by falling id in about equal parts; a table in order of its ids is read once in all."""
    shares = [1 - i / number for i in range(1, number)]
    bounds = docs.agg(F.percentile_approx(F.col(doc_id).cast("long"), shares, 1000).alias("b")).first().b if shares else None
    bounds = sorted(set(bounds or []), reverse=True)
    this = F.col(doc_id)
    for i, low in enumerate(bounds):
        yield docs.where((this >= low) & (this < bounds[i - 1]) if i else this >= low)
    yield docs.where(this.isNull() | (this < bounds[-1])) if bounds else docs


def repeated(docs: DataFrame, least: int = DOCUMENTS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``h1, h2, docs, top`` of the lines that at least ``least`` documents hold, by way of a store of its own."""
    store = LineStore(docs.sparkSession)
    try:
        for batch in batches(docs, doc_id=doc_id):
            store.add(counted(batch, doc_id, text))
        return store.lines(least)
    finally:
        store.drop()


def without(
    docs: DataFrame, found: DataFrame, carried: Sequence[str] = ("doc_id",),
    doc_id: str = "doc_id", text: str = "text", shortest: int = SHORTEST,
) -> DataFrame:
    """``row`` (a struct of the ``carried`` columns), ``n_lines, n_dropped, kept`` of all documents.

    The lines in ``found`` go from every document but those whose id is ``top``.
    """
    copies = found.agg(F.sum("docs")).first()[0] or 0
    heavy = F.col("docs") * HEAVY >= copies  # at most HEAVY lines
    given = docs.select(F.struct(*carried).alias("row"), F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    names = [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit("text"), "text").alias("t2")]  # equal rows lose equal lines
    parts = given.select("id", *names, F.posexplode(lines(F.col("text"))).alias("pos", "line"))
    parts = parts.select("id", "t1", "t2", "pos", key(F.col("line")).alias("key")).where(F.char_length("key") >= shortest)
    parts = parts.select("id", "t1", "t2", "pos", *_hashes(F.col("key")))
    hot = F.broadcast(found.where(heavy).select(*_HASH, F.lit(True).alias("hot")))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("t1", "id", "pos"), F.lit(SALTS))).otherwise(0)
    salts = F.when(heavy, F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    parts = parts.join(hot, _HASH, "left").withColumn("salt", salt)
    going = parts.join(found.select(*_HASH, "top", F.explode(salts).alias("salt")), [*_HASH, "salt"])
    going = going.where(~F.col("id").eqNullSafe(F.col("top")))
    # a document's own lines bound the set; equal rows share it
    gone = going.groupBy("id", "t1", "t2").agg(F.collect_set("pos").alias("gone"))
    gone = materialise(gone.withColumnsRenamed({"id": "_id", "t1": "_t1", "t2": "_t2"}), "gone")
    split = given.select("row", "id", *names, lines(F.col("text")).alias("lines"))
    split = split.join(gone, F.expr("id <=> _id AND t1 = _t1 AND t2 = _t2"), "left")
    left = F.array_except(F.sequence(F.lit(1), F.size("lines")), F.transform("gone", lambda p: p + 1))
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.transform(left, lambda p: F.element_at("lines", p)))
    number = F.size("lines")
    return split.select(
        "row", number.cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("kept"),
    )


def dedup_lines(docs: DataFrame, carried: Sequence[str] = ("doc_id",)) -> DataFrame:
    """All documents without the lines that others repeat; see ``without``."""
    return without(docs, repeated(docs), carried)
