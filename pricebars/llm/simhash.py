"""SimHash near-duplicates: 64-bit fingerprints, pigeonhole blocks, exact Hamming check, components.

Exact copies share a fingerprint and are one row from the first step on, so a group of copies, however large, is
no hot key.  Two fingerprints that differ in at most 3 of 64 bits agree on at least 3 of 6 blocks: every choice of
3 blocks (20 tables, keys of 31 to 33 bits) is a join key.  A key's fingerprints meet in one run of a sorted
partition, are compared there, and leave as a spanning forest rather than as pairs.  A key with more than
``RUN`` fingerprints is dealt out again in cells of two chunks, so that no task holds it.
"""

from collections.abc import Callable
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebars.llm.graph import components
from pricebars.llm.groups import first_rows, text_id
from pricebars.llm.runs import bounds, forest, runs
from pricebars.llm.text import texts, words
from pricebars.sources.store import materialise, new_folder, scratch

SHINGLE = 3
SEED = 42
DISTANCE = 3
BLOCK_BITS = (11, 11, 11, 11, 10, 10)
#: Fingerprints of a key that are compared in one go: a million comparisons, 8 MB.
RUN = 1024


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit by bit the majority of the hashes of all word shingles, repeats included; 0 without words."""
    found = words(text)
    if not found:
        return 0
    if len(found) < shingle:
        joined = [b" ".join(found)]
    else:
        joined = map(b" ".join, zip(*[found[i:] for i in range(shingle)]))
    count = max(1, len(found) - shingle + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, joined, repeat(SEED)), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for start in range(0, count, 1 << 14):
        part = hashes[start : start + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, *more: Column) -> DataFrame:
    """``doc_id, fp`` of every row, with ``more`` before them; a null text has no words."""

    @F.arrow_udf("long")
    def prints(column: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t) for t in texts(column)], pa.int64())

    return docs.select(*more, F.col("doc_id").cast("long").alias("doc_id"), prints("text").alias("fp"))


def masks(bits: tuple[int, ...] = BLOCK_BITS, distance: int = DISTANCE) -> list[int]:
    """One mask for each choice of the blocks that ``distance`` differing bits must leave alone."""
    starts = np.cumsum((0, *bits)).tolist()
    block = [((1 << n) - 1) << s for n, s in zip(bits, starts)]
    chosen = [sum(c) for c in combinations(block, len(bits) - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits that differ; numpy counts those of signed numbers without their sign, so it gets unsigned ones."""
    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64))


def _near(fp: np.ndarray, distance: int) -> np.ndarray:
    return _apart(fp[:, None], fp[None, :]) <= distance


def _links(distance: int, run: int) -> Callable:
    """Links of sorted ``key, fp, rep`` rows: ``a, b`` are linked, or ``b`` is null and ``key, fp, a`` are put off."""

    def links(batches):
        for table, late in runs(batches, run):
            key, fp, rep = (table.column(c).to_numpy() for c in ("key", "fp", "rep"))
            if late:
                yield _rows(key, fp, rep, None)
                continue
            starts, sizes = bounds(table)
            two = starts[sizes == 2]
            two = two[_apart(fp[two], fp[two + 1]) <= distance]
            a, b = [rep[two]], [rep[two + 1]]
            for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                part = slice(start, start + size)
                first = forest(_near(fp[part], distance))
                linked = np.flatnonzero(first != np.arange(size))
                a.append(rep[part][linked])
                b.append(rep[part][first[linked]])
            yield _rows(None, None, np.concatenate(a), np.concatenate(b))

    return links


def _rows(key, fp, a, b) -> pa.RecordBatch:
    columns = {"key": key, "fp": fp, "a": a, "b": b}
    none = pa.nulls(len(a), pa.int64())
    return pa.record_batch({c: none if v is None else pa.array(v) for c, v in columns.items()})


def _cells(late: DataFrame, distance: int, run: int) -> DataFrame:
    """Links within keys of more than ``run`` fingerprints: every two chunks of a key meet in a cell."""
    chunks = late.groupBy("key").agg(F.ceil(F.count("fp") * 4 / run).alias("n"))
    dealt = late.join(chunks, "key").withColumn("c", F.pmod(F.xxhash64("fp"), F.col("n")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("o")
    cells = dealt.select("key", "fp", "a", "c", other)
    cells = cells.select("key", "fp", "a", F.least("c", "o").alias("x"), F.greatest("c", "o").alias("y"))

    def linked(rows: pd.DataFrame) -> pd.DataFrame:
        rep = rows["a"].to_numpy()
        first = forest(_near(rows["fp"].to_numpy(), distance))
        return pd.DataFrame({"a": rep, "b": rep[first]}).query("a != b")

    return cells.groupBy("key", "x", "y").applyInPandas(linked, "a long, b long")


def classes(
    prints: DataFrame, distance: int = DISTANCE, bits: tuple[int, ...] = BLOCK_BITS, run: int = RUN
) -> DataFrame:
    """``fp, component_id`` of every fingerprint of ``doc_id, fp``: the smallest doc_id reachable by links."""
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("rep")).where("rep is not null")
    each = materialise(least, "classes")
    keys = [F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(masks(bits, distance))]
    keyed = each.select(F.explode(F.array(*keys)).alias("key"), "fp", "rep")
    dealt = keyed.repartition("key").sortWithinPartitions("key")
    linked = dealt.mapInArrow(_links(distance, run), "key long, fp long, a long, b long")
    found = materialise(linked, "links")
    edges, late = found.where("b is not null").select("a", "b"), found.where("b is null")
    if not late.isEmpty():
        edges = edges.unionByName(_cells(late, distance, run))
    grouped = components(edges, found.count()).withColumnRenamed("node", "rep")
    joined = each.join(grouped, "rep", "left")
    return joined.select("fp", F.coalesce("component", "rep").alias("component_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id`` of every row of ``docs``.

    Null and empty texts and texts of white space have fingerprint 0 and are linked like any other.  Rows with the
    same doc_id stay separate rows, each with its own fingerprint; a row without doc_id takes part with a null
    component unless another row shares its fingerprint.  An empty table gives no rows.  Other columns are ignored.
    """
    prints = materialise(fingerprints(docs), "prints")
    joined = prints.withColumnRenamed("fp", "own").join(classes(prints), F.col("own") == F.col("fp"), "left")
    return joined.select("doc_id", F.col("own").alias("fp"), "component_id")


def hexadecimal(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def drop(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of linked fingerprints: the first, as ``groups.first_rows`` says.

    Groups are made of fingerprints, not of ids: rows that share an id but not a group go or stay by themselves, rows
    without an id are grouped like any other and come last, equal rows are one.
    """
    spark = docs.sparkSession
    path = new_folder(spark, "later")
    with scratch(spark):
        prints = materialise(fingerprints(docs, *text_id()).withColumnRenamed("doc_id", "id"), "prints")
        grouped = classes(prints.select(F.col("fp").alias("doc_id"), "fp")).withColumnRenamed("component_id", "component")
        ids = prints.groupBy("id", "h1", "h2", "fp").agg(F.count(F.lit(1)).alias("n")).join(grouped, "fp")
        return first_rows(docs, ids, path)
