"""Near copies: word shingles, min-hash bands for candidates, the exact Jaccard similarity of every candidate, components.

Two texts whose shingle sets have similarity 0.8 agree on a band of 4 min-hashes with probability 0.41, so 20 bands miss
such a pair three times in 100,000, closer pairs more rarely.  Of the pairs that share a band those go on that agree on at
least ``FLOOR`` of all 80 min-hashes, which loses a pair at 0.8 about once in 100,000 times; their texts are compared in full.

No step puts out the pairs of a group.  First the min-hashes of a band span a forest of its likeliest pairs, at most one fewer
than it has members, and these are compared; nearly all near copies are in one component then, and bands within one
component are left out.  In the bands that are left the shingle sets themselves meet, each pair in the first
band it shares, and only links between different components leave, again as a forest.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebars.llm.blocks import sparing
from pricebars.llm.graph import components
from pricebars.llm.groups import first_rows, text_id
from pricebars.llm.runs import bounds, runs
from pricebars.llm.text import texts, words
from pricebars.sources.store import materialise, new_folder, scratch

SHINGLE = 5
LEAST = 0.8
BANDS, ROWS = 20, 4
#: Min-hashes, of all, that a candidate's texts agree on.
FLOOR = 48
SEED = 42
#: Texts of a band that are compared in one go.
RUN = 1024
_draw = np.random.default_rng(SEED)
_A = _draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingles(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of the different word shingles, ascending; a shorter text is one shingle, no words are none."""
    found = words(text)
    count = max(min(len(found), 1), len(found) - shingle + 1)
    each = (b" ".join(found[i : i + shingle]) for i in range(count))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, each), np.uint64, count))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two ascending sets; nothing is like the empty one."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def minima(found: np.ndarray) -> np.ndarray:
    """The min-hashes of a set that is not empty."""
    least = np.full(len(_A), np.iinfo(np.uint64).max)
    for start in range(0, len(found), 1 << 12):
        part = found[None, start : start + (1 << 12)] * _A[:, None] + _B[:, None]
        least = np.minimum(least, part.min(axis=1))
    return least


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``keys`` of the bands and ``sketch``, two bytes of each min-hash; both null without words."""
    for batch in batches:
        keys, sketches = [], []
        for text in texts(batch.column("text")):
            found = shingles(text)
            if not len(found):
                keys.append(None)
                sketches.append(None)
                continue
            least = minima(found)
            keys.append([
                np.uint64(xxhash.xxh64_intdigest(r.tobytes(), i)).view(np.int64) for i, r in enumerate(least.reshape(BANDS, ROWS))
            ])
            # the top bits of a minimum are mostly zero, so all bits are mixed first
            sketches.append(((least * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.uint16).tobytes())
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"), "h1": batch.column("h1"), "h2": batch.column("h2"), "node": batch.column("h1"),
            "keys": pa.array(keys, pa.list_(pa.int64())), "sketch": pa.array(sketches, pa.binary()),
        })


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id, h1, h2, node, keys, sketch`` of every row: its id, 128 bits of its text, of which 64 are a node.

    Texts are read whole; null and empty ones, and those of white space, have neither keys nor sketch and are like nothing.
    Repeated rows are repeated; a null id stays null; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_id(), "text")
    return rows.mapInArrow(_signed, "doc_id long, h1 long, h2 long, node long, keys array<long>, sketch binary")


def _spanning(sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places that span the rows along their greatest agreement, where that reaches ``FLOOR``."""
    n = len(sketch)
    best, parent, left = np.full(n, -1), np.zeros(n, np.int64), np.ones(n, bool)
    place, first, second = 0, [], []
    for _ in range(n - 1):
        left[place] = False
        same = (sketch == sketch[place]).sum(axis=1)
        better = left & (same > best)
        best[better], parent[better] = same[better], place
        place = int(np.where(left, best, -2).argmax())
        if best[place] >= FLOOR:
            first.append(parent[place])
            second.append(place)
    return np.array(first, np.int64), np.array(second, np.int64)


def _sketches(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), BANDS * ROWS)


def _forests(run: int) -> Callable:
    """Likely pairs ``a, b`` of sorted ``key, node, sketch`` rows; a band's rows beyond ``run`` span forests of their own."""

    def forests(batches):
        for table, late in runs(batches, run):
            node, sketch = table.column("node").to_numpy(), _sketches(table.column("sketch"))
            starts, sizes = (np.array([0]), np.array([len(node)])) if late else bounds(table)
            first, second = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for start, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
                i, j = _spanning(sketch[start : start + size])
                first.append(node[start + i])
                second.append(node[start + j])
            yield pa.record_batch({"a": pa.array(np.concatenate(first)), "b": pa.array(np.concatenate(second))})

    return forests


def _similarities(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Jaccard similarity of an ascending set with others, none empty."""
    sizes = np.array([len(o) for o in others])
    flat = np.concatenate(others)
    hit = one[np.minimum(np.searchsorted(one, flat), len(one) - 1)] == flat
    both = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes) - sizes)
    return both / (len(one) + sizes - both)


def _met(key: int, rows: dict, chunk: np.ndarray | None, least: float) -> list[tuple[int, int]]:
    """Links between different components of the rows of one band; of two chunks only those from one to the other."""
    node, label = rows["node"], rows["component"].copy()
    sketch, keys = rows["sketch"], rows["keys"]
    sets, found = [np.frombuffer(s, np.uint64) for s in rows["shingles"]], []
    for i in range(len(node) - 1):
        likely = (label[i + 1 :] != label[i]) & ((sketch[i + 1 :] == sketch[i]).sum(axis=1) >= FLOOR)
        if chunk is not None:
            likely &= (chunk[i + 1 :] != chunk[i]) == (chunk.min() != chunk.max())
        other = np.flatnonzero(likely) + i + 1
        if len(other):
            shared = keys[other] == keys[i]
            other = other[keys[i][shared.argmax(axis=1)] == key]  # in the first band they share
        for part in np.array_split(other, -(-len(other) // 256)) if len(other) else []:
            alike = part[_similarities(sets[i], [sets[j] for j in part]) >= least]
            for j in alike.tolist():
                if label[j] != label[i]:
                    found.append((int(node[i]), int(node[j])))
                    label[label == label[j]] = label[i]
    return found


def _columns(table: pa.Table) -> dict:
    return {
        "node": table.column("node").to_numpy(), "component": table.column("component").to_numpy(),
        "sketch": _sketches(table.column("sketch")), "shingles": table.column("shingles").to_pylist(),
        "keys": np.array(table.column("keys").to_pylist(), np.int64).reshape(table.num_rows, BANDS),
    }


def _leftover(run: int, least: float) -> Callable:
    """Links ``a, b`` of sorted rows with their shingles; rows of bands beyond ``run`` give their ``key`` and ``node`` instead."""

    def leftover(batches):
        for table, late in runs(batches, run):
            if late:
                none = pa.nulls(table.num_rows, pa.int64())
                key, node = (table.column(c).combine_chunks() for c in ("key", "node"))
                yield pa.record_batch({"a": none, "b": none, "key": key, "node": node})
                continue
            starts, sizes = bounds(table)
            found = []
            for start, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
                part = table.slice(start, size)
                found += _met(part.column("key")[0].as_py(), _columns(part), None, least)
            none = pa.nulls(len(found), pa.int64())
            a, b = (pa.array([f[i] for f in found], pa.int64()) for i in (0, 1))
            yield pa.record_batch({"a": a, "b": b, "key": none, "node": none})

    return leftover


def _cells(late: DataFrame, rows: DataFrame, run: int, least: float) -> DataFrame:
    """Links within bands of more than ``run`` rows: every two chunks of a band meet in a cell."""
    chunks = late.groupBy("key").agg(F.ceil(F.count("node") * 4 / run).alias("n"))
    dealt = rows.join(chunks, "key").withColumn("c", F.pmod(F.xxhash64("node"), F.col("n")))
    met = dealt.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    met = met.withColumns({"x": F.least("c", "o"), "y": F.greatest("c", "o")}).drop("n", "o")

    def linked(table: pa.Table) -> pa.Table:
        found = _met(table.column("key")[0].as_py(), _columns(table), table.column("c").to_numpy(), least)
        return pa.table({n: pa.array([f[i] for f in found], pa.int64()) for i, n in enumerate("ab")})

    return met.groupBy("key", "x", "y").applyInArrow(linked, "a long, b long")


def _alike(least: float) -> Callable:
    def alike(batches):
        for batch in batches:
            first, second = texts(batch.column("first")), texts(batch.column("second"))
            good = [similarity(shingles(x), shingles(y)) >= least for x, y in zip(first, second)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return alike


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, text`` of some nodes, each once."""
    some = docs.select(F.xxhash64("text").alias("node"), "text").join(nodes, "node", "left_semi")
    return some.groupBy("node").agg(F.min("text").alias("text"))


def _verified(docs: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """The pairs ``a, b`` whose whole texts are alike; only texts of a pair are dealt."""
    spark = docs.sparkSession
    ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b")
    pairs = materialise(ordered.distinct(), "pairs")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    some = materialise(_texts(docs, nodes), "paired")
    first, second = (some.select(F.col("node").alias(n), F.col("text").alias(t)) for n, t in (("a", "first"), ("b", "second")))
    whole = pairs.join(first, "a").join(second, "b").select("a", "b", "first", "second")
    with sparing(spark):
        return materialise(whole.mapInArrow(_alike(least), "a long, b long"), "alike")


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingles(t).tobytes() for t in texts(batch.column("text"))]
        yield pa.record_batch({"node": batch.column("node"), "shingles": pa.array(found, pa.binary())})


def classes(docs: DataFrame, signs: DataFrame, least: float = LEAST, run: int = RUN) -> DataFrame:
    """``node, component`` of every node that has a near copy; ``signs`` are those of ``docs``, written.

    Equal texts are one node from here on, however many there are.  Should two texts ever share a node, which 64 bits allow,
    they are left out, and stay.  No words, no rows, no near copies: no rows.
    """
    each = signs.where("keys is not null").groupBy("node").agg(
        F.first("keys").alias("keys"), F.first("sketch").alias("sketch"), F.min("h2").alias("low"), F.max("h2").alias("high")
    ).where("low = high").drop("low", "high")
    keyed = each.select(F.explode("keys").alias("key"), "node")
    shared = keyed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("key")
    members = materialise(keyed.join(shared, "key", "left_semi"), "members")
    some = each.join(members.select("node").distinct(), "node", "left_semi")
    some = materialise(some, "members")

    def sorted_(rows: DataFrame) -> DataFrame:
        return rows.repartition("key").sortWithinPartitions("key", "node")

    likely = sorted_(members.join(some.select("node", "sketch"), "node").select("key", "node", "sketch"))
    links = _verified(docs, likely.mapInArrow(_forests(run), "a long, b long"), least)
    grouped = components(links, links.count()).withColumnRenamed("component", "found")
    known = members.join(grouped, "node", "left").select("key", "node", F.coalesce("found", "node").alias("component"))
    known = materialise(known, "known")
    mixed = known.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("key")
    rest = known.join(mixed, "key", "left_semi")
    with sparing(docs.sparkSession):
        sets = materialise(_texts(docs, rest.select("node").distinct()).mapInArrow(_shingled, "node long, shingles binary"), "sets")
        rest = rest.join(some, "node").join(sets, "node").select("key", "node", "component", "keys", "sketch", "shingles")
        found = materialise(sorted_(rest).mapInArrow(_leftover(run, least), "a long, b long, key long, node long"), "leftover")
        links, late = links.unionByName(found.where("a is not null").select("a", "b")), found.where("a is null").select("key", "node")
        if not late.isEmpty():
            links = links.unionByName(materialise(_cells(late, rest, run, least), "cells"))
    return components(links, links.count())


def drop(docs: DataFrame) -> DataFrame:
    """``docs`` without near copies: of texts linked by a similarity of ``LEAST`` or more the rows of the first stay.

    Which row is first, and what becomes of null ids, repeated rows and the caller's columns, says ``groups.first_rows``.
    """
    spark = docs.sparkSession
    path = new_folder(spark, "near")
    with scratch(spark):
        signs = materialise(signed(docs), "signs")
        grouped = classes(docs, signs).withColumnRenamed("node", "h1")
        ids = signs.groupBy(F.col("doc_id").alias("id"), "h1", "h2").agg(F.count(F.lit(1)).alias("n")).join(grouped, "h1")
        return first_rows(docs, ids, path)
