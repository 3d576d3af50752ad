"""Near-duplicate embeddings: Euclidean p-stable hashing into several tables, exact cosine checks, components.

A table hashes a normalised vector to the cells floor((a x + b) / W) of ``CELLS`` Gaussian projections.  A cosine of 0.98
is a distance of 0.2 on the unit sphere, where one projection agrees with probability 0.87 and a table of 8 with
0.34; 16 tables miss such a pair once in 700 times, closer pairs more rarely.  Vectors of the same label and cell are
compared in double precision, and a pair that shares several tables counts in the first of them only.

Equal vectors are one row with a weight from the first step on.  Cells are compared in runs of sorted partitions: each
vector leaves with its number of links and one edge of a spanning forest, never as pairs.  A cell with more than
``RUN`` different vectors is dealt out again in chunks that meet two by two, so no task holds it.
"""

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebars.llm.graph import components
from pricebars.llm.runs import bounds, forest, runs
from pricebars.sources.store import materialise

LEAST = 0.98
TABLES, CELLS, WIDTH = 16, 8, 1.25
SEED = 7
#: Vectors of a cell that are compared in one go.
RUN = 1024
_ROWS = "key long, table int, rep long, weight long, vector binary, codes binary"
_FOUND = f"{_ROWS}, links long, other long"


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; the largest component goes first, so that no square overflows."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def codes(units: np.ndarray) -> np.ndarray:
    """One 64-bit hash per vector and table of the cells that its projections fall in."""
    draw = np.random.default_rng(SEED)
    a, b = draw.standard_normal((units.shape[1], TABLES * CELLS)), draw.uniform(0, WIDTH, TABLES * CELLS)
    cell = np.floor((units @ a + b) / WIDTH).astype(np.int64).reshape(len(units), TABLES, CELLS).view(np.uint64)
    table = np.arange(1, TABLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)  # tables share no hash
    h = np.repeat(table[None, :], len(units), axis=0)
    for i in range(CELLS):
        h = (h ^ cell[:, :, i]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def usable(vec_id: str = "vec_id", label: str = "label", vector: str = "embedding") -> Column:
    """Whether a vector can link at all: with an id and a label, not zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    known = F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull()
    return F.coalesce(known & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _keyed(batches):
    """A row for each vector and table; vectors of different lengths get different keys."""
    for batch in batches:
        vectors = batch.column("vector").to_pylist()
        size = np.array([len(v) for v in vectors])
        label, rep, weight = (batch.column(c).to_numpy() for c in ("label", "rep", "weight"))
        for length in np.unique(size).tolist():
            part = np.flatnonzero(size == length)
            for some in np.array_split(part, -(-len(part) // 1024)):
                x = np.array([vectors[i] for i in some], np.float64)
                c = codes(unit(x))
                key = c ^ (label[some] * 1_000_003 + length)[:, None]
                packed, hashes = [r.tobytes() for r in x], [r.tobytes() for r in c]
                for t in range(TABLES):
                    yield pa.record_batch({
                        "key": pa.array(key[:, t]), "table": pa.array(np.full(len(some), t, np.int32)),
                        "rep": pa.array(rep[some]), "weight": pa.array(weight[some]),
                        "vector": pa.array(packed, pa.binary()), "codes": pa.array(hashes, pa.binary()),
                    })


def _near(vectors: list[bytes], hashes: list[bytes], table: int, least: float) -> np.ndarray:
    """Links of a cell's vectors, without those that an earlier table has."""
    units = unit(np.vstack([np.frombuffer(v) for v in vectors]))
    near = units @ units.T >= least
    np.fill_diagonal(near, False)
    if near.any():
        own = np.vstack([np.frombuffer(c, np.int64) for c in hashes])
        for t in range(table):
            near &= own[:, t, None] != own[None, :, t]
    return near


def _compared(least: float, run: int) -> Callable:
    """``rep, links, other`` of vectors with links; rows of larger cells come back whole, with null links."""

    def compared(batches):
        for table, late in runs(batches, run):
            if late:
                none = pa.nulls(table.num_rows, pa.int64())
                whole = table.append_column("links", none).append_column("other", none)
                yield from whole.combine_chunks().to_batches()
                continue
            starts, sizes = bounds(table)
            rep, weight = table.column("rep").to_numpy(), table.column("weight").to_numpy()
            number = table.column("table").to_numpy()
            reps, links, others = [], [], []
            for start, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
                cell = table.slice(start, size)
                near = _near(
                    cell.column("vector").to_pylist(), cell.column("codes").to_pylist(), int(number[start]), least
                )
                some = np.flatnonzero(near.any(axis=1))
                if len(some):
                    part = slice(start, start + size)
                    reps.append(rep[part][some])
                    links.append((near @ weight[part])[some])
                    others.append(rep[part][forest(near)][some])
            if reps:
                n = sum(map(len, reps))
                yield pa.record_batch({
                    "key": pa.nulls(n, pa.int64()), "table": pa.nulls(n, pa.int32()),
                    "rep": pa.array(np.concatenate(reps)), "weight": pa.nulls(n, pa.int64()),
                    "vector": pa.nulls(n, pa.binary()), "codes": pa.nulls(n, pa.binary()),
                    "links": pa.array(np.concatenate(links)), "other": pa.array(np.concatenate(others)),
                })

    return compared


def _cells(late: DataFrame, least: float, run: int) -> DataFrame:
    """The same for cells of more than ``run`` vectors: every two chunks of one meet, and each chunk with itself."""
    chunks = late.groupBy("key").agg(F.ceil(F.count("rep") * 4 / run).alias("n"))
    dealt = late.join(chunks, "key").withColumn("c", F.pmod(F.xxhash64("rep"), F.col("n")))
    met = dealt.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    met = met.withColumns({"x": F.least("c", "o"), "y": F.greatest("c", "o")})

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        near = _near(list(rows["vector"]), list(rows["codes"]), int(rows["table"].iloc[0]), least)
        if rows["x"].iloc[0] != rows["y"].iloc[0]:
            chunk = rows["c"].to_numpy()
            near &= chunk[:, None] != chunk[None, :]
        rep = rows["rep"].to_numpy()
        links = near @ rows["weight"].to_numpy()
        return pd.DataFrame({"rep": rep, "links": links, "other": rep[forest(near)]}).query("links > 0")

    return met.groupBy("key", "x", "y").applyInPandas(compared, "rep long, links long, other long")


def near_duplicates(vectors: DataFrame, least: float = LEAST, run: int = RUN) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vec_id, label, embedding``.

    Rows that are not ``usable`` link with nothing and are kept as themselves, as do vectors of another length.
    Repeated rows are vectors of their own: equal ones link with each other, and rows that share an id share its
    component.  Other columns are ignored; no rows give none.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding"
    ).withColumn("usable", usable())
    good = rows.where("usable").drop("usable")
    equal = good.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("vec_id").alias("weight"))
    equal = materialise(equal.withColumnRenamed("embedding", "vector"), "vectors")
    keyed = equal.mapInArrow(_keyed, _ROWS).repartition("key").sortWithinPartitions("key")
    found = materialise(keyed.mapInArrow(_compared(least, run), _FOUND), "links")
    linked, late = found.where("links is not null").select("rep", "links", "other"), found.where("links is null")
    if not late.isEmpty():
        linked = materialise(linked.unionByName(_cells(late, least, run)), "links")
    grouped = components(linked.select(F.col("rep").alias("a"), F.col("other").alias("b")), linked.count())
    sums = linked.groupBy("rep").agg(F.sum("links").alias("links"))
    members = good.join(equal, (good["label"] == equal["label"]) & (good["embedding"] == equal["vector"]))
    members = members.select("vec_id", "rep", "weight")
    members = members.join(sums, "rep", "left").join(grouped.withColumnRenamed("node", "rep"), "rep", "left")
    counted = members.select(
        "vec_id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    alone = rows.where(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return counted.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
