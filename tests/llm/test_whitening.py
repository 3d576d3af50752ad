"""Whitening on block matrices against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricebars.llm import queries, whitening

SF = "/root/testdata/sf0.01"


def expected(vectors, most=8):
    """n, exact deviations, whitened columns, explained shares."""
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    centred = x - s / n
    cov = centred.T @ centred / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    use = e > 1e-10 * max(e[0], 0)
    return n, deviation, centred @ u[:, use] / np.sqrt(e[use]), e[use] / np.trace(cov)


def compare(rows, ids, vectors):
    n, deviation, whitened, explained = expected(vectors)
    k = len(explained)
    assert len(rows) == n * k
    place = {i: p for p, i in enumerate(ids)}
    got = np.full((n, k), np.nan)
    for r in rows:
        p = place[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation[p])
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-6 and 0 <= r.identity_error <= 1e-4
        got[p, r.component - 1] = r.whitened
    assert len({r.identity_error for r in rows}) <= 1
    for c in range(k):
        assert min(np.abs(got[:, c] - whitened[:, c]).max(), np.abs(got[:, c] + whitened[:, c]).max()) < 1e-6


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def answer(spark, rows):
    return whitening.whiten(table(spark, rows)).select("row.vec_id", *"component n deviation whitened explained identity_error".split())


def test_query_on_whole_table(spark):
    given = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    found = queries.queries()["op13_whitening"](spark, SF)
    assert dict(found.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
        "explained": "double", "identity_error": "double",
    }
    compare(found.collect(), [r.vec_id for r in given], [r.embedding for r in given])


def test_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS", 16)
    monkeypatch.setattr(whitening, "COLUMNS", 5)
    draw = np.random.default_rng(3)
    x = (draw.standard_normal((333, 12)) @ draw.standard_normal((12, 12))).astype(np.float32)
    compare(answer(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)]).collect(), range(333), x)


def test_odd_rows_and_clashing_columns(spark):
    draw = np.random.default_rng(5)
    good = [(i, draw.standard_normal(6).astype(np.float32).tolist(), i % 3) for i in range(40)]
    odd = [(50, None, 0), (51, [], 0), (52, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (53, [float("nan")] * 6, 1),
           (54, [1.0, 2.0], 0), (55, [float("inf")] + [0.0] * 5, None)]
    docs = table(spark, good + odd)
    names = ["row", "vector", "x", "place", "part", "start", "index", "values", "deviation", "pos", "n", "whitened", "component"]
    docs = docs.withColumns({c: F.lit(f"mine {c}") for c in names})
    found = whitening.whiten(docs, carried=docs.columns)
    kept = found.select("row.*").collect()
    assert {r.vec_id for r in kept} == set(range(40)) and all(r[c] == f"mine {c}" for r in kept for c in names)
    rows = found.select("row.vec_id", *"component n deviation whitened explained identity_error".split()).collect()
    compare(rows, [i for i, *_ in good], [v for _, v, _ in good])


def test_repeated_rows_ties_and_null_ids(spark):
    rows = [(None, [0.0, 1.0], 0), (7, [1.0, 0.0], 0), (7, [1.0, 0.0], 0), (7, [0.0, 1.0], 0)]
    found = answer(spark, rows).collect()  # one direction only has any variance
    assert sorted((r.vec_id or 0, r.component, round(abs(r.whitened), 9)) for r in found) == [(0, 1, 1.0)] + [(7, 1, 1.0)] * 3
    assert all(abs(r.explained - 1) < 1e-9 and r.n == 4 for r in found)


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [0.5, 2.0], 0)], [(i, [0.5, 2.0], 0) for i in range(9)]])
def test_nothing_to_whiten(spark, rows):
    found = answer(spark, rows)
    assert found.collect() == [] and found.columns[0] == "vec_id"


def test_huge_entries(spark):
    draw = np.random.default_rng(9)
    rows = [(i, [float(v) for v in draw.standard_normal(3)], 0) for i in range(20)] + [(20, [3e38, -3e38, 0.0], 0)]
    found = answer(spark, rows).collect()
    assert {r.vec_id for r in found} == set(range(21)) and all(np.isfinite(r.whitened) for r in found)
    assert all(r.deviation is None for r in found if r.vec_id == 20)
