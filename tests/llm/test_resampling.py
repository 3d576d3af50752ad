"""Importance resampling against plain Python."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers_llm import documents, odd_rows, text
from pyspark.sql import functions as F

from pricebars.llm import queries, resampling

SF = "/root/testdata/sf0.01"
BUCKETS = 10_000


def words(t):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def buckets(t, longest=2):
    w = words(t)
    runs = [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
    return [zlib.crc32(r.encode()) % BUCKETS for r in runs]


def expected(docs, target):
    """Rows (doc_id, n_features, weight, score, rank) of ``docs``, pairs of id and text."""
    s, t = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for counts, found in ((s, [d for _, d in docs]), (t, target)):
        for x in found:
            for b in buckets(x):
                counts[b] += 1
    top = [(int(b) + 1) * (int(s.sum()) + BUCKETS) / ((int(a) + 1) * (int(t.sum()) + BUCKETS)) for a, b in zip(s, t)]
    gain = [math.floor(1000 * math.log(x)) for x in top]
    rows = []
    for doc_id, x in docs:
        own = buckets(x)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(own), weight, score, None, len(words(x))])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for rank, r in enumerate(able[: 25 * len(able) // 100], start=1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def found(rows):
    wanted = ("doc_id", "n_features", "weight", "score", "rank")
    return sorted((tuple(r[c] for c in wanted) for r in rows.collect()), key=repr)


def test_query_on_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    answer = queries.queries()["op11_resampling"](spark, SF)
    assert dict(answer.dtypes) == dict.fromkeys(("doc_id", "n_features", "weight", "score", "rank"), "bigint")
    assert found(answer) == expected(docs, target)


def test_odd_rows_with_clashing_columns(spark):
    rows = [*odd_rows(), (20, "Under_score a1-b2\x00c3 ÀB " * 9, None, None, None), (21, "MiXed Ünicode 漢字 " * 30, "", "", 0)]
    docs = documents(spark, rows)
    names = ["row", "n_words", "n_features", "weight", "found", "place", "rank", "order", "id", "part", "bucket"]
    docs = docs.withColumns({n: F.lit(f"mine {n}") for n in names})
    target = spark.createDataFrame([(1, text(7, 20)), (2, None), (3, "")], "item_id long, text string")
    answer = resampling.resample(docs, target, carried=docs.columns)
    assert found(answer) == expected([(r[0], r[1]) for r in rows], [text(7, 20), None, ""])
    for r in answer.select("row.*").collect():  # the caller's columns come back as they are
        assert all(r[n] == f"mine {n}" for n in names)
    assert sorted(r.text or "" for r in answer.select("row.text").collect()) == sorted(r[1] or "" for r in rows)


@pytest.mark.parametrize("rows, target", [([], ["a b"]), ([(1, None), (2, "")], []), ([(1, text(1, 50))] * 40, [])])
def test_empty_and_equal_tables(spark, rows, target):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    answer = resampling.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"))
    assert found(answer) == expected(rows, target)


def test_runs_of_more_words():
    given = ["a b c d e", "", None, "b c d", "x", "c d e x a b c"]
    runs = list(resampling.features(pa.array(given), 4))
    for n, (crc, run, row) in enumerate(runs, start=1):
        want = []
        for i, t in enumerate(given):
            w = words(t)
            want += [(i, zlib.crc32(" ".join(w[k : k + n]).encode())) for k in range(len(w) - n + 1)]
        assert list(zip(row.tolist(), crc[run].tolist())) == want


def test_batches_are_cut_by_bytes(spark, monkeypatch):
    docs = spark.createDataFrame([(i, text(i, 30 + i)) for i in range(60)], "doc_id long, text string").coalesce(1)
    whole = resampling.counts(docs)
    monkeypatch.setattr(resampling, "BATCH_BYTES", 100)
    assert (resampling.counts(docs) == whole).all() and whole.sum() == sum(len(buckets(text(i, 30 + i))) for i in range(60))
