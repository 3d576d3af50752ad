"""Line removal and the levelled runs against plain Python."""

import random
from collections import defaultdict

import pytest
from helpers_llm import documents, odd_rows
from pyspark.sql import functions as F

from pricebars.llm import line_dedup as ld

SPACE = " \t\n\x0b\x0c\r"
LONG = "This line is surely long enough to count"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def expected(rows, least=3):
    """Rows (doc_id, n_lines, n_dropped, kept); every row is a document."""
    holders = defaultdict(list)
    for doc_id, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= 20:
                holders[k].append(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        top = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= least}
        kept = [x for x in lines if key(x) not in top or top[key(x)] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found(answer):
    return sorted((tuple(r) for r in answer.select("row.doc_id", "n_lines", "n_dropped", "kept").collect()), key=repr)


def pairs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def random_rows(seed, number):
    draw = random.Random(seed)
    pool = [f"{LONG} number {i}" for i in range(12)] + ["short", "", "  ", f"\t{LONG} NUMBER 3 \r", "ÄÖ " + "ß" * 18, "äÖ " + "ß" * 18]
    return [(draw.randrange(number), "\n".join(draw.choices(pool, k=draw.randrange(9)))) for _ in range(number)]


@pytest.mark.parametrize("seed", range(3))
def test_random_documents(spark, seed):
    rows = random_rows(seed, 60)
    assert found(ld.dedup_lines(pairs(spark, rows))) == expected(rows)


def test_odd_rows_with_clashing_columns(spark):
    shared = f"  {LONG}\t"
    rows = [
        *[(r[0], r[1]) for r in odd_rows()],
        (30, f"{shared}\n\n{LONG.upper()}\nown"), (31, shared), (32, f"{shared}\n{shared}"), (32, f"x\n{shared}"),
        (None, shared), (None, "only rows without an id hold this\n"), (None, "only rows without an id hold this"),
        (None, "Only rows without an id hold this "), (33, "\n" * 500), (34, "\n".join(f"line {i} of a very long text" for i in range(5000))),
    ]
    docs = documents(spark, [(*r, None, None, None) for r in rows])
    names = ["row", "id", "h1", "h2", "key", "pos", "line", "salt", "hot", "top", "docs", "gone", "kept", "t1", "lines", "n_lines"]
    docs = docs.withColumns({n: F.lit(f"mine {n}") for n in names})
    answer = ld.dedup_lines(docs, carried=docs.columns)
    assert found(answer) == expected(rows)
    assert all(r[n] == f"mine {n}" for r in answer.select("row.*").collect() for n in names)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (None, None)], [(5, LONG)] * 50, [(None, LONG)] * 4])
def test_empty_and_equal_tables(spark, rows):
    assert found(ld.dedup_lines(pairs(spark, rows))) == expected(rows)


def test_batches_hold_every_row_once(spark):
    for rows in (random_rows(7, 90), [(None, "a"), (3, "b")], [(1, "a")] * 9):
        parts = [[r.doc_id for r in b.collect()] for b in ld.batches(pairs(spark, rows))]
        assert sorted(map(repr, sum(parts, []))) == sorted(repr(r[0]) for r in rows)


def test_store_keeps_few_runs_and_no_line_twice(spark):
    """Nine batches in any order of ids: levels of a binary counter, disjoint first runs, exact counts."""
    store, rows = ld.LineStore(spark), []
    try:
        for i in range(9):
            some = [(1000 * (i * 4 % 9) + d, t) for d, t in random_rows(i, 20)] + [(1000 * (i * 4 % 9), f"{LONG} batch {i}")]
            rows += some
            store.add(ld.counted(pairs(spark, some)))
            first = store.first.tables()
            assert len(first) == bin(i + 1).count("1")
            keys = [(r.h1, r.h2) for run in first for r in run.collect()]
            assert len(keys) == len(set(keys))
        got = {(r.docs, r.top) for r in store.lines().collect()}, store.lines().count()
        holders = defaultdict(list)
        for doc_id, text in rows:
            for k in {key(x) for x in text.split("\n")}:
                if len(k) >= 20:
                    holders[k].append(doc_id)
        assert got == ({(len(ids), max(ids)) for ids in holders.values()}, len(holders))
    finally:
        store.drop()


def test_runs_are_merged_without_a_shuffle(spark):
    store = ld.LineStore(spark)
    try:
        store.add(ld.counted(pairs(spark, random_rows(1, 30))))
        run = store.first.tables()[0]
        for how in ("left_anti", "full"):
            plan = run.join(run.hint("merge"), ["h1", "h2"], how)._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        store.drop()


def test_salted_join_gives_the_same_rows(spark, monkeypatch):
    rows = random_rows(5, 80) + [(i, LONG) for i in range(100, 200)]
    monkeypatch.setattr(ld, "HEAVY", 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert found(ld.dedup_lines(pairs(spark, rows))) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_python_on_the_main_path(spark):
    plan = ld.dedup_lines(pairs(spark, random_rows(2, 20)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
