"""Mixing, SimHash, language model and URL filter against plain Python."""

import math
from collections import Counter, defaultdict

import duckdb
import pytest
import xxhash
from helpers_llm import SCHEMA, documents, fold, odd_rows, text, words
from pyspark.sql import functions as F

from pricebars.llm import graph, language_model, mixing, queries, runs, simhash, urls
from pricebars.llm.text import remainder

SMALL = "/root/testdata/sf0.001"


def collect(df):
    return [tuple(r) for r in df.collect()]


# --- mixing ------------------------------------------------------------------------------------------


def filled(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Reshare by weight, round after round."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    left = share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > most * sizes[s] + 1e-9}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 1000, None: 5, "c": 0, "d": 70}, {"x": 7}, {"a": 0, "b": 0},
    {f"s{i:02d}": 10 + i * i for i in range(17)},
])
def test_rates_reshare_by_weight(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source STRING, size BIGINT")
    got = {r.source: r for r in mixing.rates(df).collect()}
    for source, want in filled(sizes).items():
        assert got[source].target == pytest.approx(want)
        assert got[source].rate <= 2


def test_mixing_of_odd_rows(spark):
    docs = documents(spark, extra=True)
    found = mixing.rates(docs.select("source", mixing.size().alias("size")))
    rows = mixing.copies(docs.withColumn("size", mixing.size()), found).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert r["size"] == len(words(r.text)) and 0 <= r.copies <= 2
    mixed = mixing.mix(docs, found)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in rows)
    assert sorted(map(repr, mixing.mix(docs.repartition(5), found).collect())) == sorted(map(repr, mixed.collect()))


def test_words_taken_come_near_the_target(spark):
    docs = spark.range(20000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"), (F.col("id") % 50 + 1).alias("size")
    )
    docs = docs.union(spark.range(20000, 60000).selectExpr("id", "'hot'", "10"))
    mixed = mixing.copies(docs, mixing.rates(docs)).groupBy("source").agg(
        F.first("target").alias("target"), F.sum(F.col("size") * F.col("copies")).alias("taken")
    )
    for r in mixed.collect():
        assert r.taken == pytest.approx(r.target, rel=0.03)


def test_mixing_beyond_the_broadcast_bound(spark, monkeypatch):
    docs = documents(spark)
    found = mixing.rates(docs.select("source", mixing.size().alias("size")))
    want = sorted(map(repr, mixing.copies(docs, found).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(repr, mixing.copies(docs, found).collect())) == want


def test_empty_mix(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(docs, mixing.rates(docs.select("source", mixing.size().alias("size")))).count() == 0


# --- SimHash -----------------------------------------------------------------------------------------


def plain_fingerprint(t):
    w = words(t)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints):
    """component of each (doc_id, fp), by comparing all."""
    parent = {i: i for i, _ in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (a, x) in enumerate(prints):
        for b, y in prints[n:]:
            if (x ^ y).bit_count() <= 3:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: root(i) for i in parent}


def test_fingerprints_and_groups_of_the_smallest_table(spark):
    got = {r.doc_id: r for r in queries.queries()["op7_simhash"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    prints = sorted((r.doc_id, plain_fingerprint(r.text)) for r in docs)
    want = grouped(prints)
    assert len(got) == len(prints)
    for doc_id, fp in prints:
        assert (got[doc_id].fingerprint, got[doc_id].component_id) == (f"{fp:016x}", want[doc_id])


def test_simhash_of_odd_rows(spark):
    rows = simhash.near_duplicates(documents(spark, extra=True)).collect()
    assert len(rows) == len(odd_rows())
    of = defaultdict(set)
    for r in rows:
        of[r.doc_id].add(r.component_id)
    assert of[4] == of[5] == of[6] == {4}
    assert of[1] == of[2] == {1}
    assert of[13] == {13} and of[14] <= {14}
    assert of[None] == {1, None}
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("run", [1024, 8])
def test_classes_lose_no_link_however_long_the_runs(spark, run):
    import random

    draw = random.Random(3)
    bases = [draw.getrandbits(64) for _ in range(6)]
    prints = []
    for i in range(400):
        fp = bases[i % 6] if i % 3 else draw.getrandbits(64)
        for _ in range(draw.randrange(4)):
            fp ^= 1 << draw.randrange(64)
        prints.append((i, fp))
    signed = [(i, fp - (1 << 64) if fp >> 63 else fp) for i, fp in prints]
    got = simhash.classes(spark.createDataFrame(signed, "doc_id BIGINT, fp BIGINT"), run=run)
    component = {r.fp & (1 << 64) - 1: r.component_id for r in got.collect()}
    want = grouped(prints)
    assert all(component[fp] == want[i] for i, fp in prints)


def test_runs_are_whole_and_long_ones_marked():
    import pyarrow as pa

    keys = [1] * 2 + [2] * 9 + [3] + [4] * 3 + [5] * 20 + [6]
    for size in (1, 2, 5, 100):
        batches = [pa.record_batch({"key": pa.array(keys[i : i + size])}) for i in range(0, len(keys), size)]
        whole, late = [], []
        for table, is_late in runs.runs(iter(batches), 5):
            starts, sizes = runs.bounds(table)
            got = list(zip(table.column("key").to_numpy()[starts].tolist(), sizes.tolist()))
            (late if is_late else whole).extend(got)
        assert whole == [(1, 2), (3, 1), (4, 3), (6, 1)]
        assert Counter({k: 0 for k, _ in late}) == Counter({2: 0, 5: 0})
        assert sum(n for _, n in late) == 29


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(7, 3), (3, 7), (7, 9), (5, 5), (None, 4)]
    got = dict(collect(graph.components(spark.createDataFrame(chain, "a BIGINT, b BIGINT"), 65)))
    assert got == {i: 100 for i in range(100, 161)} | {3: 3, 7: 3, 9: 3}
    assert graph.components(spark.createDataFrame([], "a BIGINT, b BIGINT"), 0).count() == 0


# --- language model ----------------------------------------------------------------------------------


def plain_scores(rows, backoff=language_model.BACKOFF):
    """rows: (text, training).  Scores by counting, without any automaton."""
    tokens = [[*words(t), "\n"] for t, _ in rows]
    one, two = Counter(), Counter()
    for w, (_, training) in zip(tokens, rows):
        if training:
            one.update(w)
            two.update(zip(["\n", *w], w))
    n, v = sum(one.values()), len(one)
    p = lambda w: (one[w] + 0.5) / (n + 0.5 * (v + 1))
    return [
        (
            len(w), sum(one[x] > 0 for x in w), n, sum(math.log10(p(x)) for x in w),
            sum(math.log10((two[u, x] + backoff * p(x)) / (one[u] + backoff)) for u, x in zip(["\n", *w], w)),
        )
        for w in tokens
    ]


@pytest.mark.parametrize("batch, size", [(12 << 20, 2_000_000), (400, 50)])
def test_scores_equal_counting(spark, monkeypatch, batch, size):
    monkeypatch.setattr(language_model, "BATCH_BYTES", batch)
    monkeypatch.setattr(language_model, "RANGE", size)
    rows = odd_rows()
    docs = documents(spark, extra=True).drop("training").withColumn("training", remainder() != 1)
    docs = docs.withColumn("n", F.xxhash64("doc_id", "text"))
    got = sorted(tuple(r)[1:] for r in language_model.score(docs).collect())
    want = sorted(plain_scores([(r[1], fold(r[0]) not in (None, 1)) for r in rows]))
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == pytest.approx(b)


def test_language_model_of_no_training_and_no_rows(spark):
    docs = documents(spark).withColumn("training", F.lit(False))
    rows = language_model.score(docs).collect()
    assert {(r.n_known, r.train_tokens) for r in rows} == {(0, 0)}
    assert all(r.score == pytest.approx(0) for r in rows)  # one class, the unknown word, has all probability
    empty = spark.createDataFrame([], SCHEMA).withColumn("training", F.lit(True))
    assert language_model.score(empty).count() == 0


def test_words_after_a_context_add_up_to_one():
    import numpy as np

    # the text 0 1 0 1 3 1 3 | as a ring: every word is followed as often as it comes
    ring = [0, 1, 0, 1, 3, 1, 2]
    counts = np.bincount(ring, minlength=4)
    pairs = Counter(u * 4 + w for u, w in zip(ring, ring[1:] + ring[:1]))
    keys = np.array(sorted(pairs))
    machine = language_model.automaton(keys, np.array([pairs[k] for k in keys]), counts, 7, 4, 2.0)
    unknown = 0.5 / (7 + 0.5 * 5)
    for u in range(4):
        known = [10 ** machine.walk(np.array([w], np.int32), np.array([1]), u)[0] for w in range(4)]
        assert sum(known) + 10 ** machine.price[u] * unknown == pytest.approx(1)


# --- URLs --------------------------------------------------------------------------------------------


def plain_rule(host, path):
    fit = [
        (len(h + p), h + p, v) for v, h, p in urls.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fit)[1:] if fit else (None, None)


def test_urls_against_plain_python(spark):
    odd = [
        None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/1?x#y", "https://example.org/en/12", "x://a.com#/fr/",
        "https://notexample.org/es/", "http://de.example.org/EN/1", "ftp://com/de/", "http://a.com/fr/://b", "a?b://c.org/d",
        "http://Ünï.com/de/ß", "http://a.org?q://", "http://a.com\n/fr/x",
    ]
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url").collect()
    rows = [(i, u) for i, u in enumerate(odd)] + [(1000 + r.page_id, r.url) for r in pages]
    model = urls.fit()
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id BIGINT, url STRING, verdict STRING")
    got = {r.page_id: r for r in urls.judge(df, model).collect()}
    assert len(got) == len(rows)
    for i, url in rows:
        _, scheme, rest = (url or "").partition("://")
        host = path = ""
        if scheme:
            end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
            path = rest[end:].split("?")[0].split("#")[0]
        name, verdict = plain_rule(host, path)
        score = float(model.score([host], [path])[0])
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, name), url
        assert r.score == pytest.approx(score)
        assert r.verdict == (verdict or ("block" if score >= 0.5 else "allow"))
    assert urls.judge(df.limit(0), model).count() == 0


def test_url_model_tells_hosts_apart():
    bad = ["blog.cheap-pills.example.net", "casino-win.example.com", "www.adult-x.example.org", "m.free-bets.example.net"]
    good = ["tionsh.example.net", "www.therapy.example.com", "library.example.org", "blog.tionble.example.com"]
    paths = ["/en/21003", "/", "/fr/17.html", "/de/5/"]
    model = urls.fit()
    assert (model.score(bad, paths) >= 0.5).all() and (model.score(good, paths) < 0.5).all()


# --- SQL ---------------------------------------------------------------------------------------------


def test_mixing_equals_its_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = sorted(connection.execute(queries.oracle_sql()["op6_mixing"]).fetchall())
    assert sorted(collect(queries.queries()["op6_mixing"](spark, SMALL))) == want
