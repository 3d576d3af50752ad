"""Classifiers, token files, decontamination, embeddings, suffixes and the pipeline against plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers_llm import SCHEMA, documents, odd_rows, text
from pyspark.sql import functions as F

import corpus_pipeline
from pricebars.llm import decontamination, embeddings, mixing, quality, queries, simhash, suffixes, token_files, toxicity
from pricebars.sources.store import materialise, new_folder

SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LABELS = "doc_id BIGINT, quality INT, toxic INT"


# --- classifiers -------------------------------------------------------------------------------------


def held_out(spark, name, label):
    rows = queries.queries()[name](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    return [(r.score, r[label]) for r in rows.where("held_out").collect()]


def test_quality_of_held_out_documents(spark):
    pairs = held_out(spark, "op5_quality", "quality")
    right = sum((s >= 0.3) == y for s, y in pairs)
    assert right >= 0.95 * len(pairs)
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    assert np.mean([g > b for g in good for b in bad]) > 0.97


def test_toxicity_of_held_out_documents(spark):
    pairs = held_out(spark, "op1_toxicity", "toxic")
    clean, toxic = [s for s, y in pairs if not y], [s for s, y in pairs if y]
    assert all(s < 0.5 for s in clean)
    # area under the curve; documents without any known word share a score, and such a tie counts one half
    assert np.mean([(t > c) + (t == c) / 2 for t in toxic for c in clean]) >= 0.8


def test_scores_ignore_labels_of_held_out_rows_and_every_other_column(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    other = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs.select("doc_id", "text"), other)
    assert a.words == b.words and np.allclose(a.weights, b.weights)


@pytest.mark.parametrize("kind, label", [(toxicity, "toxic"), (quality, "quality")])
def test_classifiers_of_odd_rows(spark, kind, label):
    docs = documents(spark, extra=True)
    many = [(i, i % 2, i % 2) for i in range(1, 16)] + [(3, None, None), (3, 0, 0), (None, 1, 1), (99, 1, 1)]
    for rows in (many, [(1, 1, 1)], [(1, 0, 0), (2, 0, 0)], []):
        model = kind.fit(docs, spark.createDataFrame(rows, LABELS))
        scored = kind.score(docs, model)
        assert set(scored.columns) == set(docs.columns)
        scores = [r.score for r in scored.collect()]
        assert len(scores) == len(odd_rows()) and all(0 <= s <= 1 for s in scores)
    empty = docs.limit(0)
    assert kind.score(empty, kind.fit(empty, spark.createDataFrame(many, LABELS))).count() == 0


def test_risk_corrects_for_positives_among_the_unlabelled():
    draw = np.random.default_rng(0)
    rows, positive, truth = [], [], []
    for i in range(1200):
        known = i < 300
        toxic = known or draw.random() < 0.25
        rows.append(np.array([0] if toxic else [1]))
        positive.append(known)
        truth.append(toxic)
    w, b = toxicity.fit_linear(rows, np.array(positive), 2, 0.25, seed=1)
    assert w[0] + b > 1 and w[1] + b < -1  # plain positive-against-rest would call both kinds negative


def test_trees_split_what_a_line_cannot():
    x = np.random.default_rng(1).uniform(-1, 1, (800, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    model = quality.fit_forest(x, y)
    assert np.mean((model.score(x) > 0.5) == y) > 0.95
    flat = quality.fit_forest(x, np.ones(800))
    assert np.allclose(flat.score(x), flat.score(x)[0]) and flat.score(x)[0] > 0.99


def test_flattened_trees_equal_walking_them():
    draw = np.random.default_rng(2)
    x, y = draw.normal(size=(300, 4)), draw.integers(0, 2, 300).astype(float)
    model = quality.fit_forest(x, y, trees=7, depth=3)
    for row, score in zip(x, model.score(x)):
        logit = model.start
        for feature, limit, value in zip(model.feature, model.limit, model.value):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > limit[node] else 1)
            logit += value[node - len(feature)]
        assert score == pytest.approx(1 / (1 + np.exp(-logit)))


# --- token files -------------------------------------------------------------------------------------


def plain_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_files.tokenizer_file(token_files.TOKENIZER))
    return [np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4") for t in texts]


def test_pieces_encode_like_whole_texts():
    draw = random.Random(0)
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "1", ".", ",", "'s", "\x1c", "\x01", " the", "ß", "\r\n", "!", "漢", "\x85", " ", "<|endoftext|>"]
    odd = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 14))) for _ in range(4000)] + [r[1] or "" for r in odd_rows()]
    got = token_files.Encoder(token_files.TOKENIZER, 2).encode(odd)
    for t, ids, want in zip(odd, got, plain_ids(odd)):
        assert ids.tolist() == want.tolist(), repr(t)


def test_another_kind_of_tokenizer_encodes_whole_texts():
    encoder = token_files.Encoder("word_bpe_49k.json", 49407)
    assert not encoder.cuts
    assert encoder.encode(["Two words"])[0].tolist() == encoder.whole("Two words").tolist()


def test_token_files_come_back(spark, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_DOCS", 3)
    docs = documents(spark, extra=True)
    path = new_folder(spark, "tokens")
    token_files.write(docs, path)
    order = sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    got = sorted((tuple(r) for r in token_files.digest(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [r[0] for r in order]
    start = 0
    crcs = {}
    for r, ids in zip(order, plain_ids([r[1] or "" for r in order])):
        crcs.setdefault(r[0], []).append((len(ids), zlib.crc32(ids.tobytes())))
    for doc_id, at, n, crc in got:
        assert at == start and (n, crc) in crcs[doc_id]
        start += n
    (ids,) = [r.ids for r in token_files.documents(spark, path, [7, 999]).collect()]
    assert ids == plain_ids([odd_rows()[6][1]])[0].tolist()


def test_token_files_of_the_smallest_table(spark):
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    got = sorted(tuple(r) for r in queries.queries()["op4_token_files"](spark, SMALL).collect())
    start = 0
    for (doc_id, at, n, crc), (want, _), ids in zip(got, docs, plain_ids([t for _, t in docs])):
        assert (doc_id, at, n, crc) == (want, start, len(ids), zlib.crc32(ids.tobytes()))
        start += n


def test_empty_token_files(spark):
    path = new_folder(spark, "tokens")
    token_files.write(spark.createDataFrame([], SCHEMA), path)
    assert token_files.digest(spark, path).count() == 0
    assert token_files.documents(spark, path, [1]).count() == 0


# --- decontamination ---------------------------------------------------------------------------------


def edits_to_find(pattern, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(pattern, 1):
        last, row = row, [i]
        for j, x in enumerate(t, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != x)))
    return min(row)


def test_matches_equal_the_whole_table_of_distances():
    draw = random.Random(1)
    items = [(i, text(50 + i, draw.randint(3, 30))) for i in range(12)]
    index = decontamination.index(items)
    for n in range(80):
        i, item = draw.choice(items)
        allowed = min(len(item) // 10, (len(item) - 8) // 8)
        changed = list(item)
        for _ in range(draw.randint(0, allowed + 2)):
            p = draw.randrange(len(changed))
            changed[p : p + 1] = draw.choice([[], ["q"], [changed[p], "z"]])
        doc = f"{text(n, 12)} {''.join(changed)} {text(n + 500, 9)}"
        found = {f["item_id"]: f for f in decontamination.scan(["x", doc, ""], index)[1]}
        distance = edits_to_find(item, doc)
        assert (i in found) == (distance <= allowed)
        if i in found:
            f = found[i]
            assert f["edits"] == distance
            assert edits_to_find(item, doc[f["start"] : f["end"]]) == distance


def test_decontamination_of_odd_rows(spark, monkeypatch):
    passage = text(99, 30)
    items = [(1, "  " + passage.upper() + "\n"), (2, None), (3, ""), (4, "short"), (5, text(1, 60)), (5, text(1, 60)), (None, passage)]
    benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    docs = documents(spark, extra=True)
    for block in (200_000, 50):
        monkeypatch.setattr(decontamination, "BLOCK", block)
        got = sorted((r.doc_id or 0, r.item_id, r.edits) for r in decontamination.matches(docs, benchmark).distinct().collect())
        assert got == [(0, 5, 0), (1, 5, 0), (2, 5, 0), (3, 5, 0), (7, 1, 0), (8, 1, 0)]
        kept = decontamination.clean(docs, benchmark)
        assert kept.columns == docs.columns and kept.count() == len(odd_rows()) - 6
    assert decontamination.clean(docs, benchmark.limit(0)).count() == len(odd_rows())
    assert decontamination.matches(docs.limit(0), benchmark).count() == 0


def test_planted_items_of_the_smallest_table(spark):
    got = {(r.doc_id, r.item_id) for r in queries.queries()["op10_decontamination"](spark, SMALL).collect()}
    items = [(r.item_id, decontamination.normal(r.text)) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    docs = [(r.doc_id, decontamination.normal(r.text)) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert got >= {(d, i) for d, t in docs for i, item in items if item in t}


# --- embeddings --------------------------------------------------------------------------------------


def vectors():
    draw = np.random.default_rng(5)
    rows, n = [], 0
    for group in range(8):
        base = draw.normal(size=24)
        for _ in range(12):
            rows.append((n, group % 3, (base + draw.normal(size=24) * draw.choice([0, 0.05, 0.12, 0.2])).astype("f4").tolist()))
            n += 1
    rows += [(n, 0, None), (n + 1, 0, [0.0] * 24), (n + 2, 0, [float("nan")] * 24), (n + 3, 0, [1.0, None]), (n + 4, None, rows[0][2]),
             (n + 5, 0, []), (n + 6, 0, rows[0][2][:3]), (n + 7, 0, [2 * x for x in rows[0][2]]), (None, 0, rows[0][2]), (0, 0, rows[0][2])]
    return rows


@pytest.mark.parametrize("run", [1024, 4])
def test_links_and_components_of_vectors(spark, run):
    rows = vectors()
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id BIGINT, label INT, embedding ARRAY<FLOAT>, kept STRING")
    got = sorted((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id) for r in embeddings.near_duplicates(df, run=run).collect())

    def unit(r):
        if r[0] is None or r[1] is None or not r[2] or None in r[2] or not np.isfinite(r[2]).all() or not any(r[2]):
            return None
        x = np.array(r[2], float)
        return x / np.linalg.norm(x)

    units = [unit(r) for r in rows]
    links = [[] for _ in rows]
    for i, a in enumerate(units):
        for j, b in enumerate(units):
            if i != j and a is not None and b is not None and rows[i][1] == rows[j][1] and len(a) == len(b) and a @ b >= 0.98:
                links[i].append(j)
    want = []
    for i, r in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        want.append((r[0] is None, r[0] or 0, len(links[i]), min((rows[j][0] for j in seen), default=None, key=lambda x: (x is None, x))))
    want.sort()
    assert len(got) == len(want)
    assert sum(w[2] for w in want) > 100
    assert sum(g[2] for g in got) >= 0.99 * sum(w[2] for w in want)
    assert sum(g == w for g, w in zip(got, want)) >= 0.97 * len(want)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_recall_at_the_threshold():
    draw = np.random.default_rng(3)
    a = embeddings.unit(draw.normal(size=(3000, 64)))
    side = draw.normal(size=(3000, 64))
    side = embeddings.unit(side - (side * a).sum(1, keepdims=True) * a)
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * side
    assert (embeddings.codes(a) == embeddings.codes(b)).any(axis=1).mean() > 0.99
    assert (embeddings.codes(a) == embeddings.codes(side)).any(axis=1).mean() < 0.02


# --- suffixes ----------------------------------------------------------------------------------------


def removed(rows):
    """(n_bytes, n_removed, n_spans, kept) of (doc_id, text), by a set of all strings seen in smaller ids."""
    first = {}
    for doc_id, t in rows:
        x = (t or "").encode()
        for k in range(len(x) - 49):
            s = x[k : k + 50]
            first[s] = min(first.get(s, np.inf), np.inf if doc_id is None else doc_id)
    out = []
    for doc_id, t in rows:
        x = (t or "").encode()
        covered = bytearray(len(x))
        for k in range(len(x) - 49):
            if first[x[k : k + 50]] < (np.inf if doc_id is None else doc_id):
                covered[k : k + 50] = b"\1" * 50
        spans = sum(covered[k] and not (k and covered[k - 1]) for k in range(len(x)))
        out.append((doc_id, len(x), sum(covered), spans, bytes(c for c, m in zip(x, covered) if not m)))
    return out


def passages():
    draw = random.Random(4)
    base = [text(200 + i, 40) for i in range(5)]
    rows = []
    for i in range(60):
        pieces = [text(300 + i, draw.randint(0, 12))]
        for _ in range(draw.randint(0, 2)):
            p = draw.choice(base)
            a = draw.randrange(len(p) - 60)
            pieces.append(p[a : a + draw.choice([48, 49, 50, 51, 52, 60, 120])] + draw.choice(["", "#", "é"]))
        rows.append((draw.randrange(40), "".join(pieces)))
    return rows + [(3, "ab" * 90), (900, "ab" * 70), (901, "a" + "ab" * 60), (902, base[0]), (903, base[0])]


@pytest.mark.parametrize("batch, keys", [(8 << 20, 1_000_000), (500, 200)])
def test_removed_runs_equal_brute_force(spark, monkeypatch, batch, keys):
    monkeypatch.setattr(suffixes, "BATCH_BYTES", batch)
    monkeypatch.setattr(suffixes, "RANGE", keys)
    rows = passages() + [(r[0], r[1]) for r in odd_rows()]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id BIGINT, text STRING, batch INT, kept STRING")
    got = suffixes.remove_repeats(df).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=key) == sorted(removed(rows), key=key)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in got)
    assert suffixes.remove_repeats(df.limit(0)).count() == 0


def test_every_string_has_an_anchor():
    draw = np.random.default_rng(6)
    data = draw.integers(97, 100, 3000).astype(np.uint8)
    place, hashes = suffixes.anchors(data)
    for start in range(len(data) - 49):
        assert ((place >= start) & (place + 20 <= start + 50)).any()
    assert len(suffixes.anchors(data[:49])[0]) == 0


def test_suffixes_of_the_smallest_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in queries.queries()["op9_suffixes"](spark, SMALL).collect())
    assert got == sorted((d, n, m, s, hashlib.sha256(k).hexdigest()) for d, n, m, s, k in removed(rows))


# --- pipeline ----------------------------------------------------------------------------------------


def test_pipeline_stages_in_turn(spark):
    """Each stage against its operator's own answers, or plain Python, on what its predecessor kept."""
    start = docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SMALL), name)
        after = docs.collect()
        if name != "token_files":
            assert docs.columns == start.columns
        if name == "toxicity":
            model = toxicity.fit(start, spark.read.parquet(f"{SMALL}/labels.parquet"))
            assert {r.doc_id for r in after} == {r.doc_id for r in before if model.score(r.text or "") < 0.5}
        elif name == "simhash":
            prints = {r.doc_id: simhash.fingerprint((r.text or "").encode()) & (1 << 64) - 1 for r in before}
            kept = {r.doc_id for r in after}
            for a, x in prints.items():  # whoever goes is linked to somebody, and no two that stay are linked
                near = [b for b, y in prints.items() if b != a and (x ^ y).bit_count() <= 3]
                assert near if a not in kept else not kept & set(near)
        elif name == "decontamination":
            items = [decontamination.normal(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
            assert not any(i in decontamination.normal(r.text) for r in after for i in items)
            assert {r.doc_id for r in after} <= {r.doc_id for r in before}
        elif name == "mixing":
            copies = {r.doc_id: sum(x.doc_id == r.doc_id for x in after) for r in before}
            assert set(copies.values()) <= {0, 1, 2} and sum(copies.values()) == len(after)
        else:
            assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before)
            assert sum(r.n_tokens for r in after) == max(r.start + r.n_tokens for r in after)
        before = after


def test_pipeline_of_odd_rows_and_of_none(spark, tmp_path):
    benchmark = spark.createDataFrame([(1, text(99, 30))], "item_id BIGINT, text STRING")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(15)], LABELS)
    for name, rows in (("odd", odd_rows()), ("none", [])):
        folder = str(tmp_path / name)
        documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
        benchmark.write.parquet(f"{folder}/benchmark.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        near = corpus_pipeline.drop_near_duplicates(spark, docs, folder)
        ids = sorted(r.doc_id or 0 for r in near.collect())
        assert ids == ([0, 0, 1, 3, 4, 7, 8, 9, 10, 11, 12, 13, 14] if rows else []) or (rows and 3 not in ids)
        got = corpus_pipeline.run(spark, folder).collect()
        assert bool(got) == bool(rows)
        assert not {7, 8} & {r.doc_id for r in got}
