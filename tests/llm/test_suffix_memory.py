"""What one task of the suffix sort holds: ranges of like size, and few bytes for each byte of a batch."""

import random
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from pricebars.llm import suffixes


def test_key_ranges_are_alike(spark, monkeypatch):
    """Very many batches of similar texts: no key range grows beyond the others, at the ends of the order neither."""
    tables, stored = {}, suffixes.stored
    monkeypatch.setattr(suffixes, "stored", lambda df, label: tables.setdefault(label, stored(df, label)))
    monkeypatch.setattr(suffixes, "RANGE", 1000)
    monkeypatch.setattr(suffixes, "BATCH_BYTES", 4000)
    draw = random.Random(2)
    texts = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=4000)) for _ in range(120)]
    rows = [(2 * i + k, t + str(k)) for i, t in enumerate(texts) for k in (0, 1)]
    removed = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).agg(F.sum("n_removed")).first()[0]
    assert removed == 120 * 4000
    held = [r.held for r in tables["names"].where("batch is null").collect()]
    assert len(held) > 400 and max(held) < 2.5 * np.mean(held)


def test_ranges_of_anchors_are_alike():
    """The hashes of anchors are the least of many."""
    _, h = suffixes.anchors(np.random.default_rng(3).integers(97, 123, 400_000).astype(np.uint8))
    even = suffixes._even(h >> np.uint64(suffixes._OWNER_BITS))
    assert len(np.unique(even)) == len(np.unique(h >> np.uint64(suffixes._OWNER_BITS)))
    part, _ = suffixes._hash_part(np.sort(even), 20)
    count = np.bincount(part, minlength=20)
    assert count.max() < 1.2 * count.mean()


def test_strings_with_one_first_name_are_dealt_out():
    """Nine of ten strings begin with the same 18 bytes; ten copies of each stay together."""
    draw = np.random.default_rng(4)
    first = np.where(draw.random(20_000) < 0.9, 77, draw.integers(0, 1 << 36, 20_000)).astype(np.uint64)
    triple = [np.tile(x, 10) for x in (first, *draw.integers(0, 1 << 36, (2, 20_000)).astype(np.uint64))]
    part = suffixes._triple_part(triple, 16)
    assert (part.reshape(10, -1) == part[:20_000]).all() and part.min() >= 0
    count = np.bincount(part, minlength=16)
    assert len(count) == 16 and count.max() < 1.2 * count.mean()


def test_bytes_for_a_byte_of_a_batch():
    text = np.random.default_rng(5).integers(97, 123, 2_000_000).astype(np.uint8).tobytes()
    tracemalloc.start()
    try:
        part = suffixes._Part({"text": text, "lengths": [len(text)], "docs": [0]})
        tracemalloc.reset_peak()
        place, of = part.grouped()
        assert tracemalloc.get_traced_memory()[1] < 45 * len(text)
    finally:
        tracemalloc.stop()
    assert len(of) == len(part.place) and (np.diff(part.keys_at(place)[0].astype(np.float64)) >= 0).all()


def test_stored_texts_are_compressed(spark, monkeypatch):
    tables, stored = {}, suffixes.stored
    monkeypatch.setattr(suffixes, "stored", lambda df, label: tables.setdefault(label, stored(df, label)))
    rows = [(1, "the same words again and again " * 100), (2, "x" + "the same words again and again " * 100), (3, ""), (4, None)]
    found = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_bytes, len(r.kept)) for r in found} == {1: (3100, 3100), 2: (3101, 1), 3: (0, 0), 4: (0, 0)}
    assert tables["texts"].agg(F.sum(F.length("text"))).first()[0] < 1000
