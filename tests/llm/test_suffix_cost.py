"""What the suffix sort sorts, and how: only text that can repeat, by numbers of 64 bits."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricebars.llm import suffixes


def test_short_common_passages_are_not_sorted(spark, monkeypatch):
    """Passages of 30 bytes in all documents hold no string of 50; nothing of them is left to sort."""
    tables, stored = {}, suffixes.stored
    monkeypatch.setattr(suffixes, "stored", lambda df, label: tables.setdefault(label, stored(df, label)))
    draw = random.Random(5)
    own = lambda n: "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    common = [own(30) for _ in range(6)]
    rows = [(i, "".join(own(60) + draw.choice(common) for _ in range(5))) for i in range(20)]
    strings = {}
    for i, t in rows:
        for p in range(len(t.encode()) - 49):
            strings.setdefault(t.encode()[p : p + 50], set()).add(i)
    assert all(len(s) == 1 for s in strings.values())
    found = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.n_removed for r in found] == [0] * 20
    assert tables["parts"].agg(F.sum(F.length("text"))).first()[0] in (None, 0)


def test_places_and_their_keys():
    row = {"text": b"ab" * 60, "lengths": [70, 50], "docs": [0, 1]}
    part = suffixes._Part(row)
    assert part.place.tolist() == [p for p in range(120) if p % 3 and p + 18 <= (70 if p < 70 else 120)]
    first, second, last = part.keys()
    for p, a, b, c in zip(part.place.tolist(), first.tolist(), second.tolist(), last.tolist()):
        assert a.to_bytes(8) + b.to_bytes(8) + c.to_bytes(2) == row["text"][p : p + 18]


@pytest.mark.parametrize("high", [1, 3, 1 << 20, 1 << 63])
def test_distinct_rows_in_order(high):
    draw = np.random.default_rng(3)
    for count in (0, 1, 2, 3000):
        columns = [
            draw.integers(0, high, count, dtype=np.uint64, endpoint=True) << np.uint64(high == 1 << 63),
            draw.integers(0, 4, count).astype(np.uint64) * np.uint64(0x3FFFFFFFFFFFFFFF),
            draw.integers(0, 3, count).astype(np.uint16),
            draw.integers(0, 2, count),
        ]
        got, of = suffixes._distinct(*columns)
        every = list(zip(*(c.tolist() for c in columns)))
        want = sorted(set(every))
        assert list(zip(*(c.tolist() for c in got))) == want
        assert [want[k] for k in of.tolist()] == every


@pytest.mark.parametrize("ranges", [1, 2, 7, 4096, 5000])
def test_ranges_of_hashes(ranges):
    hashes = np.sort(np.random.default_rng(ranges).integers(0, 1 << 44, 20_000, dtype=np.uint64))
    hashes[-1] = (1 << 44) - 1
    part, place = suffixes._hash_part(hashes, ranges)
    assert (np.diff(part) >= 0).all() and part.min() >= 0 and part.max() == ranges - 1
    assert place.dtype == np.uint32
    same = part[1:] == part[:-1]
    assert (place[1:][same] >= place[:-1][same]).all()  # a wrapped number would fall
    assert len(set(zip(part.tolist(), place.tolist()))) > 19_900


@pytest.mark.parametrize("letters", [1, 2, 100, 256])
def test_places_grouped_by_key(letters):
    draw = np.random.default_rng(letters)
    some = draw.integers(0, letters, 40).astype(np.uint8)
    text = np.concatenate([np.r_[some[a : a + 30], draw.integers(0, letters, 3).astype(np.uint8)] for a in draw.integers(0, 11, 60)])
    part = suffixes._Part({"text": text.tobytes(), "lengths": [len(text) - 100, 83, 17], "docs": [0, 1, 2]})
    place, of = part.grouped()
    strings = [text[p : p + 18].tobytes() for p in part.place]
    assert [text[p : p + 18].tobytes() for p in place] == sorted(set(strings))
    assert [sorted(set(strings))[k] for k in of] == strings
    none = suffixes._Part({"text": b"short", "lengths": [5], "docs": [0]})
    assert [len(x) for x in none.grouped()] == [0, 0] and [len(x) for x in none.keys()] == [0, 0, 0]


def test_ranks_of_wide_and_narrow_keys():
    key = np.random.default_rng(8).integers(0, 50, 500).astype(np.uint64)
    (a, b), (c, d) = suffixes._ranked(key, 6), suffixes._ranked(key << np.uint64(58), 64)
    assert (b == d).all() and key[a].tolist() == key[c].tolist() == sorted(set(key.tolist()))


@pytest.mark.parametrize("letters", [2, 3, 26])
def test_strings_of_an_anchor(letters):
    """Every string begins where its least anchor says that its strings may, and there are fewer places than the anchor could reach."""
    draw = np.random.default_rng(letters)
    docs = [draw.integers(97, 97 + letters, n).astype(np.uint8) for n in (49, 50, 300, 2000)] + [np.tile(np.frombuffer(b"ab", np.uint8), 200)]
    found = [suffixes.anchors(d) for d in docs]
    doc = np.concatenate([np.full(len(p), i) for i, (p, _) in enumerate(found)])
    place, h = (np.concatenate(x) for x in zip(*found))
    first, last = suffixes._strings(doc, place, h >> np.uint64(20))
    for i, d in enumerate(docs):
        own = doc == i
        for p in range(len(d) - 49):
            inside = own & (place >= p) & (place + suffixes.ANCHOR <= p + 50)
            least = inside & (h == h[inside].min())
            assert least.any() and (first[least] <= p).all() and (p <= last[least]).all()
    assert (last - first)[doc == 3].mean() < 11
