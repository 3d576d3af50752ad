"""Benchmark decontamination by the q-gram lemma.

A text that holds an item of m characters with at most k edits shares at least (m - q + 1) - k q q-grams with it, on
diagonals (place in the text less place in the item) that lie within k of each other.  Hits are counted in bands of 2 (k + 1)
diagonals that overlap by half, so one band holds them all; bands that reach the bound are verified by an alignment within
the band, which gives the place and the exact number of edits.  Nothing is lost on the way.

Texts are scanned whole, each row by itself, so a passage in very many documents is no hot key.  The benchmark is
cut into blocks of about ``BLOCK`` characters, one block to a pass over the texts: its items come to the driver, go out with the
tasks, and the finds are written before the next block's turn, so neither the driver nor a task holds more than one.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebars.sources.store import materialise

Q = 8
#: Edits allowed, as a share of an item's characters; fewer where the lemma would not ask for a single shared q-gram.
EDITS = 0.1
#: Characters of the benchmark that are looked for in one pass.
BLOCK = 200_000
#: Characters of text that are scanned in one go, and of items that are aligned in one go.
SCAN, ALIGNED = 2_000_000, 500_000
_BITS = 22
_COST = 20  # a state of the alignment holds its cost above this bit and its start below
_FOUND = "array<struct<item_id: long, start: int, end: int, edits: int>>"


def normal(text: str | None) -> str:
    """Lower case, every run of white space one blank."""
    return " ".join((text or "").lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(text: np.ndarray, q: int = Q) -> np.ndarray:
    """A hash of ``_BITS`` bits of the q characters from each place on."""
    size = max(0, len(text) - q + 1)
    h = np.zeros(size, np.uint32)
    for k in range(q):
        h *= np.uint32(0x01000193)
        h += text[k : k + size]
    h *= np.uint32(0x9E3779B1)
    h >>= np.uint32(32 - _BITS)
    return h


@dataclass(frozen=True)
class Items:
    """The items of a block, ready to be looked for."""

    ids: list[int]
    codes: list[np.ndarray]
    size: np.ndarray
    budget: np.ndarray
    least: np.ndarray
    starts: np.ndarray  # by hash: where its places begin in the two arrays that follow
    item: np.ndarray
    place: np.ndarray


def index(items: list[tuple[int, str]], edits: float = EDITS, q: int = Q) -> Items:
    """Items with the same normal text stay separate; those of fewer than q characters match nothing."""
    kept = sorted((i, normal(t)) for i, t in items if i is not None)
    kept = [(i, t) for i, t in kept if len(t) >= q]
    chars = [codes(t) for _, t in kept]
    size = np.array([len(c) for c in chars], np.int64)
    budget = np.minimum((size * edits).astype(np.int64), (size - q) // q)
    hashes = [grams(c, q) for c in chars]
    h = np.concatenate([*hashes, np.empty(0, np.uint32)])
    order = np.argsort(h, kind="stable")
    count = np.array([len(x) for x in hashes], np.int64)
    place = (np.arange(len(h)) - np.repeat(np.cumsum(count) - count, count))[order]
    item, h = np.repeat(np.arange(len(kept)), count)[order], h[order]
    # Of the places that a q-gram has within one half band of an item the first and the last are enough: a place of the
    # text lies on at most two half bands with all of them, and these two give both.
    cell = place // (budget[item] + 1)
    same = (h[1:] == h[:-1]) & (item[1:] == item[:-1]) & (cell[1:] == cell[:-1])
    ends = ~(np.r_[False, same] & np.r_[same, False]) if len(h) else np.empty(0, bool)
    h, item, place = h[ends], item[ends], place[ends]
    starts = np.r_[0, np.bincount(h, minlength=1 << _BITS).cumsum()]
    return Items([i for i, _ in kept], chars, size, budget, size - q + 1 - budget * q, starts.astype(np.int64), item, place)


def candidates(text: np.ndarray, items: Items, ends: np.ndarray, q: int = Q) -> tuple[np.ndarray, ...]:
    """Document, item and first diagonal of every band with enough q-grams of one document; these end at ``ends``.

    A q-gram of the text counts in every band in which the item has it, at least once and at most twice.
    """
    h = grams(text, q)
    count = items.starts[1:] - items.starts[:-1]
    hit = np.flatnonzero(count[h])
    n = count[h[hit]].astype(np.int64)
    place = np.repeat(hit, n)
    at = np.repeat(items.starts[h[hit]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    item = items.item[at]
    half = items.budget[item] + 1
    # diagonals from 0 on: no item is longer than the offset
    offset = int(items.size.max(initial=0))
    band = (place - items.place[at] + offset) // half
    span = int(band.max(initial=0)) + 2
    # two half bands make a band; the band that begins before the first hit holds no more than the next
    doc = np.searchsorted(ends, place)
    keys, hits = np.unique((doc * len(items.ids) + item) * span + band, return_counts=True)
    pair = np.flatnonzero(np.diff(keys) == 1)
    together = hits.copy()
    together[pair] += hits[pair + 1]
    keys = keys[together >= items.least[keys // span % len(items.ids)]]
    (doc, item), band = divmod(keys // span, len(items.ids)), keys % span
    return doc, item, band * (items.budget[item] + 1) - offset


def align(
    text: np.ndarray, items: Items, item: np.ndarray, low: np.ndarray, begin: np.ndarray, end: np.ndarray
) -> tuple[np.ndarray, ...]:
    """Start, end and edits of the best alignment of each item with the text from begin to end near a band of diagonals.

    All candidates advance together, one character of the item at a time; a state is a diagonal.
    """
    k, m = items.budget[item], items.size[item]
    low = low - k
    width, rows = int((4 * k + 2).max()), int(m.max())
    diagonal = np.arange(width)
    pattern = np.zeros((len(item), rows), np.uint32)
    for c, i in enumerate(item.tolist()):
        pattern[c, : items.size[i]] = items.codes[i]
    at = low[:, None] + np.arange(rows + width)
    window = np.where((at >= begin[:, None]) & (at < end[:, None]), text[np.clip(at, 0, len(text) - 1)], np.uint32(0xFFFFFFFF))
    one, far = 1 << _COST, np.int64(1 << 50)
    state = np.where(diagonal < (4 * k + 2)[:, None], diagonal, far)
    for i in range(rows):
        new = state + (window[:, i : i + width] != pattern[:, i, None]) * one
        new[:, :-1] = np.minimum(new[:, :-1], state[:, 1:] + one)
        new = np.minimum.accumulate(new - diagonal * one, axis=1) + diagonal * one
        state = np.where((i < m)[:, None], new, state)
    last = state.argmin(axis=1)
    best = state[np.arange(len(item)), last]
    return low + (best & (one - 1)), low + m + last, best >> _COST


def scan(texts: list[str], items: Items) -> list[list[dict]]:
    """For each normal text the items it holds, with place and edits; of overlapping finds of an item the best.

    Texts are joined to be scanned in one go, but each is matched and aligned by itself.
    """
    found: list[list[dict]] = [[] for _ in texts]
    if not texts or not items.ids:
        return found
    joined = codes("\x00".join(texts))
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    starts = ends - [len(t) for t in texts]
    doc, item, low = candidates(joined, items, ends)
    order = np.argsort(items.size[item], kind="stable")
    begin = 0
    while begin < len(order):
        # the states of an alignment are some hundred bytes for each character of its items
        longest = items.size[item[order[min(begin + 255, len(order) - 1)]]]
        part = order[begin : begin + max(1, min(256, ALIGNED // int(longest)))]
        begin += len(part)
        chosen, own = item[part], doc[part]
        first, end, edits = align(joined, items, chosen, low[part], starts[own], ends[own])
        good = edits <= items.budget[chosen]
        for i, d, a, b, e in zip(chosen[good], own[good], first[good], end[good], edits[good]):
            a, b = max(int(a), int(starts[d])), min(int(b), int(ends[d]))
            place = {"start": a - int(starts[d]), "end": b - int(starts[d]), "edits": int(e)}
            found[d].append({"item_id": items.ids[i]} | place)
    return [_best(f) for f in found]


def _best(found: list[dict]) -> list[dict]:
    kept: list[dict] = []
    for new in sorted(found, key=lambda f: (f["item_id"], f["edits"], f["start"])):
        if not any(k["item_id"] == new["item_id"] and k["start"] < new["end"] and new["start"] < k["end"] for k in kept):
            kept.append(new)
    return sorted(kept, key=lambda f: (f["item_id"], f["start"]))


def _matches(block: list[tuple[int, str]], edits: float, text: Column) -> Column:
    @F.arrow_udf(_FOUND)
    def looked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        items = index(block, edits)
        for column in batches:
            rows, texts, size = [], [], 0
            for t in column:
                text = normal(t.as_py())
                texts.append(text)
                size += len(text)
                if size > SCAN:
                    rows += scan(texts, items)
                    texts, size = [], 0
            yield pa.array(rows + scan(texts, items), _arrow())

    return looked(text)


def _arrow() -> pa.DataType:
    whole = pa.int32()
    return pa.list_(pa.struct([("item_id", pa.int64()), ("start", whole), ("end", whole), ("edits", whole)]))


def blocks(benchmark: DataFrame, block: int = BLOCK) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of about ``block`` characters, brought over one at a time; null items are left out."""
    rows = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // block)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(n, 1)))
    for i in range(n):
        yield [tuple(r) for r in rows.where(part == i).collect()]


def _looked(docs: DataFrame, benchmark: DataFrame, edits: float, block: int) -> DataFrame:
    """``row, matches``: the caller's columns as one struct, which no name of ours can clash with, and the finds."""
    found = docs.select(F.struct("*").alias("row"), F.array().cast(_FOUND).alias("matches"))
    for i, items in enumerate(blocks(benchmark, block)):
        found = materialise(found, "matches") if i else found
        found = found.select("row", F.concat("matches", _matches(items, edits, F.col("row.text"))).alias("matches"))
    return found


def with_matches(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, block: int = BLOCK) -> DataFrame:
    """``docs`` with ``matches``: the items a text holds within the edit budget, where, and with how many edits.

    Places are in the text in lower case with single blanks.  Null and empty texts, and an empty benchmark, give no
    matches; rows are looked at one by one, so repeats match alike, and texts are read whole.  Null items, and items under 8
    characters, match nothing.  A column ``matches`` is replaced; others stay as they are.
    """
    found = _looked(docs, benchmark, edits, block)
    return found.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != "matches"], "matches")


def matches(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, block: int = BLOCK) -> DataFrame:
    """One row ``doc_id, item_id, start, end, edits`` for each item that a document holds."""
    found = _looked(docs.select("doc_id", "text"), benchmark, edits, block)
    return found.select("row.doc_id", F.inline("matches"))


def clean(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns as they are; see ``with_matches`` for odd rows."""
    return _looked(docs, benchmark, edits, block).where(F.size("matches") == 0).select("row.*")
