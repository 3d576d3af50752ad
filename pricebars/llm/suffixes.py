"""Removal of repeated passages by a distributed difference-cover suffix sort.

A byte goes where it is covered by a string of ``LENGTH`` bytes that also starts in a document with a smaller id.
Such strings are found with a suffix order that is exact up to their length:

1.  *Sample.*  Places whose number is 1 or 2 modulo 3 are sampled.  Whatever two places are compared, one of the
    next three offsets has both in the sample.
2.  *Sort triples.*  A sampled place's first name is the rank of the triple of 6-byte letters that begins there
    (18 bytes), from a sort by key ranges over all batches.
3.  *Recurse on names.*  The names at offsets 0, 15 and 30, which are in the same residue class, are again a triple; its order is
    that of the first 48 bytes.  Strings of ``LENGTH`` bytes need no second level.
4.  *Merge the remaining suffixes.*  A string that begins 0, 1 or 2 bytes before a sampled place is sorted by the
    place's triple and the bytes that complete it before and behind, in one order for each of the three distances: whatever
    residues two equal strings begin at, they meet in one of these.
5.  *Compare neighbours.*  Equal neighbours of an order are equal strings; the smallest document among them keeps its own.

Before that, what cannot repeat is left out, without loss: of equal whole texts only the first takes part, and of a text only
the surroundings of anchors that several texts have.  An anchor is the place of the least hash of ``ANCHOR`` bytes in some
window, chosen so that every string of ``LENGTH`` bytes has one and equal strings have the same.

Texts are written once in batches of some megabytes.  A batch asks for what it needs as sorted distinct keys, dealt out by
key range in blocks of bytes, and gets its answers as blocks; a passage that is in every document is one key per batch.
Strings, of which only equality counts, are dealt by a hash of their triple of names and sorted where they meet.
Numpy does the work of a block inside the tasks, Spark deals them out.  Texts are compressed outside Python, and rows are counted
in 32 bits: an executor holds a batch and a range for each of its cores, however large the table is.
"""

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricebars.llm import blocks
from pricebars.llm.blocks import pack, sparing, unpack
from pricebars.llm.text import pieces, texts

LENGTH = 50
#: Longer anchors are more, but by chance in several texts more rarely.
ANCHOR = 36
#: Bytes of text in a batch, and keys that a range is meant to hold.
BATCH_BYTES = 8 << 20
RANGE = 1_000_000
#: Batches from which the bounds of the key ranges are taken, keys of each, and keys for each range: more where there are many ranges.
SAMPLED_BATCHES, SAMPLED_KEYS, RANGE_KEYS = 2_000, 64, 32
#: Rows that are put in their places at once: numpy takes 8 bytes for each meanwhile.
CHUNK = 1 << 20
#: Anchors are told apart by the upper bits of their hashes; below, a batch has room for its texts of ``LENGTH`` bytes and more.
_OWNER_BITS = 20
_LETTERS, _STEP = 18, 15
_DEPTH = 48
_ASKED = "part long, batch long, payload binary"
#: Vectored reads keep some 250 MB of buffers outside the heap of each executor.
_READING = {"parquet.hadoop.vectored.io.enabled": "false"}


# --- texts and anchors -------------------------------------------------------------------------------


def _batched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = TaskContext.get().partitionId() << 32
    for number, batch in enumerate(pieces(batches, BATCH_BYTES)):
        rows = texts(batch.column("text"))
        yield pa.record_batch({
            "batch": pa.array([first + number]),
            "doc_ids": pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
            "lengths": pa.array([[len(t) for t in rows]], pa.list_(pa.int64())),
            "digests": pa.array([[hashlib.sha256(t).digest()[:16] for t in rows]], pa.list_(pa.binary())),
            "text": pa.array([_packed(b"".join(rows))], pa.binary()),
        })


def _packed(text: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(text) if text else b""


def _rows(table: pa.Table | pa.RecordBatch) -> Iterator[dict]:
    """The rows of a table of batches, with their texts."""
    for row in table.to_pylist():
        if row["text"]:
            row["text"] = zstandard.ZstdDecompressor().decompress(row["text"])
        yield row


def anchors(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of one text."""
    size, window = len(text) - ANCHOR + 1, LENGTH - ANCHOR + 1
    if size < window:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    # 8 bytes, 16, 32, and 32 with the last 8: all 36 count
    eight = _eight(text, "<u8")
    sixteen = eight[:-8] * np.uint64(0xD6E8FEB86659FD93)
    sixteen ^= eight[8:]
    h = sixteen[:-16] * np.uint64(0xA0761D6478BD642F)
    h ^= sixteen[16:]
    h = h[:size] * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= eight[28:]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9FB21C651E98DF25)  # the upper bits count
    least = _sliding(np.minimum, h, window)
    padded = np.zeros(len(least) + 2 * (window - 1), np.uint64)
    padded[window - 1 : window - 1 + len(least)] = least
    place = np.flatnonzero(_sliding(np.maximum, padded, window) == h)
    return place, h[place]


def _eight(text: np.ndarray, kind: str, place: np.ndarray | slice = slice(None)) -> np.ndarray:
    """The 8 bytes from each place, or from every place that has them, as a number."""
    return np.ndarray(max(0, len(text) - 7), kind, text, strides=(1,))[place].astype(np.uint64)


def _sliding(of: np.ufunc, x: np.ndarray, window: int) -> np.ndarray:
    """Least or greatest of every ``window`` neighbours, by doubling."""
    width = 1
    while 2 * width <= window:
        x = of(x[:-width], x[width:])
        width *= 2
    return of(x[: len(x) - (window - width)], x[window - width :])


def _anchored(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, place in it and hash, without its lowest bits, of the anchors of a batch."""
    text, docs, places, hashes = np.frombuffer(row["text"], np.uint8), [], [], []
    start = 0
    for d, n in enumerate(row["lengths"]):
        place, h = anchors(text[start : start + n])
        docs.append(np.full(len(place), d))
        places.append(place)
        hashes.append(h >> np.uint64(_OWNER_BITS))
        start += n
    return np.concatenate(docs), np.concatenate(places), np.concatenate(hashes)


def _ask_anchors(ranges: int) -> Callable:
    """Distinct anchors of each batch, and whether more than one of its documents has them."""

    def ask(batches):
        for batch in batches:
            for row in _rows(batch):
                doc, _, h = _anchored(row)
                owner = np.cumsum(np.diff(doc, prepend=doc[:1]) > 0)  # of the texts that have anchors
                both = np.sort(_even(h) << np.uint64(_OWNER_BITS) | owner.astype(np.uint64))
                h = both >> np.uint64(_OWNER_BITS)
                starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.empty(0, np.int64)
                ends = np.r_[starts[1:], len(h)] - 1
                several = (both[starts] != both[ends]).astype(np.uint8) if len(h) else np.empty(0, np.uint8)
                yield from _dealt(row["batch"], *_hash_part(h[starts], ranges), several)

    return ask


def _even(hashes: np.ndarray) -> np.ndarray:
    """Other numbers for the hashes, one for one: those of anchors are the least of many, and ranges of low ones would hold most."""
    return hashes * np.uint64(0x9E3779B97F4A7C15) & np.uint64((1 << 64 - _OWNER_BITS) - 1)


def _hash_part(hashes: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """The range of each hash, and its place there in 32 bits: anchors that differ are rarely taken for one, which costs time only."""
    bits = 64 - _OWNER_BITS
    bounds = np.array([(i << bits) // ranges for i in range(ranges)], np.uint64)
    part = np.searchsorted(bounds, hashes, side="right") - 1
    surplus = max(0, (-(-(1 << bits) // ranges)).bit_length() - 32)
    return part, (hashes - bounds[part] >> np.uint64(surplus)).astype(np.uint32)


def _dealt(batch: int, part: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Blocks of sorted keys, one for each range that has some; ``part`` ascends."""
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    filled, ends = part[starts], np.r_[starts[1:], len(part)]
    for begin in range(0, len(filled), 64):
        some = slice(begin, begin + 64)
        blocks = [pack(*[c[s:e] for c in columns]) for s, e in zip(starts[some], ends[some])]
        yield pa.record_batch({
            "part": pa.array(filled[some].astype(np.int64)),
            "batch": pa.array(np.full(len(blocks), batch, np.int64)),
            "payload": pa.array(blocks, pa.binary()),
        })


def _answered(asked: pa.Table, answers: list[bytes]) -> pa.Table:
    return pa.table({"part": asked.column("part"), "batch": asked.column("batch"), "payload": pa.array(answers, pa.binary())})


def _answer_anchors(asked: pa.Table) -> pa.Table:
    """For each anchor whether several documents have it, whichever batches they are in."""
    (h, several), cuts = _columns(asked.column("payload"), "u4", "u1")
    first, place = _ranked(h.astype(np.uint64), 32)
    shared = _shared(place, several, len(first))
    return _answered(asked, [pack(r) for r in np.split(shared[place], cuts)])


def _shared(of: np.ndarray, several: np.ndarray, count: int) -> np.ndarray:
    """For each of ``count`` keys whether more than one row has it, or one that stands for several documents."""
    found = (np.bincount(of, minlength=count) > 1).astype(np.uint8)
    found[of[several.astype(bool)]] = 1
    return found


def _columns(payloads: pa.ChunkedArray, *types: str) -> tuple[list[np.ndarray], np.ndarray]:
    """The columns of some blocks, each block unpacked into its place, and where the second and later ones begin."""
    width = sum(np.dtype(t).itemsize for t in types)
    sizes = [zstandard.frame_content_size(b.as_buffer()) // width for b in payloads]
    ends = np.cumsum(sizes, dtype=np.int64)
    columns = [np.empty(ends[-1] if len(ends) else 0, t) for t in types]
    for payload, size, end in zip(payloads, sizes, ends):
        for column, block in zip(columns, unpack(payload.as_buffer(), *types)):
            column[end - size : end] = block
    return columns, ends[:-1]


# --- what can repeat ---------------------------------------------------------------------------------

_PARTS = "batch long, docs array<long>, doc_ids array<long>, starts array<long>, lengths array<long>, text binary"
#: Stands for a missing id: no document is smaller because of it.
_NONE = np.iinfo(np.int64).max


def _joined(answers: pa.Table, *types: str) -> list[np.ndarray]:
    """The blocks of a batch, in the order of their ranges."""
    return _columns(answers.sort_by("part").column("payload"), *types)[0]


def _candidates(whole: pa.Table, answers: pa.Table) -> pa.Table:
    """The parts of a batch's texts that anchors of several documents surround; copies of earlier texts have none."""
    (row,) = _rows(whole)
    copies = {d for x in answers.column("copies").to_pylist() if x for d in x}
    answers = answers.filter(pa.compute.is_valid(answers.column("payload")))
    doc, place, h = _anchored(row)
    _, of = _ranked(_even(h), 64 - _OWNER_BITS)
    (shared,) = _joined(answers, "u1")
    keep = shared.astype(bool)[of] if len(h) else np.empty(0, bool)
    keep &= ~np.isin(doc, list(copies))
    first, last = _strings(doc, place, h)
    doc, first, last = doc[keep], first[keep], last[keep]
    lengths = np.array(row["lengths"], np.int64)
    begin = np.cumsum(lengths) - lengths
    low = begin[doc] + np.maximum(first, 0)
    low = np.minimum.accumulate(low[::-1])[::-1]  # equal hashes may have it fall
    high = begin[doc] + np.minimum(last + LENGTH, lengths[doc])
    text = np.frombuffer(row["text"], np.uint8)
    starts, ends = _union(low, high, doc)
    owner = np.searchsorted(begin + lengths, starts, side="right")
    return pa.table({
        "batch": pa.array([row["batch"]]),
        "docs": pa.array([owner.tolist()], pa.list_(pa.int64())),
        "doc_ids": pa.array([[_NONE if row["doc_ids"][d] is None else row["doc_ids"][d] for d in owner]], pa.list_(pa.int64())),
        "starts": pa.array([(starts - begin[owner]).tolist()], pa.list_(pa.int64())),
        "lengths": pa.array([(ends - starts).tolist()], pa.list_(pa.int64())),
        "text": pa.array([_packed(b"".join(text[s:e].tobytes() for s, e in zip(starts, ends)))], pa.binary()),
    })


def _strings(doc: np.ndarray, place: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Between which places the strings begin that have each anchor for their least: none reaches a smaller neighbour."""
    first, last = place - (LENGTH - ANCHOR), place.copy()
    same = doc[1:] == doc[:-1]
    left, right = np.flatnonzero(same & (h[:-1] < h[1:])), np.flatnonzero(same & (h[1:] < h[:-1]))
    first[left + 1] = np.maximum(first[left + 1], place[left] + 1)
    last[right] = np.minimum(last[right], place[right + 1] - (LENGTH - ANCHOR) - 1)
    return first, last


def _union(low: np.ndarray, high: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by intervals that come in ascending order; runs of different groups stay apart."""
    if not len(low):
        return low, high
    reach = np.maximum.accumulate(high)
    new = np.r_[True, (low[1:] > reach[:-1]) | (group[1:] != group[:-1])]
    starts = np.flatnonzero(new)
    return low[starts], np.maximum.reduceat(high, starts)


# --- first names -------------------------------------------------------------------------------------


class _Part:
    """Sampled places of a batch's parts."""

    def __init__(self, row: dict):
        self.text = np.frombuffer(row["text"], np.uint8)
        self.lengths = np.array(row["lengths"], np.int64)
        self.docs = np.array(row["docs"], np.int64)
        self.begin = np.cumsum(self.lengths) - self.lengths
        left = np.repeat((self.begin + self.lengths).astype(np.int32), self.lengths)
        left -= np.arange(len(self.text), dtype=np.int32)
        sampled = left >= _LETTERS
        sampled[::3] = False
        self.place = np.flatnonzero(sampled).astype(np.int32)
        self.left = left[self.place]  # bytes up to the end of the part

    def keys(self) -> tuple[np.ndarray, ...]:
        """The triples of letters: the first 8 bytes at each place, the next 8, and the last 2."""
        return self.keys_at(self.place)

    def keys_at(self, p: np.ndarray) -> tuple[np.ndarray, ...]:
        last = self.text[p + 16].astype(np.uint16) << np.uint16(8) | self.text[p + 17]
        return _eight(self.text, ">u8", p), _eight(self.text, ">u8", p + 8), last

    def owners(self) -> np.ndarray:
        """For each place the number of its text in the batch."""
        return np.repeat(self.docs.astype(np.int32), self.lengths)[self.place]

    def several(self, of: np.ndarray) -> np.ndarray:
        """Whether more than one text of the batch has a key, for all distinct keys; ``of`` says which a place has."""
        owner, count = self.owners(), int(of.max(initial=0)) + 1 if len(of) else 0
        one, found = np.empty(count, np.int32), np.zeros(count, np.uint8)
        one[of] = owner  # of one of a key's places
        found[of[one[of] != owner]] = 1
        return found

    def grouped(self) -> tuple[np.ndarray, np.ndarray]:
        """One place for each distinct key, in ascending order of the keys, and which of them each place has.

        The letters of all places are sorted first, then the triples of their ranks.
        """
        if not len(self.place):
            return self.place, self.place
        letter, wide = self._letters()
        letter = _ranked(letter, 6 * wide, True)[1]
        three = [letter[self.place + at] for at in range(0, _LETTERS, 6)]
        del letter
        first, of = _grouped(*three)
        return self.place[first], of

    def _letters(self) -> tuple[np.ndarray, int]:
        """For every place that has them its next 6 bytes as a number, and the bits that each byte takes."""
        present = sum(np.bincount(self.text[i : i + CHUNK], minlength=256) for i in range(0, len(self.text), CHUNK)) > 0
        wide = int(present.sum() - 1).bit_length()
        one = np.frombuffer(self.text.tobytes().translate((np.cumsum(present) - 1).astype(np.uint8).tobytes()), np.uint8)
        three = one[:-2].astype(np.uint32)
        for at in (1, 2):
            three <<= np.uint32(wide)
            three |= one[at : len(one) - 2 + at]
        key = three[:-3].astype(np.uint64)
        key <<= np.uint64(3 * wide)
        key |= three[3:]
        return key, wide


def _ranked(key: np.ndarray, width: int, spent: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """One row for each distinct key of ``width`` bits, in ascending order, and the rank of every key among them, in 32 bits.

    With ``spent`` the keys are overwritten, and no other room for as many is taken than for the sort itself.
    """
    count, low = len(key), len(key).bit_length()
    room = key if spent else key.copy()
    if width + low <= 64:  # the row goes in the lower bits: sorting numbers is several times as fast as sorting rows by them
        room <<= np.uint64(low)
        room |= np.arange(count, dtype=np.uint32)
        room.sort()
        order = room.astype(np.uint32)  # its lower half
        order &= np.uint32((1 << low) - 1)
        room >>= np.uint64(low)
    else:
        order = np.argsort(room).astype(np.uint32)
        room[:] = room[order]
    new = np.ones(count, bool)
    np.not_equal(room[1:], room[:-1], out=new[1:])
    rank, of = room.view(np.uint32)[:count], room.view(np.uint32)[count:]
    np.cumsum(new, dtype=np.uint32, out=rank)
    rank -= np.uint32(1)
    for i in range(0, count, CHUNK):
        of[order[i : i + CHUNK]] = rank[i : i + CHUNK]
    return order[new], of.copy()


def _grouped(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One of each distinct rows of numbers that are not negative, in ascending order, and which of them each row is.

    Sorted by 64 bits at a time: a row's rank by the bits so far, and as many of the next as there is room for.
    """
    count = len(columns[0])
    if not count:
        return np.empty(0, np.uint32), np.empty(0, np.uint32)
    key, room = np.zeros(count, np.uint64), 64
    columns = list(columns)
    while columns:
        column = columns.pop(0)
        least = column.min()
        width = int(column.max() - least).bit_length()
        rest = (column - least).astype(np.uint64, copy=False)
        while width:
            if not room:
                key, room = _ranked(key, 64, True)[1].astype(np.uint64), 64 - count.bit_length()
            take = min(width, room)
            width, room = width - take, room - take
            bits = rest >> np.uint64(width) if width else rest
            bits &= np.uint64((1 << take) - 1)
            if take < 64:
                key <<= np.uint64(take)
                key |= bits
            else:
                key = bits
        column = rest = bits = None
    return _ranked(key, 64 - room, True)


def _distinct(*columns: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """The distinct rows in ascending order, and which of them each row is."""
    first, of = _grouped(*columns)
    return tuple(c[first] for c in columns), of


def _sample_keys(every: int) -> Callable:
    """The first 16 bytes of one in ``every`` keys of each batch, evenly spaced in the order of many more, taken all over it.

    The first of them is drawn for each batch: batches of similar texts have similar orders, and with the same places in each
    of them all samples would be near the same few keys, with ever more keys between.
    """

    def sample(batches):
        for batch in batches:
            for row in _rows(batch):
                part = _Part(row)
                count, draw = len(part.place), np.random.default_rng(row["batch"])
                many = min(count, 64 * (count // every + 1))
                part.place = part.place[((np.arange(many) + draw.random()) * (count / max(1, many))).astype(np.int64)]
                first, second, _ = part.keys()
                step = many * every / max(1, count)
                some = np.lexsort((second, first))[np.arange(draw.random() * step, many, max(step, 1)).astype(np.int64)]
                yield pa.record_batch({"key": pa.array([np.column_stack([first[some], second[some]]).tobytes()], pa.binary())})

    return sample


def _range_of(bounds: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The range of each key: how many bounds (rows of two numbers, ascending) are not above it.

    Where several bounds share their first 8 bytes, the next 8 decide, so a beginning that very many keys have is dealt
    out to as many ranges as its keys ask for.
    """
    found = np.searchsorted(bounds[:, 0], first, side="right").astype(np.int32)
    low = np.searchsorted(bounds[:, 0], first, side="left").astype(np.int32)
    met = np.flatnonzero(found > low).astype(np.uint32)
    met = met[np.argsort(low[met], kind="stable")]
    low = low[met]
    starts = np.flatnonzero(np.diff(low, prepend=-1))
    for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(low)]):
        same, at = met[start:stop], int(low[start])
        found[same] = at + np.searchsorted(bounds[at : int(found[same[0]]), 1], second[same], side="right")
    return found


def _ask_names(bounds: np.ndarray) -> Callable:
    def ask(batches):
        for batch in batches:
            for row in _rows(batch):
                part = _Part(row)
                place, of = part.grouped()
                several = part.several(of)
                del of
                keys = part.keys_at(place)
                yield from _dealt(row["batch"], _range_of(bounds, *keys[:2]), *keys, several)

    return ask


def _answer_names(asked: pa.Table) -> pa.Table:
    """The rank of each key within its range, and whether several texts have it.

    A row without batch says how many keys the range has.
    """
    (*columns, several), cuts = _columns(asked.column("payload"), "u8", "u8", "u2", "u1")
    first, of = _grouped(*columns)
    del columns
    shared = _shared(of, several, len(first))
    ranks, shares = np.split(of, cuts), np.split(shared[of], cuts)
    part = asked.column("part")[0].as_py()
    return pa.table({
        "part": pa.array([part] * (len(ranks) + 1), pa.int64()),
        "batch": pa.array([*asked.column("batch").to_pylist(), None], pa.int64()),
        "payload": pa.array([*[pack(np.diff(r, prepend=r[:1]), s) for r, s in zip(ranks, shares)], None], pa.binary()),
        "first": pa.array([*[int(r[0]) for r in ranks], None], pa.int64()),
        "held": pa.array([None] * len(ranks) + [len(first)], pa.int64()),
    })


# --- triples of names --------------------------------------------------------------------------------

def _ask_strings(ranges: int, state: bool) -> Callable:
    """Distinct triples of names with the bytes around them, and the first document of the batch that has them.

    Only triples of names that several texts have can belong to a repeated string.  With ``state`` there is one
    row instead, which says which places have a key and which one.
    """

    def ask(whole: pa.Table, names: pa.Table) -> pa.Table:
        (row,) = _rows(whole)
        part = _Part(row)
        names = names.sort_by("part")
        size = len(part.text)
        shared = np.zeros(size + 1, bool)
        local = np.zeros(size + 1, np.uint32)  # which distinct key of the batch: in the order of the names
        _, of = part.grouped()
        (rank, several), cuts = _columns(names.column("payload"), "u4", "u1")
        shared[part.place] = several.astype(bool)[of]
        local[part.place] = of
        del of, several
        keep = part.left >= _DEPTH
        place, left = part.place[keep], part.left[keep]
        keep = shared[place] & shared[place + _STEP] & shared[place + 2 * _STEP]
        place, left = place[keep], left[keep]
        part.place = part.left = keep = shared = None
        begin = np.repeat(part.begin.astype(np.int32), part.lengths)
        before = place - begin[place]
        del begin
        around = np.zeros(len(place), np.uint64)
        for side in (2, 1, 0):
            around <<= np.uint64(1)
            around |= (before >= side) & (left >= LENGTH - side)
        for at in (-2, -1, _DEPTH, _DEPTH + 1):
            inside = (before >= -at) if at < 0 else (left > at)
            around <<= np.uint64(8)
            if len(place):
                around |= np.where(inside, part.text[np.clip(place + at, 0, size - 1)], np.uint8(0))
        del before, left
        first, key = _grouped(local[place], local[place + _STEP], local[place + 2 * _STEP], around)
        triple, around = [local[place[first] + at] for at in (0, _STEP, 2 * _STEP)], around[first]
        del local
        # names of 40 bits: the ranks within each range after all that come before
        base = [f + b for f, b in zip(names.column("first").to_pylist(), names.column("before").to_pylist())]
        name = np.concatenate([
            np.cumsum(r, dtype=np.uint32).astype(np.uint64) + np.uint64(n) for r, n in zip(np.split(rank, cuts), base)
        ]) if base else np.empty(0, np.uint64)
        del rank
        triple = [name[t] for t in triple]
        del name
        range_of = _triple_part(triple, ranges)
        order = np.argsort(range_of, kind="stable")
        if state:
            asked_as = np.empty(len(order), np.uint32)
            asked_as[order] = np.arange(len(order), dtype=np.uint32)
            return _answered(
                pa.table({"part": pa.array([None], pa.int64()), "batch": pa.array([row["batch"]], pa.int64())}),
                [pack(asked_as[key], place.astype(np.uint32))],
            )
        least = np.full(len(first), _NONE)
        np.minimum.at(least, key, np.repeat(np.array(row["doc_ids"], np.int64), part.lengths)[place])
        del key, place
        columns = [range_of, *triple, around, least]
        del range_of, triple, around, least
        for i, column in enumerate(columns):
            columns[i] = column = column[order]
        asked = list(_dealt(row["batch"], *columns))
        empty = {"part": pa.array([], pa.int64()), "batch": pa.array([], pa.int64()), "payload": pa.array([], pa.binary())}
        return pa.Table.from_batches(asked) if asked else pa.table(empty)

    return ask


def _triple_part(triple: list[np.ndarray], ranges: int) -> np.ndarray:
    """The range of each triple, by a hash: a first name that very many strings have is dealt out like others."""
    h = np.zeros(len(triple[0]), np.uint64)
    for name in triple:
        h ^= name
        h *= np.uint64(0x9FB21C651E98DF25)
        h ^= h >> np.uint64(32)
    h >>= np.uint64(32)
    return (h * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)


def _answer_strings(asked: pa.Table) -> pa.Table:
    """For each key and side the first document that has the whole string."""
    (*triple, around, doc), cuts = _columns(asked.column("payload"), *["u8"] * 4, "i8")
    of = _grouped(*triple)[1]
    del triple
    around = around.view(np.int64)
    firsts = []
    for side in range(3):  # the bytes around are -2, -1, 48 and 49, from the highest; two of them complete a string
        has = np.flatnonzero(around >> 32 + side & 1).astype(np.uint32)
        string = of[has].astype(np.int64) << 16 | (around[has] >> 8 * side & 0xFFFF)
        at = _grouped(string)[1]  # sorted, and each compared with the one before
        least = np.full(int(at.max()) + 1 if len(at) else 0, _NONE)
        np.minimum.at(least, at, doc[has])
        first = np.full(len(doc), _NONE)
        first[has] = least[at]
        firsts.append(first)
    return _answered(asked, [pack(*f) for f in zip(*[np.split(f, cuts) for f in firsts])])


def _removed(whole: pa.Table, answers: pa.Table) -> pa.Table:
    """Document, start and end of the maximal runs to remove."""
    (row,) = whole.drop_columns("text").to_pylist()
    lengths = np.array(row["lengths"], np.int64)
    begin = np.cumsum(lengths) - lengths
    own = pa.compute.is_null(answers.column("part"))
    of, place = unpack(answers.filter(own).column("payload")[0].as_py(), "u4", "u4")
    firsts = _joined(answers.filter(pa.compute.invert(own)), "i8", "i8", "i8")
    owner = np.searchsorted(begin, place, side="right") - 1
    doc = np.array(row["doc_ids"], np.int64)[owner] if len(place) else np.empty(0, np.int64)
    del owner
    starts = np.unique(np.concatenate([place[first[of] < doc].astype(np.int64) - side for side, first in enumerate(firsts)]))
    owner = np.searchsorted(begin, starts, side="right") - 1
    shift = np.array(row["starts"], np.int64) - begin
    docs = np.array(row["docs"], np.int64)
    low = starts + shift[owner] if len(starts) else starts
    low, high, group = low, low + LENGTH, docs[owner] if len(starts) else starts
    order = np.lexsort((low, group))
    low, high, group = low[order], high[order], group[order]
    # runs of one document ascend; documents are kept apart by an offset
    wide = int(high.max(initial=0)) + 1
    low, high = _union(low + group * wide, high + group * wide, group)
    return pa.table({
        "batch": pa.array([row["batch"]] * len(low), pa.int64()),
        "doc": pa.array(low // wide if len(low) else low, pa.int64()),
        "low": pa.array(low % wide, pa.int64()), "high": pa.array(high - low + low % wide, pa.int64()),
    })


def _kept(whole: pa.Table, runs: pa.Table) -> pa.Table:
    """What is left of each text of a batch."""
    (row,) = _rows(whole)
    copies = {d for x in runs.column("copies").to_pylist() if x for d in x}
    spans: dict[int, list[tuple[int, int]]] = {}
    runs = runs.filter(pa.compute.is_valid(runs.column("doc")))
    for d, low, high in sorted(zip(*(runs.column(c).to_pylist() for c in ("doc", "low", "high")))):
        spans.setdefault(d, []).append((low, high))
    out, start = [], 0
    for d, (doc_id, n) in enumerate(zip(row["doc_ids"], row["lengths"])):
        text = row["text"][start : start + n]
        start += n
        found = [(0, n)] if d in copies else spans.get(d, [])
        ends = [0, *[high for _, high in found]]
        left = b"".join(text[a:b] for a, b in zip(ends, [*[low for low, _ in found], n]))
        out.append({
            "doc_id": doc_id, "n_bytes": n, "n_removed": n - len(left), "n_spans": len(found),
            "spans": [{"start": a, "end": b} for a, b in found], "kept": left,
        })
    return pa.Table.from_pylist(out, schema=_result())


def _result() -> pa.Schema:
    long = pa.int64()
    return pa.schema([
        ("doc_id", long), ("n_bytes", long), ("n_removed", long), ("n_spans", long),
        ("spans", pa.list_(pa.struct([("start", long), ("end", long)]))), ("kept", pa.binary()),
    ])


# --- the operator ------------------------------------------------------------------------------------


def stored(df: DataFrame, label: str) -> DataFrame:
    return blocks.stored(df, label, _READING)


def _copies(whole: DataFrame) -> DataFrame:
    """``batch, copies``: places in the batch of texts that equal one of a smaller id."""
    each = whole.select("batch", F.posexplode(F.arrays_zip("doc_ids", "lengths", "digests")).alias("place", "of"))
    each = each.where(F.col("of.lengths") >= LENGTH).select("batch", "place", "of.doc_ids", "of.digests")
    first = each.groupBy("digests").agg(F.min("doc_ids").alias("first"))
    later = each.join(first, "digests").where("first is not null and (doc_ids is null or doc_ids > first)")
    return later.groupBy("batch").agg(F.collect_list(F.col("place").cast("long")).alias("copies"))


def _bytes(batches: DataFrame) -> int:
    return batches.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda total, n: total + n))).first()[0] or 0


def _bounds(parts: DataFrame, size: int, ranges: int) -> np.ndarray:
    """Bounds of the key ranges, from some 32 keys for each range: 512 bytes of the driver's memory for a million keys."""
    n = parts.count()
    step = max(1, -(-n // SAMPLED_BATCHES))
    some = parts.where(F.pmod(F.xxhash64("batch"), F.lit(step)) == 0) if step > 1 else parts
    number = max(SAMPLED_KEYS * min(n, SAMPLED_BATCHES), RANGE_KEYS * ranges)
    every = max(1, size * 2 // 3 // step // max(1, number))
    found = some.mapInArrow(_sample_keys(every), "key binary").toArrow().column("key").to_pylist()
    keys = np.frombuffer(b"".join(found), np.uint64).reshape(-1, 2)
    keys = keys[np.lexsort((keys[:, 1], keys[:, 0]))]
    return np.unique(keys[np.linspace(0, len(keys) - 1, ranges + 1).astype(np.int64)[1:-1]], axis=0) if len(keys) else keys


def _found(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The batches of texts, which of them are copies, and the runs to remove from the others."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    whole = stored(
        rows.mapInArrow(_batched, "batch long, doc_ids array<long>, lengths array<long>, digests array<binary>, text binary"),
        "texts",
    )
    size = _bytes(whole)
    copies = stored(_copies(whole), "copies")
    ranges = max(1, size // 8 // RANGE)
    asked = whole.mapInArrow(_ask_anchors(ranges), _ASKED)
    shared = stored(asked.groupBy("part").applyInArrow(_answer_anchors, _ASKED), "anchors")
    known = shared.unionByName(copies, allowMissingColumns=True)
    parts = whole.groupBy("batch").cogroup(known.groupBy("batch")).applyInArrow(_candidates, _PARTS)
    parts = stored(parts, "parts")

    size = _bytes(parts)
    ranges = max(1, size * 2 // 3 // RANGE)
    asked = parts.mapInArrow(_ask_names(_bounds(parts, size, ranges)), _ASKED)
    named = asked.groupBy("part").applyInArrow(_answer_names, f"{_ASKED}, first long, held long")
    named = stored(named, "names")
    held = named.where("batch is null").select("part", "held")
    before = F.sum("held").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = held.select("part", F.coalesce(before, F.lit(0)).alias("before"))  # a row for each of ``ranges``
    names = named.where("batch is not null").join(F.broadcast(offsets), "part")
    met = parts.groupBy("batch").cogroup(names.groupBy("batch"))
    asked = met.applyInArrow(_ask_strings(ranges, False), _ASKED)
    firsts = stored(asked.groupBy("part").applyInArrow(_answer_strings, _ASKED), "firsts")
    # which keys a batch has asked for is worked out again: that takes less room than to keep them
    firsts = firsts.unionByName(met.applyInArrow(_ask_strings(ranges, True), _ASKED))
    runs = parts.groupBy("batch").cogroup(firsts.groupBy("batch"))
    runs = stored(runs.applyInArrow(_removed, "batch long, doc long, low long, high long"), "runs")
    return whole, copies, runs


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, spans, kept`` of every row of ``doc_id, text``.

    Texts are UTF-8 bytes, null ones empty.  ``spans`` are the maximal removed runs, ``kept`` what is left, joined.  Strings
    never cross documents and are judged on the whole input.  Rows that share an id don't remove from each other; rows
    without an id lose to all that have one and not to each other.  Other columns are ignored; no rows give none.
    """
    with sparing(docs.sparkSession, _READING):
        whole, copies, runs = _found(docs)
    runs = runs.unionByName(copies, allowMissingColumns=True)
    return whole.groupBy("batch").cogroup(runs.groupBy("batch")).applyInArrow(
        _kept,
        "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start: long, end: long>>, kept binary",
    )
