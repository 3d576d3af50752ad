"""Token-id files: documents in ascending order, each compressed by itself with one shared zstandard dictionary.

A file set is a folder with two Parquet tables.  ``dictionary`` has one row ``sha256, content``.  ``blocks``
has rows of some megabytes, in file order: ``payload`` holds the documents' frames one after the other,
``offsets`` where each begins (and the last ends), ``doc_ids`` and ``n_tokens`` whose they are, ``sha256`` the dictionary
needed, ``width`` the bytes of an id, little-endian, and ``shard, first_token`` where the block's ids lie: so many
ids of its shard come before.  ``first_doc, last_doc`` prune a look-up to the blocks, and offsets to the frames, that
hold a document.  Parquet is only the container: it reaches any store that Spark reads, and commits
whole files when a task is run again.
"""

import hashlib
import json
import os
import string
import sys
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricebars.llm.blocks import sparing
from pricebars.llm.sampling import bounded, with_text
from pricebars.llm.text import pieces

END = 2
TOKENIZER = "byte_bpe_50k.json"
#: The dictionary: its size, and the documents that it is trained on at most.
DICTIONARY_BYTES = 64 << 10
SAMPLE = 1_000
LEVEL = 1
#: A block ends beyond so many compressed bytes or documents.
BLOCK_BYTES, BLOCK_DOCS = 2 << 20, 4_096
#: Pieces whose ids a worker remembers beside those of the texts at hand, words that go through the tokenizer in one call, and
#: bytes of text that are encoded at a time.
REMEMBERED = 600_000
WORDS = 500
#: What the pattern leaves whole after letters; an apostrophe might begin an ending.
_MARKS = "".join(set(string.punctuation) - {"'"})
CUT = 4 << 20

#: Shards of a part of the ids are numbered from its number times this.
SHARDS = 1 << 24

_BLOCKS = (
    "shard int, block int, first_doc long, last_doc long, first_token long, doc_ids array<long>, n_tokens array<long>, "
    "offsets array<long>, sha256 string, width int, payload binary"
)


def tokenizer_file(name: str) -> str:
    """A file's path as it is, or the name of one of the installed public vocabularies."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of whole texts, each followed by ``end``, as the tokenizer gives them, but several times as fast.

    A byte-level tokenizer splits texts by its pattern before it merges, and never joins what is on both sides of a blank or a
    line end that a visible character follows and that the cut comes before.  So texts are cut there, each distinct piece is
    encoded once and remembered, and the ids are put together.  Pieces are remembered in two halves: when the newer one has half of
    ``REMEMBERED``, it becomes the older one, and what has not been met since goes.  A text with other white space at a cut,
    and every text for another kind of tokenizer, is encoded whole.
    """

    def __init__(self, name: str, end: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file(name))
        self.end = end
        # what is worth remembering is remembered here; the tokenizer's own memory outlives it and would add up by task
        if resize := getattr(self.tokenizer.model, "_resize_cache", None):
            resize(0)
        kind = json.loads(self.tokenizer.to_str())
        before = kind["pre_tokenizer"] or {}
        self.cuts = (
            kind["normalizer"] is None and kind["model"]["type"] == "BPE" and not kind["model"].get("ignore_merges")
            and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
            and not any(self.hidden(t["content"]) for t in kind["added_tokens"])
        )
        # ids of pieces; those that may not be cut off have no ids but False
        self.known: dict[str, bytes | bool] = {}
        self.older: dict[str, bytes | bool] = {}
        # byte-level vocabularies write visible Latin-1 characters as they are, and the other bytes from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.letters = np.arange(256, dtype="<u4")
        self.letters[hidden] = 256 + np.arange(len(hidden))
        self.blank = chr(self.letters[32])
        self.marks: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.begins[[i for t, i in vocabulary.items() if t[:1] == self.blank]] = True
        affixes = kind["model"].get("continuing_subword_prefix") or kind["model"].get("end_of_word_suffix")
        self.joins = bool(affixes) or any(self.blank in t[1:] and self.may_join(t) for t in vocabulary)

    @staticmethod
    def hidden(added: str) -> bool:
        """Whether an added token could lie in letters with marks behind them, or over a cut."""
        letters = added.rstrip(_MARKS)
        return not letters or letters.isalpha() or any(c.isspace() for c in added)

    def may_join(self, token: str) -> bool:
        """Whether a token may reach over the blank between two words of letters; only then do neighbours change a word's ids."""
        bytes_of = {chr(c): b for b, c in enumerate(self.letters.tolist())}
        try:
            parts = bytes(bytes_of[c] for c in token).decode().split(" ")
        except (KeyError, UnicodeDecodeError):
            return any(a != self.blank and b == self.blank for a, b in zip(token, token[1:]))
        return any(parts[:-1]) and all(p.isalpha() for p in parts if p)

    def one(self, piece: str) -> bytes:
        """Ids of letters only, perhaps after a blank, or of marks only: what the pattern leaves whole."""
        return self.ids(piece).tobytes()

    def ids(self, piece: str) -> np.ndarray:
        written = self.letters[np.frombuffer(piece.encode(), np.uint8)].tobytes().decode("utf-32-le")
        return np.array([t.id for t in self.tokenizer.model.tokenize(written)], "<u4")

    def words(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words of letters only, each after a blank.

        Many go through the model at once: no token reaches over the blank before a word, so it merges each as if it
        were alone, and a word's ids start where a token begins with a blank.
        """
        for start in range(0, len(words), WORDS):
            some = words[start : start + WORDS]
            ids = np.empty(0, "<u4") if self.joins else self.ids(" " + " ".join(some))
            starts = (4 * np.flatnonzero(self.begins[ids])).tolist()
            if len(starts) == len(some):
                joined = ids.tobytes()
                yield from map(joined.__getitem__, map(slice, starts, [*starts[1:], len(joined)]))
            else:
                yield from (self.one(" " + w) for w in some)

    def learn(self, new: list[str]) -> None:
        """Remember the ids of pieces that are not among the newer ones."""
        known, older, words, rest, ended = self.known, self.older, [], [], []
        for p in new:
            if (ids := older.get(p)) is not None:
                known[p] = ids
            elif p.isalpha():
                words.append(p)
            elif (stem := p.rstrip(_MARKS)).isalpha():
                ended.append((p, stem))
            elif p[:1] != "\x01" and ((first := p[1:2] if p[:1] == "\n" else p[:1]) <= " " or first.isspace()):
                known[p] = False
            else:
                rest.append(p)
        for stem in {stem for _, stem in ended if stem not in known}.difference(words):
            if (ids := older.get(stem)) is not None:
                known[stem] = ids
            else:
                words.append(stem)
        known.update(zip(words, self.words(words)))
        for p, stem in ended:
            end = p[len(stem) :]
            if (marks := self.marks.get(end)) is None:
                marks = self.one(end)
                if len(self.marks) < WORDS:
                    self.marks[end] = marks
            known[p] = known[stem] + marks
        chunks = [p[1:] if p[0] == "\x01" else p if p[0] == "\n" else " " + p for p in rest]
        for p, e in zip(rest, self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)):
            known[p] = array("I", e.ids).tobytes()

    def whole(self, text: str) -> np.ndarray:
        return np.array([*self.tokenizer.encode(text, add_special_tokens=False).ids, self.end], "<u4")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not texts or not self.cuts:
            return [self.whole(t) for t in texts]
        # every piece but the first of a text (marked) follows a blank, or begins with its line end
        marked = ["\x01" + t.replace("\n", " \n") if "\x01" not in t else "\x01 " for t in texts]
        split = pc.split_pattern(pa.array(marked, pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        if len(self.known) > REMEMBERED // 2:
            self.known, self.older = {}, self.known
        found = list(map(self.known.get, distinct))
        new = [k for k, i in enumerate(found) if i is None]
        self.learn([distinct[k] for k in new])
        for k in new:
            found[k] = self.known[distinct[k]]
        bad = np.zeros(len(found), bool)
        if False in found:
            bad[:] = [i is False for i in found]
            found = [i or b"" for i in found]
        flat = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        at = (np.cumsum(size) - size)[codes]
        n = size[codes]
        after = np.cumsum(n)
        joined = flat[np.repeat(at - (after - n), n) + np.arange(after[-1])]
        offsets = split.offsets.to_numpy()
        cuts = np.r_[0, after][offsets]
        wrong = np.r_[0, np.cumsum(bad[codes])][offsets]
        return [
            self.whole(t) if wrong[i] < wrong[i + 1] else np.append(joined[cuts[i] : cuts[i + 1]], np.uint32(self.end))
            for i, t in enumerate(texts)
        ]


def encoder_of(name: str, end: int) -> Encoder:
    """This process's encoder: what it has learnt serves all tasks that a Python worker runs, up to ``REMEMBERED`` pieces.

    Functions travel with each task, and with them the globals of this module, so it is kept where they can't reach.
    """
    held = vars(sys).setdefault("_token_file_encoders", {})
    if (name, end) not in held:
        held.clear()
        held[name, end] = Encoder(name, end)
    return held[name, end]


def width_of(name: str, end: int) -> int:
    """Bytes of an id: 2 where all ids of the vocabulary fit, else 4."""
    from tokenizers import Tokenizer

    return 2 if max(Tokenizer.from_file(tokenizer_file(name)).get_vocab_size(), end + 1) <= 1 << 16 else 4


def train_dictionary(docs: DataFrame, tokenizer: str = TOKENIZER, end: int = END) -> bytes:
    """A dictionary from the id arrays of a bounded sample; empty where there is too little to learn from."""
    width = width_of(tokenizer, end)

    def arrays(batches):
        encoder = encoder_of(tokenizer, end)
        for batch in batches:
            rows = encoder.encode([t or "" for t in batch.column("text").to_pylist()])
            yield pa.record_batch({"ids": pa.array([r.astype(f"<u{width}").tobytes() for r in rows], pa.binary())})

    sample = with_text(docs, bounded(docs.select("doc_id"), SAMPLE, 4)).select("text")
    found = sorted(sample.mapInArrow(arrays, "ids binary").toArrow().column("ids").to_pylist())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, found).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _pack(tokenizer: str, end: int, width: int, dictionary: bytes, first_shard: int = 0) -> Callable:
    sha256 = hashlib.sha256(dictionary).hexdigest()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared).compress
        encoder = encoder_of(tokenizer, end)
        shard, block, before = first_shard + TaskContext.get().partitionId(), 0, 0
        ids, counts, frames, held = [], [], [], 0

        def closed():
            known = [i for i in ids if i is not None]
            row = {
                "shard": shard, "block": block, "first_doc": min(known, default=None),
                "last_doc": max(known, default=None), "first_token": before, "doc_ids": ids, "n_tokens": counts,
                "offsets": np.cumsum([0, *map(len, frames)]).tolist(), "sha256": sha256, "width": width,
                "payload": b"".join(frames),
            }
            return pa.RecordBatch.from_pylist([row], schema=_schema())

        for batch in pieces(batches, CUT):
            encoded = encoder.encode([t or "" for t in batch.column("text").to_pylist()])
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), encoded):
                frame = compress(found.astype(f"<u{width}").tobytes())
                ids.append(doc_id)
                counts.append(len(found))
                frames.append(frame)
                held += len(frame)
                if held >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS:
                    yield closed()
                    before, block = before + sum(counts), block + 1
                    ids, counts, frames, held = [], [], [], 0
        if ids:
            yield closed()

    return pack


def _schema() -> pa.Schema:
    long, longs = pa.int64(), pa.list_(pa.int64())
    return pa.schema([
        ("shard", pa.int32()), ("block", pa.int32()), ("first_doc", long), ("last_doc", long), ("first_token", long),
        ("doc_ids", longs), ("n_tokens", longs), ("offsets", longs), ("sha256", pa.string()), ("width", pa.int32()),
        ("payload", pa.binary()),
    ])


def _parts(rows: DataFrame, parts: int) -> list[DataFrame]:
    """The rows in about equal parts by ascending id, rows without one first; all rows of an id are in one part."""
    shares = [i / parts for i in range(1, parts)]
    found = rows.agg(F.percentile_approx("doc_id", shares, 1000).alias("b")).first().b if shares else None
    bounds = [F.lit(b) for b in sorted(set(found or []))]
    ends = zip([None, *bounds], [*bounds, None])
    cuts = [(F.lit(True) if a is None else F.col("doc_id") >= a, F.lit(True) if b is None else F.col("doc_id") < b) for a, b in ends]
    return [rows.where((F.col("doc_id").isNull() if i == 0 else F.lit(False)) | low & high) for i, (low, high) in enumerate(cuts)]


def write(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end: int = END, parts: int = 1) -> None:
    """Write ``doc_id, text`` of every row to a new file set at ``path``.

    Null texts are empty: a document of ``end`` alone.  Rows without doc_id come first, rows that share one follow
    each other in an order fixed by their texts.  Other columns are ignored; no rows give a file set without blocks.

    With ``parts`` the ids are shuffled and written so many ranges one after the other, each of which reads ``docs``: less disk,
    as a range's shuffle files go before the next one's come.
    """
    dictionary = train_dictionary(docs, tokenizer, end)
    spark = docs.sparkSession
    known = [(hashlib.sha256(dictionary).hexdigest(), dictionary)]
    spark.createDataFrame(known, "sha256 string, content binary").write.parquet(f"{path}/dictionary")
    order = ["doc_id", F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    width = width_of(tokenizer, end)
    with sparing(docs.sparkSession):
        for i, part in enumerate(_parts(rows, parts)):
            dealt = part.repartitionByRange(*order).sortWithinPartitions(*order)
            packed = dealt.mapInArrow(_pack(tokenizer, end, width, dictionary, i * SHARDS), _BLOCKS)
            packed.write.mode("append" if i else "errorifexists").parquet(f"{path}/blocks")


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    return tuple(spark.read.parquet(f"{path}/dictionary").first())


def _frames(block: dict, sha256: str, dictionary: bytes, wanted: set | None = None) -> Iterable[tuple[int, np.ndarray]]:
    """Place in the block and ids of each document, or of those ``wanted``; only their frames are read."""
    if block["sha256"] != sha256:
        raise ValueError(f"block needs dictionary {block['sha256']}, the folder has {sha256}")
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    decompress = zstandard.ZstdDecompressor(dict_data=shared).decompress
    payload, offsets = memoryview(block["payload"]), block["offsets"]
    for i, doc_id in enumerate(block["doc_ids"]):
        if wanted is None or doc_id in wanted:
            ids = np.frombuffer(decompress(payload[offsets[i] : offsets[i + 1]]), f"<u{block['width']}").astype("<u4")
            if len(ids) != block["n_tokens"][i]:
                raise ValueError(f"document {doc_id} has {len(ids)} ids, {block['n_tokens'][i]} were written")
            yield i, ids


def documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """``doc_id, ids`` of a few documents: only blocks that may hold one are read."""
    sha256, dictionary = _dictionary(spark, path)
    wanted = set(doc_ids)

    def find(batches):
        for batch in batches:
            for block in batch.to_pylist():
                rows = [(block["doc_ids"][i], ids.tolist()) for i, ids in _frames(block, sha256, dictionary, wanted)]
                found = {"doc_id": pa.array([r[0] for r in rows], pa.int64())}
                yield pa.record_batch(found | {"ids": pa.array([r[1] for r in rows], pa.list_(pa.int64()))})

    within = F.lit(False)
    for i in sorted(wanted):
        within = within | ((F.col("first_doc") <= i) & (F.col("last_doc") >= i))
    return spark.read.schema(_BLOCKS).parquet(f"{path}/blocks").where(within).mapInArrow(find, "doc_id long, ids array<long>")


def digest(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back from the files.

    ``start`` counts the ids of all documents before.  Sums per shard are one row each, of which there are as many as
    the writer had tasks; they are all that meets in one place.
    """
    sha256, dictionary = _dictionary(spark, path)
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")

    def measured(batches):
        for batch in batches:
            for block in batch.to_pylist():
                crc = [zlib.crc32(ids.tobytes()) for _, ids in _frames(block, sha256, dictionary)]
                count = np.array(block["n_tokens"], np.int64)
                yield pa.record_batch({
                    "shard": pa.array([block["shard"]] * len(crc), pa.int32()),
                    "doc_id": pa.array(block["doc_ids"], pa.int64()),
                    "within": pa.array(block["first_token"] + np.cumsum(count) - count),
                    "n_tokens": pa.array(count),
                    "ids_crc32": pa.array(crc, pa.int64()),
                })

    total = F.sum(F.expr("aggregate(n_tokens, 0L, (x, y) -> x + y)"))
    shards = blocks.groupBy("shard").agg(total.alias("total"))
    before = F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = shards.select("shard", F.coalesce(before, F.lit(0)).alias("before"))
    rows = blocks.mapInArrow(measured, "shard int, doc_id long, within long, n_tokens long, ids_crc32 long")
    joined = rows.join(F.broadcast(shards), "shard")
    return joined.select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
