"""Language-model scores by a weighted backoff automaton over word n-grams.

States are the contexts that were seen in training, and the empty one.  A context u has an arc for every word
w that followed it, with log10 of the smoothed probability (c(u, w) + M P(w)) / (c(u) + M), and a failure arc to the empty
context with log10 of M / (c(u) + M); the empty context has an arc for every word with log10 of
P(w) = (c(w) + 1/2) / (N + (V + 1) / 2).  So all words after a context add up to one, unknown words included, and one
pass from left to right that follows arcs, or failures and then arcs, adds up the text's probability.

The automaton of the whole corpus is in no one place.  Texts are encoded once, in batches of some megabytes that are
written with their own small vocabulary.  Each batch asks for the counts of its distinct n-grams, as arrays of hashes
dealt out by hash range; a range adds up what all batches send and answers each.  A batch then builds the slice of the
automaton that its texts can reach, which is exact, and walks it.  A frequent word or pair is one entry per batch, so
there are no hot keys.  Words are told apart by 64-bit hashes: among ten million words some pair is expected to
collide once in 370,000 corpora.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebars.llm.blocks import pack, sparing, stored, unpack
from pricebars.llm.text import pieces, texts

#: M, the weight of the shorter context's opinion, in observations.
BACKOFF = 3.0
#: Bytes of text in a batch, and words or tokens for which there is one hash range.
BATCH_BYTES = 8 << 20
RANGE = 2_000_000
#: The hash that stands for the end of a text, which is also the context of its first word.
_END = np.uint64(1)
_ENCODED = "batch long, doc_ids array<long>, training array<boolean>, lengths array<int>, tokens binary, vocabulary binary"


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of texts as places in a vocabulary of their own; place 0 is the end of a text."""
    first = TaskContext.get().partitionId() << 32
    for number, batch in enumerate(pieces(batches, BATCH_BYTES)):
        lower = pa.array([t.lower() for t in texts(batch.column("text"))], pa.large_binary())  # A-Z only
        split = pc.ascii_split_whitespace(lower.cast(pa.large_string()))
        words, offsets = split.flatten(), split.offsets.to_numpy()
        real = pc.greater(pc.binary_length(words), 0)
        before = np.r_[0, real.to_numpy(zero_copy_only=False).cumsum()]
        coded = words.filter(real).dictionary_encode()
        count = before[offsets[1:]] - before[offsets[:-1]]
        ends = np.cumsum(count + 1) - 1
        tokens = np.zeros(len(coded) + len(count), np.int32)
        inner = np.ones(len(tokens), bool)
        inner[ends] = False
        tokens[inner] = coded.indices.to_numpy(zero_copy_only=False) + 1
        spelled = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, spelled), np.uint64, len(spelled))
        row = {
            "batch": first + number, "doc_ids": batch.column("doc_id").to_pylist(),
            "training": batch.column("training").to_pylist(), "lengths": (count + 1).tolist(),
            "tokens": tokens.tobytes(), "vocabulary": np.r_[_END, hashes].tobytes(),
        }
        yield pa.RecordBatch.from_pylist([row], schema=_schema())


def _schema() -> pa.Schema:
    return pa.schema([
        ("batch", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("training", pa.list_(pa.bool_())),
        ("lengths", pa.list_(pa.int32())), ("tokens", pa.binary()), ("vocabulary", pa.binary()),
    ])


def _pairs(tokens: np.ndarray, size: int) -> np.ndarray:
    """Context and word of each token as one number; texts end with 0, which is thus the context of the next one."""
    return np.r_[0, tokens[:-1]].astype(np.int64) * size + tokens


def _hashed(pairs: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    size = len(vocabulary)
    h = vocabulary[pairs // size] * np.uint64(0x9E3779B97F4A7C15) ^ vocabulary[pairs % size] * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


@dataclass(frozen=True)
class _Batch:
    """An encoded batch with its distinct pairs, in ascending order, and the order of all hashes by range."""

    tokens: np.ndarray
    lengths: np.ndarray
    vocabulary: np.ndarray
    pairs: np.ndarray
    place: np.ndarray
    hashes: tuple[np.ndarray, np.ndarray]

    @classmethod
    def of(cls, row: dict) -> "_Batch":
        tokens, vocabulary = np.frombuffer(row["tokens"], np.int32), np.frombuffer(row["vocabulary"], np.uint64)
        pairs, place = np.unique(_pairs(tokens, len(vocabulary)), return_inverse=True)
        lengths = np.array(row["lengths"], np.int64)
        return cls(tokens, lengths, vocabulary, pairs, place, (vocabulary, _hashed(pairs, vocabulary)))


def _ask(ranges: tuple[int, int]):
    """Rows ``part, kind, batch, payload``: training counts of words (kind 0) and pairs (1) by hash range."""

    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                b = _Batch.of(row)
                training = np.repeat(np.array(row["training"], bool), b.lengths)
                counts = (
                    np.bincount(b.tokens[training], minlength=len(b.vocabulary)),
                    np.bincount(b.place[training], minlength=len(b.pairs)),
                )
                for kind in (0, 1):
                    order, cuts = _by_range(b.hashes[kind], ranges[kind])
                    h, c = b.hashes[kind][order], counts[kind][order].astype(np.uint32)
                    filled = np.flatnonzero(np.diff(cuts))
                    for begin in range(0, len(filled), 256):
                        some = filled[begin : begin + 256]
                        blocks = [pack(h[s:e], c[s:e]) for s, e in zip(cuts[some], cuts[some + 1])]
                        yield pa.record_batch({
                            "part": pa.array(some + kind * ranges[0], pa.int64()),
                            "kind": pa.array([kind] * len(some), pa.int32()),
                            "batch": pa.array([row["batch"]] * len(some), pa.int64()),
                            "payload": pa.array(blocks, pa.binary()),
                        })

    return ask


def _by_range(hashes: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(hashes)
    limits = np.array([(i << 64) // ranges for i in range(1, ranges)], np.uint64)
    return order, np.r_[0, np.searchsorted(hashes[order], limits), len(hashes)]


def _answer(asked: pa.Table) -> pa.Table:
    """Totals of a range, to each batch in the order it asked, and what the range holds as a row without batch."""
    parts, counts = zip(*[unpack(x, "u8", "u4") for x in asked.column("payload").to_pylist()])
    distinct, place = np.unique(np.concatenate(parts), return_inverse=True)
    total = np.bincount(place, np.concatenate(counts), len(distinct)).astype(np.int64)
    replies = np.split(total[place], np.cumsum([len(p) for p in parts])[:-1])
    part, kind = asked.column("part")[0].as_py(), asked.column("kind")[0].as_py()
    n = len(parts)
    return pa.table({
        "part": pa.array([part] * (n + 1), pa.int64()),
        "kind": pa.array([kind] * (n + 1), pa.int32()),
        "batch": pa.array([*asked.column("batch").to_pylist(), None], pa.int64()),
        "payload": pa.array([*[pack(r) for r in replies], None], pa.binary()),
        "held": pa.array([None] * n + [int((total > 0).sum())], pa.int64()),
        "tokens": pa.array([None] * n + [int(total.sum())], pa.int64()),
    })


@dataclass(frozen=True)
class Automaton:
    """State s has arcs ``keys`` s * size + word with ``weights`` and ``targets``, or fails to ``fall`` at ``price``.

    State ``root`` has an arc for every word: ``words`` are their weights, ``after`` the states they lead to.
    """

    size: int
    root: int
    keys: np.ndarray
    weights: np.ndarray
    targets: np.ndarray
    fall: np.ndarray
    price: np.ndarray
    words: np.ndarray
    after: np.ndarray

    def walk(self, tokens: np.ndarray, lengths: np.ndarray, start: int) -> np.ndarray:
        """log10 probability of each text, all texts advancing together from left to right."""
        longest = np.argsort(-lengths, kind="stable")
        at = (np.cumsum(lengths) - lengths)[longest]
        left = lengths[longest]
        state, score = np.full(len(lengths), start), np.zeros(len(lengths))
        step = 0
        while len(left) and left[0] > step:
            n = int(np.searchsorted(-left, -step))  # texts that have a word left
            word = tokens[at[:n] + step].astype(np.int64)
            active = np.arange(n)
            while len(active):
                s, w = state[active], word[active]
                key = s * self.size + w
                i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                arc = (self.keys[i] == key) if len(self.keys) else np.zeros(len(key), bool)
                home = ~arc & (s == self.root)
                score[active[arc]] += self.weights[i[arc]]
                state[active[arc]] = self.targets[i[arc]]
                score[active[home]] += self.words[w[home]]
                state[active[home]] = self.after[w[home]]
                active, s = active[~arc & ~home], s[~arc & ~home]
                score[active] += self.price[s]
                state[active] = self.fall[s]
            step += 1
        out = np.empty(len(lengths))
        out[longest] = score
        return out


def automaton(pairs: np.ndarray, seen: np.ndarray, counts: np.ndarray, total: int, known: int, backoff: float) -> Automaton:
    """The automaton of words with ``counts`` and of ``pairs`` with counts ``seen``; a word's state is its place."""
    size = len(counts)
    p = (counts + 0.5) / (total + 0.5 * (known + 1))
    keys, c = pairs[seen > 0], seen[seen > 0]
    context, word = keys // size, keys % size
    weights = np.log10((c + backoff * p[word]) / (counts[context] + backoff))
    price = np.log10(backoff / (counts + backoff))
    every = np.arange(size)
    return Automaton(size, size, keys, weights, word, np.full(size + 1, size), np.r_[price, 0], np.log10(p), every)


def _scored(total: int, known: int, backoff: float):
    def scored(encoded: pa.Table, answers: pa.Table) -> pa.Table:
        (row,) = encoded.to_pylist()
        b = _Batch.of(row)
        answers = answers.sort_by("part")
        counts = []
        for kind, hashes in enumerate(b.hashes):
            got = answers.filter(pc.equal(answers.column("kind"), kind)).column("payload").to_pylist()
            reply = np.concatenate([unpack(x, "i8")[0] for x in got])
            own = np.empty(len(hashes), np.int64)
            own[np.argsort(hashes)] = reply
            counts.append(own)
        words, seen = counts
        machine = automaton(b.pairs, seen, words, total, known, backoff)
        starts = np.cumsum(b.lengths) - b.lengths
        return pa.table({
            "doc_id": pa.array(row["doc_ids"], pa.int64()),
            "n_tokens": pa.array(b.lengths, pa.int64()),
            "n_known": pa.array(np.add.reduceat((words > 0)[b.tokens].astype(np.int64), starts), pa.int64()),
            "train_tokens": pa.array([total] * len(starts), pa.int64()),
            "base_score": pa.array(np.add.reduceat(machine.words[b.tokens], starts), pa.float64()),
            "score": pa.array(machine.walk(b.tokens, b.lengths, 0), pa.float64()),
        })

    return scored


def score(docs: DataFrame, backoff: float = BACKOFF) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``doc_id, text, training``.

    Rows with ``training`` teach the model, others (also where it is null) are only scored; each row counts by itself, so
    repeated texts teach as often as they come.  A null text is empty and has one token, its end.  Without training rows all words
    are unknown and get the same probability.  Other columns are ignored; no rows give none.
    """
    training = F.coalesce(F.col("training"), F.lit(False)).alias("training")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", training)
    with sparing(docs.sparkSession):
        encoded = stored(rows.mapInArrow(_encode, _ENCODED), "encoded")
        words, tokens = encoded.agg(F.sum(F.length("vocabulary") / 8), F.sum(F.length("tokens") / 4)).first()
        ranges = tuple(max(1, -(-int(n or 0) // RANGE)) for n in (words, tokens))  # there are no more pairs than tokens
        asked = encoded.mapInArrow(_ask(ranges), "part long, kind int, batch long, payload binary")
        answers = asked.groupBy("part").applyInArrow(
            _answer, "part long, kind int, batch long, payload binary, held long, tokens long"
        )
        answers = stored(answers, "answers")
    held = answers.where("kind = 0 and batch is null").agg(F.sum("held"), F.sum("tokens")).first()
    known, total = (int(x or 0) for x in held)
    replies = answers.where("batch is not null").select("batch", "part", "kind", "payload")
    return encoded.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(
        _scored(total, known, backoff),
        "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
