"""Importance resampling towards a target distribution: hashed n-grams, gains, Gumbel noise, the highest scores.

Arrow kernels do the work of a batch: ``ascii_lower``, ``split_pattern_regex``, ``list_flatten`` and
``dictionary_encode`` turn texts into word numbers; shifted numbers form n-grams; only the distinct ones of a batch are
run through CRC-32; ``take`` deals their buckets, or the gains of these, back to all places, and a segmented sum adds
them up per document.  A task sends at most ``BUCKETS`` counts, so a hot source or word is no key of a shuffle.

The highest scores are found without sorting all rows: whole scores are counted (a few ten thousand different values,
whatever the number of rows), the score at which the draw ends follows from the counts, and only rows at or above
it are put in order, by ranges that repeated rows share through the places of their rows.

Odd inputs: a null text has no words and an empty one neither; both weigh 0.  A null id is drawn as the empty id and loses
every tie.  Rows with equal ids are documents of their own; equal rows take their ranks in the order they are stored in.
Texts are read whole, however long.  An empty table gives no rows, an empty target gains of an empty count.
Columns of the caller travel inside the struct ``row``, so that no name of theirs can clash.
"""

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricebars.llm.text import pieces
from pricebars.operators.layers import dense_ids
from pricebars.sources.store import materialise

BUCKETS = 10_000
#: Features are runs of 1 to so many words.
LONGEST = 2
#: What parts words once A-Z are in lower case: all of ASCII but letters and digits.
PARTING = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Only documents of so many words are drawn, and of these so many in a hundred.
WORDS, PERCENT = 20, 25
SEED = "7"
#: Bytes of text that are taken apart in one go.
BATCH_BYTES = 4 << 20


def features(column: pa.Array, longest: int = LONGEST) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of 1, 2, ... ``longest`` words of the texts: CRC-32 of the distinct runs, their numbers, and their rows."""
    whole = column.take(pa.array(np.arange(len(column))))  # ascii_lower misreads slices that begin further on
    lowered = pc.ascii_lower(pc.fill_null(whole.cast(pa.large_string()), ""))
    lists = pc.split_pattern_regex(lowered, PARTING)
    found, rows = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.not_equal(pc.binary_length(found), 0)
    encoded = found.filter(full).dictionary_encode()
    word, row = encoded.indices.to_numpy().astype(np.int64), rows.filter(full).to_numpy().astype(np.int64)
    vocabulary = encoded.dictionary.cast(pa.large_binary()).to_pylist()
    crc = np.fromiter(map(zlib.crc32, vocabulary), np.uint32, len(vocabulary))
    yield crc, word, row
    at, size = word, max(1, len(vocabulary))  # number of the run that starts at each place
    for n in range(2, longest + 1):
        place = np.flatnonzero(row[n - 1 :] == row[: max(0, len(row) - n + 1)])
        distinct, run = np.unique(at[place] * size + word[place + n - 1], return_inverse=True)
        before, last = (part.tolist() for part in np.divmod(distinct, size))
        spaced = [zlib.crc32(b" ", c) for c in crc.tolist()]
        crc = np.fromiter((zlib.crc32(vocabulary[w], spaced[b]) for b, w in zip(before, last)), np.uint32, len(distinct))
        at = np.full(len(row), -1)
        at[place] = run
        yield crc, run, row[place]


def _parts(column: pa.Array) -> Iterator[pa.Array]:
    for part in pieces(iter([pa.record_batch({"text": column})]), BATCH_BYTES):
        yield part.column("text")


def counts(docs: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall in each bucket; a task adds up its own before the shuffle."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in _parts(batch.column(0)):
                for crc, run, _ in features(part, longest):
                    total += np.bincount((crc % buckets).take(run), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.record_batch({"bucket": pa.array(used, pa.int32()), "n": pa.array(total[used])})

    found = docs.select(F.col(text).alias("text")).mapInArrow(counted, "bucket int, n long")
    table = found.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # at most one row for each bucket
    total = np.zeros(buckets, np.int64)
    total[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of a bucket's share in the target over that in the source, one added to each count."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (float(source.sum()) + len(s)) / ((s + 1) * (float(target.sum()) + len(t)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """Gumbel noise in thousandths from the id alone, the same in every run."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h.cast("double") + 0.5) / F.lit(4294967296.0)))).cast("long")


def scores(
    docs: DataFrame, gain: np.ndarray, carried: Sequence[str] = ("doc_id",),
    doc_id: str = "doc_id", text: str = "text", longest: int = LONGEST, seed: str = SEED,
) -> DataFrame:
    """``row`` (a struct of the ``carried`` columns), ``doc_id, n_words, n_features, weight, score`` of every document."""

    @F.arrow_udf("struct<n_words: long, n_features: long, weight: long>")
    def weighed(column: pa.Array) -> pa.Array:
        out = []
        for part in _parts(column):
            words, number, gained = (np.zeros(len(part), np.int64) for _ in range(3))
            for n, (crc, run, row) in enumerate(features(part, longest), start=1):
                of_row = np.bincount(row, minlength=len(part))
                words += of_row if n == 1 else 0
                number += of_row
                begins = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.empty(0, np.int64)
                if len(row):  # rows come in order, so every document is one segment
                    gained[row[begins]] += np.add.reduceat(gain.take((crc % len(gain)).take(run)), begins)
            weight = np.where(number > 0, gained // np.maximum(number, 1), 0)
            out.append((words, number, weight))
        columns = [np.concatenate(c) if out else np.empty(0, np.int64) for c in (zip(*out) if out else [()] * 3)]
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], ["n_words", "n_features", "weight"])

    found = docs.select(
        F.struct(*carried).alias("row"), F.col(doc_id).alias("doc_id"), weighed(F.col(text)).alias("found")
    )
    return found.select(
        "row", "doc_id", "found.*", (F.col("found.weight") + noise(F.col("doc_id"), seed)).alias("score")
    )


def drawn(scored: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 ... for the highest scores of the documents of ``words`` words, null for all others.

    floor(percent * N / 100) of the N such documents are drawn, ties go to the smaller id.
    """
    kept = materialise(scored.withColumn("place", F.monotonically_increasing_id()), "scored")
    able = kept.where(F.col("n_words") >= words)
    # scores are whole numbers between the least gain and the greatest noise: tens of thousands, however many rows
    tally = able.groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    number = F.floor(F.lit(percent) * F.sum("n").over(Window.partitionBy()) / 100)
    tally = tally.select("score", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("above"), number.alias("number"))
    last = tally.where("above < number").agg(F.min("score").alias("score"), F.max("number").alias("number")).first()
    none = F.lit(None).cast("long").alias("rank")
    columns = [c for c in scored.columns if c != "rank"]
    if last.score is None:
        return kept.select(*columns, none)
    high = F.coalesce((F.col("n_words") >= words) & (F.col("score") >= last.score), F.lit(False))
    order = F.struct(
        (-F.col("score")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("c"),
        F.col("n_features").alias("d"), F.col("weight").alias("e"), F.col("place").alias("f"),
    )
    ranked = dense_ids(kept.where(high).select(F.struct(*columns).alias("kept"), order.alias("order")), "order")
    ranked = ranked.select("kept.*", F.when(F.col("id") <= last.number, F.col("id")).alias("rank"))
    return kept.where(~high).select(*columns, none).unionByName(ranked)


def resample(docs: DataFrame, target: DataFrame, carried: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Every document with its weight, score and rank in the draw towards the texts of ``target``."""
    gain = gains(counts(docs), counts(target))
    return drawn(scores(docs, gain, carried))
