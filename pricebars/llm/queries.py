"""One thin query per operator, over whole tables, and the SQL of those that SQL can express."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebars.llm import (
    decontamination, embeddings, language_model, line_dedup, mixing, quality, resampling, simhash, suffixes, token_files,
    toxicity, urls, whitening,
)
from pricebars.llm.text import held_out, read
from pricebars.sources.store import new_folder

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@_query
def op6_mixing(spark, sf_dir):
    sized = read(spark, sf_dir, "documents").select("doc_id", "source", mixing.size().alias("size"))
    mixed = mixing.copies(sized, mixing.rates(sized))
    taken = F.col("size") * F.col("copies")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


_SQL["op6_mixing"] = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           [3.0, 1.0, 2.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)]::DOUBLE AS weight
    FROM sized GROUP BY source
), started AS (
    SELECT a.source, (1.5 * (SELECT sum(source_size) FROM sources)
             - coalesce((SELECT sum(2 * b.source_size) FROM sources b WHERE b.source_size / b.weight < a.source_size / a.weight), 0))
           / (SELECT sum(b.weight) FROM sources b WHERE b.source_size / b.weight >= a.source_size / a.weight) AS level
    FROM sources a
), targets AS (
    SELECT s.*, least(coalesce((SELECT max(l.level) FROM started l JOIN sources t ON l.source IS NOT DISTINCT FROM t.source
             WHERE l.level * t.weight <= 2 * t.source_size), 1e300) * weight, 2.0 * source_size)::DOUBLE AS target
    FROM sources s
), rated AS (
    SELECT d.doc_id, d.size, t.source_size, t.target,
           CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, 2.0) ELSE 0.0 END AS rate,
           ('0x' || substr(md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13))::BIGINT / 4503599627370496.0 AS drawn
    FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN drawn < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
"""


@_query
def op7_simhash(spark, sf_dir):
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id")


def _judged(spark, sf_dir, kind, least):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = kind.score(docs, kind.fit(docs, read(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", held_out(0).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted")
    )


@_query
def op1_toxicity(spark, sf_dir):
    return _judged(spark, sf_dir, toxicity, 0.5)


@_query
def op5_quality(spark, sf_dir):
    return _judged(spark, sf_dir, quality, 0.3)


@_query
def op4_token_files(spark, sf_dir):
    path = new_folder(spark, "tokens")
    token_files.write(read(spark, sf_dir, "documents"), path)
    return token_files.digest(spark, path)


@_query
def op8_urls(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, urls.fit()).select("page_id", "host", "path", "rule", "verdict", "score")


@_query
def op10_decontamination(spark, sf_dir):
    docs, benchmark = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return decontamination.matches(docs, benchmark)


@_query
def op2_language_model(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").withColumn("training", ~held_out(1))
    scored = language_model.score(docs)
    return scored.withColumn("held_out", held_out(1)).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@_query
def op3_embeddings(spark, sf_dir):
    return embeddings.near_duplicates(read(spark, sf_dir, "embeddings"))


@_query
def op9_suffixes(spark, sf_dir):
    found = suffixes.remove_repeats(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op11_resampling(spark, sf_dir):
    docs, benchmark = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return resampling.resample(docs, benchmark).select("row.doc_id", "n_features", "weight", "score", "rank")


@_query
def op12_line_dedup(spark, sf_dir):
    found = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


_SQL["op12_line_dedup"] = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
    FROM documents
), keyed AS (
    SELECT doc_id, pos, line,
           translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), repeated AS (
    SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
    SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.top AS gone FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@_query
def op13_whitening(spark, sf_dir):
    return whitening.whiten(read(spark, sf_dir, "embeddings")).select(
        "row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    )
