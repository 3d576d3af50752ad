"""From raw documents to token files: five stages, each on all that its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read again as the
next one's documents; all but the last keep the columns of ``documents``, and any others, as they are.  Empty tables pass
through every stage.

The stage named decontamination drops near copies (``drop_near_copies``) before it looks for benchmark items: texts that share four
fifths of their five-word shingles are mostly beyond the 3 bits that the links of the SimHash stage may differ in.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebars.llm import decontamination, mixing, near_copies, simhash, token_files, toxicity
from pricebars.llm.text import read
from pricebars.sources.store import materialise, new_folder, remove, scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; the classifiers learn from this stage's documents.

    Null and empty texts score the classifiers' bias; repeated rows score alike; every text is read whole.
    """
    with scratch(spark):
        model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints one row, the first; see ``simhash.drop``."""
    return simhash.drop(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts that share four fifths of their five-word shingles the first; see ``near_copies.drop``."""
    return near_copies.drop(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, neither as it is nor with few edits; near copies go first.

    Null and empty texts hold none; repeated rows go or stay alike; every text is read whole.
    """
    return decontamination.clean(drop_near_copies(spark, docs, sf_dir), read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the rates of their sources ask for; a null source is one, rows that share an id are drawn alike."""
    return mixing.mix(docs, mixing.rates(docs.select("source", mixing.size().alias("size"))))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, in ascending order, and what reading them back gives for each.

    Null and empty texts are a document of the end alone; repeated rows follow each other; other columns play no part.
    """
    path = new_folder(spark, "tokens")
    token_files.write(docs, path, parts=2)
    return token_files.digest(spark, path).withColumn("path", F.lit(path))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

#: Classifiers, fingerprints, alignments and tokenizers are beyond SQL; the tests hold the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages.  A stage's documents and whatever else it wrote go when the next one's are there; the token files stay."""
    docs, last = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, name)
        with scratch(spark):
            docs = materialise(stage(spark, docs, sf_dir), path=path)
        if last:
            remove(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
