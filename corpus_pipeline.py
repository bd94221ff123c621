"""From raw documents to token ids: quality, near duplicates, benchmark passages, personal data, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; its result is written as Parquet
and read again. All but the last return the columns of documents. What a stage does with nulls, empty texts, ties,
repeated rows and empty tables is told by its operator: a null or empty text goes in the first stage, of repeated rows
one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countertide.llm import decontaminate, host_quality, jaccard_join, private_terms, sentencepiece_bpe
from countertide.llm.common import table
from countertide.plans.shared import freeze

#: Rows of an Arrow batch. Texts are long, and an executor holds the batches of all its tasks beside its heap.
ARROW_ROWS = 2000
ARROW_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def short_batches(spark: SparkSession) -> None:
    """Texts go to Python in short batches from now on: a stage is written by its caller, so the session keeps the setting."""
    rows = int(spark.conf.get(ARROW_ROWS_KEY))
    if rows <= 0 or rows > ARROW_ROWS:
        spark.conf.set(ARROW_ROWS_KEY, str(ARROW_ROWS))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, judged with the record of their host."""
    return host_quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 over five-word shingles, the one with the smallest id."""
    short_batches(spark)
    return jaccard_join.keep_one(docs, jaccard_join.Similarity(words=5, percent=80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    short_batches(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and the terms that disclose it replaced; ``n_chars`` counted anew."""
    short_batches(spark)
    clean = private_terms.sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as ids, with the text that these decode to."""
    short_batches(spark)
    coded = sentencepiece_bpe.encode(docs, sentencepiece_bpe.default_model())
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("token_ids", token_ids),
]

#: SQL can express neither shingle components nor BPE; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = freeze(docs, name)
    return docs
