"""From raw documents to token files in five stages, each read from what the one before wrote.

    documents -> quality -> near_duplicates -> decontamination -> mixing -> token_files

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``. A stage with Python workers makes the session's
batches to them short, so that memory does not grow with the width of rows. Null or empty texts, repeated rows and empty
tables are handled as the operators say; a stage that is given no rows returns none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pairwright.llm import decontamination, mixing, quality, simhash, token_files
from pairwright.llm.common import short_batches
from pairwright.llm.queries import table, tokenizer_path
from pairwright.plans.storage import materialize

MIN_QUALITY = 0.3


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier gives a score of MIN_QUALITY or more."""
    short_batches(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"), "quality", fold=5)
    return quality.keep_good(docs, model, MIN_QUALITY)


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id."""
    short_batches(spark)
    return simhash.drop_near_duplicates(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an item of the benchmark."""
    short_batches(spark)
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: 150 % of all words, weights 5, 2, 1, two epochs at most."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digest of the bit-packed token files: doc_id, start, n_tokens, ids_crc32."""
    short_batches(spark)
    return token_files.pack_documents(docs, tokenizer_path(), end_id=2)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_copies),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

# The classifier and the tokenizer have no SQL; the tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace('_', '-')}")
    return docs
