"""The corpus pipeline: five stages over ``documents``, each written as Parquet and reread by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the
last return the columns of documents; the last returns what its operator reads back from its files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import line_crf, mixing, rans_output, simhash_dedup, winnow
from riskframe.llm.common import store, table
from riskframe.llm.queries import GOOD, usable, word_tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier finds good; it learns from labelled rows that are not held out."""
    model = line_crf.train(docs, table(spark, sf_dir, "labels"), usable())
    return line_crf.keep_good(docs, model, GOOD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (4-word shingles, at most 4 bits): the one with the smallest id."""
    return simhash_dedup.keep_first(docs, width=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no 10-word window of the benchmark occurs."""
    return winnow.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them, some twice, some not at all."""
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files of the mix, read back: doc_id, start, n_tokens, ids_crc32."""
    return rans_output.token_files(docs, word_tokenizer())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixture", mixture), ("token_output", token_output)]
#: The first stage fits a model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
