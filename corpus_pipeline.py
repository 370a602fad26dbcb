"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next
stage's ``docs``.  All but the last return the columns of ``docs``.  Columns may hold nulls, tables may be
empty, and rows may repeat; what each stage does with them is stated by the operator it calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierwright.llm.common import read_table, small_batches, store
from tierwright.llm.language import reject_unknown
from tierwright.llm.mixing import materialise_mix
from tierwright.llm.ngram_join import Rule, keep_one_of_each
from tierwright.llm.packing import default_tokenizer, pack_documents
from tierwright.llm.secret_scan import redact


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and long ones that no learned language explains, go."""
    small_batches(spark)
    return reject_unknown(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (5-word shingles, similarity 0.8) the smallest doc_id stays."""
    small_batches(spark)
    return keep_one_of_each(docs, Rule(words=5, percent=80))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Owner-specific credentials are replaced by a mark; widely copied examples stay."""
    small_batches(spark)
    return redact(docs)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source has the words of its target, documents repeated or left out."""
    small_batches(spark)
    return materialise_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of 1024."""
    small_batches(spark)
    return pack_documents(docs, default_tokenizer())


STAGES = [
    ("language", identify_language),
    ("near-duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mix", mix_to_weights),
    ("pack", pack_sequences),
]

# Language models and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
