"""The corpus pipeline: quality rules, near-duplicates, benchmark leaks, source mix, token files.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; what it returns is written as
Parquet and read again as the next stage's ``docs``. All stages but the last return the columns of
``documents``; the mix returns a document as often as it takes it.

The stages share their executors, and Python workers outlive a stage with all they remember, beside the heap of the
executor. So texts reach them in small batches, and the encoder remembers fewer words than alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadloom.llm import decontam, mixing, quality, simhash, tokenstore
from leadloom.llm.queries import tokenizer_path
from leadloom.llm.tables import read
from leadloom.session import materialise, small_batches

#: Documents that a Python worker gets at once.
BATCH_ROWS = 500
#: Words that the encoder of a worker remembers.
ENCODER_WORDS = 250_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    small_batches(spark, BATCH_ROWS)
    return quality.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints."""
    small_batches(spark, BATCH_ROWS)
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.without_items(docs, read(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to the target weights takes them."""
    return mixing.mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The layout of the token-id files of all documents."""
    small_batches(spark, BATCH_ROWS)
    return tokenstore.stored_layout(docs, tokenizer_path(), words=ENCODER_WORDS)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_files", token_files),
]

#: SQL has no XXH64 fingerprints, n-gram coverage or byte-level encoding; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
