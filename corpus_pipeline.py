"""From documents to packed training sequences in five stages.

Each stage takes the documents that the one before it kept, written as Parquet and read again, so that a lost executor costs
no more than the stage that runs. All stages but the last return the columns of documents.

1. toxicity: learns the labels of documents that are there and drops documents of a score of 0.7 or more.
2. quality_rules: drops documents that fail the base rules or come from a host with a bad verdict.
3. near_duplicates: of documents that link by their word shingles, the one of the smallest id stays.
4. substring_dedup: words in windows of 50 that an earlier document has are taken out of the text.
5. packing: pieces of documents in sequences of at most 4096 tokens.

An empty table gives empty tables; nulls and repeated rows are as in the operators' modules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridmart.llm.jaccard import one_of_each
from gridmart.llm.packing import pack_documents
from gridmart.llm.queries import tokenizer_path
from gridmart.llm.rules import well_formed
from gridmart.llm.substrings import without_repeats
from gridmart.llm.tables import table
from gridmart.llm.toxicity import not_toxic
from gridmart.session import new_scratch, own_scratch, remove


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return not_toxic(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return well_formed(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

#: A trained network and a tokenizer are beyond SQL; tests/llm/test_corpus_pipeline.py holds the run against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other. What a stage has written for itself goes when its result is there, and then the one before."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_scratch(spark, f"stage-{name}")
        with own_scratch(spark):
            found = stage(spark, docs, sf_dir)
            found.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
