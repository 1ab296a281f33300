"""The corpus pipeline: documents in, token files out.

Each stage calls one operator on all that its predecessor kept, and all but the
last return the columns of documents:

1. language_id: documents that have no letters, or whose language is unsure
   (score below one half), go.
2. jaccard_join: one document of each group of near duplicates stays, that of the
   smallest id (five-word shingles, similarity 0.8).
3. decontaminate: documents that contain a benchmark item go (five-word shingles,
   containment 0.8).
4. mix: documents are taken as often as the mix of sources asks for; one that is
   taken twice is two rows.
5. token_files: the mix is written as token files and read back.

Nulls, empty texts, repeated rows and empty tables are dealt with as the
operators state; columns beyond those of documents stay with their rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textloom.llm import decontamination, jaccard_join, langid, mixing, token_files
from textloom.llm.common import Scratch, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"), width=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.token_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("jaccard_join", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("token_files", tokens),
]

#: SQL can't express language identification or the tokenizer; tests/llm compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
        if last:
            scratch.drop(last)
        last = name
    return docs
