"""The corpus pipeline: stages of tabprep.llm operators over ``documents``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabprep.llm import decontaminate, neardup, packing, pii, toxicity
from tabprep.llm.common import read, release, written
from tabprep.llm.queries import PACK_TOKENIZER


# Defined cases of every stage: null texts count as empty and stay (they are
# neither toxic nor contaminated, hold no personal data and pack as one end
# token); repeated rows are equal texts, of which near_duplicates keeps one;
# null ids are kept; empty tables give empty tables; all columns of the input
# are returned (but by the last stage), whatever their names.


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go; an empty text has
    the score of no evidence and stays."""
    return toxicity.non_toxic(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one of least
    id; a group whose ids are all null keeps any one row."""
    release(spark)
    return neardup.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go; with an empty benchmark
    none does."""
    release(spark)
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; null texts stay null."""
    release(spark)
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as pieces of windows of 4096 tokens; a null text is empty."""
    release(spark)
    return packing.pack(docs, public_tokenizers.path(PACK_TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal),
    ("packing", pack),
]

#: Tokens and trained scores are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each one's rows written as
    Parquet and read again as the next one's input."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
