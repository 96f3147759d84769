"""A training corpus from raw documents: five stages, each written as Parquet before the next reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from almoner.llm.contamination import decontaminate
from almoner.llm.jaccard import one_of_each
from almoner.llm.mixing import mix_sources
from almoner.llm.packing import pack_documents
from almoner.llm.queries import MIX, TOXIC_FROM, domain_of_source
from almoner.llm.tables import keep, table
from almoner.llm.toxicity import fit, score_documents


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the limit; the network is fitted on the labelled ones among them."""
    net = fit(docs, table(spark, sf_dir, "labels"))
    return score_documents(docs, net).where(f"_score < {TOXIC_FROM}").select(*docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one of least id."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights take them."""
    return mix_sources(docs, domain_of_source(), MIX).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids."""
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("packing", packing),
]

#: A trained network and a public tokenizer are not for SQL. tests/llm compares the join, decontamination, mixing and packing with plain
#: Python; of the toxicity stage it tests what it keeps by the scores, whose windows and slopes have tests of their own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
