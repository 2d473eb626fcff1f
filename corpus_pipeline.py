"""Stages that turn the documents table into packed training sequences.

Language identification and the quality rules drop documents, near-duplicates are reduced to one of each
group, and what is left is packed. All but the last stage return whole rows of documents,
further columns and clashing names included; each takes empty tables and texts of any length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracewaste.llm.crf import with_languages
from tracewaste.llm.packing import packed_documents
from tracewaste.llm.queries import WORD_MODEL
from tracewaste.llm.rules import POLICIES, PRODUCTION, kept_by, measured
from tracewaste.llm.simhash import one_of_each
from tracewaste.llm.tables import read_table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words are of the languages they are identified as, one or several; not foreign or letterless ones.

    See crf.with_languages; a null text goes, null ids and repeated rows stay as they are.
    """
    return with_languages(docs).filter("native").select("row.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule of the production policy; a null text has no words and goes."""
    return measured(docs).filter(kept_by(POLICIES[PRODUCTION])).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that op8 links, that with the least id; see simhash.one_of_each.

    Null texts count as empty, null ids come last, of rows with one id and text any one stays.
    """
    return one_of_each(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the training sequences; a null text is an end id."""
    return packed_documents(docs, WORD_MODEL)


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("packing", packing),
]

#: Languages, fingerprints and tokens are beyond SQL; tests compare the stages with plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
