"""From raw documents to token numbers, in stages of the text operators; each stage reads what the one before wrote.

Quality rules remove documents; the shingle join leaves one document of each
class of near copies; personal data is redacted in the texts; mixing passes the
documents of small sources more often, every document at least once; the last
stage encodes every text it is given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voltatlas.llm import bpe, host_rules, mixing, pii, shingle_join
from voltatlas.llm.common import stored, table
from voltatlas.llm.queries import vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and their host's verdict keep."""
    return host_rules.kept_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the one with the least doc_id."""
    return shingle_join.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal data replaced by its kind in brackets."""
    return pii.redact(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources up to twice, by the mix's weights."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its tokens' digest and that of the text they decode to."""
    return bpe.round_trip(docs, vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("mixing_sources", mixing_sources),
    ("tokens", tokens),
]

#: BPE and the trees cannot be said in SQL; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
