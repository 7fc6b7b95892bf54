"""A training corpus from ``documents`` in five stages.

Each stage works on all rows its predecessor kept; its result is written to the
shared folder and read back as the next stage's documents.

Defined cases, in every stage: a null text counts as empty and stays null; such rows,
and empty ones, fail the first stage's base test.  Rows repeated in full count as
copies of each other, of which one stays.  A null id is an id of its own.  Texts of any
length are read whole.  Columns beyond those of ``documents``, whatever their names, pass
through all stages but the last, which returns digests alone.  Of an empty table nothing
is left; an empty benchmark removes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, jaccard_join, personal_data, quality_rules
from strata.llm.common import prepare, stage, table
from strata.llm.queries import bpe_digests


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules reject go."""
    prepare(spark)
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    prepare(spark)
    return jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    prepare(spark)
    return decontaminate.drop(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become marks; ``n_chars`` follows."""
    prepare(spark)
    return personal_data.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encoded, decoded, and both as digests."""
    prepare(spark)
    return bpe_digests(docs)


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", pii),
    ("bpe", tokens),
]

# The fitted verdicts and the groups of near copies are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
