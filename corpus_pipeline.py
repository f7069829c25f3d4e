"""Corpus pipeline: quality rules, near-duplicates, benchmark decontamination, mixing, sharding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; between
stages the rows are written as Parquet and read again. All stages but the last
return the columns of ``documents``, and further columns of their input, under
whatever names, as they are. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from citeloom.llm import decontam, mixing, neardup, quality, sharding
from citeloom.llm.common import read_table, stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; failed lines leave the others, and ``n_chars`` follows the text.

    Null and empty texts have fewer words than a document needs and go; repeated rows are judged
    alike; null ids, languages and sources pass through.
    """
    return quality.keep_clean(docs)


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the smallest id, null ids last, and of
    rows that share it the one with the smallest key. Repeated rows are one; documents without words
    (null texts too) are near to nothing and all stay."""
    return neardup.keep_one(docs)


def decontam_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go. Null and empty texts hold none and stay;
    repeated rows go or stay together; an empty benchmark leaves all."""
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents appear as often as the mix draws them, up to three times. Those without words are
    never drawn; null sources are one source; repeated rows are drawn each for itself."""
    return mixing.mixed(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds each record's size, virtual slot, shard and place in the shard; input columns of these names
    are replaced. A null text has one byte; repeated rows share a slot and have places of their own."""
    return sharding.shard(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_stage),
    ("near-duplicates", neardup_stage),
    ("benchmark decontamination", decontam_stage),
    ("mixing sources", mixing_stage),
    ("sharding", sharding_stage),
]

#: Sketches, connected components and hypergeometric draws have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for position, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if position < len(STAGES) - 1:
            docs = stored(docs, "stage-" + name.replace(" ", "-"))
    return docs
