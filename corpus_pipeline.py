"""Corpus pipeline: raw documents to a shuffled, sharded training mix.

Stages run in order, each on everything its predecessor kept, written as
Parquet below the shared folder and read again by the next. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import fm_decontam, line_quality, mixing, sharding, simhash
from ledgerline.llm.common import cut, table
from ledgerline.llm.queries import MAX_BITS, SHARDS, SHINGLE_WORDS

#: The pipeline lays small sources out at most so often; the largest one once, so nothing is lost.
MAX_REPEATS = 2.0


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines are removed; documents that fail the base check or lose too much go."""
    return line_quality.apply_rules(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest doc_id."""
    return simhash.keep_one(docs, SHINGLE_WORDS, MAX_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark passages go."""
    return fm_decontam.decontaminate(spark, docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, repeated as its source's weight asks."""
    return mixing.mixed_documents(docs, max_repeats=MAX_REPEATS)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the shard and slot of every row."""
    return sharding.shard_rows(docs, SHARDS)


STAGES = [("quality rules", quality_rules), ("simhash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("source mixing", mixture), ("sharding", shards)]

#: SimHash components and the Feistel network have no DuckDB SQL; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
