"""A training corpus from raw documents: filter, identify, deduplicate, mix, tokenise.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written and read
again before the next one. All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import bpe, language_id, mixing, quality_rules, queries, simhash
from gleanery.llm.common import held_out, table
from gleanery.session import written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the learnt decision list."""
    return quality_rules.keep_good(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def keep_recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows."""
    return language_id.keep_recognised(docs, language_id.fit(docs.filter(~held_out(F.col("doc_id")))))


def keep_different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id."""
    return simhash.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of what they decode to, a row for each row."""
    return queries.bpe_digests(bpe.round_trip(docs))


STAGES = [
    ("quality rules", keep_good),
    ("language ID", keep_recognised),
    ("SimHash near-dedup", keep_different),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", tokenise),
]

#: The learnt stages cannot be expressed in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{i}")
    return docs
