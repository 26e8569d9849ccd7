"""The registered queries of this subpackage: one for each operator, over whole tables."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import (
    bpe, html_diff, language_id, mixing, periodic_runs, quality_cnn, quality_rules, sharding, simhash, spelling, token_files,
    topk_tiles, warc,
)
from gleanery.llm.common import held_out, table

SHARDS = tuple(f"shard-{i:02d}" for i in range(32))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language_id.fit(documents.filter(~held_out(F.col("doc_id"))))
    found = language_id.predict(documents, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_diff.extract(table(spark, sf_dir, "pages"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    rules = quality_rules.fit(documents, table(spark, sf_dir, "labels"))
    return quality_rules.judge(documents, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    net = quality_cnn.fit(documents, table(spark, sf_dir, "labels"))
    found = quality_cnn.score(documents, net)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(bpe.round_trip(table(spark, sf_dir, "documents")))


def bpe_digests(both: DataFrame) -> DataFrame:
    """Digests of the ids and of what they decode to."""
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk_tiles.search(vectors, vectors.filter("vec_id % 100 = 0"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placed(table(spark, sf_dir, "documents"), "doc_id", SHARDS)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), rewrite=spelling.dropped_letters)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents")).withColumnRenamed("digest", "ids_crc32")


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a document with a planted repetition, in every tenth document or so."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), rewrite=planted)
    order = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    best = F.array_max(order)
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_html_extraction, op3_simhash, op4_quality_rules, op5_quality_classifier,
    op6_mixing, op7_warc, op8_bpe, op9_topk, op10_sharding,
    op11_spelling, op12_token_files, op13_periodic_runs,
)}
