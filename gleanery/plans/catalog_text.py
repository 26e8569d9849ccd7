"""Checked queries: scans, cleaning, chunking, keys, sync and requests."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions import keys, payloads, sql
from gleanery.functions import text as X
from gleanery.operators import chunking, evaluate, markup, monitor, sync
from gleanery.plans import ingest
from gleanery.session import shared_dir, spread, written
from gleanery.sources import catalog, files, tables

REFUSAL = "of the"  # stands in for the refusal sentence in texts that hold none
EXTRA_PATTERNS = (r"all rights reserved", r"api[_ -]?key", r"password")


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def long(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def document_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as ``url, title, content``."""
    docs = spread(load(spark, sf, "documents")).where(~X.is_blank("text"))
    url = F.concat(F.lit("doc/"), F.col("doc_id").cast("string"))
    return docs.select(
        url.alias("url"), X.title_of("text", url).alias("title"), F.col("text").alias("content")
    )


def bronze_documents(spark, sf):
    return document_pages(spark, sf).select(
        "url", "title", long(F.length("content")).alias("n_chars"), F.md5("content").alias("content_md5")
    )


def row_counts(spark, sf):
    names = ("documents", "pages", "conversations", "events", "labels", "embeddings", "benchmark")
    counted = None
    for name in names:
        part = load(spark, sf, name).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows"
        )
        counted = part if counted is None else counted.unionByName(part)
    return counted


def preview_rows(spark, sf):
    return tables.preview(
        load(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars"), 10, "n_chars", "doc_id"
    )


def partitioned_table(spark, sf):
    """Written by language, read back for one of them: only its folder is scanned."""
    path = shared_dir(spark, "documents")
    tables.write_table(load(spark, sf, "documents"), path, ["lang"])
    return spark.read.parquet(path).where(F.col("lang") == "en").select("doc_id", "source", "n_chars")


def catalogue_table(spark, sf):
    """Chunks in a table by name with the stated schema, then more rows with a column of their own."""
    name, spoken = f"chunks_{uuid.uuid4().hex[:12]}", load(spark, sf, "conversations")
    chunks = fixed_document_chunks(spark, sf).withColumn("chunk_index", F.col("chunk_index").cast("int"))
    catalog.create_table(chunks, name, tables.SILVER, shared_dir(spark, "named"))
    url = F.concat(F.lit("conversation/"), "conv_id")
    turns = spoken.select(
        keys.chunk_id(url, "turn").alias("chunk_id"), url.alias("url"), F.col("role").alias("title"),
        F.col("turn").cast("int").alias("chunk_index"), F.coalesce("text", F.lit("")).alias("chunk_text"), F.col("role").alias("speaker"),
    )
    catalog.append_table(turns, name, tables.SILVER)
    rows = spark.table(name)
    return rows.groupBy("speaker").agg(
        F.count("*").alias("n_rows"), F.countDistinct("chunk_id").alias("n_keys"), F.sum(F.length("chunk_text")).cast("bigint").alias("n_chars"),
    ).select(F.coalesce("speaker", F.lit("-")).alias("speaker"), "n_rows", "n_keys", "n_chars")


def page_names(spark, sf):
    pages = load(spark, sf, "pages").select("page_id", "url")
    name = F.concat(X.page_slug("url"), F.lit(".html"))
    return pages.select(
        "page_id",
        X.canonical_url("url").alias("canonical"),
        X.canonical_url("url", ["en", "fr", "de", "es"]).alias("canonical_no_locale"),
        name.alias("file_name"),
        long(X.has_page_extension("url")).alias("url_names_a_page_file"),
        long(X.has_page_extension(name)).alias("is_page_file"),
        X.url_from_file_name(name, "https://").alias("rebuilt_url"),
    )


def _pages(spark, sf):
    return spread(load(spark, sf, "pages"))


def page_markdown(spark, sf):
    cleaned = markup.html_to_markdown(_pages(spark, sf).select("page_id", "url", "html"))
    return cleaned.where(~X.is_blank("content")).select(
        "page_id",
        X.title_of("content", "url").alias("title"),
        long(F.length("content")).alias("n_chars"),
        F.md5("content").alias("content_md5"),
    )


def utf8_repaired(spark, sf):
    """Texts as bytes, some with bytes inside that are no UTF-8; these are dropped, all others stay."""
    raw = F.col("text").cast("binary")
    broken = F.concat(F.unhex(F.lit("FF")), raw, F.unhex(F.lit("C3")))
    content = F.when(F.pmod("doc_id", F.lit(3)) == 0, broken).otherwise(raw)
    docs = load(spark, sf, "documents").select("doc_id", content.alias("content"))
    return docs.select("doc_id", F.md5(files.decode_utf8("content")).alias("text_md5"))


def page_load_times(spark, sf):
    """Pages with text, when they were loaded, as rows of the bronze table's schema."""
    bronze = catalog.conforming(ingest.bronze_from_pages(_pages(spark, sf)), tables.BRONZE)
    now = F.unix_timestamp(F.current_timestamp())
    age = now - F.unix_timestamp("ingested_at")
    return bronze.select("url", F.md5("title").alias("title_md5"), (F.col("ingested_at").isNotNull() & (age >= 0) & (age < 3600)).alias("loaded_now"))


def page_plain_text(spark, sf):
    return _pages(spark, sf).select("page_id", markup.page_text_by_pattern("html").alias("t")).select(
        "page_id", long(F.length("t")).alias("n_chars"), F.md5("t").alias("text_md5")
    )


def _shown(chunks: DataFrame) -> DataFrame:
    return chunks.select(
        "chunk_id", "url", long("chunk_index").alias("chunk_index"),
        long(F.length("chunk_text")).alias("n_chars"), F.md5("chunk_text").alias("text_md5"),
    )


def page_chunks(spark, sf):
    return _shown(ingest.silver_from_bronze(ingest.bronze_from_pages(_pages(spark, sf))))


def chunk_recursive(spark, sf):
    return _shown(chunking.finish_chunks(chunking.recursive_chunks(document_pages(spark, sf))))


def chunk_sql_function(spark, sf):
    """The same pieces by a query that is SQL alone."""
    sql.register(spark)
    document_pages(spark, sf).createOrReplaceTempView("document_pages")
    return spark.sql("""
        SELECT chunk_id, url, chunk_index, CAST(length(chunk_text) AS BIGINT) AS n_chars, md5(chunk_text) AS text_md5
        FROM (SELECT substr(sha2(concat(url, '::', c.chunk_index), 256), 1, 16) AS chunk_id, url, CAST(c.chunk_index AS BIGINT) AS chunk_index, c.chunk_text
              FROM document_pages, LATERAL split_text(content, 800, 150) c)
        WHERE length(chunk_text) >= 50""")


def fixed_document_chunks(spark, sf):
    return chunking.finish_chunks(chunking.fixed_chunks(document_pages(spark, sf)))


def chunk_fixed_window(spark, sf):
    return _shown(fixed_document_chunks(spark, sf))


def chunk_token_window(spark, sf):
    pieces = chunking.token_chunks(document_pages(spark, sf), size=100, overlap=20)
    return pieces.select(
        "url", long("chunk_index").alias("chunk_index"), F.md5("chunk_text").alias("text_md5")
    )


def chunk_measured(spark, sf):
    """At most 64 tokens a chunk, cut at paragraphs, lines, sentences or words, 8 tokens repeated."""
    pieces = chunking.measured_chunks(document_pages(spark, sf), keep=["url"], size=64, overlap=8)
    return pieces.select("url", long("chunk_index").alias("chunk_index"), long("n_tokens").alias("n_tokens"), F.md5("chunk_text").alias("text_md5"))


def _sectioned(spark: SparkSession, sf: str) -> DataFrame:
    """Each line of a document becomes a section, below a preface that holds a fence."""
    return spread(load(spark, sf, "documents")).select(
        "doc_id",
        F.concat(
            F.lit("# "), "source", F.lit("\n```\n## "), "lang", F.lit("\n```\n> "),
            F.replace("text", F.lit("\n"), F.lit("\n## ")),
        ).alias("content"),
    )


def chunk_sections_sized(spark, sf):
    """Sections above the size are split further; one running index for each document."""
    pieces = chunking.section_then_recursive_chunks(_sectioned(spark, sf), keep=["doc_id"])
    return pieces.select(
        "doc_id", long("section").alias("section"), long("chunk_index").alias("chunk_index"), F.md5("chunk_text").alias("text_md5")
    )


def chunk_sections(spark, sf):
    return chunking.section_chunks(_sectioned(spark, sf), keep=["doc_id"]).select(
        "doc_id", long("chunk_index").alias("chunk_index"),
        F.md5(F.coalesce("heading", F.lit(""))).alias("heading_md5"), F.md5("chunk_text").alias("text_md5"),
    )


def chunk_duplicate_keys(spark, sf):
    counted = monitor.duplicate_key_count(fixed_document_chunks(spark, sf))
    return counted.select(*[long(c).alias(c) for c in counted.columns])


def chunk_duplicate_texts(spark, sf):
    chunks = fixed_document_chunks(spark, sf).select(F.md5("chunk_text").alias("text_md5"))
    return monitor.duplicate_keys(chunks, "text_md5").select("text_md5", long("copies").alias("copies"))


def chunk_length_summary(spark, sf):
    s = monitor.length_summary(fixed_document_chunks(spark, sf))
    return s.select(long("n").alias("n"), *[F.round(c, 6).alias(c) for c in s.columns if c != "n"])


def text_statistics(spark, sf):
    s = monitor.text_statistics(spread(load(spark, sf, "documents")), "text", ["lang", "source"])
    whole = ("n", "words", "sentences")
    return s.select(
        "lang", "source", *[long(c).alias(c) for c in whole],
        *[F.round(c, 6).alias(c) for c in s.columns if c not in (*whole, "lang", "source")],
    )


def snapshots(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The chunk table before and after a review of the corpus.

    Afterwards toxic documents are gone, digits are masked, and pages came in.
    """
    docs = spread(load(spark, sf, "documents")).select(
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("url"), "doc_id", F.col("text").alias("content")
    )
    toxic = load(spark, sf, "labels").where("toxic = 1").select("doc_id")
    masked = sync.without_keys(docs, toxic, "doc_id").select(
        "url", F.regexp_replace("content", "[0-9]", "#").alias("content")
    )
    pages = markup.html_to_markdown(_pages(spark, sf).select(
        F.concat(F.lit("page/"), F.col("page_id").cast("string")).alias("url"), "html"
    ))

    def chunks(df):
        return chunking.finish_chunks(chunking.fixed_chunks(df, keep=["url"]))

    return chunks(docs), chunks(masked.unionByName(pages))


def snapshot_diff(spark, sf):
    old, new = snapshots(spark, sf)
    return sync.snapshot_diff(old, new, keep_same=True)


def snapshot_apply(spark, sf):
    old, new = (written(s, "snapshot", "zstd") for s in snapshots(spark, sf))
    _, table = sync.refresh(old, new)
    return _shown(table)


def change_feed(spark, sf):
    """The changed keys with the new text; deletes carry none."""
    old, new = (written(s, "snapshot", "zstd") for s in snapshots(spark, sf))
    changes, _ = sync.refresh(old, new)
    return changes.select("chunk_id", "change_type", F.md5("chunk_text").alias("text_md5"))


def index_reconcile(spark, sf):
    return sync.reconcile(load(spark, sf, "documents"), load(spark, sf, "embeddings"), "doc_id", "vec_id")


def last_message(spark, sf):
    turns = load(spark, sf, "conversations")
    last = turns.groupBy("conv_id").agg(F.max_by(F.struct("turn", "role", "text"), "turn").alias("m"))
    return last.select("conv_id", F.col("m.turn").alias("turn"), F.col("m.role").alias("role"),
                       F.md5("m.text").alias("question_md5"))


def chat_question(spark, sf):
    """Every turn written as a request of one of the accepted shapes, and read back."""
    turns = load(spark, sf, "conversations")
    message = F.struct(F.col("role"), F.col("text").alias("content"))
    earlier = F.struct(F.lit("system").alias("role"), F.lit("earlier").alias("content"))
    request = (
        F.when(F.col("role") == "user", F.to_json(F.struct(F.col("text").alias("query"), F.array().cast("array<string>").alias("history"))))
        .when(F.col("role") == "assistant", F.to_json(F.struct(F.array(earlier, message).alias("messages"))))
        .otherwise(F.to_json(F.array(earlier, message)))
    )
    return turns.select("conv_id", "turn", F.md5(payloads.question_of(request)).alias("question_md5"))


def chat_answer(spark, sf):
    """Every turn written as a response of one of the accepted shapes, and read back."""
    turns = load(spark, sf, "conversations")
    body = F.struct(F.col("text").alias("content"))
    response = (
        F.when(F.col("role") == "user", F.to_json(body))
        .when(F.col("role") == "assistant", F.to_json(F.struct(body.alias("predictions"))))
        .otherwise(F.to_json(F.struct(F.array(body).alias("predictions"))))
    )
    return turns.select("conv_id", "turn", F.md5(payloads.answer_of(response)).alias("answer_md5"))


def refusal_flags(spark, sf):
    turns = load(spark, sf, "conversations")
    return turns.select("conv_id", "turn", long(payloads.is_refusal("text", REFUSAL)).alias("refused"))


def injection_flags(spark, sf):
    flagged = monitor.quarantine(
        load(spark, sf, "documents"), "text", (*X.INJECTION_PATTERNS, *EXTRA_PATTERNS)
    )
    return flagged.select("doc_id", long("quarantined").alias("quarantined"))


def golden_append(spark, sf):
    """Well judged documents are the golden set; badly judged ones are flagged."""
    judged = load(spark, sf, "labels").join(load(spark, sf, "documents"), "doc_id")
    row = judged.select(
        X.title_of("text", "source").alias("request"), F.col("lang").alias("expected_response"),
        "quality", "toxic",
    )
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    golden = row.where(good).select("request", "expected_response")
    return evaluate.append_flagged(golden, row.where(~good).select("request", "expected_response"))


def traffic_sample(spark, sf):
    return monitor.traffic_sample(load(spark, sf, "events"), "event_id", 0.1).select(
        "event_id", "event_type", "value"
    )


def sampled_keys(spark, sf):
    """Chunk keys of every event, as a check of the key itself."""
    events = load(spark, sf, "events")
    url = F.concat(F.lit("event/"), F.col("event_type"))
    return events.select("event_id", keys.chunk_id(url, "event_id").alias("chunk_id"))


QUERIES = {
    f.__name__: f
    for f in (
        bronze_documents, row_counts, preview_rows, partitioned_table, catalogue_table, page_names, page_markdown, utf8_repaired, page_load_times, page_plain_text,
        page_chunks, chunk_recursive, chunk_sql_function, chunk_fixed_window, chunk_token_window, chunk_measured, chunk_sections, chunk_sections_sized,
        chunk_duplicate_keys, chunk_duplicate_texts, chunk_length_summary, text_statistics,
        snapshot_diff, snapshot_apply, change_feed, index_reconcile, last_message, chat_question, chat_answer,
        refusal_flags, injection_flags, golden_append, traffic_sample, sampled_keys,
    )
}
