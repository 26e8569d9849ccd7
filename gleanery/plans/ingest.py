"""From pages to the chunk table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions import text as X
from gleanery.operators import chunking, markup
from gleanery.sources import files, tables


def bronze_from_files(spark: SparkSession, folder: str, host: str) -> DataFrame:
    """``url, title, content, ingested_at`` for the page files of a folder."""
    pages = files.read_page_files(spark, folder).withColumn(
        "url", X.url_from_file_name("file_name", host)
    )
    return to_bronze(markup.html_to_markdown(pages, "raw", only_if="is_html"), "file_name")


def bronze_from_pages(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """The same from a table of pages."""
    cleaned = markup.html_to_markdown(pages.select(F.col(url).alias("url"), F.col(html).alias("html")))
    return to_bronze(cleaned, "url")


def to_bronze(cleaned: DataFrame, fallback_title: str) -> DataFrame:
    """Titles and load time; pages without text are dropped."""
    return cleaned.where(~X.is_blank("content")).select(
        "url",
        X.title_of("content", fallback_title).alias("title"),
        "content",
        F.current_timestamp().alias("ingested_at"),
    )


def silver_from_bronze(
    bronze: DataFrame, strategy: str = "recursive_character",
    size: int | None = None, overlap: int | None = None, min_size: int = chunking.MIN_CHUNK_SIZE,
) -> DataFrame:
    """Keyed chunks by one of the named strategies."""
    splitters = {
        "recursive_character": chunking.recursive_chunks,
        "markdown_header": chunking.section_chunks,
        "token_based": chunking.token_chunks,
        "fixed": chunking.fixed_chunks,
    }
    if strategy not in splitters:
        raise ValueError(f"unknown strategy {strategy!r}; one of {sorted(splitters)}")
    given = {"size": size, "overlap": overlap}
    given = {k: v for k, v in given.items() if v is not None}
    split = splitters[strategy]
    if strategy == "markdown_header" and given:
        split = chunking.section_then_recursive_chunks  # sections above the size are split further
    pieces = split(bronze, **given)
    return chunking.finish_chunks(pieces, min_size).select(
        "chunk_id", "url", "title", "chunk_index", "chunk_text"
    )


def run_ingestion(
    spark: SparkSession, folder: str, host: str, bronze_path: str, silver_path: str
) -> dict[str, int]:
    """Files to both tables; returns the row counts seen by the two writes."""
    written = {
        "documents": tables.write_table(
            bronze_from_files(spark, folder, host), bronze_path, count_rows=True
        )
    }
    # Read back, so that files are parsed once and a lost executor re-reads a table.
    bronze = spark.read.parquet(bronze_path)
    written["chunks"] = tables.write_table(silver_from_bronze(bronze), silver_path, count_rows=True)
    return written
