"""A table of questions to a table of answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators import context, inference, keyword_search, text_index, vector_index, vector_search
from gleanery.session import written


def embed_to_table(df: DataFrame, text: str, embed_fn: Callable, dimension: int, **options) -> DataFrame:
    """Embed once and read back: later passes must not call the model again."""
    return written(inference.embed_texts(df, text, embed_fn, dimension, **options), "vectors")


def retrieve(
    questions: DataFrame, chunks: DataFrame, embed_fn: Callable, dimension: int, k: int = 5,
    min_score: float | None = None, search: str = "exact", **options,
) -> DataFrame:
    """Ranked hits of each question with ``url, title, chunk_text``.

    ``questions`` holds ``query_id, question``; ``chunks`` holds ``vector`` (made
    by the same ``embed_fn``) next to its key and text. ``search`` is ``exact``,
    or for a large corpus ``celled`` or ``hashed``, which look at a part of it, by
    default as much as finds nine tenths of the true neighbours of sampled questions;
    ``index`` asks the kept index at ``path`` (:mod:`gleanery.operators.vector_index`) and
    reads no vectors of ``chunks``; ``keyword`` is BM25, from the kept index at ``text_path``
    if that is given; ``hybrid`` fuses the ranks of ``deep`` keyword hits and as many of
    the vector search (from the index at ``path`` if that is given). A ``min_score`` holds
    against the scores of the search: cosines, BM25 or fused ranks. Other ``options`` are those of that
    search.
    """
    asked = embed_to_table(questions.select("query_id", "question"), "question", embed_fn, dimension)
    if search == "exact":
        hits = vector_search.exact_search(asked, chunks, k, min_score=min_score, **options)
    elif search == "celled":
        hits = vector_search.celled_search(asked, chunks, k, **options)
    elif search == "hashed":
        hits = vector_search.hashed_search(asked, chunks, k, dimension, **options)
    elif search == "index":
        hits = vector_index.search_index(asked, k=k, **options)
    elif search in ("keyword", "hybrid"):
        hits = _by_keywords(asked, chunks, k, search == "hybrid", **options)
    else:
        raise ValueError(f"unknown search {search!r}; one of exact, celled, hashed, index, keyword, hybrid")
    if search != "exact" and min_score is not None:
        hits = hits.where(F.col("score") >= min_score)
    return vector_search.with_columns_of(hits, chunks, "chunk_id", ["url", "title", "chunk_text"])


def _by_keywords(
    asked: DataFrame, chunks: DataFrame, k: int, fused: bool, text_path: str | None = None, path: str | None = None,
    deep: int | None = None,
) -> DataFrame:
    deep = (deep or 4 * k) if fused else k
    if text_path:
        words = text_index.search_text_index(asked, text_path, deep, query_text="question")
    else:
        words = keyword_search.bm25_search(asked, chunks, deep, query_text="question")
    if not fused:
        return words
    dense = vector_index.search_index(asked, path, deep) if path else vector_search.exact_search(asked, chunks, deep)
    return keyword_search.fuse_ranks([words, dense], k)


def answer_questions(
    questions: DataFrame, chunks: DataFrame, embed_fn: Callable, dimension: int,
    generate_fn: Callable, system: str, subject: str = "the documentation", k: int = 5,
    min_score: float | None = None, search: str = "exact", search_options: dict | None = None,
    **call_options,
) -> DataFrame:
    """``query_id, question, context, cited_urls, system, human, answer, error, latency_s``."""
    hits = retrieve(questions, chunks, embed_fn, dimension, k, min_score, search, **(search_options or {}))
    prompted = context.prompts(
        questions.select("query_id", "question"), context.context_blocks(hits), system, subject=subject
    )
    return inference.answer_prompts(prompted, generate_fn, **call_options)
