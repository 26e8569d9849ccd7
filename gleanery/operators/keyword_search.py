"""Keyword search (BM25), rank fusion and re-ranking."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.functions import scores
from gleanery.functions import text as X
from gleanery.operators import topk as engine
from gleanery.session import written

# The usual BM25 constants and the usual fusion offset.
K1, B = 1.2, 0.75
TERM_BYTES = 64  # what a weighted term takes, about
FUSION_OFFSET = 60

_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """The same tokens as :func:`gleanery.functions.text.tokens`."""
    return _WORD.findall((text or "").lower())


class Bm25Scorer:
    """Scores blocks of text. The queries bring the weights of their own terms."""

    def __init__(self, k1: float, b: float, side_by_side: int | None = None):
        self.k1, self.b, self.side_by_side = k1, b, side_by_side

    def queries(self, column: pa.Array) -> tuple[list[list[tuple[str, float]]], float]:
        values = column.to_pylist()
        mean_length = next((v[0]["mean_length"] for v in values if v), 1.0)
        return [[(t["term"], t["idf"]) for t in v] for v in values], mean_length

    def corpus(self, column: pa.Array, queries):
        """Postings of the block, for the terms that its queries ask for."""
        asked, mean_length = queries
        vocabulary = {term for terms in asked for term, _ in terms}
        rows: dict[str, list[int]] = {}
        weights: dict[str, list[float]] = {}
        for row, text in enumerate(column.to_pylist()):
            found = words(text)
            scale = self.k1 * (1 - self.b + self.b * len(found) / mean_length)
            for word, n in Counter(w for w in found if w in vocabulary).items():
                rows.setdefault(word, []).append(row)
                weights.setdefault(word, []).append(n * (self.k1 + 1) / (n + scale))
        return len(column), {w: (np.array(r), np.array(weights[w])) for w, r in rows.items()}

    def score(self, queries, rows: slice, corpus) -> np.ndarray:
        size, postings = corpus
        block = queries[0][rows]
        out = np.zeros((len(block), size))
        for i, terms in enumerate(block):
            for term, idf in terms:
                if term in postings:
                    at, weight = postings[term]
                    out[i, at] += idf * weight
        return np.where(out > 0, out, -np.inf)


def weighted_queries(queries: DataFrame, documents: DataFrame, small: bool) -> DataFrame:
    """``id, value`` with the terms of each query, their weight and the mean length.

    One pass over the documents: each gives its distinct terms, and one row with
    the empty term that carries its length. Counts are combined before the
    shuffle, so a term that most documents hold is one row per task. ``small``
    says that the terms of the queries may be sent to all tasks.
    """
    asked = queries.select("id", F.explode(F.array_distinct(X.tokens("value"))).alias("term"))
    found = documents.select(X.tokens("value").alias("words")).select(
        F.size("words").alias("length"),
        F.explode(F.array_append(F.array_distinct("words"), F.lit(""))).alias("term"),
    )
    padded = asked.union(queries.select("id", F.lit("").alias("term")))
    wanted = padded.select("term").distinct()
    if small:
        found = found.join(F.broadcast(wanted), "term", "left_semi")
    counted = found.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("length").alias("length")
    )
    # The row of the empty term goes to every query as one more of its terms, and
    # is read back inside the group: statistics need no second pass over the texts.
    grouped = padded.join(counted, "term").groupBy("id").agg(
        F.collect_list(F.struct("term", "df")).alias("terms"),
        F.max(F.when(F.col("term") == "", F.col("df"))).alias("n"),
        F.max(F.when(F.col("term") == "", F.col("length") / F.col("df"))).alias("mean_length"),
    )

    def weigh(t):
        return F.struct(
            t["term"].alias("term"),
            F.log(1 + (F.col("n") - t["df"] + 0.5) / (t["df"] + 0.5)).alias("idf"),
            F.col("mean_length").alias("mean_length"),
        )

    # Sorted terms make a sum of weights come out alike wherever it runs.
    terms = F.array_sort(F.filter("terms", lambda t: t["term"] != ""))
    return grouped.select("id", F.transform(terms, weigh).alias("value"))


def _few_terms(queries: DataFrame) -> bool:
    """Whether the different terms of all queries may be sent to every task; counted by the executors."""
    terms = queries.select(F.explode(F.array_distinct(X.tokens("value"))).alias("term"))
    return terms.agg(F.count_distinct("term")).first()[0] * TERM_BYTES <= engine.SMALL_BYTES


def bm25_search(
    queries: DataFrame,
    documents: DataFrame,
    k: int,
    query_id: str = "query_id",
    query_text: str = "text",
    document_id: str = "chunk_id",
    document_text: str = "chunk_text",
    k1: float = K1,
    b: float = B,
    max_small_rows: int = engine.SMALL_ROWS,
    slice_rows: int = engine.SMALL_ROWS,
) -> DataFrame:
    """The k best documents of every query by BM25: ``query_id, item_id, score, rank``.

    Each distinct query term counts once. Documents without any query term are no
    match. However common a term is, no (query, document) pair is shuffled but
    the k best of each task, and no text at all. A task reads each of its documents
    once and scores it for ``slice_rows`` queries side by side, slice by slice. Only
    where the queries are too many to be sent at once (``max_small_rows`` or else
    ``engine.SMALL_ROWS``, and ``engine.SMALL_BYTES`` of terms), the documents are
    passed over more than once.
    """
    q = queries.select(F.col(query_id).alias("id"), F.col(query_text).alias("value"))
    d = documents.select(F.col(document_id).alias("id"), F.col(document_text).alias("value"))
    small = engine.small_side(q, d, max_small_rows)
    few_terms = small == "queries" or _few_terms(q)
    weighted, scorer = weighted_queries(q, d, few_terms), Bm25Scorer(k1, b, slice_rows)
    if small:
        return engine.topk(weighted, d, scorer, k, small=small)
    weighted = written(weighted, "bm25-queries")
    size = weighted.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("value")), F.lit(0)).alias("terms")).first()
    passes = max(1, -(-size["n"] // (max_small_rows or engine.SMALL_ROWS)), -(-size["terms"] * TERM_BYTES // engine.SMALL_BYTES))
    hits = None
    for i in range(passes):
        part = weighted.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == i)
        found = engine.topk(part, d, scorer, k, small="queries")
        hits = found if hits is None else hits.unionByName(found)
    return hits


def fuse_ranks(
    lists: Sequence[DataFrame], k: int, offset: int = FUSION_OFFSET
) -> DataFrame:
    """Reciprocal rank fusion of ranked lists: ``query_id, item_id, score, rank``.

    The lists are appended and summed by one aggregation, which also keeps items
    that only one list holds.
    """
    all_hits = None
    for hits in lists:
        part = hits.select("query_id", "item_id", (1.0 / (F.lit(offset) + F.col("rank"))).alias("part"))
        all_hits = part if all_hits is None else all_hits.unionByName(part)
    fused = all_hits.groupBy("query_id", "item_id").agg(
        F.round(F.sum("part"), engine.DECIMALS).alias("score")
    )
    return engine.ranked(fused, k)


def rerank(
    candidates: DataFrame,
    k: int,
    query_text: str = "query_text",
    item_text: str = "item_text",
    scorer: Callable[[list[str], list[str]], list[float]] | None = None,
) -> DataFrame:
    """Score the candidates of a first search again and keep k per query.

    ``candidates`` holds ``query_id, item_id`` and both texts. The default scorer
    is the share of the query's tokens found in the item; a scorer of your own
    gets two lists of texts, one Arrow batch at a time.
    """
    rest = candidates.drop("score", "rank")
    if scorer is None:
        read = rest.withColumns({
            "_query": F.array_distinct(X.tokens(query_text)),
            "_item": F.array_distinct(X.tokens(item_text)),
        })
        share = scores.token_share("_query", "_item")
        scored = read.withColumn("score", F.round(share, engine.DECIMALS)).drop("_query", "_item")
    else:
        schema = T.StructType([*rest.schema.fields, T.StructField("score", T.DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = scorer(
                    batch.column(batch.schema.get_field_index(query_text)).to_pylist(),
                    batch.column(batch.schema.get_field_index(item_text)).to_pylist(),
                )
                yield batch.append_column("score", pa.array(values, pa.float64()))

        scored = rest.mapInArrow(run, schema).withColumn("score", F.round("score", engine.DECIMALS))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "item_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def shortest_window(query: Sequence[str], text: Sequence[str]) -> tuple[int, int]:
    """How many different query words the text has, and the words of its shortest stretch that has them all.

    Two pointers over the places of query words: the stretch grows to the right until it
    has all, and is then cut from the left while it still does.
    """
    wanted = set(query)
    at = [(i, w) for i, w in enumerate(text) if w in wanted]
    needed = len({w for _, w in at})
    held: Counter[str] = Counter()
    best, left = len(text), 0
    for right, (place, word) in enumerate(at):
        held[word] += 1
        while len(held) == needed:
            first, gone = at[left]
            best = min(best, place - first + 1)
            held[gone] -= 1
            if not held[gone]:
                del held[gone]
            left += 1
    return needed, best if needed else 0


def closeness(query: str | None, text: str | None) -> float:
    """Mean of the share of query words that the text has and of how densely its shortest stretch holds them."""
    asked = list(dict.fromkeys(words(query)))
    found, window = shortest_window(asked, words(text))
    return (found / len(asked) + found / window) / 2 if found else 0.0


def rerank_by_closeness(candidates: DataFrame, k: int, query_text: str = "query_text", item_text: str = "item_text") -> DataFrame:
    """:func:`rerank` by how near to each other the query's words stand. Null texts score 0."""
    return rerank(candidates, k, query_text, item_text, lambda q, t: [closeness(a, b) for a, b in zip(q, t, strict=True)])


def diversify(hits: DataFrame, k: int, trade: float = 0.7, item_text: str = "item_text") -> DataFrame:
    """Marginal relevance: ``query_id, item_id, score, rank`` of k hits that repeat each other little.

    Hits are taken one by one: the next has the highest ``trade`` times its score less
    ``1 - trade`` times its likeness (common share of different words) to the most alike hit taken; ties
    go to the smaller id. A group is one query's hits, as deep as the search before it went.
    """
    if not 0 <= trade <= 1:
        raise ValueError("trade must lie between 0 and 1")
    rows = hits.select("query_id", "item_id", "score", F.col(item_text).alias("text"))

    def choose(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("item_id").to_numpy(zero_copy_only=False), kind="stable")
        score = table.column("score").to_numpy(zero_copy_only=False)[order].astype(np.float64)
        texts = table.column("text").to_pylist()
        sets = [set(words(texts[i])) for i in order]
        alike, taken, values = np.zeros(len(order)), [], []
        free = np.ones(len(order), bool)
        for _ in range(min(k, len(order))):
            value = np.where(free, np.round(trade * score - (1 - trade) * alike, engine.DECIMALS), -np.inf)
            best = int(value.argmax())  # the first of equal ones
            taken.append(best)
            values.append(value[best])
            free[best] = False
            both = np.array([len(s & sets[best]) / max(1, len(s | sets[best])) for s in sets])
            alike = np.maximum(alike, both)
        at = pa.array(order[taken].astype(np.int64))
        return pa.table({"query_id": table.column("query_id").take(at), "item_id": table.column("item_id").take(at), "score": pa.array(values, pa.float64()), "rank": pa.array(range(1, len(taken) + 1), pa.int32())})

    fields = [rows.schema["query_id"], rows.schema["item_id"], T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType())]
    return rows.groupBy("query_id").applyInArrow(choose, T.StructType(fields))
