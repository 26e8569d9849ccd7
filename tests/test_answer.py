"""Each kind of search in the answering path."""

import pytest
from pyspark.sql import functions as F

from gleanery.operators import inference
from gleanery.plans import answer


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(f"c{i}", f"u{i % 20}", "t", f"word{i % 40} word{(i * 7) % 40} word{(i * 3) % 11}") for i in range(200)]
    df = spark.createDataFrame(rows, "chunk_id string, url string, title string, chunk_text string")
    return answer.embed_to_table(df, "chunk_text", inference.HashingEmbedder(64), 64)


@pytest.mark.parametrize("search,options", [("celled", {"cells": 8, "probes": 4}), ("hashed", {"bits": 3, "tables": 8})])
def test_approximate_searches_find_most(spark, corpus, search, options):
    questions = spark.createDataFrame([(str(i), f"word{i} word{(i * 7) % 40}") for i in range(40)], "query_id string, question string")
    embed = inference.HashingEmbedder(64)
    want = answer.retrieve(questions, corpus, embed, 64, 5).select("query_id", "item_id")
    got = answer.retrieve(questions, corpus, embed, 64, 5, search=search, **options).select("query_id", "item_id")
    assert want.join(got, ["query_id", "item_id"]).count() >= 0.9 * want.count()
    some = answer.retrieve(questions, corpus, embed, 64, 5, 0.99, search=search, **options)
    assert some.where(F.col("score") < 0.99).count() == 0


def test_unknown_search(spark, corpus):
    with pytest.raises(ValueError, match="unknown search"):
        answer.retrieve(spark.createDataFrame([("1", "x")], "query_id string, question string"), corpus, inference.HashingEmbedder(64), 64, search="magic")
