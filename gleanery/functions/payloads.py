"""Chat requests and responses held as JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted shapes of a request.
_REQUEST = "struct<query:string,messages:array<struct<role:string,content:string>>>"
_MESSAGES = "array<struct<role:string,content:string>>"


def question_of(request: Column | str) -> Column:
    """The question in a request, whatever its shape.

    A bare list or ``messages`` gives the content of its last message (of any
    role); otherwise ``query`` is taken. ``history`` is accepted and not used.
    """
    raw = F.col(request) if isinstance(request, str) else request
    body = F.from_json(raw, _REQUEST)
    bare = F.from_json(raw, _MESSAGES)
    is_list = raw.rlike(r"\A\s*\[")

    def last(messages: Column) -> Column:
        return F.try_element_at(messages, F.lit(-1))["content"]

    return F.when(is_list, last(bare)).otherwise(
        F.coalesce(body["query"], last(body["messages"]))
    )


def answer_of(response: Column | str) -> Column:
    """The text in a response: under ``predictions`` (object or list) or bare."""
    raw = F.col(response) if isinstance(response, str) else response
    return F.coalesce(
        F.get_json_object(raw, "$.predictions[0].content"),
        F.get_json_object(raw, "$.predictions.content"),
        F.get_json_object(raw, "$.content"),
    )


def is_refusal(answer: Column | str, sentence: str) -> Column:
    """True where the answer contains the refusal sentence, ignoring case."""
    text = F.col(answer) if isinstance(answer, str) else answer
    return F.coalesce(F.contains(F.lower(text), F.lower(F.lit(sentence))), F.lit(False))
