"""Retrieval and lexical scores over array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _list(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.array().cast("array<string>"))


def _hits(retrieved: Column, expected: Column) -> Column:
    return F.size(F.array_intersect(retrieved, expected)).cast("double")


def precision_at_k(retrieved: Column | str, expected: Column | str) -> Column:
    """Distinct hits over the length of the retrieved list; 0 when it is empty."""
    r, e = _list(retrieved), _list(expected)
    return F.when(F.size(r) == 0, F.lit(0.0)).otherwise(_hits(r, e) / F.size(r))


def recall_at_k(retrieved: Column | str, expected: Column | str) -> Column:
    """Distinct hits over the length of the expected list; 1 when it is empty."""
    r, e = _list(retrieved), _list(expected)
    return F.when(F.size(e) == 0, F.lit(1.0)).otherwise(_hits(r, e) / F.size(e))


def _common(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)).cast("double")


def token_share(part: Column | str, whole: Column | str) -> Column:
    """Share of ``part`` that ``whole`` holds too; both are arrays of distinct tokens."""
    part, whole = _list(part), _list(whole)
    return F.coalesce(_common(part, whole) / F.nullif(F.size(part), F.lit(0)), F.lit(0.0))


def token_f1(answer: Column | str, expected: Column | str) -> Column:
    """Harmonic mean of both token shares: twice the overlap over both sizes."""
    answer, expected = _list(answer), _list(expected)
    both = F.size(answer) + F.size(expected)
    return F.coalesce(2 * _common(answer, expected) / F.nullif(both, F.lit(0)), F.lit(0.0))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of two array columns; null when either has no length.

    Array lambdas run interpreted, so this is for scoring known pairs. Searching
    goes through :mod:`gleanery.operators.vector_search`.
    """
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b

    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda u, v: u.cast("double") * v.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)

    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)
