"""Functions for callers who write SQL."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf
from pyspark.sql.types import IntegerType, StringType, StructType

from gleanery.operators.chunking import CHUNK_OVERLAP, CHUNK_SIZE, SEPARATORS, recursive_spans


class SplitText:
    """``split_text(text [, size [, overlap]])``: the pieces of recursive splitting, numbered from 0."""

    def __init__(self) -> None:
        self.size, self.overlap = CHUNK_SIZE, CHUNK_OVERLAP

    @staticmethod
    def analyze(text: AnalyzeArgument, size: AnalyzeArgument | None = None, overlap: AnalyzeArgument | None = None) -> AnalyzeResult:
        if text.isTable or not isinstance(text.dataType, StringType):
            raise ValueError("split_text: the first argument must be a text")
        for name, a in (("size", size), ("overlap", overlap)):
            if a is not None and (not a.isConstantExpression or not isinstance(a.value, int) or a.value < 0):
                raise ValueError(f"split_text: {name} must be a whole number that is given as a constant")
        if (overlap.value if overlap else CHUNK_OVERLAP) >= (size.value if size else CHUNK_SIZE):
            raise ValueError("split_text: overlap must be smaller than size")
        return AnalyzeResult(StructType().add("chunk_index", IntegerType()).add("chunk_text", StringType()))

    def eval(self, text: str | None, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Iterator[tuple[int, str]]:
        at = 0
        for a, b in recursive_spans(text or "", size, overlap, SEPARATORS):
            if piece := text[a:b].strip():
                yield at, piece
                at += 1


def register(spark: SparkSession) -> None:
    """Make ``split_text`` known to the session: ``FROM pages, LATERAL split_text(content, 800, 150)``."""
    spark.udtf.register("split_text", udtf(SplitText))
