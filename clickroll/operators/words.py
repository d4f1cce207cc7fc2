"""Word counts over text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_words(lines: DataFrame, column: str = "line") -> DataFrame:
    """One row per word of a line; empty words are dropped."""
    rest = [c for c in lines.columns if c != column]
    # blank, tab, line feed, vertical tab, form feed, carriage return
    words = lines.select(*rest, F.explode(F.split(column, r"[ \t\n\x0B\f\r]+")).alias("word"))
    return words.where(F.col("word") != "")


def word_count(words: DataFrame) -> DataFrame:
    """Words with their counts."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
