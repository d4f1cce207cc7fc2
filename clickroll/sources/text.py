"""Text-line streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines a socket sends, as column ``line``."""
    lines = spark.readStream.format("socket").option("host", host).option("port", port).load()
    return lines.select(F.col("value").alias("line"))


def file_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Lines of text files as they appear in a folder."""
    lines = spark.readStream.options(**options).text(path)
    return lines.select(F.col("value").alias("line"))


def text_column_lines(table: DataFrame, column: str) -> DataFrame:
    """Lines of a text column; works on batch and stream alike."""
    return table.select(F.explode(F.split(column, "\n")).alias("line"))
