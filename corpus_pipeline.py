"""The corpus pipeline: each stage calls one operator on what the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickroll.llm import decontaminate, lines, pieces, quality, simhash
from clickroll.llm.common import table
from clickroll.session import stored, work_dir

ORACLE_SQL = None


def _free(name: str, docs: DataFrame) -> str:
    """The name, with underscores behind while the documents have such a column."""
    while name in docs.columns:
        name += "_"
    return name


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    score = _free("_score", docs)
    kept = quality.scored(docs, quality.quality_model(spark, sf_dir), out=score)
    return kept.where(F.col(score) >= quality.PREDICT_AT).drop(score)


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages and chunks of lines that stand elsewhere before; ``n_chars``, if there, follows the text."""
    cut = stored(lines.cut_passages(docs), "passages")
    kept = lines.dedup_lines(cut).select(*docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest id: four words a shingle, four bits apart at most."""
    return simhash.unique_documents(docs, shingle=4, distance=4)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids with the bytes each stands for, and digests of ids and decoded text."""
    import public_tokenizers

    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    fields = ("n_tokens", "ids", "begins", "ends", "ids_sha256", "decoded_sha256")
    return pieces.with_pieces(docs.select("doc_id", "text"), model, *fields).select("doc_id", *fields)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("lines", lines_stage),
    ("simhash", simhash_stage),
    ("benchmark", benchmark_stage),
    ("pieces", pieces_stage),
]
"""Quality classifier, line dedup, near dedup, decontamination, SentencePiece."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
