"""The corpus pipeline: quality, language, near duplicates, mixing, pieces. Each stage reads what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stocktally.llm.common import table
from stocktally.llm.lang_id import identify_language
from stocktally.llm.mixing import emit_copies, mix_sources
from stocktally.llm.near_duplicates import keep_one
from stocktally.llm.pieces import encode_pieces
from stocktally.llm.quality_knn import classify_quality
from stocktally.session import cut_lineage, tune


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return classify_quality(docs, table(spark, sf_dir, "labels")).filter(F.col("predicted") == 1).select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of no language the model is sure enough of, go."""
    return identify_language(docs).filter("accepted").select(*docs.columns)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source near its target: a document comes as often as the mix takes it."""
    return emit_copies(mix_sources(docs), docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document that is left, checked by decoding."""
    return encode_pieces(docs, verify=True, keep=["doc_id", "lang", "source"])


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicate), ("mixing", mixing), ("pieces", pieces)]

# Three stages are trained models or searches that SQL cannot express; tests hold each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    tune(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
