"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; `run` writes each one's result to the
shared folder and reads it back, so that a lost executor costs no more than its stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import additive_model, bin_packing, line_templates, near_dup, semantic_leaks
from ledgerlake.llm.queries import shared_folder
from ledgerlake.workspace import shared_folder as fresh_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.3 or more."""
    model = additive_model.fit_quality_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return additive_model.keep_good(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines whose template recurs across documents."""
    shared_folder(spark)
    return line_templates.drop_recurring_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (80 % of their shingles or more in common), that with the smallest id,
    and one row of each id. Documents without an id can't be told apart and stay."""
    shared_folder(spark)
    kept = near_dup.near_duplicates(docs, percent=80).where("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.where("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item leaks."""
    return semantic_leaks.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    return bin_packing.pack(bin_packing.count_tokens(docs))


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]
#: The learned stages have no SQL; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
