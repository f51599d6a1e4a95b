"""A corpus from raw documents: filter, dedup, mix and pack, one table per stage."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterlab.llm import lines, mixing, ngram_join, packing, quality
from meterlab.plans.blocks import settled

# Random rounding and trained models have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of earlier ones; those of which nothing is left go."""
    found = lines.dedup(docs)
    names = docs.columns
    # By place, since documents may have columns of any names.
    plain = found.toDF(*[f"_{i}" for i in range(len(names))], "removed", "_words")
    text = f"_{names.index('text')}"
    empty = F.coalesce(F.length(F.trim(text)), F.lit(0)) == 0
    left = plain.where((F.col("removed") == 0) | ~empty)
    if "n_chars" in names:
        size = f"_{names.index('n_chars')}"
        changed = F.when(F.col("removed") > 0, F.length(text).cast("long"))
        left = left.withColumn(size, F.coalesce(changed, F.col(size)))
    return left.drop("removed", "_words").toDF(*names)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.keep_one(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    return mixing.repeat(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("mixing sources to target weights", mixing_sources),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is stored in the shared folder before the next.

    What a stage stores on its way is deleted when it is done, and the stages when the last one is.
    """

    def stages() -> DataFrame:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for name, stage in STAGES:
            docs = settled(partial(stage, spark, docs, sf_dir), name.replace(" ", "-"))
        return docs

    return settled(stages, "pipeline")
