"""A corpus from raw documents: five stages, each written to the shared folder and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import content_sort, jaccard, queries, tiling, toxicity
from tidewatch.session import ship_package, work_dir


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network doesn't reject. It learns from the labelled documents of the stage's input."""
    scorer = queries.toxicity_scorer(docs, queries.labels(spark, sf_dir))
    return toxicity.score_toxicity(docs, scorer).filter(F.col("score") < queries.TOXIC_FROM).select("row.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest identifier."""
    return content_sort.deduplicate_texts(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group connected by shingle similarity, the one with the smallest identifier."""
    return jaccard.keep_representatives(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold an item of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return tiling.mark_contaminated(docs, benchmark).filter(~F.col("contaminated")).select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 2048 ids."""
    return queries.packed_pieces(docs)


STAGES = [
    ("toxicity", toxic),
    ("exact_dedup", exact_copies),
    ("jaccard_join", near_copies),
    ("decontamination", benchmark_passages),
    ("packing", packed),
]

#: SQL can't run the network or the tokenizer; tests hold the rows against plain versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
