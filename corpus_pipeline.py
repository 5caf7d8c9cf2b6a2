"""The corpus pipeline: five stages over documents, each written as Parquet before the next reads it.

Documents that the quality classifier scores under its threshold go; of each group of near copies (five-word shingles,
similarity 0.8, linked through others too) one row stays, of the smallest doc_id; documents with a passage of the benchmark go;
personal data in the rest is replaced by its kind in brackets, and n_chars follows the new text; what is left is packed
into sequences.

Defined results, stage by stage:
quality: a null or empty text is scored like any other; without labels every document stays (score 0.5).
near_copies: rows without a doc_id or without words are nobody's copy and stay; of rows that share a doc_id each text is a
row of its own: exact repeats leave one row, a different text stays unless it is a copy; of equal candidates the smallest
text and other columns stay.
benchmark: null and empty texts match nothing and stay; an empty benchmark drops nothing.
personal_data: a null text becomes empty; repeated rows stay.
packed: null and empty texts are one end id; repeated rows are packed each.
Empty tables give empty tables. Columns beyond those of documents pass through the first four stages, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import decontaminate, jaccard_join, mil_quality, packing, pii
from quillspark.llm.common import free_name, named, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: keep what scores at least THRESHOLD, by a model of the labels that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    model = mil_quality.train(docs, labels.select("doc_id", F.col("quality").alias("label")))
    score = free_name(docs, "_score")
    return mil_quality.with_scores(docs, model, score).filter(F.col(score) >= mil_quality.THRESHOLD).drop(score)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: keep one row of each component, that of the smallest doc_id."""
    return jaccard_join.without_copies(docs, k=5, percent=80).select(*map(named, docs.columns))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: drop documents with a window like a benchmark item."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: replace personal data in texts."""
    clean = pii.redacted(docs, pii.train(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*map(named, docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: pieces of documents in sequences."""
    return packing.pack(docs, remembered=150_000, forget=True).drop("ids")  # few and not for long, as workers hold what other stages need too


STAGES = [("quality", quality), ("near_copies", near_copies), ("benchmark", benchmark), ("personal_data", personal_data), ("packed", packed)]
#: Models and tokenizers are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
