"""Duplicates, leakage between splits, digests, and the checks of a whole dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .digests import sequence_digest

FINGERPRINT_CHARS = 16


def duplicate_counts(df: DataFrame, split: str, fingerprint: str) -> DataFrame:
    """Per split: examples and duplicates (rows beyond the first of each fingerprint)."""
    each = df.groupBy(split, fingerprint).agg(F.count("*").alias("_n"))
    return each.groupBy(split).agg(F.sum("_n").alias("examples"), (F.sum("_n") - F.count("*")).alias("duplicates"))


def leakage(df: DataFrame, split: str, fingerprint: str) -> DataFrame:
    """Per pair of splits that share fingerprints: split_a, split_b (in order) and how many distinct ones.

    One shuffle gives each fingerprint's splits; their number is bounded, so are the pairs of one fingerprint."""
    shared = df.groupBy(fingerprint).agg(F.array_sort(F.collect_set(split)).alias("_s")).filter(F.size("_s") > 1)
    pairs = F.flatten(F.transform("_s", lambda a, i: F.transform(F.slice("_s", i + 2, F.size("_s")), lambda b: F.struct(a.alias("split_a"), b.alias("split_b")))))
    return shared.select(F.explode(pairs).alias("_p")).groupBy("_p.split_a", "_p.split_b").agg(F.count("*").alias("shared"))


def short_fingerprints(df: DataFrame, fingerprint: str) -> DataFrame:
    """Distinct shortened fingerprints (cut first, then made distinct): column fp."""
    return df.select(F.substring(fingerprint, 1, FINGERPRINT_CHARS).alias("fp")).distinct()


def set_digest(values: Column, separator: str = "\n") -> Column:
    """SHA-256 of the sorted values with a separator between; an aggregate for groups of bounded size, such as a selection."""
    return F.sha2(F.array_join(F.array_sort(F.collect_list(values)), separator), 256)


def fingerprint_digest(df: DataFrame, value: str, separator: str = "\n") -> DataFrame:
    """One row, n and digest: SHA-256 of the sorted values with a separator between, for tables of any size."""
    return sequence_digest(df, F.lit(""), [F.col(value)], F.col(value), separator).select("n", "digest")


def ordered_digest(df: DataFrame, split: str, order: str, fingerprint: str) -> DataFrame:
    """dataset_digest: SHA-256 of all fingerprints one after another, splits by name and rows in order."""
    return sequence_digest(df, F.lit(""), [F.col(split), F.col(order)], F.col(fingerprint)).select(F.col("digest").alias("dataset_digest"))


def named_set_digest(df: DataFrame, split: str, fingerprint: str) -> DataFrame:
    """dataset_digest: SHA-256 of each split's name and its sorted fingerprints, splits by name."""
    names = df.select(F.col(split).alias("s")).distinct().select("s", F.lit(0).alias("k"), F.col("s").alias("v"))
    rows = names.unionByName(df.select(F.col(split).alias("s"), F.lit(1).alias("k"), F.col(fingerprint).alias("v")))
    return sequence_digest(rows, F.lit(""), [F.col("s"), F.col("k"), F.col("v")], F.col("v")).select(F.col("digest").alias("dataset_digest"))


def split_report(df: DataFrame, split: str, fingerprint: str, tokens: str) -> DataFrame:
    """Per split: examples, duplicates, total_tokens, longest."""
    size = df.groupBy(split).agg(F.sum(tokens).alias("total_tokens"), F.max(tokens).alias("longest"))
    return duplicate_counts(df, split, fingerprint).join(size, split)


def first_problem(report: DataFrame, leaks: DataFrame, split: str, ceiling: int, budget: int, least_train: int = 2) -> str | None:
    """The code of the first rule that split_report and leakage break, in the fixed order of the rules."""
    rows = {r[split]: r for r in report.collect()}  # one row a split
    if "train" not in rows:
        return "DATASET_SPLIT_MISSING"
    if rows["train"]["examples"] < least_train:
        return "DATASET_TOO_FEW_EXAMPLES"
    if leaks.limit(1).count():
        return "DATASET_SPLIT_LEAKAGE"
    if any(r["longest"] > ceiling for r in rows.values()):
        return "DATASET_SEQUENCE_TOO_LONG"
    return "DATASET_TOKEN_BUDGET_EXCEEDED" if rows["train"]["total_tokens"] > budget else None
