"""Token-length statistics and the policies on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN_BUDGET, CEILING, SHOWN = 50_000_000, 2048, 50


def whitespace_tokens(text: Column) -> Column:
    """A deterministic tokenizer for tests: runs of other than white space."""
    return F.regexp_count(text, F.lit(r"\S+"))


def token_stats(df: DataFrame, split: str, tokens: str, splits: list[str] | None = None) -> DataFrame:
    """Per split: count, min, median (cut to a whole number), nearest-rank p95 and p99, max, total. Named splits without rows are zeros.

    Lengths are counted first, so that what is sorted is one row per distinct length."""
    each = df.groupBy(split, F.col(tokens).cast("long").alias("x")).agg(F.count("*").alias("n"))
    sums = each.groupBy(split).agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("x", "n"))).alias("_lengths"), F.sum(F.col("x") * F.col("n")).alias("total_tokens"))

    def at(rank: Column) -> Column:
        """The length with this rank, from 1."""
        start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("hit"))
        step = lambda s, r: F.struct((s["seen"] + r["n"]).alias("seen"), F.coalesce(s["hit"], F.when(s["seen"] + r["n"] >= rank, r["x"])).alias("hit"))
        return F.aggregate("_lengths", start, step)["hit"]

    n = F.col("n")
    median = ((at(F.floor((n + 1) / 2)) + at(F.floor(n / 2) + 1)) / 2).cast("long")
    share = lambda percent: at(F.expr(f"(n * {percent} + 99) div 100"))
    stats = sums.select(split, "n", F.array_min("_lengths")["x"].alias("min_tokens"), median.alias("median_tokens"), share(95).alias("p95_tokens"), share(99).alias("p99_tokens"), F.array_max("_lengths")["x"].alias("max_tokens"), "total_tokens")
    if splits:
        named = df.sparkSession.createDataFrame([(s,) for s in splits], f"`{split}` string")
        stats = named.join(stats, split, "left").na.fill(0)
    return stats


def overlength(df: DataFrame, split: str, line: str, tokens: str, ceiling: int = CEILING, shown: int = SHOWN) -> DataFrame:
    """Per split with longer rows: how many, the longest, and the first lines of them in order.

    Only the shown first lines of each split are gathered, found by a rank that Spark limits before it shuffles."""
    from pyspark.sql.window import Window

    long = df.filter(F.col(tokens) > ceiling)
    first = long.withColumn("_k", F.row_number().over(Window.partitionBy(split).orderBy(line))).filter(F.col("_k") <= shown)
    lines = first.groupBy(split).agg(F.array_join(F.array_sort(F.collect_list(line)), ",").alias("first_lines"))
    return long.groupBy(split).agg(F.count("*").alias("n_long"), F.max(tokens).cast("long").alias("longest")).join(lines, split)


def token_budget(df: DataFrame, split: str, tokens: str, ceiling: int = CEILING, budget: int = TRAIN_BUDGET) -> DataFrame:
    """One row: code of the policy that df breaks (a long sequence in any split goes before the train budget), or ok."""
    sums = df.agg(F.count_if(F.col(tokens) > ceiling).alias("n_long"), F.coalesce(F.sum(F.when(F.col(split) == "train", F.col(tokens))), F.lit(0)).cast("long").alias("train_tokens"))
    code = F.when(F.col("n_long") > 0, "DATASET_SEQUENCE_TOO_LONG").when(F.col("train_tokens") > budget, "DATASET_TOKEN_BUDGET_EXCEEDED").otherwise("ok")
    return sums.withColumn("code", code)
