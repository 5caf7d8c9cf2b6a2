"""One report on a dataset's splits, all findings at once, from one scan and one shuffle by fingerprint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import messages_code
from .tokens import CEILING, TRAIN_BUDGET

SPLITS = ("train", "validation", "test")
#: Least examples of the train split (fixed value).
LEAST_TRAIN = 2


def input_report(df: DataFrame, split: Column, messages: Column, fingerprint: Column, tokens: Column | None, ceiling: int = CEILING, budget: int = TRAIN_BUDGET, splits: tuple[str, ...] = SPLITS) -> DataFrame:
    """One row: verdict, code (the first finding that rejects, or null), inputs (one struct a split that has rows, in order of
    `splits`: split, records, duplicates, invalid, total_tokens, longest, too_long), and findings (code, split, other, n) in the order
    of the rules.

    Rules in order: no train split, too few train rows, for each split a record of the wrong form (DATASET_SCHEMA_UNKNOWN,
    DATASET_ROLE_INVALID, DATASET_TARGET_EMPTY, with how many), leakage by pair of splits, for each split longer sequences
    than the ceiling, the budget of train tokens; last, as accepted remarks without a code that rejects, duplicates in a split.
    Without tokens the rules on tokens are left out.

    Rows are read once. They are combined where they are by (fingerprint, split) and meet by fingerprint alone in the one shuffle,
    as counts; what follows sums numbers. Rows whose split is none of splits, or null, are counted as no input; a null fingerprint
    is a record like any other that equals nothing."""
    code = messages_code(messages)
    length = F.lit(0).cast("long") if tokens is None else tokens.cast("long")
    rows = df.select(split.alias("s"), fingerprint.alias("fp"), code.alias("code"), length.alias("t")).filter(F.col("s").isin(*splits))
    problems = ("DATASET_SCHEMA_UNKNOWN", "DATASET_ROLE_INVALID", "DATASET_TARGET_EMPTY")

    def each(name: str, at: str) -> list[Column]:
        mine = F.col("s") == name
        return [
            F.count_if(mine).alias(f"n_{at}"), F.coalesce(F.sum(F.when(mine, F.col("t"))), F.lit(0)).alias(f"t_{at}"), F.max(F.when(mine, F.col("t"))).alias(f"l_{at}"), F.count_if(mine & (F.col("t") > ceiling)).alias(f"o_{at}"),
            *(F.count_if(mine & (F.col("code") == p)).alias(f"p{i}_{at}") for i, p in enumerate(problems)),
        ]

    at = {name: str(i) for i, name in enumerate(splits)}
    by = rows.groupBy("fp").agg(*(c for name, i in at.items() for c in each(name, i)))
    pairs = [(a, b) for i, a in enumerate(splits) for b in splits[i + 1 :]]
    known = F.col("fp").isNotNull()
    total = by.agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for i in at.values() for c in (f"n_{i}", f"t_{i}", f"o_{i}", *(f"p{k}_{i}" for k in range(len(problems))))),
        *(F.coalesce(F.max(f"l_{i}"), F.lit(0)).alias(f"l_{i}") for i in at.values()),
        *(F.coalesce(F.sum(F.when(known & (F.col(f"n_{i}") > 0), F.col(f"n_{i}") - 1)), F.lit(0)).alias(f"d_{i}") for i in at.values()),
        *(F.count_if(known & (F.col(f"n_{at[a]}") > 0) & (F.col(f"n_{at[b]}") > 0)).alias(f"x_{at[a]}_{at[b]}") for a, b in pairs),
    )
    n = lambda kind, name: F.col(f"{kind}_{at[name]}")

    def finding(when: Column, code: str, split: str, count: Column, other: str | None = None) -> Column:
        return F.when(when, F.struct(F.lit(code).alias("code"), F.lit(split).alias("split"), F.lit(other).cast("string").alias("other"), count.cast("long").alias("n")))

    rejecting = [finding(n("n", "train") == 0, "DATASET_SPLIT_MISSING", "train", F.lit(0)), finding((n("n", "train") > 0) & (n("n", "train") < LEAST_TRAIN), "DATASET_TOO_FEW_EXAMPLES", "train", n("n", "train"))]
    rejecting += [finding(n(f"p{k}", s) > 0, p, s, n(f"p{k}", s)) for s in splits for k, p in enumerate(problems)]
    rejecting += [finding(F.col(f"x_{at[a]}_{at[b]}") > 0, "DATASET_SPLIT_LEAKAGE", a, F.col(f"x_{at[a]}_{at[b]}"), b) for a, b in pairs]
    if tokens is not None:
        rejecting += [finding(n("o", s) > 0, "DATASET_SEQUENCE_TOO_LONG", s, n("o", s)) for s in splits]
        rejecting += [finding(n("t", "train") > budget, "DATASET_TOKEN_BUDGET_EXCEEDED", "train", n("t", "train"))]
    remarks = [finding(n("d", s) > 0, "DUPLICATES", s, n("d", s)) for s in splits]
    inputs = [
        F.when(n("n", s) > 0, F.struct(F.lit(s).alias("split"), n("n", s).cast("long").alias("records"), n("d", s).cast("long").alias("duplicates"), (n("p0", s) + n("p1", s) + n("p2", s)).cast("long").alias("invalid"), n("t", s).cast("long").alias("total_tokens"), n("l", s).cast("long").alias("longest"), n("o", s).cast("long").alias("too_long")))
        for s in splits
    ]
    wrong = F.array_compact(F.array(*rejecting))
    out = total.select(F.array_compact(F.array(*inputs)).alias("inputs"), wrong.alias("_wrong"), F.array_compact(F.array(*remarks)).alias("_remarks"))
    first = F.get("_wrong", F.lit(0))["code"]
    return out.select(F.when(F.size("_wrong") > 0, "rejected").otherwise("accepted").alias("verdict"), first.alias("code"), "inputs", F.concat("_wrong", "_remarks").alias("findings"))
