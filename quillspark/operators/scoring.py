"""Scores of multiple-choice responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import answer_label


def predictions(df: DataFrame, reference: str, response: str, labels: Sequence[str]) -> DataFrame:
    """df with prediction and hit (1 where it equals the reference)."""
    return df.withColumn("prediction", answer_label(F.col(response), labels)).withColumn("hit", (F.col("prediction") == F.col(reference)).cast("int"))


def choice_metrics(scored: DataFrame, reference: str) -> DataFrame:
    """One row of metrics in percent: accuracy (balanced: mean recall of the reference labels), macro_f1 over labels of
    either side, null_weighted_f1 over reference labels, normalized_accuracy, null_count.

    Rows are counted by (reference, prediction) once; everything else works on those few counts."""
    pairs = scored.groupBy(F.col(reference).alias("r"), F.col("prediction").alias("p")).agg(F.count("*").alias("n"))
    sides = pairs.select(F.explode(F.array(F.struct(F.col("r").alias("label"), F.col("n").alias("ref"), F.lit(0).cast("long").alias("pred"), F.when(F.col("r") == F.col("p"), F.col("n")).otherwise(0).alias("tp")), F.struct(F.col("p").alias("label"), F.lit(0).cast("long").alias("ref"), F.col("n").alias("pred"), F.lit(0).cast("long").alias("tp")))).alias("x")).select("x.*")
    by = sides.groupBy("label").agg(F.sum("ref").alias("ref"), F.sum("pred").alias("pred"), F.sum("tp").alias("tp"))
    by = by.withColumn("f1", 2 * F.col("tp") / (F.col("ref") + F.col("pred")))
    m = by.agg(F.avg(F.when(F.col("ref") > 0, F.col("tp") / F.col("ref"))).alias("a"), F.avg("f1").alias("f"), F.avg(F.when(F.col("ref") > 0, F.col("f1"))).alias("rf"), F.count_if(F.col("ref") > 0).alias("k"), F.coalesce(F.sum(F.when(F.col("label") == "null", F.col("pred"))), F.lit(0)).alias("nulls"), F.sum("ref").alias("n"))
    base = 1 / F.col("k")
    normal = F.when(F.col("k") == 1, 0.0).otherwise(F.greatest((F.col("a") - base) / (1 - base), F.lit(0.0)))
    return m.select((100 * F.col("a")).alias("accuracy"), (100 * F.col("f")).alias("macro_f1"), (100 * F.col("rf") * (1 - F.col("nulls") / F.col("n"))).alias("null_weighted_f1"), (100 * normal).alias("normalized_accuracy"), F.col("nulls").cast("long").alias("null_count"))
