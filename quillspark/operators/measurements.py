"""Measurements of runs: fits over data shapes, memory that bounds admit, required memory by model, reports of metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .integrity import line_fit

#: Metrics of a report, and those of the model before training (fixed values).
METRICS = ["trainLoss", "validationLoss", "testLoss", "validationPerplexity"]
BASELINES = ["baseValidationLoss", "baseValidationPerplexity"]


def shape_fit(points: DataFrame, *by: str) -> DataFrame:
    """points (file_bytes, examples, ingest_bytes), one a data shape: the line of memory an example over bytes an example, as
    per_byte and fixed, for each group of by. Null for fewer than two shapes or shapes of one size; no examples, no point."""
    n = F.nullif(F.col("examples"), F.lit(0))
    slope, intercept = line_fit(F.col("file_bytes") / n, F.col("ingest_bytes") / n)
    return points.groupBy(*by).agg(slope.alias("per_byte"), intercept.alias("fixed"))


def worst_case(per_byte: Column, fixed: Column, max_bytes: int, max_examples: int) -> Column:
    """Memory that a bound on bytes and one on examples admit together, by a fitted line."""
    return per_byte * max_bytes + fixed * max_examples


def required_memory(records: DataFrame) -> DataFrame:
    """model_key and the most memory that any method's good run asks for; records (model_key, status, required) of failed runs,
    or without a figure, are not measured and count nothing."""
    return records.filter((F.col("status") == "ok") & (F.coalesce(F.col("required"), F.lit(0)) != 0)).groupBy("model_key").agg(F.max("required").alias("required"))


def measured_models(methods: DataFrame) -> DataFrame:
    """model_key and measured: whether a model (model_key, method, required) has methods and a figure for each."""
    there = methods.filter("method is not null").groupBy("model_key").agg(F.bool_and(F.col("required").isNotNull()).alias("_all"))
    return methods.select("model_key").distinct().join(there, "model_key", "left").select("model_key", F.coalesce("_all", F.lit(False)).alias("measured"))


def report(runs: DataFrame, key: str) -> DataFrame:
    """One row for each metric that a run (key and the metrics' columns) has: key, kind, id, value, units, verdict.

    Without a validation loss a run's metrics say nothing, only those of the model before training are listed; a run with
    nothing to list has one row without an id."""
    measured = F.col("validationLoss").isNotNull()
    entry = lambda kind, name, there: F.when(there & F.col(name).isNotNull(), F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("id"), F.col(name).cast("double").alias("value"), F.lit("nats per supervised token" if name.endswith("Loss") else "tokens").alias("units")))
    entries = F.array_compact(F.array(*(entry("metric", m, measured) for m in METRICS), *(entry("baseline", b, F.lit(True)) for b in BASELINES)))
    verdict = F.when(measured, "sample-sanity").otherwise("not-measurable")
    return runs.select(key, verdict.alias("verdict"), F.explode_outer(entries).alias("e")).select(key, "e.kind", "e.id", "e.value", "e.units", "verdict")
