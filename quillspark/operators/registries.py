"""Registry documents, JSON texts as rows, as entries with their defaults.

A document is an object with schema_version (1.0 where it has none) and its entries by key. Any number of documents is read
as rows. Defined results: a null or unreadable document, one that repeats a key, and one without entries give no rows (see
documents.schema_problems for what is wrong with it); an entry that is no object has every default; a field that is not there
has its default; one that is there as null, or of a type that does not convert, is null, an empty array, or false, never a default that would enable an
entry; booleans follow truth: zero, false, null, "" and an empty list or object are false, all else is true. Other columns of the
documents stay, but for those that bear a field's name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .documents import others

#: Fields with their kind and default.
MODEL_FIELDS = [
    ("model_id", "string", None), ("revision", "string", None), ("provider", "string", ""), ("license", "string", ""),
    ("architecture", "string", "causal_lm"), ("backend", "string", "generic_causal_lm"), ("requires_trust_remote_code", "boolean", False),
    ("training_methods", "array", None), ("max_sequence_length", "long", None), ("chat_template", "string", "tokenizer"),
    ("serving_profile", "string", "peft_adapter"), ("approval_state", "string", "experimental"), ("enabled", "boolean", False),
    ("internal_only", "boolean", False),
]
SOURCE_FIELDS = [
    ("source_id", "string", None), ("revision", "string", ""), ("config", "string", None), ("split", "string", None), ("license", "string", ""),
    ("gated", "boolean", False), ("redistribution", "string", "unclear"), ("intended_use", "array", None), ("languages", "array", None),
    ("canonical_schema", "string", "messages"), ("conversion_version", "long", 0), ("approval_state", "string", "experimental"),
    ("enabled", "boolean", True), ("overlaps_with", "array", None), ("tier", "long", None), ("pipeline_usage", "string", "training"),
    ("language_field", "string", None), ("language_prefix_source", "string", None), ("prompt_field", "string", "inputs"),
]
PROFILE_FIELDS = [("count", "long", None), ("selection", "string", "stable_hash"), ("exclude_languages", "array", None), ("expected_removals", "long", None)]


def _field(spec: Column, name: str, kind: str, default) -> Column:
    path = f"$['{name}']"
    given = F.try_variant_get(spec, path, "variant")
    if kind == "array":
        return F.coalesce(F.try_variant_get(spec, path, "array<string>"), F.array().cast("array<string>"))
    if kind == "boolean":
        return F.when(given.isNull(), F.lit(default)).otherwise(~F.to_json(given).isin("null", "false", "0", "0.0", '""', "[]", "{}"))
    return F.when(given.isNull(), F.lit(default).cast(kind)).otherwise(F.try_variant_get(spec, path, kind))


def _entries(documents: DataFrame, column: str, field: str, key: str, names: list[str]) -> DataFrame:
    """One row per entry: the documents' other columns, schema_version, key and _spec, a VARIANT."""
    doc = F.try_parse_json(F.col(column))
    version = _field(doc, "schema_version", "string", "1.0").alias("schema_version")
    taken = {n.lower() for n in ["schema_version", "_spec", key, *names]}
    rest = documents.drop(*(c for c in documents.columns if c.lower() in taken and c != column))
    return rest.select(*others(rest, column), version, F.explode(F.try_variant_get(doc, f"$['{field}']", "map<string,variant>")).alias(key, "_spec"))


def models(documents: DataFrame, column: str) -> DataFrame:
    """Model entries: model_key, MODEL_FIELDS, and methods, a map from method to min_vram_gb, measured_on and the load that it
    was measured at."""
    rows = _entries(documents, column, "models", "model_key", [f[0] for f in MODEL_FIELDS] + ["lora_target_modules", "methods"])
    spec = F.col("_spec")
    at = lambda v, name: F.try_variant_get(v, f"$['measured_at']['{name}']", "long").alias(name)
    profile = lambda _, v: F.struct(F.try_variant_get(v, "$['min_vram_gb']", "double").alias("min_vram_gb"), F.try_variant_get(v, "$['measured_on']", "string").alias("measured_on"), at(v, "max_sequence_length"), at(v, "per_device_batch_size"))
    methods = F.transform_values(F.try_variant_get(spec, "$['resource_profile']", "map<string,variant>"), profile)
    targets = F.coalesce(F.try_variant_get(spec, "$['lora_target_modules']", "array<string>"), F.array(_field(spec, "lora_target_modules", "string", "auto")))
    return rows.select("*", *(_field(spec, *f).alias(f[0]) for f in MODEL_FIELDS), targets.alias("lora_target_modules"), methods.alias("methods")).drop("_spec")


def sources(documents: DataFrame, column: str) -> DataFrame:
    """Source entries: id, SOURCE_FIELDS, and profiles, a map from a profile's name to PROFILE_FIELDS."""
    rows = _entries(documents, column, "sources", "id", [f[0] for f in SOURCE_FIELDS] + ["profiles"])
    spec = F.col("_spec")
    profile = lambda _, v: F.struct(*(_field(v, *f).alias(f[0]) for f in PROFILE_FIELDS))
    profiles = F.transform_values(F.try_variant_get(spec, "$['profiles']", "map<string,variant>"), profile)
    return rows.select("*", *(_field(spec, *f).alias(f[0]) for f in SOURCE_FIELDS), profiles.alias("profiles")).drop("_spec")


def measured(entries: DataFrame) -> DataFrame:
    """One row per model and method with a figure: the entry's key, method and its measurement."""
    found = entries.select("model_key", F.explode("methods").alias("method", "_m")).filter("_m.min_vram_gb IS NOT NULL")
    return found.select("model_key", "method", "_m.*")
