"""Registration rows of models, the checks on them, and the file patterns of a model's snapshot."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .policy import default_method

#: Longest sequence that is registered.
LONGEST = 2048


def registration(models: DataFrame, task: str, framework: str, data_format: str) -> DataFrame:
    """One row for each enabled model that users may see, of models (model_key, model_id, revision, provider, max_sequence,
    enabled, internal, methods: array of (method, required))."""
    measured = F.transform(F.filter("methods", lambda m: F.coalesce(m["required"], F.lit(0)) > 0), lambda m: m["method"])
    names = F.transform("methods", lambda m: m["method"])
    method = F.when(F.array_contains(names, "qlora") | F.array_contains(measured, "lora"), default_method(F.array_intersect(measured, names))).otherwise(F.get(names, F.lit(0)))
    memory = F.get(F.filter("methods", lambda m: m["method"] == F.col("_method")), F.lit(0))["required"]
    return (
        models.filter("enabled and not internal").withColumn("_method", method)
        .select(
            F.col("model_key").alias("id"), F.element_at(F.split("model_id", "/"), -1).alias("display_name"), F.lit(task).alias("task_type"), F.lit(framework).alias("framework"), "provider",
            F.concat_ws("@", "model_id", "revision").alias("base_weights"),
            F.struct(F.col("_method").alias("method"), F.least(F.lit(LONGEST), F.coalesce(F.nullif("max_sequence", F.lit(0)), F.lit(LONGEST))).alias("max_sequence_length")).alias("defaults"),
            F.struct(F.lit("nvidia").alias("accelerator"), F.lit(1).alias("gpu_count"), memory.alias("min_vram_gb")).alias("resources"), F.lit(data_format).alias("data_format"),
        )
    )


def registration_problems(block: DataFrame, approved: DataFrame, default_id: str) -> DataFrame:
    """id and problem of a registration block against the approved keys (model_key): one row for each id and rule that is broken.

    An empty id is its own problem and nothing else is asked of its row; weights that several rows share are a problem of
    each; an approved key without a row, and a default that isn't registered, come out under their own ids."""
    empty = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    rows = block.select(F.trim(F.coalesce("id", F.lit(""))).alias("id"), F.trim(F.coalesce("base_weights", F.lit(""))).alias("w"), *(empty(F.col(c)).alias(f"no_{c}") for c in ("framework", "provider", "data_format")), F.col("defaults").isNull().alias("no_defaults"))
    said = rows.filter("id <> ''")
    known = approved.select(F.trim("model_key").alias("id"), F.lit(True).alias("known")).distinct()
    fields = F.array(F.when(F.col("w") == "", "no base_weights"), *(F.when(F.col(f"no_{c}"), f"no {c}") for c in ("framework", "provider", "data_format", "defaults")))
    own = said.select("id", F.explode(F.array_compact(fields)).alias("problem"))
    twice = said.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id", F.lit("id twice").alias("problem"))
    shared = said.filter("w <> ''").groupBy("w").agg(F.count("*").alias("n")).filter("n > 1").join(said, "w").select("id", F.lit("base_weights twice").alias("problem"))
    unknown = said.join(known, "id", "left_anti").select("id", F.lit("not approved").alias("problem"))
    absent = known.join(said, "id", "left_anti").select("id", F.lit("not registered").alias("problem"))
    default = said.agg(F.count_if(F.col("id") == default_id).alias("n")).filter("n = 0").select(F.lit(default_id).alias("id"), F.lit("default not registered").alias("problem"))
    nameless = rows.filter("id = ''").select("id", F.lit("no id").alias("problem"))
    parts = [own, twice, shared, unknown, absent, default, nameless]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.distinct()


def _regex(pattern: str) -> str:
    """A file pattern with *, ? and [sets] as a regular expression for the whole name."""
    out, i = [], 0
    while i < len(pattern):
        c = pattern[i]
        end = pattern.find("]", i + 2) if c == "[" else -1
        if end > 0:
            inner = pattern[i + 1 : end]
            negated = inner[0] == "!"
            out.append("[" + "^" * negated + re.sub(r"([\\\[\]^&])", r"\\\1", inner[negated:]) + "]")
            i = end
        else:
            out.append({"*": ".*", "?": "."}.get(c) or re.escape(c))
        i += 1
    return "(?s)^" + "".join(out) + r"\z"


def wanted(path: Column, allow: Sequence[str], ignore: Sequence[str]) -> Column:
    """Whether a path, or its last part, matches one of allow and neither matches one of ignore."""
    name = F.element_at(F.split(path, "/"), -1)

    def any_of(patterns: Sequence[str]) -> Column:
        found = F.lit(False)
        for p in patterns:
            found |= path.rlike(_regex(p)) | name.rlike(_regex(p))
        return found

    return any_of(allow) & ~any_of(ignore)
