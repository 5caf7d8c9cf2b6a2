"""Source rows as canonical messages or evaluation records, and nested reports as findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..codes import Refused
from ..functions.text import is_blank, strip
from .jsonl import message_list


def _pair(user: Column, assistant: Column) -> Column:
    return F.array(F.struct(F.lit("user").alias("role"), user.alias("content")), F.struct(F.lit("assistant").alias("role"), assistant.alias("content")))


def instruction_rows(df: DataFrame) -> DataFrame:
    """instruction, context (may be null), response: a context is appended after a blank line and the whole stripped."""
    has = ~is_blank(F.col("context"))
    user = F.when(has, strip(F.concat("instruction", F.lit("\n\n"), "context"))).otherwise(F.col("instruction"))
    return df.withColumn("messages", _pair(user, F.col("response"))).withColumn("valid", ~is_blank(F.col("instruction")) & ~is_blank(F.col("response")))


def input_target_rows(df: DataFrame) -> DataFrame:
    return df.withColumn("messages", _pair(F.col("inputs"), F.col("targets"))).withColumn("valid", ~is_blank(F.col("inputs")) & ~is_blank(F.col("targets")))


def conversation_rows(df: DataFrame) -> DataFrame:
    """conversations_id and conversations, a JSON list of messages; a string in another notation, with text after the list, or
    with other than text in it, is not valid."""
    valid = ~is_blank(F.col("conversations_id").cast("string")) & F.col("messages").isNotNull()
    return df.withColumn("messages", message_list(F.col("conversations"))).withColumn("valid", F.coalesce(valid, F.lit(False)))


def evaluation_rows(df: DataFrame) -> DataFrame:
    """id, label, prompts (question, mcq_options, mcq) and metadata (language, category, topic); the last two may be empty."""
    text = lambda c: ~is_blank(c)
    prompts = F.coalesce((F.size("prompts") > 0) & F.forall("prompts", lambda p: text(p["question"]) & text(p["mcq_options"]) & text(p["mcq"])), F.lit(False))
    return df.withColumn("valid", text(F.col("id")) & text(F.col("label")) & prompts & text(F.col("metadata.language")) & F.col("metadata.category").isNotNull() & F.col("metadata.topic").isNotNull())


ADAPTERS = {"instruction": instruction_rows, "input_target": input_target_rows, "conversation": conversation_rows, "evaluation": evaluation_rows}


def adapt(kind: str, df: DataFrame) -> DataFrame:
    """df by the adapter of its kind; refuses unknown kinds. Rows that aren't valid stay, with valid false."""
    if kind not in ADAPTERS:
        raise Refused("DATASET_SCHEMA_UNKNOWN", f"no adapter for {kind!r}")
    return ADAPTERS[kind](df)


def dependency_findings(reports: DataFrame) -> DataFrame:
    """Findings of dependency scans, reports (report, JSON text); a report without dependencies is an error, not clean."""
    kind = "struct<dependencies:array<struct<name:string,version:string,vulns:array<struct<id:string,aliases:array<string>,fix_versions:array<string>>>>>>"
    got = reports.select(F.from_json("report", kind).alias("r")).select(F.when(F.col("r.dependencies").isNull(), F.raise_error(F.lit("the report has no dependencies"))).otherwise(F.col("r.dependencies")).alias("d"))
    each = got.select(F.explode("d").alias("d")).select("d.name", "d.version", F.explode("d.vulns").alias("v"))
    return each.select(F.lit("pip-audit").alias("source"), F.col("name").alias("package"), F.col("version").alias("installed"), F.col("v.id").alias("identifier"), F.lit(None).cast("string").alias("severity"), F.array_join("v.fix_versions", ", ").alias("fix"))


def image_findings(reports: DataFrame) -> DataFrame:
    """Findings of image scans; a report without a schema version is an error, one with null results has none."""
    kind = "struct<SchemaVersion:int,Results:array<struct<Vulnerabilities:array<struct<VulnerabilityID:string,PkgName:string,InstalledVersion:string,Severity:string,FixedVersion:string>>>>>"
    got = reports.select(F.from_json("report", kind).alias("r")).select(F.when(F.col("r.SchemaVersion").isNull(), F.raise_error(F.lit("the report has no schema version"))).otherwise(F.col("r.Results")).alias("d"))
    each = got.select(F.explode("d").alias("d")).select(F.explode("d.Vulnerabilities").alias("v"))
    return each.select(F.lit("trivy").alias("source"), F.col("v.PkgName").alias("package"), F.col("v.InstalledVersion").alias("installed"), F.col("v.VulnerabilityID").alias("identifier"), F.col("v.Severity").alias("severity"), F.coalesce("v.FixedVersion", F.lit("")).alias("fix"))
