"""Rules and keyed lookups: vulnerability decisions, model registry, licenses, resources."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import strip

#: Licenses with obligations (fixed values).
OBLIGATIONS = {"llama3.2": ["preserve_llama_attribution", "include_applicable_license_notice"]}
SENTINEL = "lm-sft-"


def is_blocking(rules: dict) -> Column:
    """Whether a finding (source, severity, fix) blocks under rules {'dependencies': ..., 'images': ...}."""
    dep, img = rules["dependencies"], rules["images"]
    fixed = F.coalesce(F.col("fix"), F.lit("")) != ""
    image = F.col("severity").isin(list(img.get("block_severities") or [])) & (fixed | F.lit(not img.get("require_fix_available", True)))
    library = F.when(fixed, F.lit(bool(dep.get("block_when_fix_available", True)))).otherwise(F.lit(bool(dep.get("block_when_no_fix", False))))
    return F.when(F.col("source") == "pip-audit", library).otherwise(F.coalesce(image, F.lit(False)))


def decide(findings: DataFrame, exceptions: DataFrame, rules: dict, scope: str, today: date) -> DataFrame:
    """findings (finding_id, source, package, installed, identifier, severity, fix) with decision and entry.

    exceptions (entry, match, id, aliases, source, package, installed, scope, expires): the first entry that fits decides.
    Entries match by id or alias, or by package; both are equi-joins, the matches are few per finding."""
    valid = exceptions.filter(F.array_contains("scope", scope))
    ids = valid.filter("coalesce(match, 'id') <> 'package'").select("entry", "expires", F.explode(F.array_distinct(F.concat(F.array("id"), F.coalesce("aliases", F.array().cast("array<string>"))))).alias("identifier"))
    packages = valid.filter("match = 'package'").select("entry", "expires", "source", "package", "installed")
    hit = findings.join(ids, "identifier").select("finding_id", "entry", "expires").unionByName(findings.join(packages, ["source", "package", "installed"]).select("finding_id", "entry", "expires"))
    first = hit.groupBy("finding_id").agg(F.min(F.struct("entry", "expires")).alias("_e"))
    blocking = F.coalesce(is_blocking(rules), F.lit(False))
    decision = F.when(~blocking, "reported").when(F.col("_e").isNull(), "blocking").when(F.to_date("_e.expires") < F.lit(today), "expired").otherwise("excepted")
    return findings.join(first, "finding_id", "left").withColumn("decision", decision).withColumn("entry", F.when(blocking, F.col("_e.entry"))).drop("_e")


def unique(registry: DataFrame, key: str) -> DataFrame:
    """A registry whose keys must stand once each: a repeated or null key ends with CONFIG_SCHEMA_INVALID when it is met."""
    bad = (F.count("*").over(Window.partitionBy(key)) > 1) | F.col(key).isNull()
    return registry.withColumn(key, F.when(bad, F.raise_error(F.concat(F.lit("CONFIG_SCHEMA_INVALID: repeated or null key "), F.coalesce(F.col(key), F.lit("null"))))).otherwise(F.col(key)))


def resolve_models(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """requests (request_id, model_key) with code: null where the registry (model_key, enabled, remote_code, revision) allows it.
    A registry with a repeated key is refused."""
    found = requests.join(unique(registry, "model_key").withColumn("_known", F.lit(True)), "model_key", "left")
    code = (
        F.when(F.coalesce(F.trim("model_key"), F.lit("")) == "", "MODEL_KEY_MISSING").when(F.col("_known").isNull(), "MODEL_NOT_APPROVED").when(~F.col("enabled"), "MODEL_DISABLED")
        .when(F.col("remote_code"), "MODEL_REMOTE_CODE_BLOCKED").when(~F.coalesce(F.col("revision").rlike("^[0-9a-f]{40}$"), F.lit(False)), "MODEL_REVISION_UNPINNED")
    )
    return found.withColumn("code", code).drop("_known")


def obligations(license_: Column) -> Column:
    """Obligations of a license; none for those without an entry."""
    table = F.create_map(*(x for k, v in OBLIGATIONS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    return F.coalesce(F.try_element_at(table, F.lower(F.trim(license_))), F.array().cast("array<string>"))


def is_sentinel(name: Column) -> Column:
    return F.lower(F.trim(name)).startswith(SENTINEL)


def base_model_code(requested: Column, registered: Column) -> Column:
    """Null where a requested base model is empty, a tier's sentinel, or the registered one."""
    fine = (F.coalesce(F.trim(requested), F.lit("")) == "") | is_sentinel(requested) | (F.trim(requested) == registered)
    return F.when(~fine, "MODEL_BASE_MODEL_CONFLICT")


def _given(channels: list[Column]) -> Column:
    return F.array_distinct(F.filter(F.transform(F.array(*channels), lambda c: strip(c)), lambda c: F.coalesce(c, F.lit("")) != ""))


def agreed(channels: list[Column]) -> Column:
    """The value, trimmed, that non-empty channels agree on; null where they differ or all are empty."""
    given = _given(channels)
    return F.when(F.size(given) == 1, F.get(given, F.lit(0)))


def agreement_code(channels: list[Column]) -> Column:
    """A code where non-empty channels name different values; null where they agree or none is given."""
    return F.when(F.size(_given(channels)) > 1, "CONFIG_SCHEMA_INVALID")


def license_notice(license_: Column, model_id: Column) -> Column:
    """A model card's lines on the obligations of its base model's license; empty without any."""
    duties = obligations(license_)
    line = F.concat(F.lit("Base model "), model_id, F.lit(", license "), F.lower(F.trim(license_)), F.lit(": "), F.array_join(F.transform(duties, lambda d: F.replace(d, F.lit("_"), F.lit(" "))), ", "), F.lit("."))
    return F.when(F.size(duties) > 0, line).otherwise("")


def sequence_code(requested: Column, ceiling: Column) -> Column:
    """A sequence length above its ceiling is refused, never lowered."""
    return F.when((requested > ceiling) | (requested < 1), "CONFIG_OUT_OF_BOUNDS")


def measured_load_applies(sequence: Column, batch: Column, measured: Column) -> Column:
    """A measurement bounds runs of at least its load; without one it bounds all."""
    return measured.isNull() | (sequence * batch >= measured)


def default_method(measured_methods: Column) -> Column:
    return F.when(F.array_contains(measured_methods, "lora"), "lora").otherwise("qlora")


def device(value: Column) -> Column:
    return F.when(F.coalesce(F.trim(value), F.lit("")) == "", "cuda:0").when(F.trim(value).rlike("^[0-9]+$"), F.concat(F.lit("cuda:"), F.trim(value))).otherwise(F.trim(value))


def may_commit_rows(redistribution: Column, gated: Column) -> Column:
    return redistribution.isin("yes", "share_alike") & ~gated


def source_gate(requests: DataFrame, sources: DataFrame, evaluation: bool = False) -> DataFrame:
    """requests (source_id, ...) with the first gate that their source fails, or ok: unknown, disabled, evaluation only, unpinned.
    For evaluation the third is "not evaluation only" instead: a source is of use for one of the two alone.

    sources: source_id, enabled, intended_use (array), revision, and whatever else a registry holds; a repeated source_id is
    refused."""
    s = unique(sources, "source_id").select("source_id", F.lit(True).alias("_there"), "enabled", "intended_use", "revision")
    held_out = F.array_contains(F.coalesce("intended_use", F.array()), "evaluation_only")
    gate = (
        F.when(F.col("_there").isNull(), "unknown").when(~F.coalesce("enabled", F.lit(False)), "disabled")
        .when(~held_out if evaluation else held_out, "not evaluation only" if evaluation else "evaluation only")
        .when(~F.coalesce(F.col("revision").rlike("^[0-9a-f]{40}$"), F.lit(False)), "unpinned").otherwise("ok")
    )
    return requests.join(s, "source_id", "left").withColumn("gate", gate).drop("_there", "enabled", "intended_use", "revision")


def overlap_partners(sources: DataFrame) -> DataFrame:
    """source_id and partner of sources (source_id, overlaps_with) that share rows: declared by either, each pair both ways."""
    one = sources.select("source_id", F.explode("overlaps_with").alias("partner")).filter("partner <> source_id")
    return one.unionByName(one.select(F.col("partner").alias("source_id"), F.col("source_id").alias("partner"))).distinct()


def supports(methods: Column, method: Column) -> Column:
    """Whether a model's methods have one; a model without methods has none."""
    return F.coalesce(F.array_contains(methods, method), F.lit(False))


def first_given(*names: Column) -> Column:
    """The first of several texts that isn't empty."""
    return F.coalesce(*(F.nullif(n, F.lit("")) for n in names))


def same_version(a: Column, b: Column) -> Column:
    """Whether two versions agree but for a local part after a plus sign."""
    public = lambda v: F.split_part(v, F.lit("+"), F.lit(1))
    return F.coalesce(public(a) == public(b), F.lit(False))


def missing_names(required: DataFrame, present: DataFrame, name: str) -> DataFrame:
    """Names that are required and not there; none means that the required ones are a subset."""
    return required.select(name).distinct().join(present.select(name).distinct(), name, "left_anti")
