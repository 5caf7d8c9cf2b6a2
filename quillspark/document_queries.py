"""Registered queries over JSON documents: rules of a schema document, and registry entries with their defaults."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import documents, policy, registries
from .queries import _table, query

_COUNT = {"type": "integer", "minimum": 1}
#: The fields of a training job and their bounds.
JOB = {
    "type": "object",
    "properties": {
        "schemaVersion": {"type": "string", "pattern": r"^[0-9]+\.[0-9]+$"},
        "model": {
            "type": "object",
            "properties": {"key": {"$ref": "#/$defs/name"}, "modelId": {"$ref": "#/$defs/name"}, "revision": {"type": "string", "pattern": "^[0-9a-f]{40}$"}, "backend": {"$ref": "#/$defs/name"}},
            "required": ["key", "modelId", "revision", "backend"],
            "additionalProperties": False,
        },
        "training": {
            "type": "object",
            "properties": {
                "method": {"type": "string", "enum": ["lora", "qlora"]}, "epochs": _COUNT, "learningRate": {"type": "number", "exclusiveMinimum": 0}, "loraDropout": {"type": "number", "minimum": 0, "maximum": 1},
                "lrSchedulerType": {"type": "string", "enum": ["constant", "linear", "cosine"]}, "warmupRatio": {"type": "number", "minimum": 0, "exclusiveMaximum": 1}, "warmupSteps": {"type": "integer", "minimum": 0},
                "earlyStopping": {"type": "object", "properties": {"patience": _COUNT, "minDelta": {"type": "number", "minimum": 0}}, "required": ["patience", "minDelta"], "additionalProperties": False},
            },
            "required": ["method", "epochs", "learningRate", "loraDropout"],
            "dependentRequired": {"warmupRatio": ["lrSchedulerType"], "warmupSteps": ["lrSchedulerType"]},
            "not": {"required": ["warmupRatio", "warmupSteps"]},
            "additionalProperties": False,
        },
        "checks": {"type": "array", "minItems": 1, "items": {"type": "object", "properties": {"name": {"$ref": "#/$defs/name"}, "successful": {"type": "boolean"}}, "required": ["name", "successful"]}},
        "device": {"type": "string", "minLength": 1},
    },
    "required": ["schemaVersion", "model", "training", "device"],
    "additionalProperties": False,
    "$defs": {"name": {"type": "string", "minLength": 1}},
}

#: An order as a job document, in words that both engines read; each part is at fault for some keys.
_JOBS = """CASE WHEN o_orderkey % 23 = 0 THEN '{"schemaVersion": ' ELSE '{"schemaVersion": "' || CASE WHEN o_orderkey % 11 = 0 THEN 'v1' ELSE '1.0' END
|| '", "model": {"key": "' || CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE 'm' || o_custkey END || '", "modelId": "org/m", "revision": "' || CASE WHEN o_orderkey % 7 = 0 THEN 'main' ELSE repeat('a1', 20) END
|| '"' || CASE WHEN o_orderkey % 17 = 0 THEN ', "more": 1' ELSE ', "backend": "b"' END || '}, "training": {"method": "' || CASE WHEN o_orderkey % 6 = 0 THEN 'full' ELSE 'lora' END
|| '", "epochs": ' || CASE WHEN o_orderkey % 5 = 0 THEN '0' WHEN o_orderkey % 5 = 1 THEN '2.0' WHEN o_orderkey % 5 = 2 THEN '1.5' WHEN o_orderkey % 10 = 3 THEN '"3"' ELSE '7' END
|| ', "learningRate": ' || CASE WHEN o_orderkey % 9 = 0 THEN '0' ELSE '1e-4' END || CASE WHEN o_orderkey % 8 = 0 THEN '' ELSE ', "loraDropout": 0.' || o_orderkey % 10 END
|| CASE WHEN o_orderkey % 4 = 0 THEN ', "warmupRatio": 0.1' ELSE '' END || CASE WHEN o_orderkey % 3 = 0 THEN ', "warmupSteps": 5' ELSE '' END || CASE WHEN o_orderkey % 2 = 0 THEN ', "lrSchedulerType": "linear"' ELSE '' END
|| ', "earlyStopping": {"patience": ' || o_orderkey % 3 || ', "minDelta": 0}}, "checks": [' || CASE WHEN o_orderkey % 14 = 0 THEN '' ELSE '{"name": "a", "successful": true}, {"name": "", "successful": ' || CASE WHEN o_orderkey % 15 = 0 THEN 'null' ELSE 'false' END || '}' END
|| ']' || CASE WHEN o_orderkey % 19 = 0 THEN '' ELSE ', "device": "' || o_orderstatus || '"' END || '}' END"""


def _rule(path: str, rule: str, broken: str) -> str:
    return f"SELECT o_orderkey, '{path}' AS path, '{rule}' AS rule FROM j WHERE {broken}"


_JOB_RULES = [
    _rule("(root)", "json", "NOT ok"),
    _rule("schemaVersion", "pattern", "NOT regexp_full_match(d->>'$.schemaVersion', '[0-9]+[.][0-9]+')"),
    _rule("model/key", "minLength", "length(d->>'$.model.key') = 0"),
    _rule("model/revision", "pattern", "NOT regexp_full_match(d->>'$.model.revision', '[0-9a-f]{40}')"),
    _rule("model", "required backend", "ok AND NOT json_exists(d, '$.model.backend')"),
    _rule("model", "additionalProperties more", "json_exists(d, '$.model.more')"),
    _rule("training/method", "enum", "d->>'$.training.method' NOT IN ('lora', 'qlora')"),
    _rule("training/epochs", "type", "json_type(d, '$.training.epochs') = 'VARCHAR' OR TRY_CAST(d->>'$.training.epochs' AS DOUBLE) <> floor(TRY_CAST(d->>'$.training.epochs' AS DOUBLE))"),
    _rule("training/epochs", "minimum", "json_type(d, '$.training.epochs') <> 'VARCHAR' AND TRY_CAST(d->>'$.training.epochs' AS DOUBLE) < 1"),
    _rule("training/learningRate", "exclusiveMinimum", "TRY_CAST(d->>'$.training.learningRate' AS DOUBLE) <= 0"),
    _rule("training", "required loraDropout", "ok AND NOT json_exists(d, '$.training.loraDropout')"),
    _rule("training", "dependentRequired lrSchedulerType", "(json_exists(d, '$.training.warmupRatio') OR json_exists(d, '$.training.warmupSteps')) AND NOT json_exists(d, '$.training.lrSchedulerType')"),
    _rule("training", "not", "json_exists(d, '$.training.warmupRatio') AND json_exists(d, '$.training.warmupSteps')"),
    _rule("training/earlyStopping/patience", "minimum", "TRY_CAST(d->>'$.training.earlyStopping.patience' AS DOUBLE) < 1"),
    _rule("checks", "minItems", "json_array_length(d, '$.checks') < 1"),
    _rule("checks/1/name", "minLength", "length(d->>'$.checks[1].name') = 0"),
    _rule("checks/1/successful", "type", "json_type(d, '$.checks[1].successful') <> 'BOOLEAN'"),
    _rule("(root)", "required device", "ok AND NOT json_exists(d, '$.device')"),
]


@query(f"WITH j AS (SELECT o_orderkey, json_valid(doc) AS ok, CASE WHEN json_valid(doc) THEN CAST(doc AS JSON) END AS d FROM (SELECT o_orderkey, {_JOBS} AS doc FROM orders)) " + " UNION ALL ".join(_JOB_RULES))
def job_documents(spark, sf_dir):
    """Every order as a job document, and each rule of the schema that it breaks."""
    jobs = _table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_JOBS).alias("doc"))
    return documents.document_problems(jobs, "doc", JOB)


_MODELS = """'{"schema_version": "1.1", "models": {"m' || c_custkey || '": {"model_id": "org/' || c_nationkey || '", "revision": ' || CASE WHEN c_custkey % 3 = 0 THEN 'null' ELSE '"' || repeat('0f', 20) || '"' END
|| CASE WHEN c_custkey % 4 = 0 THEN '' ELSE ', "enabled": ' || CASE WHEN c_custkey % 4 = 1 THEN 'true' WHEN c_custkey % 4 = 2 THEN 'null' ELSE '1' END END || ', "requires_trust_remote_code": ' || CASE WHEN c_custkey % 5 = 0 THEN 'true' ELSE 'false' END
|| ', "resource_profile": {"qlora": {"min_vram_gb": ' || CASE WHEN c_custkey % 2 = 0 THEN 'null' ELSE '' || (4 + c_nationkey) || '.5' END || ', "measured_at": {"max_sequence_length": 512, "per_device_batch_size": 2}}}}, "d' || c_custkey || '": {"model_id": "x", "backend": "own"}}}'"""


@query("""WITH m AS (SELECT 'm' || c_custkey AS model_key, c_custkey % 4 IN (1, 3) AS enabled, c_custkey % 5 = 0 AS remote, c_custkey % 3 > 0 AS pinned, 'generic_causal_lm' AS backend, CASE WHEN c_custkey % 2 = 1 THEN c_nationkey + 4.5 END AS vram FROM customer
UNION ALL SELECT 'd' || c_custkey, false, false, false, 'own', NULL FROM customer)
SELECT model_key, backend, CASE WHEN NOT enabled THEN 'MODEL_DISABLED' WHEN remote THEN 'MODEL_REMOTE_CODE_BLOCKED' WHEN NOT pinned THEN 'MODEL_REVISION_UNPINNED' ELSE 'ok' END AS code, CAST(vram AS DOUBLE) AS min_vram_gb, CAST(CASE WHEN vram IS NOT NULL THEN 1024 ELSE 0 END AS BIGINT) AS load FROM m""")
def registry_models(spark, sf_dir):
    """Each customer as a registry document of two models; a request for each model, and its measurement."""
    docs = _table(spark, sf_dir, "customer").select("c_custkey", F.expr(_MODELS).alias("doc"))
    entries = registries.models(docs, "doc")
    registry = entries.select("model_key", "backend", "enabled", F.col("requires_trust_remote_code").alias("remote_code"), "revision")
    resolved = policy.resolve_models(entries.select("model_key"), registry)
    figures = registries.measured(entries).select("model_key", "min_vram_gb", (F.col("max_sequence_length") * F.col("per_device_batch_size")).alias("load"))
    return resolved.join(figures, "model_key", "left").select("model_key", "backend", F.coalesce("code", F.lit("ok")).alias("code"), "min_vram_gb", F.coalesce("load", F.lit(0)).alias("load"))


_SOURCES = """'{"sources": {"s' || s_suppkey || '": {"source_id": "org/' || s_nationkey || '"' || CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE ', "revision": "' || repeat('a', 40) || '"' END
|| CASE WHEN s_suppkey % 4 = 0 THEN ', "enabled": false' WHEN s_suppkey % 4 = 1 THEN ', "enabled": null' ELSE '' END || ', "intended_use": ["' || CASE WHEN s_suppkey % 5 = 0 THEN 'evaluation_only' ELSE 'training' END
|| '"], "profiles": {"dev": {"count": ' || s_nationkey || '}, "full": null}}}}'"""


@query("""SELECT 's' || s_suppkey AS source_id, CASE WHEN s_suppkey % 4 < 2 THEN 'disabled' WHEN s_suppkey % 5 = 0 THEN 'evaluation only' WHEN s_suppkey % 3 = 0 THEN 'unpinned' ELSE 'ok' END AS gate,
'messages/unclear/inputs/1.0' AS defaults, CAST(s_nationkey AS BIGINT) AS dev_count, 'stable_hash' AS full_selection FROM supplier""")
def registry_sources(spark, sf_dir):
    """Each supplier as a registry document of one source with two profiles, held against the gates."""
    docs = _table(spark, sf_dir, "supplier").select("s_suppkey", F.expr(_SOURCES).alias("doc"))
    entries = registries.sources(docs, "doc")
    rows = entries.select(F.col("id").alias("source_id"), F.concat_ws("/", "canonical_schema", "redistribution", "prompt_field", "schema_version").alias("defaults"), F.col("profiles")["dev"]["count"].alias("dev_count"), F.col("profiles")["full"]["selection"].alias("full_selection"))
    return policy.source_gate(rows, entries.drop("source_id").withColumnRenamed("id", "source_id")).select("source_id", "gate", "defaults", "dev_count", "full_selection")
