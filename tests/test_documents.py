import json

import pytest
from pyspark.sql import functions as F

from quillspark.codes import Refused
from quillspark.operators import documents, registries


def broken(spark, schema, *docs, refs=None):
    texts = [d if d is None or isinstance(d, str) and d.startswith("!") else json.dumps(d) for d in docs]
    df = spark.createDataFrame(list(enumerate(t and t.lstrip("!") for t in texts)), "n int, doc string")
    got = df.select("n", documents.schema_problems(F.col("doc"), schema, refs).alias("p")).orderBy("n").collect()
    return [[tuple(p) for p in r["p"]] for r in got]


def test_unreadable_documents_break_one_rule(spark):
    assert broken(spark, {"type": "object"}, None, "!", "!{", '!{"a": 1, "a": 2}', "!null", {}) == [[("(root)", "json")]] * 4 + [[("(root)", "type")], []]


@pytest.mark.parametrize("schema, good, bad", [
    ({"type": "integer"}, [1, 2.0, 10**25, -3], [1.5, "1", True, None, [], {}]),
    ({"type": ["number", "null"]}, [1, 1.5, None], ["1", False]),
    ({"enum": ["a", 1, None, True]}, ["a", 1, 1.0, None, True], ["b", 2, False, "1", [], {}]),
    ({"const": False}, [False], [0, "", None, True]),
    ({"minLength": 2, "maxLength": 3}, ["ab", "\U0001f600é", "abc", 7], ["a", "abcd", ""]),
    ({"pattern": "b+"}, ["abc", 5, None], ["ac", ""]),
    ({"minimum": 1, "exclusiveMaximum": 2}, [1, 1.9, "0"], [0.99, 2, -5]),
    ({"items": {"type": "string"}, "maxItems": 2, "uniqueItems": True}, [[], ["a", "b"], 4], [[1], ["a"] * 2, list("abc")]),
    ({"minProperties": 1, "propertyNames": {"pattern": "^[a-z]+$"}}, [{"a": None}], [{}, {"A": 1}]),
    ({"additionalProperties": {"type": "integer"}}, [{}, {"x": 1}], [{"x": "1"}, {"x": None}]),
    ({"oneOf": [{"type": "integer"}, {"minimum": 5}]}, [1, 7.5], [6, 2.5]),
    ({"anyOf": [{"type": "string"}, {"minimum": 5}]}, ["a", 6], [1]),
    ({"not": {"required": ["a"]}}, [{}, {"b": 1}], [{"a": None}]),
    ({"if": {"properties": {"on": {"const": True}}, "required": ["on"]}, "then": {"required": ["pin"]}, "else": {"properties": {"pin": False}}}, [{"on": True, "pin": 1}, {}, {"on": False}], [{"on": True}, {"pin": 1}]),
    ({"dependentRequired": {"a": ["b"]}}, [{}, {"b": 1}, {"a": 1, "b": None}], [{"a": 1}]),
])
def test_keywords(spark, schema, good, bad):
    found = broken(spark, schema, *("!null" if v is None else v for v in good + bad))
    assert not any(found[: len(good)]) and all(found[len(good) :])


def test_every_broken_rule_is_found_with_its_path(spark):
    schema = {
        "properties": {"models": {"additionalProperties": {"$ref": "#/$defs/m"}}, "checks": {"items": {"$ref": "shared.json#/$defs/check"}}},
        "required": ["models", "version"],
        "additionalProperties": False,
        "$defs": {"m": {"type": "object", "properties": {"rev": {"type": ["string", "null"], "pattern": "^[0-9]+$"}, "lists": {"items": {"items": {"minimum": 3}}}}, "required": ["rev"]}},
    }
    refs = {"shared.json": {"$defs": {"check": {"properties": {"name": {"$ref": "#/$defs/name"}}, "required": ["name"]}, "name": {"minLength": 1}}}}
    doc = {"models": {"a": {"rev": "x"}, "b": {}, "c": 5, "d": {"rev": None, "lists": [[], [3, 1], [2]]}}, "checks": [{"name": "n"}, {"name": ""}, {}], "more": 1}
    assert broken(spark, schema, doc, refs=refs)[0] == sorted([
        ("(root)", "additionalProperties more"), ("(root)", "required version"), ("checks/1/name", "minLength"), ("checks/2", "required name"),
        ("models/a/rev", "pattern"), ("models/b", "required rev"), ("models/c", "type"), ("models/d/lists/1/1", "minimum"), ("models/d/lists/2/0", "minimum"),
    ])


@pytest.mark.parametrize("schema", [{"contains": {}}, {"properties": {"a": {"patternProperties": {}}}}, {"$ref": "#/$defs/none"}, {"type": "text"}, {"enum": [[1]]}, {"properties": {"a'b": {}}}, {"$ref": "#"}])
def test_a_schema_that_is_not_compiled_whole_is_refused(spark, schema):
    with pytest.raises(Refused, match="CONFIG_SCHEMA_INVALID"):
        documents.schema_problems(F.lit("{}"), schema)


def test_rows_keep_their_other_columns(spark):
    df = spark.createDataFrame([(1, "x", '{"a": 1}'), (1, "x", '{"a": 1}'), (2, "y", "{}"), (None, None, None)], "path int, `_problem` string, doc string").withColumnRenamed("_problem", "kept")
    schema = {"required": ["a"]}
    got = documents.document_problems(df.withColumnRenamed("path", "id"), "doc", schema)
    assert sorted(map(tuple, got.collect()), key=str) == [(2, "y", "(root)", "required a"), (None, None, "(root)", "json")]
    assert documents.valid_documents(df, "doc", schema).count() == 2
    assert not documents.document_problems(df.limit(0), "doc", schema).collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_columns_that_clash_with_the_results(spark):
    df = spark.createDataFrame([(1, "r", "{}")], "path int, `_problem` string, doc string")
    with_rules = documents.document_problems(df, "doc", {"required": ["a"]})
    assert with_rules.columns == ["path", "_problem", "_path", "rule"] and tuple(with_rules.first()) == (1, "r", "(root)", "required a")


def entries(spark, load, *docs):
    return load(spark.createDataFrame([(d if d is None else json.dumps(d),) for d in docs], "doc string"), "doc")


def test_model_entries_have_defaults(spark):
    doc = {"models": {"a": {"model_id": "o/a"}, "b": {"model_id": "o/b", "enabled": 1, "license": None, "lora_target_modules": ["q"], "training_methods": None, "resource_profile": {"lora": None, "qlora": {"min_vram_gb": 6, "measured_at": {"max_sequence_length": 8}}}}}}
    a, b = entries(spark, registries.models, doc).orderBy("model_key").collect()
    assert (a["schema_version"], a["architecture"], a["license"], a["enabled"], a["training_methods"], a["lora_target_modules"], a["revision"], a["methods"]) == ("1.0", "causal_lm", "", False, [], ["auto"], None, None)
    assert (b["enabled"], b["license"], b["lora_target_modules"], b["training_methods"], b["methods"]["lora"]["min_vram_gb"]) == (True, None, ["q"], [], None)
    assert [tuple(r) for r in registries.measured(entries(spark, registries.models, doc)).collect()] == [("b", "qlora", 6.0, None, 8, None)]


def test_source_entries_have_defaults(spark):
    doc = {"schema_version": "2.1", "sources": {"s": {"source_id": "x", "profiles": {"full": None}}, "t": {"enabled": None, "gated": "no", "conversion_version": "3", "overlaps_with": ["s"]}, "u": 5}}
    s, t, u = entries(spark, registries.sources, doc, doc | {"sources": {}}, {}, None).orderBy("id").collect()
    assert (s["schema_version"], s["enabled"], s["revision"], s["prompt_field"], s["conversion_version"], s["profiles"]["full"]["selection"]) == ("2.1", True, "", "inputs", 0, "stable_hash")
    assert (t["enabled"], t["gated"], t["conversion_version"], t["overlaps_with"], t["source_id"]) == (False, True, 3, ["s"], None)
    assert (u["redistribution"], u["enabled"], u["languages"]) == ("unclear", True, [])


def test_columns_that_bear_a_field_name(spark):
    df = spark.createDataFrame([(1, "p", "k", '{"models": {"a": {"provider": "q"}}}')], "n int, provider string, MODEL_KEY string, doc string")
    got = registries.models(df, "doc").select("n", "provider", "model_key").first()
    assert tuple(got) == (1, "q", "a")
