"""JSON documents held against a schema document, which is compiled to column expressions over VARIANT.

Every rule that a document breaks is found, not the first alone. The subset of keywords is KEYWORDS; a schema with another
one is refused, as a keyword that is passed over would accept what it should not. Nothing is collected: the schema is the
driver's, the documents are rows.

Defined results: a null, unreadable or repeated-key document breaks the rule "json" at the root; a document may break a rule
at any depth, and each place is a row of its own; a rule that does not fit a value's type (a length of a number) is not broken,
as the type rule says that already; numbers are compared as doubles; repeated rows are checked each; other columns stay.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..codes import Refused

#: The keywords that are compiled, and those that say nothing about a document.
KEYWORDS = [
    "type", "enum", "const", "pattern", "minLength", "maxLength", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum",
    "required", "properties", "additionalProperties", "propertyNames", "minProperties", "dependentRequired", "items", "minItems",
    "maxItems", "uniqueItems", "$ref", "allOf", "anyOf", "oneOf", "not", "if", "then", "else",
]
NOTES = ["$schema", "$id", "$defs", "$comment", "title", "description", "examples", "default", "format"]
DEPTH = 32
PROBLEMS = "array<struct<path:string,rule:string>>"

_TYPES = {"object": "OBJECT<", "array": "ARRAY<", "string": "STRING", "boolean": "BOOLEAN", "null": "VOID"}


class _Compiler:
    def __init__(self, refs: dict[str, dict]) -> None:
        self.refs = refs

    def resolve(self, ref: str, root: dict) -> tuple[dict, dict]:
        name, _, pointer = ref.partition("#")
        base = root if not name else self.refs.get(name)
        found = base
        for part in filter(None, pointer.split("/")):
            found = found.get(part.replace("~1", "/").replace("~0", "~")) if isinstance(found, dict) else None
        if not isinstance(found, (dict, bool)):
            raise Refused("CONFIG_SCHEMA_INVALID", f"nothing at {ref}")
        return found, base

    def problems(self, schema, value: Column, path: Column, root: dict, depth: int = 0) -> Column:
        """The problems of a value and of all below it, none where there is no value. The value and its kind are bound once for
        all rules of their place."""
        kinds = lambda v: F.flatten(F.transform(F.array(F.schema_of_variant(v)), lambda kind: self.held(schema, v, kind, path, root, depth)))
        return F.flatten(F.transform(F.array_compact(F.array(value)), kinds))

    def held(self, schema, value: Column, kind: Column, path: Column, root: dict, depth: int) -> Column:
        """The problems of a value that is there."""
        if depth > DEPTH:
            raise Refused("CONFIG_SCHEMA_INVALID", f"more than {DEPTH} schemas within each other")
        if schema is True:
            return _none()
        if schema is False:
            return _one(path, "false")
        unknown = sorted(set(schema) - set(KEYWORDS) - set(NOTES))
        if unknown:
            raise Refused("CONFIG_SCHEMA_INVALID", f"keywords that are not compiled: {', '.join(unknown)}")
        inner = lambda s: self.held(s, value, kind, path, root, depth + 1)
        rules = [F.when(broken, _problem(path, rule)) for rule, broken in self.rules(schema, value, kind, inner)]
        parts = [F.array_compact(F.array(*rules)).cast(PROBLEMS)] if rules else []
        for name, part in (schema.get("properties") or {}).items():
            parts.append(self.problems(part, F.try_variant_get(value, f"$['{_plain(name)}']", "variant"), _below(path, F.lit(name)), root, depth + 1))
        if "$ref" in schema:
            found, where = self.resolve(schema["$ref"], root)
            parts.append(self.held(found, value, kind, path, where, depth + 1))
        parts += [inner(s) for s in schema.get("allOf", [])]
        if "if" in schema:
            parts.append(F.when(F.size(inner(schema["if"])) == 0, inner(schema.get("then", True))).otherwise(inner(schema.get("else", True))))
        if "items" in schema:
            each = lambda v, i: self.problems(schema["items"], v, _below(path, i.cast("string")), root, depth + 1)
            parts.append(F.coalesce(F.flatten(F.transform(_list(value), each)), _none()))
        more = schema.get("additionalProperties", True)
        if more is not True:
            unnamed = F.filter(F.map_entries(_map(value)), lambda e: ~_within(e["key"], list(schema.get("properties") or {})))
            each = (lambda e: _one(path, F.concat(F.lit("additionalProperties "), e["key"]))) if more is False else (lambda e: self.problems(more, e["value"], _below(path, e["key"]), root, depth + 1))
            parts.append(F.coalesce(F.flatten(F.transform(unnamed, each)), _none()))
        return F.flatten(F.array(*parts)) if parts else _none()

    def rules(self, schema: dict, value: Column, kind: Column, inner):
        """(rule, whether it is broken) of the keywords that concern a value as a whole."""
        is_ = lambda t: _is(t, kind, value)
        if "type" in schema:
            names = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
            yield "type", ~_any([is_(t) for t in names])
        for word in ("enum", "const"):
            if word in schema:
                yield word, ~_any([_equals(value, kind, x) for x in (schema[word] if word == "enum" else [schema[word]])])
        text = F.when(is_("string"), F.try_variant_get(value, "$", "string"))
        if "pattern" in schema:
            yield "pattern", _true(~text.rlike(schema["pattern"]))
        number = F.when(is_("number"), F.try_variant_get(value, "$", "double"))
        keys, elements = F.map_keys(_map(value)), _list(value)
        bounds = [
            ("minLength", F.length(text), "<"), ("maxLength", F.length(text), ">"), ("minimum", number, "<"), ("maximum", number, ">"),
            ("exclusiveMinimum", number, "<="), ("exclusiveMaximum", number, ">="), ("minProperties", F.size(keys), "<"),
            ("minItems", F.size(elements), "<"), ("maxItems", F.size(elements), ">"),
        ]
        for word, measure, sign in bounds:
            if word in schema:
                limit = F.lit(schema[word])
                beyond = {"<": measure < limit, ">": measure > limit, "<=": measure <= limit, ">=": measure >= limit}[sign]
                yield word, _true(beyond)
        if schema.get("uniqueItems"):
            texts = F.transform(elements, lambda v: F.to_json(v))
            yield "uniqueItems", _true(F.size(F.array_distinct(texts)) < F.size(texts))
        there = lambda name: F.try_variant_get(value, f"$['{name}']", "variant").isNotNull()
        an_object = is_("object")
        for name in schema.get("required", []):
            yield f"required {name}", an_object & ~there(_plain(name))
        for name, needs in (schema.get("dependentRequired") or {}).items():
            for need in needs:
                yield f"dependentRequired {need}", an_object & there(_plain(name)) & ~there(_plain(need))
        if "propertyNames" in schema:
            names = schema["propertyNames"]
            if set(names) - {"pattern", *NOTES}:
                raise Refused("CONFIG_SCHEMA_INVALID", "names of properties are held against a pattern only")
            yield "propertyNames", _true(F.exists(keys, lambda k: ~k.rlike(names.get("pattern", ""))))
        fits = lambda s: (F.size(inner(s)) == 0).cast("int")
        if "anyOf" in schema:
            yield "anyOf", _sum([fits(s) for s in schema["anyOf"]]) < 1
        if "oneOf" in schema:
            yield "oneOf", _sum([fits(s) for s in schema["oneOf"]]) != 1
        if "not" in schema:
            yield "not", fits(schema["not"]) == 1


def _plain(name: str) -> str:
    """A property's name that a path can hold."""
    if "'" in name or "\\" in name:
        raise Refused("CONFIG_SCHEMA_INVALID", f"a property's name with a quote or backslash: {name}")
    return name


def _problem(path: Column, rule) -> Column:
    return F.struct(F.coalesce(F.nullif(path, F.lit("")), F.lit("(root)")).alias("path"), (rule if isinstance(rule, Column) else F.lit(rule)).alias("rule"))


def _one(path: Column, rule) -> Column:
    return F.array(_problem(path, rule)).cast(PROBLEMS)


def _none() -> Column:
    return F.array().cast(PROBLEMS)


def _below(path: Column, step: Column) -> Column:
    return F.concat_ws("/", F.nullif(path, F.lit("")), step)


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | _true(c)
    return out


def _sum(counts: list[Column]) -> Column:
    out = F.lit(0)
    for c in counts:
        out = out + c
    return out


def _within(key: Column, names: list[str]) -> Column:
    return key.isin(names) if names else F.lit(False)


def _map(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>")


def _list(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _is(name: str, kind: Column, value: Column) -> Column:
    """Whether a value of a kind has a type's name; 2.0 is an integer."""
    numeric = kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    if name == "number":
        return numeric
    if name == "integer":
        number = F.try_variant_get(value, "$", "double")
        return numeric & _true(number == F.rint(number))
    if name not in _TYPES:
        raise Refused("CONFIG_SCHEMA_INVALID", f"no type {name}")
    return kind.startswith(_TYPES[name])


def _equals(value: Column, kind: Column, literal) -> Column:
    """Whether a value is a literal: a text, a number, a truth value or null."""
    if literal is None:
        return _is("null", kind, value)
    if isinstance(literal, bool):
        return _is("boolean", kind, value) & (F.try_variant_get(value, "$", "boolean") == literal)
    if isinstance(literal, (int, float)):
        return _is("number", kind, value) & (F.try_variant_get(value, "$", "double") == float(literal))
    if isinstance(literal, str):
        return _is("string", kind, value) & (F.try_variant_get(value, "$", "string") == literal)
    raise Refused("CONFIG_SCHEMA_INVALID", f"lists and objects are not compared: {json.dumps(literal)}")


def schema_problems(document: Column, schema: dict, refs: dict[str, dict] | None = None) -> Column:
    """The rules that a JSON text breaks, as an array of (path, rule), sorted by path and rule; refs are schemas by the file
    name that references give."""
    checked = lambda v: F.array_sort(F.array_distinct(_Compiler(refs or {}).problems(schema, v, F.lit(""), schema)))
    parsed = F.array_compact(F.array(F.try_parse_json(document)))  # bound by the transform, so that a text is parsed once
    return F.coalesce(F.get(F.transform(parsed, checked), F.lit(0)), _one(F.lit(""), "json"))


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores before it until no column has it, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def others(df: DataFrame, column: str) -> list[Column]:
    """The columns but one, whatever their names hold."""
    return [df[f"`{c.replace('`', '``')}`"] for c in df.columns if c != column]


def document_problems(documents: DataFrame, column: str, schema: dict, refs: dict[str, dict] | None = None) -> DataFrame:
    """The documents' rows without column, one for each rule that they break, with path and rule (_path, _rule where the rows
    have columns of these names)."""
    rest = others(documents, column)
    names = [free_name(documents, n) for n in ("path", "rule")]
    typed = f"array<struct<`{names[0]}`:string,`{names[1]}`:string>>"
    return documents.select(*rest, F.inline(schema_problems(F.col(column), schema, refs).cast(typed)))


def valid_documents(documents: DataFrame, column: str, schema: dict, refs: dict[str, dict] | None = None) -> DataFrame:
    """The rows whose document breaks no rule."""
    return documents.filter(F.size(schema_problems(F.col(column), schema, refs)) == 0)
