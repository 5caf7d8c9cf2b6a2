"""Column functions on text and on messages, an array of (role, content)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MESSAGES = "array<struct<role:string,content:string>>"
ROLES = ["system", "user", "assistant"]
#: What Python's str.strip takes off: Java's Unicode white space and the four separators that it lacks.
_EDGE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(text: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(text, _EDGE, "")


def is_blank(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit("")) == ""


def _lower_escapes(json: Column) -> Column:
    """to_json writes control characters with capital hex digits; the canonical form has small ones."""
    codes = ["000B", "000E", "000F", *(f"00{i:02X}" for i in range(0x1A, 0x20))]
    fixed = reduce(lambda c, x: F.regexp_replace(c, rf"(?<!\\)((?:\\\\)*)\\u{x}", rf"$1\\u{x.lower()}"), codes, json)
    return F.when(json.contains("\\u00"), fixed).otherwise(json)


def canonical_json(value: Column) -> Column:
    """Compact JSON with null fields; the caller gives struct fields in alphabetical order."""
    return _lower_escapes(F.to_json(value, {"ignoreNullFields": "false"}))


def canonical_messages(messages: Column) -> Column:
    """The messages with fields in alphabetical order."""
    return F.transform(messages, lambda m: F.struct(m["content"].alias("content"), m["role"].alias("role")))


def record_json(messages: Column) -> Column:
    """Canonical JSON of the record {"messages": ...}."""
    return canonical_json(F.struct(canonical_messages(messages).alias("messages")))


def message_fingerprint(messages: Column) -> Column:
    """SHA-256 of the pairs of role and stripped content."""
    return F.sha2(canonical_json(F.transform(messages, lambda m: F.array(m["role"], strip(m["content"])))), 256)


def record_fingerprint(messages: Column) -> Column:
    """SHA-256 of the whole record, nothing stripped."""
    return F.sha2(record_json(messages), 256)


def assistant_text(messages: Column) -> Column:
    """Contents of assistant turns, one after another on lines."""
    return F.array_join(F.transform(F.filter(messages, lambda m: m["role"] == "assistant"), lambda m: m["content"]), "\n")


def content_hash(fields: Sequence[str]) -> Column:
    """SHA-256 of the canonical JSON of some columns."""
    return F.sha2(canonical_json(F.struct(*(F.col(f).alias(f) for f in sorted(fields)))), 256)


def messages_code(messages: Column) -> Column:
    """The first failed rule of typed messages, or null: none, a role that isn't known, no assistant text."""
    known = F.forall(messages, lambda m: F.coalesce(m["role"].isin(ROLES), F.lit(False)))
    answered = F.exists(messages, lambda m: (m["role"] == "assistant") & ~is_blank(m["content"]))
    empty = messages.isNull() | (F.size(messages) == 0)
    return F.when(empty, "DATASET_SCHEMA_UNKNOWN").when(~known, "DATASET_ROLE_INVALID").when(~answered, "DATASET_TARGET_EMPTY")


def family(keys: Column) -> Column:
    """Schema family of a record by its keys; otherwise the code: DATASET_SCHEMA_UNKNOWN or DATASET_SCHEMA_MIXED."""
    has = lambda *names: F.coalesce(F.arrays_overlap(keys, F.array(*map(F.lit, names))), F.lit(False))
    found = F.array_compact(F.array(F.when(has("messages"), "conversational"), F.when(has("prompt", "completion"), "prompt_completion"), F.when(has("instruction", "output"), "instruction")))
    return F.when(F.size(found) == 1, F.get(found, F.lit(0))).when(F.size(found) == 0, "DATASET_SCHEMA_UNKNOWN").otherwise("DATASET_SCHEMA_MIXED")


def prefix_length(low: Column, high: Column) -> Column:
    """Length of the common prefix of two texts, by bisection: a prefix of some length is shared or not.

    The common prefix of all texts of a group is that of their least and greatest."""
    most = F.least(F.length(low), F.length(high))
    start = F.struct(F.lit(0).alias("a"), most.alias("b"))

    def halve(s: Column, _: Column) -> Column:
        mid = F.ceil((s["a"] + s["b"]) / 2).cast("int")
        same = F.left(low, mid) == F.left(high, mid)
        return F.struct(F.when(same, mid).otherwise(s["a"]).alias("a"), F.when(same, s["b"]).otherwise(F.greatest(mid - 1, s["a"])).alias("b"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(32)), start, halve)["a"]


def member_path(name: Column) -> Column:
    """An archive member's path with forward slashes, without empty and single-dot parts."""
    return F.array_join(F.filter(F.split(F.replace(name, F.lit("\\"), F.lit("/")), "/"), lambda p: ~p.isin("", ".")), "/")


def unsafe_member(name: Column) -> Column:
    """Why an archive member's name is unsafe, or null."""
    path = F.replace(name, F.lit("\\"), F.lit("/"))
    return F.when(path.startswith("/"), "absolute path").when(path.rlike("^[A-Za-z]:"), "drive prefix").when(F.array_contains(F.split(path, "/"), ".."), "parent traversal")


def answer_label(response: Column, labels: Sequence[str], tag: str = "Sagot:") -> Column:
    """The label a response answers with: the last one directly after tag, else the whole response; 'null' if neither.

    Letters' case, marks at the edges and runs of white space don't count; of labels that differ by case alone the last is given."""
    import re

    choice = "|".join(map(re.escape, sorted(labels, key=len, reverse=True)))
    tagged = F.regexp_extract(response, rf"(?iuU){re.escape(tag)}[\s\*]*({choice})+", 1)
    marks = r"[!-/:-@\[-`{-~ \n]+"
    plain = F.regexp_replace(F.lower(F.when(tagged != "", tagged).otherwise(response)), rf"^{marks}|{marks}$", "")
    plain = F.regexp_replace(strip(plain), r"(?U)[\s\x1c-\x1f]+", " ")
    table = F.create_map(*(F.lit(x) for pair in {label.lower(): label for label in labels}.items() for x in pair))
    return F.coalesce(F.try_element_at(table, plain), F.lit("null"))


#: The texts of the multiple-choice prompt.
PROMPT_HEAD = """Piliin ang pinaka-angkop na sagot sa sumusunod na tanong.

Sumagot gamit ang sumusunod na format.
"{tag} ANSWER"
Palitan ang ANSWER gamit ang napiling sagot. Gumamit lang ng letrang A, B, C, o D sa sagot mo."""


def choice_prompt(question: Column, choices: Column, tag: str = "Sagot:") -> Column:
    """The zero-shot prompt of a question and its lettered choices; null if either is blank."""
    body = F.concat(F.lit(PROMPT_HEAD.replace("{tag}", tag) + "\n\nTanong:\n```\n"), question, F.lit("\n\n"), choices, F.lit("\n```"))
    return F.when(~is_blank(question) & ~is_blank(choices), strip(body))


def folded_system(messages: Column) -> Column:
    """Messages for a template without a system role: a first system turn goes in front of the user's turn that follows it."""
    at = lambda i: F.get(messages, F.lit(i))
    both = F.struct(F.lit("user").alias("role"), F.concat(at(0)["content"], F.lit("\n\n"), at(1)["content"]).alias("content"))
    fold = (at(0)["role"] == "system") & (at(1)["role"] == "user")
    return F.when(fold, F.concat(F.array(both), F.slice(messages, 3, F.greatest(F.size(messages), F.lit(1))))).otherwise(messages)


def chat_text(messages: Column, start: str = "<|im_start|>", end: str = "<|im_end|>", has_system: bool = True, ask: bool = False) -> Column:
    """Messages in the default template: each turn's role and content between marks, a line each; ask opens the assistant's turn."""
    turns = messages if has_system else folded_system(messages)
    each = F.transform(turns, lambda m: F.concat(F.lit(start), m["role"], F.lit("\n"), m["content"], F.lit(end + "\n")))
    return F.concat(F.array_join(each, ""), F.lit(f"{start}assistant\n" if ask else ""))


def short_record_fingerprint(record: Column) -> Column:
    """The shortened fingerprint of any record; the caller gives struct fields in alphabetical order."""
    return F.left(F.sha2(canonical_json(record), 256), F.lit(16))
