"""The report on inputs, masked examples, and rules on listings and registries that were too lenient."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillspark.functions import text
from quillspark.operators import integrity, masking, policy, report
from quillspark.queries import QUERIES

from .oracle import SF

MESSAGES = "array<struct<role:string,content:string>>"


def chat(answer, role="assistant"):
    return [("user", "q"), (role, answer)]


def reported(spark, rows, **limits):
    df = spark.createDataFrame(rows, f"split string, messages {MESSAGES}, fp string, tokens int")
    return report.input_report(df, F.col("split"), F.col("messages"), F.col("fp"), F.col("tokens"), **limits).first()


def test_all_findings_at_once_and_in_order(spark):
    rows = [("test", chat("a"), "f1", 5), ("train", chat("a"), "f1", 5), ("train", chat("a"), "f1", 900), ("train", chat(" "), "f2", 5), ("validation", chat("b", "tool"), "f3", 5), ("validation", None, None, None), ("validation", [], None, 1), ("other", chat("z"), "f1", 5), (None, chat("z"), "f1", 5)]
    got = reported(spark, rows, ceiling=100, budget=50)
    assert got["verdict"] == "rejected" and got["code"] == "DATASET_TARGET_EMPTY"
    assert [tuple(f) for f in got["findings"]] == [
        ("DATASET_TARGET_EMPTY", "train", None, 1), ("DATASET_SCHEMA_UNKNOWN", "validation", None, 2), ("DATASET_ROLE_INVALID", "validation", None, 1), ("DATASET_SPLIT_LEAKAGE", "train", "test", 1),
        ("DATASET_SEQUENCE_TOO_LONG", "train", None, 1), ("DATASET_TOKEN_BUDGET_EXCEEDED", "train", None, 910), ("DUPLICATES", "train", None, 1),
    ]
    assert [(r["split"], r["records"], r["duplicates"], r["invalid"], r["longest"]) for r in got["inputs"]] == [("train", 3, 1, 1, 900), ("validation", 3, 0, 3, 5), ("test", 1, 0, 0, 5)]


@pytest.mark.parametrize("n, code", [(0, "DATASET_SPLIT_MISSING"), (1, "DATASET_TOO_FEW_EXAMPLES"), (2, None)])
def test_train_split(spark, n, code):
    got = reported(spark, [("train", chat(str(i)), str(i), 1) for i in range(n)])
    assert (got["code"], got["verdict"]) == (code, "rejected" if code else "accepted") and (n or got["inputs"] == [])


def test_repeats_alone_are_accepted_and_tokens_may_be_left_out(spark):
    df = spark.createDataFrame([("train", chat("a"), "f")] * 3, f"split string, messages {MESSAGES}, fp string")
    got = report.input_report(df, F.col("split"), F.col("messages"), F.col("fp"), None).first()
    assert got["verdict"] == "accepted" and [tuple(f) for f in got["findings"]] == [("DUPLICATES", "train", None, 2)]


def test_the_report_is_one_scan_and_one_shuffle_by_fingerprint(spark, capsys):
    QUERIES["input_report"](spark, SF).explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def by_hand(spans, ids, offsets):
    out = [-100] * len(ids)
    for a, b in spans:
        for i, (s, e) in enumerate(offsets):
            if a <= s and e <= b and s < e:
                out[i] = ids[i]
    return out


def test_merging_tokens_and_spans():
    rnd = random.Random(4)
    for _ in range(300):
        cuts = sorted(rnd.choices(range(60), k=rnd.randint(0, 25)))
        offsets = list(zip(cuts, cuts[1:]))
        edges = sorted(rnd.sample(range(60), 2 * rnd.randint(0, 5)))
        spans = list(zip(edges[::2], edges[1::2]))
        a, b = (np.array(x, np.int64) for x in (list(zip(*offsets)) or [[], []]))
        c, d = (np.array(x, np.int64) for x in (list(zip(*spans)) or [[], []]))
        assert masking.inside(a, b, c, d).tolist() == [x != -100 for x in by_hand(spans, [1] * len(offsets), offsets)]


def test_masked_examples_against_plain_loops(spark):
    rows = [(0, chat("An answer, and more.")), (1, chat("é 日本 \U0001f600 ok") + chat("second!")), (2, chat("", "user")), (3, [("system", "s"), *chat("word " * 400)]), (4, None), (5, [])]
    df = spark.createDataFrame([(i, m, "z") for i, m in rows], f"id int, messages {MESSAGES}, labels string").drop("labels")
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = {r["id"]: r for r in masking.masked_examples(df, F.col("messages"), text.chat_text(F.col("messages")), "<|im_end|>", masking.from_file(path), 100, ["id"]).collect()}
    library = Tokenizer.from_file(path)
    for i, m in rows:
        full, spans, at = "".join(f"<|im_start|>{r}\n{c}<|im_end|>\n" for r, c in m or []), [], 0
        for r, c in m or []:
            start = full.find(c.strip(), at)
            end = full.find("<|im_end|>", start) + 10
            if r == "assistant":
                spans.append((start, end))
            at = end if r == "assistant" else start + len(c.strip())
        e = library.encode(full, add_special_tokens=False)
        want = by_hand(spans, e.ids, e.offsets)
        code = "DATASET_SEQUENCE_TOO_LONG" if len(e.ids) > 100 else "DATASET_TARGET_EMPTY" if set(want) <= {-100} else None
        assert (got[i]["n_tokens"], got[i]["code"]) == (len(e.ids), code)
        assert (got[i]["input_ids"], got[i]["labels"]) == ((None, None) if code else (e.ids, want))
    assert masking.masked_examples(df.limit(0), F.col("messages"), F.lit(""), "x", masking.by_blanks).count() == 0


def test_token_counts_by_any_tokenizer(spark):
    df = spark.createDataFrame([("a b  c",), ("",), (None,)], "t string")
    assert [r["n_tokens"] for r in masking.token_counts(df, F.col("t"), masking.by_blanks).collect()] == [3, 0, 0]
    got = [r["n"] for r in masking.token_counts(df, F.col("t"), masking.from_file(public_tokenizers.path("byte_bpe_50k.json")), "n").collect()]
    assert got == [4, 0, 0]


def test_listed_twice_and_nameless(spark):
    files = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("b", 2, "y"), (None, 1, "z")], "path string, size long, sha256 string")
    disk = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), (None, 1, "z")], "path string, size long, sha256 string")
    assert [tuple(r) for r in integrity.manifest_diff(files, disk).collect()] == [("b", "repeated")]
    members = spark.createDataFrame([(None, 1, 1, 0o100644), ("fine", 1, 1, 0o100644), ("../up", 1, 1, 0o100644), ("x", 1, 1, 0o100644), ("x", 1, 1, 0o100644)], "name string, size long, packed long, mode int")
    got = sorted((str(r["name"]), r["problem"], r["code"]) for r in integrity.member_problems(members).collect())
    assert got == [("../up", "parent traversal", "DATASET_ARCHIVE_UNSAFE"), ("None", "no name", "DATASET_ARCHIVE_UNSAFE")] + [("x", "duplicate", "DATASET_ARCHIVE_DUPLICATE_MEMBER")] * 2


def test_repeated_registry_keys_are_refused(spark):
    registry = spark.createDataFrame([("m", True, False, "a" * 40)] * 2, "model_key string, enabled boolean, remote_code boolean, revision string")
    asked = spark.createDataFrame([(1, "m")], "request_id int, model_key string")
    with pytest.raises(Exception, match="CONFIG_SCHEMA_INVALID: repeated or null key m"):
        policy.resolve_models(asked, registry).collect()
    assert policy.resolve_models(asked, registry.limit(1)).count() == 1
    sources = spark.createDataFrame([("s", True, [], "a" * 40)] * 2, "source_id string, enabled boolean, intended_use array<string>, revision string")
    with pytest.raises(Exception, match="CONFIG_SCHEMA_INVALID"):
        policy.source_gate(spark.createDataFrame([("s",)], "source_id string"), sources).collect()


def test_labels_that_differ_by_case(spark):
    df = spark.createDataFrame([("sagot: A",)], "t string")
    assert df.select(text.answer_label(F.col("t"), ["A", "a"]).alias("x")).first()["x"] == "a"
