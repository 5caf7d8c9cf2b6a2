import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from quillspark import rule_queries
from quillspark.functions import arithmetic, text
from quillspark.operators import integrity, measurements, policy, registration, scoring, tokens
from quillspark.sources import adapters


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("n, p95, p99", [(20, 19, 20), (100, 95, 99), (1, 1, 1)])
def test_nearest_rank(spark, n, p95, p99):
    df = spark.range(1, n + 1).select(F.lit("train").alias("split"), F.col("id").alias("x"))
    r = tokens.token_stats(df, "split", "x", ["train", "test"]).filter("split = 'train'").first()
    assert (r["p95_tokens"], r["p99_tokens"], r["n"], r["total_tokens"], r["median_tokens"]) == (p95, p99, n, n * (n + 1) // 2, (n + 1) // 2)
    empty = tokens.token_stats(df, "split", "x", ["train", "test"]).filter("split = 'test'").first()
    assert empty["n"] == empty["max_tokens"] == 0


def test_overlength_goes_before_budget(spark):
    df = spark.createDataFrame([("train", i, 10 * i) for i in range(1, 80)], "split string, line long, n long")
    r = tokens.overlength(df, "split", "line", "n", 100).first()
    assert r["n_long"] == 69 and r["longest"] == 790 and r["first_lines"].split(",") == [str(i) for i in range(11, 61)]
    assert tokens.token_budget(df, "split", "n", 100, 1).first()["code"] == "DATASET_SEQUENCE_TOO_LONG"
    assert tokens.token_budget(df, "split", "n", 1000, 1).first()["code"] == "DATASET_TOKEN_BUDGET_EXCEEDED"


@pytest.mark.parametrize("response, label", [("SAGOT:\n* d *", "D"), ("perhaps. Sagot: ABC", "C"), ("(b).", "B"), ("\n A\n", "A"), ("A or B", "null"), ("Sagot: E", "null"), ("", "null"), (None, "null")])
def test_answers(spark, response, label):
    assert one(spark, text.answer_label(F.lit(response).cast("string"), ["A", "B", "C", "D"])) == label


# Worked out by hand from the definitions: recall by reference label, F1 by label, shares of answers without a label.
@pytest.mark.parametrize("refs, answers, want", [
    ("AAABBC", ["A", "B", "A", "B", "B", "A"], {"accuracy": 100 * (2 / 3 + 1 + 0) / 3, "normalized_accuracy": 100 * ((5 / 9 - 1 / 3) / (2 / 3)), "macro_f1": 100 * (4 / 6 + 4 / 5 + 0) / 3, "null_count": 0}),
    ("BBAA", ["b", "who knows", "b", "a"], {"accuracy": 50, "normalized_accuracy": 0, "null_weighted_f1": 100 * ((1 / 2 + 2 / 3) / 2) * 3 / 4, "null_count": 1}),
    ("C", ["c"], {"accuracy": 100, "normalized_accuracy": 0}),
])
def test_choice_metrics(spark, refs, answers, want):
    df = spark.createDataFrame(list(zip(refs, answers)), "ref string, resp string")
    got = scoring.choice_metrics(scoring.predictions(df, "ref", "resp", sorted(set(refs))), "ref").first()
    for name, value in want.items():
        assert got[name] == pytest.approx(value), name


def test_strip_takes_what_python_takes(spark):
    blanks = [chr(i) for i in range(0x3001) if chr(i).isspace()]
    df = spark.createDataFrame([(b + "x" + b,) for b in blanks], "c string").select(text.strip(F.col("c")).alias("c"))
    assert {r["c"] for r in df.collect()} == {"x"}


def test_control_characters_in_canonical_json(spark):
    content = "a\x1f\x0b\\u001F\u2028é\"/\x7f"
    df = spark.createDataFrame([([("user", content)],)], "m array<struct<role:string,content:string>>")
    got = df.select(text.record_json(F.col("m"))).first()[0]
    assert got == json.dumps({"messages": [{"content": content, "role": "user"}]}, ensure_ascii=False, separators=(",", ":"))


def test_prefix_length(spark):
    for a, b in (("", ""), ("", "x"), ("abc", "abd"), ("éà", "éàx"), ("same", "same"), ("x", "y")):
        n = next((i for i, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))
        assert one(spark, text.prefix_length(F.lit(a), F.lit(b))) == n


def test_plan_arithmetic(spark):
    steps = arithmetic.total_steps(F.lit(79), F.lit(1), F.lit(2), F.lit(3))
    assert one(spark, steps) == 120
    assert one(spark, arithmetic.warmup_steps(F.lit(120), F.lit(None), F.lit(0.03))) == 4
    assert one(spark, arithmetic.warmup_steps(F.lit(5), F.lit(9), F.lit(None))) == 5
    assert one(spark, arithmetic.warmup_steps(F.lit(5), F.lit(1), F.lit(0.1))) is None
    assert one(spark, arithmetic.perplexity(F.lit(20.0))) is None
    assert one(spark, arithmetic.bytes_text(F.lit(1536))) == "1.50 KiB"


def test_masks(spark):
    df = spark.createDataFrame([([("user", "hi"), ("assistant", " yes ")], "<u>hi<e><a>yes<e>")], "m array<struct<role:string,content:string>>, t string")
    assert [tuple(s) for s in df.select(arithmetic.assistant_spans(F.col("m"), F.col("t"), "<e>")).first()[0]] == [(11, 17)]
    ids = F.array(*map(F.lit, [7, 8, 9]))
    offsets = F.array(*(F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in ((0, 2), (2, 4), (4, 4))))
    labels = arithmetic.masked_labels(ids, offsets, F.array(F.struct(F.lit(2).alias("start"), F.lit(9).alias("end"))))
    assert one(spark, labels) == [-100, 8, -100]
    assert one(spark, arithmetic.supervised_tokens(labels)) == 1
    assert one(spark, arithmetic.marked(F.array(*map(F.lit, "abc")), labels)) == "a⟦b⟧c"


def test_decisions(spark):
    findings = spark.createDataFrame([(1, "pip-audit", "p", "1", "V-1", None, "2"), (2, "pip-audit", "p", "1", "V-2", None, ""), (3, "trivy", "q", "1", "V-3", "HIGH", "2"), (4, "trivy", "q", "2", "V-3", "HIGH", "2")], "finding_id int, source string, package string, installed string, identifier string, severity string, fix string")
    entries = spark.createDataFrame([(1, None, "X", ["V-1"], None, None, None, ["s"], "2026-01-01"), (2, "package", "Y", None, "trivy", "q", "1", ["s"], "2026-01-02")], "entry int, match string, id string, aliases array<string>, source string, package string, installed string, scope array<string>, expires string")
    rules = {"dependencies": {}, "images": {"block_severities": ["HIGH"]}}
    got = {r["finding_id"]: r["decision"] for r in policy.decide(findings, entries, rules, "s", date(2026, 1, 2)).collect()}
    assert got == {1: "expired", 2: "reported", 3: "excepted", 4: "blocking"}
    got = {r["finding_id"]: r["decision"] for r in policy.decide(findings, entries, rules, "t", date(2026, 1, 2)).collect()}
    assert got[1] == got[3] == "blocking"


def test_agreed_channels(spark):
    assert one(spark, policy.agreed([F.lit("a"), F.lit(" "), F.lit("a")])) == "a"
    assert one(spark, policy.agreed([F.lit("a"), F.lit("b")])) is None


def files(spark, *paths):
    return spark.createDataFrame([(p,) for p in paths], "path string")


def test_foreign_layouts(spark):
    images = [f"images/{i}.png" for i in range(5)]
    assert integrity.foreign_task(files(spark, *images, *(f"masks/{i}.png" for i in range(5)))).first()["task"] == "image segmentation"
    assert integrity.foreign_task(files(spark, *images, *(f"labels/{i}.txt" for i in range(5)))).first()["task"] == "object detection"
    assert integrity.foreign_task(files(spark, *(f"{c}/{i}.jpg" for c in ("cat", "dog") for i in range(3)))).first()["task"] == "image classification"
    assert integrity.foreign_task(files(spark, *images, "masks/9.png", "x.jsonl")).first()["task"] is None
    assert integrity.foreign_task(files(spark, "a/logo.png", "notes.md")).first()["task"] is None


def test_archive_members(spark):
    rows = [("train.jsonl", 5, 5, 0o100644), ("./train.jsonl", 5, 5, 0o100644), ("../x", 1, 1, 0o100644), ("C:/y", 1, 1, 0o100644), ("/z", 1, 1, 0o100644), ("link", 1, 1, 0o120777), ("bomb", 5 << 20, 5000, 0o100644), ("fine\\a", 9, 3, 0o100644)]
    df = spark.createDataFrame(rows, "name string, size long, packed long, mode int")
    got = {r["name"]: r["problem"] for r in integrity.member_problems(df).collect()}
    assert got == {"train.jsonl": "duplicate", "./train.jsonl": "duplicate", "../x": "parent traversal", "C:/y": "drive prefix", "/z": "absolute path", "link": "symlink", "bomb": "ratio"}


def test_bounds_of_a_whole_archive(spark):
    def problems(n, size, packed, archive=None):
        """Of n members, the first of them as large as given."""
        first = lambda x, c: F.when(F.col("id") == 0, x).otherwise(1).cast("long").alias(c)
        df = spark.range(n).select(F.concat(F.lit("m"), "id").alias("name"), first(size, "size"), first(packed, "packed"), F.lit(0o100644).alias("mode"))
        return [(r["name"], r["problem"]) for r in integrity.member_problems(df, archive).collect()]

    assert problems(integrity.MAX_MEMBERS, 1, 1) == [] and problems(integrity.MAX_MEMBERS + 1, 1, 1) == [(None, "too many members")]
    assert problems(3, 1, (1 << 30) - 2) == [] and problems(3, 1, (1 << 30) - 1) == [(None, "archive too large")]
    assert problems(3, 1, 1, 1 << 30) == [] and problems(3, 1, 1, (1 << 30) + 1) == [(None, "archive too large")]
    assert problems(0, 1, 1) == []
    half, rest = (f"a{i}" for i in range(2)), [("b", 0), ("c", 1)]
    rows = [(n, 512 << 20, 8 << 20, 0o100644) for n in half]
    for n, size in rest:
        df = spark.createDataFrame([*rows, (n, size, 1, 0o100644)], "name string, size long, packed long, mode int")
        assert [(r["name"], r["problem"]) for r in integrity.member_problems(df).collect()] == ([(None, "total too large")] if size else [])


def test_manifest_against_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text("a")
    (tmp_path / "sub/b.txt").write_text("b")
    disk = integrity.listing(spark, str(tmp_path))
    assert integrity.manifest_diff(disk, disk).count() == 0
    listed = disk.withColumn("size", F.when(F.col("path") == "a.txt", 9).otherwise(F.col("size"))).union(spark.createDataFrame([("gone", 1, "x")], "path string, size long, sha256 string"))
    assert {r["path"]: r["problem"] for r in integrity.manifest_diff(listed, disk).collect()} == {"a.txt": "size", "gone": "missing"}


def test_fits(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 7.0), (3.0, 9.0)], "x double, y double")
    r = df.agg(*integrity.line_fit(F.col("x"), F.col("y"))).first()
    assert (r["slope"], r["intercept"]) == (pytest.approx(2), pytest.approx(3))
    assert df.limit(1).agg(*integrity.line_fit(F.col("x"), F.col("y"))).first()["slope"] is None
    assert df.agg(*integrity.line_fit(F.lit(1.0), F.col("y"))).first()["slope"] is None


def test_adapters(spark):
    rows = spark.createDataFrame([("i", " c\n", "r"), ("i", "  ", "r"), ("i", None, " ")], "instruction string, context string, response string")
    got = adapters.adapt("instruction", rows).collect()
    assert [r["messages"][0]["content"] for r in got] == ["i\n\n c", "i", "i"] and [r["valid"] for r in got] == [True, True, False]
    chats = spark.createDataFrame([("1", json.dumps([{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}])), ("2", "[{'role': 'user'}]"), (" ", "[]")], "conversations_id string, conversations string")
    assert [r["valid"] for r in adapters.adapt("conversation", chats).collect()] == [True, False, False]
    with pytest.raises(ValueError):
        adapters.adapt("other", rows)


def test_scanner_reports(spark):
    doc = json.dumps({"dependencies": [{"name": "p", "version": "1", "vulns": [{"id": "V", "fix_versions": ["2", "3"]}]}, {"name": "q", "version": "1", "vulns": []}]})
    r = adapters.dependency_findings(spark.createDataFrame([(doc,)], "report string")).collect()
    assert [(x["package"], x["identifier"], x["fix"]) for x in r] == [("p", "V", "2, 3")]
    assert adapters.image_findings(spark.createDataFrame([('{"SchemaVersion": 2, "Results": null}',)], "report string")).count() == 0
    with pytest.raises(Exception, match="no schema version"):
        adapters.image_findings(spark.createDataFrame([("{}",)], "report string")).collect()


def test_prompt_rules(spark):
    from quillspark.operators import prompts

    turns = lambda *t: F.array(*(F.struct(F.lit(r).alias("role"), F.lit(c).cast("string").alias("content")) for r, c in t))
    check = lambda t, n=None: one(spark, prompts.prompt_problem(t, n))
    assert check(prompts.as_turns(F.lit("hi"))) is None and check(prompts.as_turns(F.lit(" "))) == "empty turn"
    assert check(turns(("user", "a"), ("assistant", "b"))) == "last turn" and check(turns(("tool", "a"), ("user", "b"))) == "role"
    assert check(turns(("system", None), ("user", "x" * 20_001))) == "empty turn" and check(turns(("user", "x" * 20_001))) == "long turn" and check(turns(("user", "x" * 20_000))) is None
    assert check(turns(("user", "a")), F.lit(0)) == check(turns(("user", "a")), F.lit(1025)) == "new tokens" and check(turns(("user", "a")), F.lit(1024)) is None
    report = prompts.prompt_report(spark.range(1).select(turns(("user", "abc")).alias("messages"), F.lit(3000).alias("t")), tokens="t").first()
    assert (report["n_turns"], report["n_chars"], report["problem"]) == (1, 3, "long prompt")


def test_registry_of_sources(spark):
    sources = spark.createDataFrame([("a", True, ["training"], "f" * 40, ["b"]), ("b", False, None, None, None), ("c", True, ["evaluation_only"], "f" * 40, ["c"]), ("d", True, None, "F" * 40, [])], "source_id string, enabled boolean, intended_use array<string>, revision string, overlaps_with array<string>")
    asked = spark.createDataFrame([(x,) for x in ("a", "b", "c", "d", "e", None)], "source_id string")
    assert {r["source_id"]: r["gate"] for r in policy.source_gate(asked, sources).collect()} == {"a": "ok", "b": "disabled", "c": "evaluation only", "d": "unpinned", "e": "unknown", None: "unknown"}
    assert sorted(map(tuple, policy.overlap_partners(sources).collect())) == [("a", "b"), ("b", "a")]


def test_small_rules(spark):
    assert one(spark, policy.supports(F.lit(None).cast("array<string>"), F.lit("lora"))) is False
    assert one(spark, policy.first_given(F.lit(""), F.lit(None), F.lit("x"))) == "x"
    assert one(spark, policy.same_version(F.lit("2.0+cu12"), F.lit("2.0"))) is True
    assert [one(spark, arithmetic.accumulation_window(F.lit(i), F.lit(7), F.lit(3))) for i in range(1, 8)] == [3, 3, 3, 3, 3, 3, 1]
    assert json.loads(one(spark, arithmetic.lowered_controls(F.lit(0), F.lit(None).cast("string"), F.lit(5)))) == {}
    assert json.loads(one(spark, arithmetic.lowered_controls(F.lit(2), F.lit("cosine"), F.lit(5)))) == {"patience": 2, "scheduler": "cosine", "warmup_steps": 5}
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "path string")
    assert [r["path"] for r in policy.missing_names(names("a", "b"), names("b", "c"), "path").collect()] == ["a"]


def test_bytes_text_has_two_places_in_every_unit(spark):
    cases = {0: "0.00 B", 1023: "1023.00 B", 1024: "1.00 KiB", 5 << 18: "1.25 MiB", -2048: "-2.00 KiB", 1029: "1.00 KiB", 3 << 50: "3.00 PiB"}
    for n, said in cases.items():
        assert one(spark, arithmetic.bytes_text(F.lit(n))) == said
    assert one(spark, arithmetic.bytes_text(F.lit(None).cast("long"))) is None


def test_selectors_that_differ(spark):
    assert one(spark, policy.agreement_code([F.lit("a"), F.lit("b"), F.lit(None)])) == "CONFIG_SCHEMA_INVALID"
    assert one(spark, policy.agreement_code([F.lit(" a"), F.lit("a "), F.lit("")])) is None
    assert one(spark, policy.agreement_code([F.lit(None).cast("string"), F.lit(" ")])) is None
    assert one(spark, policy.license_notice(F.lit(None).cast("string"), F.lit("m"))) == ""


def test_chat_without_a_system_role(spark):
    messages = lambda *pairs: F.array(*(F.struct(F.lit(r).alias("role"), F.lit(c).alias("content")) for r, c in pairs))
    shown = lambda m, **k: one(spark, text.chat_text(m, "<", ">", **k))
    both = messages(("system", "be brief"), ("user", "hi"), ("assistant", "yo"))
    assert shown(both) == "<system\nbe brief>\n<user\nhi>\n<assistant\nyo>\n"
    assert shown(both, has_system=False, ask=True) == "<user\nbe brief\n\nhi>\n<assistant\nyo>\n<assistant\n"
    assert shown(messages(("system", "s"), ("assistant", "a")), has_system=False) == "<system\ns>\n<assistant\na>\n"
    assert shown(messages(("system", "s")), has_system=False) == "<system\ns>\n"
    assert shown(messages(("system", "s"), ("user", "u")), has_system=False) == "<user\ns\n\nu>\n"


def test_snapshot_patterns(spark):
    fits = lambda path, allow, ignore=(): one(spark, registration.wanted(F.lit(path), allow, ignore))
    assert fits("x/y/config.json", ["*.json"]) and fits("x/y/config.json", ["config.*"]) and not fits("x/config.json", ["*.json"], ["x/*"])
    assert fits("a[1].txt", ["a[[]1].txt"]) and fits("b3", ["b[!12]"]) and not fits("b1", ["b[!12]"]) and not fits("b.", ["b\\."]) and not fits("new\n", ["new"])
    assert not fits("anything", [])


def test_registration_problems(spark):
    row = lambda id, w, p="p", d=1: (id, w, "f", p, "d", d)
    block = spark.createDataFrame([row("a", "w1"), row("a", "w2"), row("b", "w2", None), row(None, "w9"), row("c", " ", d=None)], "id string, base_weights string, framework string, provider string, data_format string, defaults int")
    found = registration.registration_problems(block, spark.createDataFrame([("a",), ("b",), ("z",)], "model_key string"), "a").collect()
    assert {tuple(r) for r in found} == {("a", "id twice"), ("a", "base_weights twice"), ("b", "base_weights twice"), ("b", "no provider"), ("c", "no base_weights"), ("c", "no defaults"), ("c", "not approved"), ("z", "not registered"), ("", "no id")}
    assert [r["problem"] for r in registration.registration_problems(block.limit(0), spark.createDataFrame([], "model_key string"), "q").collect()] == ["default not registered"]


def test_measurements(spark):
    runs = spark.createDataFrame([("a", "lora", "ok", 5.0), ("a", "qlora", "ok", 7.0), ("b", "lora", "failed", 9.0), ("c", None, "ok", None)], "model_key string, method string, status string, required double")
    assert [tuple(r) for r in measurements.required_memory(runs).collect()] == [("a", 7.0)]
    assert {tuple(r) for r in measurements.measured_models(runs).collect()} == {("a", True), ("b", True), ("c", False)}
    points = spark.createDataFrame([("x", 100, 10, 1000), ("x", 400, 10, 1600), ("y", 5, 1, 9), ("y", 0, 0, 3)], "shape string, file_bytes long, examples long, ingest_bytes long")
    assert {tuple(r) for r in measurements.shape_fit(points, "shape").collect()} == {("x", 2.0, 80.0), ("y", None, None)}


def test_model_rules_sizes_beyond_a_long(spark, tmp_path):
    keys = [149_999, 211_400, 899_999, 9_000_000]  # from the second on the bytes are more than a long holds
    spark.createDataFrame([(k, k % 100) for k in keys], "o_orderkey long, o_custkey long").coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    got = {r["o_orderkey"]: r["size"] for r in rule_queries.model_rules(spark, str(tmp_path)).collect()}
    assert got == {k: f"{float(k**3 * 977) / 1024**5:.2f} PiB" for k in keys}
