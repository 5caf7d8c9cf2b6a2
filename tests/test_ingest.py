import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from quillspark.codes import DATASET_CODES, Refused, raise_first
from quillspark.plans import profiles
from quillspark.sources import datasets, jsonl

GOOD = '{"prompt": "p", "completion": "c"}'
CASES = {
    "two families in a record": ([GOOD, '{"completion": "x", "output": "y", "prompt": "z", "instruction": "w"}', GOOD], 2, "DATASET_SCHEMA_MIXED"),
    "another family later": ([GOOD] * 2 + ['{"instruction": "list two rivers", "output": "Ebro, Po"}'], 3, "DATASET_SCHEMA_MIXED"),
    "blank answer": (['{"instruction": "say nothing", "output": "\\t \\u2003"}', GOOD], 1, "DATASET_TARGET_EMPTY"),
    "role of another scheme": (['{"messages": [{"role": "user", "content": "hi"}, {"role": "Assistant", "content": "ho"}]}'], 1, "DATASET_ROLE_INVALID"),
    "no known key": ([GOOD, '{"text": "a line of prose"}'], 2, "DATASET_SCHEMA_UNKNOWN"),
    "cut short": ([GOOD, "", "", '{"prompt": "p", "completion": "cut sho'], 4, "DATASET_INVALID_JSON"),
    "a bare string": (['"just text"', GOOD], 1, "DATASET_INVALID_JSON"),
    "two values": ([GOOD, GOOD + GOOD], 2, "DATASET_INVALID_JSON"),
    "boolean answer": (['{"prompt": "p", "completion": true}'], 1, "DATASET_SCHEMA_UNKNOWN"),
    "half a character": ([GOOD, '{"prompt": "p", "completion": "c \\uDC01"}'], 2, "DATASET_INVALID_JSON"),
    "object as input": (['{"instruction": "i", "input": {"a": 1}, "output": "o"}'], 1, "DATASET_SCHEMA_UNKNOWN"),
    "messages that are no list": (['{"messages": {"role": "user", "content": "x"}}'], 1, "DATASET_SCHEMA_UNKNOWN"),
}


def read(spark, tmp_path, data):
    (tmp_path / "train.jsonl").write_bytes(data)
    return jsonl.normalize(jsonl.read_lines(spark, {"train": str(tmp_path / "train.jsonl")}))


@pytest.mark.parametrize("case", CASES)
def test_first_error(spark, tmp_path, case):
    lines, number, code = CASES[case]
    assert code in DATASET_CODES
    got = read(spark, tmp_path, "\n".join(lines).encode())
    with pytest.raises(Refused) as refused:
        raise_first(got)
    assert (refused.value.code, refused.value.details["line_no"]) == (code, number)
    assert "sho" not in str(refused.value)


def test_invalid_utf8_and_long_lines(spark, tmp_path):
    got = read(spark, tmp_path, GOOD.encode() + b"\n\n\xff\xfe\n" + b"x" * (4 * 1024 * 1024 + 1))
    assert {r["line_no"]: r["code"] for r in got.collect()} == {1: None, 3: "DATASET_INVALID_UTF8", 4: "DATASET_LINE_TOO_LARGE"}


def test_line_numbers_over_many_input_splits(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        (tmp_path / "a.txt").write_text("".join(f"{i}\r\u2028{'x' * (i % 37)}\n" for i in range(1, 1500)) + "1500")
        got = jsonl.read_lines(spark, {"train": str(tmp_path / "a.txt")})
        assert got.rdd.getNumPartitions() > 5 or got.count() == 1500
        rows = got.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 1500 and all(int(r["value"].split("\r")[0]) == r["line_no"] for r in rows)


def test_line_numbers_over_the_parts_of_a_file(spark, tmp_path):
    (tmp_path / "t").mkdir()
    for p in range(5):
        (tmp_path / "t" / f"part-{p:05}.txt").write_text("".join(f"{i}{'x' * (i % 37)}\n" for i in range(p * 300 + 1, p * 300 + 301)).replace("x", " "))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = jsonl.read_lines(spark, {"train": str(tmp_path / "t")}, joined_parts=True).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 1500 and all(int(r["value"]) == r["line_no"] for r in rows)


def test_every_kind_of_bad_line(spark, tmp_path):
    lines = ['{"prompt": "a", "completion": "b"}', "", '{"prompt": "a",, }', "[1]", '{"prompt": "a", "completion": "  "}', '{"messages": [{"role": "tool", "content": "x"}]}', '{"question": 1}', '{"prompt": "a", "output": "b"}', '{"prompt": 1, "completion": "b"}', '{"messages": [{"role": "user", "content": "x"}, {"role": "assistant", "content": "y"}]}']
    got = {r["line_no"]: r["code"] for r in read(spark, tmp_path, "\n".join(lines).encode()).collect()}
    codes = [None, "INVALID_JSON", "INVALID_JSON", "TARGET_EMPTY", "SCHEMA_MIXED", "SCHEMA_UNKNOWN", "SCHEMA_MIXED", "SCHEMA_UNKNOWN", "SCHEMA_MIXED"]
    assert got == dict(zip([1, *range(3, 11)], (c and f"DATASET_{c}" for c in codes)))


def test_error_report_covers_all_documents(spark):
    from quillspark.queries import QUERIES
    from tests.oracle import SF

    n = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id % 23 <> 0 or doc_id % 20011 = 11").count()
    assert QUERIES["jsonl_error_report"](spark, SF).count() == n


def test_texts_of_refused_lines_and_other_columns(spark):
    lines = ['{"prompt": "a", "completion": "b"}', '{"prompt": "c", "completion": " "}', '{"instruction": "d", "output": "e"}', '{"prompt": 1, "completion": "f"}', '{"prompt": "g", "completion": "' + "x" * 99 + '"}']
    rows = spark.createDataFrame([("train", i, f"mark {i}", v) for i, v in enumerate(lines)], "split string, line_no long, mark string, value string")
    codes = [None, "DATASET_TARGET_EMPTY", "DATASET_SCHEMA_MIXED", "DATASET_SCHEMA_UNKNOWN", "DATASET_LINE_TOO_LARGE"]
    for only, texts in ((True, [["a", "b"], None, None, None, None]), (False, [["a", "b"], ["c", " "], ["d", "e"], None, None])):
        got = jsonl.normalize(rows, max_bytes=90, examples_only=only).orderBy("line_no").collect()
        assert [(r["mark"], r["code"], r["messages"] and [m["content"] for m in r["messages"]]) for r in got] == [(f"mark {i}", c, t) for i, (c, t) in enumerate(zip(codes, texts))]


def test_families_and_cap(spark, tmp_path):
    lines = ['{"instruction": "i", "input": "x", "output": "o"}', '{"instruction": "i", "input": 0, "output": "o"}', '{"output": "o", "instruction": "j", "output": "last"}']
    (tmp_path / "t.jsonl").write_text("\n".join(lines) + "\n")
    read_ = jsonl.read_lines(spark, {"train": str(tmp_path / "t.jsonl")})
    got = jsonl.normalize(read_).orderBy("line_no").collect()
    assert [[m["content"] for m in r["messages"]] for r in got] == [["i\n\nx", "o"], ["i", "o"], ["j", "last"]]
    capped = jsonl.normalize(read_, max_examples=1)
    assert {r["line_no"]: r["code"] for r in capped.collect()} == {1: None, 2: "DATASET_TOO_MANY_EXAMPLES", 3: None}


def test_lenient_rule(spark):
    raw = ['{"instruction": "i", "context": "c", "response": "r"}', '{"prompt": 5, "response": "r"}', '{"instruction": "i", "input": "", "output": "o", "prompt": "p"}']
    refused = ['{"prompt": "p", "output": "o"}', '{"instruction": "i", "completion": "c"}', '{"messages": [{"role": "bot", "content": "x"}]}', '{"prompt": "p", "completion": "  "}', '{"x": 1}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(raw + refused)], "i int, raw string")
    got = [r["messages"] and [m["content"] for m in r["messages"]] for r in jsonl.lenient(df).orderBy("i").collect()]
    assert got == [["i\n\nc", "r"], ["5", "r"], ["i", "o"]] + [None] * 5


def test_inputs_that_are_blank_or_padded(spark, tmp_path):
    lines = ['{"instruction": " i", "input": "  ", "output": "o"}', '{"instruction": " i", "input": "x ", "output": "o"}']
    got = read(spark, tmp_path, "\n".join(lines).encode()).orderBy("line_no").collect()
    assert [r["messages"][0]["content"] for r in got] == [" i", "i\n\nx"]


def test_conversations_are_strict(spark):
    from quillspark.sources import adapters

    good = '[{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]'
    texts = [good, good + " tail", '[{"role": "assistant", "content": 5}]', '[{"role": "assistant", "content": {"a": "b"}}]', "[]", None, "", '[{"role": "user", "content": "a"}]', good.replace('"b"', '" "')]
    df = spark.createDataFrame([(i, str(i), t) for i, t in enumerate(texts)] + [(90, " ", good)], "i int, conversations_id string, conversations string")
    assert {r["i"] for r in adapters.adapt("conversation", df).filter("valid").collect()} == {0}


@pytest.mark.parametrize("names, root, code", [
    (["a/b/train.jsonl", "a/b/val.jsonl", "__MACOSX/a/x"], ["train.jsonl", "val.jsonl"], None), (["train.jsonl", "a/x.txt"], ["a/x.txt", "train.jsonl"], None), (["w/inner.zip"], None, "DATASET_ARCHIVE_NESTED"),
    (["x.zip", "y.ZIP", "t"], None, "DATASET_SPLIT_AMBIGUOUS"), (["1/2/3/4/5/train.jsonl"], ["5/train.jsonl"], None),
])
def test_content_root(spark, names, root, code):
    files = spark.createDataFrame([(n, 1) for n in names], "path string, size long")
    if code:
        with pytest.raises(Refused) as refused:
            datasets.content_root(files)
        assert refused.value.code == code
    else:
        assert sorted(r["path"] for r in datasets.content_root(files).collect()) == root


def test_input_target_and_evaluation_rows(spark):
    from quillspark.sources import adapters

    pairs = adapters.adapt("input_target", spark.createDataFrame([("q", "a"), (" ", "a"), ("q", None)], "inputs string, targets string")).collect()
    assert [r["valid"] for r in pairs] == [True, False, False] and [m["content"] for m in pairs[0]["messages"]] == ["q", "a"]
    kind = "id string, label string, prompts array<struct<question:string,mcq_options:string,mcq:string>>, metadata struct<language:string,category:string,topic:string>"
    rows = [("1", "A", [("q", "o", "m")], ("tl", "", "")), ("2", "A", [("q", " ", "m")], ("tl", "", "")), ("3", "A", [], ("tl", "", "")), ("4", "", [("q", "o", "m")], ("tl", "", "")), ("5", "A", [("q", "o", "m")], ("tl", None, ""))]
    got = {r["id"]: r["valid"] for r in adapters.adapt("evaluation", spark.createDataFrame(rows, kind)).collect()}
    assert got == {"1": True, "2": False, "3": False, "4": False, "5": False}
    with pytest.raises(Refused):
        adapters.adapt("unheard of", spark.range(1))


@pytest.mark.parametrize("names, code", [
    (["train.jsonl", "validation.jsonl", "val.jsonl"], "DATASET_SPLIT_AMBIGUOUS"), (["train.jsonl", "backup/train.jsonl"], "DATASET_SPLIT_AMBIGUOUS"), (["validation.jsonl"], "DATASET_SPLIT_MISSING"),
    (["train.jsonl", "val.jsonl", "__MACOSX/train.jsonl", "notes.txt"], None),
])
def test_split_resolution(spark, tmp_path, names, code):
    for n in names:
        (tmp_path / n).parent.mkdir(exist_ok=True)
        (tmp_path / n).write_text(GOOD)
    if code:
        with pytest.raises(Refused) as refused:
            datasets.split_paths(spark, str(tmp_path))
        assert refused.value.code == code
    else:
        assert sorted(datasets.split_paths(spark, str(tmp_path))) == ["train", "validation"]


def test_split_sizes(spark):
    df = spark.createDataFrame([("train.jsonl", 600 << 20)], "path string, size long")
    assert datasets.split_code(df).first()["code"] == "DATASET_SPLIT_TOO_LARGE"
    assert datasets.split_code(df.limit(0)).first()["code"] == "DATASET_SPLIT_MISSING"


def source(spark):
    return spark.createDataFrame([(i, f"question {i % 30} é", "" if i % 2 else "context", f"answer {i % 30}") for i in range(60)], "source_index long, instruction string, context string, response string")


PROFILE = profiles.Profile("d", "smoke", "instruction", ("context", "instruction", "response"), "rev", 25)


def test_build_is_the_same_for_any_order_of_rows(spark, tmp_path):
    built = profiles.build(source(spark), PROFILE)
    made = profiles.manifest(built, PROFILE)
    again = profiles.manifest(profiles.build(source(spark).orderBy(F.rand(3)).repartition(5), PROFILE), PROFILE)
    assert made == again and made["splits"]["train"]["exampleCount"] == 25
    datasets.write_canonical(built, str(tmp_path / "out"))
    lines = [x for p in sorted((tmp_path / "out").glob("part-*")) for x in p.read_text().splitlines()]
    want = [json.dumps({"messages": [{"content": m["content"], "role": m["role"]} for m in r["messages"]]}, ensure_ascii=False) for r in built.orderBy("source_index").collect()]
    assert lines == want


def test_approval_tells_every_drift(spark):
    built = profiles.build(source(spark), PROFILE)
    made = profiles.manifest(built, PROFILE)
    approved = profiles.approval(made, built, date(2026, 1, 1))
    assert profiles.verify(made, approved) == []
    for change in ({"sourceRevision": "x"}, {"excludeLanguages": ["tl"]}, {"selectedSourceIndexCount": 1}):
        assert profiles.verify(made | change, approved) == list(change)
    assert profiles.verify(made | {"splits": {}}, approved) == ["split train is not built"]


def test_disjoint_profiles(spark):
    a = profiles.build(source(spark).filter("source_index % 30 < 10"), PROFILE)
    b = profiles.build(source(spark).filter("source_index % 30 between 9 and 20"), PROFILE)
    c = profiles.build(source(spark).filter("source_index % 30 > 20"), PROFILE)
    assert [(r["split_a"], r["split_b"]) for r in profiles.disjoint({"a": a, "b": b, "c": c}).collect()] == [("a", "b")]


def test_evaluation_sources_are_refused(spark):
    with pytest.raises(Refused):
        profiles.build(source(spark), profiles.Profile("d", "p", "instruction", ("response",), "r", usage="evaluation"))
