"""Files: bounded lines in byte ranges, loading that stops, digests, the canonical sink, and names that collide."""

import hashlib
import json
import random
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quillspark.codes import Refused, raise_first
from quillspark.operators import integrity
from quillspark.sources import files, jsonl

from .test_ingest import CASES, GOOD

ROOT = Path(__file__).resolve().parents[1]


def pieces(data):
    """Lines as they are numbered: only a newline ends one, and the last may lack it."""
    out = data.split(b"\n")
    return out[:-1] if out[-1] == b"" else out


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50, 10_000])
@pytest.mark.parametrize("chunk", [1, 4, 1 << 20])
def test_lines_of_ranges_are_the_lines_of_the_file(tmp_path, size, chunk):
    rnd = random.Random(size * 31 + chunk)
    for k in range(20):
        data = b"".join(rnd.choice([b"\n", b"a", b"bc\r", b"\n\n", b"long" * rnd.randint(1, 9)]) for _ in range(rnd.randint(0, 25)))
        (tmp_path / "f").write_bytes(data)
        got = [line for part in files.ranges(str(tmp_path / "f"), size) for line in files.lines_of(part, 12, chunk)]
        assert [x[1] for x in got] == [x if len(x) <= 12 else None for x in pieces(data)], (k, data)


def test_a_line_of_300_mb_is_never_held(tmp_path):
    path = tmp_path / "big.jsonl"
    with open(path, "wb") as f:
        f.write(b"first\n")
        for _ in range(300):
            f.write(b"x" * (1 << 20))
        f.write(b"\nlast")
    code = f"""
import resource
from quillspark.sources import files
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
reader = files._LineReader({{"path": {str(path)!r}, "maxbytes": str(4 << 20)}})
rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
print(len(rows), [r["value"] for r in rows], [(r["range"], r["place"]) for r in rows], (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout
    assert out.startswith("3 [b'first', None, b'last'] [(0, 0), (0, 1), (4, 0)]") and int(out.split()[-1]) < 200


def test_numbers_and_codes_through_spark(spark, tmp_path):
    lines = [b"x" * (i % 50) for i in range(2000)]
    (tmp_path / "f").write_bytes(b"\n".join(lines))
    got = sorted(map(tuple, jsonl.read_bounded(spark, str(tmp_path / "f"), 40, 1000).collect()))
    assert [g[0] for g in got] == list(range(1, 2001))
    assert [(g[1], g[2]) for g in got] == [(bytearray(x), None) if len(x) <= 40 else (None, "DATASET_LINE_TOO_LARGE") for x in lines]
    (tmp_path / "empty").write_bytes(b"")
    assert jsonl.read_bounded(spark, str(tmp_path / "empty")).count() == 0


@pytest.mark.parametrize("case", list(CASES)[::2])
def test_load_gives_the_first_error(spark, tmp_path, case):
    lines, number, code = CASES[case]
    (tmp_path / "t").write_bytes("\n".join(lines).encode())
    for size in (20, 1 << 20):
        with pytest.raises(Refused) as refused:
            jsonl.load(spark, str(tmp_path / "t"), 100, range_bytes=size)
        assert (refused.value.code, refused.value.details["line_no"]) == (code, number)


def test_load_and_normalize_agree(spark, tmp_path):
    rnd = random.Random(3)
    kinds = [GOOD] * 6 + ["", " ", '{"instruction": "i", "output": "o"}', "{", '{"prompt": 1}', '{"prompt": "p", "completion": " "}', "x" * 400]
    for k in range(4):
        (tmp_path / "t").write_text("\n".join(rnd.choice(kinds) if i > 5 * k else GOOD for i in range(30)))
        with pytest.raises(Refused) as a:
            jsonl.load(spark, str(tmp_path / "t"), 1000, max_bytes=300, range_bytes=90)
        rows = jsonl.read_bounded(spark, str(tmp_path / "t"), 300, 90)
        value = F.coalesce(F.col("value"), F.lit(b"x" * (jsonl.MAX_LINE_BYTES + 1)))
        with pytest.raises(Refused) as b:
            raise_first(jsonl.normalize(rows.select(F.lit("train").alias("split"), "line_no", value.alias("value"))))
        assert (a.value.code, a.value.details["line_no"]) == (b.value.code, b.value.details["line_no"])


def test_loading_stops_where_the_cap_or_an_error_is(spark, tmp_path):
    line = json.dumps({"prompt": "p", "completion": "c" * 80}) + "\n"
    path = str(tmp_path / "t")
    Path(path).write_text(line * 2000)
    total = len(files.ranges(path, 2000))
    assert total > 100
    fine = jsonl.load(spark, path, 2000, range_bytes=2000)
    assert (fine.examples, fine.lines, fine.ranges_read) == (2000, 2000, total) and fine.rows.count() == 2000
    assert fine.rows.agg(F.min("line_no"), F.max("line_no"), F.count_distinct("line_no")).first() == (1, 2000, 2000)
    with pytest.raises(Refused) as refused:
        jsonl.load(spark, path, 30, range_bytes=2000)
    assert (refused.value.code, refused.value.details["line_no"]) == ("DATASET_TOO_MANY_EXAMPLES", 31) and refused.value.details["ranges_read"] <= 3
    Path(path).write_text(line * 100 + "{\n" + line * 1900)
    with pytest.raises(Refused) as refused:
        jsonl.load(spark, path, 10**6, range_bytes=2000)
    assert (refused.value.code, refused.value.details["line_no"]) == ("DATASET_INVALID_JSON", 101) and refused.value.details["ranges_read"] <= 15 < total


def test_lines_are_parsed_by_one_python_evaluation(spark, tmp_path, capsys):
    (tmp_path / "t").write_text(GOOD + "\n" + GOOD)
    jsonl.parsed(jsonl.bounded_lines(spark, str(tmp_path / "t")), ["range", "place"], F.col("value")).explain()
    plan = capsys.readouterr().out
    assert plan.count("MapInArrow") == 1 and "PythonUDF" not in plan and "EvalPython" not in plan


def test_digests_of_files_folders_and_trees(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "two.txt").write_bytes(b"two\n2")
    (tmp_path / "a" / "one.txt").write_bytes(b"")
    (tmp_path / "top.bin").write_bytes(bytes(range(256)) * 9000)
    every = {str(p.relative_to(tmp_path)): p.read_bytes() for p in tmp_path.rglob("*") if p.is_file()}
    got = {r["name"]: (r["bytes"], r["sha256"]) for r in files.digests(spark, str(tmp_path)).collect()}
    assert got == {n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in every.items()}
    folder = {r["name"]: (r["files"], r["sha256"]) for r in files.digests(spark, str(tmp_path), "folder").collect()}
    assert folder["a"] == (2, hashlib.sha256(b"" + b"two\n2").hexdigest())
    plain = hashlib.sha256()
    for n in sorted(every):
        plain.update(n.encode() + b"\0" + every[n] + b"\0")
    tree = files.digests(spark, str(tmp_path), "tree").collect()
    assert [(r["files"], r["sha256"]) for r in tree] == [(3, plain.hexdigest())]
    (tmp_path / "none").mkdir()
    assert files.digests(spark, str(tmp_path / "none")).count() == 0


def test_a_file_of_3_gb(spark, tmp_path):
    with open(tmp_path / "sparse", "wb") as f:
        f.truncate(3 << 30)
    digest = hashlib.sha256()
    for _ in range(3 << 10):
        digest.update(bytes(1 << 20))
    assert [(r["bytes"], r["sha256"]) for r in files.digests(spark, str(tmp_path)).collect()] == [(3 << 30, digest.hexdigest())]


def test_sink_commits_what_its_tasks_wrote(spark, tmp_path):
    path = str(tmp_path / "out")
    lines = [f"línea {i}" for i in range(1000)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, x string").repartitionByRange(5, "i").sortWithinPartitions("i").select("x")
    said = files.write_lines(df, path)
    parts = [Path(path, p["file"]).read_bytes() for p in said["parts"]]
    assert b"".join(parts).decode() == "".join(x + "\n" for x in lines) and len(parts) == 5
    assert said["rows"] == 1000 and said["bytes"] == sum(map(len, parts)) and [p["sha256"] for p in said["parts"]] == [hashlib.sha256(b).hexdigest() for b in parts]
    assert files.verified(spark, path).count() == 0
    Path(path, said["parts"][1]["file"]).write_bytes(b"x")
    Path(path, said["parts"][2]["file"]).unlink()
    Path(path, "more.jsonl").write_bytes(b"y")
    assert {r["problem"] for r in files.verified(spark, path).collect()} == {"changed", "missing", "extra"}
    with pytest.raises(Exception, match="committed"):
        files.write_lines(df, path)
    assert files.write_lines(df, path, overwrite=True)["rows"] == 1000


def test_a_failed_job_leaves_no_manifest(spark, tmp_path):
    path = str(tmp_path / "out")
    bad = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id").cast("string")))
    with pytest.raises(Exception, match="lost"):
        files.write_lines(bad, path)
    with pytest.raises(FileNotFoundError):
        files.committed(path)
    assert not list(Path(path).glob("*.jsonl")) or not Path(path, files.MANIFEST).exists()
    assert files.write_lines(spark.range(0).selectExpr("CAST(id AS string)"), str(tmp_path / "none"))["parts"] == []


def collisions(paths):
    """By hand, over all pairs."""
    names = [([p for p in x.replace("\\", "/").split("/") if p not in ("", ".")], x[-1:] in ("/", "\\")) for x in paths if x]
    all_files = ["/".join(p).lower() for p, folder in names if p and not folder]
    folders = {"/".join(p[:i]).lower() for p, folder in names for i in range(1, len(p) + folder)}
    return {(n, "duplicate") for n in all_files if all_files.count(n) > 1} | {(n, "file and folder") for n in all_files if n in folders}


def test_collisions_in_any_order(spark):
    rnd = random.Random(2)
    for _ in range(5):
        paths = ["/".join(rnd.choices(["a", "B", "b", "c", "."], k=rnd.randint(1, 4))) + rnd.choice(["", "", "/", "\\"]) for _ in range(14)] + [None, "", "x", "X/y"]
        rnd.shuffle(paths)
        df = spark.createDataFrame([(p,) for p in paths], "path string")
        assert {(r["name"], r["problem"]) for r in integrity.path_collisions(df, "path").collect()} == collisions(paths)
    df = spark.createDataFrame([("p", "a"), ("q", "a/b"), (None, "a"), (None, "A")], "z string, path string")
    assert [(r["within"], r["problem"]) for r in integrity.path_collisions(df, "path", "z").collect()] == [(None, "duplicate")]
    assert integrity.path_collisions(df, "path", "z", fold=False).count() == 0


def test_one_folder_of_many_files_is_few_rows(spark):
    df = spark.range(0, 20000, 1, 4).select(F.concat(F.lit("all/in/one/"), F.col("id").cast("string")).alias("path")).union(spark.sql("SELECT 'all/in'"))
    got = integrity.path_collisions(df, "path").collect()
    assert [(r["name"], r["problem"], r["files"], r["below"]) for r in got] == [("all/in", "file and folder", 1, 20000)]


def test_small_ranges_share_tasks(spark, tmp_path):
    (tmp_path / "t").write_bytes(b"".join(b"%d\n" % i for i in range(20_000)))
    (tmp_path / "u").write_bytes(b"x" * 500 + b"\nlast")
    for path, size in ((tmp_path / "t", 64), (tmp_path, 1 << 10)):
        lines = jsonl.bounded_lines(spark, str(path), 400, size)
        assert lines.rdd.getNumPartitions() == 1 < len(files.ranges(str(path), size))
        want = b"".join((tmp_path / n).read_bytes() for n in ("t", "u")[: 1 + (path == tmp_path)]).split(b"\n")
        want = want[:-1] if not want[-1] else want
        got = sorted((r["line_no"], r["value"]) for r in jsonl.read_bounded(spark, str(path), 400, size).collect())
        assert got == [(i + 1, None if len(w) > 400 else w) for i, w in enumerate(want)]
    some = [files.Range(i, "f", 0, n) for i, n in enumerate([3, 3, 3, 20, 1, 9])]
    assert [[r.number for r in p.ranges] for p in files.packed(some, 10)] == [[0, 1, 2], [3], [4, 5]]


def test_batches_and_parsed_rows_are_bounded_by_bytes(spark):
    from quillspark.storage import small_batches

    def rows(batches):
        for batch in batches:
            yield batch.from_arrays([[batch.num_rows]], ["n"])

    lines = spark.range(0, 24, 1, 1).select(F.lit("s").alias("split"), F.col("id").alias("line_no"), F.to_binary(F.concat(F.lit('{"prompt": "p", "completion": "'), F.repeat(F.lit("x"), 1 << 20), F.lit('"}')), F.lit("utf-8")).alias("value"))
    old = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    with small_batches(spark):
        assert max(r["n"] for r in lines.mapInArrow(rows, "n long").collect()) <= 5
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == old
    parsed = jsonl.parsed(lines, ["split", "line_no"], F.col("value"))
    sizes = parsed.select("messages").mapInArrow(rows, "n long").collect()
    assert sum(r["n"] for r in sizes) == 24
    assert [r["line_no"] for r in parsed.filter("code is null and family = 'prompt_completion'").orderBy("line_no").collect()] == list(range(24))
