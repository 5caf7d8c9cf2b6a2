"""Snapshots with all their problems, and the evaluation corpus as a job."""

import hashlib
import json
import os

import pytest

from quillspark.codes import Refused
from quillspark.operators import integrity
from quillspark.plans import evaluation, profiles, snapshot
from quillspark.sources import files

ROWS = "path string, size long, sha256 string"


def plain_problems(listed, disk, total, needed):
    """The rules in a loop over the listing."""
    out, read, size = [], set(), 0
    for path in {p for p, _, _ in listed}:
        mine = [(n, d) for p, n, d in listed if p == path]
        if len(mine) > 1:
            out.append((path, "repeated"))
        if not path:
            out.append((path, "no path"))
        elif "\\" in path or ":" in path or any(p in ("", ".", "..") for p in path.split("/")):
            out.append((path, "unsafe path"))
        elif path in disk and disk[path][2]:
            out.append((path, "symlink"))
        elif path not in disk:
            out.append((path, "missing"))
        else:
            read.add(path)
            size += disk[path][0] * len(mine)
            out += [(path, "size")] * any(n != disk[path][0] for n, _ in mine) + [(path, "sha256")] * any(d != disk[path][1] for _, d in mine)
    out += [(p, "unlisted") for p in disk if p not in read]
    out += [(None, "total")] * (size != total) + [(None, "no needed file")] * (not any(p.endswith(needed) for p in read))
    return sorted(out, key=str)


@pytest.mark.parametrize("total, needed", [(9, ".bin"), (20, ".bin"), (None, ".none")])
def test_all_problems(spark, total, needed):
    listed = [("a.bin", 4, "x"), ("a.bin", 4, "x"), ("b", 1, "y"), ("b", 2, "y"), ("c", 1, "z"), ("link", 1, "l"), ("d/../c", 1, "z"), ("/c", 1, "z"), ("c:d", 1, "z"), ("c\\d", 1, "z"), ("./c", 1, "z"), ("", 1, "q"), (None, 1, "q"), (None, None, None), ("gone", 1, "g"), ("n", None, None)]
    disk = {"a.bin": (4, "x", False), "b": (1, "other", False), "c": (1, "z", False), "link": (None, None, True), "n": (3, "n", False), "extra": (5, "e", False), "d\\e": (1, "f", False)}
    found = integrity.snapshot_problems(spark.createDataFrame(listed, ROWS), spark.createDataFrame([(p, *v) for p, v in disk.items()], ROWS + ", link boolean"), total, needed)
    assert sorted(map(tuple, found.collect()), key=str) == plain_problems(listed, disk, total, needed)


def test_empty_sides(spark):
    none = spark.createDataFrame([], ROWS)
    bare = spark.createDataFrame([], ROWS + ", link boolean")
    assert [tuple(r) for r in integrity.snapshot_problems(none, bare, 0, ".w").collect()] == [(None, "no needed file")]


def test_snapshot_folder(spark, tmp_path):
    files = {"w/one.safetensors": b"abc" * 1000, "config.json": b"{}", ".hidden": b"h", "_under": b"", "w/.deep/x": b"x"}
    for name, data in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    folder, problems = str(tmp_path), lambda **k: sorted(map(tuple, snapshot.verify(spark, str(tmp_path), **k).collect()), key=str)
    assert problems() == [(None, "no manifest")]
    made = snapshot.write(spark, folder, "k", "org/m", "a" * 40)
    assert made["files"] == [{"path": p, "bytes": len(d), "sha256": hashlib.sha256(d).hexdigest()} for p, d in sorted(files.items())] and made["totalBytes"] == sum(map(len, files.values()))
    assert problems() == [] and problems(modelKey="k", modelId="org/m", revision="a" * 40) == []
    assert problems(modelKey="other", revision="b" * 40) == [(None, "modelKey"), (None, "revision")]
    (tmp_path / "config.json").write_bytes(b"[]")
    (tmp_path / "new").write_bytes(b"n")
    os.symlink("/etc/hostname", tmp_path / "w" / "link")
    os.symlink("/etc", tmp_path / "folder")
    assert problems() == [("config.json", "sha256"), ("folder", "unlisted"), ("new", "unlisted"), ("w/link", "unlisted")]
    with pytest.raises(Refused) as refused:
        snapshot.write(spark, folder, "k", "org/m", "a" * 40)
    assert refused.value.details["links"] == ["folder", "w/link"]
    made["files"].append({"path": "w/link", "bytes": 1, "sha256": ""})
    (tmp_path / snapshot.MANIFEST).write_text(json.dumps(made | {"formatVersion": 2}))
    assert (None, "formatVersion") in problems() and ("w/link", "symlink") in problems()
    (tmp_path / snapshot.MANIFEST).write_text("{broken")
    assert problems() == [(None, "manifest can't be read")]


def test_links_are_not_followed(spark, tmp_path):
    (tmp_path / "w" / "deep").mkdir(parents=True)
    for name in ("one.safetensors", "w/two", "w/deep/three", "w2"):
        (tmp_path / name).write_bytes(b"x")
    snapshot.write(spark, str(tmp_path), "k", "org/m", "a" * 40)
    # A folder that links back to its top: who follows it reads every file again and again, until the path has too many links.
    os.symlink(tmp_path, tmp_path / "w" / "top")
    os.symlink(tmp_path / "w" / "deep", tmp_path / "w" / "deep" / "self")
    os.symlink(tmp_path / "gone", tmp_path / "w3")
    seen, selector = [], files.fs.FileSelector
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(files.fs, "FileSelector", lambda where, **how: seen.append((where, how.get("recursive", False))) or selector(where, **how))
        found = files.listed(str(tmp_path), True, set(files.links(str(tmp_path))))
    assert sorted(seen) == [(str(tmp_path / p), False) for p in ("", "w", "w/deep")]
    assert [p[len(str(tmp_path)) + 1 :] for p, _ in found] == ["one.safetensors", snapshot.MANIFEST, "w/deep/three", "w/two", "w2"]
    assert sorted(map(tuple, snapshot.verify(spark, str(tmp_path)).collect())) == [("w/deep/self", "unlisted"), ("w/top", "unlisted"), ("w3", "unlisted")]


RECORD = "i long, id string, label string, prompts array<struct<question:string,mcq_options:string,mcq:string>>, metadata struct<language:string,category:string,topic:string,other:string>, extra int"


def record(i, label="A é \"\\/"):
    return {"i": i, "id": f"r{i}", "label": label, "prompts": [{"question": f"q{i}\n\t", "mcq_options": "(a)", "mcq": "m\x7f"}] * (1 + i % 2), "metadata": {"language": "tl", "category": "", "topic": f"t{i % 3}", "other": "o"}, "extra": i}


def registry(spark, use="evaluation_only", revision="a" * 40, enabled=True):
    return spark.createDataFrame([("held", enabled, [use], revision)], "source_id string, enabled boolean, intended_use array<string>, revision string")


def profile(**k):
    return profiles.Profile(**{"dataset_id": "held", "name": "full", "kind": "evaluation", "key_fields": ("id", "label", "prompts", "metadata"), "revision": "a" * 40, "strategy": "all", "count": 40} | k)


def test_evaluation_job(spark, tmp_path):
    rows = [record(i) for i in range(39, -1, -1)]
    source = spark.createDataFrame(rows, RECORD).repartition(5)
    made = evaluation.build(source, registry(spark), profile(), str(tmp_path / "out"), "i")
    keep = lambda r: {"id": r["id"], "label": r["label"], "prompts": r["prompts"], "metadata": {k: r["metadata"][k] for k in ("language", "category", "topic")}}
    wanted = [keep(record(i)) for i in range(40)]
    data = "".join(json.dumps(r, ensure_ascii=False, sort_keys=True) + "\n" for r in wanted).encode()
    parts = sorted((tmp_path / "out" / "evaluation").glob("part-*.jsonl"))
    assert b"".join(p.read_bytes() for p in parts) == data
    prints = sorted({hashlib.sha256(json.dumps(r, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:16] for r in wanted})
    assert "".join(p.read_text() for p in sorted((tmp_path / "out" / "fingerprints").glob("part-*"))).split() == prints
    assert made["splits"] == {"evaluation": {"exampleCount": 40, "sha256": hashlib.sha256(data).hexdigest(), "bytes": len(data)}}
    assert (made["fingerprintCount"], made["fingerprintDigest"]) == (len(prints), hashlib.sha256("\n".join(prints).encode()).hexdigest())
    assert (made["selectedSourceIndexCount"], made["selectedSourceIndexDigest"]) == (40, hashlib.sha256(json.dumps(list(range(40)), separators=(",", ":")).encode()).hexdigest())
    assert json.loads((tmp_path / "out" / "manifest.json").read_text()) | {"problems": None} == made
    again = evaluation.build(source, registry(spark), profile(), str(tmp_path / "again"), "i", approved=made)
    assert again["problems"] == []
    fewer = evaluation.build(source, registry(spark), profile(strategy="stable_hash", count=7), str(tmp_path / "few"), "i", approved=made)
    assert fewer["splits"]["evaluation"]["exampleCount"] == 7 and "split evaluation: exampleCount" in fewer["problems"]


def test_evaluation_refusals(spark, tmp_path):
    source = spark.createDataFrame([record(i) for i in range(3)] + [record(3, " ") | {"id": None}], RECORD)
    few = profile(count=4)
    for sources, reason in ((registry(spark, "training"), "not evaluation only"), (registry(spark, revision="main"), "unpinned"), (registry(spark, enabled=False), "disabled"), (registry(spark, revision="b" * 40), "another revision"), (registry(spark).filter("false"), "unknown")):
        with pytest.raises(Refused, match=reason):
            evaluation.build(source, sources, few, str(tmp_path / "out"), "i")
    with pytest.raises(Refused, match="number of rows"):
        evaluation.build(source, registry(spark), profile(count=5), str(tmp_path / "out"), "i")
    with pytest.raises(Refused) as refused:
        evaluation.build(source, registry(spark), few, str(tmp_path / "out"), "i")
    assert refused.value.details == {"source_index": 3, "rows": 1} and not (tmp_path / "out").exists()
    empty = evaluation.build(source.limit(0), registry(spark), profile(count=0), str(tmp_path / "none"), "i")
    assert empty["splits"]["evaluation"] == {"exampleCount": 0, "sha256": hashlib.sha256(b"").hexdigest(), "bytes": 0}


def test_evaluate_command(spark, tmp_path, capsys):
    spark.createDataFrame([record(i) for i in range(40)], RECORD).write.parquet(str(tmp_path / "in"))
    (tmp_path / "registry.jsonl").write_text(json.dumps({"source_id": "held", "enabled": True, "intended_use": ["evaluation_only"], "revision": "a" * 40}) + "\n")
    fields = {"dataset_id": "held", "name": "full", "kind": "evaluation", "key_fields": ["id", "label"], "revision": "a" * 40, "strategy": "all", "count": 40}
    command = ["evaluate", str(tmp_path / "in"), "--profile", json.dumps(fields), "--out", str(tmp_path / "out"), "--registry", str(tmp_path / "registry.jsonl"), "--order", "i"]
    assert profiles.main(command) == 0 and json.loads(capsys.readouterr().out)["splits"]["evaluation"]["exampleCount"] == 40
    (tmp_path / "approval.json").write_text(json.dumps({"splits": {}}))
    assert profiles.main([*command[:-4], "--registry", str(tmp_path / "registry.jsonl"), "--order", "i", "--approval", str(tmp_path / "approval.json"), "--out", str(tmp_path / "out2")]) == 1
