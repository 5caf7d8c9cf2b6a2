"""A dataset folder checked and packaged, and the commands for it."""

import hashlib
import json
from pathlib import Path

import public_tokenizers
import pytest

from quillspark.codes import Refused
from quillspark.operators import masking
from quillspark.plans import package, profiles


def folder(path, **splits):
    path.mkdir(parents=True, exist_ok=True)
    for split, rows in splits.items():
        (path / f"{split}.jsonl").write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows), encoding="utf-8")
    return str(path)


def pair(i, answer="a"):
    return {"prompt": f"p{i}", "completion": f"{answer} {i} é"}


def canonical(rows):
    line = lambda r: json.dumps({"messages": [{"content": r["prompt"], "role": "user"}, {"content": r["completion"], "role": "assistant"}]}, ensure_ascii=False)
    return "".join(line(r) + "\n" for r in rows).encode()


def test_package_and_verify(spark, tmp_path):
    splits = {"train": [pair(i) for i in range(300)] + [pair(0)], "validation": [pair(i, "b") for i in range(5)]}
    out = str(tmp_path / "out")
    made = package.package(spark, folder(tmp_path / "in", **splits), out, masking.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    for split, rows in splits.items():
        data = canonical(rows)
        said = made["splits"][split]
        assert (said["examples"], said["bytes"], said["sha256"]) == (len(rows), len(data), hashlib.sha256(data).hexdigest())
    assert made["report"]["verdict"] == "accepted" and [f["code"] for f in made["report"]["findings"]] == ["DUPLICATES"]
    assert json.loads(Path(out, "manifest.json").read_text()) == made and package.verify(spark, out) == []
    Path(out, "train", made["splits"]["train"]["parts"][0]["file"]).write_bytes(b"{}\n")
    assert package.verify(spark, out) == [f"train/{made['splits']['train']['parts'][0]['file']}: changed"]
    assert package.verify(spark, str(tmp_path / "in")) == ["no manifest"]


def test_what_is_refused_writes_nothing(spark, tmp_path, capsys):
    leak = folder(tmp_path / "leak", train=[pair(0), pair(1)], test=[pair(1)])
    with pytest.raises(Refused) as refused:
        package.package(spark, leak, str(tmp_path / "out"))
    assert refused.value.code == "DATASET_SPLIT_LEAKAGE" and refused.value.details["findings"][0]["n"] == 1
    bad = folder(tmp_path / "bad", train=[pair(0), {"prompt": "p", "completion": 1}], validation=[pair(5)])
    with pytest.raises(Refused) as refused:
        package.package(spark, bad, str(tmp_path / "out"))
    assert (refused.value.code, refused.value.details["split"], refused.value.details["line_no"]) == ("DATASET_SCHEMA_UNKNOWN", "train", 2)
    assert not (tmp_path / "out").exists()
    assert profiles.main(["package", bad, "--out", str(tmp_path / "out")]) == 1 and json.loads(capsys.readouterr().out.splitlines()[-1])["code"] == "DATASET_SCHEMA_UNKNOWN"


def test_list_command(spark, tmp_path, capsys):
    rows = [{"source_id": "b", "enabled": True, "intended_use": ["training"], "revision": "a" * 40, "tier": 1}, {"source_id": "a", "enabled": False, "intended_use": [], "revision": "x", "tier": 1}]
    (tmp_path / "sources.jsonl").write_text("\n".join(map(json.dumps, rows)))
    assert profiles.main(["list", str(tmp_path / "sources.jsonl")]) == 0
    got = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert [(r["source_id"], r["usable"], r["reason"]) for r in got] == [("a", False, "disabled"), ("b", True, None)]
