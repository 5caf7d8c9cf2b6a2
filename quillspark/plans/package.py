"""A dataset folder checked as a whole and packaged as canonical files with one manifest."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..codes import Refused
from ..functions.text import chat_text, record_json
from ..operators import masking, report
from ..operators.tokens import CEILING, TRAIN_BUDGET, whitespace_tokens
from ..sources import datasets, files, jsonl
from ..storage import shared_path

SPLITS = ("train", "validation", "test")
MANIFEST = "manifest.json"
MAX_EXAMPLES = 500_000


def examples(spark: SparkSession, folder: str, max_examples: int = MAX_EXAMPLES, range_bytes: int = files.RANGE) -> DataFrame:
    """(split, line_no, family, messages) of a folder's split files, below its content root. Refuses what split_paths refuses and,
    with split and line, the first error of the first split that has one; a split isn't read beyond that."""
    out = None
    for split, path in datasets.split_paths(spark, folder).items():
        try:
            rows = jsonl.load(spark, path, max_examples, range_bytes=range_bytes).rows
        except Refused as refused:
            raise Refused(refused.code, split=split, **refused.details) from refused
        rows = rows.withColumn("split", F.lit(split))
        out = rows if out is None else out.unionByName(rows)
    return out


def measured(rows: DataFrame, tokenizer: masking.Tokenizer | None, render: Callable[[Column], Column] = chat_text) -> DataFrame:
    """rows with tokens: those of the rendered messages by a tokenizer, or runs of other than white space."""
    text = render(F.col("messages"))
    return rows.withColumn("tokens", whitespace_tokens(text)) if tokenizer is None else masking.token_counts(rows, text, tokenizer, "tokens")


def checked(rows: DataFrame, ceiling: int = CEILING, budget: int = TRAIN_BUDGET) -> dict:
    """The input report on rows (split, messages, tokens), as plain values."""
    found = report.input_report(rows, F.col("split"), F.col("messages"), F.sha2(record_json(F.col("messages")), 256), F.col("tokens"), ceiling, budget).first()
    return {"verdict": found["verdict"], "code": found["code"], "inputs": [r.asDict() for r in found["inputs"]], "findings": [r.asDict() for r in found["findings"]]}


def package(spark: SparkSession, folder: str, out: str, tokenizer: masking.Tokenizer | None = None, max_examples: int = MAX_EXAMPLES, ceiling: int = CEILING, budget: int = TRAIN_BUDGET) -> dict:
    """Check folder, write each split as a canonical file below out, and write and return the manifest: per split the number of
    examples and bytes that the sink committed, and the SHA-256 of the file as read back, with the report.

    A dataset with a finding that rejects is refused with the first one's code, and nothing is written; the other findings are in
    the exception's details. Examples keep the order of their lines. The manifest is written last, so a folder without one holds no
    package."""
    rows = measured(examples(spark, folder, max_examples), tokenizer)
    path = shared_path(spark, "examples")
    rows.write.parquet(path)  # parsed and tokenized once for the report and the files
    rows = spark.read.parquet(path)
    found = checked(rows, ceiling, budget)
    if found["code"]:
        raise Refused(found["code"], findings=found["findings"])
    splits = {}
    for split in (r["split"] for r in found["inputs"]):
        mine = rows.filter(F.col("split") == split).repartitionByRange("line_no").sortWithinPartitions("line_no")
        said = files.write_lines(mine.select(datasets.spaced_json(F.col("messages"))), f"{out.rstrip('/')}/{split}")
        splits[split] = {"examples": said["rows"], "bytes": said["bytes"], "parts": said["parts"]}
    for r in files.digests(spark, out, "folder").collect():  # one row a split
        if r["name"] in splits:
            splits[r["name"]] |= {"sha256": r["sha256"], "read": r["bytes"]}
    for split, made in splits.items():
        if made.pop("read", None) != made["bytes"]:
            raise Refused("ARTIFACT_VERIFICATION_FAILED", "a file is not what was written", split=split)
    manifest = {"splits": splits, "report": found}
    store, where = files.opened(out.rstrip("/"))
    with store.open_output_stream(f"{where}/{MANIFEST}") as file:
        file.write(json.dumps(manifest, sort_keys=True, indent=1).encode())
    return manifest


def verify(spark: SparkSession, out: str) -> list[str]:
    """Problems of a package: a split's folder, file and what is wrong with it; none means that all files are as committed."""
    store, where = files.opened(out.rstrip("/"))
    if store.get_file_info(f"{where}/{MANIFEST}").type.name != "File":
        return ["no manifest"]
    with store.open_input_stream(f"{where}/{MANIFEST}") as file:
        manifest = json.loads(file.read())
    problems = []
    for split, said in manifest["splits"].items():
        try:
            problems += [f"{split}/{r['file']}: {r['problem']}" for r in files.verified(spark, f"{out.rstrip('/')}/{split}").collect()]
            if files.committed(f"{out.rstrip('/')}/{split}")["parts"] != said["parts"]:
                problems.append(f"{split}: another file than the package's")
        except FileNotFoundError:
            problems.append(f"{split}: missing")
    return sorted(problems)


def listing(sources: DataFrame) -> DataFrame:
    """What a registry of sources (source_id, enabled, intended_use, revision, tier) offers, in order: source_id, tier, usable and
    why not, from the same gate that requests pass."""
    from ..operators import policy

    gated = policy.source_gate(sources.select("source_id", "tier"), sources)
    return gated.select("source_id", "tier", (F.col("gate") == "ok").alias("usable"), F.when(F.col("gate") != "ok", F.col("gate")).alias("reason")).orderBy("tier", "source_id")
