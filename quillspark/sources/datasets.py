"""Datasets as folders of split files, and canonical files written from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..codes import Refused
from ..functions.text import record_json
from ..operators.digests import sequence_digest
from ..operators.integrity import foreign_task

#: File names of each split (fixed values).
SPLIT_FILES = {"train": ["train.jsonl"], "validation": ["validation.jsonl", "val.jsonl"], "test": ["test.jsonl"]}
IGNORED = ["__MACOSX", ".git", ".ipynb_checkpoints"]
MAX_SPLIT_BYTES, MAX_DATASET_BYTES = 512 << 20, 1 << 30


def file_table(spark: SparkSession, folder: str) -> DataFrame:
    """Files below folder, without reading them: path (below folder), full, size."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    return files.select(F.substring_index("path", folder.rstrip("/") + "/", -1).alias("path"), F.col("path").alias("full"), F.col("length").alias("size"))


def content_root(files: DataFrame, depth: int = 4) -> DataFrame:
    """A listing (path, size) below its content root: folders that hold nothing but one folder are descended into, at most
    depth of them; macOS' own folder doesn't count. Refuses a listing that is one archive, or has several at the top."""
    files = files.filter(~F.col("path").startswith("__MACOSX"))
    zipped = lambda c: F.lower(c).endswith(".zip")
    for step in range(depth + 1):
        top = F.substring_index("path", "/", 1)
        seen = files.agg(F.count_distinct(top).alias("tops"), F.min(top).alias("name"), F.count_if(F.contains("path", F.lit("/"))).alias("deep"), F.count_if(~F.contains("path", F.lit("/")) & zipped(F.col("path"))).alias("zips")).first()
        if seen["zips"] > 1:
            raise Refused("DATASET_SPLIT_AMBIGUOUS", "more than one archive")
        if seen["tops"] == 1 and seen["zips"] == 1:
            raise Refused("DATASET_ARCHIVE_NESTED", member=seen["name"])
        if seen["tops"] != 1 or not seen["deep"] or step == depth:
            return files
        files = files.withColumn("path", F.expr(f"substr(path, {len(seen['name']) + 2})"))
    return files


def split_code(files: DataFrame) -> DataFrame:
    """One row: code and split of the first rule that a listing (path, size) breaks, else nulls.

    In order: a split's file name below the top, two files for one split, no train file, a split or all of them too large."""
    names = {f: s for s, fs in SPLIT_FILES.items() for f in fs}
    table = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    parts = F.split("path", "/")
    one = files.filter(~F.arrays_overlap(parts, F.array(*map(F.lit, IGNORED)))).select(F.try_element_at(table, F.element_at(parts, -1)).alias("split"), (F.size(parts) > 1).alias("deep"), "size").filter("split is not null")
    by = one.groupBy("split").agg(F.count_if("deep").alias("deep"), F.count_if(~F.col("deep")).alias("top"), F.sum(F.when(~F.col("deep"), F.col("size"))).alias("bytes"))
    m = by.agg(F.min(F.when(F.col("deep") > 0, F.col("split"))).alias("stray"), F.min(F.when(F.col("top") > 1, F.col("split"))).alias("two"), F.count_if((F.col("split") == "train") & (F.col("top") > 0)).alias("train"), F.min(F.when(F.col("bytes") > MAX_SPLIT_BYTES, F.col("split"))).alias("big"), F.sum("bytes").alias("total"))
    code = F.when(F.coalesce("stray", "two").isNotNull(), "DATASET_SPLIT_AMBIGUOUS").when(F.col("train") == 0, "DATASET_SPLIT_MISSING").when(F.col("big").isNotNull() | (F.col("total") > MAX_DATASET_BYTES), "DATASET_SPLIT_TOO_LARGE")
    return m.select(code.alias("code"), F.coalesce("stray", "two", F.when(F.col("train") == 0, "train"), "big").alias("split"))


def split_paths(spark: SparkSession, folder: str) -> dict[str, str]:
    """The path of each split's file in folder, below its content root; refuses what split_code names, and, where there is no
    train file, the layout of another task by its name."""
    files = content_root(file_table(spark, folder))
    found = split_code(files).first()
    if found["code"] == "DATASET_SPLIT_MISSING" and (task := foreign_task(files).first()["task"]):
        raise Refused("DATASET_WRONG_PIPELINE", task=task)
    if found["code"]:
        raise Refused(found["code"], split=found["split"])
    rows = files.filter(F.col("path").isin([f for fs in SPLIT_FILES.values() for f in fs])).select("path", "full").collect()  # at most one a split
    return {s: r["full"] for s, fs in SPLIT_FILES.items() for r in rows if r["path"] in fs}


def _spaced(**fields: F.Column) -> F.Column:
    """A JSON object of JSON texts, keys sorted, a blank after each comma and colon."""
    return F.concat(F.lit("{"), F.concat_ws(", ", *(F.concat(F.lit(f'"{k}": '), fields[k]) for k in sorted(fields))), F.lit("}"))


def _text(c: F.Column) -> F.Column:
    return F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)


def _list(items: F.Column) -> F.Column:
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def spaced_json(messages) -> F.Column:
    """The record's JSON line as the canonical files have it: sorted keys, a blank after each comma and colon outside strings."""
    return _spaced(messages=_list(F.transform(messages, lambda m: _spaced(content=_text(m["content"]), role=_text(m["role"])))))


def spaced_evaluation() -> F.Column:
    """As spaced_json, of an evaluation record's columns id, label, prompts and metadata; fields of other names are left out."""
    some = lambda of, *names: _spaced(**{n: _text(of[n]) for n in names})
    prompts = _list(F.transform("prompts", lambda p: some(p, "question", "mcq_options", "mcq")))
    return _spaced(id=_text(F.col("id")), label=_text(F.col("label")), metadata=some(F.col("metadata"), "language", "category", "topic"), prompts=prompts)


def write_canonical(df: DataFrame, path: str, order: str = "source_index", messages: str = "messages") -> None:
    """Canonical JSONL part files in source order: rows are sorted by ranges, so concatenated parts are the one file."""
    df.repartitionByRange(order).sortWithinPartitions(order).select(spaced_json(F.col(messages)).alias("value")).write.option("lineSep", "\n").text(path)


def manifest(df: DataFrame, split: str, order: str, messages: str = "messages") -> DataFrame:
    """Per split: examples, distinct fingerprints, bytes and digest of record digests in source order."""
    line = record_json(F.col(messages))
    each = df.select(F.col(split).cast("string").alias("split"), F.col(order).alias("_o"), F.sha2(line, 256).alias("_f"), F.octet_length(line).alias("_b"))
    digests = sequence_digest(each, F.col("split"), [F.col("_o"), F.col("_f")], F.col("_f"), "\n").select(F.col("g").alias("split"), F.col("digest").alias("sha256"))
    counts = each.groupBy("split").agg(F.count("*").alias("examples"), F.count_distinct("_f").alias("fingerprints"), F.sum("_b").alias("bytes"))
    return counts.join(digests, "split")
