"""JSONL records as rows: physical line numbers, one schema family per split, and a stable code where a line fails."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..codes import Refused
from ..functions.text import MESSAGES, ROLES, family, messages_code
from ..operators.digests import around_rank
from ..storage import shared_path, small_batches, stored
from . import files

MAX_LINE_BYTES = 4 << 20
#: Bytes of lines that are parsed before their rows leave.
SLICE = 1 << 20
#: Names of the schema families (fixed values, as functions/text.family gives them).
FAMILIES = ["conversational", "prompt_completion", "instruction"]


def read_lines(spark: SparkSession, paths: dict[str, str], joined_parts: bool = False) -> DataFrame:
    """Rows (split, line_no, value) of text files, value with its bytes as they are; only a newline ends a line.

    Lines are numbered from 1 within each file: an input split's first line is the number of lines in the splits before
    it, so no file passes through one task. What is windowed without a file's rows is one row per input split.
    joined_parts: a split's files, in order of their paths, are numbered on as the one file that they make up."""
    out = None
    for split, path in paths.items():
        one = spark.read.option("lineSep", "\n").text(path).select(F.lit(split).alias("split"), "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_id"))
        out = one if out is None else out.unionByName(one)
    blocks = out.groupBy("split", "_file", "_start").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    files = Window.partitionBy("split").orderBy("_file", "_start") if joined_parts else Window.partitionBy("split", "_file").orderBy("_start")
    before = files.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    joined = out.join(blocks.drop("_n"), ["split", "_file", "_start"])  # one row an input split; Spark broadcasts them where they are small
    # Identifiers are consecutive within a task's input split, so a line's place is the distance to the split's first.
    return joined.select("split", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line_no"), "value")


_MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
_FOUND = pa.schema([("kind", pa.string()), ("keys", pa.list_(pa.string())), ("code", pa.string()), ("messages", pa.list_(pa.struct([("role", pa.string()), ("content", pa.string())])))])


def _texts(record: dict, *names: str) -> tuple[str | None, list]:
    got = [record.get(n) for n in names]
    return ("DATASET_SCHEMA_UNKNOWN" if any(not isinstance(g, str) for g in got) else None), got


def _record(raw: bytes | None) -> tuple:
    """kind (big, blank, bad, record), keys, and messages or the code of the first failed type rule of a line's bytes."""
    if raw is None:
        return "big", None, "DATASET_LINE_TOO_LARGE", None
    raw = raw.strip()
    if not raw:
        return "blank", None, None, None
    try:
        record = json.loads(raw.decode())
        if b"\\u" in raw:
            json.dumps(record, ensure_ascii=False).encode()  # lone surrogates are not text; only escapes can give them
    except UnicodeDecodeError:
        return "bad", None, "DATASET_INVALID_UTF8", None
    except (ValueError, RecursionError):
        return "bad", None, "DATASET_INVALID_JSON", None
    if not isinstance(record, dict):
        return "bad", None, "DATASET_INVALID_JSON", None
    keys = list(record)
    if "messages" in record:
        messages = record["messages"]
        if not isinstance(messages, list) or not messages:
            return "record", keys, "DATASET_SCHEMA_UNKNOWN", None
        for m in messages:
            if not isinstance(m, dict):
                return "record", keys, "DATASET_SCHEMA_UNKNOWN", None
            if m.get("role") not in ("system", "user", "assistant"):
                return "record", keys, "DATASET_ROLE_INVALID", None
            if not isinstance(m.get("content"), str):
                return "record", keys, "DATASET_SCHEMA_UNKNOWN", None
        return "record", keys, None, [{"role": m["role"], "content": m["content"]} for m in messages]
    if "prompt" in record or "completion" in record:
        code, (user, answer) = _texts(record, "prompt", "completion")
    elif "instruction" in record or "output" in record:
        code, (user, answer) = _texts(record, "instruction", "output")
        extra = record.get("input") or ""
        if not isinstance(extra, str):
            code = code or "DATASET_SCHEMA_UNKNOWN"
        elif code is None and extra.strip():
            user = f"{user}\n\n{extra}".strip()
    else:
        return "record", keys, None, None
    return "record", keys, code, None if code else [{"role": "user", "content": user}, {"role": "assistant", "content": answer}]


def parsed(lines: DataFrame, at: list[str], value: F.Column) -> DataFrame:
    """The columns at of lines with kind (big, blank, bad, record), family, messages, and code: that of the first rule which a line
    breaks by itself. value: its bytes, null for a line over the bound.

    One Arrow function over batches, a few lines of SLICE bytes or one longer line at a time; Spark's JSON functions accept text after
    a value and other things that the rules refuse."""
    rows = lines.select(*at, value.alias("_value"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin = 0
            while begin < batch.num_rows:
                found, size = [], 0
                while begin + len(found) < batch.num_rows and size < SLICE:
                    raw = batch.columns[-1][begin + len(found)].as_py()
                    found.append(_record(raw))
                    size += len(raw or b"") + 64
                columns = [pa.array(c, f.type) for c, f in zip(zip(*found), _FOUND)]
                yield pa.RecordBatch.from_arrays([*(c.slice(begin, len(found)) for c in batch.columns[:-1]), *columns], names=[*batch.schema.names[:-1], *_FOUND.names])
                begin += len(found)

    ddl = T.StructType([*rows.schema.fields[:-1], *T.StructType.fromDDL("kind string, keys array<string>, code string, messages array<struct<role:string,content:string>>").fields])
    fam = F.when(F.col("kind") == "record", family(F.col("keys")))
    code = F.when(F.col("kind") != "record", F.col("code")).when(fam.startswith("DATASET"), fam).when(F.col("code").isNotNull(), F.col("code")).otherwise(messages_code(F.col("messages")))
    got = rows.mapInArrow(work, ddl)
    return got.select(*at, "kind", F.when(~fam.startswith("DATASET"), fam).alias("family"), code.alias("code"), "messages")


def normalize(lines: DataFrame, max_examples: int | None = None, max_bytes: int = MAX_LINE_BYTES, examples_only: bool = True) -> DataFrame:
    """lines (split, line_no, value, ...) as (split, line_no, ..., family, messages, code); blank lines are left out, other columns
    go along.

    Rules in order: line size, UTF-8, JSON object, one family by its keys, the family of the split's first line that has
    one, types and roles, assistant text, number of examples. A row with a code is no example, so that its messages are null;
    without examples_only they stay where they have roles and texts. Lines are parsed once, into a table of the shared folder
    that the rules over many lines then read."""
    at = [c for c in lines.columns if c != "value"]
    value = F.when(F.octet_length("value") <= max_bytes, F.col("value").cast("binary"))
    with small_batches(lines.sparkSession):
        rows = stored(parsed(lines.filter("value is not null"), at, value).filter("kind <> 'blank'"), "parsed")
    firsts = rows.filter("family is not null").groupBy("split").agg(F.min_by("family", "line_no").alias("_first"))
    code = F.when(F.col("family") != F.col("_first"), "DATASET_SCHEMA_MIXED").otherwise(F.col("code"))
    out = rows.join(F.broadcast(firsts), "split", "left").select(*at, "family", "messages", code.alias("code"))  # firsts is one row a split
    if max_examples is not None:
        fine = out.filter("code is null").select("split", "line_no")
        for r in fine.groupBy("split").agg(F.count("*").alias("n")).filter(F.col("n") > max_examples).collect():  # one row a split
            near, k = around_rank(fine.filter(F.col("split") == r["split"]), F.col("line_no"), max_examples + 1)
            line = near.orderBy("line_no").limit(k).agg(F.max("line_no").alias("line")).first()["line"]
            here = (F.col("split") == r["split"]) & (F.col("line_no") == line)
            out = out.withColumn("code", F.when(here & F.col("code").isNull(), "DATASET_TOO_MANY_EXAMPLES").otherwise(F.col("code")))
    return out.withColumn("messages", F.when(F.col("code").isNull(), F.col("messages"))) if examples_only else out


def bounded_lines(spark: SparkSession, path: str, max_bytes: int = MAX_LINE_BYTES, range_bytes: int = files.RANGE, first: int = 0, last: int | None = None) -> DataFrame:
    """Rows (range, place, value, size) of a file's lines, or of a folder's files in order; value is null for lines over max_bytes."""
    spark.dataSource.register(files.BoundedLines)
    options = {"path": path, "maxBytes": max_bytes, "rangeBytes": range_bytes, "first": first} | ({} if last is None else {"last": last})
    return spark.read.format("bounded_lines").options(**options).load()


def numbered(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """rows (range, place, ...) with line_no from 1. counts: lines of each range, which the driver holds as it does the ranges."""
    before, table = 0, []
    for number in sorted(counts):
        table.append((number, before))
        before += counts[number]
    offsets = rows.sparkSession.createDataFrame(table, "range long, _before long")
    if len(table) <= 1 << 20:  # rows of two numbers: at most some 24 MB; beyond that Spark chooses
        offsets = F.broadcast(offsets)
    return rows.join(offsets, "range").withColumn("line_no", F.col("_before") + F.col("place") + 1).drop("_before")


def read_bounded(spark: SparkSession, path: str, max_bytes: int = MAX_LINE_BYTES, range_bytes: int = files.RANGE) -> DataFrame:
    """(line_no, value, code) of all lines of a file, or of a folder's files in order: the files are read twice, first to count
    the lines of each range; a line over max_bytes has its number and DATASET_LINE_TOO_LARGE, and is never held."""
    lines = bounded_lines(spark, path, max_bytes, range_bytes)
    counts = {r["range"]: r["n"] for r in lines.groupBy("range").agg(F.count("*").alias("n")).collect()}  # one row a range, as many as the driver plans
    return numbered(lines, counts).select("line_no", "value", F.when(F.col("value").isNull(), "DATASET_LINE_TOO_LARGE").alias("code"))


@dataclass
class Loaded:
    """What load() read: examples (line_no, family, messages), their number, lines, and how many of the file's ranges were read."""

    rows: DataFrame
    examples: int
    lines: int
    ranges_read: int


def load(spark: SparkSession, path: str, max_examples: int, max_bytes: int = MAX_LINE_BYTES, range_bytes: int = files.RANGE, most: int = 4096) -> Loaded:
    """The examples of a split's file, or Refused with the code and line of its first error.

    Ranges of bytes are read in order, in groups of 1, 2, 4, ... and at most `most` of them, and each is parsed once; the driver
    gets one row a range. Reading ends with the first group that holds an error or an example beyond max_examples, so a bad or too
    long file is not read to its end. Codes and lines are those that normalize gives first. A file without examples gives none."""
    total = len(files.ranges(path, range_bytes))
    folder = shared_path(spark, "load")
    at, step, valid, locked, counts = 0, 1, 0, None, {}
    while at < total:
        last = min(total, at + step)
        lines = bounded_lines(spark, path, max_bytes, range_bytes, at, last)
        with small_batches(spark):
            parsed(lines, ["range", "place"], F.col("value")).write.parquet(f"{folder}/group={at}")
        group = spark.read.parquet(f"{folder}/group={at}")
        own = F.min(F.when(F.col("code").isNotNull(), F.struct("place", "code"))).alias("own")
        seen = F.min_by(F.col("family"), F.when(F.col("family").isNotNull(), F.col("place"))).alias("family")
        firsts = [F.min(F.when(F.col("family") == f, F.col("place"))).alias(f) for f in FAMILIES]
        fine = F.count_if((F.col("kind") == "record") & F.col("code").isNull()).alias("fine")
        found = {r["range"]: r for r in group.groupBy("range").agg(F.count("*").alias("lines"), fine, own, seen, *firsts).collect()}  # one row a range
        for number in range(at, last):
            r = found.get(number)
            counts[number] = r["lines"] if r else 0
            if r is None:
                continue
            locked = locked or r["family"]
            other = [(r[f], 0, "DATASET_SCHEMA_MIXED") for f in FAMILIES if f != locked and r[f] is not None]
            wrong = min(other + ([(r["own"]["place"], 1, r["own"]["code"])] if r["own"] else []), default=None)
            if valid + r["fine"] > max_examples:
                good = group.filter((F.col("range") == number) & (F.col("kind") == "record") & F.col("code").isNull() & (F.col("family") == locked))
                beyond = good.select("place").orderBy("place").limit(max_examples - valid + 1).agg(F.max("place").alias("p"), F.count("*").alias("n")).first()
                if beyond["n"] > max_examples - valid:
                    wrong = min([(beyond["p"], 2, "DATASET_TOO_MANY_EXAMPLES")] + ([wrong] if wrong else []))
            if wrong:
                raise Refused(wrong[2], line_no=sum(counts[n] for n in counts if n < number) + wrong[0] + 1, ranges_read=last, ranges=total)
            valid += r["fine"]
        at, step = last, min(2 * step, most)
    if not counts:
        return Loaded(spark.createDataFrame([], "line_no long, family string, messages array<struct<role:string,content:string>>"), 0, 0, 0)
    rows = numbered(spark.read.parquet(folder).filter("kind = 'record'"), counts).select("line_no", "family", "messages")
    return Loaded(rows, valid, sum(counts.values()), total)


@F.pandas_udf(T.ArrayType(_MESSAGE))
def message_list(values: pd.Series) -> pd.Series:
    """Strict parse of a JSON list of messages, each with a known role and text that isn't blank, one at least of the
    assistant; null for anything else."""

    def one(text: str | None) -> list[dict] | None:
        try:
            got = json.loads(text)
        except (TypeError, ValueError, RecursionError):
            return None
        if not isinstance(got, list):
            return None
        for m in got:
            if not isinstance(m, dict) or m.get("role") not in ROLES or not isinstance(m.get("content"), str) or not m["content"].strip():
                return None
        return [{"role": m["role"], "content": m["content"]} for m in got] if any(m["role"] == "assistant" for m in got) else None

    return values.map(one)


def lenient(record: DataFrame) -> DataFrame:
    """record (raw, JSON text of an object) with messages by the lenient rule, null where it refuses.

    messages if there; else a prompt with completion or response; else an instruction with output or response, and input or
    context after it; scalars become text as JSON has them. Roles must be known and some assistant turn not blank."""
    v = lambda name: F.get_json_object("raw", f"$.{name}")
    has = lambda name: F.coalesce(F.array_contains(F.json_object_keys("raw"), name), F.lit(False))
    either = lambda name: F.coalesce(F.when(has(name), v(name)).otherwise(v("response")), F.lit("None"))
    filled = lambda name: F.when(v(name) != "", v(name))
    context = F.coalesce(filled("input"), filled("context"))
    pair = lambda asked, answer: F.array(F.struct(F.lit("user").alias("role"), asked.alias("content")), F.struct(F.lit("assistant").alias("role"), answer.alias("content")))
    got = (
        F.when(has("messages"), F.from_json(v("messages"), MESSAGES))
        .when(has("prompt") & (has("completion") | has("response")), pair(F.coalesce(v("prompt"), F.lit("None")), either("completion")))
        .when(has("instruction") & (has("output") | has("response")), pair(F.concat(F.coalesce(v("instruction"), F.lit("None")), F.coalesce(F.concat(F.lit("\n\n"), context), F.lit(""))), either("output")))
    )
    return record.withColumn("messages", F.when(messages_code(got).isNull(), got))
