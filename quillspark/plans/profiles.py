"""Whole jobs: build a profile of a source, verify it against an approval, and check that profiles share no rows."""

from __future__ import annotations

import argparse
import hashlib
import json
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..codes import Refused
from ..functions.text import record_fingerprint, strip
from ..operators import checks, masking, selection
from ..operators.digests import sequence_digest
from ..operators.integrity import field_diff
from ..sources import adapters, datasets
from . import package

#: Fields compared with an approval, the most explanatory first (fixed values).
COMPARED = ["sourceRevision", "conversionVersion", "excludeLanguages", "selectedSourceIndexDigest", "selectedSourceIndexCount"]


@dataclass(frozen=True)
class Profile:
    """What to build: a source's kind and key fields, how many rows, and what to leave out first."""

    dataset_id: str
    name: str
    kind: str
    key_fields: tuple[str, ...]
    revision: str
    count: int | None = None
    strategy: str = "stable_hash"
    language_field: str | None = None
    exclude: tuple[str, ...] = ()
    template_field: str | None = None
    expected_removals: int | None = None
    conversion: str = "1.0"
    usage: str = "training"


def exclude(df: DataFrame, profile: Profile, donor: DataFrame | None = None) -> DataFrame:
    """The exclusion comes before selection: by column if there is one, else by a donor's template, else refused."""
    if not profile.exclude:
        return df
    if profile.language_field:
        return selection.drop_languages(df, profile.language_field, profile.exclude)
    if profile.template_field and donor is not None:
        return selection.drop_prefix(df, profile.template_field, selection.derive_prefix(donor, profile.template_field), profile.expected_removals)
    raise Refused("CONFIG_OUT_OF_BOUNDS", "languages can't be told apart in this source")


def build(source: DataFrame, profile: Profile, order: str = "source_index", donor: DataFrame | None = None) -> DataFrame:
    """Rows of a profile: source_index, messages, fingerprint. source has the order column."""
    if profile.usage != "training":
        raise Refused("CONFIG_OUT_OF_BOUNDS", "an evaluation source is never training data")
    rows = exclude(source, profile, donor)
    chosen = selection.select_stable(rows, profile.count, f"{profile.dataset_id}:{profile.name}", profile.key_fields, order, profile.strategy)
    made = adapters.adapt(profile.kind, chosen)
    bad = F.when(~F.col("valid"), F.raise_error(F.lit("a selected row can't be converted"))).otherwise(F.col("messages"))
    return made.select(F.col(order).alias("source_index"), bad.alias("messages")).withColumn("fingerprint", record_fingerprint(F.col("messages")))


def manifest(built: DataFrame, profile: Profile, split: str = "train") -> dict:
    """Provenance of a build: counts and digests, no content."""
    index = F.col("source_index")
    row = sequence_digest(built, F.lit(""), [index], index, ",", "[", "]").first() or {"n": 0, "digest": hashlib.sha256(b"[]").hexdigest()}
    parts = datasets.manifest(built.withColumn("_split", F.lit(split)), "_split", "source_index").first()
    return {
        "schemaVersion": "1.0", "datasetId": profile.dataset_id, "profile": profile.name, "sourceRevision": profile.revision, "conversionVersion": profile.conversion,
        "excludeLanguages": sorted(profile.exclude), "selectedSourceIndexCount": row["n"], "selectedSourceIndexDigest": row["digest"],
        "splits": {split: {"exampleCount": parts["examples"], "sha256": parts["sha256"], "bytes": parts["bytes"]}},
    }


def approval(made: dict, built: DataFrame, on: date) -> dict:
    """An approval of a manifest: its compared fields, each split's count and digest, and the fingerprints' number and digest."""
    short = checks.fingerprint_digest(checks.short_fingerprints(built, "fingerprint"), "fp").first() or {"n": 0, "digest": hashlib.sha256(b"").hexdigest()}
    return {k: made[k] for k in ("datasetId", "profile", *COMPARED)} | {
        "approvedOn": on.isoformat(), "splits": {s: {"exampleCount": v["exampleCount"], "sha256": v["sha256"]} for s, v in made["splits"].items()},
        "fingerprintCount": short["n"], "fingerprintDigest": short["digest"],
    }


def write_fingerprints(built: DataFrame, path: str) -> None:
    """The sorted short fingerprints of a build, one a line, as part files whose concatenation is the approval's file."""
    short = checks.short_fingerprints(built, "fingerprint")
    short.repartitionByRange("fp").sortWithinPartitions("fp").select(F.col("fp").alias("value")).write.option("lineSep", "\n").text(path)


def read_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """Distinct fingerprints of such files, fp; blank lines and white space around don't count."""
    return spark.read.option("lineSep", "\n").text(path).select(strip(F.col("value")).alias("fp")).filter("fp <> ''").distinct()


def verify(made: dict, approved: dict) -> list[str]:
    """Every difference between a manifest and an approval: fields in order, then splits by name."""
    problems = field_diff(approved, made, COMPARED)
    for split in sorted({*made["splits"], *approved["splits"]}):
        a, b = approved["splits"].get(split), made["splits"].get(split)
        if a is None or b is None:
            problems.append(f"split {split} is not {'approved' if a is None else 'built'}")
        else:
            problems += [f"split {split}: {k}" for k in ("sha256", "exampleCount") if a[k] != b[k]]
    return problems


def disjoint(profiles: dict[str, DataFrame]) -> DataFrame:
    """Pairs of profiles (each with fingerprint) that share rows: split_a, split_b, shared; every pair, not only the first."""
    return disjoint_files({name: checks.short_fingerprints(df, "fingerprint") for name, df in profiles.items()})


def disjoint_files(approved: dict[str, DataFrame]) -> DataFrame:
    """As disjoint, from approvals' fingerprint files (each with fp, as read_fingerprints gives it)."""
    short = None
    for name, df in approved.items():
        one = df.select("fp", F.lit(name).alias("profile"))
        short = one if short is None else short.unionByName(one)
    return checks.leakage(short, "profile", "fp")


_REGISTRY = "source_id string, enabled boolean, intended_use array<string>, revision string, tier int"


def main(argv: list[str] | None = None) -> int:
    """build, verify or approve a profile of a Parquet source, show that approvals share no rows, check and package a dataset
    folder, list the sources of a registry (JSON lines), or build an evaluation corpus, from the command line; prints a JSON document, returns 1 for problems."""
    parser = argparse.ArgumentParser(prog="quillspark")
    parser.add_argument("command", choices=["build", "verify", "approve", "disjoint", "package", "list", "evaluate"])
    parser.add_argument("source", nargs="+", help="the source; for disjoint name=folder of each approval's fingerprints")
    parser.add_argument("--vocabulary", help="tokenizers file that package counts tokens by; white space without one")
    parser.add_argument("--registry", help="JSON lines of the sources that evaluate looks its own up in")
    parser.add_argument("--profile", help="JSON of a profile's fields")
    parser.add_argument("--order", default="source_index")
    parser.add_argument("--out", help="folder for canonical JSONL, or for an approval's fingerprints")
    parser.add_argument("--approval", help="approval JSON to verify against")
    parser.add_argument("--date", type=date.fromisoformat, help="day of an approval, YYYY-MM-DD")
    args = parser.parse_args(argv)
    disjoint_ = args.command == "disjoint"
    if disjoint_ and (len(args.source) < 2 or not all("=" in s for s in args.source)):
        parser.error("disjoint takes two or more name=folder")
    alone = args.command in ("package", "list")
    if not disjoint_ and (len(args.source) > 1 or not (args.profile or alone)):
        parser.error(f"{args.command} takes one source" + ("" if alone else " and a profile"))
    if args.command == "package" and not args.out:
        parser.error("package takes a folder to write to")
    if args.command == "evaluate" and not (args.out and args.registry):
        parser.error("evaluate takes a registry and a folder to write to")
    if args.command == "approve" and not args.date or args.command == "verify" and not args.approval:
        parser.error("approve takes a date, verify an approval")
    spark = SparkSession.builder.getOrCreate()
    if disjoint_:
        shared = disjoint_files({name: read_fingerprints(spark, folder) for name, folder in (s.split("=", 1) for s in args.source)})
        pairs = [r.asDict() for r in shared.orderBy("split_a", "split_b").collect()]  # one row a pair of profiles
        print(json.dumps({"successful": not pairs, "shared": pairs}))
        return int(bool(pairs))
    if args.command == "package":
        try:
            made = package.package(spark, args.source[0], args.out, masking.from_file(args.vocabulary) if args.vocabulary else None)
        except Refused as refused:
            print(json.dumps({"successful": False, "code": refused.code, "details": refused.details}))
            return 1
        print(json.dumps(made, sort_keys=True))
        return 0
    if args.command == "list":
        sources = spark.read.schema(_REGISTRY).json(args.source[0])
        print(json.dumps([r.asDict() for r in package.listing(sources).collect()]))  # one row a source
        return 0
    fields = json.loads(args.profile)
    profile = Profile(**{k: tuple(v) if isinstance(v, list) else v for k, v in fields.items()})
    if args.command == "evaluate":
        from . import evaluation

        approved = None
        if args.approval:
            with open(args.approval, encoding="utf-8") as f:
                approved = json.load(f)
        try:
            made = evaluation.build(spark.read.parquet(args.source[0]), spark.read.schema(_REGISTRY).json(args.registry), profile, args.out, args.order, approved)
        except Refused as refused:
            print(json.dumps({"successful": False, "code": refused.code, "details": refused.details}))
            return 1
        print(json.dumps(made, sort_keys=True))
        return int(bool(made["problems"]))
    try:
        built = build(spark.read.parquet(args.source[0]), profile, args.order)
        made = manifest(built, profile)
    except Refused as refused:
        print(json.dumps({"successful": False, "code": refused.code}))
        return 1
    if args.command == "verify":
        try:
            with open(args.approval, encoding="utf-8") as f:
                problems = verify(made, json.load(f))
        except FileNotFoundError:
            problems = ["there is no approval"]
        print(json.dumps({"successful": not problems, "problems": problems}))
        return int(bool(problems))
    if args.command == "approve":
        if args.out:
            write_fingerprints(built, args.out)
        made = approval(made, built, args.date)
    elif args.out:
        datasets.write_canonical(built, args.out)
    print(json.dumps(made, sort_keys=True))
    return 0
