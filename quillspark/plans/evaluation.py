"""Held-out evaluation corpora: built from a pinned source, written with fingerprints and a manifest, held against an approval."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..codes import Refused
from ..functions.text import short_record_fingerprint
from ..operators import checks, policy, selection
from ..operators.digests import sequence_digest
from ..sources import adapters, datasets, files
from ..storage import stored
from . import profiles

SPLIT = "evaluation"


def records(source: DataFrame, profile: profiles.Profile, order: str = "source_index") -> DataFrame:
    """The profile's rows of source as evaluation records: source_index, id, label, metadata, prompts, values verbatim.

    A profile that takes all rows and has a count is refused unless the source has just as many: a source that has moved is
    looked at again before it is used. A chosen row that isn't a record is refused by its index, without its content."""
    if profile.strategy == "all" and profile.count is not None and (n := source.count()) != profile.count:
        raise Refused("CONFIG_OUT_OF_BOUNDS", "the source has another number of rows", expected=profile.count, found=n)
    chosen = selection.select_stable(source, profile.count, f"{profile.dataset_id}:{profile.name}", profile.key_fields, order, profile.strategy)
    made = stored(adapters.adapt(SPLIT, chosen).withColumn("source_index", F.col(order)).select("source_index", "id", "label", "metadata", "prompts", "valid"), SPLIT)
    bad = made.filter(~F.coalesce("valid", F.lit(False))).agg(F.count("*").alias("n"), F.min("source_index").alias("first")).first()
    if bad["n"]:
        raise Refused("DATASET_SCHEMA_UNKNOWN", "a selected row is no evaluation record", source_index=bad["first"], rows=bad["n"])
    return made.drop("valid")


def fingerprints(made: DataFrame) -> DataFrame:
    """Distinct short fingerprints of records, fp; fields of other names don't count."""
    prompts = F.transform("prompts", lambda p: F.struct(p["mcq"].alias("mcq"), p["mcq_options"].alias("mcq_options"), p["question"].alias("question")))
    about = F.struct(*(F.col(f"metadata.{n}").alias(n) for n in ("category", "language", "topic")))
    return made.select(short_record_fingerprint(F.struct("id", "label", about.alias("metadata"), prompts.alias("prompts"))).alias("fp")).distinct()


def build(source: DataFrame, sources: DataFrame, profile: profiles.Profile, out: str, order: str = "source_index", approved: dict | None = None) -> dict:
    """Write a profile's records below out/evaluation as a canonical file and their sorted fingerprints below out/fingerprints, then
    out/manifest.json, and return the manifest with its problems against an approval (None without one).

    sources: the registry; the profile's source must be enabled, evaluation-only and pinned, and at the profile's revision.
    Nothing is written for a source or row that is refused. No training split is ever made."""
    spark = source.sparkSession
    gate = policy.source_gate(spark.createDataFrame([(profile.dataset_id,)], "source_id string"), sources, evaluation=True).first()["gate"]
    moved = gate == "ok" and sources.filter((F.col("source_id") == profile.dataset_id) & (F.col("revision") == profile.revision)).isEmpty()
    if gate != "ok" or moved:
        raise Refused("CONFIG_OUT_OF_BOUNDS", "another revision" if moved else gate, source=profile.dataset_id)
    made, out = records(source, profile, order), out.rstrip("/")
    dealt = made.repartitionByRange("source_index").sortWithinPartitions("source_index")
    said = files.write_lines(dealt.select(datasets.spaced_evaluation()), f"{out}/{SPLIT}")
    file = files.digests(spark, f"{out}/{SPLIT}", "folder").first() or {"sha256": hashlib.sha256().hexdigest(), "bytes": 0}
    if file["bytes"] != said["bytes"]:
        raise Refused("ARTIFACT_VERIFICATION_FAILED", "a file is not what was written", split=SPLIT)
    prints = fingerprints(made)
    prints.repartitionByRange("fp").sortWithinPartitions("fp").select(F.col("fp").alias("value")).write.mode("overwrite").option("lineSep", "\n").text(f"{out}/fingerprints")
    short = checks.fingerprint_digest(prints, "fp").first() or {"n": 0, "digest": hashlib.sha256(b"").hexdigest()}
    index = sequence_digest(made, F.lit(""), [F.col("source_index")], F.col("source_index"), ",", "[", "]").first() or {"n": 0, "digest": hashlib.sha256(b"[]").hexdigest()}
    manifest = {
        "schemaVersion": "1.0", "datasetId": profile.dataset_id, "profile": profile.name, "pipelineUsage": SPLIT, "sourceRevision": profile.revision, "conversionVersion": profile.conversion, "excludeLanguages": [],
        "selectedSourceIndexCount": index["n"], "selectedSourceIndexDigest": index["digest"], "fingerprintCount": short["n"], "fingerprintDigest": short["digest"],
        "splits": {SPLIT: {"exampleCount": said["rows"], "sha256": file["sha256"], "bytes": said["bytes"]}},
    }
    store, where = files.opened(out)
    with store.open_output_stream(f"{where}/manifest.json") as written:
        written.write(json.dumps(manifest, indent=2, sort_keys=True).encode() + b"\n")
    return manifest | {"problems": None if approved is None else profiles.verify(manifest, approved)}
