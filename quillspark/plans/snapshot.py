"""Snapshots of model folders: a manifest of every file, and all problems of a folder against it."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..codes import Refused
from ..operators.integrity import snapshot_problems
from ..sources import files

#: The manifest's name, format and version, and the ending of the files of which a snapshot has at least one.
MANIFEST, FORMAT, VERSION, WEIGHTS = "snapshot-manifest.json", "snapshot", 1, ".safetensors"
_SCHEMA = "format string, formatVersion int, modelKey string, modelId string, revision string, totalBytes long, files array<struct<path:string,bytes:long,sha256:string>>"


def on_disk(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size, sha256, link) of the files below folder but the manifest, hidden ones too, digested by one task a file; a
    symbolic link, or what lies behind one, is not read."""
    links = files.links(folder)
    found = files.digests(spark, folder, hidden=True, skipped=links).select(F.col("name").alias("path"), F.col("bytes").alias("size"), "sha256", F.lit(False).alias("link"))
    linked = spark.createDataFrame([(p, None, None, True) for p in links], "path string, size long, sha256 string, link boolean")
    return found.unionByName(linked).filter(F.substring_index("path", "/", -1) != MANIFEST)


def write(spark: SparkSession, folder: str, model_key: str, model_id: str, revision: str) -> dict:
    """Write and return the manifest of folder, files in order of their paths. A folder with a symbolic link is refused."""
    if links := files.links(folder):
        raise Refused("ARTIFACT_VERIFICATION_FAILED", "a snapshot holds no symbolic links", links=links)
    rows = on_disk(spark, folder).orderBy("path").collect()  # one a file, as many as the listing that the driver made
    listed = [{"path": r["path"], "bytes": r["size"], "sha256": r["sha256"]} for r in rows]
    made = {"format": FORMAT, "formatVersion": VERSION, "modelKey": model_key, "modelId": model_id, "revision": revision, "files": listed, "totalBytes": sum(r["size"] for r in rows)}
    store, where = files.opened(folder.rstrip("/"))
    with store.open_output_stream(f"{where}/{MANIFEST}") as out:
        out.write(json.dumps(made, indent=2).encode() + b"\n")
    return made


def verify(spark: SparkSession, folder: str, **expected: str) -> DataFrame:
    """All problems (path, problem) of a snapshot, none if it is whole: a manifest that is missing or can't be read, its fields
    against FORMAT, VERSION and expected (modelKey, modelId, revision), and what snapshot_problems finds."""
    store, where = files.opened(folder.rstrip("/"))
    whole = lambda texts: spark.createDataFrame([(None, t) for t in texts], "path string, problem string")
    if store.get_file_info(f"{where}/{MANIFEST}").type.name != "File":
        return whole(["no manifest"])
    read = spark.read.schema(_SCHEMA + ", _broken string").option("columnNameOfCorruptRecord", "_broken").option("multiLine", True).json(f"{folder.rstrip('/')}/{MANIFEST}")
    head = read.drop("files").first()
    if head is None or head["_broken"] is not None:
        return whole(["manifest can't be read"])
    wanted = {"format": FORMAT, "formatVersion": VERSION} | {k: v for k, v in expected.items() if v}
    fields = whole([k for k, v in wanted.items() if head[k] != v])
    listed = read.select(F.explode("files").alias("f")).select("f.path", F.col("f.bytes").alias("size"), "f.sha256")
    return fields.unionByName(snapshot_problems(listed, on_disk(spark, folder), head["totalBytes"], WEIGHTS))
