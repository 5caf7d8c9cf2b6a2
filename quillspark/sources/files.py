"""Files of any size as data sources: bounded lines in byte ranges, digests of whole files, and a canonical sink with commit.

Sources open files by URI through pyarrow's file systems; a plain path is a local or mounted one.

bounded_lines: partitions are neighbouring byte ranges of PACK bytes together, or one larger range, so that small ranges don't
make a task each; a line belongs to the range in which it begins. A range is read in chunks, and a
line is given up as soon as it passes the bound, so that a worker holds one chunk and one line of at most max_bytes. Of a line
over the bound only its place and its size so far are given, as soon as that is known, and what follows is skipped.

file_digests: partitions are files (or, joined, lists of files that make up one), each streamed to SHA-256 by one task.

canonical_jsonl: a sink whose tasks hand rows, bytes and digest of the part they wrote to the commit, which writes the
manifest. A job that fails leaves no manifest, so parts without one are nobody's data; parts of attempts that were lost
aren't in it.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Collection, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ..storage import small_batches

#: Bytes read at once, in a range, in a batch of lines, and in the ranges that one task reads.
CHUNK, RANGE, BATCH, PACK = 1 << 20, 64 << 20, 4 << 20, 8 << 20
MANIFEST = "_manifest.json"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def listed(path: str, hidden: bool = False, skipped: Collection[str] = ()) -> list[tuple[str, int]]:
    """(path, size) of a file, or of the files below a folder in order of their paths, without those that begin with _ or a dot
    unless hidden. Names in skipped, of files or folders below it, are not looked behind."""
    store, where = opened(path)
    prefix = path[: path.index("://") + 3] if "://" in path and not path.startswith("file:") else ""
    info = store.get_file_info(where)
    if info.type == fs.FileType.File:
        return [(prefix + info.path, info.size)]
    found, folders, root = [], [where], where.rstrip("/") + "/"
    while folders:
        here = [f for f in store.get_file_info(fs.FileSelector(folders.pop(), recursive=not skipped)) if f.path.split(root, 1)[-1] not in skipped]
        found += here
        folders += [f.path for f in here if f.type == fs.FileType.Directory] if skipped else []
    return sorted((prefix + f.path, f.size) for f in found if f.type == fs.FileType.File and (hidden or f.base_name[0] not in "_."))


def links(path: str) -> list[str]:
    """Names below a folder that are symbolic links, to files or folders, in order; other stores than local ones have none."""
    store, where = opened(path)
    if not isinstance(store, fs.LocalFileSystem):
        return []
    root = where.rstrip("/")
    return sorted(f"{at}/{name}"[len(root) + 1 :] for at, folders, names in os.walk(root) for name in folders + names if os.path.islink(f"{at}/{name}"))


@dataclass
class Range(InputPartition):
    """Bytes start to end of a file; number counts the ranges of all files."""

    number: int
    path: str
    start: int
    end: int


def ranges(path: str, size: int = RANGE) -> list[Range]:
    out = []
    for file, n in listed(path):
        for start in range(0, n, size):
            out.append(Range(len(out), file, start, min(n, start + size)))
    return out


@dataclass
class Pack(InputPartition):
    """Neighbouring ranges that one task reads in order."""

    ranges: list[Range]


def packed(some: list[Range], limit: int = PACK) -> list[Pack]:
    """Ranges in order as packs of at most limit bytes, or one larger range."""
    out, size = [], 0
    for r in some:
        if not out or size + r.end - r.start > limit:
            out.append(Pack([]))
            size = 0
        out[-1].ranges.append(r)
        size += r.end - r.start
    return out


def lines_of(part: Range, max_bytes: int, chunk: int = CHUNK) -> Iterator[tuple[int, bytes | None, int]]:
    """(place, line, size) of the lines that begin in a range; line is None and size what was seen so far beyond max_bytes."""
    store, where = opened(part.path)
    with store.open_input_file(where) as file:
        at = max(part.start - 1, 0)  # a line begins at start if the byte before ends one
        file.seek(at)
        skip, begin, held, place = part.start > 0, at, bytearray(), 0
        while True:
            data = file.read(chunk)
            if not data:
                break
            cursor = 0
            while cursor < len(data):
                if not skip and not held and begin >= part.end:
                    return
                newline = data.find(b"\n", cursor)
                stop = len(data) if newline < 0 else newline
                if not skip:
                    if len(held) + stop - cursor > max_bytes:
                        yield place, None, len(held) + stop - cursor
                        place, skip, held = place + 1, True, bytearray()
                    else:
                        held += data[cursor:stop]
                        if newline >= 0:
                            yield place, bytes(held), len(held)
                            place, held = place + 1, bytearray()
                cursor = stop + 1
                if newline >= 0:
                    skip, begin = False, at + newline + 1
            at += len(data)
            if skip and at >= part.end:
                return
        if held:
            yield place, bytes(held), len(held)


class _LineReader(DataSourceReader):
    schema = pa.schema([("range", pa.int64()), ("place", pa.int64()), ("value", pa.binary()), ("size", pa.int64())])

    def __init__(self, options: dict) -> None:
        self.path, self.max_bytes = options["path"], int(options.get("maxbytes", 4 << 20))
        self.size, self.chunk = int(options.get("rangebytes", RANGE)), int(options.get("chunkbytes", CHUNK))
        self.first, self.last = int(options.get("first", 0)), int(options.get("last", 1 << 62))

    def partitions(self) -> list[Pack]:
        return packed(ranges(self.path, self.size)[self.first : self.last]) or [Pack([])]

    def read(self, part: Pack | Range) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for one in part.ranges if isinstance(part, Pack) else [part]:
            for place, line, n in lines_of(one, self.max_bytes, self.chunk):
                rows.append((one.number, place, line, n))
                size += len(line or b"") + 64
                if size >= BATCH:
                    yield self._batch(rows)
                    rows, size = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), self.schema)], schema=self.schema)


class BoundedLines(DataSource):
    """Rows (range, place, value, size): place counts a range's lines from 0, value is null for a line over maxBytes.

    Options: path, maxBytes, rangeBytes, chunkBytes, first and last (numbers of ranges to read, last excluded)."""

    @classmethod
    def name(cls) -> str:
        return "bounded_lines"

    def schema(self) -> str:
        return "range long, place long, value binary, size long"

    def reader(self, schema) -> _LineReader:
        return _LineReader({k.lower(): v for k, v in self.options.items()})


@dataclass
class Files(InputPartition):
    """Files whose bytes make up one, and the name it goes by."""

    name: str
    paths: list[str]
    tree: str


class _DigestReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.kind, self.hidden = options["path"], options.get("kind", "file"), options.get("hidden") == "true"
        self.skipped = set(json.loads(options.get("skipped", "[]")))

    def partitions(self) -> list[Files]:
        root = opened(self.path)[1].rstrip("/") + "/"
        below = lambda f: f.split(root, 1)[-1]
        files = [f for f, _ in listed(self.path, self.hidden, self.skipped)]
        if self.kind == "tree":
            return [Files(self.path, sorted(files, key=below), root)]
        if self.kind == "folder":
            by: dict[str, list[str]] = {}
            for f in sorted(files):
                by.setdefault(below(f).rpartition("/")[0], []).append(f)
            return [Files(n, fs_, "") for n, fs_ in by.items()] or [Files("", [], "")]
        return [Files(below(f), [f], "") for f in files] or [Files("", [], "")]

    def read(self, part: Files) -> Iterator[tuple]:
        if not part.paths and not part.tree:
            return
        digest, size, lines = hashlib.sha256(), 0, 0
        for path in part.paths:
            store, where = opened(path)
            if part.tree:
                digest.update(path.split(part.tree, 1)[-1].encode() + b"\0")
            with store.open_input_file(where) as file:
                while data := file.read(CHUNK):
                    digest.update(data)
                    size += len(data)
                    lines += data.count(b"\n")
            if part.tree:
                digest.update(b"\0")
        yield part.name, len(part.paths), size, lines, digest.hexdigest()


class FileDigests(DataSource):
    """Rows (name, files, bytes, lines, sha256). Option kind: file (one row each), folder (a folder's files in order of their
    paths, as one), tree (one row for the folder: each path below it, a zero byte, its content, a zero byte). Option hidden: files that begin with _ or a dot too. Option skipped: JSON list of names, of
    files or folders below the path, that aren't read."""

    @classmethod
    def name(cls) -> str:
        return "file_digests"

    def schema(self) -> str:
        return "name string, files int, bytes long, lines long, sha256 string"

    def reader(self, schema) -> _DigestReader:
        return _DigestReader({k.lower(): v for k, v in self.options.items()})


def digests(spark: SparkSession, path: str, kind: str = "file", hidden: bool = False, skipped: Sequence[str] = ()) -> DataFrame:
    """Sizes and SHA-256 of the files below path, read back by one task a file (or folder, or tree) in constant memory."""
    spark.dataSource.register(FileDigests)
    return spark.read.format("file_digests").option("path", path).option("kind", kind).option("hidden", hidden).option("skipped", json.dumps(list(skipped))).load()


@dataclass
class _Part(WriterCommitMessage):
    order: int
    file: str
    rows: int
    bytes: int
    sha256: str


class _CanonicalWriter(DataSourceArrowWriter):
    def __init__(self, path: str, run: str) -> None:
        self.path, self.run = path, run

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Part:
        context = TaskContext.get()
        store, folder = opened(self.path)
        store.create_dir(folder, recursive=True)
        name = f"part-{context.partitionId():07d}-{self.run}-{context.attemptNumber()}-{uuid.uuid4().hex[:8]}.jsonl"
        digest, rows, size = hashlib.sha256(), 0, 0
        with store.open_output_stream(f"{folder}/{name}") as out:
            for batch in batches:
                for line in batch.column(0):
                    data = line.as_py().encode() + b"\n"
                    out.write(data)
                    digest.update(data)
                    rows, size = rows + 1, size + len(data)
        if not rows:
            store.delete_file(f"{folder}/{name}")
        return _Part(context.partitionId(), name, rows, size, digest.hexdigest())

    def commit(self, messages: list[_Part | None]) -> None:
        parts = sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.order)
        manifest = {"rows": sum(m.rows for m in parts), "bytes": sum(m.bytes for m in parts), "parts": [{"file": m.file, "rows": m.rows, "bytes": m.bytes, "sha256": m.sha256} for m in parts]}
        store, folder = opened(self.path)
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(f"{folder}/_writing") as out:
            out.write(json.dumps(manifest, sort_keys=True).encode())
        store.move(f"{folder}/_writing", f"{folder}/{MANIFEST}")

    def abort(self, messages: list[_Part | None]) -> None:
        store, folder = opened(self.path)
        for m in messages:
            if m is not None and m.rows:
                store.delete_file(f"{folder}/{m.file}")


class CanonicalJsonl(DataSource):
    """A sink of one string column, value: a line each. Partitions become parts in their order."""

    @classmethod
    def name(cls) -> str:
        return "canonical_jsonl"

    def writer(self, schema, overwrite: bool) -> _CanonicalWriter:
        path = self.options["path"]
        store, folder = opened(path)
        if store.get_file_info(f"{folder}/{MANIFEST}").type == fs.FileType.File:
            if not overwrite:
                raise FileExistsError(f"{path} holds a committed file")
            store.delete_file(f"{folder}/{MANIFEST}")
        return _CanonicalWriter(path, uuid.uuid4().hex[:8])


def write_lines(lines: DataFrame, path: str, overwrite: bool = False) -> dict:
    """Write the one column of lines, whose partitions are in order, as a canonical file, and give its manifest."""
    spark = lines.sparkSession
    spark.dataSource.register(CanonicalJsonl)
    with small_batches(spark):
        lines.toDF("value").write.format("canonical_jsonl").option("path", path).mode("overwrite" if overwrite else "append").save()
    return committed(path)


def committed(path: str) -> dict:
    """The manifest of a canonical file; a folder without one holds no committed file."""
    store, folder = opened(path)
    if store.get_file_info(f"{folder}/{MANIFEST}").type != fs.FileType.File:
        raise FileNotFoundError(f"{path} holds no committed file")
    with store.open_input_stream(f"{folder}/{MANIFEST}") as file:
        return json.loads(file.read())


def verified(spark: SparkSession, path: str) -> DataFrame:
    """(file, problem) where the files of a canonical folder differ from its manifest: missing, extra, changed."""
    from pyspark.sql import functions as F

    manifest = committed(path)["parts"]
    said = spark.createDataFrame([(p["file"], p["bytes"], p["sha256"]) for p in manifest], "file string, said_bytes long, said_sha256 string")
    found = digests(spark, path).select(F.col("name").alias("file"), "bytes", "sha256")
    problem = F.when(F.col("sha256").isNull(), "missing").when(F.col("said_sha256").isNull(), "extra").when((F.col("sha256") != F.col("said_sha256")) | (F.col("bytes") != F.col("said_bytes")), "changed")
    return said.join(found, "file", "full").select("file", problem.alias("problem")).filter("problem is not null")
