"""Byte-level BPE of a rank file by a global shuffle of distinct words, and decoding by a join with the token-byte table.

Texts are cut into pre-tokens by the public pattern. About CHUNK_BYTES of text make a chunk; its pre-tokens are exploded into
a list of distinct words and, for every position, the number of the word there. Each distinct word of a chunk is one entry
of a request to the shard that owns the word (by crc32), so that a word of any frequency is one entry a chunk. A shard
encodes each of its words once, whatever number of chunks ask for it, and its answers are joined back to the chunks, which
put the ids together by position. Words and position lists leave through one shuffle; only answers take a second one.

Decoding joins each id with the table (id, bytes) of the vocabulary, whose size is the vocabulary's own and doesn't grow
with the data, and puts the bytes together by position.

Defined results: a null text is empty; an empty text has no ids; rows that share a doc_id, or have none, are each encoded;
columns other than doc_id and text are not looked at; an empty table gives no rows. A text of any length is encoded
whole; it is one row, so a chunk of its own.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import from_planes, planes, slices

#: Bytes of text in a chunk and, over all chunks, for each shard; ids that are handled in one step.
CHUNK_BYTES, SHARD_BYTES, STEP = 16 << 20, 32 << 20, 1 << 20
#: Characters from which a text's pre-tokens are taken one by one instead of as a list.
LONG = 4 << 20
#: Widths of numbers in packed columns, in bytes.
_WIDE, _IDS = 4, 3

_X = pa.schema([("key", pa.int64()), ("chunk", pa.int64()), ("shard", pa.int32()), ("words", pa.binary()), ("lengths", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("ends", pa.binary()), ("places", pa.binary()), ("shards", pa.binary())])
_X_DDL = "key long, chunk long, shard int, words binary, lengths binary, doc_ids array<long>, ends binary, places binary, shards binary"
_ANSWER = pa.schema([("key", pa.int64()), ("shard", pa.int32()), ("counts", pa.binary()), ("ids", pa.binary())])


def ranks(path: str) -> dict[bytes, int]:
    """The rank file's tokens: bytes to id."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


@cache
def library(path: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={})


class Cutter:
    """cut(text) gives the pre-tokens as the encoding library cuts them.

    The two pattern libraries know different versions of Unicode. Which characters are letters, numbers and blanks is asked
    of the encoding library, by its own patterns over every code point; a text that has a character on which they
    differ is cut by a pattern that names the classes."""

    def __init__(self) -> None:
        every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
        single = {bytes([i]): i for i in range(256)}
        named, differ = public_tokenizers.PATTERN, set()
        own = {}
        for name in (r"\p{L}", r"\p{N}", r"\s"):
            probe = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={})
            own[name] = set(bytes(probe.encode_ordinary(every)).decode())
            differ |= own[name] ^ set(regex.findall(name, every))
        spans = {name: self._class(chars) for name, chars in own.items()}
        named = named.replace(r"[^\s\p{L}\p{N}]", "[^" + "".join(spans.values()) + "]").replace(r"\S", f"[^{spans[r'\s']}]")
        for name, text in spans.items():
            named = named.replace(name, f"[{text}]")
        self.plain, self.named = regex.compile(public_tokenizers.PATTERN), regex.compile(named)
        self.differ = re.compile(f"[{self._class(differ)}]") if differ else None

    @staticmethod
    def _class(chars: set[str]) -> str:
        codes = np.array(sorted(map(ord, chars)))
        first = np.flatnonzero(np.diff(codes, prepend=-2) != 1)
        last = np.append(first[1:], len(codes)) - 1
        return "".join(f"\\U{a:08x}-\\U{z:08x}" for a, z in zip(codes[first], codes[last]))

    def cut(self, text: str) -> Iterator[str]:
        pattern = self.named if self.differ and not text.isascii() and self.differ.search(text) else self.plain
        return pattern.findall(text) if len(text) < LONG else (m[0] for m in pattern.finditer(text))


@cache
def cutter() -> Cutter:
    return Cutter()


class _Numbers(dict):
    """Numbers of words in the order in which they come."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def _row(schema: pa.Schema, **values) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([values], schema)


def exploded(docs: DataFrame, shards: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows of two kinds, dealt by key: for each chunk (key is its number) the words at each position, and for each chunk and
    shard (key is the shard, negative) the distinct words asked for."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, chunk = cutter().cut, TaskContext.get().partitionId() << 32
        numbers, doc_ids, places, size = _Numbers(), [], [], 0

        def made() -> Iterator[pa.RecordBatch]:
            words = [w.encode() for w in numbers]
            owner = np.fromiter((zlib.crc32(w) % shards for w in words), np.int64, len(words))
            order = np.argsort(owner, kind="stable")
            present, first = np.unique(owner[order], return_index=True)
            for s, mine in zip(present, np.split(order, first[1:])):
                asked = [words[i] for i in mine]
                yield _row(_X, key=-1 - int(s), chunk=chunk, shard=int(s), words=zstd(b"".join(asked)), lengths=planes(np.fromiter(map(len, asked), np.uint64, len(asked)), _WIDE))
            ends = np.cumsum([len(p) for p in places], dtype=np.uint64)
            at = np.concatenate(places) if places else np.zeros(0, np.uint32)
            yield _row(_X, key=chunk, chunk=chunk, doc_ids=doc_ids, ends=planes(ends, 8), places=planes(at, _WIDE), shards=planes(owner, _WIDE))

        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = cut(text or "")
                places.append(np.fromiter(map(numbers.__getitem__, found), np.uint32))
                doc_ids.append(doc_id)
            size += batch.column("text").nbytes
            if size >= chunk_bytes:
                yield from made()
                numbers, doc_ids, places, size, chunk = _Numbers(), [], [], 0, chunk + 1
        if doc_ids:
            yield from made()

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(work, _X_DDL).repartition(shards, "key")


def zstd(data: bytes) -> bytes:
    return pa.compress(data, "zstd", asbytes=True) if data else b""


def unzstd(data: bytes, size: int) -> bytes:
    return pa.decompress(data, size, "zstd", asbytes=True) if size else b""


def answered(rows: DataFrame, path: str) -> DataFrame:
    """(key, shard, counts, ids) for each request, key being the chunk: ids of its words in the order asked.

    A task keeps the ids of its shards' words, so that each is encoded once however many chunks ask."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, known = library(path)._core_bpe.encode_single_piece, {}
        for batch in batches:
            for i in range(batch.num_rows):
                if not batch.column("words")[i].is_valid:
                    continue
                lengths = from_planes(batch.column("lengths")[i].as_py(), _WIDE).astype(np.int64)
                ends = np.cumsum(lengths).tolist()
                data, begin, ids = unzstd(batch.column("words")[i].as_py(), ends[-1]), 0, []
                for end in ends:
                    word = data[begin:end]
                    got = known.get(word)
                    if got is None:
                        known[word] = got = np.array(encode(word), "<u4").tobytes()
                    ids.append(got)
                    begin = end
                counts = np.fromiter(map(len, ids), np.uint64, len(ids)) // 4
                yield _row(_ANSWER, key=batch.column("chunk")[i].as_py(), shard=batch.column("shard")[i].as_py(), counts=planes(counts, _WIDE), ids=planes(np.frombuffer(b"".join(ids), "<u4"), _IDS))

    return rows.mapInArrow(work, "key long, shard int, counts binary, ids binary")


def _joined(answers: pa.Table, chunk: pa.Table) -> pa.Table:
    """The ids of a chunk's documents, from the answers to its requests and its words by position."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
    if not chunk.num_rows or chunk["shard"][0].is_valid:
        return schema.empty_table()
    row = chunk.select(["doc_ids", "ends", "places", "shards"]).to_pylist()[0]
    owner = from_planes(row["shards"], _WIDE).astype(np.int64)
    count, first, flat, have = np.zeros(len(owner), np.int64), np.zeros(len(owner), np.int64), [], 0
    order = np.argsort(owner, kind="stable")
    dealt = owner[order]
    for s, counts, ids in zip(answers["shard"].to_pylist(), answers["counts"].to_pylist(), answers["ids"].to_pylist()):
        mine = order[slice(*np.searchsorted(dealt, [s, s + 1]))]
        count[mine] = c = from_planes(counts, _WIDE).astype(np.int64)
        first[mine] = have + np.cumsum(c) - c
        flat.append(from_planes(ids, _IDS).astype(np.uint32))
        have += len(flat[-1])
    flat = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
    if len(owner) and not count.all():
        raise ValueError("a word of a chunk has no answer: the documents changed while they were read")
    places, ends = from_planes(row["places"], _WIDE), from_planes(row["ends"], 8).astype(np.int64)
    n = np.concatenate([[0], np.cumsum(count[places])])
    out = np.empty(n[-1], "<u4")
    for a in range(0, len(places), STEP):
        p = places[a : a + STEP]
        c = count[p]
        out[n[a] : n[a + len(p)]] = flat[np.repeat(first[p] - (n[a : a + len(p)] - n[a]), c) + np.arange(c.sum())]
    at = pa.array(4 * np.concatenate([[0], n[ends]]), pa.int64())
    ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, at.buffers()[1], pa.py_buffer(out)])
    return pa.table([pa.array(row["doc_ids"], pa.int64()), ids.cast(pa.binary())], schema=schema)


def encode(docs: DataFrame, path: str | None = None, chunk_bytes: int = CHUNK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, ids) for each row of docs: the ids of its whole text as little-endian unsigned 32-bit integers."""
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string"))).alias("n")).first()["n"] or 0
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // shard_bytes))
    rows = exploded(docs, shards, chunk_bytes)
    # Both sides read one shuffle, so rows isn't filtered here; groups of requests give nothing.
    return answered(rows, path).groupBy("key").cogroup(rows.groupBy("key")).applyInArrow(_joined, "doc_id long, ids binary")


def token_table(path: str) -> pa.Array:
    """The bytes of each id, null where there is none."""
    tokens = ranks(path)
    table: list[bytes | None] = [None] * (max(tokens.values()) + 1)
    for token, i in tokens.items():
        table[i] = token
    return pa.array(table, pa.large_binary())


def decode(encoded: DataFrame, path: str | None = None, name: str = "decoded") -> DataFrame:
    """encoded (doc_id, ids) with the bytes that the ids stand for; an id that the vocabulary lacks is an error."""
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), (name, pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_table(path)

        def joined(raw: pa.Buffer) -> bytes:
            parts, ids = [], np.frombuffer(raw, "<u4")
            for a in range(0, len(ids), STEP):
                got = table.take(pa.array(ids[a : a + STEP]))
                if got.null_count:
                    raise ValueError("an id is not in the vocabulary")
                at = np.frombuffer(got.buffers()[1], np.int64)
                parts.append(got.buffers()[2][at[0] : at[len(got)]].to_pybytes() if at[len(got)] else b"")
            return b"".join(parts)

        for batch in batches:
            ids, begin = batch.column("ids").cast(pa.binary()), 0
            at = np.concatenate([[0], np.cumsum([0 if x is None else x for x in pc.binary_length(ids).to_pylist()])])
            while begin < len(ids):  # about STEP ids, or one longer row
                end = max(begin + 1, int(np.searchsorted(at, at[begin] + 4 * STEP, "right")) - 1)
                part = ids[begin:end]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[begin:end], part, pa.array([joined(x.as_buffer()) if x.is_valid else None for x in part], pa.binary())], schema=schema)
                begin = end

    return encoded.select("doc_id", "ids").mapInArrow(work, f"doc_id long, ids binary, `{name}` binary")


def op13_distinct_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = decode(encode(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return done.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
