"""Cost-balanced packing of whole documents into sequences of at most CAPACITY tokens.

The attention cost of a piece of n tokens is estimated as LINEAR * n + QUADRATIC * n * n. Documents are dealt
round robin into bins of about BIN_BYTES of text, and of BIN_ROWS rows at most; a bin opens ceil(tokens / CAPACITY) sequences, so that it
pads fewer than CAPACITY tokens in all. Documents longer than a sequence are cut into full sequences and a
rest. Documents and rests go, in descending length, to the lowest-cost sequence whose remaining capacity
holds them whole; where none does, to the lowest-cost sequences with room, cut to fit. No token is lost.

Defined results: a null text is empty and has the end id only; rows that share a doc_id are packed
separately, those without one too; other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import give_back
from .encoding import REMEMBERED, encoder

CAPACITY, LINEAR, QUADRATIC, BIN_BYTES, BIN_ROWS = 4096, 1.0, 1.0 / 1024, 8 << 20, 1 << 16


def assign(lengths: np.ndarray, capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents with these lengths, each at least 1."""
    lengths = np.asarray(lengths, np.int64)
    opened = -(-int(lengths.sum()) // capacity)
    full = lengths // capacity
    pieces = [(int(d), k * capacity, capacity, 0, 0) for d in np.flatnonzero(full) for k in range(full[d])]
    pieces = [(d, s, n, i, 0) for i, (d, s, n, _, _) in enumerate(pieces)]
    left = opened - len(pieces)
    room, cost = np.full(left, capacity, np.int64), np.zeros(left)
    rest = lengths - full * capacity
    for d in np.argsort(-rest, kind="stable"):
        n, start = int(rest[d]), int(full[d] * capacity)
        while n:
            fits = np.flatnonzero(room >= n)
            if not len(fits):
                fits = np.flatnonzero(room)
            i = int(fits[np.argmin(cost[fits])])
            take = min(n, int(room[i]))
            pieces.append((int(d), start, take, opened - left + i, capacity - int(room[i])))
            room[i] -= take
            cost[i] += linear * take + quadratic * take * take
            start, n = start + take, n - take
    return pieces


def pack(docs: DataFrame, vocabulary: str | None = None, end_id: int = 2, capacity: int = CAPACITY, bin_bytes: int = BIN_BYTES, remembered: int = REMEMBERED, forget: bool = False) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit).

    remembered: pieces whose ids a worker keeps; forget: not beyond a task, whose memory goes back to the system. Memory against
    time, the same result."""
    vocabulary = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("rows")).first()
    bins = max(1, -(-(size["bytes"] or 0) // bin_bytes), -(-size["rows"] // BIN_ROWS))
    end = np.array([end_id], "<u4").tobytes()
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")] + [("ids", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, first = encoder(vocabulary, remembered), TaskContext.get().partitionId() << 32
        doc_ids, ids = [], []
        for batch in batches:
            doc_ids += batch.column(0).to_pylist()
            ids += [e.encode(t.as_py()) + end for t in batch.column(1)]
        if forget:
            e.forget()
        if not ids:
            return
        pieces = assign(np.array([len(x) // 4 for x in ids]), capacity)
        pieces.sort(key=lambda p: (p[3], p[4]))
        for i in range(0, len(pieces), 4000):
            rows = [(doc_ids[d], s, n, zlib.crc32(b := ids[d][4 * s : 4 * (s + n)]), len(ids[d]) // 4, first + q, o, b) for d, s, n, q, o in pieces[i : i + 4000]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        if forget:
            doc_ids, ids, pieces, rows = [], [], [], []
            give_back()

    return docs.repartition(bins).mapInArrow(work, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("ids")
