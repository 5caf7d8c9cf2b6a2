"""Shared helpers: shared-folder tables, Arrow text access and vectorised word hashing."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step looks at.
SLICE_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; only a local session may do without one."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared")
        where = spark.sparkContext.getCheckpointDir()
    return where.rstrip("/")


def free_name(df: DataFrame, name: str) -> str:
    """name, with as many underscores in front as df's own columns need."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def named(name: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_row(df: DataFrame) -> Column:
    """All columns of df as one struct, row: passes through Arrow functions whatever the columns' names."""
    return F.struct(*map(named, df.columns)).alias("row")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return memory that a worker's task has freed to the system, as the worker stays for the stages that follow."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and each row's offsets into them (one more than rows); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches by rows so that each holds about limit bytes of text, or one longer row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = text_bytes(batch.column(text))
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(at, at[begin] + limit, "right")) - 1)
            yield batch.slice(begin, end - begin)
            begin = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def planes(x: np.ndarray, width: int) -> bytes:
    """The low width bytes of unsigned numbers, compressed: all first bytes, then all second ones, and so on."""
    return zstandard.compress(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes(), 1)


def from_planes(data: bytes | pa.Buffer, width: int | None = None, n: int | None = None) -> np.ndarray:
    """The numbers of planes, of known width or known number."""
    parts = np.frombuffer(zstandard.decompress(data), np.uint8)
    parts = parts.reshape(width, -1) if width else parts.reshape(-1, n)
    out = np.zeros((parts.shape[1], 8), np.uint8)
    out[:, : len(parts)] = parts.T
    return out.view("<u8").ravel()


_STEP = 0x9E3779B97F4A7C15
_LETTER = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_STEP))
#: A to Z as their lower case, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_LETTER_LOWER = _LETTER[LOWER]
#: The white space of the word rules: space and U+0009 to U+000D.
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, SLICE_BYTES + (1 << 16))
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of every row: 64-bit hash with A-Z lower-cased, first byte, end byte, and each row's offsets into the words."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, np.zeros(len(at), np.int64)
    inside = ~BLANK[data]
    cut = np.zeros(n + 1, bool)
    cut[at] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:-1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _power_tables(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_LETTER_LOWER[data] * up[:n], out=sums[1:])
    hashes = mix((sums[end] - sums[begin]) * down[begin])
    return hashes, begin, end, np.searchsorted(begin, at)


def shingles(hashes: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """k-word shingles in order: hash, row, and first word. A row with 1 to k-1 words has its whole sequence as one."""
    n = np.diff(at)
    row = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(hashes)) - at[row]
    full = place <= n[row] - k
    begin = np.flatnonzero(full)
    got = np.full(len(begin), k * _STEP % (1 << 64), np.uint64)
    for j in range(k):
        got = mix(got + hashes[begin + j])
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        rest = np.empty(len(short), np.uint64)
        for i, r in enumerate(short):
            x = np.full(1, int(n[r]) * _STEP % (1 << 64), np.uint64)
            for h in hashes[at[r] : at[r + 1]]:
                x = mix(x + h)
            rest[i] = x[0]
        begin = np.concatenate([begin, at[short]])
        got = np.concatenate([got, rest])
        order = np.argsort(begin, kind="stable")
        begin, got = begin[order], got[order]
    return got, row[begin], begin
