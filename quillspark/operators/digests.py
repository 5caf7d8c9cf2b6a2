"""SHA-256 over rows in order, for groups of any size, and values at a rank, without a whole table in one place."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of values in a piece; rows that are sorted as a whole; ranges in a step.
PIECE_BYTES, FEW, STEPS = 1 << 20, 100_000, 256


def sequence_digest(df: DataFrame, group: Column, order: Sequence[Column], value: Column, separator: str = "", head: str = "", tail: str = "") -> DataFrame:
    """Per group: n and digest, the SHA-256 of head, the values in order with a separator between, and tail.

    Rows are sorted by ranges and packed into pieces where they are; SHA-256 takes bytes one after another, so one task
    reads the pieces of all groups in order, but holds one piece at a time and keeps no array. Null values count as
    empty; a table without rows has no groups."""
    names = [f"o{i}" for i in range(len(order))]
    rows = df.select(group.cast("string").alias("g"), *(c.alias(n) for c, n in zip(order, names)), F.coalesce(value.cast("string"), F.lit("")).alias("v"))
    sorted_ = rows.repartitionByRange("g", *names).sortWithinPartitions("g", *names).select("g", "v")
    join = separator.encode()
    schema = pa.schema([("part", pa.int64()), ("piece", pa.int64()), ("g", pa.string()), ("n", pa.int64()), ("data", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece, held, group, size = TaskContext.get().partitionId(), 0, [], None, 0

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"part": part, "piece": piece, "g": group, "n": len(held), "data": join.join(held)}], schema)

        for batch in batches:
            for g, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (g != group or size >= PIECE_BYTES):
                    yield made()
                    piece, held, size = piece + 1, [], 0
                group = g
                held.append(v.encode())
                size += len(held[-1])
        if held:
            yield made()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha, group, n = None, None, 0

        def done() -> pa.RecordBatch:
            sha.update(tail.encode())
            return pa.RecordBatch.from_pydict({"g": pa.array([group], pa.string()), "n": pa.array([n], pa.int64()), "digest": [sha.hexdigest()]})

        for batch in batches:
            for row in batch.to_pylist():
                if sha is not None and row["g"] != group:
                    yield done()
                    sha = None
                if sha is None:
                    sha, group, n = hashlib.sha256(head.encode()), row["g"], 0
                else:
                    sha.update(join)
                sha.update(row["data"])
                n += row["n"]
        if sha is not None:
            yield done()

    pieces = sorted_.mapInArrow(pack, "part long, piece long, g string, n long, data binary")
    return pieces.repartition(1).sortWithinPartitions("part", "piece").select("g", "n", "data").mapInArrow(digest, "g string, n long, digest string")


def content_sum(*columns: Column) -> Column:
    """An aggregate that tells groups of rows apart whatever their order: two sums of hashes, combined where the rows are."""
    sums = (F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")) for seed in (1, 2))
    return F.concat_ws(":", *sums)


def ranges(order: Column, edges: Sequence) -> Column:
    """How many of the sorted edges are at most order, found by halving; -1 for null.

    Few edges become nested conditions, which Spark compiles; many are halved in one literal array, as a long condition would not
    compile."""

    def halve(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(order < edges[middle], halve(low, middle)).otherwise(halve(middle + 1, high))

    if len(edges) <= STEPS:
        found = halve(0, len(edges))
    else:
        every = F.lit(list(edges))
        start = F.struct(F.lit(0).alias("low"), F.lit(len(edges)).alias("high"))

        def step(s: Column, _: Column) -> Column:
            middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
            below = order < F.get(every, middle)
            open_ = s["low"] < s["high"]
            return F.struct(F.when(open_ & ~below, middle + 1).otherwise(s["low"]).alias("low"), F.when(open_ & below, middle).otherwise(s["high"]).alias("high"))

        found = F.aggregate(F.sequence(F.lit(0), F.lit(len(edges).bit_length())), start, step)["low"]
    return F.when(order.isNull(), F.lit(-1)).otherwise(found)


def edges_of(df: DataFrame, order: Column, steps: int) -> list:
    """At most steps - 1 values of a numeric column that cut its rows into ranges of about as many each."""
    found = df.agg(F.percentile_approx(order, [i / steps for i in range(1, steps)], 10 * steps).alias("e")).first()["e"]
    return sorted(set(found or []))


def grown_edges(df: DataFrame, order: Column, rows: int, least: int = 64, most: int = 4096) -> list:
    """Edges of a numeric column for ranges of about `rows` rows each, and so of at most about as many of any key, from one pass:
    at least `least` ranges and at most `most`; a table of more than rows * most rows has larger ones."""
    found = df.agg(F.percentile_approx(order, [i / most for i in range(1, most)], 4 * most).alias("e"), F.count("*").alias("n")).first()
    steps = min(most, max(least, -(-found["n"] // rows)))
    edges = found["e"] or []
    return sorted({edges[i * most // steps - 1] for i in range(1, steps)}) if edges else []


def around_rank(df: DataFrame, order: Column, k: int) -> tuple[DataFrame, int]:
    """The rows of df that may be the k-th by a numeric column (from 1), few or all of one value, and k among them."""
    while True:
        edges = edges_of(df, order, STEPS)
        at = ranges(order, edges)
        counts = sorted((r["at"], r["n"]) for r in df.groupBy(at.alias("at")).agg(F.count("*").alias("n")).collect())  # at most STEPS + 1 rows
        total = sum(n for _, n in counts)
        if total <= FEW:
            return df, k
        for bucket, n in counts:
            if k <= n:
                break
            k -= n
        df = df.filter(at == bucket)
        if n == total:
            return df, k
