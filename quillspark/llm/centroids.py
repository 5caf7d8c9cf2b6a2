"""Centroid clustering of integer vectors: a float32 screen with rigorous error intervals, then exact integers.

Every round reads the vectors where they lie. For a block of vectors and all centroids one float32 matrix product gives
approximate scores |c|^2 - 2 x.c; each comes with an interval that holds the exact score whatever the order in which the
product was summed. Centroids whose interval begins after the least upper end cannot be nearest. Where one centroid is
left it is the nearest; where intervals overlap those centroids are compared by exact integers, and of equal distances the
lowest number wins. Tasks send one row of sums a centroid, so a round moves tasks x centroids rows and the driver sees
one row a centroid.

Error bound: a product of n float32 terms, summed in any order with or without fused operations, differs from the exact
one by at most g = m * u / (1 - m * u) times the sum of the absolute terms, u = 2**-24, with m = n and one more for each
rounding of an input (components beyond 2**24 aren't exact in float32); that sum is at most |x| * |c| (Cauchy-Schwarz).
Norms and interval ends are taken in float64, whose own errors are covered by SLACK.

Kept are vectors of exactly `size` components, none null or non-finite, whose integers floor(scale * x) fit in 64 bits.
Integers beyond 2**27, whose squares could overflow, are compared by Python's integers instead of the screen, with the same
result. Defined results: fewer kept vectors than centroids give as many centroids as vectors; equal seed hashes (a repeated
vec_id) are ordered by the vectors; a null vec_id seeds only where nothing else is left; a distance or inertia beyond 64 bits is
null; an empty table gives no rows; columns other than vec_id and embedding are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

SIZE, SCALE, CENTROIDS, ROUNDS = 64, 64, 16, 3
#: Unit rounding of float32; what covers float64's rounding in norms and interval ends; largest integer for the screen.
UNIT, SLACK, SCREENED = 2.0**-24, 2.0**-40, 1 << 27
#: Vectors in one matrix product.
BLOCK = 4096


def kept(ids: pa.Array, vectors: pa.Array, size: int = SIZE, scale: int = SCALE) -> tuple[pa.Array, np.ndarray]:
    """The vec_ids and integer vectors of the rows that are kept."""
    vectors = vectors.cast(pa.large_list(pa.float64()))
    at, values = vectors.offsets.to_numpy(), vectors.values
    fine = np.flatnonzero((np.diff(at) == size) & vectors.is_valid().to_numpy(zero_copy_only=False))
    x = values.to_numpy(zero_copy_only=False)[at[fine][:, None] + np.arange(size)]  # nulls become NaN
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(x * scale)
    good = (np.abs(x) < 2.0**63).all(axis=1)  # false for NaN
    return ids.take(pa.array(fine[good])), x[good].astype(np.int64)


class Screen:
    """nearest(x) gives each vector's centroid, and how many exact comparisons it took."""

    def __init__(self, centroids: list[list[int]]) -> None:
        self.exact = centroids
        self.wide = any(abs(v) > SCREENED for c in centroids for v in c)
        if not self.wide:
            self.c = np.array(centroids, np.int64)
            self.single = np.ascontiguousarray(self.c.T.astype(np.float32))
            self.square = (self.c**2).sum(axis=1)  # at most 2**60 for 64 components
            self.norm = np.sqrt(self.square.astype(np.float64)) * (1 + SLACK)
            m = (len(centroids[0]) + 2) * UNIT
            self.error = m / (1 - m)

    def intervals(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper ends of |c|^2 - 2 x.c."""
        product = (x.astype(np.float32) @ self.single).astype(np.float64)
        length = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) * (1 + SLACK)
        square = self.square.astype(np.float64)
        spread = 2 * self.error * length[:, None] * self.norm + SLACK * (square + 2 * np.abs(product) + 1)
        middle = square - 2 * product
        return middle - spread, middle + spread

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, int]:
        out, compared = np.zeros(len(x), np.int64), 0
        narrow = np.zeros(len(x), bool) if self.wide else (np.abs(x) <= SCREENED).all(axis=1)
        for i in np.flatnonzero(~narrow):
            out[i] = min(range(len(self.exact)), key=lambda j: (plain_distance(x[i].tolist(), self.exact[j]), j))
        rows = np.flatnonzero(narrow)
        for begin in range(0, len(rows), BLOCK):
            at = rows[begin : begin + BLOCK]
            low, high = self.intervals(x[at])
            left = low <= high.min(axis=1, keepdims=True)
            out[at] = left.argmax(axis=1)
            open_ = np.flatnonzero(left.sum(axis=1) > 1)
            if len(open_):
                r, j = np.nonzero(left[open_])
                d = ((x[at[open_[r]]] - self.c[j]) ** 2).sum(axis=1)  # components differ by 2**28 at most: below 2**62
                compared += len(d)
                order = np.lexsort((j, d, r))
                first = order[np.unique(r[order], return_index=True)[1]]
                out[at[open_]] = j[first]
        return out, compared

    def distance(self, x: np.ndarray, j: np.ndarray) -> list[int]:
        if not self.wide and (np.abs(x) <= SCREENED).all():
            return ((x - self.c[j]) ** 2).sum(axis=1).tolist()
        return [plain_distance(v, self.exact[k]) for v, k in zip(x.tolist(), j.tolist())]


def plain_distance(a: list[int], b: list[int]) -> int:
    return sum((x - y) ** 2 for x, y in zip(a, b))


def seeds(vectors: DataFrame, k: int, size: int = SIZE, scale: int = SCALE) -> list[list[int]]:
    """The k kept vectors of least SHA-256 of 1:<vec_id>, in that order: a bounded heap a task and one merge."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = kept(batch.column(0), batch.column(1), size, scale)
            for a in range(0, len(x), BLOCK):
                part = x[a : a + BLOCK]
                yield pa.RecordBatch.from_arrays([ids[a : a + BLOCK], pa.ListArray.from_arrays(np.arange(len(part) + 1, dtype=np.int32) * size, part.ravel())], names=["vec_id", "vector"])

    found = vectors.mapInArrow(work, "vec_id long, vector array<long>").withColumn("hash", F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256))
    return [list(r["vector"]) for r in found.orderBy(F.asc_nulls_last("hash"), "vector").limit(k).collect()]


def moved(vectors: DataFrame, centroids: list[list[int]], size: int = SIZE, scale: int = SCALE) -> list[list[int]]:
    """The centroids after one round: the exact floor of each component's mean, where a centroid has vectors."""
    total = pa.decimal128(38, 0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        screen, k = Screen(centroids), len(centroids)
        n, sums = [0] * k, [[0] * size for _ in range(k)]
        for batch in batches:
            _, x = kept(batch.column(0), batch.column(1), size, scale)
            if not len(x):
                continue
            near, _ = screen.nearest(x)
            for j in np.unique(near).tolist():
                mine = x[near == j]
                n[j] += len(mine)
                high, low = mine >> 32, mine & 0xFFFFFFFF  # two parts, so that no sum overflows
                sums[j] = [s + (h << 32) + w for s, h, w in zip(sums[j], high.sum(axis=0).tolist(), low.sum(axis=0).tolist())]
        some = [j for j in range(k) if n[j]]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([n[j] for j in some], pa.int64()), *(pa.array([sums[j][i] for j in some], total) for i in range(size))], names=["cluster", "n", *(f"s{i}" for i in range(size))])

    ddl = "cluster int, n long, " + ", ".join(f"s{i} decimal(38,0)" for i in range(size))
    parts = vectors.mapInArrow(work, ddl).groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(size)))
    out = [list(c) for c in centroids]
    for r in parts.collect():  # one row a centroid
        out[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(size)]
    return out


def assigned(vectors: DataFrame, centroids: list[list[int]], size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """(vec_id, cluster, distance) of every kept vector; distance is exact, as decimal(38,0)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        screen = Screen(centroids)
        for batch in batches:
            ids, x = kept(batch.column(0), batch.column(1), size, scale)
            near, _ = screen.nearest(x)
            far = [d if d < 10**38 else None for d in screen.distance(x, near)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(near, pa.int32()), pa.array(far, pa.decimal128(38, 0))], names=["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(work, "vec_id long, cluster int, distance decimal(38,0)")


def cluster(table: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE) -> tuple[DataFrame, list[list[int]]]:
    """The kept vectors of table (vec_id, embedding) with their cluster and distance, and the final centroids."""
    vectors = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    centroids = seeds(vectors, k, size, scale)
    if not centroids:
        return table.sparkSession.createDataFrame([], "vec_id long, cluster int, distance decimal(38,0)"), []
    for _ in range(rounds):
        centroids = moved(vectors, centroids, size, scale)
    return assigned(vectors, centroids, size, scale), centroids


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, centroids = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    rows = stored(rows, "op11-assigned")
    sums = {r["cluster"]: r["d"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # one row a centroid
    fits = lambda d: d if d is not None and d < 1 << 63 else None
    inertia = None if None in sums.values() else sum(map(int, sums.values()))
    table = [(j, fits(None if sums.get(j) is None else int(sums[j])), fits(inertia), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids)]
    known = spark.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    distance = F.expr("try_cast(distance AS long)").alias("distance")
    return rows.join(F.broadcast(known), "cluster").select("vec_id", "cluster", distance, "cluster_inertia", "inertia", "centroid_sha256")  # known has one row a centroid


_ROUND = """
, a{r} AS MATERIALIZED (SELECT v.n, v.vec_id, v.x, min_by(c.j, c.d * 16 + c.j) AS j, min(c.d) AS d
  FROM v, LATERAL (SELECT c{r}.j, list_sum(list_transform(list_zip(v.x, c{r}.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT AS d FROM c{r}) c GROUP BY v.n, v.vec_id, v.x)
, m{r} AS MATERIALIZED (SELECT j, list(q ORDER BY i) AS x FROM (
  SELECT j, i, (sum(y) - ((sum(y) % count(*)) + count(*)) % count(*)) // count(*) AS q FROM (SELECT j, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM a{r}) GROUP BY j, i) GROUP BY j)
, c{s} AS MATERIALIZED (SELECT c{r}.j, coalesce(m{r}.x, c{r}.x) AS x FROM c{r} LEFT JOIN m{r} USING (j))"""

OP11_SQL = (
    """
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda e: floor(64 * e::DOUBLE)::HUGEINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64)
, c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST, x) - 1 AS j, x FROM (SELECT sha256('1:' || vec_id) AS h, x FROM v ORDER BY h NULLS LAST, x LIMIT 16))"""
    + "".join(_ROUND.format(r=r, s=r + 1) for r in range(3))
    + """
, a3 AS MATERIALIZED (SELECT v.n, v.vec_id, min_by(c.j, c.d * 16 + c.j) AS j, min(c.d) AS d
  FROM v, LATERAL (SELECT c3.j, list_sum(list_transform(list_zip(v.x, c3.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT AS d FROM c3) c GROUP BY v.n, v.vec_id)
SELECT vec_id, a3.j::INT AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY a3.j))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c3.x, ',')) AS centroid_sha256
FROM a3 JOIN c3 USING (j)"""
)
