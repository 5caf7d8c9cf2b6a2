"""Benchmark decontamination by SimHash of item-sized windows.

Texts are lower-cased words; shingles have K words (an item of fewer words is one shingle). For each item length
every window of as many words is a candidate if enough of its shingles occur anywhere in the benchmark: fewer could
not reach the similarity. Such a window's 64-bit SimHash, weighted by shingle counts, is looked up in a multi-index:
four blocks of 16 bits, each bucket listing the items within RADIUS / 4 bits of it, so that every fingerprint within
RADIUS is met in some block. Candidates of the window's length within RADIUS are verified by the weighted Jaccard
similarity of their shingle counts, sum of minima over sum of maxima, at least PERCENT / 100.

The benchmark is the query set: it is taken in blocks of about ITEMS items and ITEM_BYTES bytes (or one longer item), whose
index is sent to the executors; each block reads the documents once. No document leaves its task.

Defined results: null or blank texts and items match nothing; a text shorter than an item is one window; of equally
similar windows the first counts; rows that share a doc_id give rows each, items that share an item_id or are repeated
too; a null item_id or doc_id stays null; other columns aren't looked at (without_leaks keeps them);
empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_row, mix, shingles, slices, text_bytes, words

K, PERCENT, RADIUS, BLOCKS, ITEMS, ITEM_BYTES = 5, 80, 19, 4, 1024, 16 << 20
_BITS = np.arange(64, dtype=np.uint64)


def _fingerprints(grams: np.ndarray, begin: np.ndarray, length: int) -> np.ndarray:
    """SimHash of grams[b : b + length] for each b."""
    base, end = int(begin.min()), int(begin.max()) + length
    signs = ((mix(grams[base:end])[:, None] >> _BITS) & np.uint64(1)).astype(np.int32) * 2 - 1
    sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(signs, 0, dtype=np.int32)])
    high = (sums[begin - base + length] - sums[begin - base]) > 0
    return (high.astype(np.uint64) << _BITS).sum(1, dtype=np.uint64)


def _need(window: int, item: int, percent: int) -> int:
    """Least weighted intersection that may reach the similarity."""
    return -(-percent * (window + item) // (100 + percent))


class Index:
    """A block of items, their shingles, and the multi-index of their fingerprints."""

    def __init__(self, items: list[tuple[int | None, str, int]], k: int, percent: int, radius: int) -> None:
        self.k, self.percent, self.radius = k, percent, radius
        data, at = text_bytes(pa.array([t for _, t, _ in items], pa.string()))
        hashes, _, _, where = words(data, at)
        self.ids, self.times, self.width, self.grams = [], [], [], []
        for (item_id, _, times), a, b in zip(items, where[:-1], where[1:]):
            if b > a:
                width = min(k, int(b - a))
                self.ids.append(item_id)
                self.times.append(times)
                self.width.append(width)
                self.grams.append(shingles(hashes[a:b], np.array([0, b - a]), width)[0])
        self.size = np.array([len(g) for g in self.grams])
        self.prints = np.array([_fingerprints(g, np.zeros(1, int), len(g))[0] for g in self.grams], np.uint64)
        self.known = {w: np.unique(np.concatenate([g for g, x in zip(self.grams, self.width) if x == w])) for w in set(self.width)}
        self.sizes = {w: sorted({int(n) for n, x in zip(self.size, self.width) if x == w}) for w in set(self.width)}
        reach = radius // BLOCKS
        flips = np.array([sum(1 << b for b in c) for r in range(reach + 1) for c in combinations(range(16), r)], np.uint64)
        self.tables = []
        for block in range(BLOCKS):
            part = (self.prints >> np.uint64(16 * block)) & np.uint64(0xFFFF)
            bucket = (part[:, None] ^ flips).ravel().astype(np.int64)
            item = np.repeat(np.arange(len(self.ids)), len(flips))
            order = np.argsort(bucket, kind="stable")
            self.tables.append((np.searchsorted(bucket[order], np.arange((1 << 16) + 1)), item[order].astype(np.int32)))

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a fingerprint's place and an item, each once, within the radius."""
        pairs = []
        for block, (at, item) in enumerate(self.tables):
            part = ((prints >> np.uint64(16 * block)) & np.uint64(0xFFFF)).astype(np.int64)
            n = at[part + 1] - at[part]
            place = np.repeat(at[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            pairs.append(np.repeat(np.arange(len(prints)), n) * len(self.ids) + item[place])
        pair = np.unique(np.concatenate(pairs))
        where, item = pair // len(self.ids), pair % len(self.ids)
        near = np.bitwise_count(prints[where] ^ self.prints[item]) <= self.radius
        return where[near], item[near]

    def matches(self, grams: np.ndarray, width: int) -> list[tuple[int, float, int, int]]:
        """Item's place, similarity, first shingle and length of the best windows of a text with these shingles."""
        hit = np.isin(grams, self.known[width])
        if not hit.any():
            return []
        before = np.concatenate([[0], np.cumsum(hit)])
        best: dict[int, tuple[float, int, int]] = {}
        for size in self.sizes[width]:
            n = min(size, len(grams))
            begin = np.flatnonzero(before[n:] - before[:-n] >= max(1, _need(n, size, self.percent)))
            if not len(begin):
                continue
            where, item = self.candidates(_fingerprints(grams, begin, n))
            for s, i in zip(begin[where].tolist(), item.tolist()):
                if self.size[i] == size and self.width[i] == width:
                    low, high = _overlap(grams[s : s + n], self.grams[i])
                    if 100 * low >= self.percent * high and (i not in best or low / high > best[i][0]):
                        best[i] = (low / high, s, n)
        return [(i, *found) for i, found in sorted(best.items())]


def _overlap(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sums of minima and of maxima of both sides' shingle counts."""
    every, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = np.bincount(place[: len(a)], minlength=len(every)), np.bincount(place[len(a) :], minlength=len(every))
    return int(np.minimum(x, y).sum()), int(np.maximum(x, y).sum())


def _blocks(benchmark: DataFrame, k: int, percent: int, radius: int) -> Iterator[Index]:
    """The benchmark's index, in blocks of about ITEMS items and ITEM_BYTES bytes; an item that is repeated stands once, with its number."""
    items = benchmark.filter("text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.lower(F.col("text").cast("string")).alias("text"))
    items = items.groupBy("item_id", "text").agg(F.count("*").alias("times"))
    size = items.agg(F.count("*").alias("items"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(1, -(-size["items"] // ITEMS), -(-(size["bytes"] or 0) // ITEM_BYTES))
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        yield Index(sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])), k, percent, radius)


def _found(index: Index, batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, dict[int, list]]]:
    """Slices of batches, each with the matches of its rows that have any: item's place, similarity, first shingle, words."""
    marks = {}
    for width, known in index.known.items():  # a quick look before the exact one
        marks[width] = np.zeros(1 << 22, bool)
        marks[width][known & np.uint64((1 << 22) - 1)] = True
    for batch in slices(batches, text):
        data, at = text_bytes(batch.column(text))
        hashes, _, _, where = words(data, at)
        n, rows = np.diff(where), {}
        for width in index.known:
            gram, row, _ = shingles(hashes, where, width)
            first = np.searchsorted(row, np.arange(batch.num_rows + 1))
            for r in np.unique(row[marks[width][gram & np.uint64((1 << 22) - 1)]]).tolist():
                if n[r] >= width and (got := index.matches(gram[first[r] : first[r + 1]], width)):
                    rows.setdefault(r, []).extend((i, similarity, s, m + width - 1) for i, similarity, s, m in got)
        yield batch, rows


def leaks(docs: DataFrame, benchmark: DataFrame, k: int = K, percent: int = PERCENT, radius: int = RADIUS) -> DataFrame:
    """Pairs of docs (doc_id, text) and benchmark (item_id, text): doc_id, item_id, similarity, start_word, n_words."""
    columns = "doc_id long, item_id long, similarity double, start_word long, n_words long"
    docs = docs.filter("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text"))
    names, kinds = [c.split()[0] for c in columns.split(", ")], [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]

    def against(index: Index) -> DataFrame:
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, found in _found(sent.value, batches, "text"):
                rows = [(batch.column("doc_id")[r].as_py(), sent.value.ids[i], *rest) for r, got in found.items() for i, *rest in got for _ in range(sent.value.times[i])]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        return docs.mapInArrow(work, columns)

    return reduce(DataFrame.unionByName, map(against, _blocks(benchmark, k, percent, radius)))


def without_leaks(docs: DataFrame, benchmark: DataFrame, k: int = K, percent: int = PERCENT, radius: int = RADIUS) -> DataFrame:
    """The rows of docs (with text; all columns stay) that match no item; rows never leave their partition."""
    out = docs.select(F.lower(F.col("text").cast("string")).alias("text"), as_row(docs))

    def without(out: DataFrame, index: Index) -> DataFrame:
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, found in _found(sent.value, batches, "text"):
                yield batch.filter(pa.array([r not in found for r in range(batch.num_rows)], pa.bool_()))

        return out.mapInArrow(work, out.schema)

    return reduce(without, _blocks(benchmark, k, percent, radius), out).select("row.*")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
