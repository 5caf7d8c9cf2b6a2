"""Text quality by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words. Each passage is encoded by shares of character classes, word
statistics and shares of hashed words; a hidden layer embeds it, gated attention (tanh times sigmoid, softmax over the
bag) weighs it, and a logistic unit scores the weighted mean of the embeddings. Only document labels are used.
Training takes a bounded sample of whole documents: the labelled ones in order of a hash of doc_id, at most SAMPLE of
them and of PASSAGES passages together (a document that would exceed these is left out; looked for among the first
4 * SAMPLE labels); every document's every passage is scored.

Defined results: a null or blank text is one passage without words and gets a score too; without labels of both
classes every score is the share of label 1, or 0.5 without labels; of repeated labels of a doc_id the lowest
counts; rows that share a doc_id are scored each, and one of them is trained on; an empty table gives no rows; all other
columns stay, and the score's column takes underscores in front where docs has one of its name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import as_row, free_name, give_back, mix, slices, text_bytes, words

PASSAGE, SAMPLE, PASSAGES, HIDDEN, EPOCHS, BATCH, RATE, DECAY, WORD_BINS, THRESHOLD = 48, 6000, 1 << 17, 24, 24, 64, 4e-3, 1e-4, 32, 0.3
#: Characters of each class; the classes after these are A-Z, a-z, other ASCII and non-ASCII bytes.
_CLASSES = [b" ", b"\n", b"0123456789", b".", b",", b"|", b"%", b"&", b"$", b"#", b"*", b"!", b"'\"", b":;?", b"<>/=(){}[]", b"-_@+"]


def _byte_classes() -> np.ndarray:
    table = np.full(256, len(_CLASSES) + 2, np.int64)
    table[65:91], table[97:123], table[128:] = len(_CLASSES), len(_CLASSES) + 1, len(_CLASSES) + 3
    for i, chars in enumerate(_CLASSES):
        table[list(chars)] = i
    return table


_CLASS = _byte_classes()
_N_CLASSES = len(_CLASSES) + 4
FEATURES = _N_CLASSES + 8 + WORD_BINS


def encode(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage (rows by FEATURES) and the number of passages of each text."""
    data, at = text_bytes(column)
    hashes, begin, end, where = words(data, at)
    count = np.diff(where)
    passages = np.maximum(1, -(-count // PASSAGE))
    first = np.cumsum(passages) - passages
    total = int(passages.sum())
    doc = np.repeat(np.arange(len(count)), count)
    owner = first[doc] + (np.arange(len(hashes)) - where[doc]) // PASSAGE
    x = np.zeros((total, FEATURES), np.float32)
    if not len(data):
        return x, passages
    n = np.bincount(owner, minlength=total)
    # A passage's bytes run from its first word to the next one's; a text's first passage has what comes before its words too.
    opens = np.flatnonzero(np.diff(owner, prepend=-1))
    start = np.zeros(total, np.int64)
    start[owner[opens]] = begin[opens]
    start[first] = at[:-1]
    of_byte = np.repeat(np.arange(total), np.diff(start, append=len(data)))
    size = np.bincount(of_byte, minlength=total)
    kinds = np.bincount(of_byte * _N_CLASSES + _CLASS[data], minlength=total * _N_CLASSES)
    x[:, :_N_CLASSES] = kinds.reshape(total, -1) / np.maximum(size, 1)[:, None]
    length = (end - begin).astype(np.float64)
    share = lambda v: np.bincount(owner, v, total) / np.maximum(n, 1)
    again = np.zeros(len(hashes))
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    key = np.sort((owner.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    distinct = key[np.concatenate([[True], key[1:] != key[:-1]])] >> np.uint64(40)
    mean = share(length)
    stats = [mean / 10, np.sqrt(np.maximum(share(length * length) - mean * mean, 0)) / 10, share(length <= 3), share(length >= 10), share(again), np.bincount(distinct.astype(np.int64), minlength=total) / np.maximum(n, 1), share((data[begin] >= 65) & (data[begin] <= 90)), np.minimum(n, PASSAGE) / PASSAGE]
    x[:, _N_CLASSES : _N_CLASSES + 8] = np.stack(stats, 1)
    bins = np.bincount(owner * WORD_BINS + (mix(hashes) % np.uint64(WORD_BINS)).astype(np.int64), minlength=total * WORD_BINS)
    x[:, _N_CLASSES + 8 :] = bins.reshape(total, -1) / np.maximum(n, 1)[:, None]
    return x, passages


class AttentionMil:
    """embed: tanh(E x); attention: softmax of g (tanh(V x) * sigmoid(U x)); score: sigmoid(c z + d)."""

    def __init__(self, constant: float = 0.5) -> None:
        self.constant, self.w = constant, None

    def _forward(self, x: np.ndarray, sizes: np.ndarray) -> tuple:
        w = self.w
        e, v = np.tanh(x @ w["E"] + w["e"]), np.tanh(x @ w["V"] + w["v"])
        u = 1 / (1 + np.exp(-(x @ w["U"] + w["u"])))
        at = np.cumsum(sizes) - sizes
        raw = (v * u) @ w["g"]
        a = np.exp(raw - np.repeat(np.maximum.reduceat(raw, at), sizes))
        a /= np.repeat(np.add.reduceat(a, at), sizes)
        z = np.add.reduceat(e * a[:, None], at)
        p = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["d"], -30, 30)))
        return e, v, u, a, z, p, at

    def _gradient(self, x: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the bags' mean log loss."""
        e, v, u, a, z, p, at = self._forward(x, sizes)
        error = ((p - labels) / len(sizes)).astype(x.dtype)
        dz = np.repeat(error[:, None] * self.w["c"], sizes, 0)
        de = dz * a[:, None] * (1 - e * e)
        da = (dz * e).sum(1)
        draw = a * (da - np.repeat(np.add.reduceat(a * da, at), sizes))
        gate = draw[:, None] * self.w["g"]
        dv, du = gate * u * (1 - v * v), gate * v * u * (1 - u)
        return {"E": x.T @ de, "V": x.T @ dv, "U": x.T @ du, "g": (v * u).T @ draw, "c": z.T @ error, "e": de.sum(0), "v": dv.sum(0), "u": du.sum(0), "d": error.sum(keepdims=True)}

    def fit(self, x: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> AttentionMil:
        rng = np.random.default_rng(7)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        x = self._normal(x)
        shape = {"E": (FEATURES, HIDDEN), "V": (FEATURES, HIDDEN), "U": (FEATURES, HIDDEN), "g": (HIDDEN,), "c": (HIDDEN,), "e": (HIDDEN,), "v": (HIDDEN,), "u": (HIDDEN,), "d": (1,)}
        self.w = {k: (rng.normal(0, s[0] ** -0.5, s) if k in "EVUgc" else np.zeros(s)).astype(np.float32) for k, s in shape.items()}
        m, s2, step = {k: np.zeros_like(w) for k, w in self.w.items()}, {k: np.zeros_like(w) for k, w in self.w.items()}, 0
        first = np.cumsum(sizes) - sizes
        for _ in range(EPOCHS):
            order = rng.permutation(len(sizes))
            for i in range(0, len(order), BATCH):
                bags = order[i : i + BATCH]
                n = sizes[bags]
                rows = np.repeat(first[bags] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                xb = x[rows]
                grad = self._gradient(xb, n, labels[bags])
                step += 1
                for k, w in self.w.items():
                    g = grad[k] + DECAY * w
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s2[k] = 0.999 * s2[k] + 0.001 * g * g
                    w -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(s2[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def _normal(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6).astype(np.float32)

    def scores(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if self.w is None:
            return np.full(len(sizes), self.constant)
        return self._forward(self._normal(x), sizes)[5].astype(np.float64)


def train(docs: DataFrame, labels: DataFrame) -> AttentionMil:
    """Fit on docs (doc_id, text) and labels (doc_id, label 0 or 1): the sample described above."""
    wanted = labels.filter("doc_id is not null and label is not null").groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
    wanted = wanted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(4 * SAMPLE)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("hash"))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            _, _, _, where = words(*text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("hash"), pa.array(np.maximum(1, -(-np.diff(where) // PASSAGE)))], ["doc_id", "hash", "n"])

    # Of rows that share a doc_id one is trained on, that of the least hash of its text.
    found = docs.join(F.broadcast(wanted), "doc_id").select("doc_id", "text", "hash").mapInArrow(sizes, "doc_id long, hash long, n long")
    found = found.groupBy("doc_id").agg(F.min(F.struct(F.coalesce("hash", F.lit(0)).alias("hash"), "n")).alias("row"))
    chosen, room = [], PASSAGES
    for r in found.orderBy(F.xxhash64("doc_id"), "doc_id").collect():  # at most 4 * SAMPLE numbers
        if r["row"]["n"] <= room and len(chosen) < SAMPLE:
            chosen.append((r["doc_id"], r["row"]["hash"]))
            room -= r["row"]["n"]
    if not chosen:
        return AttentionMil()

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x, n = encode(batch.column("text"))
            rows = [x[a : a + k].tobytes() for a, k in zip(np.cumsum(n) - n, n)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary())], ["doc_id", "label", "bag"])

    picked = wanted.join(docs.sparkSession.createDataFrame(chosen, "doc_id long, hash long"), "doc_id")
    sampled = docs.withColumn("hash", F.coalesce("hash", F.lit(0))).join(F.broadcast(picked), ["doc_id", "hash"]).select("doc_id", "text", "label").mapInArrow(bags, "doc_id long, label int, bag binary")
    sampled = sampled.groupBy("doc_id", "label").agg(F.min("bag").alias("bag"))  # rows may be repeated
    rows = sorted((r["doc_id"], r["label"], bytes(r["bag"])) for r in sampled.collect())  # at most SAMPLE bags of PASSAGES passages
    if len({r[1] for r in rows}) < 2:
        return AttentionMil(float(np.mean([r[1] for r in rows])) if rows else 0.5)
    parts = [np.frombuffer(r[2], np.float32).reshape(-1, FEATURES) for r in rows]
    return AttentionMil().fit(np.concatenate(parts), np.array([len(p) for p in parts]), np.array([r[1] for r in rows], np.float32))


def with_scores(docs: DataFrame, model: AttentionMil, name: str = "score") -> DataFrame:
    """docs with a column of scores from text, name or free_name(docs, name); all other columns stay."""
    name = free_name(docs, name)
    held = docs.select(as_row(docs))
    place = [c.lower() for c in docs.columns].index("text")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).field(place).cast(pa.string()), batch.column(0)], ["text", "row"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(texts(batches)):
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(model.scores(*encode(batch.column("text"))), pa.float64())], ["row", "score"])
        give_back()

    scored = held.mapInArrow(work, StructType([held.schema["row"], StructField("score", DoubleType())]))
    return scored.select("row.*", F.col("score").alias(name))


def quality_model(spark: SparkSession, sf_dir: str) -> AttentionMil:
    """Trained on the labelled documents of sf_dir that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    return train(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels.select("doc_id", F.col("quality").alias("label")))


def op10_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text").cast("string").alias("text"))
    scored = with_scores(docs, quality_model(spark, sf_dir)).drop("text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
