"""Token-id output as Re-Pair grammars.

Documents are dealt by ranges of doc_id into shards and encoded; each shard writes blocks of about BLOCK ids.
In a block, frequent pairs of neighbouring symbols within a document are replaced by new nonterminals, round
after round, until no pair stands LEAST times: every round counts all pairs (of a run of equal symbols every second
one), takes the most frequent ones that cannot overlap (no symbol is the left part of one and the right part of
another), and replaces them together. Each block of a shard has a grammar of its own, so that ids are decoded from one
row and a shard of any size takes the memory of a block. A block keeps its rules, the
number of ids each rule expands to, and each document's symbols, so that any range of ids of a document can
be decoded from the symbols that cover it.

File format (Parquet, one row per block): shard, block, shard_start (ids of the shard before the block),
n_tokens, doc_ids, doc_symbols and doc_tokens (little-endian unsigned 32-bit, one per document), rules (pairs
of symbols, unsigned 32-bit), expansions (ids under each rule, unsigned 32-bit), symbols (unsigned 16-bit, or
32-bit where wide is true).

Defined results: a null text is empty and has the end id only; rows that share a doc_id stay separate, one after
another in the order of the table, and many of them need not meet in one shard; a null doc_id comes first; an empty table
gives an empty file set and no rows; columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import shared_dir
from .encoding import encoder, runs

#: Ids in a block, least count of a pair that is replaced, pieces that a worker remembers.
BLOCK, LEAST, REMEMBERED = 1 << 20, 6, 600_000
#: Marks of a symbol: the last of its document; begins a pair that may be frequent.
LAST, LIVE = np.uint8(1), np.uint8(2)
SCHEMA = "shard int, block int, shard_start long, n_tokens long, doc_ids array<long>, doc_symbols binary, doc_tokens binary, base int, rules binary, expansions binary, wide boolean, symbols binary"


def _bins(left: np.ndarray, right: np.ndarray, mask: int) -> np.ndarray:
    return (left * np.uint32(0x9E3779B1) ^ right * np.uint32(0x85EBCA6B)) >> np.uint32(7) & np.uint32(mask)


def _pairs(symbols: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Places of pairs that may be frequent, of a run of equal symbols every second one, their keys, and bins by a hash.

    Pairs that are rare stay rare, as later rounds only take from them: their marks lose LIVE."""
    at = np.flatnonzero(marks[:-1] == LIVE)
    left, right = symbols.take(at), symbols[1:].take(at)
    mask = (1 << max(8, min(20, len(at).bit_length()))) - 1
    bins = _bins(left, right, mask).astype(np.intp)  # an index of another width would be converted at each use
    equal = np.flatnonzero(left == right)
    fine = None
    if len(equal):
        fine = np.ones(len(at), bool)
        opens = np.concatenate([[True], np.diff(at[equal]) != 1])
        odd = (np.arange(len(equal)) - np.flatnonzero(opens)[np.cumsum(opens) - 1]) & 1
        fine[equal[odd == 1]] = False
    often = (np.bincount(bins[fine] if len(equal) else bins, minlength=mask + 1) >= LEAST).take(bins)
    marks[at.take(np.flatnonzero(~often))] = 0
    take = np.flatnonzero(often if fine is None else fine & often)
    return at.take(take), (left.take(take).astype(np.uint64) << np.uint64(32)) | right.take(take), bins.take(take), mask


def compress(ids: np.ndarray, ends: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, end of each document among them, rules (n x 2) and ids under each rule. base: first nonterminal."""
    symbols = ids.astype(np.uint32)
    marks = np.full(len(symbols), LIVE, np.uint8)
    marks[ends[ends > 0] - 1] |= LAST
    rules: list[np.ndarray] = []
    size = np.ones(base, np.int64)
    while len(symbols) > 1:
        at, keys, bins, mask = _pairs(symbols, marks)
        ordered = np.sort(keys)
        edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, int)
        count = np.diff(np.append(edge, len(ordered)))
        often = count >= LEAST
        best = ordered[edge[often][np.argsort(-count[often], kind="stable")]]
        left, right, chosen = set(), set(), []
        for key in best.tolist():
            a, b = key >> 32, key & 0xFFFFFFFF
            if a not in right and b not in left and (a != b or (a not in left and b not in right)):
                left.add(a)
                right.add(b)
                chosen.append(key)
        if not chosen:
            break
        chosen = np.array(chosen, np.uint64)
        pairs = np.stack([chosen >> np.uint64(32), chosen & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)
        _, alone = np.unique(_bins(pairs[:, 0], pairs[:, 1], mask), return_index=True)  # of pairs in one bin the others wait for a later round
        chosen, pairs = chosen[alone], pairs[alone]
        first = base + sum(map(len, rules))
        rule_of = np.full(mask + 1, -1, np.int32)
        rule_of[_bins(pairs[:, 0], pairs[:, 1], mask)] = np.arange(len(chosen))
        slot = rule_of.take(bins)
        hit = np.flatnonzero(slot >= 0)
        hit = hit[chosen.take(slot.take(hit)) == keys.take(hit)]
        at, slot = at.take(hit), slot.take(hit)
        symbols[at] = (first + slot).astype(np.uint32)
        marks[at] = marks[1:].take(at) | LIVE
        marks[np.maximum(at - 1, 0)] |= LIVE
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        # A pair before a replaced one begins at the symbol before it, or at the nonterminal that took that one's place.
        before = np.flatnonzero(~keep[np.maximum(at - 1, 0)])
        marks[np.maximum(at[before] - 2, 0)] |= LIVE
        stay = np.flatnonzero(keep)
        symbols, marks = symbols.take(stay), marks.take(stay)
        rules.append(pairs)
        size = np.concatenate([size, size[pairs[:, 0]] + size[pairs[:, 1]]])
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    return symbols, np.flatnonzero(marks & LAST) + 1, table, size[base:]


def expand(symbols: np.ndarray, base: int, rules: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ids under symbols. Rules are expanded level by level, those of a level side by side."""
    sizes = sizes.astype(np.int64)
    size = np.concatenate([np.ones(base, np.int64), sizes])
    begin = np.concatenate([np.arange(base), base + np.cumsum(sizes) - sizes])
    flat = np.empty(base + int(sizes.sum()), np.uint32)
    flat[:base] = np.arange(base)
    level, left, right = np.zeros(base + len(rules), np.int64), rules[:, 0], rules[:, 1]
    while True:
        deeper = 1 + np.maximum(level[left], level[right])
        if (deeper == level[base:]).all():
            break
        level[base:] = deeper
    order = np.argsort(level[base:], kind="stable")
    for some in np.split(order, np.flatnonzero(np.diff(level[base:][order])) + 1):
        for part, at in ((left[some], begin[base + some]), (right[some], begin[base + some] + size[left[some]])):
            flat[runs(at, size[part])] = flat[runs(begin[part], size[part])]
    return flat[runs(begin[symbols], size[symbols])]


def _row(shard: int, block: int, start: int, docs: list[tuple[int, bytes]], base: int) -> dict:
    tokens = np.array([len(ids) // 4 for _, ids in docs], np.int64)
    return _block(shard, block, start, [d for d, _ in docs], tokens, np.frombuffer(b"".join(ids for _, ids in docs), "<u4"), base)


def _block(shard: int, block: int, start: int, doc_ids: list[int], tokens: np.ndarray, ids: np.ndarray, base: int) -> dict:
    symbols, ends, rules, sizes = compress(ids, np.cumsum(tokens), base)
    wide = base + len(rules) > 1 << 16
    return {
        "shard": shard, "block": block, "shard_start": start, "n_tokens": int(tokens.sum()), "doc_ids": doc_ids,
        "doc_symbols": np.diff(ends, prepend=0).astype("<u4").tobytes(), "doc_tokens": tokens.astype("<u4").tobytes(), "base": base,
        "rules": rules.astype("<u4").tobytes(), "expansions": sizes.astype("<u4").tobytes(), "wide": wide, "symbols": symbols.astype("<u4" if wide else "<u2").tobytes(),
    }


def _ended(ids: np.ndarray, count: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """ids with end_id after each text's, and how many each then has."""
    out, last = np.empty(len(ids) + len(count), np.uint32), np.zeros(len(ids) + len(count), bool)
    last[np.cumsum(count + 1) - 1] = True
    out[last], out[~last] = end_id, ids
    return out, count + 1


def _cut(slices: Iterator[tuple[list, np.ndarray, np.ndarray]], least: int) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Documents (names, ids one after another, ids of each) in blocks, each up to the document with which it has least ids."""
    names, parts, counts, held = [], [], [], 0
    for mine, ids, count in slices:
        while len(count):
            ends = np.cumsum(count)
            n = min(int(np.searchsorted(ends, least - held)) + 1, len(ends))
            m = int(ends[n - 1])
            names, parts, counts, held = names + mine[:n], [*parts, ids[:m]], [*counts, count[:n]], held + m
            mine, ids, count = mine[n:], ids[m:], count[n:]
            if held >= least:
                yield names, np.concatenate(parts), np.concatenate(counts)
                names, parts, counts, held = [], [], [], 0
    if names:
        yield names, np.concatenate(parts), np.concatenate(counts)


def write_ids(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 0, shards: int | None = None) -> None:
    """Encode docs (doc_id, text) and write the files described above to path. shards: as many as docs has input splits,
    whose size Spark bounds, if not given."""
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    shards = shards or max(1, docs.rdd.getNumPartitions())
    arrow = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("shard_start", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), *((n, pa.binary()) for n in ("doc_symbols", "doc_tokens")), ("base", pa.int32()), *((n, pa.binary()) for n in ("rules", "expansions")), ("wide", pa.bool_()), ("symbols", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, shard = encoder(vocabulary, REMEMBERED), TaskContext.get().partitionId()
        base = max(e.tokenizer.get_vocab_size(), end_id + 1)

        def slices() -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
            for batch in batches:
                doc_ids = batch.column(0).to_pylist()
                for ids, count in e.encode_all(batch.column(1)):
                    yield doc_ids[: len(count)], *_ended(ids, count, end_id)
                    doc_ids = doc_ids[len(count) :]

        start = 0
        for block, (doc_ids, ids, count) in enumerate(_cut(slices(), BLOCK)):
            yield pa.RecordBatch.from_pylist([_block(shard, block, start, doc_ids, count, ids, base)], arrow)
            start += len(ids)

    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("tie"))
    dealt = dealt.repartitionByRange(shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    dealt.mapInArrow(encode, SCHEMA).write.option("compression", "zstd").parquet(path)


def _unpack(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(block["symbols"], "<u4" if block["wide"] else "<u2"), np.frombuffer(block["rules"], "<u4").reshape(-1, 2), np.frombuffer(block["expansions"], "<u4")


def decode_range(block: dict, doc: int, begin: int, end: int) -> np.ndarray:
    """Ids begin to end of a block's doc-th document, from the symbols that cover them alone."""
    symbols, rules, sizes = _unpack(block)
    n = np.frombuffer(block["doc_symbols"], "<u4").astype(np.int64)
    symbols = symbols[n[:doc].sum() : n[: doc + 1].sum()]
    edge = np.cumsum(np.concatenate([np.ones(block["base"], np.int64), sizes])[symbols])
    first, last = np.searchsorted(edge, begin, "right"), np.searchsorted(edge, end, "left") + 1
    skipped = edge[first - 1] if first else 0
    return expand(symbols[first:last], block["base"], rules, sizes)[begin - skipped : end - skipped]


def read_ids(spark: SparkSession, path: str, digests_only: bool = False) -> DataFrame:
    """Per document of the files at path: doc_id, start, n_tokens, ids_crc32, and unless digests_only ids (little-endian unsigned 32-bit)."""
    blocks = spark.read.schema(SCHEMA).parquet(path)
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("shard_tokens"))
    before = totals.select("shard", (F.sum("shard_tokens").over(Window.orderBy("shard")) - F.col("shard_tokens")).alias("before"))  # one row a shard: as many as write_ids was told to write

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1).to_pylist()[0]
                ids = expand(*(lambda s, r, z: (s, block["base"], r, z))(*_unpack(block))).astype("<u4")
                n = np.frombuffer(block["doc_tokens"], "<u4").astype(np.int64)
                at = np.concatenate([[0], np.cumsum(n)])
                parts = [memoryview(ids[a:b]) for a, b in zip(at[:-1], at[1:])]
                columns = [pa.array(block["doc_ids"], pa.int64()), pa.array(at[:-1] + block["before"] + block["shard_start"], pa.int64()), pa.array(n, pa.int64()), pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                if not digests_only:
                    columns.append(pa.array([p.tobytes() for p in parts], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    return blocks.join(F.broadcast(before), "shard").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * (not digests_only))


def op1_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/ids-{uuid.uuid4().hex}"
    write_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_ids(spark, path, digests_only=True)
