"""Scoring by a weighted backoff automaton over words.

States are contexts of up to ORDER - 1 = 2 words: the root, one state for the text's begin and each training word, and
one for each training pair. A state's arc for a word leads to the state of the longest context that the word leaves
behind and carries the log10 of the smoothed probability; a word without an arc there takes the state's failure
arc, whose weight is added and which leads to the context without its first word, down to the root, which knows every
training word and one class for all others. Weights come from counts by hierarchical Dirichlet smoothing:

    root:       P(w) = (c(w) + 1) / (N + V + 1)
    arc at h:   P(w | h) = (c(h w) + M P(w | h')) / (c(h) + M)          h': h without its first word
    failure:    M / (c(h) + M)

with M = MASS[words of h]; so each state's probabilities add up to one. A text is read from left to right once and the
state is carried. Long texts are cut into segments of SEGMENT words that are read side by side; a later segment reads
the two words before it first, which leaves it in the state that a single reading would have there.

No model is collected or broadcast. Documents are taken in chunks of at most CHUNK_TOKENS tokens (or one longer
text), by their order in the table, which is read twice: to ask and to score; docs must be a table or another source whose
partitions give the same rows in the same order again, which is checked by a sum over each answer. Each chunk sends the 64-bit prints of its distinct words, pairs and triples with their training counts to the
shards that own these prints, packed, and gets back the counts over the whole corpus in the order asked: the part
of the automaton that its texts can reach. Counts are all that weights need, so no shard holds a context's
continuations together and none is hot: a word or pair in all texts is one entry a chunk.

Defined results: a null text is empty and has the end token only; a null doc_id counts as held out; rows that
share a doc_id stay and count each; without training rows every token has probability 1; an empty table gives no
rows; columns other than doc_id, text and train are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import from_planes, mix, planes, slices, stored, text_bytes, words

#: Tokens in a chunk, bytes of text that one shard answers for, words that are read side by side.
CHUNK_TOKENS, SHARD_BYTES, SEGMENT = 1 << 20, 8 << 20, 256
#: Weight of the shorter context's distribution, in counts, for contexts of one and two words.
MASS = {1: 1000.0, 2: 100.0}
END, BEGIN = np.uint64(0xE4D), np.uint64(0xBE61)
_CHUNK = "chunk long, doc_ids array<long>, train binary, n binary, words binary, ids binary"
_REQUEST = "chunk long, shard long, sum long, prints binary, train binary"
_ANSWER = "chunk long, shard long, sum long, counts binary, tokens long, known long"
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_LOW, _KIND = 0xFFFFFFFF, ~np.uint64(3)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunk = TaskContext.get().partitionId() << 32
    hashes, n, ids, train, seen = [], [], [], [], 0

    def packed() -> pa.RecordBatch:
        word, number = np.unique(np.concatenate(hashes), return_inverse=True)
        often = np.argsort(-np.bincount(number), kind="stable")  # frequent words get small numbers, which pack well
        place = np.empty(len(word), np.int64)
        place[often] = np.arange(len(word))
        row = [chunk, pa.concat_arrays(ids).to_pylist(), np.concatenate(train).astype(np.uint8).tobytes(), np.concatenate(n).astype("<u4").tobytes(), word[often].tobytes(), planes(place[number], 4)]
        kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], [c.split()[0] for c in _CHUNK.split(", ")])

    for batch in slices(batches):
        data, at = text_bytes(batch.column("text"))
        h, _, _, where = words(data, at)
        if seen and seen + len(h) + batch.num_rows > CHUNK_TOKENS:
            yield packed()
            chunk, hashes, n, ids, train, seen = chunk + 1, [], [], [], [], 0
        hashes.append(np.insert(h, where[1:], END))
        n.append(np.diff(where) + 1)
        ids.append(batch.column("doc_id"))
        train.append(batch.column("train").to_numpy(zero_copy_only=False).astype(bool))
        seen += len(hashes[-1])
    if ids:
        yield packed()


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the place of each key among them."""
    each, at = np.unique(keys, return_inverse=True)
    return each, at.astype(np.int32)


class Grams:
    """A chunk's distinct words, pairs and triples, their prints, and where each token's stand."""

    def __init__(self, word: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        self.word, self.ids, self.n = word, ids.astype(np.int32), n
        opens = np.zeros(len(ids), bool)
        opens[np.cumsum(n) - n] = True
        before = np.concatenate([[0], self.ids[:-1].astype(np.int64) + 1])  # 0 is the text's begin
        before[opens] = 0
        self.pair, self.pair_at = _numbered((before << 32) | self.ids)
        self.inner = np.flatnonzero(~opens).astype(np.int32)
        self.triple, self.triple_at = _numbered((self.pair_at[self.inner - 1].astype(np.int64) << 32) | self.ids[self.inner])
        context = np.concatenate([[BEGIN], word])
        pair = mix(context[self.pair >> 32] * np.uint64(3) + word[self.pair & _LOW])
        triple = mix(pair[self.triple >> 32] * np.uint64(5) + word[self.triple & _LOW])
        # The last two bits tell words, pairs and triples apart.
        prints = np.concatenate([h & _KIND | np.uint64(k) for k, h in enumerate((word, pair, triple), 1)])
        self.order = np.argsort(prints).astype(np.int32)
        self.prints = prints[self.order]

    def counted(self, learn: np.ndarray) -> np.ndarray:
        """How often each stands in the tokens for which learn is true: words, pairs, triples."""
        parts = ((self.ids[learn], self.word), (self.pair_at[learn], self.pair), (self.triple_at[learn[self.inner]], self.triple))
        return np.concatenate([np.bincount(at, minlength=len(of)) for at, of in parts])

    def requests(self, shards: int) -> Iterator[tuple[int, int, int]]:
        """Shard, begin and end of the sorted prints that it owns, of those shards that own some."""
        shard = ((self.prints >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
        first = np.flatnonzero(np.diff(shard, prepend=np.uint64(shards)))
        return zip(shard[first].astype(int).tolist(), first.tolist(), [*first[1:].tolist(), len(shard)])


def _unpack(chunk: pa.RecordBatch | pa.Table) -> tuple[list, np.ndarray, Grams]:
    """doc_ids, train and n-grams of a single row."""
    row = {c: chunk.column(c)[0] for c in ("doc_ids", "train", "n", "words", "ids")}
    read = lambda c, kind: np.frombuffer(row[c].as_buffer(), kind)
    return row["doc_ids"].as_py(), read("train", np.uint8).astype(bool), Grams(read("words", "<u8"), from_planes(row["ids"].as_buffer(), 4), read("n", "<u4").astype(np.int64))


def _start(shard: int, shards: int) -> np.uint64:
    """The least print of a shard; shards are ranges of prints."""
    return np.uint64((-((-shard << 32) // shards)) << 32)


def _ask(shards: int):
    schema = pa.schema([*((c, pa.int64()) for c in ("chunk", "shard", "sum")), ("prints", pa.binary()), ("train", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            _, train, x = _unpack(chunk)
            counts, rows = x.counted(np.repeat(train, x.n))[x.order], []
            for shard, a, b in x.requests(shards):
                step = np.diff(x.prints[a:b], prepend=_start(shard, shards))
                narrow = int(step.max()) >> 48 == 0  # steps between sorted prints mostly need six bytes
                rows.append((chunk.column(0)[0].as_py(), shard, zlib.crc32(x.prints[a:b]), planes(step, 6 if narrow else 8), planes(counts[a:b], 4)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return work


def _answer(shards: int):
    kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 2
    schema = pa.schema([(c.split()[0], k) for c, k in zip(_ANSWER.split(", "), kinds)])

    def work(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        start = _start(table.column("shard")[0].as_py(), shards)
        train = [from_planes(c.as_buffer(), 4).astype(np.uint32) for c in table.column("train")]
        prints = [np.cumsum(from_planes(p.as_buffer(), n=len(t))) + start for p, t in zip(table.column("prints"), train)]
        size = np.cumsum([0, *map(len, train)])
        each, at = _numbered(np.concatenate(prints))
        total = np.bincount(at, np.concatenate(train), len(each)).astype(np.int64)
        word = total[each & np.uint64(3) == 1]
        counts = [planes(total[at[a:b]], 5) for a, b in zip(size[:-1], size[1:])]
        once = [[int(x)] + [None] * (len(counts) - 1) for x in (word.sum(), np.count_nonzero(word))]
        return pa.Table.from_arrays([*(table.column(c) for c in ("chunk", "shard", "sum")), *(pa.array(c, k) for c, k in zip([counts, *once], kinds[3:]))], schema=schema)

    return work


class Automaton:
    """The states that a chunk's texts can reach: 0 the root, 1 the text's begin, then its words and its pairs.

    counts: of grams' words, pairs and triples in the training texts; n, v and texts: all training tokens, distinct words
    and texts. Arcs are sorted by (state, word)."""

    def __init__(self, grams: Grams, counts: np.ndarray, n: int, v: int, texts: int) -> None:
        w, p = len(grams.word), len(grams.pair)
        word, pair, triple = counts[:w].astype(np.float64), counts[w : w + p].astype(np.float64), counts[w + p :].astype(np.float64)
        held = np.concatenate([[texts], word])  # how often each one-word context stands
        before, last = grams.pair >> 32, grams.pair & _LOW
        behind = np.zeros(len(triple), np.int32)  # the pair that a triple ends in
        behind[grams.triple_at] = grams.pair_at[grams.inner]
        base = (word + 1) / (n + v + 1)
        one, two = MASS[1], MASS[2]
        after_one = (pair + one * base[last]) / (held[before] + one)
        after_two = (triple + two * after_one[behind]) / (pair[grams.triple >> 32] + two)
        pair_state = np.where(pair > 0, 2 + w + np.arange(p), 0).astype(np.int32)
        seen, seen3 = pair > 0, triple > 0
        key = np.concatenate([(((before + 1) << 32) | last)[seen], (((2 + w + (grams.triple >> 32)) << 32) | (grams.triple & _LOW))[seen3]])
        self.key = np.append(key, np.iinfo(np.int64).max)
        self.weight = np.append(np.log10(np.concatenate([after_one[seen], after_two[seen3]])), 0)
        self.target = np.append(np.concatenate([pair_state[seen], pair_state[behind[seen3]]]), np.int32(0))
        self.root = np.log10(base)
        self.word_state = np.where(word > 0, 2 + np.arange(w), 0).astype(np.int32)
        self.failure = np.log10(np.concatenate([[1], one / (held + one), two / (pair + two)]))
        self.fails_to = np.concatenate([np.zeros(2 + w, np.int32), (2 + last).astype(np.int32)])
        self.start = 1 if texts else 0

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and weights of reading one word in each state."""
        state, target, weight = state.copy(), self.word_state[word], np.zeros(len(word))
        fell = np.ones(len(word), bool)
        moving = np.flatnonzero(state)
        while len(moving):
            key = (state[moving].astype(np.int64) << 32) | word[moving]
            at = np.searchsorted(self.key, key)
            found = self.key[at] == key
            hit, miss = moving[found], moving[~found]
            weight[hit] += self.weight[at[found]]
            target[hit], fell[hit] = self.target[at[found]], False
            weight[miss] += self.failure[state[miss]]
            state[miss] = self.fails_to[state[miss]]
            moving = miss[state[miss] > 0]
        weight[fell] += self.root[word[fell]]
        return target, weight

    def read(self, ids: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The sum of weights of each text; n: how many of the ids each has."""
        per = -(-n // SEGMENT)
        text = np.repeat(np.arange(len(n)), per)
        part = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
        warm = np.where(part > 0, 2, 0)
        length = np.minimum(SEGMENT, n[text] - part * SEGMENT) + warm
        order = np.argsort(-length, kind="stable")
        text, part, warm, length = text[order], part[order], warm[order], length[order]
        at = (np.cumsum(n) - n)[text] + part * SEGMENT - warm
        state, sums = np.where(part > 0, 0, self.start).astype(np.int32), np.zeros(len(text))
        open_ = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), "left")
        for j, m in enumerate(open_.tolist()):  # the first m segments have a word j
            state[:m], weight = self.step(state[:m], ids[at[:m] + j])
            sums[:m] += np.where(warm[:m] > j, 0.0, weight)
        return np.bincount(text, sums, len(n))


def _traverse(shards: int, n: int, v: int, texts: int):
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        doc_ids, train, x = _unpack(left)
        place = {shard: i for i, shard in enumerate(right.column("shard").to_pylist())}
        sums, packed = right.column("sum").to_pylist(), right.column("counts").combine_chunks()
        counts = np.empty(len(x.prints), np.int64)
        for shard, a, b in x.requests(shards):
            if sums[place[shard]] != zlib.crc32(x.prints[a:b]):
                raise ValueError("docs gave other rows, or in another order, when they were read again; store them first")
            counts[x.order[a:b]] = from_planes(packed[place[shard]].as_buffer(), 5)
        automaton, at = Automaton(x, counts, n, v, texts), np.cumsum(x.n) - x.n
        known, base = np.add.reduceat((counts > 0)[x.ids].astype(np.int64), at), np.add.reduceat(automaton.root[x.ids], at)
        return pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "held_out": ~train, "n_tokens": x.n, "n_known": known, "train_tokens": np.full(len(at), n, np.int64), "base_score": base, "score": automaton.read(x.ids, x.n)})

    return work


def score_texts(docs: DataFrame) -> DataFrame:
    """Per document of docs (doc_id, text, train): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(F.col("train"), F.lit(False)).alias("train"))
    total = docs.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count_if("train").alias("texts")).first()
    shards = max(1, -(-(total["bytes"] or 0) // SHARD_BYTES))
    asked = docs.mapInArrow(_ask(shards), _REQUEST)
    answers = stored(asked.groupBy("shard").applyInArrow(_answer(shards), _ANSWER), "lm-answers")
    learnt = answers.agg(F.sum("tokens").alias("n"), F.sum("known").alias("v")).first()
    read = _traverse(shards, learnt["n"] or 0, learnt["v"] or 0, total["texts"])
    chunks = docs.mapInArrow(_chunks, _CHUNK)
    return chunks.groupBy("chunk").cogroup(answers.drop("tokens", "known").groupBy("chunk")).applyInArrow(read, _SCORES)


def op9_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_texts(docs.select("doc_id", "text", (F.crc32(F.col("doc_id").cast("string")) % 7 != 2).alias("train")))
