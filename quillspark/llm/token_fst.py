"""Token counts by finite-state transducers compiled from a byte-level BPE file.

Two deterministic transducers run in cascade, and every transition carries the number of tokens that it emits.

1. The cutter reads character classes and marks where a pretoken begins (GPT-2's rule). It has eight states;
   what the rule looks ahead for is folded into the input symbols. Symbols are cut into chunks; each chunk's
   map from every entry state to its exit state is computed for all chunks side by side, the maps compose by a
   parallel prefix scan, and with the entry states known all chunks emit their marks side by side.
2. The counter reads the bytes of one pretoken. Since the last token of a text's BPE encoding depends only on
   which neighbouring tokens survive together, a state need hold no more than the longest suffix that may still
   grow into a longer token, with the last token and the relative count at each place inside it. States are
   compiled when first reached and kept in a dense table; a transition's annotation is the change of the count,
   which may be negative where tokens merge. All pretokens of a batch advance side by side.

A pretoken begins in the counter's first state whatever stood before, so the cutter's marks are all that has to
pass between chunks. The table grows to at most STATES states; when it is full, it is compiled anew from the states in
which the pretokens stand, so memory is bounded whatever their length.

Defined results: a null text is empty and has no tokens; special strings in a text count one token each, as the
library takes them by default; repeated rows stay; an empty table gives no rows; columns other than doc_id and text
are not looked at.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import slices

#: Most states of the counter, symbols in a chunk of the cutter, tokens that over_limit allows.
STATES, CHUNK, LIMIT = 1 << 17, 256, 512
#: A place with at most so many longer tokens remembers which of them may follow instead of its last token.
FEW = 48
LETTER, NUMBER, OTHER, QUOTE2, QUOTE3, JOINS, ALONE, SPACE = range(8)
START, IN_LETTERS, IN_NUMBERS, IN_OTHER, JOINED, IN_SPACE, ONE_LEFT, TWO_LEFT = range(8)


def _cutter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and mark, by state and symbol; symbols from 8 on open a document."""
    to, mark = np.zeros((8, 16), np.uint8), np.zeros((8, 16), np.uint8)
    for state in range(8):
        for symbol in range(8):
            if state == TWO_LEFT:
                go, emit = ONE_LEFT, 0
            elif state == ONE_LEFT:
                go, emit = START, 0
            elif symbol in (QUOTE2, QUOTE3) and state not in (IN_OTHER, JOINED):
                go, emit = (ONE_LEFT, 1) if symbol == QUOTE2 else (TWO_LEFT, 1)
            elif symbol in (LETTER, NUMBER, OTHER, QUOTE2, QUOTE3):
                go = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS}.get(symbol, IN_OTHER)
                emit = int(state not in (go, JOINED))
            elif symbol == SPACE:
                go, emit = IN_SPACE, int(state != IN_SPACE)
            else:
                go, emit = (JOINED if symbol == JOINS else START), 1
            to[state, symbol], mark[state, symbol] = go, emit
    to[:, 8:], mark[:, 8:] = to[START, :8], mark[START, :8]
    return to, mark


TO, MARK = _cutter()


def scan_marks(symbols: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """For each symbol whether a pretoken begins there."""
    n = len(symbols)
    k = -(-n // chunk)
    grid = np.full(k * chunk, LETTER, np.uint8)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(k, chunk).T)
    flat_to, flat_mark = TO.ravel(), MARK.ravel()
    maps = np.tile(np.arange(8, dtype=np.uint8), (k, 1))
    for row in grid:
        maps = flat_to[maps * np.uint8(16) + row[:, None]]
    step = 1
    while step < k:  # after each round a map spans twice as many chunks
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step].copy(), 1)
        step *= 2
    state = np.concatenate([[np.uint8(START)], maps[:-1, START]])
    marks = np.empty((chunk, k), np.uint8)
    for i, row in enumerate(grid):
        at = state * np.uint8(16) + row
        marks[i] = flat_mark[at]
        state = flat_to[at]
    return marks.T.ravel()[:n].astype(bool)


def _class_table(path: str) -> np.ndarray:
    """Class of each code point; those that this Python doesn't know are taken from the library, whose Unicode is newer."""
    cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    table = np.full(0x110000, OTHER, np.uint8)
    for i in range(0x110000):
        major = unicodedata.category(chr(i))[0]
        if major in "LN":
            table[i] = LETTER if major == "L" else NUMBER
        elif major == "Z" or 9 <= i <= 13 or i == 0x85:
            table[i] = SPACE
        elif i < 0x40000 and unicodedata.category(chr(i)) == "Cn":
            table[i] = LETTER if len(cut("a" + chr(i))) == 1 else NUMBER if len(cut("1" + chr(i))) == 1 else OTHER
    return table


class Counter:
    """The second transducer: table[state, byte] is 16 * next state + 8 + change of the count, or 0 where not compiled."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        byte = {chr(c): b for c, b in zip([*plain, *range(256, 256 + len(rest))], [*plain, *rest])}
        special = {t["content"] for t in spec["added_tokens"]}
        raw = spec["model"]["vocab"]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.id = {bytes(byte[c] for c in t): i for t, i in raw.items() if t not in special}
        self.text = {i: t for t, i in self.id.items()}
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for order, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[raw[a], raw[b]] = (order, raw[a + b])
            self.made.setdefault(raw[a + b], (order, raw[a], raw[b]))
        self.grows: dict[bytes, list[int]] = {}
        for t, i in self.id.items():
            for j in range(1, len(t)):
                self.grows.setdefault(t[:j], []).append(i)
        self.bit = {(t, i): 1 << k for t, ids in self.grows.items() if len(ids) <= FEW for k, i in enumerate(ids)}
        self.together: dict[tuple[int, int], bool] = {}
        self.masks: dict[tuple[int, bytes], int] = {}
        self.reset()

    def reset(self, keep: tuple = ()) -> list[int]:
        """Forget all states but the first and those of keep; their new numbers."""
        self.table = np.zeros((1 << 10, 256), np.int32)
        self.states, self.number = [], {}
        self._state((b"", (-1,), (0,)))
        return [self._state(key) for key in keep]

    def _state(self, key: tuple) -> int:
        """The number of a state; the table grows with them."""
        if key not in self.number:
            if len(self.states) == len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.number[key] = len(self.states)
            self.states.append(key)
        return self.number[key]

    def _merged(self, ids: list[int]) -> list[int]:
        while len(ids) > 1:
            found = [(self.rank[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in self.rank]
            if not found:
                break
            (_, new), i = min(found)
            ids[i : i + 2] = [new]
        return ids

    def _whole(self, token: int) -> bool:
        """Whether a token's own text is encoded as the token."""
        if (-1, token) not in self.together:
            self.together[-1, token] = self._merged([self.id[bytes([c])] for c in self.text[token]]) == [token]
        return self.together[-1, token]

    def _survive(self, a: int, b: int) -> bool:
        """Whether the encoding of both texts in a row is these two tokens (of b's alone, where a is -1).

        Merges are undone from the last on; the pair that touches then must not have merged before the one undone.
        """
        if a < 0:
            return self._whole(b)
        if (a, b) not in self.together:
            left, right, before, fine = a, b, len(self.rank), self._whole(b)
            while fine:
                if self.rank.get((left, right), (before,))[0] < before:
                    fine = False
                    break
                x, y = self.made.get(left, (-1,))[0], self.made.get(right, (-1,))[0]
                if x < 0 and y < 0:
                    break
                if x > y:
                    before, left = x, self.made[left][2]
                else:  # of equal merges the left one comes first
                    before, right = y + 1, self.made[right][1]
            self.together[a, b] = fine
        return self.together[a, b]

    def _after(self, token: int, text: bytes) -> int:
        """What a place remembers: which of the few longer tokens on text may follow token (as -3 - bits), else token; -2 if none can."""
        longer = self.grows.get(text)
        if longer is None or token < -2:
            return -2
        if len(longer) > FEW:
            return token
        if (token, text) not in self.masks:
            self.masks[token, text] = sum(self.bit[text, t] for t in longer if self._survive(token, t))
        return -3 - self.masks[token, text] if self.masks[token, text] else -2

    def _narrow(self, mark: int, before: bytes, text: bytes) -> int:
        """A place's memory after one more byte."""
        longer = self.grows.get(text)
        if mark >= -1:
            return self._after(mark, text)
        if mark == -2 or longer is None:
            return -2
        bits = sum(self.bit[text, t] for t in longer if (-3 - mark) & self.bit[before, t])
        return -3 - bits if bits else -2

    def _may(self, mark: int, held: bytes, token: int) -> bool:
        if mark >= -1:
            return self._survive(mark, token)
        return mark != -2 and bool((-3 - mark) & self.bit.get((held, token), 0))

    def compile(self, state: int, byte: int) -> None:
        held, last, count = self.states[state]
        text = held + bytes([byte])
        for i in range(len(text)):
            token = self.id.get(text[i:])
            if token is not None and self._may(last[i], held[i:], token):
                break
        else:
            raise ValueError("this vocabulary lacks a byte")
        change = count[i] + 1
        kept = [self._narrow(m, held[j:], text[j:]) for j, m in enumerate(last[:-1])] + [self._after(last[-1], text[-1:])] + [token]
        keep = next(j for j, m in enumerate(kept) if m != -2)
        key = (text[keep:], tuple(kept[keep:]), tuple(c - change if m != -2 else 0 for c, m in zip((*count, change)[keep:], kept[keep:])))
        self.table[state, byte] = 16 * self._state(key) + 8 + change

    def count(self, data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Tokens of the pretokens of data. A full table is compiled anew from the states that stand just then."""
        order = np.argsort(-length, kind="stable")
        at, length = begin[order], length[order]
        more = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), "left")
        state, total = np.zeros(len(at), np.int32), np.zeros(len(at), np.int32)
        for j, n in enumerate(more.tolist()):  # the first n pretokens have a byte j
            here, read = state[:n], data[at[:n] + j]
            got, renewed = self.table[here, read], False
            while len(missing := np.flatnonzero(got == 0)):
                for pair in np.unique(here[missing].astype(np.int64) * 256 + read[missing]).tolist():
                    if len(self.states) >= STATES:
                        break
                    self.compile(pair >> 8, pair & 255)
                else:
                    got[missing] = self.table[here[missing], read[missing]]
                    continue
                held, lane = np.unique(here, return_inverse=True)
                if renewed or 2 * len(held) > STATES:
                    raise MemoryError
                here, renewed = np.array(self.reset(tuple(self.states[s] for s in held.tolist())), np.int32)[lane], True
                got = self.table[here, read]
            total[:n] += (got & 15) - 8
            state[:n] = got >> 4
        out = np.empty(len(at), np.int32)
        out[order] = total
        return out

    def counts(self, data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """count, with pretokens in halves where they stand in too many states at once; one alone stands in one."""
        try:
            return self.count(data, begin, length)
        except MemoryError:
            half = len(begin) // 2
            return np.concatenate([self.counts(data, begin[:half], length[:half]), self.counts(data, begin[half:], length[half:])])


_kept: dict = {}


def _classes(path: str) -> np.ndarray:
    if (path, "classes") not in _kept:
        _kept[path, "classes"] = _class_table(path)
    return _kept[path, "classes"]


def _counter(path: str) -> Counter:
    if path not in _kept:
        _kept[path] = Counter(path)
    return _kept[path]


def count_tokens(texts: list[str | None], path: str, classes: np.ndarray | None = None) -> np.ndarray:
    """Tokens of each text, without added ones. classes: of the file's code points, if known."""
    table, counter = _classes(path) if classes is None else classes, _counter(path)
    texts = [t or "" for t in texts]
    extra = np.zeros(len(texts), np.int64)
    parts, owner = texts, np.arange(len(texts))
    if counter.special and any(counter.special.search(t) for t in texts):
        cut = [counter.special.split(t) for t in texts]
        extra += [len(c) - 1 for c in cut]
        parts, owner = [p for c in cut for p in c], np.repeat(owner, [len(c) for c in cut])
    points = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
    if not len(points):
        return extra
    n = np.array([len(p) for p in parts], np.int64)
    opens = (np.cumsum(n) - n)[n > 0]
    symbol = table[points]
    closes = np.append(opens[1:], len(points)) - 1
    after = np.full(len(points), SPACE, np.uint8)
    after[:-1] = symbol[1:]
    after[closes] = SPACE
    space = (symbol == SPACE) & (after != SPACE)
    symbol[space] = np.where(points[space] == 32, JOINS, ALONE)
    quotes = np.flatnonzero(points == 39)
    room = closes[np.searchsorted(opens, quotes, "right") - 1] - quotes
    ahead = np.append(points, [0, 0]).astype(np.int64)
    one, two = ahead[quotes + 1] * (room > 0), ahead[quotes + 2] * (room > 1)
    for a in "sdmt":
        symbol[quotes[one == ord(a)]] = QUOTE2
    for a, b in ("ll", "ve", "re"):
        symbol[quotes[(one == ord(a)) & (two == ord(b))]] = QUOTE3
    symbol[opens] += 8
    marks = np.flatnonzero(scan_marks(symbol))
    width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
    place = np.concatenate([[0], np.cumsum(width)])
    data = np.frombuffer("".join(parts).encode(), np.uint8)
    begin = place[marks]
    tokens = counter.counts(data, begin, np.diff(begin, append=len(data)))
    per_part = np.bincount(np.repeat(np.arange(len(n))[n > 0], np.diff(opens, append=len(points)))[marks], tokens, len(n))
    return extra + np.bincount(owner, per_part, len(texts)).astype(np.int64)


def with_token_counts(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of docs (doc_id, text)."""
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    classes = docs.sparkSession.sparkContext.broadcast(_classes(vocabulary))  # a byte for each code point

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n = count_tokens(batch.column(1).to_pylist(), vocabulary, classes.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes")).mapInArrow(work, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op4_token_fst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
