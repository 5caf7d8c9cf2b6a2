"""Exact ids of a tokenizers file for whole texts, with each blank-delimited piece encoded by the library once.

Both public vocabularies used here cut texts at blanks before they merge, so that the ids of a text are the
ids of its pieces one after another. A text whose blanks are not single ones between other characters is cut
only where the rule is certain, and its pieces go to the library with their blanks. Closing marks are cut off a piece where the
letter before them stays one letter in lower case, and a single word of letters up to U+00FF goes to the library's model
past its normaliser and pre-tokenizer, which would leave it as it is or fold its case. Every CHECKED-th text is given to
the library whole as well; should it give other ids, these hold, and the worker encodes whole texts from there on.

encode_all does the same for a column of texts, of byte-level vocabularies by their distinct pieces: they are numbered by Arrow, each is looked up
once a slice of SLICE bytes, and the ids are put together by position.
"""

from __future__ import annotations

import codecs
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

#: Pieces in one generation of a worker's memory; the generation before stays until the next is full.
REMEMBERED = 400_000
#: A longer piece is encoded but not remembered.
LONGEST = 200
#: Of so many texts one is also encoded whole, to hold the pieces' ids against it.
CHECKED = 200
#: Marks that end a letter run in either vocabulary, whatever stands around them.
MARKS = ".,:;!?|%&$#*"
#: Bytes of text whose distinct pieces are numbered at once, and new words that go to the library's model at once.
SLICE, WORDS = 16 << 20, 4096


def _shown() -> str:
    """The characters that stand for the bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    shown = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return "".join(shown[b] for b in range(256))


_SHOWN = _shown()
#: The same, with a blank between lines.
_LINES = _SHOWN[:10] + " " + _SHOWN[11:]


def _visible(text: str) -> str:
    return codecs.charmap_decode(text.encode(), "strict", _SHOWN)[0]


def runs(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers begin, begin + 1, ... of n[i] each, one run after another."""
    return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())


class _Irregular(Exception):
    pass


_NONE = np.zeros(0, np.int64)


def _unmarked(piece: str) -> str:
    """A piece without its closing marks, if these can be cut off."""
    word = piece.rstrip(MARKS)
    return word if word and len(word) < len(piece) and word[-1] < "\u0250" and word[-1].isalpha() and len(word[-1].lower()) == 1 else ""


def _marked(pieces: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray, pa.Array]:
    """Which pieces _unmarked takes marks from; marks, and which of them each of these pieces ends with; all pieces without them."""
    bare = pc.utf8_rtrim(pieces, MARKS)
    (start, data), (bare_start, bare_data) = ((np.frombuffer(x.buffers()[1], np.int64)[x.offset : x.offset + len(x) + 1], np.frombuffer(x.buffers()[2] or b"", np.uint8)) for x in (pieces, bare))
    size, n = np.diff(start), np.diff(bare_start)
    marked = (n > 0) & (n < size)
    at = np.flatnonzero(marked)
    last = bare_data[bare_start[at + 1] - 1]
    marked[at[(last < 128) & ((last | 32) - 97 > 25)]] = False  # of ASCII only letters; as bytes, what lies below a is large
    other = at[last > 127]
    marked[other] = [_unmarked(p) != "" for p in pieces.take(pa.array(other)).to_pylist()]
    at = np.flatnonzero(marked)
    place = np.zeros(256, np.int64)
    place[list(MARKS.encode())] = np.arange(len(MARKS))
    k, which = (size - n)[at], place[data[start[at + 1] - 1]]
    which[k > 1] = len(MARKS) + np.arange((k > 1).sum())
    some = pieces.take(pa.array(at[k > 1])).to_pylist()
    return marked, [*MARKS, *(p[-i:] for p, i in zip(some, k[k > 1].tolist()))], which, pc.if_else(pa.array(marked), bare, pieces)


class _Words:
    """Ids of words that follow a blank, by their place in an Arrow array; beyond the bound the last slice's words stay."""

    def __init__(self, pieces: "_Pieces", tokenizer: Tokenizer, bound: int) -> None:
        self.pieces, self.bound = pieces, bound
        # The library on words in the form of the vocabulary: a blank parts them, and the model merges each.
        self.lines = Tokenizer(tokenizer.model)
        self.lines.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith(_SHOWN[32])]] = True
        self.forget()

    def forget(self) -> None:
        self.known, self.n, self.ids = pa.array([], pa.large_string()), _NONE, np.zeros(0, np.uint32)

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters up to U+00FF."""
        text = codecs.charmap_decode((" " + "\n ".join(words)).encode(), "strict", _LINES)[0]
        ids = np.array(self.lines.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        at = np.flatnonzero(self.opens[ids])
        if len(at) != len(words):
            return _flat([self.pieces.word(" " + w) for w in words])
        return ids, np.diff(at, append=len(ids))

    def _new(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """An order of new words, their ids and how many each has in that order, and how many of the last are irregular; these have none."""
        text, found, odd, fine = words.to_pylist(), [], [], []
        plain = [w.isalpha() and len(w) <= LONGEST and (w.isascii() or len(w.encode("latin-1", "ignore")) == len(w)) for w in text]
        first = np.flatnonzero(plain).tolist()
        parts = [self._plain([text[i] for i in first[at : at + WORDS]]) for at in range(0, len(first), WORDS)]
        for i in np.flatnonzero(~np.array(plain, bool)).tolist():
            try:
                found.append(self.pieces._found(text[i]))
                fine.append(i)
            except _Irregular:
                odd.append(i)
        parts.append(_flat([*found, *[b""] * len(odd)]))
        return np.array([*first, *fine, *odd], np.int64), np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts]), len(odd)

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """ids of distinct words one after another, where each word's begin, how many it has, and which words are irregular."""
        at = pc.fill_null(pc.index_in(words, self.known), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        order, ids, n, odd = self._new(words.take(pa.array(new)))
        new = new[order]
        at[new], odd = len(self.n) + np.arange(len(new)), new[len(new) - odd :]
        self.n, self.ids, self.known = np.concatenate([self.n, n]), np.concatenate([self.ids, ids]), pa.concat_arrays([self.known, words.take(pa.array(new))])
        begin = np.cumsum(self.n) - self.n
        out = self.ids, begin[at], self.n[at], odd
        stay = np.ones(len(self.n), bool)
        if len(stay) > self.bound:
            stay[:] = False
            stay[at] = True
        stay[at[odd]] = False
        stay &= pc.binary_length(self.known).to_numpy() <= LONGEST
        if not stay.all():
            kept = np.flatnonzero(stay)
            self.n, self.ids, self.known = self.n[kept], self.ids[runs(begin[kept], self.n[kept])], self.known.take(pa.array(kept))
        return out


class _Pieces(dict):
    """Ids by piece. before: what the library gets in front of a piece (None: raw pieces with their own blanks)."""

    def __init__(self, encode, word, before: str | None, remembered: int, fold: bool = False) -> None:
        super().__init__()
        self.encode, self.word, self.before, self.remembered, self.fold, self.old, self.bare = encode, word, before, remembered, fold, {}, self

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.word((self.before or "") + piece) if piece.isascii() and piece.isalpha() and not self.fold else self._found(piece)
        if len(piece) <= LONGEST:
            if len(self) >= self.remembered:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def _found(self, piece: str) -> bytes:
        word = _unmarked(piece)
        if word:
            return self[word] + self.bare[piece[len(word) :]]
        if self.before is None:
            if self.fold and piece.isascii() and piece.isalpha() and piece != (low := piece.lower()):
                return self[low]
            return self.encode(piece)
        newline = len(piece) > 1 and piece[0] == "\n"
        body = piece[1:] if newline else piece
        if not body or body[0].isspace() or body[-1].isspace():
            raise _Irregular
        if newline and body.isalpha():
            return self.encode("\n") + self.bare[body]
        return self.encode(piece if newline else self.before + piece)


class PieceEncoder:
    """encode(text) gives the ids as little-endian unsigned 32-bit integers, equal to the library's for the whole text."""

    _certain = re.compile(r"(?<=\S)(?= \S)")

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        kind = json.loads(self.tokenizer.to_str())["pre_tokenizer"]["type"]
        self.keeps_blanks = kind == "ByteLevel"
        self.four = [i.to_bytes(4, "little") for i in range(max(self.tokenizer.get_vocab().values()) + 1)]
        self.first = _Pieces(self._library, self._word, "", remembered)
        self.later = _Pieces(self._library, self._word, " ", remembered)
        self.later.bare = self.first
        self.raw = _Pieces(self._library, self._word, None, remembered, fold=not self.keeps_blanks)
        self.words = _Words(self.later, self.tokenizer, 2 * remembered)
        self.texts, self.whole = 0, False

    def forget(self) -> None:
        """Drop the ids of all pieces; they are found anew."""
        for pieces in (self.first, self.later, self.raw):
            pieces.clear()
            pieces.old = {}
        self.words.forget()

    def _word(self, word: str) -> bytes:
        """Ids of a single pretoken of letters up to U+00FF, which may follow a blank, from the library's model."""
        if not self.keeps_blanks:
            word = word.strip(" ").lower()
        return b"".join([self.four[t.id] for t in self.model.tokenize(_visible(word))])

    def _library(self, text: str) -> bytes:
        word = text[1:] if text[:1] == " " else text
        if word.isalpha() and (word.isascii() or max(word) <= "\xff"):
            return self._word(text)
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str | None) -> bytes:
        self.texts += 1
        if not self.whole:
            ids = self._joined(text)
            if self.texts % CHECKED != 1 or ids == self._of_whole(text):
                return ids
            self.whole = True
        return self._of_whole(text)

    def encode_all(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Slice by slice of the texts in their order: their ids one after another, and the number of ids of each."""
        size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        before, at = np.cumsum(size) - size, 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(before, before[at] + SLICE)))
            some = pc.fill_null(texts.slice(at, end - at).cast(pa.large_string()), "")
            if self.whole or not self.keeps_blanks:
                yield _flat(list(map(self.encode, some.to_pylist())))
            else:
                yield self._numbered(some)
            at = end

    def _numbered(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lines = pc.replace_substring(texts, "\n", " \n")
        # Blank lines and repeated blanks make irregular pieces; such texts are left out here and encoded one by one below.
        lines = pc.if_else(pc.or_(pc.match_substring(lines, "  "), pc.match_substring(lines, "\n ")), "", lines)
        lists = pc.split_pattern(lines, " ")
        edge = lists.offsets.to_numpy().astype(np.int64)
        head_at = np.zeros(len(lists.values), bool)
        head_at[edge[:-1]] = True
        coded = lists.values.filter(pa.array(~head_at)).dictionary_encode()
        marked, marks, which, words = _marked(coded.dictionary)
        words = words.dictionary_encode()
        ids, begin, n, odd = self.words.of(words.dictionary)
        bad = np.isin(words.indices.to_numpy(), odd)
        # The first piece of a text has no blank before it, and a number of its own behind those of all pieces.
        heads = []
        for head in pc.list_element(lists, 0).to_pylist():
            try:
                heads.append(self.first[head])
            except _Irregular:
                heads.append(None)
        bad = np.concatenate([bad, [x is None for x in heads]]).astype(bool)
        other, m = _flat([b"", *map(self.first.__getitem__, marks), *(x or b"" for x in heads)])
        begin, n = np.concatenate([begin, len(ids) + np.cumsum(m) - m]), np.concatenate([n, m])
        # A piece is a word and the marks behind it; those of pieces without marks are empty.
        none = len(words.dictionary)
        parts = np.full((len(bad), 2), none)
        parts[: len(marked), 0] = words.indices.to_numpy()
        parts[: len(marked), 1][marked] = none + 1 + which
        parts[len(marked) :, 0] = none + 1 + len(marks) + np.arange(len(heads))
        flat, n = _taken(np.concatenate([ids, other]), begin, n, parts.ravel()), n[parts].sum(1)
        codes = np.empty(len(head_at), np.int64)
        codes[~head_at], codes[head_at] = coded.indices.to_numpy(), len(marked) + np.arange(len(heads))
        count = np.diff(np.concatenate([[0], np.cumsum(n[codes])])[edge])
        flat = _taken(flat, np.cumsum(n) - n, n, codes)
        irregular = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(bad[codes])])[edge])) if bad.any() else _NONE
        if len(irregular):
            held = np.repeat(np.isin(np.arange(len(texts)), irregular), count)
            other, m = _flat([self._joined(texts[i].as_py()) for i in irregular.tolist()])
            regular, count[irregular] = flat[~held], m
            held = np.repeat(np.isin(np.arange(len(texts)), irregular), count)
            flat = np.empty(len(held), np.uint32)
            flat[held], flat[~held] = other, regular
        ends = np.cumsum(count)
        for i in range(-self.texts % CHECKED, len(texts), CHECKED):
            if flat[ends[i] - count[i] : ends[i]].tobytes() != self._of_whole(texts[i].as_py()):
                self.whole = True
                return _flat(list(map(self._of_whole, texts.to_pylist())))
        self.texts += len(texts)
        return flat, count

    def _of_whole(self, text: str | None) -> bytes:
        return array("I", self.tokenizer.encode(text or "", add_special_tokens=False).ids).tobytes()

    def _joined(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.keeps_blanks:
            return b"".join(map(self.raw.__getitem__, text.replace("\n", " ").split(" ")))
        head, *rest = text.replace("\n", " \n").split(" ")
        try:
            return self.first[head] + b"".join(map(self.later.__getitem__, rest))
        except _Irregular:
            return b"".join(map(self.raw.__getitem__, self._certain.split(text)))


def _taken(ids: np.ndarray, begin: np.ndarray, n: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The ids of each code, one code after another, a million codes at once."""
    return np.concatenate([np.zeros(0, np.uint32), *(ids[runs(begin[some], n[some])] for some in np.split(codes, range(1 << 20, len(codes), 1 << 20)))])


def _flat(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str, remembered: int = REMEMBERED) -> PieceEncoder:
    """The worker's encoder for a file, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path, remembered)
    return _encoders[path]
