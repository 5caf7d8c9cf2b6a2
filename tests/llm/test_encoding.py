"""Ids through pieces against the library on whole texts."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from quillspark.llm import encoding
from quillspark.llm.encoding import MARKS, PieceEncoder

VOCABULARIES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


@pytest.mark.parametrize("name", VOCABULARIES)
def test_every_letter_before_every_mark(name):
    e = PieceEncoder(public_tokenizers.path(name))
    for c in map(chr, range(0x250)):
        for m in MARKS:
            text = f"{c}{m} a{c}{m} {c}a{m} x{c}{m}{m}b {m}{c} A{c}Z{m}\n{c}"
            assert e._joined(text) == e._of_whole(text), (c, m)


@pytest.mark.parametrize("name", VOCABULARIES)
def test_dotted_capital_wherever_the_text_stands(name):
    text = "DENİZLİ, İZMİR ve MANİSALİ."
    e = PieceEncoder(public_tokenizers.path(name))
    assert all(e.encode(t) == e._of_whole(t) for t in [text, "a b", text, *["c"] * 400, text])


def test_where_pieces_fail_whole_texts_are_encoded(monkeypatch):
    e = PieceEncoder(public_tokenizers.path(VOCABULARIES[0]))
    monkeypatch.setattr(e, "_joined", lambda text: b"")
    assert [e.encode(t) for t in ("one two", "three")] == [e._of_whole(t) for t in ("one two", "three")]


@pytest.mark.parametrize("name", VOCABULARIES)
def test_an_encoder_that_forgets_gives_the_same_ids(name):
    e = PieceEncoder(public_tokenizers.path(name), 3)
    texts = ["one two three four five, one", "six\n one", ""]
    before = [e.encode(t) for t in texts]
    e.forget()
    assert not any(len(p) or p.old for p in (e.first, e.later, e.raw)) and [e.encode(t) for t in texts] == before


ODD = [
    None, "", " ", "a", " a", "a ", "a  b", "\n", "a\nb", "a\n\nb c", "\na", "tab\tx y", "word. word, word.,? word", "3.5. 3, x3. .x . .", "ñ. ªb. º, µ; Ǆ. ß! ĳ?", "İ. x İ, i̇.",
    "\x00 a\x00. \x00", "a" * 300 + ". " + "é" * 201, "日本語 日本。 日.", "😀. 😀 x😀.", "don't we'll. I'M,", "CAPITAL Capital, capital", "a\u00a0b c\u2003d\u0085 e", "x" * 199 + "ñ, y", "é́. é́ ", "<|endoftext|> a.",
]


@pytest.mark.parametrize("name", VOCABULARIES)
@pytest.mark.parametrize("slice_, remembered", [(1, 2), (40, 3), (1 << 20, 1000)])
def test_columns_of_texts(name, slice_, remembered, monkeypatch):
    monkeypatch.setattr(encoding, "SLICE", slice_)
    monkeypatch.setattr(encoding, "WORDS", 3)
    pick = random.Random(5)
    pieces = [p for t in ODD if t for p in t.split(" ")] + ["the", "one.", "\nTwo,", "tréé"]
    texts = ODD + [" ".join(pick.choices(pieces, k=pick.randint(1, 9))) for _ in range(300)] + [" ".join(pick.choices(["the", "one.", "\nTwo,", "tréé", "x%%"], k=9)) for _ in range(50)]
    e = PieceEncoder(public_tokenizers.path(name), remembered)
    for kind in (pa.string(), pa.large_string()):
        found = list(e.encode_all(pa.array(texts, kind)))
        ids, count = np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])
        ends = np.cumsum(count)
        assert not e.whole and [ids[b - n : b].tobytes() for b, n in zip(ends, count)] == [e._of_whole(t) for t in texts]
    e.forget()
    assert len(e.words.known) == 0 and list(e.encode_all(pa.array([], pa.string()))) == []


def test_a_word_goes_to_the_library_once_whatever_marks_follow(monkeypatch):
    e, asked = PieceEncoder(public_tokenizers.path(VOCABULARIES[1])), []
    plain = e.words._plain
    monkeypatch.setattr(e.words, "_plain", lambda words: asked.extend(words) or plain(words))
    for _ in range(2):
        list(e.encode_all(pa.array(["x two, two. two; two two&&& zwölf", "x zwölf. two"])))
    assert sorted(asked) == ["two", "zwölf"]


def test_where_a_columns_pieces_fail_whole_texts_are_encoded(monkeypatch):
    e = PieceEncoder(public_tokenizers.path(VOCABULARIES[1]))
    monkeypatch.setattr(e.words, "_plain", lambda words: (np.zeros(len(words), np.uint32), np.ones(len(words), np.int64)))
    texts = ["one two", "three four"]
    for _ in range(2):
        (ids, count), = e.encode_all(pa.array(texts))
        assert e.whole and ids.tobytes() == b"".join(map(e._of_whole, texts)) and count.sum() == len(ids)


def test_texts_with_blank_lines_are_not_encoded_twice(monkeypatch):
    e, asked = PieceEncoder(public_tokenizers.path(VOCABULARIES[1])), []
    plain = e.words._plain
    monkeypatch.setattr(e.words, "_plain", lambda words: asked.extend(words) or plain(words))
    texts = ["x one\n\ntwo three", "x  four five", "x six"]
    (ids, count), = e.encode_all(pa.array(texts))
    assert asked == ["six"] and ids.tobytes() == b"".join(map(e._of_whole, texts)) and len(count) == 3
