"""Operators 1, 3 and 4 against the tokenizers library."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quillspark.llm import packing, repair_ids, token_fst
from quillspark.llm.encoding import PieceEncoder

from .helpers import ODD, documents, prose

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LIBRARY = {p: Tokenizer.from_file(p) for p in (BYTES, WORDS)}
ENCODERS = {p: PieceEncoder(p) for p in (BYTES, WORDS)}
PARTS = [*"ab'sdmtrevlLTÉéßµªÿ Æ\n\t  .,!|%09<>ß中́\x1c\x85 \U0001f600", "<|endoftext|>", "<|ENDOFTEXT|>", "'ll", " the", "ing"]
TEXTS = st.lists(st.sampled_from(PARTS), max_size=60).map("".join)


def library(path, text):
    return LIBRARY[path].encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_pieces_give_the_ids_of_whole_texts(text):
    for path in (BYTES, WORDS):
        assert np.frombuffer(ENCODERS[path].encode(text), "<u4").tolist() == library(path, text)


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_transducers_count_what_the_library_gives(texts):
    assert token_fst.count_tokens(texts, BYTES).tolist() == [len(library(BYTES, t)) for t in texts]


def test_any_code_point():
    rnd = random.Random(3)
    texts = ["".join(chr(rnd.choice([rnd.randrange(0x20, 0x3000), rnd.randrange(0xE000, 0x20000), 32, 39])) for _ in range(30)) for _ in range(300)]
    assert token_fst.count_tokens(texts, BYTES).tolist() == [len(library(BYTES, t)) for t in texts]


def test_chunk_maps_compose():
    symbols = np.random.default_rng(1).integers(0, 16, 5000).astype(np.uint8)
    state, want = token_fst.START, []
    for s in symbols:
        want.append(bool(token_fst.MARK[state, s]))
        state = token_fst.TO[state, s]
    for chunk in (1, 7, 256, 9999):
        assert token_fst.scan_marks(symbols, chunk).tolist() == want


@pytest.mark.parametrize("states", [8, 40, 300])
def test_counter_starts_anew_when_full(monkeypatch, states):
    monkeypatch.setattr(token_fst, "STATES", states)
    monkeypatch.setitem(token_fst._kept, BYTES, token_fst.Counter(BYTES))
    rnd = random.Random(4)
    texts = [prose(i, 40) for i in range(30)] + ["".join(rnd.choice("abcdefgh") for _ in range(4000))]  # one pretoken of more states than fit
    assert token_fst.count_tokens(texts, BYTES).tolist() == [len(library(BYTES, t)) for t in texts]
    assert len(token_fst._kept[BYTES].states) <= states


def test_counts_of_documents(spark):
    got = {r["doc_id"]: r for r in token_fst.with_token_counts(documents(spark, ODD)).collect()}
    for i, t in enumerate(ODD):
        n = len(library(BYTES, t))
        assert tuple(got[i]) == (i, len((t or "").encode()), n, n > 512)
    assert token_fst.with_token_counts(documents(spark, ODD).limit(0)).count() == 0


def test_grammar_round_trip_and_random_access():
    rnd = np.random.default_rng(5)
    base = rnd.integers(0, 50, 400)
    docs = [np.concatenate([base[rnd.integers(0, 300) :], [0]]) for _ in range(40)] + [np.zeros(1, int), np.zeros(900, int)]
    n = np.array([len(d) for d in docs])
    ids = np.concatenate(docs).astype(np.uint32)
    block = repair_ids._row(0, 0, 0, [(i, d.astype("<u4").tobytes()) for i, d in enumerate(docs)], 50257)
    symbols, rules, sizes = repair_ids._unpack(block)
    assert len(symbols) < len(ids) / 2 and len(rules)
    assert (repair_ids.expand(symbols, 50257, rules, sizes) == ids).all()
    for _ in range(100):
        d = int(rnd.integers(0, len(docs)))
        a, b = sorted(rnd.integers(0, n[d] + 1, 2))
        if a < b:
            assert (repair_ids.decode_range(block, d, a, b) == docs[d][a:b]).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), max_size=80), min_size=1, max_size=6))
def test_no_frequent_pair_is_left(docs):
    ids = np.array([i for d in docs for i in [*d, 0]], np.uint32)
    symbols, ends, rules, sizes = repair_ids.compress(ids, np.cumsum([len(d) + 1 for d in docs]), 10)
    assert (repair_ids.expand(symbols, 10, rules, sizes) == ids).all()
    count = {}
    for a, b in zip(np.concatenate([[0], ends[:-1]]), ends):
        i = a
        while i + 1 < b:
            pair = (symbols[i], symbols[i + 1])
            count[pair] = count.get(pair, 0) + 1
            i += 2 if pair[0] == pair[1] and i + 2 < b and symbols[i + 2] == pair[0] else 1
    assert max(count.values(), default=0) < repair_ids.LEAST


def test_runs_of_equal_ids_compress():
    ids = np.full(5000, 7, np.uint32)
    symbols, _, rules, sizes = repair_ids.compress(ids, np.array([5000]), 10)
    assert len(symbols) < 20 and (repair_ids.expand(symbols, 10, rules, sizes) == ids).all()


def test_no_rule_crosses_documents():
    ids = np.tile(np.array([5, 6], np.uint32), 50)
    symbols, ends, _, _ = repair_ids.compress(ids, np.arange(1, 101), 50257)
    assert (symbols == ids).all() and len(ends) == 100


@pytest.mark.parametrize("shards", [1, 5])
def test_id_files(spark, tmp_path, monkeypatch, shards):
    texts = ODD + [prose(i % 4, 80) for i in range(30)]
    df = documents(spark, texts).unionByName(documents(spark, texts[3:5])).repartition(3)
    path = str(tmp_path / "ids")
    repair_ids.write_ids(df, path, shards=shards)
    rows = sorted(repair_ids.read_ids(spark, path).collect(), key=lambda r: r["start"])
    want = [*enumerate(texts), *enumerate(texts[3:5])]
    start, left = 0, Counter((i, (*library(BYTES, t), 0)) for i, t in want)
    assert [r["doc_id"] for r in rows] == sorted(i for i, _ in want)
    for r in rows:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        left[r["doc_id"], tuple(ids)] -= 1
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not any(left.values())


def test_blocks_close_with_the_document_that_fills_them():
    counts, ids = [3, 1, 9, 0, 4, 4, 1, 2], np.arange(24, dtype=np.uint32)
    for at in ([8], [1, 4, 8], range(1, 9)):
        edge = [0, *at]
        ends = [0, *np.cumsum(counts)]
        slices = ((list(range(a, b)), ids[ends[a] : ends[b]], np.array(counts[a:b])) for a, b in zip(edge, edge[1:]))
        blocks = list(repair_ids._cut(slices, 4))
        assert [b[0] for b in blocks] == [[0, 1], [2], [3, 4], [5], [6, 7]] and [len(b[1]) for b in blocks] == [4, 9, 4, 4, 3]
        assert [b[2].tolist() for b in blocks] == [[3, 1], [9], [0, 4], [4], [1, 2]] and np.concatenate([b[1] for b in blocks]).tolist() == ids.tolist()



def test_id_files_of_an_empty_table(spark, tmp_path):
    repair_ids.write_ids(documents(spark, ODD).limit(0), str(tmp_path / "ids"))
    assert repair_ids.read_ids(spark, str(tmp_path / "ids")).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 300), min_size=1, max_size=60))
def test_assignment_is_whole_and_tight(lengths):
    pieces = packing.assign(np.array(lengths), 64)
    used, room = {}, {}
    for d, start, n, q, offset in pieces:
        used.setdefault(d, []).append((start, n))
        room.setdefault(q, []).append((offset, n))
    for d, n in enumerate(lengths):
        at = 0
        for start, k in sorted(used[d]):
            assert start == at
            at += k
        assert at == n
    for spans in room.values():
        at = 0
        for offset, k in sorted(spans):
            assert offset == at
            at += k
        assert at <= 64
    assert len(room) == -(-sum(lengths) // 64)


def test_costs_are_balanced():
    lengths = np.array([40, 40, 24, 24, 10, 10, 10, 10, 14, 14])
    cost = {}
    for _, _, n, q, _ in packing.assign(lengths, 100):
        cost[q] = cost.get(q, 0) + n + n * n / 1024
    assert max(cost.values()) - min(cost.values()) < 3


def test_packed_documents(spark):
    texts = ODD + [prose(i, 2500) for i in range(6)]
    df = documents(spark, texts).unionByName(documents(spark, texts[3:5]))
    rows = packing.pack(df, bin_bytes=20000).collect()
    whole = {}
    for r in rows:
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        whole.setdefault(r["doc_id"], []).append(r)
    for i, t in enumerate(texts):
        ids = np.array([*library(WORDS, t), 2], "<u4").tobytes()
        copies = 2 if i in (0, 1) else 1
        got = sorted(whole[i], key=lambda r: (r["start"], r["sequence_id"]))
        if copies == 1 or i > 1:
            assert b"".join(bytes(r["ids"]) for r in got) == ids and {r["doc_tokens"] for r in got} == {len(ids) // 4} or i in (0, 1)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by.values():
        assert sum(n for _, n in spans) <= 4096 and sorted(o for o, _ in spans)[0] == 0
    assert packing.pack(documents(spark, ODD).limit(0)).count() == 0
