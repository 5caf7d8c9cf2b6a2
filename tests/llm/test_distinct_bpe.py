"""Byte-level BPE through distinct words, against the encoding library on whole texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from quillspark.llm import distinct_bpe
from quillspark.llm.queries import QUERIES

from .helpers import ODD, documents, prose

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def want(text):
    return np.array(distinct_bpe.library(PATH).encode_ordinary(text or ""), "<u4").tobytes()


def test_pre_tokens_of_every_code_point_and_of_random_texts():
    library, cut = distinct_bpe.library(PATH), distinct_bpe.cutter().cut
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    ids = lambda t: [i for w in cut(t) for i in library._core_bpe.encode_single_piece(w.encode())]
    for a in range(0, len(every), 997):
        text = "".join(f"a{c}1{c}{c} {c}, {c}\n" for c in every[a : a + 997])
        assert ids(text) == library.encode_ordinary(text), a
    rnd = random.Random(5)
    some = "ab Z1'st  \n\t\r.,!\x1c\x85 İ́՘　日本\U0001f600\U00011de0"
    for _ in range(20000):
        text = "".join(rnd.choices(some, k=rnd.randint(0, 12)))
        assert "".join(cut(text)) == text and ids(text) == library.encode_ordinary(text), text


@pytest.mark.parametrize("chunk", [1, 4000, 16 << 20])
def test_whole_texts_and_back(spark, chunk):
    texts = ODD + [prose(i % 7, 60) for i in range(40)] + ["the " * 5000, "՘x \U00011de0 y"]
    docs = documents(spark, texts).repartition(3)
    got = {r["doc_id"]: r for r in distinct_bpe.decode(distinct_bpe.encode(docs, chunk_bytes=chunk, shard_bytes=50_000)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert bytes(got[i]["ids"]) == want(t) and bytes(got[i]["decoded"]) == (t or "").encode()


def test_long_texts_are_taken_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(distinct_bpe, "LONG", 10)
    assert list(distinct_bpe.cutter().cut("one two  three\n\n4")) == distinct_bpe.cutter().plain.findall("one two  three\n\n4")


def test_repeats_missing_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, None), (None, "c"), (2, "")], "doc_id long, text string")
    got = [(r["doc_id"], bytes(r["ids"])) for r in distinct_bpe.encode(df).collect()]
    assert sorted(got, key=str) == sorted([(1, want("a b")), (1, want("a b")), (1, b""), (None, want("c")), (2, b"")], key=str)
    assert distinct_bpe.encode(df.limit(0)).count() == 0


def test_unknown_id_is_an_error(spark):
    df = spark.createDataFrame([(1, bytearray(np.array([1 << 30], "<u4").tobytes()))], "doc_id long, ids binary")
    with pytest.raises(Exception, match="out of bounds|not in the vocabulary"):
        distinct_bpe.decode(df).collect()


def test_both_sides_read_one_shuffle(spark):
    df = distinct_bpe.encode(documents(spark, [prose(i, 30) for i in range(20)]))
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_query(spark, tmp_path):
    texts = ODD + [prose(3, 50)]
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op13_distinct_bpe"](spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        assert got[i] == (len(want(t)) // 4, hashlib.sha256(want(t)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
