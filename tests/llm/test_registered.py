"""The registered queries on a small folder with nulls, empties, repeats and clashing columns, against plain rules."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quillspark.llm.queries import QUERIES

from .helpers import ODD, documents, prose, words
from .test_models import PATTERNS, brute_scores, valid
from .test_pairs import brute_leaks

TEXTS = ODD + [prose(i % 9, 50) for i in range(20)] + ["mail me@x.org or 10.1.2.3 or +49 30 1234567, 4111 1111 1111 1111."]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("registered"))
    documents(spark, TEXTS).write.parquet(f"{path}/documents.parquet")
    documents(spark, TEXTS).limit(0).write.parquet(f"{path}/empty/documents.parquet")
    for p in (path, f"{path}/empty"):
        spark.createDataFrame([(0, prose(3, 50)), (1, None)], "item_id long, text string").write.parquet(f"{p}/benchmark.parquet")
        spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{p}/embeddings.parquet")
        spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{p}/conversations.parquet")
        spark.createDataFrame([(i, i % 2, 0) for i in range(len(TEXTS))], "doc_id long, quality int, toxic int").write.parquet(f"{p}/labels.parquet")
    return path


def run(spark, folder, name):
    return {r["doc_id"]: r for r in QUERIES[name](spark, folder).collect()}


def ids(name, text, end):
    return np.array([*Tokenizer.from_file(public_tokenizers.path(name)).encode(text or "", add_special_tokens=False).ids, *end], "<u4")


def test_ids(spark, folder):
    got, start = run(spark, folder, "op1_repair_ids"), 0
    for i, t in enumerate(TEXTS):
        x = ids("byte_bpe_50k.json", t, [0])
        assert tuple(got[i])[:4] == (i, start, len(x), zlib.crc32(x.tobytes()))
        start += len(x)


def test_leaks(spark, folder):
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op2_decontaminate"](spark, folder).collect()}
    assert got == set(brute_leaks(TEXTS, [prose(3, 50), None])) and got


def test_pieces(spark, folder):
    pieces, room = {}, {}
    for r in QUERIES["op3_packing"](spark, folder).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
        room.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, t in enumerate(TEXTS):
        x, at = ids("word_bpe_49k.json", t, [2]), 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(x) and r["ids_crc32"] == zlib.crc32(x[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(x)
    for spans in room.values():
        ends = np.cumsum([n for _, n in sorted(spans)])
        assert [o for o, _ in sorted(spans)] == [0, *ends[:-1]] and ends[-1] <= 4096


def test_counts(spark, folder):
    got = run(spark, folder, "op4_token_fst")
    for i, t in enumerate(TEXTS):
        n = len(ids("byte_bpe_50k.json", t, []))
        assert tuple(got[i])[:4] == (i, len((t or "").encode()), n, n > 512)


def test_media(spark, folder):
    got = run(spark, folder, "op5_media")
    for i, t in enumerate(TEXTS):
        data = (t or "").encode()
        payload = data + b" " * (-len(data) % 192 or 192 * (not data))
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        digest = hashlib.sha256((",".join(map(str, r["times"])) + ";" + ",".join(map(str, r["hashes"]))).encode()).hexdigest()
        assert r["feature"] == f"{len(r['times'])}:{digest}" and r["media_bytes"] > len(payload)


def test_personal_data(spark, folder):
    got = run(spark, folder, "op6_pii")
    for i, t in enumerate(TEXTS):
        spans = {k: [(m.start(), m.end()) for m in re.finditer(p, t or "") if valid(k, m[0])] for k, p in PATTERNS.items()}
        base = ",".join(f"{k}:{a}:{b}" for k, s in spans.items() for a, b in s)
        r = got[i]
        assert [r[f"n_{k}"] for k in spans] == [len(s) for s in spans.values()]
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and (r["spans"] + ",").startswith(base)


def test_scores(spark, folder):
    got = run(spark, folder, "op9_backoff_lm")
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(TEXTS))]
    for i, want in enumerate(brute_scores(TEXTS, [not h for h in held])):
        assert got[i]["held_out"] == held[i] and tuple(got[i])[2:] == pytest.approx(want, rel=1e-9)


def test_quality(spark, folder):
    got = run(spark, folder, "op10_mil_quality")
    for i in range(len(TEXTS)):
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= got[i]["score"] <= 1 and got[i]["predicted"] == int(got[i]["score"] >= 0.3)


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "op7_revisits"])
def test_empty_tables(spark, folder, name):
    assert QUERIES[name](spark, f"{folder}/empty").count() == 0


def test_attention_by_plain_loops_and_numeric_gradient():
    from quillspark.llm.mil_quality import AttentionMil, FEATURES, HIDDEN

    rng = np.random.default_rng(1)
    model = AttentionMil()
    shape = {"E": (FEATURES, HIDDEN), "V": (FEATURES, HIDDEN), "U": (FEATURES, HIDDEN), "g": (HIDDEN,), "c": (HIDDEN,), "e": (HIDDEN,), "v": (HIDDEN,), "u": (HIDDEN,), "d": (1,)}
    model.w = w = {k: rng.normal(0, 0.3, s) for k, s in shape.items()}
    sizes, labels = np.array([1, 4, 2]), np.array([1.0, 0.0, 1.0])
    x, at = rng.normal(0, 1, (7, FEATURES)), [0, 1, 5]

    def plain():
        out = []
        for a, n in zip(at, sizes):
            raw = [float((np.tanh(p @ w["V"] + w["v"]) / (1 + np.exp(-(p @ w["U"] + w["u"])))) @ w["g"]) for p in x[a : a + n]]
            weigh = np.exp(raw) / np.exp(raw).sum()
            z = sum(k * np.tanh(p @ w["E"] + w["e"]) for k, p in zip(weigh, x[a : a + n]))
            out.append(float(1 / (1 + np.exp(-(z @ w["c"] + w["d"][0])))))
        return np.array(out)

    assert model._forward(x, sizes)[5] == pytest.approx(plain())
    grad = model._gradient(x, sizes, labels)
    loss = lambda: -np.mean(labels * np.log(plain()) + (1 - labels) * np.log(1 - plain()))
    for k in shape:
        i = tuple(int(rng.integers(0, n)) for n in shape[k])
        old = w[k][i]
        w[k][i] = old + 1e-5
        up = loss()
        w[k][i] = old - 1e-5
        down = loss()
        w[k][i] = old
        assert grad[k][i] == pytest.approx((up - down) / 2e-5, abs=1e-6), k
