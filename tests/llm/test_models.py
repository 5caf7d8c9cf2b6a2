"""Operators 6, 9 and 10 and the revisits."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.operators.digests import ranges
from quillspark.llm import backoff_lm, mil_quality, pii, revisit

from .helpers import ODD, documents, prose, words

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


PERSONAL = [
    "a.b@c.d e@f g@h.i-j.k, x@y@z.com", "x@y.z_w@v.u.", "\U0001f600 é me@host.org", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.0000255.3.4 9999999999999999999999.1.1.1", "4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111",
    "+1 (017) 555-7713 +1 2 +12345678 +1234567890123456 call +49-30 123456.", "4111 1111 1111 1111@x.yz", "1" * 5000, "a" * 5000 + "@", "a@b." * 300, 'token = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda" end', "password: cb1a9fee807a05366fcb8b6c95c7c565ede51a72",
    "edltreatiensonreintionabsolutely words", "+" * 300 + "1", "4" + " 1" * 15, "5 4111111111111111", "12-34-56",
]


def test_base_spans_are_those_of_the_plain_patterns(spark):
    texts = ODD + PERSONAL
    df = documents(spark, texts)
    for r in pii.with_spans(df, pii.train(df)).collect():
        t = texts[r["doc_id"]] or ""
        for kind, pattern in PATTERNS.items():
            want = [(m.start(), m.end()) for m in re.finditer(pattern, t) if valid(kind, m[0])]
            assert [(s["start"], s["end"]) for s in r[kind]] == want, (kind, t[:80])
    secret = {r["doc_id"]: [(texts[r["doc_id"]])[s["start"] : s["end"]] for s in r["secret"]] for r in pii.with_spans(df, pii.train(df)).collect() if r["secret"]}
    assert set(secret) == {len(ODD) + 10, len(ODD) + 11} and all(len(x[0]) == 40 for x in secret.values())


def test_redaction(spark):
    texts = ODD + PERSONAL
    df = documents(spark, texts)
    out = pii.redacted(df, pii.train(df))
    assert out.columns == df.columns
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    at = len(ODD)
    assert got[at + 2] == "\U0001f600 é [EMAIL]" and got[at + 10] == 'token = "[SECRET]" end'
    assert got[at + 3].startswith("[IP] 256.1.1.1 [IP].[IP] [IP] ") and got[at + 5].startswith("[PHONE] +1 2 [PHONE]")
    for i, t in enumerate(texts):
        if not any(valid(k, m[0]) for k, p in PATTERNS.items() for m in re.finditer(p, t or "")) and i not in (at + 10, at + 11):
            assert got[i] == (t or "")
    assert pii.redacted(df.limit(0), pii.train(df.limit(0))).count() == 0


def test_reliabilities_are_learnt():
    counts = {(1, 1, 1, 1): 40, (1, 0, 1, 1): 10, (-1, 0, -1, -1): 200, (0, 0, -1, -1): 50, (1, 0, -1, 1): 5}
    belief = pii.estimate(counts)
    assert belief[1, 1, 1, 1] > 0.95 and belief[1, 0, 1, 1] > 0.9 and belief[-1, 0, -1, -1] < 0.05


def test_pii_plan_has_no_python(spark):
    df = documents(spark, PERSONAL)
    plan = pii.redacted(df, pii.train(df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_scores(texts, train):
    """By recursion over contexts, without an automaton."""
    tokens = [[*words(t), "\n"] for t in texts]
    c, b, t3 = Counter(), Counter(), Counter()
    starts = 0
    for t, learn in zip(tokens, train):
        if learn:
            starts += 1
            c.update(t)
            b.update(zip(["", *t], t))
            t3.update(zip(["", *t], t, t[1:]))
    n, v = sum(c.values()), len(c)
    c[""] = starts

    def p(w, *h):
        if not h:
            return ((c[w] if w else 0) + 1) / (n + v + 1)
        held, joint = (c[h[0]], b[*h, w]) if len(h) == 1 else (b[h], t3[*h, w])
        mass = backoff_lm.MASS[len(h)]
        return (joint + mass * p(w, *h[1:])) / (held + mass) if held else p(w, *h[1:])

    out = []
    for t in tokens:
        score = sum(math.log10(p(w, *["", *t][max(0, i - 1) : i + 1])) for i, w in enumerate(t))
        out.append((len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), score))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_backoff_scores(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(backoff_lm, "CHUNK_TOKENS", 300)
        monkeypatch.setattr(backoff_lm, "SHARD_BYTES", 3000)
        monkeypatch.setattr(backoff_lm, "SEGMENT", 5)
    texts = ODD[:13] + [prose(i % 9, 50) for i in range(40)] + ["two words", "one two words more"]
    train = [i % 4 != 2 for i in range(len(texts))]
    df = documents(spark, texts).withColumn("train", F.col("doc_id") % 4 != 2).repartition(3)
    rows = {r["doc_id"]: r for r in backoff_lm.score_texts(df).collect()}
    assert len(rows) == len(texts)
    for i, want in enumerate(brute_scores(texts, train)):
        assert rows[i]["held_out"] == (not train[i])
        assert tuple(rows[i])[2:] == pytest.approx(want, rel=1e-9)


def small_automaton():
    texts = [prose(i % 4, 40) for i in range(8)] + ["unknown words of the test"]
    tokens = [[*words(t), "\n"] for t in texts]
    names = sorted({w for t in tokens for w in t})
    ids, n = np.array([names.index(w) for t in tokens for w in t]), np.array([len(t) for t in tokens])
    grams = backoff_lm.Grams(np.arange(1, len(names) + 1, dtype=np.uint64) * np.uint64(1 << 40), ids, n)
    learn = np.repeat(np.arange(len(n)) < 8, n)
    counts = grams.counted(learn)
    return grams, counts, backoff_lm.Automaton(grams, counts, int(learn.sum()), int((counts[: len(names)] > 0).sum()), 8)


def test_backoff_probabilities_sum_to_one():
    grams, counts, a = small_automaton()
    known = np.flatnonzero(counts[: len(grams.word)])
    assert len(a.key) > 100 and (np.diff(a.key) > 0).all()
    unknown = 1 / (counts[known].sum() + len(known) + 1)
    for state in {0, *(a.key[:-1] >> 32).tolist()}:
        _, weight = a.step(np.full(len(known), state), known)
        rest, s = math.log10(unknown), state
        while s:
            rest, s = rest + a.failure[s], a.fails_to[s]
        assert (10**weight).sum() + 10**rest == pytest.approx(1)


def test_arcs_lead_to_the_longest_context_and_failures_to_shorter_ones():
    grams, counts, a = small_automaton()
    w = len(grams.word)

    def context(state):
        if state >= 2 + w:
            before, last = int(grams.pair[state - 2 - w] >> 32), int(grams.pair[state - 2 - w] & 0xFFFFFFFF)
            return before - 1, last
        return () if state == 0 else (-1,) if state == 1 else (state - 2,)

    states = {context(s) for s in {0, 1, *a.target.tolist(), *a.word_state.tolist()}}
    for s in set(a.target.tolist()) - {0}:
        assert context(a.fails_to[s]) == context(s)[1:]
    for key, target in zip(a.key[:-1].tolist(), a.target.tolist()):
        full = (*context(key >> 32), key & 0xFFFFFFFF)
        assert context(target) == next(full[i:] for i in range(max(0, len(full) - 2), len(full) + 1) if full[i:] in states)


def test_requests_cover_all_prints_by_owner():
    grams, _, _ = small_automaton()
    for shards in (1, 3, 1000, 1 << 22):
        asked = list(grams.requests(shards))
        assert [a for _, a, _ in asked] == [0, *(b for _, _, b in asked)][:-1] and asked[-1][2] == len(grams.prints)
        for shard, a, b in asked:
            assert backoff_lm._start(shard, shards) <= grams.prints[a] and (shard + 1 == shards or grams.prints[b - 1] < backoff_lm._start(shard + 1, shards))


def test_segments_carry_the_state(monkeypatch):
    grams, _, a = small_automaton()
    whole = a.read(grams.ids, grams.n)
    for size in (2, 3, 7):
        monkeypatch.setattr(backoff_lm, "SEGMENT", size)
        assert a.read(grams.ids, grams.n) == pytest.approx(whole, rel=1e-12)


def test_backoff_edges(spark):
    df = documents(spark, ODD[:6])
    assert backoff_lm.score_texts(df.limit(0).withColumn("train", F.lit(True))).count() == 0
    rows = backoff_lm.score_texts(df.withColumn("train", F.lit(None).cast("boolean"))).collect()
    assert all(r["held_out"] and r["score"] == r["base_score"] == 0 and r["train_tokens"] == 0 for r in rows)


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = mil_quality.op10_mil_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in got)
    assert len(got) > 40 and right / len(got) > 0.93
    good = [r["score"] for r in got if r["quality"]]
    bad = [r["score"] for r in got if not r["quality"]]
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.95
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in got)


def test_quality_edges(spark):
    df = documents(spark, ODD)
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)] + [(3, 0), (None, 1), (4, None)], "doc_id long, label int")
    model = mil_quality.train(df, labels)
    rows = mil_quality.with_scores(df, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    again = mil_quality.with_scores(df.repartition(4), mil_quality.train(df.repartition(3), labels)).collect()
    assert {r["doc_id"]: r["score"] for r in again} == pytest.approx({r["doc_id"]: r["score"] for r in rows}, abs=1e-5)
    assert mil_quality.with_scores(df.limit(0), mil_quality.train(df, labels.limit(0))).count() == 0
    assert mil_quality.train(df, labels.limit(0)).constant == 0.5


def test_one_passage_decides():
    import numpy as np

    rng = np.random.default_rng(0)
    sizes = np.full(120, 6)
    x = rng.normal(0, 1, (720, mil_quality.FEATURES)).astype(np.float32)
    labels = (np.arange(120) % 2).astype(np.float32)
    x[np.arange(0, 720, 12) + 3, 0] += 9  # a single passage of every even bag
    model = mil_quality.AttentionMil().fit(x, sizes, labels)
    assert ((model.scores(x, sizes) > 0.5) == (labels == 1)).mean() > 0.95


def archive(spark, rows):
    return spark.createDataFrame(rows, "record_id long, kind string, url string, time long, headers map<string,string>, payload string")


def test_revisits(spark):
    h = lambda **k: {a.replace("_", "-"): b for a, b in k.items()}
    rows = [
        (1, "response", "http://www.A.com/x/#f", 10, h(etag="e1", server="s"), "old"), (2, "response", "https://a.com/x", 20, h(etag="e2", server="s", last_modified="d"), "new"), (3, "response", "https://a.com/x", 20, h(etag="e3"), None),
        (4, "revisit", "http://m.a.com/x?ref=q", 15, h(etag="W/e1", date="t", set_cookie="c"), None), (5, "revisit", "http://a.com/x", 20, h(etag="e1"), None), (6, "revisit", "http://a.com/x", 25, h(etag="e1"), None), (7, "revisit", "http://a.com/x", 30, h(last_modified="d"), None),
        (8, "revisit", "http://a.com/x", 30, {}, None), (9, "revisit", "http://b.com", 30, h(etag="e1"), None), (10, "revisit", None, 30, h(etag="e1"), None), (11, "revisit", "http://a.com/x", None, None, None), (7, "revisit", "http://a.com/x", 30, h(last_modified="d"), None),
    ]
    got = revisit.resolve_revisits(archive(spark, rows)).collect()
    by = {r["record_id"]: (r["status"], r["source_id"], r["payload"]) for r in got}
    assert by == {4: ("resolved", 1, "old"), 5: ("resolved", 1, "old"), 6: ("mismatch", 2, None), 7: ("resolved", 2, "new"), 8: ("unvalidated", 2, None), 9: ("orphan", None, None), 10: ("orphan", None, None), 11: ("orphan", None, None)}
    assert sum(r["record_id"] == 7 for r in got) == 2
    assert next(r["headers"] for r in got if r["record_id"] == 4) == {"etag": "W/e1", "server": "s", "date": "t"}
    assert revisit.resolve_revisits(archive(spark, rows).limit(0)).count() == 0


def test_an_outlier_leaves_the_ranges_even(spark):
    rows = [(i, "response" if i % 2 else "revisit", "http://u.org", 10**9 + i, {"etag": "e"}, "p" if i % 2 else None) for i in range(300)] + [(999, "response", "http://u.org", 5, {"etag": "e"}, "first")]
    df = archive(spark, rows).withColumn("key", F.lit(1)).withColumn("bucket", F.lit(2))
    edges = df.agg(F.percentile_approx("time", [i / 64 for i in range(1, 64)], 1000)).first()[0]
    sizes = df.groupBy(ranges(F.col("time"), sorted(set(edges))).alias("b")).count().collect()
    assert len(sizes) == 64 and max(r["count"] for r in sizes) < 12
    got = {r["record_id"]: r["source_id"] for r in revisit.resolve_revisits(df).collect()}
    assert got == {i: i - 1 if i else 999 for i in range(0, 300, 2)}


def test_one_url_over_many_ranges(spark):
    rows = [(2 * i, "response" if i % 3 else "revisit", "http://u.org", (i * 37) % 1000, {"etag": "e"}, "p" if i % 3 else None) for i in range(400)]
    full = [(r[3], r[0], r[5]) for r in rows if r[1] == "response"]
    for r in revisit.resolve_revisits(archive(spark, rows).repartition(6)).collect():
        before = [x for x in full if x[0] < r["time"]]
        assert r["source_id"] == (max(before)[1] if before else None)


def test_query_digests(spark):
    texts = ["mail a@b.cd now"]
    r = pii.with_spans(documents(spark, texts), pii.SpanClassifier(0.0, {})).collect()[0]
    assert [(s["start"], s["end"]) for s in r["email"]] == [(5, 11)]
