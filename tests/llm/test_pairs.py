"""Operators 8 and 2 and the components against brute force."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.llm import decontaminate, jaccard_join

from .helpers import ODD, documents, prose, shingles, words


def brute_classes(texts, k, percent):
    sets = [frozenset(shingles(words(t), k)) for t in texts]
    up = list(range(len(texts)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return {i: (len(sets[i]), top(i)) for i in range(len(texts))}


def near(seed, n, edits):
    w = prose(seed, n).split()
    for i in range(edits):
        w[(seed + 7 * i * i + i) % n] = f"edit{seed}{i}"
    return " ".join(w)


def corpus():
    out = list(ODD) + [prose(i, 60) for i in range(10)]
    base = prose(99, 120).split()
    for i in range(40):  # one large group around a text, edited in one place each: some link only through others
        w = list(base)
        w[3 * i % 110] = f"w{i}"
        if i % 3 == 0:
            w[(3 * i + 50) % 110] = f"v{i}"
        out.append(" ".join(w))
    out += [" ".join(base)] * 6 + [near(5, 80, e) for e in range(8)] + ["tiny text"] * 3 + ["Tiny  TEXT", "a b c", "a b d", prose(3, 60).upper()]
    passage = prose(77, 50)
    return out + [passage + " " + prose(200 + i, 30) for i in range(12)] + [passage + f" tail{i}" for i in range(6)]


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80), (1, 60)])
def test_classes(spark, k, percent):
    texts = corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_classes(documents(spark, texts).repartition(5), k, percent).collect()}
    assert got == brute_classes(texts, k, percent)


def test_many_shards_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SHARD_BYTES", 5000)
    monkeypatch.setattr(jaccard_join, "CHUNK_BYTES", 3000)
    texts = corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_classes(documents(spark, texts)).collect()}
    assert got == brute_classes(texts, 3, 90)


def test_class_edges(spark):
    assert jaccard_join.jaccard_classes(documents(spark, ODD).limit(0)).count() == 0
    df = documents(spark, [prose(1, 40), prose(1, 40), prose(2, 40)])
    rows = jaccard_join.jaccard_classes(df.unionByName(df.limit(1)).withColumn("doc_id", F.when(F.col("doc_id") == 2, None).otherwise(F.col("doc_id")))).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["component_id"]) for r in rows) == [(False, 0, 0), (False, 0, 0), (False, 1, 0), (True, None, None)]


def shared_ids():
    """doc_id, text and source: one doc_id at texts of several groups, as the smallest of each, and rows without a doc_id."""
    one, two, three = prose(11, 80), prose(12, 80), prose(13, 80)
    change = lambda text, *at: " ".join(f"new{i}" if i in at else w for i, w in enumerate(text.split()))
    rows = [(1, one), (1, two), (1, two.upper()), (5, one), (6, two), (7, change(one, 2)), (8, change(two, 3)), (3, three), (3, prose(14, 30)), (4, change(three, 79))]
    rows += [(None, change(three, 0)), (None, change(prose(15, 60), 0)), (20, change(prose(15, 60), 0, 59)), (21, prose(15, 60)), (None, prose(16, 50)), (None, prose(16, 50)), (9, None), (9, " "), (9, one)]
    return [(d, t, str(i)) for i, (d, t) in enumerate(rows)]


def test_one_doc_id_on_different_texts(spark):
    given = shared_ids()
    want = brute_classes([t for _, t, _ in given], 3, 80)
    ids = {}
    for i, (d, _, _) in enumerate(given):
        ids.setdefault(want[i][1], []).extend([] if d is None else [d])
    assert sum(1 in x and len(x) > 2 for x in ids.values()) == 2
    df = spark.createDataFrame(given, "doc_id long, text string, source string")
    for parts in (1, 5):
        got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_classes(df.repartition(parts), 3, 80).collect())
        assert got == Counter((d, want[i][0], min(ids[want[i][1]], default=None)) for i, (d, _, _) in enumerate(given))
        left = jaccard_join.without_copies(df.repartition(parts), 3, 80)
        assert left.columns == df.columns
        stay = {}
        for r in left.collect():
            stay.setdefault(want[int(r["source"])][1], []).append(r["doc_id"])
        assert {g: sorted(d for d in x if d is not None) for g, x in stay.items()} == {g: x if want[g][0] == 0 else sorted(x)[:1] for g, x in ids.items()}
        assert sum(None in x for x in stay.values()) == 3 and left.filter("doc_id is null").count() == 4


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(70)] + [(200, 201), (201, 202), (200, 202)], "a long, b long")
    got = {r["id"]: r["label"] for r in jaccard_join.components(edges).collect()}
    assert got == {i: 0 for i in range(71)} | {i: 200 for i in range(200, 203)}


def brute_leaks(texts, items):
    out = {}
    for d, t in enumerate(texts):
        for i, item in enumerate(items):
            w, x = words((t or "").lower()), words((item or "").lower())
            if not w or not x:
                continue
            k = min(5, len(x))
            if len(w) < k:
                continue
            g, c = shingles(w, k), Counter(shingles(x, k))
            m = sum(c.values())
            best = 0
            for s in range(max(1, len(g) - m + 1)):
                y = Counter(g[s : s + m])
                best = max(best, sum((y & c).values()) / sum((y | c).values()))
            if best >= 0.8:
                out[d, i] = best
    return out


def test_leaks(spark, monkeypatch):
    items = [prose(i, 12 + 3 * i) for i in range(14)] + [None, "", "só três", "one two three four", prose(2, 18)]
    long = prose(30, 70)
    items.append(long)
    texts = list(ODD) + [prose(50 + i, 30) + " " + items[i] + " " + prose(80 + i, 20) for i in range(14)]
    texts += [long.upper(), " ".join(long.split()[:60]), " ".join(long.split()[4:]), long.replace(long.split()[35], "changed", 1), "x Só  TRÊS y", "one two three four", "one two three", " ".join([items[3]] * 3)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = documents(spark, texts)
    want = brute_leaks(texts, items)
    assert len(want) > 16
    for block in (1024, 4):
        monkeypatch.setattr(decontaminate, "ITEMS", block)
        rows = decontaminate.leaks(docs, bench).collect()
        assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in rows} == pytest.approx(want)
        kept = decontaminate.without_leaks(docs, bench)
        assert kept.columns == docs.columns
        assert {r["doc_id"] for r in kept.collect()} == set(range(len(texts))) - {d for d, _ in want}
    twice = bench.filter("item_id = 2").unionByName(bench.filter("item_id = 2")).withColumn("item_id", F.lit(None).cast("long"))
    assert [(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, twice).collect()] == [(d, None) for d, i in sorted(want) if i == 2 for _ in range(2)]
    assert decontaminate.leaks(docs.limit(0), bench).count() == 0
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.without_leaks(docs, bench.limit(0)).count() == len(texts)


def test_index_guarantees_the_radius():
    items = [(i, prose(i, 20), 1) for i in range(60)]
    index = decontaminate.Index(items, 5, 80, decontaminate.RADIUS)
    rnd = np.random.default_rng(1)
    probes = []
    for p in index.prints[:40]:
        flips = rnd.permutation(64)[: decontaminate.RADIUS]
        probes.append(p ^ np.uint64(sum(1 << int(b) for b in flips)))
    where, item = index.candidates(np.array(probes, np.uint64))
    got = set(zip(where.tolist(), item.tolist()))
    assert {(i, j) for i, p in enumerate(probes) for j, q in enumerate(index.prints) if int(np.bitwise_count(p ^ q)) <= decontaminate.RADIUS} == got
    assert all((i, i) in got for i in range(40))


def test_similar_windows_are_within_the_radius():
    """The share of pairs of weighted shingle sets at the least similarity whose prints are within the radius; measured, see the README."""
    rnd = np.random.default_rng(5)
    for n in (12, 30, 80, 200):
        near = 0
        for _ in range(400):
            need = decontaminate._need(n, n, 80)
            grams = rnd.integers(1, 1 << 63, 2 * n - need, dtype=np.uint64)
            a, b = (decontaminate._fingerprints(g, np.zeros(1, int), n)[0] for g in (grams[:n], np.concatenate([grams[:need], grams[n:]])))
            near += int(np.bitwise_count(a ^ b)) <= decontaminate.RADIUS
        assert near / 400 >= 0.99, n
