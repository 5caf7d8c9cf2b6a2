"""The pipeline's stages against plain rules, each on its own input, and the registered SQL."""

import re

import corpus_pipeline
from quillspark.llm import mil_quality
from quillspark.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle import SF, database, rows

from .helpers import shingles, words
from .test_models import PATTERNS, valid
from .test_pairs import brute_leaks


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF).persist()
        kept[name] = (before.toPandas(), after.toPandas())
        if name != "packed":
            assert after.columns == columns
        before = after
    given, left = kept["quality"]
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    good = set(labels.doc_id[labels.quality == 1])
    assert len(good & set(left.doc_id)) >= 0.97 * len(good)
    bad = set(labels.doc_id[labels.quality == 0])
    assert len(bad & set(left.doc_id)) <= 0.2 * len(bad)

    given, left = kept["near_copies"]
    sets = {i: frozenset(shingles(words(t), 5)) for i, t in zip(given.doc_id, given.text)}
    group = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = {k: min(a, b) if g in (a, b) else g for k, g in group.items()}
    assert set(left.doc_id) == {i for i, g in group.items() if i == g}

    given, left = kept["benchmark"]
    items = spark.read.parquet(f"{SF}/benchmark.parquet").toPandas()
    leaking = {given.doc_id.iloc[d] for d, _ in brute_leaks(list(given.text), list(items.text))}
    assert leaking and set(left.doc_id) == set(given.doc_id) - leaking

    given, left = kept["personal_data"]
    text = dict(zip(left.doc_id, left.text))
    for i, t in zip(given.doc_id, given.text):
        found = [m[0] for k, p in PATTERNS.items() for m in re.finditer(p, t) if valid(k, m[0])]
        assert not any(f in text[i] for f in found)
        if not found and "[SECRET]" not in text[i]:
            assert text[i] == t
    assert (left.n_chars == left.text.str.len()).all()

    given, left = kept["packed"]
    assert set(left.doc_id) == set(given.doc_id)
    whole = left.groupby("doc_id").agg(n=("length", "sum"), t=("doc_tokens", "first"))
    assert (whole.n == whole.t).all()


def test_run_equals_the_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns[:3] == ["doc_id", "start", "length"] and got.count()


def test_queries_and_their_sql(spark):
    assert sorted(QUERIES) == sorted(f"op{i}_{n}" for i, n in enumerate(("repair_ids", "decontaminate", "packing", "token_fst", "media", "pii", "revisits", "jaccard_join", "backoff_lm", "mil_quality", "centroids", "turn_repair", "distinct_bpe"), 1))
    for name, sql in ORACLE_SQL.items():
        assert rows(QUERIES[name](spark, SF).toPandas()) == rows(database().sql(sql).df())


def test_threshold_is_the_query_s():
    assert mil_quality.THRESHOLD == 0.3
