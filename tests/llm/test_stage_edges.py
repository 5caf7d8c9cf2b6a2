"""The pipeline's stages on awkward tables: nulls, repeats, empty tables, columns with clashing and dotted names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillspark.llm.jaccard_join import without_copies

from .helpers import prose


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stages"))
    texts = [prose(i, 60) for i in range(12)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1, texts[1]), (2, texts[1]), (13, None), (14, ""), (None, texts[3]), (15, "x@y.zz " + prose(50, 40)), (15, "x@y.zz " + prose(50, 40)), (16, prose(60, 15) + " " + prose(99, 30))]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(0, prose(99, 30))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(12)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


CLASHES = ["_score", "_pii_m", "_pii_g", "_pii", "_low", "_id", "name", "row", "label", "a.b"]


def test_stages_keep_rows_and_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for c in CLASHES:
        docs = docs.withColumn(c, F.lit("mine"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns and all(set(r[-len(CLASHES) :]) == {"mine"} for r in after.collect())
        kept[name] = [(r["doc_id"], r["text"]) for r in after.collect()]
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(kept["quality"], key=key) == sorted(given, key=key)
    gone = sorted(given, key=key)
    for r in [(1, prose(1, 60)), (2, prose(1, 60)), (15, "x@y.zz " + prose(50, 40))]:  # repeats of (1, A), the copy (2, A), a repeat of 15
        gone.remove(r)
    assert sorted(kept["near_copies"], key=key) == gone
    assert sorted(kept["benchmark"], key=key) == sorted((r for r in given if r[0] != 16), key=key)
    assert sorted(kept["personal_data"], key=key) == sorted(((d, (t or "").replace("x@y.zz", "[EMAIL]")) for d, t in given), key=key)


def test_stages_on_an_empty_table(spark, folder):
    none = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0


def test_run_is_the_stages_one_after_another(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder).persist()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["start"], r["ids_crc32"])
    piece = lambda df: [(r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in sorted(df.collect(), key=key)]
    assert piece(corpus_pipeline.run(spark, folder)) == piece(docs)


def test_repeats_of_one_doc_id_leave_one_row(spark):
    a, b = prose(1, 40), prose(2, 40)
    df = spark.createDataFrame([(1, a), (1, a), (2, b), (2, a)], "doc_id long, text string")
    assert sorted(map(tuple, without_copies(df, 5, 80).collect())) == [(1, a), (2, b)]
