import hashlib
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillspark.codes import Refused
from quillspark.operators import checks, digests, selection
from quillspark.plans import profiles


def table(spark, n=60):
    rows = [(i, f"text {i % 17}", "tl" if i % 5 == 0 else "en") for i in range(n)]
    return spark.createDataFrame(rows, "source_index long, body string, lang string")


def by_hand(df, count, salt):
    seen, ranked = Counter(), []
    for r in sorted(df.collect(), key=lambda r: r["source_index"]):
        digest = hashlib.sha256(json.dumps({"body": r["body"]}, separators=(",", ":"), sort_keys=True).encode()).hexdigest()
        ranked.append((hashlib.sha256(f"{salt}:{digest}:{seen[digest]}".encode()).hexdigest(), r["source_index"]))
        seen[digest] += 1
    return sorted(i for _, i in sorted(ranked)[:count])


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_stable_selection_is_a_function_of_content(spark, parts):
    df = table(spark)
    shuffled = df.orderBy(F.rand(parts)).repartition(parts)
    got = [r["source_index"] for r in selection.select_stable(shuffled, 20, "a:b", ["body"], "source_index").collect()]
    assert got == by_hand(df, 20, "a:b")
    assert got != list(range(20))


def test_selection_returns_all(spark):
    df = table(spark)
    assert selection.select_stable(df, None, "s", ["body"], "source_index").count() == 60
    assert selection.select_stable(df, 500, "s", ["body"], "source_index").count() == 60
    assert selection.select_stable(df, 5, "s", ["body"], "source_index", "all").count() == 60
    with pytest.raises(Refused):
        selection.select_stable(df, 5, "s", ["body"], "source_index", "first")


def test_selection_plan_is_a_bounded_heap(spark, capsys):
    selection.select_bounded(table(spark), 5, "s", "source_index", ["body"]).explain()
    assert "TakeOrderedAndProject" in capsys.readouterr().out


def test_bounded_selection(spark):
    df = table(spark)
    got = selection.select_bounded(df, 10, "s", "source_index", ["body"]).collect()
    assert [r["rank"] for r in got] == sorted(r["rank"] for r in got)
    with pytest.raises(Refused):
        selection.select_bounded(df, 0, "s", "source_index", ["body"])
    with pytest.raises(Exception, match="blank identity"):
        selection.select_bounded(df.withColumn("id", F.lit(" ")), 3, "s", "id", ["body"]).collect()


def streamed(spark, tmp_path, schema, count=8):
    from quillspark.streaming.selection import selected, stream_bounded

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    stream_bounded(stream, f"{tmp_path}/cp", count, "s", "source_index", ["body"], parts=3).awaitTermination()
    return selected(spark, f"{tmp_path}/cp", count, schema)


def test_streamed_selection_equals_batch_with_repeats_and_restarts(spark, tmp_path):
    df = table(spark).withColumn("more", F.when(F.col("source_index") % 2 == 0, F.col("source_index") * 1.5))
    batches = [df.filter("source_index < 5"), df.filter("source_index < 5"), df.filter("source_index < 5").union(df.filter("source_index < 5")), df.filter("source_index between 20 and 40"), df.filter("source_index > 38")]
    want, every = None, None
    for i, batch in enumerate(batches):
        batch.coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
        every = batch if every is None else every.union(batch)
        if i in (1, 2, 4):  # the query is started again after the second, third and last batch
            want = [tuple(r) for r in selection.select_bounded(every, 8, "s", "source_index", ["body"]).collect()]
            assert [tuple(r) for r in streamed(spark, tmp_path, df.schema).collect()] == want
            assert len(want) == 8 and (len(set(want)) <= 5) == (i < 4)  # repeats count as often as they come
    assert [tuple(r) for r in streamed(spark, tmp_path, df.schema).collect()] == want  # nothing new


def test_streamed_selection_refuses_no_rows(spark, tmp_path):
    from quillspark.streaming.selection import stream_bounded

    with pytest.raises(Refused):
        stream_bounded(table(spark), "x", 0, "s", "source_index", ["body"])


def test_language_exclusion(spark):
    df = table(spark).union(spark.createDataFrame([(99, "x", None)], "source_index long, body string, lang string"))
    assert selection.drop_languages(df, "lang", ["TL"]).count() == 49
    for field, gone in (("none", ["tl"]), ("lang", ["xx"]), ("lang", ["tl", "en", "none"])):
        with pytest.raises(Refused):
            selection.drop_languages(df, field, gone)
    assert selection.drop_languages(df, None, []).count() == 61


def test_template_exclusion(spark):
    head = "Name every lake that the next lines speak of, in their order é; " * 3
    donor = spark.createDataFrame([(head + "a",), (head + "b",)], "inputs string")
    prefix = selection.derive_prefix(donor, "inputs")
    assert prefix == head
    rows = spark.createDataFrame([(head + "c",), ("other",), (None,)], "inputs string")
    assert selection.drop_prefix(rows, "inputs", prefix, 1).count() == 2
    for wrong in (0, 2):
        with pytest.raises(Refused):
            selection.drop_prefix(rows, "inputs", prefix, wrong)
    with pytest.raises(Refused):
        selection.derive_prefix(rows, "inputs")


def test_occurrence_counts_equal_rows_in_order(spark):
    df = spark.createDataFrame([(i, "same" if i % 3 else "other") for i in range(200)], "i long, k string")
    got = {r["i"]: r["occurrence"] for r in selection.occurrence(df.repartition(7), "k", "i").collect()}
    seen = Counter()
    for i in range(200):
        k = "same" if i % 3 else "other"
        assert got[i] == seen[k]
        seen[k] += 1


def test_holdout_and_empty(spark):
    df = table(spark).withColumn("fp", F.sha2("body", 256))
    out = selection.holdout(df, "fp", "source_index")
    assert out.filter("split = 'validation'").count() == 12
    with pytest.raises(Refused):
        selection.holdout(df.limit(1), "fp", "source_index")


def test_leakage_and_digests(spark):
    df = spark.createDataFrame([("train", "a"), ("train", "a"), ("test", "a"), ("test", "b"), ("validation", "b"), ("train", "c")], "split string, fp string")
    got = {(r["split_a"], r["split_b"]): r["shared"] for r in checks.leakage(df, "split", "fp").collect()}
    assert got == {("test", "train"): 1, ("test", "validation"): 1}
    dup = {r["split"]: r["duplicates"] for r in checks.duplicate_counts(df, "split", "fp").collect()}
    assert dup == {"train": 1, "test": 0, "validation": 0}
    want = hashlib.sha256("\n".join(sorted("aaabbc")).encode()).hexdigest()
    assert checks.fingerprint_digest(df, "fp").first()["digest"] == want == df.agg(checks.set_digest(F.col("fp"))).first()[0]
    report = checks.split_report(df.withColumn("n", F.lit(3)), "split", "fp", "n")
    none = df.limit(0)
    assert checks.first_problem(report, checks.leakage(df, "split", "fp"), "split", 10, 100) == "DATASET_SPLIT_LEAKAGE"
    assert checks.first_problem(report, checks.leakage(none, "split", "fp"), "split", 2, 100) == "DATASET_SEQUENCE_TOO_LONG"
    assert checks.first_problem(report, checks.leakage(none, "split", "fp"), "split", 10, 5) == "DATASET_TOKEN_BUDGET_EXCEEDED"
    assert checks.first_problem(report, checks.leakage(none, "split", "fp"), "split", 10, 100) is None


def test_occurrence_with_null_orders_and_one_frequent_content(spark):
    rows = [(None if i % 5 == 0 else 7 * i, "hot" if i % 2 else None, i) for i in range(200)] + [(10**15, "hot", 500)]
    df = spark.createDataFrame(rows, "o long, k string, occurrence int").repartition(5)
    got = selection.occurrence(df, "k", "o", "place").collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"o", "k", "occurrence", "place"}
    for key in ("hot", None):
        mine = sorted((r["o"] is not None, r["o"] or 0, r["place"]) for r in got if r["k"] == key)
        assert sorted(p for _, _, p in mine) == list(range(len(mine)))
        assert [p for there, _, p in mine if there] == list(range(sum(not there for there, _, _ in mine), len(mine)))


def test_selection_keeps_a_users_columns(spark):
    df = spark.createDataFrame([(i, f"t{i % 4}", i, i, i) for i in range(40)], "id long, text string, occurrence int, _hash int, _rank int")
    out = selection.select_stable(df, 10, "s", ["text"], "id")
    assert out.columns == df.columns and out.count() == 10
    assert [tuple(r) for r in out.collect()] == sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("few", [5, 100_000])
def test_holdout_of_frequent_fingerprints(spark, monkeypatch, few):
    from quillspark.operators import digests

    monkeypatch.setattr(digests, "FEW", few)
    monkeypatch.setattr(selection, "FEW", few)
    fps = ["00" * 32 if i % 2 else f"{i * 7919 % 100000:064x}"[::-1] for i in range(300)]
    rows = [(f, i) for i, f in enumerate(fps)] + [(None, 999)]
    df = spark.createDataFrame(rows, "fp string, o long")
    got = {(r["fp"], r["o"]) for r in selection.holdout(df, "fp", "o", 0.4).filter("split = 'validation'").collect()}
    assert got == set(sorted(r for r in rows if r[0] is not None)[: int(301 * 0.4)])


def test_digests_of_groups_in_pieces(spark, monkeypatch):
    import hashlib

    from quillspark.operators import digests

    monkeypatch.setattr(digests, "PIECE_BYTES", 50)
    rows = [(f"g{i % 3}", (i * 37) % 101, f"value{i}") for i in range(101)]
    df = spark.createDataFrame(rows, "g string, o long, v string").repartition(7)
    got = {r["g"]: (r["n"], r["digest"]) for r in digests.sequence_digest(df, F.col("g"), [F.col("o")], F.col("v"), ",", "[", "]").collect()}
    for g in ("g0", "g1", "g2"):
        mine = [v for _, v in sorted((o, v) for k, o, v in rows if k == g)]
        assert got[g] == (len(mine), hashlib.sha256(("[" + ",".join(mine) + "]").encode()).hexdigest())
    assert digests.sequence_digest(df.limit(0), F.col("g"), [F.col("o")], F.col("v")).count() == 0
    a, b = (df.select(digests.content_sum(F.col("o"), F.col("v")).alias("s")).first()["s"] for df in (df, df.filter("o <> 3")))
    assert a != b


def test_command_line(spark, tmp_path, capsys):
    rows = [(i, f"ask {i}", "", f"answer {i}") for i in range(30)]
    for name, part in (("a", rows[:20]), ("b", rows[15:])):
        spark.createDataFrame(part, "source_index int, instruction string, context string, response string").write.parquet(f"{tmp_path}/{name}")
    profile = json.dumps({"dataset_id": "d", "name": "p", "kind": "instruction", "key_fields": ["instruction", "response"], "revision": "r", "count": 20})
    said = lambda *args: (profiles.main(list(args)), json.loads(capsys.readouterr().out))
    for name in "ab":
        code, approved = said("approve", f"{tmp_path}/{name}", "--profile", profile.replace("20", "15") if name == "b" else profile, "--date", "2024-05-06", "--out", f"{tmp_path}/fp-{name}")
        assert code == 0 and approved["approvedOn"] == "2024-05-06" and approved["fingerprintCount"] == (20 if name == "a" else 15)
        (tmp_path / f"{name}.json").write_text(json.dumps(approved))
    assert said("verify", f"{tmp_path}/a", "--profile", profile, "--approval", f"{tmp_path}/a.json") == (0, {"successful": True, "problems": []})
    assert said("verify", f"{tmp_path}/a", "--profile", profile, "--approval", f"{tmp_path}/b.json")[0] == 1
    assert said("verify", f"{tmp_path}/a", "--profile", profile, "--approval", f"{tmp_path}/none.json") == (1, {"successful": False, "problems": ["there is no approval"]})
    assert said("disjoint", f"a={tmp_path}/fp-a", f"b={tmp_path}/fp-b") == (1, {"successful": False, "shared": [{"split_a": "a", "split_b": "b", "shared": 5}]})
    with pytest.raises(SystemExit):
        profiles.main(["disjoint", "a"])


def test_a_key_of_half_of_all_rows_is_cut_into_ranges_of_a_set_size(spark):
    df = spark.range(0, 40000, 1, 4).select((F.col("id") * 7919 % 40009).alias("o"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    edges = digests.grown_edges(df, F.col("o"), 100)
    assert 300 < len(edges) < 400 and len(digests.grown_edges(df, F.col("o"), 10**9)) == 63
    sizes = df.groupBy("k", digests.ranges(F.col("o"), edges).alias("r")).count()
    assert sizes.agg(F.max("count")).first()[0] < 200
    few = edges[::4]
    both = df.select(digests.ranges(F.col("o"), edges).alias("a"), "o").collect()
    assert all(r["a"] == sum(e <= r["o"] for e in edges) for r in both[::97]) and len(few) < digests.STEPS < len(edges)
    got = selection.occurrence(df, "k", "o", range_rows=100).filter("k = 'hot'").orderBy("o").select("occurrence").collect()
    assert [r["occurrence"] for r in got] == list(range(20000))
    assert df.select(digests.ranges(F.lit(None).cast("long"), edges).alias("x")).first()["x"] == -1


def test_a_task_of_the_stream_hands_on_its_least_rows():
    import pyarrow as pa

    from quillspark.streaming.selection import least_of_task

    rows = [(i % 4, f"{i * 7 % 10:02d}", "ü" if i % 2 else "z", f"r{i % 3}") for i in range(60)]
    batches = [pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows[i : i + 7]))), ["part", "rank", "identity", "row"]) for i in range(0, 60, 7)]
    for count in (1, 13, 100):
        got = [tuple(r[1:]) for b in least_of_task(count)(iter(batches)) for r in zip(*(c.to_pylist() for c in b.columns))]
        assert got == sorted(r[1:] for r in rows)[:count]
    assert list(least_of_task(3)(iter([]))) == []
