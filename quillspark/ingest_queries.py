"""Registered queries of files, streams, reports and masks, each with its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from .functions import text
from .operators import integrity, masking, report, tokens
from .plans import evaluation, profiles
from .queries import _CONV, _HASH, _table, conversations, query
from .sources import datasets, files, jsonl
from .storage import shared_path
from .streaming import selection

#: Bound of a line, bytes of a range: small, so that some lines are over it and files have many ranges.
_BOUND, _RANGE = 4096, 1 << 16


@query(rf"""SELECT row_number() OVER (ORDER BY doc_id) AS line_no, CASE WHEN octet_length(encode(line)) > {_BOUND} THEN 'DATASET_LINE_TOO_LARGE' ELSE sha256(line) END AS line
FROM (SELECT doc_id, doc_id || ' ' || replace(coalesce(text, ''), chr(10), ' ') AS line FROM documents)""")
def bounded_lines(spark, sf_dir):
    """All documents as lines of sorted files, read in byte ranges by a reader that holds no line over its bound."""
    path = shared_path(spark, "bounded")
    lines = _table(spark, sf_dir, "documents").repartitionByRange("doc_id").sortWithinPartitions("doc_id").select(F.concat(F.col("doc_id").cast("string"), F.lit(" "), F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(" "))))
    files.write_lines(lines, path)
    got = jsonl.read_bounded(spark, path, _BOUND, _RANGE)
    return got.select("line_no", F.coalesce("code", F.sha2("value", 256)).alias("line"))


@query(rf"""SELECT row_number() OVER (ORDER BY doc_id) AS line_no, 'prompt_completion' AS family, sha256(text) AS answer FROM documents WHERE regexp_replace(coalesce(text, ''), '\s', '', 'g') <> ''""")
def loaded_examples(spark, sf_dir):
    """Documents with a text as a split's file, loaded in growing groups of ranges, each line parsed once."""
    path = shared_path(spark, "loaded")
    docs = _table(spark, sf_dir, "documents").filter(~text.is_blank(F.col("text")))
    lines = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id").select(F.to_json(F.struct(F.lit("p").alias("prompt"), F.col("text").alias("completion"))))
    files.write_lines(lines, path)
    got = jsonl.load(spark, path, max_examples=1 << 40, range_bytes=_RANGE)
    return got.rows.select("line_no", "family", F.sha2(F.element_at("messages", -1)["content"], 256).alias("answer"))


@query(f"SELECT doc_id, identity, sha256('streamed:' || identity) AS rank FROM (SELECT doc_id, doc_id || ':' || {_HASH} AS identity FROM documents) ORDER BY rank, identity LIMIT 50")
def streamed_selection(spark, sf_dir):
    """The 50 documents of least rank, of a stream that takes a third of its files at a time; files are a third of what a task reads."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    came, checkpoint = shared_path(spark, "stream"), shared_path(spark, "stream-state")
    third = max(1, docs.rdd.getNumPartitions())  # grows with the table, as Spark bounds its input splits
    docs.repartition(3 * third).write.parquet(came)
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", third).parquet(came)
    selection.stream_bounded(stream, checkpoint, 50, "streamed", "doc_id", ["lang", "text"]).awaitTermination()
    return selection.selected(spark, checkpoint, 50, docs.schema).select("doc_id", "identity", "rank")


_LINE = """'{"messages": [' || list_aggregate(list_transform(messages, lambda m: '{"content": ' || CAST(to_json(m.content) AS VARCHAR) || ', "role": ' || CAST(to_json(m.role) AS VARCHAR) || '}'), 'string_agg', ', ') || ']}' || chr(10)"""


@query(f"""SELECT CASE conv_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'validation' ELSE 'test' END AS split, count(*) AS examples, CAST(sum(octet_length(encode(line))) AS BIGINT) AS bytes, sha256(string_agg(line, '' ORDER BY conv_id)) AS sha256
FROM (SELECT conv_id, {_LINE} AS line FROM ({_CONV})) GROUP BY 1""")
def canonical_manifest(spark, sf_dir):
    """Canonical files of three splits: rows and bytes as the sink's tasks committed them, digests from the files themselves."""
    root = shared_path(spark, "canonical")
    convs = conversations(spark, sf_dir)
    made = []
    for k, split in enumerate(("train", "validation", "test")):
        mine = convs.filter(F.col("conv_id") % 3 == k).repartitionByRange("conv_id").sortWithinPartitions("conv_id")
        made.append((split, files.write_lines(mine.select(datasets.spaced_json(F.col("messages"))), f"{root}/{split}")))
    said = spark.createDataFrame([(s, m["rows"], m["bytes"]) for s, m in made], "split string, examples long, bytes long")
    found = files.digests(spark, root, "folder").select(F.col("name").alias("split"), F.col("bytes").alias("read"), "sha256")
    return said.join(found, (said["split"] == found["split"]) & (F.col("bytes") == F.col("read"))).select(said["split"], "examples", "bytes", "sha256")


_PATHS = "SELECT regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages"


@query(f"""WITH p AS (SELECT host, path LIKE '%/' AS folder, list_filter(string_split(path, '/'), lambda x: x NOT IN ('', '.')) AS parts FROM ({_PATHS})),
n AS (SELECT host, lower(array_to_string(parts[1:i], '/')) AS name, i = len(parts) AND NOT folder AS file FROM (SELECT host, parts, folder, unnest(range(1, len(parts) + 1)) AS i FROM p)),
c AS (SELECT host, name, count(*) FILTER (file) AS files, count(*) FILTER (NOT file) AS below FROM n GROUP BY host, name)
SELECT host, name, 'duplicate' AS problem, files, below FROM c WHERE files > 1 UNION ALL SELECT host, name, 'file and folder', files, below FROM c WHERE files > 0 AND below > 0
UNION ALL SELECT host, 'any', 'paths', count(*), count(*) FILTER (folder) FROM p GROUP BY host""")
def path_collisions(spark, sf_dir):
    """The pages' paths as files of their hosts: which cannot be laid out as folders, and how many there are."""
    pages = spark.sql(_PATHS.replace("FROM pages", "FROM {pages}").replace("'^", "r'^"), pages=_table(spark, sf_dir, "pages"))
    found = integrity.path_collisions(pages, "path", "host").withColumnRenamed("within", "host")
    totals = pages.groupBy("host").agg(F.count("*").alias("files"), F.count_if(F.col("path").endswith("/")).alias("below"))
    return found.unionByName(totals.select("host", F.lit("any").alias("name"), F.lit("paths").alias("problem"), "files", "below"))


_DOC_SPLIT = "CASE WHEN doc_id % 10 < 8 THEN 'train' WHEN doc_id % 10 = 8 THEN 'validation' ELSE 'test' END"


@query(rf"""WITH r AS MATERIALIZED (SELECT {_DOC_SPLIT} AS split, sha256(text) AS fp, regexp_replace(coalesce(text, ''), '\s', '', 'g') = '' AS blank, len(regexp_extract_all(coalesce(text, ''), '\S+')) AS t FROM documents),
s AS (SELECT split, CASE split WHEN 'train' THEN 0 WHEN 'validation' THEN 1 ELSE 2 END AS k, count(*) AS n, count(fp) - count(DISTINCT fp) AS d, count(*) FILTER (blank) AS invalid, sum(t)::BIGINT AS t, max(t) AS l, count(*) FILTER (t > 512) AS o FROM r GROUP BY split),
x AS (SELECT a.split AS a, b.split AS b, count(DISTINCT a.fp) AS n FROM r a JOIN r b ON a.fp = b.fp AND CASE a.split WHEN 'train' THEN 0 WHEN 'validation' THEN 1 ELSE 2 END < CASE b.split WHEN 'train' THEN 0 WHEN 'validation' THEN 1 ELSE 2 END GROUP BY ALL),
f AS (SELECT 1 AS rule, k, 0 AS j, 'DATASET_TARGET_EMPTY:' || split || '::' || invalid AS f FROM s WHERE invalid > 0
UNION ALL SELECT 2, CASE a WHEN 'train' THEN 0 ELSE 1 END, CASE b WHEN 'validation' THEN 0 ELSE 1 END, 'DATASET_SPLIT_LEAKAGE:' || a || ':' || b || ':' || n FROM x
UNION ALL SELECT 3, k, 0, 'DATASET_SEQUENCE_TOO_LONG:' || split || '::' || o FROM s WHERE o > 0
UNION ALL SELECT 4, 0, 0, 'DATASET_TOKEN_BUDGET_EXCEEDED:train::' || t FROM s WHERE split = 'train' AND t > 20000 UNION ALL SELECT 5, k, 0, 'DUPLICATES:' || split || '::' || d FROM s WHERE d > 0)
SELECT CASE WHEN count(*) FILTER (rule < 5) > 0 THEN 'rejected' ELSE 'accepted' END AS verdict, min_by(split_part(f, ':', 1), rule * 100 + k * 10 + j) FILTER (rule < 5) AS code,
  (SELECT string_agg(split || ':' || n || ':' || d || ':' || invalid || ':' || t || ':' || l || ':' || o, ',' ORDER BY k) FROM s) AS inputs, string_agg(f, ',' ORDER BY rule, k, j) AS findings FROM f""")
def input_report(spark, sf_dir):
    """Documents as answers in three splits: counts, repeats, leaks, lengths and the budget, from one scan."""
    message = lambda role, c: F.struct(F.lit(role).alias("role"), F.coalesce(c, F.lit("")).alias("content"))
    m = F.array(message("user", F.lit("q")), message("assistant", F.col("text")))
    got = report.input_report(_table(spark, sf_dir, "documents"), F.expr(_DOC_SPLIT), m, F.sha2("text", 256), tokens.whitespace_tokens(F.coalesce("text", F.lit(""))), ceiling=512, budget=20000)
    shown = lambda column, *fields: F.array_join(F.transform(column, lambda r: F.concat_ws(":", *(F.coalesce(r[f].cast("string"), F.lit("")) for f in fields))), ",")
    return got.select("verdict", "code", shown("inputs", "split", "records", "duplicates", "invalid", "total_tokens", "longest", "too_long").alias("inputs"), shown("findings", "code", "split", "other", "n").alias("findings"))


_WORD = r"[^\x20\x09-\x0D]+"


@query(rf"""WITH t AS (SELECT *, coalesce(sum(24 + length(role) + length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM conversations),
spans AS MATERIALIZED (SELECT conv_id, before + 13 + length(role) + length(text) - length(ltrim(text, ' ')) AS a, before + 13 + length(role) + length(text) + 10 AS b FROM t WHERE role = 'assistant'),
chats AS (SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn) AS chat FROM conversations GROUP BY conv_id),
pieces AS (SELECT conv_id, unnest(regexp_extract_all(chat, '{_WORD}')) AS w, unnest(regexp_split_to_array(chat, '{_WORD}')[1:-2]) AS gap, unnest(range(len(regexp_extract_all(chat, '{_WORD}')))) AS i FROM chats),
words AS MATERIALIZED (SELECT conv_id, (sum(length(w) + length(gap)) OVER (PARTITION BY conv_id ORDER BY i))::BIGINT AS stop, length(w) AS n FROM pieces),
live AS (SELECT w.conv_id, count(*) AS n_tokens, count(*) FILTER (EXISTS (SELECT 1 FROM spans s WHERE s.conv_id = w.conv_id AND s.a <= w.stop - w.n AND w.stop <= s.b)) AS supervised FROM words w GROUP BY w.conv_id)
SELECT conv_id, CAST(n_tokens AS INTEGER) AS n_tokens, CASE WHEN n_tokens > 300 THEN 'DATASET_SEQUENCE_TOO_LONG' WHEN supervised = 0 THEN 'DATASET_TARGET_EMPTY' ELSE 'ok' END AS code, CASE WHEN n_tokens > 300 OR supervised = 0 THEN 0 ELSE supervised END AS supervised FROM live""")
def masked_examples(spark, sf_dir):
    """Conversations as masked examples with words as tokens, at most 300 of them."""
    convs = conversations(spark, sf_dir)
    got = masking.masked_examples(convs, F.col("messages"), text.chat_text(F.col("messages")), "<|im_end|>", masking.by_blanks, 300, ["conv_id"])
    live = F.coalesce(F.size(F.filter("labels", lambda x: x != -100)), F.lit(0)).cast("long")
    return got.select("conv_id", "n_tokens", F.coalesce("code", F.lit("ok")).alias("code"), F.when(F.col("labels").isNull(), F.lit(0).cast("long")).otherwise(live).alias("supervised"))


@query()
def masked_public(spark, sf_dir):
    """Conversations as masked examples of a public tokenizer: digests of ids and labels. Not SQL; tested against a plain loop."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    convs = conversations(spark, sf_dir)
    got = masking.masked_examples(convs, F.col("messages"), text.chat_text(F.col("messages")), "<|im_end|>", masking.from_file(path), 2048, ["conv_id"])
    shown = lambda c: F.md5(F.array_join(c, ","))
    return got.select("conv_id", "n_tokens", F.coalesce("code", F.lit("ok")).alias("code"), shown("input_ids").alias("ids"), shown("labels").alias("labels"))


_SNAPSHOT = r"""SELECT p_partkey AS k, CASE p_partkey % 9 WHEN 1 THEN '../' || p_partkey WHEN 2 THEN 'a' || chr(92) || p_partkey WHEN 4 THEN 'd//' || p_partkey ELSE 'w/' || p_partkey || '.safetensors' END AS path, p_size AS size, p_name AS name FROM part"""


@query(f"""WITH b AS MATERIALIZED (SELECT *, k % 13 <> 0 AS listed, k % 8 <> 0 AS there, k % 9 IN (1, 2, 4) AS unsafe, k % 11 = 0 AS link FROM ({_SNAPSHOT})),
r AS (SELECT * FROM b WHERE listed AND there AND NOT unsafe AND NOT link)
SELECT path, problem, count(*) AS n FROM (
SELECT path, 'repeated' AS problem FROM b WHERE listed AND k % 10 = 3
UNION ALL SELECT path, CASE WHEN unsafe THEN 'unsafe path' WHEN there THEN 'symlink' ELSE 'missing' END FROM b WHERE listed AND (unsafe OR NOT there OR link)
UNION ALL SELECT path, 'size' FROM r WHERE k % 7 = 0 UNION ALL SELECT path, 'sha256' FROM r WHERE k % 5 = 0
UNION ALL SELECT path, 'unlisted' FROM b WHERE there AND NOT (listed AND NOT unsafe AND NOT link)
UNION ALL SELECT '(whole)', 'total' FROM (SELECT coalesce(sum(CASE WHEN k % 10 = 3 THEN 2 ELSE 1 END * (size + CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END)), 0) AS t FROM r) WHERE t <> (SELECT sum(size) FROM b WHERE listed)
UNION ALL SELECT '(whole)', 'no needed file' WHERE NOT EXISTS (SELECT 1 FROM r WHERE path LIKE '%.safetensors')) GROUP BY ALL""")
def snapshot_check(spark, sf_dir):
    """Parts as files of a snapshot: some listed twice, under names that aren't safe, changed, gone, linked or unlisted."""
    parts = spark.sql(_SNAPSHOT.replace("FROM part", "FROM {part}"), part=_table(spark, sf_dir, "part"))
    k, digest = F.col("k"), F.sha2("name", 256)
    listed = parts.filter(k % 13 != 0)
    listed = listed.unionByName(listed.filter(k % 10 == 3))
    disk = parts.filter(k % 8 != 0).select("path", (F.col("size") + F.when(k % 7 == 0, 1).otherwise(0)).alias("size"), F.when(k % 5 == 0, F.sha2("path", 256)).otherwise(digest).alias("sha256"), (k % 11 == 0).alias("link"))
    total = parts.filter(k % 13 != 0).agg(F.sum("size")).first()[0]
    found = integrity.snapshot_problems(listed.select("path", "size", digest.alias("sha256")), disk, total, ".safetensors")
    return found.groupBy(F.coalesce("path", F.lit("(whole)")).alias("path"), "problem").agg(F.count("*").alias("n"))


_J = "CAST(to_json({}) AS VARCHAR)".format


@query(rf"""SELECT row_number() OVER (ORDER BY doc_id) AS line_no, sha256('{{"id": "' || doc_id || '", "label": ' || {_J("lang")} || ', "metadata": {{"category": "", "language": ' || {_J("lang")} || ', "topic": ' || {_J("source")} || '}}, "prompts": [{{"mcq": '
|| {_J("text")} || ', "mcq_options": "A", "question": ' || {_J("source")} || '}}]}}') AS line FROM documents WHERE regexp_replace(coalesce(text, ''), '\s', '', 'g') <> ''""")
def evaluation_corpus(spark, sf_dir):
    """Documents with text as an evaluation corpus, built and written by the job, and its file's lines as read back."""
    one = F.struct(F.col("text").alias("mcq"), F.lit("A").alias("mcq_options"), F.col("source").alias("question"))
    about = F.struct(F.lit("").alias("category"), F.col("lang").alias("language"), F.col("source").alias("topic"))
    docs = _table(spark, sf_dir, "documents").filter(~text.is_blank(F.col("text"))).select("doc_id", F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("label"), about.alias("metadata"), F.array(one).alias("prompts"))
    sources = spark.createDataFrame([("held", True, ["evaluation_only"], "a" * 40)], "source_id string, enabled boolean, intended_use array<string>, revision string")
    path = shared_path(spark, "corpus")
    evaluation.build(docs, sources, profiles.Profile("held", "full", "evaluation", ("id", "label", "prompts", "metadata"), "a" * 40, strategy="all"), path, "doc_id")
    got = jsonl.read_bounded(spark, f"{path}/{evaluation.SPLIT}", 1 << 30)
    return got.select("line_no", F.sha2("value", 256).alias("line"))
