"""More registered queries: rules on chats, evaluation rows, listings, models and measurements, each with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .functions import arithmetic, text
from .operators import integrity, measurements, policy, registration, tokens
from .plans import profiles
from .queries import _CONV, _table, conversations, query
from .sources import adapters, datasets, jsonl
from .storage import shared_dir

_CHAT = r"string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn)"


@query(f"""SELECT conv_id, md5(chat || '<|im_start|>assistant' || chr(10)) AS chat, CAST(len(regexp_extract_all(chat, '\\S+')) AS INTEGER) AS n_tokens, md5(CASE WHEN first = 'system' AND second = 'user' THEN folded ELSE chat END) AS folded FROM (
SELECT conv_id, {_CHAT} AS chat, min(CASE WHEN k = 1 THEN role END) AS first, min(CASE WHEN k = 2 THEN role END) AS second,
  string_agg(CASE WHEN k = 1 THEN '<|im_start|>user' || chr(10) || text || chr(10) || chr(10) WHEN k = 2 THEN text || '<|im_end|>' || chr(10) ELSE '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) END, '' ORDER BY turn) AS folded
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations) GROUP BY conv_id)""")
def chat_rendered(spark, sf_dir):
    """Conversations in the default template, with and without a system role in it, and its tokens."""
    m = F.col("messages")
    chat = text.chat_text(m)
    return conversations(spark, sf_dir).select("conv_id", F.md5(text.chat_text(m, ask=True)).alias("chat"), tokens.whitespace_tokens(chat).alias("n_tokens"), F.md5(text.chat_text(m, has_system=False)).alias("folded"))


@query("""SELECT conv_id, CAST(count(*) FILTER (WHERE own) AS INTEGER) AS n_spans, coalesce(string_agg(start || '-' || stop, ',' ORDER BY turn) FILTER (WHERE own), '') AS spans FROM (
SELECT conv_id, turn, role = 'assistant' AS own, before + 13 + length(role) + length(text) - length(ltrim(text, ' ')) AS start, before + 13 + length(role) + length(text) + 10 AS stop
FROM (SELECT *, coalesce(sum(24 + length(role) + length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM conversations)) GROUP BY conv_id""")
def chat_spans(spark, sf_dir):
    """Where the assistant's turns stand in the rendered chat."""
    spans = arithmetic.assistant_spans(F.col("messages"), text.chat_text(F.col("messages")), "<|im_end|>")
    shown = F.array_join(F.transform(spans, lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), ",")
    return conversations(spark, sf_dir).select("conv_id", F.size(spans).alias("n_spans"), shown.alias("spans"))


@query("""WITH w AS (SELECT doc_id, string_split(text, ' ') AS words FROM documents), p AS (SELECT doc_id, words, unnest(range(len(words))) AS i FROM w),
o AS (SELECT *, i BETWEEN 5 AND 39 AND i % 7 > 0 AS live, i BETWEEN 6 AND 40 AND (i - 1) % 7 > 0 AS before FROM p)
SELECT doc_id, md5(string_agg(CASE WHEN live AND NOT before THEN '⟦' WHEN before AND NOT live THEN '⟧' ELSE '' END || words[i + 1], '' ORDER BY i) || CASE WHEN bool_or(live AND i = len(words) - 1) THEN '⟧' ELSE '' END) AS shown FROM o GROUP BY doc_id""")
def supervision_marks(spark, sf_dir):
    """Words as tokens, those of the places that supervised_counts supervises between marks."""
    pieces = F.split("text", " ", -1)
    labels = F.transform(pieces, lambda w, i: F.when((i >= 5) & (i < 40) & (i % 7 > 0), i).otherwise(arithmetic.IGNORED))
    return _table(spark, sf_dir, "documents").select("doc_id", F.md5(arithmetic.marked(pieces, labels)).alias("shown"))


_QUESTION = "CASE doc_id % 5 WHEN 0 THEN '  ' ELSE source END"


@query(f"""SELECT doc_id, doc_id % 5 <> 0 AND doc_id % 7 <> 0 AND doc_id % 11 <> 0 AS valid,
left(sha256(CAST(to_json({{'id': CAST(doc_id AS VARCHAR), 'label': lang, 'metadata': {{'category': '', 'language': CASE WHEN doc_id % 7 <> 0 THEN lang ELSE '' END, 'topic': source}},
'prompts': CASE WHEN doc_id % 11 <> 0 THEN [{{'mcq': text, 'mcq_options': 'A', 'question': {_QUESTION}}}] ELSE [] END}}) AS VARCHAR)), 16) AS fp FROM documents WHERE text <> ''""")
def evaluation_build(spark, sf_dir):
    """Documents as evaluation rows: which the adapter takes, and their short fingerprints."""
    i = F.col("doc_id")
    one = F.struct(F.col("text").alias("mcq"), F.lit("A").alias("mcq_options"), F.expr(_QUESTION).alias("question"))
    prompts = F.when(i % 11 != 0, F.array(one)).otherwise(F.array().cast("array<struct<mcq:string,mcq_options:string,question:string>>"))
    about = F.struct(F.lit("").alias("category"), F.when(i % 7 != 0, F.col("lang")).otherwise("").alias("language"), F.col("source").alias("topic"))
    rows = _table(spark, sf_dir, "documents").filter("text <> ''").select("doc_id", i.cast("string").alias("id"), F.col("lang").alias("label"), about.alias("metadata"), prompts.alias("prompts"))
    return adapters.adapt("evaluation", rows).select("doc_id", "valid", text.short_record_fingerprint(F.struct("id", "label", "metadata", "prompts")).alias("fp"))


@query(r"""SELECT doc_id, doc_id % 6 <> 0 AND regexp_replace(text, '\s', '', 'g') <> '' AS valid, md5(CASE WHEN doc_id % 6 = 0 THEN ' ' ELSE source END || text) AS pair FROM documents""")
def adapted_targets(spark, sf_dir):
    rows = _table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 6 == 0, " ").otherwise(F.col("source")).alias("inputs"), F.col("text").alias("targets"))
    return adapters.adapt("input_target", rows).select("doc_id", "valid", F.md5(F.array_join(F.transform("messages", lambda m: m["content"]), "")).alias("pair"))


@query("""SELECT row_number() OVER (ORDER BY conv_id) AS line_no, sha256('{"messages": [' || string_agg('{"content": ' || CAST(to_json(m.content) AS VARCHAR) || ', "role": "' || m.role || '"}', ', ' ORDER BY i) || ']}') AS line
FROM (SELECT conv_id, unnest(messages) AS m, unnest(range(len(messages))) AS i FROM (""" + _CONV + """)) GROUP BY conv_id""")
def canonical_file(spark, sf_dir):
    """The canonical JSONL file of all conversations, written as sorted parts and read again with its line numbers."""
    path = f"{shared_dir(spark)}/canonical-{uuid.uuid4().hex}"
    datasets.write_canonical(conversations(spark, sf_dir), path, "conv_id")
    return jsonl.read_lines(spark, {"train": path}, joined_parts=True).select("line_no", F.sha2(F.col("value").cast("binary"), 256).alias("line"))


@query("""SELECT lang AS split, count(*) AS examples, max(doc_id) AS last FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS k FROM documents WHERE doc_id % 9 <> 0) WHERE k <= 25 GROUP BY lang""")
def capped_load(spark, sf_dir):
    """Examples of each split before the 26th, as a cap of 25 takes them; every ninth line isn't JSON and has no place among them."""
    lines = _table(spark, sf_dir, "documents").select(F.col("lang").alias("split"), F.col("doc_id").alias("line_no"), F.when(F.col("doc_id") % 9 == 0, "{").otherwise('{"prompt": "a", "completion": "b"}').alias("value"))
    got = jsonl.normalize(lines, max_examples=25)
    over = got.filter("code = 'DATASET_TOO_MANY_EXAMPLES'").select("split", F.col("line_no").alias("cut"))
    kept = got.join(F.broadcast(over), "split", "left").filter("code is null and (cut is null or line_no < cut)")  # over is one row a split
    return kept.groupBy("split").agg(F.count("*").alias("examples"), F.max("line_no").alias("last"))


_SIZE = "o_orderkey * o_orderkey * o_orderkey * 977"
_UNITS = " ".join(f"WHEN n < {1024 ** (i + 1)} THEN printf('%.2f {u}', n / {1024**i}.0::DOUBLE)" for i, u in enumerate(("B", "KiB", "MiB", "GiB", "TiB")))


@query(f"""SELECT o_orderkey, CASE {_UNITS} ELSE printf('%.2f PiB', n / {1024**5}.0::DOUBLE) END AS size, (o_orderkey % 4) * (o_orderkey % 8) >= 6 OR o_orderkey % 3 = 0 AS applies,
CASE WHEN o_orderkey % 2 = 0 THEN 'lora' ELSE 'qlora' END AS method, o_orderkey % 3 < 2 AND o_orderkey % 5 > 0 AS committable,
CASE WHEN o_orderkey % 6 IN (0, 1, 3) THEN 'm1' WHEN o_orderkey % 6 = 5 THEN NULL ELSE 'CONFIG_SCHEMA_INVALID' END AS selected,
CASE WHEN o_orderkey % 4 = 0 THEN 'Base model m' || o_custkey || ', license llama3.2: preserve llama attribution, include applicable license notice.' ELSE '' END AS notice FROM (SELECT *, {_SIZE} AS n FROM orders)""")
def model_rules(spark, sf_dir):
    """Bytes as text, measured loads, default methods, rows that may be committed, selectors, and license notices."""
    k = F.col("o_orderkey")
    channels = [F.when(k % 6 == 0, "m1").when(k % 6 == 4, "m3").otherwise(""), F.when(k % 6 < 3, " m1 "), F.when((k % 6 > 1) & (k % 6 < 5), F.when(k % 6 == 3, "m1").otherwise("m2"))]
    yes = F.when(k % 3 == 0, "yes").when(k % 3 == 1, "share_alike").otherwise("no")
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey", arithmetic.bytes_text(F.expr(_SIZE.replace("o_orderkey", "CAST(o_orderkey AS DECIMAL(38, 0))", 1))).alias("size"), policy.measured_load_applies(k % 4, k % 8, F.when(k % 3 > 0, 6)).alias("applies"),
        policy.default_method(F.when(k % 2 == 0, F.array(F.lit("qlora"), F.lit("lora"))).otherwise(F.array(F.lit("qlora")))).alias("method"), policy.may_commit_rows(yes, k % 5 == 0).alias("committable"),
        F.coalesce(policy.agreement_code(channels), policy.agreed(channels)).alias("selected"), policy.license_notice(F.when(k % 4 == 0, " Llama3.2").otherwise("mit"), F.concat(F.lit("m"), "o_custkey")).alias("notice"),
    )


_LAYOUTS = {
    "pairs": "SELECT 'images/' || doc_id || '.jpg' AS path FROM documents UNION ALL SELECT 'masks/' || doc_id || '.png' FROM documents WHERE doc_id % 2 = 0",
    "notes": "SELECT 'img/' || doc_id || '.JPG' AS path FROM documents UNION ALL SELECT 'labels/' || doc_id || '.txt' FROM documents UNION ALL SELECT '__MACOSX/img/' || doc_id || '.jpg' FROM documents",
    "classes": "SELECT source || '/' || doc_id || '.webp' AS path FROM documents",
    "lines": "SELECT source || '/' || doc_id || '.webp' AS path FROM documents UNION ALL SELECT 'train.jsonl'",
    "few": "SELECT 'images/' || doc_id || '.jpg' AS path FROM documents WHERE doc_id < 2 UNION ALL SELECT 'a/b.txt'",
}
#: The rules of a layout over all listings at once, the task worked out from each one's files.
_LAYOUT_SQL = rf"""WITH f AS ({" UNION ALL ".join(f"SELECT '{k}' AS listing, path FROM ({v})" for k, v in _LAYOUTS.items())}),
p AS MATERIALIZED (SELECT listing, path, CASE WHEN contains(path, '/') THEN split_part(path, '/', 1) END AS dir, lower(regexp_extract(path, '\.([^./]+)$', 1)) AS suffix, regexp_extract(path, '([^/]*?)(\.[^./]*)?$', 1) AS stem FROM f WHERE NOT list_has_any(string_split(path, '/'), {integrity.IGNORED_DIRS})),
k AS MATERIALIZED (SELECT *, list_contains({integrity.IMAGE_SUFFIXES}, suffix) AS image, list_contains({integrity.ANNOTATION_SUFFIXES}, suffix) AS note FROM p),
d AS MATERIALIZED (SELECT listing, dir, count(*) FILTER (image) AS images, count(*) FILTER (note) AS notes FROM k WHERE dir IS NOT NULL GROUP BY ALL),
s AS MATERIALIZED (SELECT listing, min(dir) FILTER (images > 0 AND list_contains({integrity.IMAGE_DIRS}, lower(dir))) AS image_dir, min(dir) FILTER (images > 0 AND list_contains({integrity.MASK_DIRS}, lower(dir))) AS mask_dir,
  min_by(notes >= images, dir) FILTER (notes > 0 AND list_contains({integrity.ANNOTATION_DIRS}, lower(dir))) AS noted, count(*) FILTER (images > 0 AND notes = 0) AS classes FROM d GROUP BY listing),
w AS (SELECT listing, count(*) FILTER (image) AS images, count(*) FILTER (suffix = 'jsonl') AS lines, count(*) FILTER (dir IS NULL AND NOT image AND NOT list_contains({integrity.TOP_FILES}, path)) AS top FROM k GROUP BY listing),
m AS (SELECT a.listing, count(DISTINCT a.stem) AS paired FROM k a JOIN s ON s.listing = a.listing AND a.dir = s.image_dir JOIN k b ON b.listing = a.listing AND b.dir = s.mask_dir AND b.stem = a.stem WHERE a.image AND b.image GROUP BY a.listing)
SELECT listing, (SELECT count(*) FROM f WHERE f.listing = s.listing) AS files, CASE WHEN lines > 0 THEN 'none' WHEN coalesce(paired, 0) >= {integrity.LEAST_IMAGES} THEN 'image segmentation'
WHEN image_dir IS NOT NULL AND noted AND images >= {integrity.LEAST_IMAGES} THEN 'object detection' WHEN images >= {integrity.LEAST_IMAGES} AND classes >= {integrity.LEAST_CLASSES} AND top = 0 THEN 'image classification' ELSE 'none' END AS task
FROM s JOIN w USING (listing) LEFT JOIN m USING (listing)"""


@query(_LAYOUT_SQL)
def layout_tasks(spark, sf_dir):
    """Listings made from the documents' ids, and the task that each has the layout of."""
    out = None
    for name, sql in _LAYOUTS.items():
        files = spark.sql(sql.replace("FROM documents", "FROM {documents}"), documents=_table(spark, sf_dir, "documents"))
        one = files.agg(F.count("*").alias("files")).crossJoin(integrity.foreign_task(files)).select(F.lit(name).alias("listing"), "files", F.coalesce("task", F.lit("none")).alias("task"))  # one row each
        out = one if out is None else out.unionByName(one)
    return out


_SPLITS = {
    "fine": "SELECT 'train.jsonl' AS path, sum(n_chars) AS size FROM documents UNION ALL SELECT 'val.jsonl', max(n_chars) FROM documents",
    "stray": "SELECT 'train.jsonl' AS path, sum(n_chars) AS size FROM documents UNION ALL SELECT source || '/test.jsonl', sum(n_chars) FROM documents GROUP BY source",
    "two": "SELECT 'train.jsonl' AS path, sum(n_chars) AS size FROM documents UNION ALL SELECT 'val.jsonl', 1 UNION ALL SELECT 'validation.jsonl', 1",
    "missing": "SELECT 'test.jsonl' AS path, sum(n_chars) AS size FROM documents UNION ALL SELECT '__MACOSX/train.jsonl', 5",
    "big": "SELECT 'train.jsonl' AS path, 536870912 + count(*) AS size FROM documents",
    "total": "SELECT 'train.jsonl' AS path, 536870912 AS size FROM documents WHERE n_chars >= 0 GROUP BY 2 UNION ALL SELECT 'test.jsonl', 536870912 UNION ALL SELECT 'validation.jsonl', max(n_chars) FROM documents",
}
_SPLIT_NAMES = ", ".join(f"('{f}', '{split}')" for split, fs in datasets.SPLIT_FILES.items() for f in fs)


@query(rf"""WITH f AS MATERIALIZED ({" UNION ALL ".join(f"SELECT '{k}' AS listing, path, size FROM ({v})" for k, v in _SPLITS.items())}), names(file, split) AS (VALUES {_SPLIT_NAMES}),
s AS MATERIALIZED (SELECT listing, split, contains(path, '/') AS deep, size FROM f JOIN names ON regexp_extract(path, '[^/]*$') = file WHERE NOT list_has_any(string_split(path, '/'), {list(datasets.IGNORED)})),
b AS (SELECT listing, split, bool_or(deep) AS stray, count(*) FILTER (NOT deep) AS n, sum(size) FILTER (NOT deep) AS bytes FROM s GROUP BY ALL),
r AS (SELECT listing, 1 AS rule, min(split) AS split, 'DATASET_SPLIT_AMBIGUOUS' AS code FROM b WHERE stray GROUP BY listing UNION ALL SELECT listing, 2, min(split), 'DATASET_SPLIT_AMBIGUOUS' FROM b WHERE n > 1 GROUP BY listing
UNION ALL SELECT DISTINCT listing, 3, 'train', 'DATASET_SPLIT_MISSING' FROM f WHERE listing NOT IN (SELECT listing FROM b WHERE split = 'train' AND n > 0)
UNION ALL SELECT listing, 4, min(split), 'DATASET_SPLIT_TOO_LARGE' FROM b WHERE bytes > {datasets.MAX_SPLIT_BYTES} GROUP BY listing UNION ALL SELECT listing, 5, '', 'DATASET_SPLIT_TOO_LARGE' FROM b GROUP BY listing HAVING sum(bytes) > {datasets.MAX_DATASET_BYTES}),
o AS (SELECT listing, min_by(code, rule) AS code, min_by(split, rule) AS split FROM r GROUP BY listing)
SELECT listing, CAST(sum(size) AS BIGINT) AS bytes, coalesce(any_value(code), 'ok') AS code, coalesce(any_value(o.split), '') AS split FROM f LEFT JOIN o USING (listing) GROUP BY listing""")
def split_listings(spark, sf_dir):
    """Listings of split files sized by the documents, and the first rule that each breaks."""
    out = None
    for name, sql in _SPLITS.items():
        files = spark.sql(sql.replace("FROM documents", "FROM {documents}"), documents=_table(spark, sf_dir, "documents"))
        one = files.agg(F.sum("size").cast("long").alias("bytes")).crossJoin(datasets.split_code(files)).select(F.lit(name).alias("listing"), "bytes", F.coalesce("code", F.lit("ok")).alias("code"), F.coalesce("split", F.lit("")).alias("split"))  # one row each
        out = one if out is None else out.unionByName(one)
    return out


@query("""SELECT 'pip-audit' AS source, 'p' || o_custkey AS package, count(*) AS findings, CAST(sum(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fixed FROM orders WHERE o_orderkey % 3 > 0 GROUP BY ALL
UNION ALL SELECT 'trivy', 'q' || o_custkey, count(*), CAST(sum(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) FROM orders WHERE o_orderkey % 5 > 0 GROUP BY ALL""")
def scanner_findings(spark, sf_dir):
    """Each order as a report of either scanner; a third and a fifth of the reports are without findings."""
    fields = lambda sql: F.expr(sql)
    orders = _table(spark, sf_dir, "orders")
    fix = "CASE WHEN o_orderkey % 2 = 0 THEN '9.1' END"
    audit = orders.select(fields(f"to_json(named_struct('dependencies', array(named_struct('name', 'p' || o_custkey, 'version', '1', 'vulns', CASE WHEN o_orderkey % 3 > 0 THEN array(named_struct('id', 'V' || o_orderkey, 'aliases', array('A'), 'fix_versions', array_compact(array({fix})))) ELSE array() END))))").alias("report"))
    image = orders.select(fields(f"to_json(named_struct('SchemaVersion', 2, 'Results', CASE WHEN o_orderkey % 5 > 0 THEN array(named_struct('Vulnerabilities', array(named_struct('VulnerabilityID', 'V' || o_orderkey, 'PkgName', 'q' || o_custkey, 'InstalledVersion', '1', 'Severity', 'HIGH', 'FixedVersion', {fix})))) END))").alias("report"))
    found = adapters.dependency_findings(audit).unionByName(adapters.image_findings(image))
    return found.groupBy("source", "package").agg(F.count("*").alias("findings"), F.sum(F.when(F.col("fix") != "", 1).otherwise(0)).alias("fixed"))


@query("""WITH f AS (SELECT DISTINCT lang, left(sha256(text), 16) AS fp FROM documents)
SELECT a.lang AS split_a, b.lang AS split_b, count(*) AS shared FROM f a JOIN f b ON a.fp = b.fp AND a.lang < b.lang GROUP BY ALL
UNION ALL SELECT min(lang), 'zz', count(DISTINCT fp) FROM f WHERE lang = (SELECT min(lang) FROM f)""")
def disjoint_profiles(spark, sf_dir):
    """A profile for each language, and one more that repeats the first language's rows."""
    docs = _table(spark, sf_dir, "documents").select("lang", F.sha2("text", 256).alias("fingerprint"))
    langs = sorted(r["lang"] for r in docs.select("lang").distinct().collect())  # a handful of languages
    named = {lang: docs.filter(F.col("lang") == lang) for lang in langs}
    return profiles.disjoint(named | {"zz": named[langs[0]]}).filter(F.col("split_b").isin(langs) | (F.col("split_a") == langs[0]))


@query("""SELECT lang, round(regr_slope(y, x), 4) AS per_byte, round(regr_intercept(y, x), 2) AS fixed, round((536870912 * regr_slope(y, x) + 500000 * regr_intercept(y, x)) / 1048576, 2) AS worst_mib
FROM (SELECT lang, source, sum(strlen(text)) / count(*) AS x, sum(2 * n_chars + doc_id % 97 + 770) / count(*) AS y FROM documents GROUP BY ALL) GROUP BY lang""")
def shape_models(spark, sf_dir):
    """Memory an example over bytes an example, each source of a language being a data shape."""
    points = _table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.sum(F.octet_length("text")).alias("file_bytes"), F.count("*").alias("examples"), F.sum(F.col("n_chars") * 2 + F.col("doc_id") % 97 + 770).alias("ingest_bytes"))
    worst = measurements.worst_case(F.col("per_byte"), F.col("fixed"), 512 << 20, 500_000)
    return measurements.shape_fit(points, "lang").select("lang", F.round("per_byte", 4).alias("per_byte"), F.round("fixed", 2).alias("fixed"), F.round(worst / (1 << 20), 2).alias("worst_mib"))


_RUNS = "SELECT o_orderkey, o_custkey AS model_key, CASE WHEN o_orderkey % 4 = 0 THEN 'failed' ELSE 'ok' END AS status, CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice END AS required FROM orders"


@query(f"""SELECT model_key, max(CASE WHEN status = 'ok' THEN required END) AS required, bool_and(required IS NOT NULL) AS measured FROM ({_RUNS}) GROUP BY model_key""")
def measured_memory(spark, sf_dir):
    """Orders as measurements of their customers' models."""
    runs = spark.sql(_RUNS.replace("FROM orders", "FROM {orders}"), orders=_table(spark, sf_dir, "orders"))
    return measurements.measured_models(runs.withColumn("method", F.col("o_orderkey").cast("string"))).join(measurements.required_memory(runs), "model_key", "left").select("model_key", "required", "measured")


_METRICS = """SELECT o_orderkey, o_totalprice AS "trainLoss", CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice / 2 END AS "validationLoss", CAST(NULL AS DOUBLE) AS "testLoss",
CASE WHEN o_orderkey % 2 = 0 THEN 7.5 END AS "validationPerplexity", CASE WHEN o_orderkey % 5 = 0 THEN 2.5 END AS "baseValidationLoss", CAST(NULL AS DOUBLE) AS "baseValidationPerplexity" FROM orders"""


@query(f"""WITH m AS ({_METRICS}), v AS (SELECT *, CASE WHEN "validationLoss" IS NULL THEN 'not-measurable' ELSE 'sample-sanity' END AS verdict FROM m),
e AS (SELECT o_orderkey, 'metric' AS kind, 'trainLoss' AS id, CAST("trainLoss" AS DOUBLE) AS value, verdict FROM v WHERE "validationLoss" IS NOT NULL
UNION ALL SELECT o_orderkey, 'metric', 'validationLoss', "validationLoss", verdict FROM v WHERE "validationLoss" IS NOT NULL
UNION ALL SELECT o_orderkey, 'metric', 'validationPerplexity', "validationPerplexity", verdict FROM v WHERE "validationLoss" IS NOT NULL AND "validationPerplexity" IS NOT NULL
UNION ALL SELECT o_orderkey, 'baseline', 'baseValidationLoss', "baseValidationLoss", verdict FROM v WHERE "baseValidationLoss" IS NOT NULL)
SELECT kind, id, CASE WHEN id LIKE '%Loss' THEN 'nats per supervised token' WHEN id IS NOT NULL THEN 'tokens' END AS units, verdict, count(*) AS n, round(sum(value), 2) AS total
FROM (SELECT * FROM e UNION ALL SELECT o_orderkey, NULL, NULL, NULL, verdict FROM v WHERE o_orderkey NOT IN (SELECT o_orderkey FROM e)) GROUP BY ALL""")
def evaluation_reports(spark, sf_dir):
    """Metrics of a run for each order, unpivoted."""
    runs = spark.sql(_METRICS.replace('"', "`").replace("FROM orders", "FROM {orders}"), orders=_table(spark, sf_dir, "orders"))
    return measurements.report(runs, "o_orderkey").groupBy("kind", "id", "units", "verdict").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


_BLOCK = """SELECT CASE WHEN o_orderkey % 50 = 0 THEN ' ' ELSE 'c' || o_custkey END AS id, CASE WHEN o_orderkey % 40 = 0 THEN '' ELSE 'w' || o_orderkey % 1000 END AS base_weights, 'f' AS framework,
CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'p' END AS provider, 'd' AS data_format, CASE WHEN o_orderkey % 7 > 0 THEN 1 END AS defaults FROM orders"""


@query(f"""WITH b AS (SELECT *, trim(id) AS i FROM ({_BLOCK})), s AS (SELECT * FROM b WHERE i <> ''), k AS (SELECT 'c' || c_custkey AS i FROM customer WHERE c_custkey % 2 = 0),
p AS (SELECT i AS id, 'no base_weights' AS problem FROM s WHERE base_weights = '' UNION ALL SELECT i, 'no provider' FROM s WHERE provider = '' UNION ALL SELECT i, 'no defaults' FROM s WHERE defaults IS NULL
UNION ALL SELECT i, 'id twice' FROM s GROUP BY i HAVING count(*) > 1 UNION ALL SELECT i, 'base_weights twice' FROM s WHERE base_weights <> '' AND base_weights IN (SELECT base_weights FROM s GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT i, 'not approved' FROM s WHERE i NOT IN (SELECT i FROM k) UNION ALL SELECT i, 'not registered' FROM k WHERE i NOT IN (SELECT i FROM s) UNION ALL SELECT 'm0', 'default not registered' UNION ALL SELECT '', 'no id' FROM b WHERE i = '')
SELECT DISTINCT id, problem FROM p""")
def registration_checks(spark, sf_dir):
    """Orders as a registration block, every second customer as an approved key."""
    block = spark.sql(_BLOCK.replace("FROM orders", "FROM {orders}"), orders=_table(spark, sf_dir, "orders"))
    approved = _table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(F.concat(F.lit("c"), "c_custkey").alias("model_key"))
    return registration.registration_problems(block, approved, "m0")


@query("""SELECT 'c' || c_custkey AS id, 'n' || c_nationkey AS display_name, 'org/n' || c_nationkey || '@r' || c_custkey AS base_weights, CASE WHEN c_custkey % 4 = 1 THEN 'lora' ELSE 'qlora' END AS method,
least(2048, CASE WHEN c_custkey % 3 = 0 THEN 2048 ELSE c_custkey * 8 END) AS longest, CASE WHEN c_custkey % 4 = 1 THEN 8.0 WHEN c_custkey % 2 = 0 THEN 5.0 END AS memory FROM customer WHERE c_custkey % 5 > 0 AND c_custkey % 7 > 0""")
def registration_rows(spark, sf_dir):
    """Customers as models: lora measured in every fourth, qlora in every second."""
    k = F.col("c_custkey")
    method = lambda name, gb: F.struct(F.lit(name).alias("method"), gb.alias("required"))
    models = _table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), k).alias("model_key"), F.concat(F.lit("org/n"), "c_nationkey").alias("model_id"), F.concat(F.lit("r"), k).alias("revision"), F.lit("p").alias("provider"), F.when(k % 3 > 0, k * 8).alias("max_sequence"),
        (k % 5 > 0).alias("enabled"), (k % 7 == 0).alias("internal"), F.array(method("lora", F.when(k % 4 == 1, 8.0)), method("qlora", F.when(k % 2 == 0, 5.0))).alias("methods"),
    )
    got = registration.registration(models, "t", "f", "d")
    return got.select("id", "display_name", "base_weights", F.col("defaults.method").alias("method"), F.col("defaults.max_sequence_length").alias("longest"), F.col("resources.min_vram_gb").alias("memory"))


@query("""SELECT path, (path GLOB '*.json' OR name GLOB '*.safetensors' OR name GLOB 'vocab?1[0-4]') AND NOT (path GLOB 'a3/*' OR name GLOB '*7.json') AS wanted FROM (
SELECT 'a' || p_size || '/' || name AS path, name FROM (SELECT p_size, CASE p_partkey % 4 WHEN 0 THEN p_partkey || '.json' WHEN 1 THEN p_partkey || '.safetensors' WHEN 2 THEN 'vocab.' || p_partkey ELSE p_name END AS name FROM part)) GROUP BY ALL""")
def snapshot_patterns(spark, sf_dir):
    """Parts as files of snapshots."""
    k = F.col("p_partkey")
    name = F.when(k % 4 == 0, F.concat(k, F.lit(".json"))).when(k % 4 == 1, F.concat(k, F.lit(".safetensors"))).when(k % 4 == 2, F.concat(F.lit("vocab."), k)).otherwise(F.col("p_name"))
    files = _table(spark, sf_dir, "part").select(F.concat(F.lit("a"), "p_size", F.lit("/"), name).alias("path")).distinct()
    return files.select("path", registration.wanted(F.col("path"), ["*.json", "*.safetensors", "vocab?1[0-4]"], ["a3/*", "*7.json"]).alias("wanted"))
