"""Personal data by weak supervision, in DataFrame operations only.

Fixed patterns give the base spans (email, ip, card, phone). Other candidates are long unbroken tokens and national
phone numbers. Four labelers vote on each: a regex on its shape, a gazetteer on the word before it, the marks
just before it, and its share of digits. The votes' patterns (at most 81) are counted over all documents;
expectation-maximisation over these counts estimates each labeler's reliability for both classes and each
pattern's probability of being personal. With those as soft labels a naive Bayes classifier is trained on bounded
features of the span and its surroundings, and it decides every candidate. Only counts by pattern and feature
value, of bounded number, reach the driver.

Offsets come from the texts between matches: what split() leaves and regexp_extract_all() finds add up to the text.
The patterns are written so that each takes linear time and finds what the plain pattern finds.

Defined results: a null text is empty and has no spans; without candidates the classifier takes none; spans of the
classifier that overlap a base span are dropped; offsets are code points, the end exclusive; repeated rows stay, a null
doc_id stays null; other columns are not looked at (redacted keeps them).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name

_LOCAL = r"A-Za-z0-9._%+-"
#: kind: cheap test that a text may hold one, pattern.
BASE = {
    "email": (lambda t: t.contains("@"), rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (lambda t: t.rlike(r"[0-9]\.[0-9]"), r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"), r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": (lambda t: t.contains("+"), r"\+[0-9][\x20().0-9-]+[0-9]"),
}
_BEFORE = r"(?<![A-Za-z0-9_-])"
CANDIDATE = rf"{_BEFORE}[A-Za-z0-9_-]{{20,}}+|{_BEFORE}\(?[0-9]{{3}}\)?[\x20.-][0-9]{{3}}[\x20.-][0-9]{{4}}(?![0-9])"
#: Words that announce personal data (fixed values).
GAZETTEER = ["token", "key", "apikey", "api_key", "secret", "password", "passwd", "pwd", "bearer", "auth", "credential", "session", "cookie", "phone", "tel", "mobile", "cell", "call", "fax", "contact", "ssn", "account", "iban"]
CONTEXT, RUN, EM_ROUNDS = 24, 128, 30
LABELERS = ("shape", "gazetteer", "marks", "digits")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    value = lambda i: F.substring(digits, n - i, F.lit(1)).cast("int")
    double = lambda d: F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
    terms = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i % 2 == 1, double(value(i))).otherwise(value(i)))
    return F.aggregate(terms, F.lit(0), lambda s, x: s + x) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.coalesce(p.try_cast("int"), F.lit(999)) <= 255)
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(8, 15)


def _cut(df: DataFrame, name: str, may: Column, pattern: str) -> DataFrame:
    """Adds name_m, the matches, and name_g, the texts around them (one more)."""
    text, none = F.col("text"), F.array().cast("array<string>")
    return df.withColumns({f"{name}_m": F.when(may, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none), f"{name}_g": F.when(may, F.split(text, pattern, -1)).otherwise(F.array(text))})


def _gaps(name: str) -> Column:
    """The text in front of each match of _cut."""
    return F.slice(F.col(f"{name}_g"), 1, F.size(f"{name}_m"))


def _spans(df: DataFrame, name: str) -> DataFrame:
    """Adds name_s, an array of (start, end, match, before) of what _cut found; before: the CONTEXT characters in front.

    Offsets add up within runs of RUN matches and then over the runs, so the arrays that grow while they are folded stay short."""
    df = df.withColumn(f"{name}_i", F.zip_with(F.col(f"{name}_m"), _gaps(name), lambda m, g: F.struct(F.length(g).alias("skip"), m.alias("match"), F.right(g, F.lit(CONTEXT)).alias("before"))))
    items, kind = F.col(f"{name}_i"), "array<struct<start:int,end:int,match:string,before:string>>"
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("found"))

    def span(start: Column, end: Column, x: Column) -> Column:
        return F.struct(start.alias("start"), end.alias("end"), x["match"].alias("match"), x["before"].alias("before"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["skip"]
        end = start + F.length(x["match"])
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(span(start, end, x))).alias("found"))

    runs = F.transform(F.sequence(F.lit(0), ((F.size(items) - 1) / RUN).cast("int")), lambda i: F.aggregate(F.slice(items, i * RUN + 1, F.lit(RUN)), empty, step))

    def join(acc: Column, run: Column) -> Column:
        moved = F.transform(run["found"], lambda x: span(x["start"] + acc["at"], x["end"] + acc["at"], x))
        return F.struct((acc["at"] + run["at"]).alias("at"), F.concat(acc["parts"], F.array(moved)).alias("parts"))

    whole = F.aggregate(runs, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("parts")), join)["parts"]
    return df.withColumn(f"{name}_s", F.when(F.size(items) > 0, F.flatten(whole)).otherwise(F.array().cast(kind))).drop(f"{name}_i", f"{name}_m", f"{name}_g")


def _kept(kind: str) -> Column:
    """The spans of a base kind that are valid."""
    return F.filter(f"{kind}_s", lambda s: _valid(kind, s["match"]))


def _meets(kind: str, s: Column) -> Column:
    """Whether s meets a span of a base kind: the last of those that begin before s ends, found by halving, ends after s begins."""
    spans = F.col(kind)

    def halve(at: Column, _: Column) -> Column:
        middle = ((at["low"] + at["high"]) / 2).cast("int")
        before = F.get(spans, middle)["start"] < s["end"]
        return F.when(at["low"] >= at["high"], at).otherwise(F.struct(F.when(before, middle + 1).otherwise(at["low"]).alias("low"), F.when(before, at["high"]).otherwise(middle).alias("high")))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans) + 1)).cast("int"))
    first = F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.size(spans).alias("high")), halve)["low"]
    return F.when(F.size(spans) > 0, F.coalesce(F.get(spans, first - 1)["end"] > s["start"], F.lit(False))).otherwise(False)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _word_before(before: Column) -> Column:
    return F.lower(F.regexp_extract(before, r"([A-Za-z_]+)[^A-Za-z_]{0,6}$", 1))


def _digits(match: Column) -> Column:
    return F.length(F.regexp_replace(match, "[^0-9]", "")) / F.length(match)


def votes(match: Column, before: Column) -> dict[str, Column]:
    """Each labeler's vote on a span: 1 personal, -1 not, 0 abstains."""
    share = _digits(match)
    return {
        "shape": _vote(match.rlike(r"^[0-9a-f]{32,}$|^[A-Z0-9]{20,}$|^\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}$"), match.rlike("^[A-Za-z-]+$")),
        "gazetteer": _vote(_word_before(before).isin(GAZETTEER), F.lit(False)),
        "marks": _vote(before.rlike("[=:]\\s*[\"']?$"), before.rlike(r"[A-Za-z,.]\s+$|^$")),
        "digits": _vote((share > 0.15) & (share < 0.95), share == 0),
    }


def features(match: Column, before: Column) -> dict[str, Column]:
    """The classifier's features of a span, each of a few values."""
    kind = F.when(match.rlike("^[0-9a-f]+$"), "hex").when(match.rlike("^[A-Za-z-]+$"), "letters").when(match.rlike("^[0-9().\\x20-]+$"), "digits").otherwise("mixed")
    return {
        "length": F.least(F.length(match) / 8, F.lit(8)).cast("int").cast("string"),
        "kind": kind,
        "left": F.when(before == "", "none").when(before.rlike("[\"']$"), "quote").when(before.rlike("[=:]\\s*$"), "equals").when(before.rlike(r"\s$"), "blank").otherwise("other"),
        "announced": _word_before(before).isin(GAZETTEER).cast("string"),
    }


def estimate(counts: dict[tuple[int, ...], float]) -> dict[tuple[int, ...], float]:
    """Probability of each vote pattern to be personal, by expectation-maximisation."""
    belief = {p: (1 + max(0, sum(p))) / (2 + sum(map(abs, p))) if any(p) else 0.5 for p in counts}
    total = sum(counts.values())
    for _ in range(EM_ROUNDS):
        yes = sum(n * belief[p] for p, n in counts.items())
        prior = (yes + 1) / (total + 2)
        rate = {}
        for j in range(len(LABELERS)):
            for v in (-1, 0, 1):
                a = sum(n * belief[p] for p, n in counts.items() if p[j] == v)
                b = sum(n * (1 - belief[p]) for p, n in counts.items() if p[j] == v)
                rate[j, v] = ((a + 1) / (yes + 3), (b + 1) / (total - yes + 3))
        for p in counts:
            odds = math.log(prior / (1 - prior)) + sum(math.log(rate[j, v][0] / rate[j, v][1]) for j, v in enumerate(p))
            belief[p] = 1 / (1 + math.exp(-max(-60.0, min(60.0, odds))))
    return belief


class SpanClassifier:
    """Bias and one weight for each feature value; decides(match, before) is a column."""

    def __init__(self, bias: float, weights: dict[str, dict[str, float]]) -> None:
        self.bias, self.weights = bias, weights

    def decides(self, match: Column, before: Column) -> Column:
        def weigh(column: Column, table: dict[str, float]) -> Column:
            return reduce(lambda c, kv: c.when(column == kv[0], F.lit(kv[1])), list(table.items())[1:], F.when(column == next(iter(table)), F.lit(table[next(iter(table))]))).otherwise(0.0)

        if not self.weights:
            return F.lit(False)
        score = reduce(lambda a, b: a + b, (weigh(c, self.weights[n]) for n, c in features(match, before).items()), F.lit(self.bias))
        return score > 0


def train(docs: DataFrame) -> SpanClassifier:
    """Learn the classifier from all candidates of docs (text)."""
    found = _cut(docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")), "c", F.lit(True), CANDIDATE)
    near = F.zip_with("c_m", _gaps("c"), lambda m, g: F.struct(m.alias("match"), F.right(g, F.lit(CONTEXT)).alias("before")))
    each = found.select(F.explode(near).alias("x")).select("x.match", "x.before")
    v, f = votes(F.col("match"), F.col("before")), features(F.col("match"), F.col("before"))
    rows = each.select(*(c.alias(f"v_{n}") for n, c in v.items()), *(c.alias(f"f_{n}") for n, c in f.items())).groupBy(*(f"v_{n}" for n in v), *(f"f_{n}" for n in f)).count().collect()
    if not rows:
        return SpanClassifier(0.0, {})
    counts: dict[tuple[int, ...], float] = {}
    for r in rows:
        p = tuple(r[f"v_{n}"] for n in v)
        counts[p] = counts.get(p, 0) + r["count"]
    belief = estimate(counts)
    yes = sum(n * belief[p] for p, n in counts.items())
    total = sum(counts.values())
    weights: dict[str, dict[str, float]] = {}
    for name in f:
        sums: dict[str, list[float]] = {}
        for r in rows:
            b = belief[tuple(r[f"v_{n}"] for n in v)]
            s = sums.setdefault(r[f"f_{name}"], [0.0, 0.0])
            s[0] += r["count"] * b
            s[1] += r["count"] * (1 - b)
        weights[name] = {k: math.log((a + 0.5) / (yes + 0.5 * len(sums))) - math.log((b + 0.5) / (total - yes + 0.5 * len(sums))) for k, (a, b) in sorted(sums.items())}
    return SpanClassifier(math.log((yes + 1) / (total - yes + 1)), weights)


def with_spans(docs: DataFrame, classifier: SpanClassifier) -> DataFrame:
    """docs (doc_id, text) with one array of (start, end) for each base kind and for secret, the classifier's."""
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    for kind, (may, pattern) in BASE.items():
        df = _spans(_cut(df, kind, may(F.col("text")), pattern), kind)
    df = _spans(_cut(df, "secret", F.lit(bool(classifier.weights)), CANDIDATE), "secret")
    found = {kind: _kept(kind) for kind in BASE}
    df = df.select("doc_id", "text", *(c.alias(k) for k, c in found.items()), F.filter("secret_s", lambda s: classifier.decides(s["match"], s["before"])).alias("secret"))
    return df.withColumn("secret", F.filter("secret", lambda s: ~reduce(lambda a, b: a | b, (_meets(k, s) for k in BASE))))


def redacted(docs: DataFrame, classifier: SpanClassifier) -> DataFrame:
    """docs with every span in text replaced by its kind in brackets; a null text becomes empty; all columns stay."""
    out, text = docs, F.coalesce(F.col("text").cast("string"), F.lit(""))
    out, cut = out.withColumn("text", text), free_name(docs, "_pii")
    while {f"{cut}_m", f"{cut}_g"} & {c.lower() for c in docs.columns}:
        cut = "_" + cut
    kinds = {k: (may(text), pattern) for k, (may, pattern) in BASE.items()}
    if classifier.weights:
        kinds["secret"] = (F.lit(True), CANDIDATE)

    def parts(kind: str) -> Column:
        mark = F.lit(f"[{kind.upper()}]")
        take = (lambda m, g: classifier.decides(m, F.right(g, F.lit(CONTEXT)))) if kind == "secret" else (lambda m, g: _valid(kind, m))
        return F.zip_with(f"{cut}_m", _gaps(cut), lambda m, g: F.concat(g, F.when(take(m, g), mark).otherwise(m)))

    for kind, (may, pattern) in kinds.items():
        out = _cut(out, cut, may, pattern)
        joined = F.concat(F.array_join(parts(kind), ""), F.element_at(f"{cut}_g", -1))
        out = out.withColumn("text", F.when(F.size(f"{cut}_m") > 0, joined).otherwise(F.col("text"))).drop(f"{cut}_m", f"{cut}_g")
    return out


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = with_spans(docs, train(docs))

    def listing(kind: str) -> Column:
        return F.transform(kind, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

    listed = {k: listing(k) for k in (*BASE, "secret")}
    base = F.concat(*(listed[k] for k in BASE))
    return found.select("doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in BASE), F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(F.concat(*listed.values()), ",").alias("spans"))
