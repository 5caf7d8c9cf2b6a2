"""Repair of conversations whose turns were lost, emptied, cut, repeated or given a wrong role.

A conversation's roles must be, by their initials, s?(ua)+ or nothing. The cheapest edits that give such a sequence are
found by a recursive query of DuckDB inside hash-partitioned batches: each recursion advances one turn for all
conversations of the batch and keeps, for each state of the grammar, the least cost and of equal costs the ASCII-least
audit (older steps are overwritten, so memory is linear). States: 0 nothing yet, S after a system turn, U after a user turn, A after an assistant turn; 0 and A may end.

No conversation has to fit a task. Rows are dealt by ranges of (hash of conv_id, conv_id, turn, role, text) and cut there into
segments of at most SEGMENT rows; a conversation that meets the edge of a task or has several segments is advanced from every
state that a segment may begin in, and a second recursion composes segments in the same way, one segment a recursion.
Repeated rows are found by a grouped minimum over (conversation, hash of role and text), so that neither needs the other's rows.
Only what is one value of the result is made in one place: the audit, and the SHA-256 of a repaired conversation, which reads
its segments one after another and holds one at a time.

Equal least costs and audits are unaffected by the cuts: of two sequences of edits for the same rows between the same states
with equal cost neither is a proper prefix of the other, as what is longer would hold further insertions; so the least of a
whole is made of the least of its parts.

Damage, where asked for, goes by crc32(conv_id:turn) % 20: 0 drops a row, 1 empties its text, 2 takes its .!? away, 3 repeats it,
4 sets role user.

Defined results: a null conv_id is a conversation of its own; nulls in role, text or the damage key are one space; null turns
come first and count for no gap; rows of one turn are in order of role and text; an empty table gives no rows; a conversation without rows has an empty audit; columns other than conv_id, turn,
role and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import stored

#: Rows in a segment, characters of text in one, segments in a batch of the recursive query and in one that is being made.
SEGMENT, SEGMENT_TEXT, BATCH, READY = 512, 1 << 20, 2000, 256
#: Costs of the edits and what a truncated row adds unless it is deleted (fixed values of the task).
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANKS = " \t\n\x0b\x0c\r"

#: What an edit does to a state: a symbol is a row's kind (s, u, a, o by its role's initial; in upper case: truncated; x: must go).
_STEPS = f"""
insertions(a, b, letters, cost) AS (VALUES ('0', '0', '', 0), ('S', 'S', '', 0), ('U', 'U', '', 0), ('A', 'A', '', 0),
  ('0', 'U', 'I', {INSERT}), ('S', 'U', 'I', {INSERT}), ('A', 'U', 'I', {INSERT}), ('U', 'A', 'I', {INSERT}), ('0', 'A', 'II', {2 * INSERT}), ('S', 'A', 'II', {2 * INSERT})),
kinds(kind) AS (VALUES ('s'), ('u'), ('a'), ('o'), ('S'), ('U'), ('A'), ('O'), ('x')),
moves(kind, a, b, letters, cost) AS (
  SELECT kind, a, a, 'D', {DELETE} FROM kinds, (VALUES ('0'), ('S'), ('U'), ('A')) x(a)
  UNION ALL SELECT kind, a, b, CASE WHEN lower(kind) = role THEN 'K' ELSE 'R' END, CASE WHEN lower(kind) = role THEN 0 ELSE {REROLE} END + CASE WHEN kind = upper(kind) THEN {TRUNCATED} ELSE 0 END
  FROM kinds, (VALUES ('0', 'U', 'u'), ('S', 'U', 'u'), ('A', 'U', 'u'), ('U', 'A', 'a'), ('0', 'S', 's')) y(a, b, role) WHERE kind <> 'x' AND (role <> 's' OR lower(kind) = 's')),
steps AS MATERIALIZED (SELECT kind, a, b, m.cost, m.letters FROM (
  SELECT kind, i.a, m.b, min({{'cost': i.cost + m.cost, 'letters': i.letters || m.letters}}) AS m FROM insertions i JOIN moves m ON i.b = m.a GROUP BY kind, i.a, m.b))"""

_ADVANCE = f"""
WITH RECURSIVE {_STEPS},
walk(seg, start, step, state, cost, audit) USING KEY (seg, start, state) AS (
  SELECT seg, start, 0, start, 0, '' FROM segs, (VALUES ('0'), ('S'), ('U'), ('A')) x(start) WHERE start = '0' OR NOT whole
  UNION
  SELECT seg, start, step, state, best.cost, best.audit FROM (
    SELECT w.seg, w.start, w.step + 1 AS step, t.b AS state, min({{'cost': w.cost + t.cost, 'audit': w.audit || t.letters}}) AS best
    FROM walk w JOIN segs g ON g.seg = w.seg JOIN steps t ON t.a = w.state AND t.kind = substr(g.kinds, w.step + 1, 1)
    WHERE w.step < len(g.kinds) GROUP BY w.seg, w.start, w.step, t.b))
SELECT seg, start, state, cost, audit FROM walk JOIN segs USING (seg) WHERE step = len(kinds)"""

#: One segment a recursion: maps hold (conv, place, start, state, cost, audit), convs how many segments there are.
_COMPOSE = f"""
WITH RECURSIVE {_STEPS},
walk(conv, place, state, cost, audit, path) USING KEY (conv, state) AS (
  SELECT conv, 0, '0', 0::BIGINT, '', '' FROM convs
  UNION
  SELECT conv, place, state, best.cost, best.audit, best.path FROM (
    SELECT w.conv, w.place + 1 AS place, m.state, min({{'cost': w.cost + m.cost, 'audit': w.audit || m.audit, 'path': w.path || w.state}}) AS best
    FROM walk w JOIN maps m ON m.conv = w.conv AND m.place = w.place AND m.start = w.state GROUP BY w.conv, w.place, m.state)),
ended AS (SELECT conv, min({{'cost': w.cost + i.cost, 'audit': w.audit || i.letters, 'path': w.path || w.state, 'tail': i.letters}}) AS best
  FROM walk w JOIN convs c USING (conv) JOIN insertions i ON i.a = w.state WHERE w.place = c.n AND (i.b = 'A' OR i.b = '0') GROUP BY conv)
SELECT conv, best.cost AS cost, best.audit AS audit, best.path AS path, best.tail AS tail FROM ended"""


def _database() -> duckdb.DuckDBPyConnection:
    db = duckdb.connect(config={"threads": "1", "memory_limit": "400MB", "temp_directory": ""})
    db.execute("SET enable_progress_bar = false")
    return db


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and times (0: dropped, 2: repeated) of the damaged rows; nulls of role and text are one space."""
    key = F.crc32(F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))) % 20
    text = F.when(key == 1, F.lit("")).when(key == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return turns.select("conv_id", "turn", F.when(key == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(key == 0, 0).when(key == 3, 2).otherwise(1).alias("times"))


def plain(table: DataFrame) -> DataFrame:
    """conv_id, turn, role and text of any table of conversations, nulls of role and text as one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return table.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role"), space("text"))


_SEGMENTS = "conv_id long, seg long, whole boolean, turns array<long>, roles array<string>, texts binary, kinds string, keys array<binary>"


def segments(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Conversations cut into segments in order of seg: at most segment rows, or SEGMENT_TEXT of text, of one conversation.

    whole: no other segment holds rows of the conversation. texts: the rows' texts, packed. kinds: one symbol a row, truncated
    ones in upper case, blank ones x. keys: hash of each row's role and text."""
    schema = pa.schema([("conv_id", pa.int64()), ("seg", pa.int64()), ("whole", pa.bool_()), ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.binary()), ("kinds", pa.string()), ("keys", pa.list_(pa.binary()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg, conv, first, held, size, parts = TaskContext.get().partitionId() << 32, None, True, [], 0, 0
        seen, ready, waiting = False, [], 0

        def made(whole: bool) -> None:
            nonlocal seg, parts, waiting
            kinds, keys = [], []
            for _, role, text in held:
                kind, last = role[:1] if role[:1] in ("s", "u", "a") else "o", text.rstrip(BLANKS)[-1:]
                kinds.append("x" if not last else kind if last in ".!?" else kind.upper())
                keys.append(hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest())
            row = {"conv_id": conv, "seg": seg, "whole": whole, "turns": [t for t, _, _ in held], "roles": [r for _, r, _ in held], "texts": packed([x for _, _, x in held]), "kinds": "".join(kinds), "keys": keys}
            seg, parts, waiting = seg + 1, parts + 1, waiting + size
            ready.append(row)

        for batch in batches:
            for c, turn, role, text, times in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if seen and c != conv:
                    made(not parts and not first)
                    held, size, parts, first = [], 0, 0, False
                if len(ready) >= READY or waiting >= SEGMENT_TEXT:
                    yield pa.RecordBatch.from_pylist(ready, schema)
                    ready, waiting = [], 0
                conv, seen = c, True
                for _ in range(times):
                    if held and (len(held) >= segment or size + len(text) > SEGMENT_TEXT):
                        made(False)
                        held, size = [], 0
                    held.append((turn, role, text))
                    size += len(text)
        if seen:
            made(False)  # the first and the last conversation of a task may go on in others
            yield pa.RecordBatch.from_pylist(ready, schema)

    order = [F.xxhash64("conv_id").alias("_h"), "conv_id", "turn", "role", "text"]
    dealt = rows.select(order[0], "conv_id", "turn", "role", "text", "times")
    ordered = dealt.repartitionByRange("_h", "conv_id", "turn", "role", "text").sortWithinPartitions("_h", "conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "turn", "role", "text", "times").mapInArrow(work, _SEGMENTS)


def packed(texts: list[str]) -> bytes:
    """Texts as one compressed value: their number, the bytes of each, and all bytes."""
    parts = [t.encode() for t in texts]
    return zstandard.compress(np.array([len(parts), *map(len, parts)], "<u4").tobytes() + b"".join(parts), 3)


def unpacked(data: bytes) -> list[str]:
    raw = zstandard.decompress(data)
    n = int.from_bytes(raw[:4], "little")
    ends = 4 + 4 * n + np.cumsum(np.frombuffer(raw, "<u4", n, 4).astype(np.int64))
    return [raw[a:b].decode() for a, b in zip([4 + 4 * n, *ends.tolist()], ends.tolist())]


def judged(segs: DataFrame) -> DataFrame:
    """(conv_id, seg, whole, turns, initials, symbols, fresh): kinds with repeats as x; fresh: 1 where a row is the first of its
    role and text in the conversation, else 0."""
    each = segs.select("conv_id", "seg", F.posexplode("keys").alias("i", "key"))
    firsts = each.groupBy("conv_id", "key").agg(F.min(F.struct("seg", "i")).alias("f"))
    fresh = firsts.groupBy(F.col("f.seg").alias("seg")).agg(F.collect_list("f.i").alias("firsts"))  # of one segment
    narrow = segs.select("conv_id", "seg", "whole", "turns", "kinds", F.transform("roles", lambda r: F.substring(r, 1, 1)).alias("initials"))
    joined = narrow.join(fresh, "seg", "left").withColumn("firsts", F.coalesce("firsts", F.array().cast("array<int>")))
    mark = F.transform(F.sequence(F.lit(1), F.length("kinds")), lambda i: F.when(F.array_contains("firsts", (i - 1).cast("int")), F.lit("1")).otherwise("0"))
    return joined.withColumn("fresh", F.when(F.length("kinds") > 0, F.array_join(mark, "")).otherwise("")).drop("firsts")


_MAPS = "conv_id long, seg long, maps array<struct<start:string,state:string,cost:long,audit:string>>, stats struct<n:int,blank:int,duplicate:int,truncated:int,illegal:int,first:string,last:string,low:long,high:long,distinct:int>"


def advanced(rows: DataFrame, tasks: int) -> DataFrame:
    """Per segment: least cost and audit from each state it may begin in to each it may end in, and its counts."""
    schema = _arrow(_MAPS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        db = _database()
        for batch in batches:
            for a in range(0, batch.num_rows, BATCH):
                rows = batch.slice(a, BATCH).to_pylist()
                for r in rows:
                    r["symbols"] = "".join(k if f == "1" else "x" for k, f in zip(r["kinds"], r["fresh"]))
                segs = pa.table({"seg": [r["seg"] for r in rows], "whole": [r["whole"] for r in rows], "kinds": [r["symbols"] for r in rows]})  # noqa: F841  read by name
                maps: dict[int, list] = {}
                for seg, start, state, cost, audit in db.execute(_ADVANCE).fetchall():
                    maps.setdefault(seg, []).append({"start": start, "state": state, "cost": cost, "audit": audit})
                out = [{"conv_id": r["conv_id"], "seg": r["seg"], "maps": maps[r["seg"]], "stats": _counts(r)} for r in rows]
                yield pa.RecordBatch.from_pylist(out, schema)

    return rows.repartition(tasks, "seg").mapInArrow(work, _MAPS)


def _counts(r: dict) -> dict:
    pairs = list(zip(r["initials"], r["initials"][1:]))
    known = [t for t in r["turns"] if t is not None]
    kinds = list(zip(r["kinds"], r["fresh"]))
    return {
        "n": len(kinds), "blank": sum(k == "x" for k, _ in kinds), "duplicate": sum(k != "x" and f == "0" for k, f in kinds), "truncated": sum(k != "x" and f == "1" and k.isupper() for k, f in kinds),
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in pairs), "first": r["initials"][0] if kinds else None, "last": r["initials"][-1] if kinds else None,
        "low": known[0] if known else None, "high": known[-1] if known else None, "distinct": len(set(known)),
    }


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(ddl))


_CONVS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, edits array<struct<seg:long,start:string,audit:string,tail:string>>"


def composed(maps: DataFrame, tasks: int) -> DataFrame:
    """Per conversation: counts, cost, audit, and for each segment the state it begins in and its edits."""
    schema = _arrow(_CONVS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        db = _database()
        held: list[dict] = []

        def made() -> pa.RecordBatch:
            by: dict = {}
            for r in held:
                by.setdefault(r["conv_id"], []).append(r)
            groups = list(by.values())
            convs = pa.table({"conv": range(len(groups)), "n": [len(g) for g in groups]})  # noqa: F841  read by name
            flat = [(c, p, m) for c, g in enumerate(groups) for p, r in enumerate(g) for m in r["maps"]]
            maps = pa.table({"conv": [c for c, _, _ in flat], "place": [p for _, p, _ in flat], **{k: [m[k] for _, _, m in flat] for k in ("start", "state", "cost", "audit")}})  # noqa: F841
            out = []
            for conv, cost, audit, path, tail in db.execute(_COMPOSE).fetchall():
                g = groups[conv]
                edits = []
                for p, r in enumerate(g):
                    mine = next(m for m in r["maps"] if m["start"] == path[p] and m["state"] == path[p + 1])
                    edits.append({"seg": r["seg"], "start": path[p], "audit": mine["audit"], "tail": tail if p == len(g) - 1 else ""})
                out.append({"conv_id": g[0]["conv_id"], "cost": cost, "audit": audit, "edits": edits} | _totals([r["stats"] for r in g]))
            return pa.RecordBatch.from_pylist(out, schema)

        for batch in batches:
            for r in batch.to_pylist():
                if len(held) >= BATCH and r["conv_id"] != held[-1]["conv_id"]:
                    yield made()
                    held = []
                held.append(r)
        if held:
            yield made()

    return maps.repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "seg").mapInArrow(work, _CONVS)


def _totals(stats: list[dict]) -> dict:
    some, known = [s for s in stats if s["n"]], [s for s in stats if s["low"] is not None]
    distinct = sum(s["distinct"] for s in known) - sum(a["high"] == b["low"] for a, b in zip(known, known[1:]))
    illegal = sum(s["illegal"] for s in some) + sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(some, some[1:]))
    gaps = known[-1]["high"] - known[0]["low"] + 1 - distinct if known else 0
    return {"gaps": gaps, "illegal": illegal} | {k: sum(s[k] for s in stats) for k in ("blank", "duplicate", "truncated")}


def edited(roles: list[str], texts: list[str], start: str, letters: str) -> list[tuple[str, str]]:
    """The repaired rows of a segment that begins in a state."""
    out, at, before = [], 0, start
    for letter in letters:
        asked = "assistant" if before == "U" else "user"
        if letter == "D":
            at += 1
            continue
        if letter == "K":
            role, text = roles[at], texts[at]
        else:
            role, text = asked, "" if letter == "I" else texts[at]
        at += letter != "I"
        before = role[0].upper()
        out.append((role, text))
    return out


def hashed(segs: DataFrame, convs: DataFrame, tasks: int) -> DataFrame:
    """(conv_id, repaired_sha256): each conversation's segments meet their edits in order, one segment at a time."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("start", "string"), ("audit", "string"))]
    edits = convs.select("conv_id", F.explode("edits").alias("e")).select("conv_id", F.col("e.seg").alias("seg"), F.lit(None).cast("array<string>").alias("roles"), F.lit(None).cast("binary").alias("texts"), F.col("e.start").alias("start"), F.concat("e.audit", "e.tail").alias("audit"))
    both = segs.select("conv_id", "seg", "roles", "texts", *nothing).unionByName(edits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sha, empty, seen, edit = None, hashlib.sha256(), True, False, None
        done: list[tuple] = []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], pa.int64()), pa.array([h for _, h in done])], schema=schema)

        for batch in batches:
            for i in range(batch.num_rows):
                c = batch.column("conv_id")[i].as_py()
                if seen and c != conv:
                    done.append((conv, sha.hexdigest()))
                    sha, empty = hashlib.sha256(), True
                conv, seen = c, True
                if batch.column("start")[i].is_valid:
                    edit = batch.column("start")[i].as_py(), batch.column("audit")[i].as_py()
                    continue
                for role, text in edited(batch.column("roles")[i].as_py(), unpacked(batch.column("texts")[i].as_py()), *edit):
                    sha.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                    empty = False
            if len(done) >= BATCH:
                yield flush()
                done = []
        if seen:
            done.append((conv, sha.hexdigest()))
            yield flush()

    ordered = both.repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "seg", F.col("start").isNull())
    return ordered.mapInArrow(work, "conv_id long, repaired_sha256 string")


def repair(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Per conversation of rows (conv_id, turn, role, text, times): gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256."""
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    segs = stored(segments(rows, segment), "repair-segments")
    convs = stored(composed(advanced(judged(segs), tasks), tasks), "repair-conversations")
    hashes = hashed(segs, convs, tasks).withColumnRenamed("conv_id", "_c")
    return convs.drop("edits").join(hashes, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(plain(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


_DAMAGED = """
crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(256) r(i))),
keyed AS MATERIALIZED (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT), lambda c, b: xor(c >> 8, crc.t[xor(c & 255, b) + 1]), 4294967295)) % 20 AS k
  FROM conversations, crc),
lines AS MATERIALIZED (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM keyed, range(2) r(copy) WHERE k <> 0 AND copy < CASE k WHEN 3 THEN 2 ELSE 1 END)),
judged AS MATERIALIZED (SELECT conv_id, turn, role, text, i, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') AS cut,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair,
    CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS initial FROM lines),
counts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
  count(*) FILTER (cut AND NOT blank AND NOT again) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id)"""

OP12_SQL = f"""
WITH RECURSIVE {_STEPS}, {_DAMAGED},
marks AS MATERIALIZED (SELECT conv_id, i, CASE WHEN blank OR again THEN 'x' WHEN cut THEN upper(initial) ELSE initial END AS kind FROM judged),
walk(conv_id, i, state, cost, audit) AS (
  SELECT DISTINCT conv_id, 0, '0', 0, '' FROM conversations
  UNION ALL
  SELECT conv_id, i, state, best.cost, best.audit FROM (
    SELECT w.conv_id, w.i + 1 AS i, s.b AS state, min({{'cost': w.cost + s.cost, 'audit': w.audit || s.letters}}) AS best
    FROM walk w JOIN marks m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i + 1 JOIN steps s ON s.a = w.state AND s.kind = m.kind GROUP BY w.conv_id, w.i, s.b)),
best AS MATERIALIZED (SELECT w.conv_id, min({{'cost': w.cost + e.cost, 'audit': w.audit || e.letters}}) AS m, any_value(coalesce(c.gaps, 0)) AS gaps, any_value(coalesce(c.blank, 0)) AS blank,
    any_value(coalesce(c.duplicate, 0)) AS duplicate, any_value(coalesce(c.truncated, 0)) AS truncated, any_value(coalesce(c.illegal, 0)) AS illegal
  FROM walk w LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id JOIN insertions e ON e.a = w.state AND e.b IN ('0', 'A') WHERE w.i = coalesce(c.n, 0) GROUP BY w.conv_id),
edits AS (SELECT conv_id, p, substr(audit, p, 1) AS letter, p - len(replace(left(audit, p), 'I', '')) AS inserted, len(replace(left(audit, p), 'D', '')) AS j FROM (SELECT conv_id, m.audit AS audit, unnest(range(1, len(m.audit) + 1)) AS p FROM best)),
made AS (SELECT e.conv_id, e.letter, e.j, e.p, l.role, CASE WHEN e.letter = 'I' THEN '' ELSE l.text END AS text
  FROM edits e LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM e.conv_id AND l.i = e.p - e.inserted AND e.letter <> 'I' WHERE e.letter <> 'D'),
named AS (SELECT *, max(CASE WHEN j = 1 AND letter = 'K' AND role LIKE 's%' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS s FROM made),
whole AS (SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (j - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY p) AS t FROM named GROUP BY conv_id)
SELECT b.conv_id, gaps, blank, duplicate, truncated, illegal, m.cost::BIGINT AS cost, m.audit AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM best b LEFT JOIN whole w ON w.conv_id IS NOT DISTINCT FROM b.conv_id"""
