"""Repair of conversations against exhaustive search, whole and cut into small segments, and against SQL."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from quillspark.llm import turn_repair
from quillspark.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle import SF, database, rows

BLANK = re.compile(r"[\x20\x09-\x0D]*")
NEXT = {"0": "su", "s": "u", "u": "a", "a": "u"}


def faults(turns):
    out, seen = [], set()
    for role, text in turns:
        out.append("blank" if BLANK.fullmatch(text) else "duplicate" if (role, text) in seen else "" if re.search(r"[.!?][\x20\x09-\x0D]*\Z", text) else "truncated")
        seen.add((role, text))
    return out


def cheapest(turns):
    """Least (cost, audit, rows) of all sequences of edits, with at most two insertions at a place."""
    marks, found = faults(turns), []

    def go(i, state, cost, audit, made, inserted):
        if found and cost > found[0][0]:
            return
        if i == len(turns) and state in "0a":
            if not found or (cost, audit) < found[0][:2]:
                found[:] = [(cost, audit, made)]
        if inserted < 2:
            new = "a" if state == "u" else "u"
            go(i, new, cost + 3, audit + "I", [*made, ("user" if new == "u" else "assistant", "")], inserted + 1)
        if i < len(turns):
            (role, text), extra = turns[i], 3 * (marks[i] == "truncated")
            go(i + 1, state, cost + 4, audit + "D", made, 0)
            if marks[i] not in ("blank", "duplicate"):
                if role[:1] and role[:1] in NEXT[state]:
                    go(i + 1, role[:1], cost + extra, audit + "K", [*made, (role, text)], 0)
                new = "a" if state == "u" else "u"
                go(i + 1, new, cost + 3 + extra, audit + "R", [*made, ("user" if new == "u" else "assistant", text)], 0)

    go(0, "0", 0, "", [], 0)
    return found[0]


def want(lines):
    """lines: (turn, role, text) of one conversation after damage."""
    lines = sorted(lines, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    turns, known = [(r, t) for _, r, t in lines], [n for n, _, _ in lines if n is not None]
    marks = faults(turns)
    cost, audit, made = cheapest(turns)
    pairs = [a[0][:1] + b[0][:1] for a, b in itertools.pairwise(turns)]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    text = "\n".join(f"{r}:{t}" for r, t in made)
    return (gaps, *(marks.count(m) for m in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest())


def damaged(table):
    out = {}
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        mine = out.setdefault(conv, [])
        if k:
            row = (turn, "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text)
            mine += [row] * (1 + (k == 3))
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.fixture(scope="module")
def table():
    rnd = random.Random(8)
    texts, roles = ["Hi.", "Yes!", "cut", " ", "", "Ok? ", "a.\x0b", None, "Hi."], ["system", "user", "assistant", "tool", "", None, "user", "assistant"]
    out = []
    for conv in range(120):
        n = rnd.randint(1, 6)
        start = rnd.choice([0, 1, 5])
        for i in range(n):
            turn = None if rnd.random() < 0.05 else start + (i if rnd.random() < 0.85 else rnd.randint(0, 9))
            role = rnd.choice(roles) if rnd.random() < 0.4 else ("user", "assistant")[i % 2]
            out.append((conv, turn, role, rnd.choice(texts) if rnd.random() < 0.5 else f"text {conv} {i}."))
    return out + [(None, 0, "user", "Who?"), (None, 1, "assistant", "Nobody."), (500, 3, "user", "x."), (500, 3, "user", "x."), (-1, 0, "s", "Sys.")]


@pytest.mark.parametrize("segment", [1, 2, 512])
def test_against_exhaustive_search(spark, table, segment):
    df = spark.createDataFrame([(*r, "z", 1) for r in table], "conv_id long, turn long, role string, text string, seg string, cost int").repartition(3)
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in turn_repair.repair(turn_repair.damaged(turn_repair.plain(df)), segment).collect()}
    lines = damaged(table)
    assert set(got) == set(lines)
    for conv, mine in lines.items():
        assert got[conv] == want(mine), (conv, mine)


def test_one_conversation_of_half_of_all_rows(spark):
    rows_ = [(1, i, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(3000)] + [(c, i, ("user", "assistant")[i % 2], f"{i}!") for c in range(2, 600) for i in range(4)]
    df = spark.createDataFrame(rows_, "conv_id long, turn long, role string, text string")
    segs = turn_repair.segments(turn_repair.damaged(turn_repair.plain(df)), 100)
    sizes = segs.select("conv_id", F.size("roles").alias("n")).collect()
    assert max(r["n"] for r in sizes) <= 100 and sum(r["conv_id"] == 1 for r in sizes) >= 28
    whole = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in turn_repair.repair(turn_repair.damaged(turn_repair.plain(df)), 5000).collect()}
    cut = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in turn_repair.repair(turn_repair.damaged(turn_repair.plain(df)), 100).collect()}
    assert whole == cut and len(whole) == 599


def test_query_and_sql(spark, table, tmp_path):
    got = QUERIES["op12_turn_repair"](spark, SF).toPandas()
    assert rows(got) == rows(database().sql(ORACLE_SQL["op12_turn_repair"]).df())
    spark.createDataFrame(table, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES["op12_turn_repair"](spark, str(tmp_path)).toPandas()
    assert rows(got) == rows(database(str(tmp_path)).sql(ORACLE_SQL["op12_turn_repair"]).df())
