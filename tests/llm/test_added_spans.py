"""Precision and recall of the spans that the personal-data method adds, on planted secrets, phones and harmless look-alikes."""

import random

from quillspark.llm import pii

from .helpers import documents, prose


def planted(n, seed=3):
    """Texts with the spans in them that are personal."""
    rnd, out = random.Random(seed), []
    hexes = lambda k: "".join(rnd.choice("0123456789abcdef") for _ in range(k))
    mixed = lambda k: "".join(rnd.choice("ABCDEFGHIJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789") for _ in range(k))
    word = lambda: "-".join(rnd.choice(["counter", "productive", "state", "of", "the", "art", "inter", "national", "well", "known"]) for _ in range(6))
    for i in range(n):
        head, tail = prose(seed * 1000 + i, 12), prose(seed * 2000 + i, 9)
        kind = i % 5
        if kind == 0:
            lead, item = f"{rnd.choice(['api_key', 'token', 'password', 'secret'])}{rnd.choice([': ', '=', ' = '])}", mixed(32)
        elif kind == 1:
            lead, item = f"{rnd.choice(['auth token', 'session', 'bearer'])}{rnd.choice([': ', '='])}", hexes(40)
        elif kind == 2:
            lead, item = f"{rnd.choice(['call', 'tel', 'phone', 'mobile'])}{rnd.choice([': ', ' '])}", f"{rnd.randint(200, 999)}-{rnd.randint(200, 999)}-{rnd.randint(1000, 9999)}"
        else:
            lead, item = "a ", word()
        text = f"{head} {lead}{item} {tail}"
        at = len(head) + 1 + len(lead)
        out.append((text, {(at, at + len(item))} if kind < 3 else set()))
    return out


def test_precision_and_recall(spark):
    cases = planted(400)
    docs = documents(spark, [t for t, _ in cases])
    found = {r["doc_id"]: {(s["start"], s["end"]) for s in r["secret"]} for r in pii.with_spans(docs, pii.train(docs)).select("doc_id", "secret").collect()}
    right = sum(len(found[i] & want) for i, (_, want) in enumerate(cases))
    precision, recall = right / max(1, sum(map(len, found.values()))), right / sum(len(want) for _, want in cases)
    print("precision", precision, "recall", recall)
    assert precision >= 0.95 and recall >= 0.9
