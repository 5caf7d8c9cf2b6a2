"""Small documents with every awkward case, and plain-Python rules to compare with."""

import random
import re

from quillspark.llm import packing  # noqa: F401  the subpackage must be there

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(tokens, k):
    return [tuple(tokens[i : i + k]) for i in range(len(tokens) - k + 1)] if len(tokens) >= k else [tuple(tokens)] if tokens else []


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join(rnd.choice("the of and to in".split()) if rnd.random() < 0.3 else "".join(rnd.choice(["an", "ti", "re", "on", "the", "é"]) for _ in range(rnd.randint(2, 4))) for _ in range(n))


#: Null, empty, blank, repeated, odd white space, special strings, other scripts, long without blanks.
ODD = [None, "", " \n\t ", "one", "one two", "One\x0btwo three\x0c four", "a  b\n\nc", " lead", "trail ", "'s it's 'll''re x'", "<|endoftext|> a<|endoftext|>", "日本語 テキスト \U0001f600", "x" * 3000, "ab" * 40000, "é ́a", "A.B,C|D %%% 12 345"]


def documents(spark, texts, extra=True):
    """texts as documents, with a column whose name clashes with internal ones."""
    rows = [(i, t, "en", "s", len(t or "")) + (("z", 7) if extra else ()) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long" + (", label string, n int" if extra else ""))
