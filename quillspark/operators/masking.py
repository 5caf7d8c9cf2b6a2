"""Tokens with offsets by any tokenizer, and labels that leave only assistant turns to learn from."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arithmetic import IGNORED, assistant_spans
from .tokens import CEILING

#: Texts in one call of a tokenizer.
CALL = 256
#: A tokenizer: texts to (ids, starts, ends) of each text's tokens, places in characters, in order.
Tokenizer = Callable[[list[str]], list[tuple[list[int], list[int], list[int]]]]


@cache
def _file(path: str):
    from tokenizers import Tokenizer as Library

    got = Library.from_file(path)
    got.no_truncation()
    got.no_padding()
    return got


def from_file(path: str) -> Tokenizer:
    """The tokenizer of a tokenizers file, which workers open for themselves."""

    def encode(texts: list[str]) -> list[tuple[list[int], list[int], list[int]]]:
        return [(e.ids, [a for a, _ in e.offsets], [b for _, b in e.offsets]) for e in _file(path).encode_batch(texts, add_special_tokens=False)]

    return encode


def by_blanks(texts: list[str]) -> list[tuple[list[int], list[int], list[int]]]:
    """A tokenizer for tests: runs of other than white space, numbered by their place."""
    import re

    found = [list(re.finditer(r"\S+", t)) for t in texts]
    return [(list(range(len(m))), [x.start() for x in m], [x.end() for x in m]) for m in found]


def token_counts(df: DataFrame, text: Column, tokenizer: Tokenizer, name: str = "n_tokens") -> DataFrame:
    """df with the number of tokens of text; a null text has none."""

    @F.pandas_udf(T.LongType())
    def count(texts):
        import pandas as pd

        values = texts.fillna("").tolist()
        return pd.Series([len(x[0]) for a in range(0, len(values), CALL) for x in tokenizer(values[a : a + CALL])], dtype="int64")

    return df.withColumn(name, count(text))


def inside(starts: np.ndarray, ends: np.ndarray, span_starts: np.ndarray, span_ends: np.ndarray) -> np.ndarray:
    """Which tokens lie within a span and aren't empty. Spans are in order and apart, tokens in order: a token can only lie in the
    last span that begins at or before it, which one merge of the two sorted lists finds."""
    if not len(span_starts):
        return np.zeros(len(starts), bool)
    k = np.searchsorted(span_starts, starts, "right") - 1
    return (k >= 0) & (ends <= span_ends[np.maximum(k, 0)]) & (starts < ends)


def masked_examples(df: DataFrame, messages: Column, text: Column, end_of_turn: str, tokenizer: Tokenizer, ceiling: int = CEILING, keep: list[str] | None = None) -> DataFrame:
    """The columns keep of df with n_tokens, code, input_ids and labels: ids in assistant turns, IGNORED elsewhere.

    code: DATASET_SEQUENCE_TOO_LONG where a text has more tokens than ceiling (nothing is cut), DATASET_TARGET_EMPTY where no token
    is left to learn from, else null; with a code, input_ids and labels are null. A null text counts as empty. text is the rendered
    chat; spans of assistant turns in it are found in Spark, tokens and labels in one Arrow function over batches."""
    keep = df.columns if keep is None else keep
    rows = df.select(*keep, text.alias("_text"), assistant_spans(messages, text, end_of_turn).alias("_spans"))
    made = "n_tokens int, code string, input_ids array<int>, labels array<int>"
    kinds = [pa.int32(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, CALL):
                part = batch.slice(a, CALL)
                texts = [t or "" for t in part.column("_text").to_pylist()]
                out = []
                for (ids, starts, ends), spans in zip(tokenizer(texts), part.column("_spans").to_pylist()):
                    spans = spans or []
                    ids = np.array(ids, np.int32)
                    if len(ids) > ceiling:
                        out.append((len(ids), "DATASET_SEQUENCE_TOO_LONG", None, None))
                        continue
                    live = inside(np.array(starts, np.int64), np.array(ends, np.int64), np.array([s["start"] for s in spans], np.int64), np.array([s["end"] for s in spans], np.int64))
                    out.append((len(ids), None, ids, np.where(live, ids, IGNORED).astype(np.int32)) if live.any() else (len(ids), "DATASET_TARGET_EMPTY", None, None))
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], *(pa.array(c, k) for c, k in zip(zip(*out), kinds))], names=[*part.schema.names[:-2], "n_tokens", "code", "input_ids", "labels"])

    ddl = T.StructType([*rows.schema.fields[:-2], *T.StructType.fromDDL(made).fields])
    return rows.mapInArrow(work, ddl)
