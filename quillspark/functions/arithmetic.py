"""Column arithmetic for training plans, losses and masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IGNORED = -100


def steps_per_epoch(examples: Column, batch: Column, accumulation: Column) -> Column:
    return F.ceil(examples / (batch * accumulation))


def total_steps(examples: Column, batch: Column, accumulation: Column, epochs: Column) -> Column:
    """Whole steps of an epoch, times epochs."""
    return epochs * steps_per_epoch(examples, batch, accumulation)


def warmup_steps(total: Column, steps: Column, ratio: Column) -> Column:
    """Explicit steps or the ratio's share, at most total; null where both are given or the ratio is outside [0, 1)."""
    both = steps.isNotNull() & ratio.isNotNull()
    bad = ratio.isNotNull() & ((ratio < 0) | (ratio >= 1))
    return F.when(~both & ~bad, F.least(F.coalesce(steps, F.ceil(total * ratio), F.lit(0)), total))


def perplexity(loss: Column) -> Column:
    """exp(loss) below 20, else null."""
    return F.when(loss < 20, F.exp(loss))


def weighted_loss(loss: Column, tokens: Column) -> Column:
    """Mean loss by token; an aggregate. Null without tokens."""
    return F.sum(loss * tokens) / F.nullif(F.sum(tokens), F.lit(0))


def supervised_tokens(labels: Column) -> Column:
    return F.size(F.filter(labels, lambda x: x != IGNORED))


def masked_labels(ids: Column, offsets: Column, spans: Column) -> Column:
    """ids where the token's offsets (start, end) lie in one of spans (start, end) and are not empty, else IGNORED."""

    def label(i: Column, at: Column) -> Column:
        inside = F.exists(spans, lambda s: (s["start"] <= at["start"]) & (at["end"] <= s["end"]))
        return F.when(inside & (at["start"] < at["end"]), i).otherwise(F.lit(IGNORED))

    return F.zip_with(ids, offsets, label)


def _find(part: Column, text: Column, start: Column) -> Column:
    """Place of part in text from start on, or -1."""
    return F.call_function("locate", part, text, start + 1) - 1


def assistant_spans(messages: Column, text: Column, end_of_turn: str) -> Column:
    """Spans (start, end) of assistant turns in a rendered text: each from its content's place after the turn before to
    the end of the next end-of-turn mark, or of the text."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(s: Column, m: Column) -> Column:
        content = F.regexp_replace(m["content"], r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
        found = _find(content, text, s["at"])
        end_at = _find(F.lit(end_of_turn), text, found)
        end = F.when(end_at >= 0, end_at + len(end_of_turn)).otherwise(F.length(text))
        own = m["role"] == "assistant"
        at = F.when(found < 0, s["at"]).when(own, end).otherwise(found + F.length(content))
        return F.struct(at.cast("int").alias("at"), F.when(own & (found >= 0), F.concat(s["spans"], F.array(F.struct(found.cast("int").alias("start"), end.cast("int").alias("end"))))).otherwise(s["spans"]).alias("spans"))

    return F.aggregate(messages, empty, step)["spans"]


def marked(pieces: Column, labels: Column) -> Column:
    """Token texts with runs of supervised tokens between ⟦ and ⟧."""
    on = F.transform(labels, lambda x: x != IGNORED)
    edges = F.zip_with(on, F.slice(F.concat(F.array(F.lit(False)), on), 1, F.size(on)), lambda a, b: F.when(a & ~b, "⟦").when(~a & b, "⟧").otherwise(""))
    return F.concat(F.array_join(F.zip_with(edges, pieces, lambda e, p: F.concat(e, p)), ""), F.when(F.element_at(on, -1), "⟧").otherwise(""))


def bytes_text(n: Column) -> Column:
    """Bytes, a long or a whole decimal, in the largest unit from B to PiB that leaves at least one, to two places, halves to the even digit."""
    show = lambda i, unit: F.format_string(f"%.2f {unit}", F.bround(n.cast("double") / 1024**i, 2))
    out = F.when(n.isNull(), F.lit(None).cast("string"))
    for i, unit in enumerate(("B", "KiB", "MiB", "GiB", "TiB")):
        out = out.when(F.abs(n) < 1024 ** (i + 1), show(i, unit))
    return out.otherwise(show(5, "PiB"))


def accumulation_window(place: Column, total: Column, width: Column) -> Column:
    """How many batches the accumulation window of the place-th batch (from 1) has: the last one may be shorter."""
    return F.least(width, total - F.floor((place - 1) / width) * width)


def lowered_controls(patience: Column, scheduler: Column, warmup: Column) -> Column:
    """JSON of training controls: a patience of 0 and a warm-up without a scheduler are left out."""
    return F.to_json(F.struct(F.when(patience > 0, patience).alias("patience"), scheduler.alias("scheduler"), F.when(scheduler.isNotNull(), warmup).alias("warmup_steps")))
