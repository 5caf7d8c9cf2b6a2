"""Checks of inference prompts: arrays of turns (role, content) that end with the user's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ROLES, is_blank

#: Most new tokens, characters of a turn, and tokens of a rendered prompt.
MAX_NEW_TOKENS, MAX_TURN_CHARS, MAX_TOKENS = 1024, 20_000, 2048


def as_turns(prompt: Column) -> Column:
    """A plain text prompt as one turn of the user."""
    return F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content")))


def prompt_problem(turns: Column, max_new_tokens: Column | None = None) -> Column:
    """The first rule that a prompt breaks, or null: the new tokens' bound, the last turn's role, then of the first bad turn
    its role, its content, its length."""
    wanted = F.lit(96) if max_new_tokens is None else max_new_tokens
    fine = F.coalesce(wanted.between(1, MAX_NEW_TOKENS), F.lit(False))
    last = F.coalesce(F.try_element_at(turns, F.lit(-1))["role"] == "user", F.lit(False))

    def of_turn(t: Column) -> Column:
        return F.when(~F.coalesce(t["role"].isin(ROLES), F.lit(False)), "role").when(is_blank(t["content"]), "empty turn").when(F.length(t["content"]) > MAX_TURN_CHARS, "long turn")

    return F.when(~fine, "new tokens").when(~last, "last turn").otherwise(F.get(F.array_compact(F.transform(turns, of_turn)), F.lit(0)))


def prompt_report(prompts: DataFrame, turns: str = "messages", tokens: str | None = None) -> DataFrame:
    """prompts with n_turns, n_chars and problem; tokens: the column with a rendered prompt's tokens, if counted."""
    problem = prompt_problem(F.col(turns))
    if tokens:
        problem = F.coalesce(problem, F.when(F.col(tokens) > MAX_TOKENS, "long prompt"))
    chars = F.aggregate(turns, F.lit(0).cast("long"), lambda n, t: n + F.coalesce(F.length(t["content"]), F.lit(0)))
    return prompts.withColumns({"n_turns": F.coalesce(F.size(turns), F.lit(0)), "n_chars": F.coalesce(chars, F.lit(0)), "problem": problem})
