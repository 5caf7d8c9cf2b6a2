"""Reproducible selection by salted content hash, and fail-closed exclusion of languages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..codes import Refused
from ..functions.text import content_hash, is_blank, prefix_length
from .digests import FEW, around_rank, grown_edges, ranges

#: Least characters that a template common to one language's rows must have.
LEAST_PREFIX = 100
#: Rows in a range of the order column in which the rows of one content are counted apart.
RANGE_ROWS = 1 << 20


def _free(df: DataFrame, *names: str) -> list[str]:
    """names with underscores in front until df has no column of them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def rank(salt: str, identity: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{salt}:"), identity), 256)


def occurrence(df: DataFrame, key: str, order: str, name: str = "occurrence", range_rows: int = RANGE_ROWS) -> DataFrame:
    """df with column occurrence: rows of the same key before this one in the order (0 for the first).

    A key may hold much of the table, so rows are numbered within (key, range of order) and the ranges' sizes, which
    were aggregated before the shuffle, are added. Ranges hold about range_rows rows each, so their number grows with the table. Rows without an order come first,
    those without a key are a key of their own; order is numeric."""
    part, inside, n, before, k = _free(df, "_part", "_inside", "_n", "_before", "_key")
    dealt = df.withColumn(part, ranges(F.col(order), grown_edges(df, F.col(order), range_rows)))
    sizes = dealt.groupBy(F.col(key).alias(k), F.col(part).alias(f"{part}_")).agg(F.count("*").alias(n))
    earlier = Window.partitionBy(k).orderBy(f"{part}_").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(k, f"{part}_", F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(before))
    numbered = dealt.withColumn(inside, F.row_number().over(Window.partitionBy(key, part).orderBy(order)) - 1)
    joined = numbered.join(sizes, F.col(key).eqNullSafe(F.col(k)) & (F.col(part) == F.col(f"{part}_")))
    return joined.withColumn(name, F.col(before) + F.col(inside)).drop(part, inside, before, k, f"{part}_")


def select_stable(df: DataFrame, count: int | None, salt: str, key_fields: Sequence[str], order: str, selection: str = "stable_hash") -> DataFrame:
    """The count rows of least rank, in source order; all rows for selection 'all', no count, or a count that covers them.

    Equal contents are told apart by their occurrence, so the choice doesn't depend on how rows are dealt. Only hashes and
    the order are ranked; the chosen rows are joined to them afterwards. Of rows that have the same key fields and order
    any may be taken."""
    if selection == "all" or count is None:
        return df.orderBy(order)
    if selection != "stable_hash":
        raise Refused("CONFIG_OUT_OF_BOUNDS", f"unknown selection {selection!r}")
    h, o, k, i = _free(df, "_hash", "_order", "_times", "_number")
    keys = df.select(content_hash(key_fields).alias(h), F.col(order).alias(o))
    ranked = occurrence(keys, h, o, "occurrence").withColumn("rank", rank(salt, F.concat_ws(":", h, F.col("occurrence").cast("string"))))
    chosen = ranked.orderBy("rank", o).limit(count).groupBy(h, o).agg(F.count("*").alias(k))
    rows = df.join(chosen, F.col(order).eqNullSafe(F.col(o)) & (content_hash(key_fields) == F.col(h)))
    numbered = rows.withColumn(i, F.row_number().over(Window.partitionBy(h, o).orderBy(F.lit(0))))
    return numbered.filter(F.col(i) <= F.col(k)).drop(h, o, k, i).orderBy(order)


def with_identity(df: DataFrame, salt: str, identity_field: str, key_fields: Sequence[str]) -> DataFrame:
    """df with identity (id and content hash) and rank; a pure function of each row."""
    identity = F.concat_ws(":", F.col(identity_field).cast("string"), content_hash(key_fields))
    checked = F.when(is_blank(F.col(identity_field).cast("string")), F.raise_error(F.lit("a row has a blank identity"))).otherwise(identity)
    return df.withColumn("identity", checked).withColumn("rank", rank(salt, F.col("identity")))


def select_bounded(df: DataFrame, count: int, salt: str, identity_field: str, key_fields: Sequence[str]) -> DataFrame:
    """The count rows of least (rank, identity), in that order: one bounded heap a task and one merge."""
    if count <= 0:
        raise Refused("CONFIG_OUT_OF_BOUNDS", "count must be positive")
    return with_identity(df, salt, identity_field, key_fields).orderBy("rank", "identity").limit(count)


def drop_languages(df: DataFrame, field: str | None, exclude: Sequence[str]) -> DataFrame:
    """Rows whose field, in any case, is none of exclude. Refuses a missing field, and to drop nothing or everything."""
    if not exclude:
        return df
    if not field or field not in df.columns:
        raise Refused("CONFIG_OUT_OF_BOUNDS", "no column to tell languages by")
    gone = F.lower(F.coalesce(F.col(field).cast("string"), F.lit("none"))).isin([x.lower() for x in exclude])
    counts = df.agg(F.count_if(gone).alias("removed"), F.count("*").alias("n")).first()
    if counts["removed"] in (0, counts["n"]):
        raise Refused("CONFIG_OUT_OF_BOUNDS", "the exclusion removes nothing or everything", removed=counts["removed"])
    return df.filter(~gone)


def derive_prefix(df: DataFrame, field: str, least: int = LEAST_PREFIX) -> str:
    """The longest common prefix of field over all rows: that of its least and greatest value."""
    found = df.agg(F.min(field).alias("low"), F.max(field).alias("high"), F.count_if(F.col(field).isNull()).alias("nulls"))
    row = found.select("nulls", F.left("low", prefix_length(F.col("low"), F.col("high"))).alias("prefix")).first()
    if row["prefix"] is None or row["nulls"] or len(row["prefix"]) < least:
        raise Refused("CONFIG_OUT_OF_BOUNDS", "no common template long enough")
    return row["prefix"]


def drop_prefix(df: DataFrame, field: str, prefix: str, expected: int | None = None) -> DataFrame:
    """Rows whose field doesn't begin with prefix; a null field stays. The removals must be as many as expected, or some."""
    gone = F.coalesce(F.col(field).startswith(prefix), F.lit(False))
    counts = df.agg(F.count_if(gone).alias("removed"), F.count("*").alias("n")).first()
    if counts["removed"] == counts["n"] or (counts["removed"] != expected if expected is not None else not counts["removed"]):
        raise Refused("CONFIG_OUT_OF_BOUNDS", "unexpected number of removals", removed=counts["removed"])
    return df.filter(~gone)


def holdout(df: DataFrame, fingerprint: str, order: str, fraction: float = 0.2) -> DataFrame:
    """df with column split: the first max(1, floor(n * fraction)) rows by fingerprint (small hex digits), then order, are
    validation, the rest train.

    The cut is one (fingerprint, order) value, found by counts in ranges that are narrowed until few rows are left; then
    rows are compared with it. Rows without a fingerprint or an order are train; rows equal in both go the same way."""
    n = df.count()
    if n < 2:
        raise Refused("DATASET_TOO_FEW_EXAMPLES")
    rows = df.select(F.col(fingerprint).alias("f"), F.col(order).alias("o")).filter("f is not null and o is not null")
    rows, k = around_rank(rows, F.conv(F.left("f", F.lit(15)), 16, 10).cast("long"), max(1, int(n * fraction)))
    rows, k = around_rank(rows, F.col("o"), k) if rows.limit(FEW + 1).count() > FEW else (rows, k)
    last = rows.orderBy("f", "o").limit(k).agg(F.max(F.struct("f", "o")).alias("last")).first()["last"]  # of at most FEW rows
    if last is None:
        return df.withColumn("split", F.lit("train"))
    f, o = F.col(fingerprint), F.col(order)
    first = (f < last["f"]) | ((f == last["f"]) & (o <= last["o"]))
    return df.withColumn("split", F.when(first, "validation").otherwise("train"))


def fitting_sample(df: DataFrame, fingerprint: str, tokens: str, ceiling: int, limit: int) -> DataFrame:
    """The first limit rows by fingerprint that have at most ceiling tokens, with skipped_long: longer rows before the last.

    Both steps are bounded sorts and aggregates."""
    chosen = df.filter(F.col(tokens) <= ceiling).orderBy(fingerprint).limit(limit)
    last = chosen.agg(F.max(fingerprint).alias("_last"), F.count("*").alias("_n"))
    full = F.col("_n") >= limit
    skipped = df.filter(F.col(tokens) > ceiling).crossJoin(F.broadcast(last)).filter(~full | (F.col(fingerprint) < F.col("_last")))  # last is one row
    return chosen.crossJoin(F.broadcast(skipped.agg(F.count("*").alias("skipped_long"))))
