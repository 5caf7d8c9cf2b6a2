"""N-gram Jaccard self-join: rare-first prefix filtering with length, positional and suffix filters.

A text's set is its distinct k-word shingles. Two texts link when PERCENT * |union| <= 100 * |intersection|.

1. Every set is hashed. Equal sets form a class, named by a 64-bit hash of the set, so that copies are never expanded into
   pairs. Chunks of documents send each distinct shingle's fingerprint, packed, to the shard that owns it: with the set that
   has it where only one of the chunk's sets does, else once as shared; so a shingle of many texts is one entry a
   chunk. Back comes how many of each set's shingles other sets have too. All further steps know classes by
   name only: a doc_id may be missing or stand at several texts.
2. Rare-first order puts shingles of one set alone first, so a set with a whole prefix of those can link with no
   other; the rest keep their sets. Parts of them ask the shards for the number of sets with each of their distinct
   shingles, to which each part adds one entry; ordered by it, then hash, the first n - ceil(t * n) + 1 are a set's
   prefix. With each goes the number of shingles after it in each of RANGES hash ranges.
3. Prefix shingles are joined. Pairs must pass the length filter, the positional filter, and the suffix filter: what both
   sets may share after the joined shingle is at most the sum of the lesser counts over the hash ranges. First each
   bucket is joined with its pivot only (the set with the fewest rarer shingles); then, in buckets that still hold more
   than one component, members outside the most frequent one are joined with those of other components, by those pairs
   of length and place alone that the filters let pass. So a large group of near copies gives as many pairs as it has
   members, and work grows with its size, not with the square. Each pair is verified once on the whole sets.

Nothing is capped: fingerprints only decide order and which sets may be left out safely; verification is on 64-bit
hashes. Defined results: a null or blank text has an empty set and is its own component; component_id is the
smallest doc_id of a component's rows; a row with a null doc_id takes part like any other and has the component_id of
its component, null if no row there has a doc_id; rows that share a doc_id stay, each with its own text (two components
may so have one component_id); an empty table gives no rows; columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_row, free_name, from_planes, mix, planes, shingles, slices, stored, text_bytes, words

#: Bytes of text in a chunk, and of text that one shard answers for; shingles in a part.
CHUNK_BYTES, SHARD_BYTES, PART_GRAMS = 4 << 20, 8 << 20, 250_000
#: Hash ranges of the suffix filter.
RANGES = 16
_REQUEST = "chunk long, shard int, places binary, sets binary, n binary, entries binary, many binary, doc_ids array<long>, names binary, sizes binary, known binary"
_ARROW = pa.schema([("chunk", pa.int64()), ("shard", pa.int32()), *((n, pa.binary()) for n in ("places", "sets", "n", "entries", "many")), ("doc_ids", pa.list_(pa.int64())), *((n, pa.binary()) for n in ("names", "sizes", "known"))])


def sets_of(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row of batch (with column text): hash and row, by row."""
    data, at = text_bytes(batch.column("text"))
    hashes, _, _, where = words(data, at)
    gram, row, _ = shingles(hashes, where, k)
    _, first = np.unique(mix(gram) ^ mix(row.astype(np.uint64) + np.uint64(7)), return_index=True)
    first.sort()
    return gram[first], row[first]


def _names(gram: np.ndarray, row: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Names of the sets with these shingles by row; size: how many each has."""
    name = np.zeros(len(size), np.uint64)
    np.add.at(name, row, mix(gram + np.uint64(99)))
    return mix(name + size.astype(np.uint64))


def _requests(chunk: int, shards: int, gram: np.ndarray, row: np.ndarray, doc_ids: list) -> pa.RecordBatch:
    """One row for each shard that owns any of the shingles; what is sent grows with the shingles, whatever the number of
    shards. The row of one shard also has all the chunk's documents.

    entries: shingles that one of the chunk's sets has alone, by set; places: steps between these sets' places among the
    chunk's, sets: their names, n: how many entries each has; many: shingles of several sets; known: how many of these
    each document's set has."""
    size = np.bincount(row, minlength=len(doc_ids))
    name = _names(gram, row, size)
    filled = np.flatnonzero(size)
    each, first, at = np.unique(name[filled], return_index=True, return_inverse=True)
    place_of = np.full(len(doc_ids), -1, np.int64)
    place_of[filled[first]] = np.arange(len(each))  # equal sets send once
    own = place_of[row] >= 0
    gram, place = gram[own], place_of[row[own]]
    value, number, times = np.unique(gram, return_inverse=True, return_counts=True)
    several = times[number] > 1
    known = np.zeros(len(doc_ids), np.int64)
    known[filled] = np.bincount(place[several], minlength=len(each))[at]
    del number, own, place_of
    short = lambda g: ((g // np.uint64(shards)) & np.uint64(0xFFFFFFFF)).astype("<u4")
    shard_of = lambda g: (g % np.uint64(shards)).astype(np.int64)
    many = value[times > 1]
    many_shard = shard_of(many)
    order = np.argsort(many_shard, kind="stable")
    many, many_shard = short(many[order]), many_shard[order]
    gram, place = gram[~several], place[~several]
    shard = shard_of(gram)
    order = np.lexsort((place, shard))
    entry, s, p = short(gram[order]), shard[order], place[order]
    opens = np.flatnonzero((np.diff(s, prepend=-1) != 0) | (np.diff(p, prepend=-1) != 0))
    edge = np.append(opens, len(s))
    s, p, n, home, rows = s[opens], p[opens], np.diff(edge), chunk % shards, []
    for own in np.union1d(np.union1d(s, many_shard), [home]).astype(int).tolist():
        (a, b), (c, d) = np.searchsorted(s, [own, own + 1]), np.searchsorted(many_shard, [own, own + 1])
        about = (doc_ids, name.astype("<u8").tobytes(), size.astype("<u4").tobytes(), known.astype("<u4").tobytes()) if own == home else (None,) * 4
        rows.append((chunk, own, np.diff(p[a:b], prepend=0).astype("<u4").tobytes(), each[p[a:b]].astype("<u8").tobytes(), n[a:b].astype("<u4").tobytes(), entry[edge[a] : edge[b]].tobytes(), many[c:d].tobytes(), *about))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def _count_shared(table: pa.Table) -> pa.Table:
    """A shard's answers: of each requested set's entries, how many any other set has too."""
    rows = table.to_pylist()
    read = lambda c, kind: np.concatenate([np.frombuffer(r[c], kind) for r in rows])
    per = read("n", "<u4").astype(np.int64)
    value, number = np.unique(read("entries", "<u4"), return_inverse=True)
    _, owner = np.unique(read("sets", "<u8"), return_inverse=True)
    pair = np.unique((number.astype(np.uint64) << np.uint64(32)) | np.repeat(owner.astype(np.uint64), per))
    shared = (np.bincount((pair >> np.uint64(32)).astype(np.int64), minlength=len(value)) > 1) | np.isin(value, read("many", "<u4"))
    found = np.add.reduceat(shared[number].astype(np.int64), np.cumsum(per) - per) if len(per) else per
    at, out = np.cumsum([0, *(len(r["n"]) // 4 for r in rows)]), []
    for r, a, b in zip(rows, at[:-1], at[1:]):
        out.append({"shared": found[a:b].astype("<u4").tobytes(), **{c: r[c] for c in ("chunk", "places", "doc_ids", "names", "sizes", "known")}})
    return pa.Table.from_pylist(out, pa.schema([_ARROW.field("chunk"), ("shared", pa.binary()), *(_ARROW.field(c) for c in ("places", "doc_ids", "names", "sizes", "known"))]))


def _gather(percent: int):
    def work(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own = next(r for r in rows if r["sizes"] is not None)
        name, n = np.frombuffer(own["names"], "<u8"), np.frombuffer(own["sizes"], "<u4").astype(np.int64)
        shared = np.frombuffer(own["known"], "<u4").astype(np.int64)
        each, at = np.unique(name[n > 0], return_inverse=True)
        others = np.zeros(len(each), np.int64)
        for r in rows:
            others[np.cumsum(np.frombuffer(r["places"], "<u4").astype(np.int64))] += np.frombuffer(r["shared"], "<u4")
        shared[n > 0] += others[at]
        return pa.table({"doc_id": pa.array(own["doc_ids"], pa.int64()), "n": n, "name": name.view("<i8"), "survives": (n > 0) & (n - shared < _prefix(n, percent))})

    return work


def _distinct(part: pa.Table, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a part's sets (grams): distinct shingles by owning shard, how many sets have each, each entry's place, the shards' edges."""
    gram, number, times = np.unique(part.column("grams").combine_chunks().flatten().to_numpy().view(np.uint64), return_inverse=True, return_counts=True)
    shard = (gram % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return gram[order], times[order], place[number], np.searchsorted(shard[order], np.arange(shards + 1))


def _ask_order(shards: int):
    schema = pa.schema([("part", pa.int64()), ("shard", pa.int64()), ("grams", pa.binary()), ("times", pa.binary())])

    def work(part: pa.Table) -> pa.Table:
        gram, times, _, edge = _distinct(part, shards)
        number = part.column("part")[0].as_py()
        rows = [(number, s, gram[edge[s] : edge[s + 1]].tobytes(), planes(times[edge[s] : edge[s + 1]], 4)) for s in np.flatnonzero(np.diff(edge)).tolist()]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return work


def _give_frequency(table: pa.Table) -> pa.Table:
    grams = [np.frombuffer(g.as_buffer(), "<u8") for g in table.column("grams")]
    value, number = np.unique(np.concatenate(grams), return_inverse=True)
    total = np.bincount(number, np.concatenate([from_planes(t.as_buffer(), 4) for t in table.column("times")]), len(value)).astype(np.int64)[number]
    edge = np.cumsum([0, *map(len, grams)])
    return pa.table({"part": table.column("part"), "shard": table.column("shard"), "counts": pa.array([planes(total[a:b], 5) for a, b in zip(edge[:-1], edge[1:])], pa.binary())})


_PREFIX = "gram long, id long, n long, place long, after array<int>"


def _prefixes(shards: int, percent: int):
    def work(part: pa.Table, answers: pa.Table) -> pa.Table:
        gram, _, at, _ = _distinct(part, shards)
        packed = answers.column("counts").combine_chunks()
        count = np.concatenate([from_planes(packed[i].as_buffer(), 5) for i in np.argsort(answers.column("shard").to_numpy()).tolist()]).astype(np.int64)[at]
        ids, n = part.column("id").to_numpy(), part.column("n").to_numpy()
        gram, doc = gram[at], np.repeat(np.arange(len(n)), n)
        order = np.lexsort((gram, count, doc))
        gram, count = gram[order], count[order]
        place = np.arange(len(doc)) - (np.cumsum(n) - n)[doc]
        range_ = (mix(gram) >> np.uint64(60)).astype(np.int64)
        every = np.bincount(doc * RANGES + range_, minlength=len(n) * RANGES).reshape(-1, RANGES)
        front = np.flatnonzero(place < _prefix(n, percent)[doc])
        seen = np.zeros((len(front) + 1, RANGES), np.int64)
        seen[np.arange(1, len(front) + 1), range_[front]] = 1
        seen = np.cumsum(seen, 0)
        opens = np.searchsorted(doc[front], np.arange(len(n)))
        after = every[doc[front]] - (seen[1:] - seen[opens[doc[front]]])
        keep = count[front] > 1  # a shingle of one set joins nothing
        front, after = front[keep], after[keep]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(front) + 1) * RANGES, pa.int32()), pa.array(after.ravel().astype(np.int32)))
        return pa.table({"gram": gram[front].view(np.int64), "id": ids[doc[front]], "n": n[doc[front]], "place": place[front], "after": lists})

    return work


def _links(a: Column, b: Column, both: Column, percent: int) -> Column:
    return 100 * both >= percent * (a + b - both)


def _prefix(n: np.ndarray, percent: int) -> np.ndarray:
    return n + -(n * percent // 100 + (n * percent % 100 > 0)) + 1


def components(edges: DataFrame) -> DataFrame:
    """id and label (smallest id reachable) of the ends of edges (a, b). Labels spread and jump until none changes."""
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("label")).withColumnRenamed("a", "id"), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near.withColumnRenamed("a", "id"), "id").select("id", "label", F.least("label", "near").alias("to"))
        jump = labels.select(F.col("id").alias("to"), F.col("label").alias("further"))
        moved = stored(spread.join(jump, "to", "left").select("id", F.least("to", F.coalesce("further", "to")).alias("new"), "label"), "labels")
        labels = moved.select("id", F.col("new").alias("label"))
        if not moved.filter("new <> label").limit(1).count():
            return labels


def _components_of(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Per document of docs (doc_id, text): doc_id, n (shingles), name (of its set), component_id and first: the name of
    the set that comes first among those of the component that a row with its smallest doc_id has."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    shards = max(1, -(-size // SHARD_BYTES))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, grams, rows, ids, seen = TaskContext.get().partitionId() << 32, [], [], [], 0
        for batch in slices(batches):
            g, r = sets_of(batch, k)
            grams.append(g)
            rows.append(r + len(ids))
            ids += batch.column(0).to_pylist()
            seen += batch.column("text").nbytes
            if seen >= CHUNK_BYTES or len(ids) >= CHUNK_BYTES:
                yield _requests(chunk, shards, np.concatenate(grams), np.concatenate(rows), ids)
                chunk, grams, rows, ids, seen = chunk + 1, [], [], [], 0
        if ids:
            yield _requests(chunk, shards, np.concatenate(grams), np.concatenate(rows), ids)

    info = docs.mapInArrow(ask, _REQUEST).groupBy("shard").applyInArrow(_count_shared, "chunk long, shared binary, places binary, doc_ids array<long>, names binary, sizes binary, known binary")
    info = stored(info.groupBy("chunk").applyInArrow(_gather(percent), "doc_id long, n long, name long, survives boolean"), "sets")
    classes = info.filter("n > 0").groupBy("name").agg(F.min("doc_id").alias("rep"), F.max("survives").alias("survives"))
    kept = classes.filter("survives").select("name", "rep")

    def whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            g, r = sets_of(batch, k)
            order = np.lexsort((g, r))
            g, at = g[order], np.searchsorted(r, np.arange(batch.num_rows + 1))
            arrays = [pa.array(_names(g, r[order], np.diff(at)).view(np.int64)), pa.array(np.diff(at)), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(g.view(np.int64)))]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n", "grams"])

    # A class's text stands at its smallest doc_id, perhaps beside others, or at rows without one; of equal sets any one is taken.
    # Joined by sorting at every size, so that a small table shows the costs of a large one.
    some = docs.join(kept.filter("rep is not null").select(F.col("rep").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi").unionByName(docs.filter("doc_id is null"))
    full = some.select("text").mapInArrow(whole_sets, "id long, n long, grams array<long>").dropDuplicates(["id"])
    sets = stored(full.join(kept.select(F.col("name").alias("id")), "id", "left_semi"), "whole-sets")

    parts = max(1, -(-(sets.agg(F.sum("n").alias("n")).first()["n"] or 0) // PART_GRAMS))
    dealt = sets.withColumn("part", F.pmod("id", F.lit(parts)))
    answered = dealt.groupBy("part").applyInArrow(_ask_order(shards), "part long, shard long, grams binary, times binary").groupBy("shard").applyInArrow(_give_frequency, "part long, shard long, counts binary")
    prefix = stored(dealt.groupBy("part").cogroup(answered.groupBy("part")).applyInArrow(_prefixes(shards, percent), _PREFIX), "prefixes")

    def possible(x: str, y: str) -> Column:
        """By lengths and by the places of the first shared shingle."""
        n, place, other_n, other_place = F.col(f"{x}n"), F.col(f"{x}place"), F.col(f"{y}n"), F.col(f"{y}place")
        most = F.least(n - place, other_n - other_place)  # what may be shared from there on
        return (100 * F.least(n, other_n) >= percent * F.greatest(n, other_n)) & _links(n, other_n, most, percent)

    def suffix(x: str, y: str) -> Column:
        both = F.aggregate(F.zip_with(f"{x}after", f"{y}after", lambda p, q: F.least(p, q)), F.lit(1), lambda s, c: s + c)
        return _links(F.col(f"{x}n"), F.col(f"{y}n"), both, percent)

    def verified(pairs: DataFrame) -> DataFrame:
        x = sets.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("grams").alias("grams_a"))
        y = sets.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("grams").alias("grams_b"))
        both = F.size(F.array_intersect("grams_a", "grams_b"))
        return pairs.join(x.hint("merge"), "a").join(y.hint("merge"), "b").filter(_links(F.col("n_a"), F.col("n_b"), both, percent)).select("a", "b")

    # Aggregates are stored before they are joined with what they were made of, so that Spark can split a hot bucket in the join.
    pivots = prefix.groupBy("gram").agg(F.min(F.struct("place", "n", "id", "after")).alias("pivot"), F.count("*").alias("members")).filter("members > 1")
    pivots = stored(pivots.select("gram", *(F.col(f"pivot.{c}").alias(f"pivot_{c}") for c in ("id", "n", "place", "after"))), "pivots")
    star = prefix.join(pivots, "gram").filter((F.col("id") != F.col("pivot_id")) & possible("", "pivot_")).filter(suffix("", "pivot_"))
    star = stored(star.select(F.least("id", "pivot_id").alias("a"), F.greatest("id", "pivot_id").alias("b")).distinct(), "pairs")
    links = stored(verified(star), "links")
    labels = components(links)

    left = stored(prefix.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id")), "labelled")
    # Only members outside a bucket's most frequent component are joined with the others, so a large component never meets itself.
    sizes = left.groupBy("gram", "label").agg(F.count("*").alias("members"))
    main = sizes.groupBy("gram").agg(F.max(F.struct("members", "label"))["label"].alias("main"), F.count("*").alias("labels")).filter("labels > 1")
    main = stored(main.select("gram", "main"), "main")
    mixed = stored(left.join(main, "gram"), "mixed")
    # Pairs of length and place that may link, by bands of length of which only neighbours can.
    band = F.floor(F.log("n") / (1.001 * math.log(100 / percent))) if percent < 100 else F.col("n")
    cells = mixed.groupBy("gram", "n", "place").agg(F.max(F.col("label") != F.col("main")).alias("odd")).withColumn("band", band.cast("long"))
    x = cells.filter("odd").select("gram", "band", "n", "place")
    y = cells.select("gram", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"), F.col("n").alias("y_n"), F.col("place").alias("y_place"))
    met = stored(x.join(y, ["gram", "band"]).filter(possible("", "y_")).select("gram", "n", "place", "y_n", "y_place"), "cells")
    odd = mixed.filter("label <> main").select("gram", "n", "place", "id", "label", "after").join(met, ["gram", "n", "place"])
    others = mixed.select("gram", *(F.col(c).alias(f"y_{c}") for c in ("n", "place", "id", "label", "after")))
    rest = stored(odd, "odd").join(others, ["gram", "y_n", "y_place"]).filter("label <> y_label").filter(suffix("", "y_"))
    rest = rest.select(F.least("id", "y_id").alias("a"), F.greatest("id", "y_id").alias("b")).distinct().join(star, ["a", "b"], "left_anti")
    more = stored(verified(rest), "links")
    if more.limit(1).count():
        labels = components(links.unionByName(more))
    linked = labels.withColumnRenamed("id", "name").join(classes.select("name", "rep"), "name")
    tops = linked.groupBy("label").agg(F.min(F.when(F.col("rep").isNotNull(), F.struct("rep", "name"))).alias("top"))
    found = stored(labels.join(tops, "label").select(F.col("id").alias("name"), F.col("top.rep").alias("component"), F.col("top.name").alias("first"), F.lit(True).alias("linked")), "found")
    found = classes.select("name", "rep").join(found, "name", "left")
    found = found.select("name", F.when(F.col("linked"), F.col("component")).otherwise(F.col("rep")).alias("component"), F.when(F.col("linked"), F.col("first")).otherwise(F.col("name")).alias("first"))
    out = info.join(stored(found, "components"), "name", "left")
    return out.select("doc_id", "n", "name", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"), "first")


def jaccard_classes(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """Per document of docs (doc_id, text): doc_id, n_shingles, component_id."""
    return _components_of(docs, k, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def without_copies(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """docs with one row of each component: the smallest doc_id, then the first set's name, then the smallest text and
    other columns. Rows without a doc_id or without words are nobody's copy."""
    rows = _components_of(docs.select("doc_id", "text"), k, percent).filter("doc_id is not null")
    rows = rows.withColumn("stays", (F.col("n") == 0) | (F.col("doc_id") == F.col("component_id")) & (F.col("name") == F.col("first")))
    by_id = rows.groupBy("doc_id").agg(F.count("*").alias("of"), F.count_if("stays").alias("stay")).filter("stay = 0 or of > 1")
    id_ = free_name(docs, "_id")
    by_id = stored(by_id.select(F.col("doc_id").alias(id_), (F.col("stay") > 0).alias("some")), "copies")
    key = F.col("doc_id").cast("long")
    out = docs.join(by_id.select(id_), key == F.col(id_), "left_anti")
    some = by_id.filter("some").select(id_)
    if not some.limit(1).count():
        return out

    def with_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            g, r = sets_of(batch, k)
            size = np.bincount(r, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_names(g, r, size).view(np.int64)), pa.array(size), batch.column("row")], ["doc_id", "name", "n", "row"])

    # Rows that share a doc_id are told apart by their sets' names.
    several = docs.join(some, key == F.col(id_), "left_semi").select(key.alias("doc_id"), F.col("text").cast("string").alias("text"), as_row(docs))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("name", T.LongType()), T.StructField("n", T.LongType()), several.schema["row"]])
    several = several.mapInArrow(with_names, schema)
    first = several.filter("n > 0").join(rows.filter("stays and n > 0").select("doc_id", "name").distinct(), ["doc_id", "name"], "left_semi")
    first = first.groupBy("doc_id", "name").agg(F.min_by("row", F.struct("row.text", F.to_json("row"))).alias("row"))
    return out.unionByName(several.filter("n = 0").select("row.*")).unionByName(first.select("row.*"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 90 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS id, a AS label FROM e UNION SELECT e.b, r.label FROM r JOIN e ON e.a = r.id)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, coalesce(min(r.label), d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN r ON r.id = d.doc_id GROUP BY d.doc_id
"""
