"""Bounded selection over a stream, with the least rows as keyed state.

A row's rank depends on its content alone and the k least of a union are the k least of the parts' k least. So each task hands on
the k least rows that it read, these are dealt into PARTS keys by the last digits of their rank, each key's state holds its k least
rows, and reading the selection merges at most k rows a key. State is written by changelog into the query's checkpoint: a batch that runs again, or a query that is started
again, goes on from the committed state, and neither repeats nor loses a row. Rows count as often as they come, as in the batch selection.

Rows are kept as JSON text of their columns; what JSON text doesn't hold exactly (timestamps beyond milliseconds) is cut there."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..codes import Refused
from ..operators.selection import with_identity

PARTS = 64
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_KEPT = "rank string, identity string, row string"


class Least(StatefulProcessor):
    """Keeps the count rows of least (rank, identity) of each key."""

    def __init__(self, count: int) -> None:
        self.count = count

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getListState("kept", _KEPT)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803  names of the interface
        before = [tuple(x) for x in self.kept.get()] if self.kept.exists() else []
        least = before
        for frame in rows:
            least = sorted([*least, *frame[["rank", "identity", "row"]].itertuples(index=False, name=None)])[: self.count]
        if least != before:
            self.kept.put(least)
        yield pd.DataFrame({"part": [key[0]], "kept": [len(least)]})

    def close(self) -> None:
        pass


def least_of_task(count: int):
    """An Arrow function that hands on the count least rows (rank, identity, row) of a task, as they are ordered by Least."""
    order = [("rank", "ascending"), ("identity", "ascending"), ("row", "ascending")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            both = pa.Table.from_batches([batch] if kept is None else [*kept.to_batches(), batch])
            kept = both.take(pc.sort_indices(both, sort_keys=order)[:count]).combine_chunks()
        if kept is not None:
            yield from kept.to_batches()

    return work


def stream_bounded(stream: DataFrame, checkpoint: str, count: int, salt: str, identity_field: str, key_fields: Sequence[str], parts: int = PARTS) -> StreamingQuery:
    """Start a query over what the stream has now; selected() reads its selection, between and after runs."""
    if count <= 0:
        raise Refused("CONFIG_OUT_OF_BOUNDS", "count must be positive")
    spark = stream.sparkSession
    ranked = with_identity(stream, salt, identity_field, key_fields)
    part = (F.conv(F.right("rank", F.lit(8)), 16, 10).cast("long") % parts).cast("int").alias("part")
    rows = ranked.select(part, "rank", "identity", F.to_json(F.struct(*stream.columns), {"ignoreNullFields": "false"}).alias("row"))
    rows = rows.mapInArrow(least_of_task(count), rows.schema)
    kept = rows.groupBy("part").transformWithStateInPandas(Least(count), "part int, kept long", "Update", "None")
    old = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)  # the query takes the setting when it starts
    try:
        return kept.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(_PROVIDER, old)


def selected(spark: SparkSession, checkpoint: str, count: int, schema: T.StructType) -> DataFrame:
    """The count rows of least (rank, identity) of all that the query at checkpoint has taken in, in that order; schema: the
    stream's."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "kept").load().select("list_element.*")
    least = state.orderBy("rank", "identity").limit(count)
    return least.select(F.from_json("row", schema).alias("r"), "identity", "rank").select("r.*", "identity", "rank")
