"""Tables in the folder that driver and executors share (as in llm/common.py, which may be missing)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Bytes of rows that a Python function or sink gets at once, beside one longer row.
ARROW_BYTES = 4 << 20
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, limit: int = ARROW_BYTES) -> Iterator[None]:
    """While a job runs, its Arrow batches are bounded by bytes, as Spark's bound on their rows leaves long ones as large as they are."""
    old = spark.conf.get(_BYTES)
    spark.conf.set(_BYTES, limit)
    try:
        yield
    finally:
        spark.conf.set(_BYTES, old)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, set here only where it is unset in a local session."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        sc = spark.sparkContext
        if sc.getCheckpointDir() is None:
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            sc.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared")
        where = sc.getCheckpointDir()
    return where.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it again: it is computed once, and lost executors cost their own tasks."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
