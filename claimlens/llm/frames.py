"""Small Spark helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.functions.checkpoints import materialize, work_folder

from .words import release

Batches = Iterator[pa.RecordBatch]
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back.

    The files are compressed and columnar, later reads prune columns, and a lost
    executor costs a re-read only.
    """
    path = f"{work_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``stored`` that no plan reads any more."""
    for table in tables:
        remove_folder(table.sparkSession, table.stored_at)


def text_of(column: str = "text") -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def arrow_map(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``work`` on every record batch, without a shuffle; a task gives its memory back."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            out = work(batch)
            if out is not None:
                yield out
        release()

    return df.mapInArrow(run, schema)


@contextmanager
def small_batches(spark: SparkSession, size: int = 4 << 20) -> Iterator[None]:
    """Record batches of about ``size`` bytes for the jobs run inside: each is held by the executor and by its worker, outside the heap."""
    before = spark.conf.get(BATCH_BYTES, None)
    spark.conf.set(BATCH_BYTES, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_BYTES)
        else:
            spark.conf.set(BATCH_BYTES, before)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


__all__ = ["arrow_map", "discard", "free_name", "materialize", "remove_folder", "shuffle_width", "small_batches", "stored", "text_of", "work_folder"]
