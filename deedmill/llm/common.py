"""Helpers that the operators of this folder share."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id as long and text as string; other columns, whatever their names, are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def map_batches(frame: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType) -> DataFrame:
    """One result batch for each Arrow batch of `frame`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield function(batch)

    return frame.mapInArrow(run, schema)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. A local session without one gets a temporary folder; a cluster must name one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="deedmill-"))
    return context.getCheckpointDir()


#: Whether Spark removes an execution's shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is executed in this block leaves no shuffle files; otherwise they stay until the driver's memory is collected."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def checkpoint(frame: DataFrame) -> DataFrame:
    """Write `frame` to the shared folder and go on from there, so that a lost executor costs only its own tasks.

    The shuffle files that led there are removed, so a chain of steps takes the disk of its largest one and not of all.
    """
    shared_folder(frame.sparkSession)
    with shuffles_removed(frame.sparkSession):
        # A selection is planned anew, under the setting.
        return frame.select("*").checkpoint()
