"""Lookup sheets: raw label -> standard label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedmill.functions.values import strip, title


def read_label_sheet(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """A two-column CSV sheet with header, cleaned by :func:`clean_label_map`.

    The path may be a folder: its files count in order of their names.
    """
    sheet = spark.read.csv(path, header=True).select(
        key, value, F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()).alias("row")
    )
    return clean_label_map(sheet, key, value, "row")


def clean_label_map(sheet: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Trimmed title-case pairs, one per key.

    Repeated pairs count at their first row; of several values of a key the last one stays.
    """
    pairs = (
        sheet.select(title(strip(F.col(key))).alias(key), title(strip(F.col(value))).alias(value), order)
        .filter(F.col(key).isNotNull())
        .groupBy(key, value)
        .agg(F.min(order).alias(order))
    )
    return pairs.groupBy(key).agg(F.max_by(value, order).alias(value))
