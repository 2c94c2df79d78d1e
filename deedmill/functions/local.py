"""Small driver-side tables as local relations.

A local relation carries its true size, so the planner itself decides whether a join with it is
broadcast; no hint is needed and none is given.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def local_table(spark: SparkSession, columns: dict[str, list], types: dict[str, pa.DataType]) -> DataFrame:
    arrays = [pa.array(columns[name], types[name]) for name in columns]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=list(columns)))
