"""Numbers for composite keys.

Reports are counted by one number per key. A level with several key columns, or with columns that are no numbers,
gets one that keeps the order of its keys: the key's rank among all distinct ones. Keys are ranked in sorted ranges,
each of which one task counts, so their number may be as large as it likes. Rows get their key's number by a join,
and results get the key columns back by another.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from deedmill.operators.levels import Level
from deedmill.operators.percentiles import Keep


def ranked_keys(df: DataFrame, columns: list[str], number: str, keep: Keep) -> DataFrame:
    """Each distinct key of `columns` without nulls, and its rank from 1 as the bigint column `number`."""
    whole = reduce(and_, [F.col(c).isNotNull() for c in columns])
    keys = df.filter(whole).select(*columns).distinct().repartitionByRange(*columns).sortWithinPartitions(*columns)
    # Staged, so that each key keeps its part and place whatever is computed again.
    placed = keep(keys.select(*columns, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), f"keys-{number}")
    parts = placed.groupBy("_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # One row for each part.
    before = F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(F.col("_part").alias("_p"), (before - F.col("_first") + 1).alias("_shift"))
    joined = placed.join(parts, F.col("_part") == F.col("_p"))
    return joined.select(*columns, (F.col("_at") + F.col("_shift")).cast("bigint").alias(number))


def number_keys(df: DataFrame, levels: Iterable[Level], keep: Keep) -> tuple[DataFrame, dict[str, DataFrame]]:
    """`df` with a number column for each composite level, and the levels' numbered keys by name.

    Rows with a null in a key column get no number and belong to no key of that level. `keep` stages the keys.
    """
    numbered = {}
    for level in levels:
        if level.composite:
            columns = list(level.columns)
            numbered[level.name] = keys = keep(ranked_keys(df, columns, level.number, keep), f"numbers-{level.name}")
            side = keys.toDF(*[f"_k_{c}" for c in columns], level.number)
            df = df.join(side, reduce(and_, [F.col(c) == F.col(f"_k_{c}") for c in columns]), "left").drop(*[f"_k_{c}" for c in columns])
    return df, numbered


def with_key_columns(result: DataFrame, level: Level, numbered: dict[str, DataFrame]) -> DataFrame:
    """A result of one level with its key columns beside `key_id`."""
    if not level.composite:
        return result.withColumn(level.columns[0], F.col("key_id"))
    keys = numbered[level.name].withColumnRenamed(level.number, "_key_id")
    return result.join(keys, F.col("key_id") == F.col("_key_id")).drop("_key_id")
