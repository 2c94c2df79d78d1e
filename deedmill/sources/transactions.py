"""Reading transactions, city by city or all at once."""

from __future__ import annotations

import warnings
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedmill.config import EXPECTED_COLUMNS


def list_cities(cities: DataFrame) -> DataFrame:
    """The known cities by name."""
    return cities.select("city_id", "city_name").orderBy("city_name")


def load_transactions(table: DataFrame, cities: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """Transactions of the named cities (all if None), tagged with ``city``.

    One scan serves all cities. The city dimension is filtered first and joined, so a table
    partitioned by city_id is pruned to the cities asked for.
    """
    table = table.toDF(*[c.lower() for c in table.columns])
    missing = [c for c in EXPECTED_COLUMNS if c not in table.columns]
    if missing:
        warnings.warn(f"missing columns: {missing}", stacklevel=2)
    wanted = cities.select("city_id", F.col("city_name").alias("city"))
    if names is not None:
        wanted = wanted.filter(F.col("city").isin(list(names)))
    return table.drop("city").join(wanted, "city_id")


def range_predicates(column: str, low: int, high: int, slices: int) -> list[str]:
    """Conditions that split all values of a column at equal steps from low to high; the ends are open, null is in the first."""
    cuts = sorted({low + (high - low) * i // slices for i in range(1, slices)})
    if not cuts:
        return ["1 = 1"]
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"({column} < {cuts[0]} OR {column} IS NULL)", *between, f"{column} >= {cuts[-1]}"]


def read_jdbc(
    spark: SparkSession, url: str, table: str, city_ids: Iterable[int], column: str, low: int, high: int, slices: int = 16, **options: str
) -> DataFrame:
    """Transactions from a relational database, ``slices`` queries per city.

    Each query takes one city and one range of ``column``, which should be indexed together with
    the city; ``low`` and ``high`` are about its ends. So a big city is neither read through a single
    connection nor scanned once for each slice. ``table`` and ``column`` must be plain, trusted names.
    """
    ranges = range_predicates(column, low, high, slices)
    predicates = [f"city_id = {int(c)} AND {r}" for c in city_ids for r in ranges]
    return spark.read.jdbc(url, table, predicates=predicates, properties={k: str(v) for k, v in options.items()})
