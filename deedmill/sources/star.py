"""Transactions derived from a star schema of orders (lineitem, orders, customer, part, supplier, nation).

The expressions are plain SQL, so the same text can be run on another engine to check results.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

CITY_NAME = (
    "CASE {r} WHEN 0 THEN 'Mumbai' WHEN 1 THEN 'Pune' WHEN 2 THEN 'Thane' WHEN 3 THEN 'Dubai' ELSE 'Nagpur' END"
)
RAW_TYPE = (
    "CASE p_type WHEN 'STANDARD' THEN ' flat ' WHEN 'SMALL' THEN 'APARTMENT' WHEN 'LARGE' THEN 'Shop' "
    "WHEN 'PROMO' THEN 'Office' WHEN 'MEDIUM' THEN 'Row_House' ELSE NULL END"
)
RAW_BHK = (
    "CASE p_type WHEN 'LARGE' THEN 'shop' WHEN 'PROMO' THEN 'Office' WHEN 'ECONOMY' THEN NULL ELSE "
    "CASE p_size % 6 WHEN 0 THEN '1bhk ' WHEN 1 THEN '2 BHK' WHEN 2 THEN '1.5 bhk' WHEN 3 THEN '3BHK' "
    "WHEN 4 THEN 'studio' ELSE '4 bhk' END END"
)

EXPRESSIONS = {
    "document_no": "concat(CAST(l_orderkey AS STRING),'-',CAST(l_linenumber AS STRING),'-',"
    "CAST(l_partkey AS STRING),'-',CAST(l_suppkey AS STRING))",
    "index": "l_suppkey + 1",
    "city_id": "n_regionkey + 1",
    "city": CITY_NAME.format(r="n_regionkey"),
    "loc_id": "CASE WHEN s_suppkey % 23 = 0 THEN NULL ELSE n_nationkey + 1 END",
    "location_id": "n_nationkey + 1",
    "location": "n_name",
    "location_lat": "CAST(10 + n_nationkey AS DOUBLE)",
    "location_lng": "CAST(70 + n_nationkey AS DOUBLE)",
    "proj_id": "CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_suppkey + 1 END",
    "project_name": "s_name",
    "project_lat": "CAST(10 + l_suppkey % 7 AS DOUBLE) + CAST(0.5 AS DOUBLE)",
    "project_lng": "CAST(70 + l_suppkey % 9 AS DOUBLE) + CAST(0.5 AS DOUBLE)",
    "manual_processed": "CASE WHEN l_linenumber % 4 = 0 THEN 'No' ELSE 'Yes' END",
    "property_category": "CASE WHEN l_returnflag='R' AND l_linestatus='O' THEN 'Lease' "
    "WHEN l_returnflag='R' THEN 'Other' ELSE 'Sale' END",
    "transaction_type": "CASE WHEN o_orderpriority='1-URGENT' THEN 'Development Agreement' "
    "ELSE 'Agreement To Sale' END",
    "property_type": "CASE p_type WHEN 'STANDARD' THEN 'Flat' WHEN 'SMALL' THEN 'Apartment' WHEN 'LARGE' THEN 'Shop' "
    "WHEN 'PROMO' THEN 'Office' WHEN 'MEDIUM' THEN 'Row_House' ELSE 'Others' END",
    "property_type_raw": RAW_TYPE,
    "bhk_br": RAW_BHK,
    "net_carpet_area_sqmt": "CASE WHEN l_quantity < 2 THEN CAST(0 AS DOUBLE) WHEN l_quantity = 50 THEN NULL "
    "ELSE l_quantity * CAST(4 AS DOUBLE) END",
    "agreement_price": "CASE WHEN l_partkey % 97 = 0 THEN 'NA' "
    "ELSE CAST(CAST(floor(l_extendedprice * 150) AS BIGINT) AS STRING) END",
    "floor_no": "CASE l_linenumber WHEN 1 THEN 'Ground' WHEN 2 THEN 'Terrace' WHEN 3 THEN '4 & 5' "
    "ELSE CAST(p_size % 24 AS STRING) END",
    "purchaser_name": "concat('1) नाव:-', c_name, ' वय:-', CAST(18 + c_custkey % 60 AS STRING), ' पत्ता:-x', "
    "CASE WHEN o_orderkey % 3 = 0 THEN concat(' 2) नाव:-B वय:-', CAST(20 + o_orderkey % 50 AS STRING), "
    "' पत्ता:-y') ELSE '' END)",
    "project_type": "CASE WHEN l_linenumber % 3 = 0 THEN '' WHEN l_linenumber % 5 = 0 THEN NULL "
    "WHEN p_type IN ('LARGE','PROMO') THEN 'Commercial' ELSE 'Residential' END",
    "buyer_pincode": "CASE WHEN c_custkey % 29 = 0 THEN 'N/A' ELSE CAST(400001 + c_nationkey AS STRING) END",
    "transaction_date": "CAST(o_orderdate AS DATE)",
    "year": "CAST(year(o_orderdate) AS INT)",
    "quarter": "concat(CAST(year(o_orderdate) AS STRING),'-Q',CAST(quarter(o_orderdate) AS STRING))",
}

# Dimension, join condition, prefix of its columns, dimension it hangs on.
_DIMENSIONS = [
    ("orders", "l_orderkey = o_orderkey", "o", None),
    ("customer", "o_custkey = c_custkey", "c", "orders"),
    ("part", "l_partkey = p_partkey", "p", None),
    ("supplier", "l_suppkey = s_suppkey", "s", None),
    ("nation", "s_nationkey = n_nationkey", "n", "supplier"),
]

BHK_LABELS = {
    "1 bhk": "1Br",
    "1bhk": "1Br",
    "1.5 Bhk": "1.5Br",
    "2 bhk": "2Br",
    "3bhk": "3Br",
    "4 Bhk": ">3Br",
    "Studio": "<1Br",
    "Shop": "Shop",
    "Office": "Office",
}
PROPERTY_LABELS = {
    "Flat": "Flat",
    "Apartment": "Flat",
    "Row_House": "Row House",
    "Shop": "Shop",
    "Office": "Office",
    "Others": "Others",
}


def _needed(columns: Iterable[str] | None) -> tuple[dict[str, str], list[tuple[str, str]]]:
    """Expressions of the columns and the (dimension, condition) joins they need.

    Every key of lineitem has its match, so leaving a join out keeps the rows.
    """
    chosen = {c: EXPRESSIONS[c] for c in (columns or EXPRESSIONS)}
    tables = set()
    for name, _, prefix, parent in reversed(_DIMENSIONS):
        if name in tables or any(re.search(rf"\b{prefix}_\w", e) for e in chosen.values()):
            tables |= {name, parent}
    return chosen, [(name, on) for name, on, _, _ in _DIMENSIONS if name in tables]


def transactions_sql(columns: Iterable[str] | None = None, table: str = "{}", quote: str = '"') -> str:
    """SELECT that derives the given columns. ``table`` tells how a table name is written."""
    chosen, joins = _needed(columns)
    fields = ",\n  ".join(f"{e} AS {quote}{c}{quote}" for c, e in chosen.items())
    lines = [f"JOIN {table.format(name)} ON {on}" for name, on in joins]
    return f"SELECT\n  {fields}\nFROM {table.format('lineitem')}\n" + "\n".join(lines)


def transactions(spark: SparkSession, directory: str, columns: Iterable[str] | None = None) -> DataFrame:
    """The derived transactions over the Parquet tables of ``directory``."""
    chosen, joins = _needed(columns)
    text = " ".join([*chosen.values(), *[on for _, on in joins]])
    facts = dict.fromkeys(re.findall(r"\bl_\w+", text))
    frames = {name: _table(spark, directory, name) for name, _ in joins}
    frames["lineitem"] = _table(spark, directory, "lineitem").select(*facts)
    return spark.sql(transactions_sql(columns, "{{{}}}", "`"), **frames)


def _table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def cities(spark: SparkSession, directory: str) -> DataFrame:
    """City dimension: one city per region."""
    return spark.read.parquet(f"{directory}/region.parquet").selectExpr(
        "CAST(r_regionkey + 1 AS INT) AS city_id", f"{CITY_NAME.format(r='r_regionkey')} AS city_name"
    )
