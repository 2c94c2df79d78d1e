"""Where buyers come from."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from deedmill.functions import exact
from deedmill.functions.values import round2
from deedmill.operators.levels import GRAINS, LEVEL_KEY, LEVELS, PERIOD_KEY, Level, by_grain, by_target, masks, period_columns, with_targets


def _by_pincode(df: DataFrame, levels: Iterable[Level], grains: Iterable[str] = GRAINS) -> DataFrame:
    """Documents and price per pincode and period; the null pincode is a row of its own."""
    pincode = F.col("buyer_pincode").cast("bigint").alias("pincode")
    # Counted once for all levels, then spread over them.
    fine = (
        with_targets(df, levels)
        .groupBy("city", "_targets", *period_columns(grains), pincode)
        .agg(F.count(F.lit(1)).alias("n"), *exact.sums("price", F.col("agreement_price")))
    )
    return by_grain(by_target(fine), grains).groupBy(*PERIOD_KEY, "pincode").agg(F.sum("n").alias("n"), *exact.merged("price"))


def pincode_stats(df: DataFrame, levels: Iterable[Level] = LEVELS, grains: Iterable[str] = GRAINS) -> DataFrame:
    """Priced documents per pincode: count, share, total and mean.

    The share is of all priced documents, also those without pincode. Totals are added up from the
    pincodes' counts and joined to them.
    """
    return _with_shares(_by_pincode(df.filter(masks()["valid_price"]), levels, grains))


def counted_pincodes(rows: DataFrame, grains: Iterable[str] = GRAINS) -> DataFrame:
    """`pincode_stats` of rows that have their level and key, counted before they are shuffled."""
    fine = _priced(rows, grains).groupBy(*LEVEL_KEY, *period_columns(grains), "pincode").agg(F.sum("n").alias("n"), *exact.merged("price"))
    return _with_shares(by_grain(fine, grains).groupBy(*PERIOD_KEY, "pincode").agg(F.sum("n").alias("n"), *exact.merged("price")))


def _with_shares(rows: DataFrame) -> DataFrame:
    totals = rows.groupBy(*PERIOD_KEY).agg(F.sum("n").alias("_total")).toDF(*[f"_k_{c}" for c in PERIOD_KEY], "_total")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in PERIOD_KEY])
    return _pincode_shares(rows.join(totals, same))


def _pincode_shares(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("pincode").isNotNull()).select(
        *PERIOD_KEY,
        "pincode",
        F.col("n").alias("no_of_transactions"),
        round2(F.col("n") / F.col("_total") * 100).alias("pct_of_total_transactions"),
        exact.rounded("price").alias("total_agreement_price"),
        round2(exact.mean("price", "n")).alias("avg_agreement_price"),
    )


def pincodes_in_place(rows: DataFrame, grains: Iterable[str] = GRAINS) -> DataFrame:
    """`pincode_stats` of rows that have their level and key, and each key of which is in one part."""
    rows = by_grain(_priced(rows, grains), grains)
    counted = rows.groupBy(*PERIOD_KEY, "pincode").agg(F.sum("n").alias("n"), *exact.merged("price"))
    return _pincode_shares(counted.withColumn("_total", F.sum("n").over(W.partitionBy(*PERIOD_KEY))))


def _priced(rows: DataFrame, grains: Iterable[str]) -> DataFrame:
    pincode, price = F.col("buyer_pincode").cast("bigint").alias("pincode"), exact.halves("price", F.col("agreement_price"))
    one = F.lit(1).cast("bigint").alias("n")
    return rows.filter(masks()["valid_price"]).select(*LEVEL_KEY, *period_columns(grains), pincode, one, *price)


def top_pincodes(df: DataFrame, k: int = 10, levels: Iterable[Level] = LEVELS) -> DataFrame:
    """The k most frequent pincodes of every key; ties go to the smaller pincode."""
    rows = _by_pincode(df, levels).filter(F.col("pincode").isNotNull())
    order = W.partitionBy(*PERIOD_KEY).orderBy(F.desc("n"), F.asc("pincode"))
    return (
        rows.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select(*PERIOD_KEY, "pincode", F.col("n").alias("count"), "rank")
    )
