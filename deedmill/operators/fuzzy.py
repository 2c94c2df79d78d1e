"""Untidy property types matched to the closest known label, in column expressions.

Labels are scored by their longest common subsequence with each known label. It is found bit by bit:
a known label's characters are bits of a number, and each character of the other label updates all
of them in one addition. Numbers hold 32 bits, a longer label takes several.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedmill.functions.local import local_table

FALLBACK = "Others"
BITS, ONES = 32, (1 << 32) - 1
# Known labels that an unknown one meets at a time.
BLOCK = 500


def known_labels(labels: DataFrame, key: str) -> DataFrame:
    """The labels of a lookup sheet, in their own order."""
    return labels.filter(F.col(key).isNotNull()).select(F.col(key).alias("label"), F.col(key).alias("position")).distinct()


def _sorted_words(c: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")), " ")


def _characters(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0))


def _bit_maps(characters: Column) -> Column:
    """For every 32 characters, a map from a character to the bits of its places."""

    def bits(part: Column) -> Column:
        places = F.transform(part, lambda c, i: F.struct(c.alias("c"), F.call_function("shiftleft", F.lit(1).cast("bigint"), i).alias("bit")))
        return F.map_from_entries(
            F.transform(
                F.array_distinct(part),
                lambda c: F.struct(
                    c, F.aggregate(places, F.lit(0).cast("bigint"), lambda all_, p: F.when(p["c"] == c, all_.bitwiseOR(p["bit"])).otherwise(all_))
                ),
            )
        )

    starts = F.filter(F.sequence(F.lit(0), F.size(characters)), lambda i: (i % BITS == 0) & (i < F.size(characters)))
    return F.transform(starts, lambda i: bits(F.slice(characters, i + 1, F.lit(BITS))))


def _common(characters: Column, maps: Column) -> Column:
    """Length of the longest common subsequence: places whose bit is cleared at the end."""
    start = F.transform(maps, lambda _: F.lit(ONES))

    def step(state: Column, c: Column) -> Column:
        def limb(done: Column, k: Column) -> Column:
            v, m = F.get(state, k), F.coalesce(F.element_at(F.get(maps, k), c), F.lit(0))
            total = v + v.bitwiseAND(m) + done["carry"]
            new = total.bitwiseAND(F.lit(ONES)).bitwiseOR(v.bitwiseAND(F.bitwise_not(m)))
            return F.struct(F.concat(done["v"], F.array(new)).alias("v"), F.shiftright(total, BITS).alias("carry"))

        limbs = F.filter(F.sequence(F.lit(0), F.size(maps)), lambda k: k < F.size(maps))
        nothing = F.struct(F.array().cast("array<bigint>").alias("v"), F.lit(0).cast("bigint").alias("carry"))
        return F.aggregate(limbs, nothing, limb, lambda s: s["v"])

    final = F.aggregate(characters, start, step)
    return F.aggregate(final, F.lit(0), lambda n, v: n + BITS - F.bit_count(v))


def closest_labels(labels: DataFrame, column: str, known: DataFrame | Iterable[str], threshold: float = 80) -> DataFrame:
    """(label, match, score) for every distinct label outside ``known``.

    Score: words sorted, then 100 * 2 * LCS / (sum of lengths). Of equal scores the first known
    label wins; below the threshold the match is "Others". ``known`` has ``label`` and ``position``,
    its order, or is a list. Each distinct label meets the known ones block by block.
    """
    if not isinstance(known, DataFrame):
        names = list(dict.fromkeys(known))
        types = {"label": pa.string(), "position": pa.int64()}
        known = local_table(labels.sparkSession, {"label": names, "position": list(range(len(names)))}, types)
    words = known.select(F.col("label").alias("_known"), "position", _characters(_sorted_words(F.col("label"))).alias("_chars"))
    blocks = F.lit(-(-known.count() // BLOCK))
    entry = F.struct("position", F.col("_known").alias("known"), F.size("_chars").alias("size"), _bit_maps(F.col("_chars")).alias("maps"))
    listed = words.groupBy(F.pmod(F.xxhash64("_known"), blocks).alias("_block")).agg(F.collect_list(entry).alias("_entries"))
    distinct = labels.select(F.col(column).alias("label")).filter(F.col("label").isNotNull()).distinct()
    unknown = distinct.join(known.select(F.col("label").alias("_known")), F.col("label") == F.col("_known"), "left_anti")
    unknown = unknown.withColumn("_chars", _characters(_sorted_words(F.col("label"))))
    unknown = unknown.withColumn("_block", F.explode(F.filter(F.sequence(F.lit(0).cast("bigint"), blocks.cast("bigint")), lambda i: i < blocks)))

    def score(e: Column) -> Column:
        size = F.size("_chars") + e["size"]
        return F.when(size == 0, 100.0).otherwise(F.lit(200.0) * _common(F.col("_chars"), e["maps"]) / F.nullif(size, F.lit(0)))

    # The best of a block: smallest by (-score, position).
    scored = F.transform("_entries", lambda e: F.struct((-score(e)).alias("minus"), e["position"].alias("position"), e["known"].alias("known")))
    best = unknown.join(listed, "_block").select("label", F.array_min(scored).alias("_best"))
    best = best.groupBy("label").agg(F.min("_best").alias("_best"))
    out = distinct.join(known.select(F.col("label").alias("_known")), F.col("label") == F.col("_known"), "left_anti")
    top = F.coalesce(-F.col("_best.minus"), F.lit(0.0))
    return out.join(best, "label", "left").select(
        "label", F.when(top >= threshold, F.coalesce("_best.known", F.lit(FALLBACK))).otherwise(FALLBACK).alias("match"), top.alias("score")
    )


def normalize_labels(df: DataFrame, column: str, known: DataFrame | Iterable[str], threshold: float = 80) -> DataFrame:
    """The frame with every unknown label replaced by its closest known one."""
    matches = closest_labels(df, column, known, threshold).select(F.col("label").alias("_label"), F.col("match").alias("_match"))
    return (
        df.join(matches, F.col(column) == F.col("_label"), "left")
        .withColumn(column, F.coalesce("_match", column))
        .drop("_label", "_match")
    )
