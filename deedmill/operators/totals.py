"""Totals per key, per segment and per label.

Everything here is additive, so raw rows are aggregated once at (key, year, quarter) grain and
the three period grains are rolled up from that far smaller result. The partial aggregation
before each shuffle keeps a hot key from piling up in one task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedmill.config import NON_BHK_LABELS
from deedmill.functions import exact
from deedmill.functions.values import round2
from deedmill.operators.levels import (
    AREA_LEVELS,
    BEDROOM,
    GRAINS,
    LEVEL_KEY,
    LEVELS,
    PERIOD_KEY,
    PROPERTY,
    SEGMENT_KEY,
    Level,
    by_grain,
    by_group,
    by_level,
    by_segment,
    masks,
    period_columns,
)

def fine_key(grains: Iterable[str]) -> list[str]:
    """Key of the first aggregation: the finest that the grains are rolled up from."""
    return [*LEVEL_KEY, *period_columns(grains)]


def project_type_label(has_residential: Column, has_commercial: Column) -> Column:
    return (
        F.when(has_residential & has_commercial, "Residential + Commercial")
        .when(has_residential, "Residential")
        .when(has_commercial, "Commercial")
        .otherwise("Other")
    )


def base_totals(df: DataFrame, level: Level | Iterable[Level], grains: Iterable[str] = GRAINS) -> DataFrame:
    """One row per key and period: totals, latest date, project type and descriptive columns.

    A descriptive column takes its value from the smallest document number that has one. Of several levels, each
    fills its own descriptive columns; those of one name must have one type.
    """
    levels = [level] if isinstance(level, Level) else list(level)
    sources: dict[str, list[tuple[str, str]]] = {}
    for one in levels:
        for name, src in one.attributes:
            sources.setdefault(name, []).append((one.name, src))

    def first(name: str) -> Column:
        value = F.col(sources[name][0][1])
        if len({src for _, src in sources[name]}) > 1 or len(sources[name]) < len(levels):
            value = F.coalesce(*[F.when(F.col("level") == own, F.col(src)) for own, src in sources[name]])
        return F.min(F.when(value.isNotNull(), F.struct("document_no", value.alias("value")))).alias(f"_{name}")

    attributes, firsts = list(sources), [first(name) for name in sources]
    fine = (
        by_level(df, levels)
        .groupBy(*fine_key(grains))
        .agg(
            *exact.sums("sales", F.col("agreement_price")),
            *exact.sums("carpet", F.col("carpet_sqft")),
            F.count("document_no").alias("documents"),
            F.max("floor_no").alias("floor"),
            F.max("transaction_date").alias("latest"),
            F.bool_or(F.coalesce(F.col("project_type") == "Residential", F.lit(False))).alias("residential"),
            F.bool_or(F.coalesce(F.col("project_type") == "Commercial", F.lit(False))).alias("commercial"),
            *firsts,
        )
    )
    rolled = (
        by_grain(fine, grains)
        .groupBy(*PERIOD_KEY)
        .agg(
            *exact.merged("sales"),
            *exact.merged("carpet"),
            F.sum("documents").alias("documents"),
            F.max("floor").alias("floor"),
            F.max("latest").alias("latest"),
            F.bool_or("residential").alias("residential"),
            F.bool_or("commercial").alias("commercial"),
            *[F.min(f"_{name}").alias(f"_{name}") for name in attributes],
        )
    )
    zero = F.lit(0.0)
    return rolled.select(
        *PERIOD_KEY,
        *[F.col(f"_{name}.value").alias(name) for name in attributes],
        F.coalesce(exact.rounded("sales"), zero).alias("total_sales"),
        F.coalesce(exact.rounded("carpet"), zero).alias("total_ca_consumed_sqft_igr"),
        F.col("documents").alias("total_transactions"),
        F.col("floor").alias("max_floor"),
        F.col("latest").alias("recent_transaction_date"),
        project_type_label(F.col("residential"), F.col("commercial")).alias("project_type"),
    )


def _segment_amounts() -> tuple[dict[str, Column], dict[str, Column]]:
    """What counts for each count of a segment, and what is added up for each amount."""
    priced, price, carpet = masks()["valid_price"], F.col("agreement_price"), F.col("carpet_sqft")
    counts = {"documents": F.col("document_no").isNotNull(), "n_price_pos": priced, "n_carpet": carpet.isNotNull(), "n_carpet_pos": carpet > 0}
    amounts = {"price": price, "price_pos": F.when(priced, price), "carpet": carpet, "carpet_pos": F.when(carpet > 0, carpet)}
    return counts, amounts


def segment_totals(
    df: DataFrame, levels: Iterable[Level] = LEVELS, kinds: Iterable[str] = (PROPERTY, BEDROOM), grains: Iterable[str] = GRAINS
) -> DataFrame:
    """Per segment: documents, price total, mean of positive prices, carpet total, mean carpet.

    The mean carpet of bedroom labels takes every label at levels of checked projects and only bedroom labels
    with carpet above zero elsewhere; property types have none.
    """
    return counted_totals(by_level(df, levels), levels, kinds, grains)


def counted_totals(rows: DataFrame, levels: Iterable[Level], kinds: Iterable[str], grains: Iterable[str]) -> DataFrame:
    """`segment_totals` of rows that have their level and key, counted before they are shuffled."""
    kinds = list(kinds)
    counts, amounts = _segment_amounts()
    fine = rows.groupBy(*fine_key(grains), *kinds).agg(
        *[F.count_if(c).alias(name) for name, c in counts.items()], *[s for a, v in amounts.items() for s in exact.sums(a, v)]
    )
    return _segments(by_grain(by_segment(fine, kinds, all_labels=True), grains), list(levels))


def totals_in_place(rows: DataFrame, levels: Iterable[Level], kinds: Iterable[str], grains: Iterable[str]) -> DataFrame:
    """`segment_totals` of rows that have their level and key, and each key of which is in one part."""
    kinds, grains = list(kinds), list(grains)
    counts, amounts = _segment_amounts()
    made = [F.when(c, 1).otherwise(0).cast("bigint").alias(name) for name, c in counts.items()]
    rows = rows.select(*fine_key(grains), *kinds, *made, *[h for a, v in amounts.items() for h in exact.halves(a, v)])
    return _segments(by_group(rows, kinds, grains, all_labels=True), list(levels))


def _segments(rows: DataFrame, levels: list[Level]) -> DataFrame:
    counts, amounts = _segment_amounts()
    rolled = rows.groupBy(*SEGMENT_KEY).agg(*[F.sum(c).alias(c) for c in counts], *[m for a in amounts for m in exact.merged(a)])
    bedroom = F.col("kind") == BEDROOM
    counted = ~bedroom | ~F.col("segment").isin(NON_BHK_LABELS)
    every_row = F.col("level").isin([x.name for x in levels if x.manual_only])
    mean_carpet = F.when(every_row, exact.mean("carpet", "n_carpet")).when(counted, exact.mean("carpet_pos", "n_carpet_pos"))
    zero = F.lit(0.0)
    return rolled.select(
        *SEGMENT_KEY,
        F.when(counted, F.col("documents")).alias("sold_igr"),
        F.when(counted, F.coalesce(exact.rounded("price"), zero)).alias("total_agreement_price"),
        F.when(counted, round2(exact.mean("price_pos", "n_price_pos"))).alias("avg_agreement_price"),
        F.when(counted, F.coalesce(exact.rounded("carpet"), zero)).alias("ca_consumed_sqft_igr"),
        F.when(bedroom, round2(mean_carpet)).alias("avg_carpet_area_in_sqft"),
    )


# Counted label -> (column, rows)
LABEL_COUNTS = {"transactions_sale": "property_type_raw", "transactions": "property_category"}


def label_counts(
    df: DataFrame, levels: Iterable[Level] = AREA_LEVELS, metrics: Iterable[str] = tuple(LABEL_COUNTS), grains: Iterable[str] = GRAINS
) -> DataFrame:
    """Documents per label: of sales by mapped raw type, of all documents by category."""
    sale = F.col("property_category") == "Sale"
    entries = []
    for metric in metrics:
        label = F.col(LABEL_COUNTS[metric])
        counted = label.isNotNull() & sale if metric == "transactions_sale" else label.isNotNull()
        entries.append(F.when(counted, F.struct(F.lit(metric).alias("metric"), label.alias("segment"))))
    fine = (
        by_level(df, levels, sale_only=False)
        .withColumn("_e", F.explode(F.array(*entries)))
        .filter(F.col("_e").isNotNull())
        .groupBy(*fine_key(grains), F.col("_e.metric").alias("metric"), F.col("_e.segment").alias("segment"))
        .agg(F.count("document_no").alias("n"))
    )
    return by_grain(fine, grains).groupBy(*PERIOD_KEY, "metric", "segment").agg(F.sum("n").alias("n"))


def sales_by_raw_type(df: DataFrame, levels: Iterable[Level] = AREA_LEVELS) -> DataFrame:
    return label_counts(df, levels, ["transactions_sale"]).drop("metric")


def documents_by_category(df: DataFrame, levels: Iterable[Level] = AREA_LEVELS) -> DataFrame:
    return label_counts(df, levels, ["transactions"]).drop("metric")


def development_agreements(df: DataFrame, levels: Iterable[Level] = AREA_LEVELS, grains: Iterable[str] = GRAINS) -> DataFrame:
    """Development agreements per key and period that has sales; null where there are none."""
    agreement = F.col("transaction_type") == "Development Agreement"
    fine = (
        by_level(df, levels, sale_only=False)
        .groupBy(*fine_key(grains))
        .agg(F.count_if(agreement).alias("n"), F.count_if(F.col("property_category") == "Sale").alias("sales"))
    )
    rolled = by_grain(fine, grains).groupBy(*PERIOD_KEY).agg(F.sum("n").alias("n"), F.sum("sales").alias("sales"))
    return rolled.filter(F.col("sales") > 0).select(
        *PERIOD_KEY, F.nullif(F.col("n"), F.lit(0)).alias("no_of_da_registered")
    )
