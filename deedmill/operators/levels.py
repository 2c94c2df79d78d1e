"""Report levels and period grains.

Long results share one key: level, city, key_id, grain, period. ``period`` is "Overall", a year
or a quarter label.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedmill.config import NON_BHK_LABELS

GRAINS = ("Overall", "YoY", "QoQ")
LEVEL_KEY = ["level", "city", "key_id"]
PERIOD_KEY = [*LEVEL_KEY, "grain", "period"]
SEGMENT_KEY = [*PERIOD_KEY, "kind", "segment"]
PROPERTY, BEDROOM = "property_type", "bhk_br"


@dataclass(frozen=True)
class Level:
    """What to report by, with its rules. ``attributes`` are (output, input) descriptive columns.

    ``key`` is one numeric column, or a tuple of any columns. The latter must be numbered first, see ``keys``.
    """

    name: str
    key: str | tuple[str, ...]
    mean_bins: bool  # bins around the segment's mean; otherwise fixed by city
    manual_only: bool
    prevailing_percentile: float
    prevailing_band: float
    attributes: tuple[tuple[str, str], ...] = ()

    @property
    def composite(self) -> bool:
        return not isinstance(self.key, str)

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(self.key) if self.composite else (self.key,)

    @property
    def number(self) -> str:
        """The column with the key's number."""
        return f"_number_{self.name}" if self.composite else self.key

    def key_id(self) -> Column:
        return F.col(self.number).cast("bigint")

    def rows(self, sale_only: bool = True) -> Column:
        """Rows of the level's base population."""
        rows = F.col(self.number).isNotNull()
        if sale_only:
            rows = rows & (F.col("property_category") == "Sale")
        if self.manual_only:
            rows = rows & (F.col("manual_processed") == "Yes")
        return rows


PROJECT = Level(
    "project", "proj_id", True, True, 0.90, 0.05,
    (("index", "index"), ("project", "project_name"), ("location", "location"), ("location_id", "location_id"),
     ("project_lat", "project_lat"), ("project_lng", "project_lng"), ("city_id", "city_id")),
)
LOCATION = Level(
    "location", "loc_id", False, False, 0.80, 0.10,
    (("location", "location"), ("city_id", "city_id"), ("location_lat", "location_lat"), ("location_lng", "location_lng")),
)
CITY = Level("city", "city_id", False, False, 0.80, 0.10)
LEVELS = (PROJECT, LOCATION, CITY)
AREA_LEVELS = (LOCATION, CITY)


def period_columns(grains: Iterable[str]) -> list[str]:
    """The columns that tell the periods of the grains."""
    grains = list(grains)
    return [column for grain, column in (("YoY", "year"), ("QoQ", "quarter")) if grain in grains]


def with_targets(df: DataFrame, levels: Iterable[Level], sale_only: bool = True) -> DataFrame:
    """Rows that count for one of the levels, with ``_targets``: level and key_id of each they count for.

    What is the same at all levels is best aggregated by this column first, before ``by_target``.
    """
    if sale_only:
        df = df.filter(F.col("property_category") == "Sale")
    targets = [F.when(x.rows(sale_only), F.struct(F.lit(x.name).alias("level"), x.key_id().alias("key_id"))) for x in levels]
    return df.withColumn("_targets", F.array_compact(F.array(*targets))).filter(F.size("_targets") > 0)


def by_target(df: DataFrame) -> DataFrame:
    """One row for each of a row's ``_targets``, with ``level`` and ``key_id``."""
    df = df.withColumn("_target", F.explode("_targets")).drop("_targets")
    return df.withColumns({"level": F.col("_target.level"), "key_id": F.col("_target.key_id")}).drop("_target")


def by_level(df: DataFrame, levels: Iterable[Level] = LEVELS, sale_only: bool = True) -> DataFrame:
    """One row per transaction and level it counts for, with ``level`` and ``key_id``."""
    levels = list(levels)
    if len(levels) == 1:
        (one,) = levels
        return df.filter(one.rows(sale_only)).withColumns({"level": F.lit(one.name), "key_id": one.key_id()})
    return by_target(with_targets(df, levels, sale_only))


def by_grain(df: DataFrame, grains: Iterable[str] = GRAINS) -> DataFrame:
    """One row per period a row belongs to; a row without year or quarter misses that grain."""
    grains = list(grains)
    period = {"Overall": F.lit("Overall"), "YoY": F.col("year").cast("string"), "QoQ": F.col("quarter")}
    targets = F.array(*[F.struct(F.lit(g).alias("grain"), period[g].alias("period")) for g in grains])
    return (
        df.withColumn("_target", F.explode(targets))
        .withColumns({"grain": F.col("_target.grain"), "period": F.col("_target.period")})
        .drop("_target")
        .filter(F.col("period").isNotNull())
    )


def by_segment(df: DataFrame, kinds: Iterable[str] = (PROPERTY, BEDROOM), all_labels: bool = False) -> DataFrame:
    """One row per segment; rows without label drop out, and so do labels that are no bedroom count."""
    targets = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("segment")) for k in kinds])
    df = (
        df.withColumn("_target", F.explode(targets))
        .withColumns({"kind": F.col("_target.kind"), "segment": F.col("_target.segment")})
        .drop("_target")
        .filter(F.col("segment").isNotNull())
    )
    if all_labels or BEDROOM not in kinds:
        return df
    return df.filter((F.col("kind") != BEDROOM) | ~F.col("segment").isin(NON_BHK_LABELS))


def chosen(number: Column, options: list[Column]) -> Column:
    """The option of that number, from 0; the others are not evaluated."""
    out = F.when(number == 0, options[0])
    for i, option in enumerate(options[1:], 1):
        out = out.when(number == i, option)
    return out


def by_group(df: DataFrame, kinds: Iterable[str], grains: Iterable[str], all_labels: bool = False) -> DataFrame:
    """`by_grain` of `by_segment`, in one step. Rows are spread by a number, as texts would be copied for each."""
    kinds, grains = list(kinds), list(grains)
    period = {"Overall": F.lit("Overall"), "YoY": F.col("year").cast("string"), "QoQ": F.col("quarter")}
    places = [(kind, grain) for kind in kinds for grain in grains]
    numbers = []
    for i, (kind, grain) in enumerate(places):
        fits = F.col(kind).isNotNull() & period[grain].isNotNull()
        if kind == BEDROOM and not all_labels:
            fits = fits & ~F.col(kind).isin(NON_BHK_LABELS)
        numbers.append(F.when(fits, F.lit(i)))
    df = df.withColumn("_group", F.explode(F.array(*numbers))).filter(F.col("_group").isNotNull())
    values = {
        "grain": [F.lit(grain) for _, grain in places],
        "period": [period[grain] for _, grain in places],
        "kind": [F.lit(kind) for kind, _ in places],
        "segment": [F.col(kind) for kind, _ in places],
    }
    return df.withColumns({name: chosen(F.col("_group"), options) for name, options in values.items()}).drop("_group")


# Rows that a task is dealt, if keys are small: what it makes of them should not spill.
DEALT = 100_000


def parts(df: DataFrame, levels: Iterable[Level] = LEVELS) -> int:
    """In how many parts the rows are dealt out by key: at least as many as the session's shuffles have."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-df.count() * len(list(levels)) // DEALT))


def by_key(rows: DataFrame, parts: int) -> DataFrame:
    """Rows shuffled so that each key is in one of as many parts.

    The level is no column of the shuffle: where there is one level, the planner knows it as a constant, and would shuffle
    what is grouped by it later once more.
    """
    return rows.repartition(parts, "city", "key_id")


def masks() -> dict[str, Column]:
    """Named predicates on prepared transactions; ``base`` is left to the level."""
    price = F.coalesce(F.col("agreement_price") > 0, F.lit(False))
    area = F.coalesce(F.col("net_carpet_area_sqmt") > 0, F.lit(False))
    return {
        "valid_price": price,
        "valid_area": area,
        "valid_rate": price & area,
        "valid_carpet": F.coalesce(F.col("carpet_sqft") > 0, F.lit(False)),
        "non_bhk": ~F.coalesce(F.col("bhk_br").isin(NON_BHK_LABELS), F.lit(False)),
    }


def mask_summary(df: DataFrame, levels: Iterable[Level] = LEVELS) -> DataFrame:
    """How many rows of each level's base population pass each predicate."""
    named = masks()
    counts = [F.count_if(m).alias(name) for name, m in named.items()]
    rows = by_level(df, levels)
    return rows.groupBy("level").agg(F.count(F.lit(1)).alias("base"), *counts)
