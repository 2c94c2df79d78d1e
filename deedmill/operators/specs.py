"""Distributions by specifications: strategy, step and bounds chosen for each statistic.

Any number of specifications are answered from one pass over the rows. Per block, values are counted in cells of a
width that divides every edge that any of its specifications can have; each specification then puts whole cells into
its buckets. The means that centre bins are taken from the cells' exact sums.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from deedmill.functions import bins, exact
from deedmill.operators.levels import (
    BEDROOM,
    GRAINS,
    LEVEL_KEY,
    LEVELS,
    PROPERTY,
    SEGMENT_KEY,
    Level,
    by_grain,
    by_group,
    by_key,
    by_level,
    by_segment,
    chosen,
    masks,
    parts,
)
from deedmill.operators.ranges import large_keys, money, only_large, without_large

MEAN, FIXED = "mean", "fixed"
# Block -> column that is binned
VALUES = {"area": "carpet_sqft", "price": "agreement_price", "rate": "rate_on_net_ca"}


@dataclass(frozen=True)
class RangeSpec:
    """One distribution of a block, with bins around the segment's mean or between fixed bounds.

    ``priced`` limits area distributions to documents with a positive price, and so their mean. Rows between no
    bounds are dropped from fixed area bins and have open buckets in the others.
    """

    name: str
    block: str
    step: int
    strategy: str = MEAN
    low: int | None = None
    high: int | None = None
    priced: bool = False

    def __post_init__(self) -> None:
        if self.block not in VALUES:
            raise ValueError(f"{self.name}: unknown block '{self.block}', choose one of {sorted(VALUES)}")
        if self.strategy not in (MEAN, FIXED):
            raise ValueError(f"{self.name}: unknown strategy '{self.strategy}', choose '{MEAN}' or '{FIXED}'")
        if self.step <= 0:
            raise ValueError(f"{self.name}: the step must be positive")
        if self.strategy == FIXED and (self.low is None or self.high is None or self.low >= self.high):
            raise ValueError(f"{self.name}: fixed bins need bounds, the lower one below the upper one")
        if self.priced and self.block != "area":
            raise ValueError(f"{self.name}: only area distributions have a priced form")

    def width(self) -> int:
        """A cell width that no edge cuts."""
        if self.strategy == MEAN:
            return gcd(bins.AREA_MEAN_ROUNDING, self.step) if self.block == "area" else self.step
        return gcd(self.low, self.step, self.high if self.block == "price" else 0)


def widths(specs: Iterable[RangeSpec]) -> dict[str, int]:
    """The common cell width of each block that has a specification."""
    found: dict[str, int] = {}
    for spec in specs:
        found[spec.block] = gcd(found.get(spec.block, 0), spec.width())
    return found


def _members(rows: DataFrame, width: dict[str, int]) -> DataFrame:
    """A row for each block of rows that have their level and key, with its cell and value."""
    named = masks()
    members = {
        "area": named["valid_area"] & named["valid_carpet"],
        "price": named["valid_price"],
        "rate": named["valid_rate"] & (F.col("rate_on_net_ca") > 0),
    }
    entries = []
    for block, size in width.items():
        value = F.col(VALUES[block])
        cell = (bins.price_cell if block == "price" else bins.plain_cell)(value, size).cast("bigint")
        entries.append(F.when(members[block], F.struct(F.lit(block).alias("block"), cell.alias("cell"), value.alias("value"))))
    entry = entries[0] if len(entries) == 1 else F.explode(F.array_compact(F.array(*entries)))
    rows = rows.withColumn("_e", entry).filter(F.col("_e").isNotNull())
    return rows.withColumns({c: F.col(f"_e.{c}") for c in ("block", "cell", "value")}).drop("_e")


def _amounts() -> dict[str, Column]:
    amounts = {"price": F.col("agreement_price"), "carpet": F.col("carpet_sqft"), "value": F.col("value")}
    return amounts | {f"{a}_priced": F.when(masks()["valid_price"], c) for a, c in amounts.items()}


def _counted(rows: DataFrame, width: dict[str, int], kinds: list[str]) -> DataFrame:
    """Exact sums per key, period, segment, block and cell, of rows that have their level and key."""
    fine = (
        _members(rows, width)
        .groupBy(*LEVEL_KEY, "year", "quarter", *kinds, "block", "cell")
        .agg(
            F.count(F.lit(1)).alias("n"), F.count_if(masks()["valid_price"]).alias("n_priced"),
            *[s for a, c in _amounts().items() for s in exact.sums(a, c)],
        )
    )
    sums = [*[F.sum(c).alias(c) for c in ("n", "n_priced")], *[m for a in _amounts() for m in exact.merged(a)]]
    return by_grain(by_segment(fine, kinds)).groupBy(*SEGMENT_KEY, "block", "cell").agg(*sums)


def _uncounted(rows: DataFrame, width: dict[str, int], kinds: list[str]) -> DataFrame:
    """`_counted` with a row for each row instead of one for each cell."""
    counts = [F.lit(1).cast("bigint").alias("n"), masks()["valid_price"].cast("bigint").alias("n_priced")]
    made = [*counts, *[h for a, c in _amounts().items() for h in exact.halves(a, c)]]
    rows = _members(rows, width).select(*LEVEL_KEY, "year", "quarter", *kinds, "block", "cell", *made)
    return by_group(rows, kinds, GRAINS).drop("year", "quarter", *kinds)


def _bucket(spec: RangeSpec, width: int, low: Column, high: Column) -> Column:
    """Number of a cell's bucket between two edges; null outside of fixed area bins."""
    cell, step = F.col("cell"), spec.step
    if spec.block == "price":
        exactly, at = cell % 2 == 0, F.floor(cell / 2) * width
        inner = F.when(exactly, F.greatest(F.ceil((at - low) / step) - 1, F.lit(0))).otherwise(F.floor((at - low) / step))
        beyond = F.when(exactly, at > high).otherwise(at >= high)
        return F.when(at < low, bins.LOW).when(beyond, bins.HIGH).otherwise(inner)
    at = cell * width
    last = low + F.ceil((high - low) / step) * step
    inner = F.floor((at - low) / step)
    if spec.block == "area" and spec.strategy == FIXED:
        return F.when((at >= low) & (at < last), inner)
    return F.when(at < low, bins.LOW).when(at >= last, bins.HIGH).otherwise(inner)


def range_stats(
    df: DataFrame, specs: Iterable[RangeSpec], levels: Iterable[Level] = LEVELS, kinds: Iterable[str] = (PROPERTY, BEDROOM)
) -> DataFrame:
    """spec, level, city, key_id, grain, period, kind, segment, bucket, unit_sold, total_sales and ca_consumed_sqft.

    One row for each bucket that has rows, of each specification. The window that sums a segment holds its cells,
    whose number the value axis bounds, or the rows of a small key. Rows of keys with few rows are shuffled once, by key,
    and put into buckets where they then are; cells of large keys are counted before they are shuffled.
    """
    specs, levels, kinds = list(specs), list(levels), list(kinds)
    if len({s.name for s in specs}) < len(specs):
        raise ValueError("specifications need names of their own")
    large = large_keys(df, levels)
    some = None if large.isEmpty() else large
    needed = ["year", "quarter", *kinds, "net_carpet_area_sqmt", *VALUES.values()]
    rows = by_level(df, levels).select(*LEVEL_KEY, *needed)
    width = widths(specs)
    tables = [_bucketed(_uncounted(by_key(without_large(rows, some), parts(df, levels)), width, kinds), specs)]
    if some is not None:
        tables.append(_bucketed(_counted(only_large(rows, some), width, kinds), specs))
    return reduce(DataFrame.unionByName, tables)


def _bucketed(cells: DataFrame, specs: list[RangeSpec]) -> DataFrame:
    """`range_stats` of cells or rows with their counts and sums."""
    width = widths(specs)
    # Sorting by a hash first settles nearly every comparison without looking at the keys.
    cells = cells.withColumn("_hash", F.xxhash64(*SEGMENT_KEY))
    group = W.partitionBy("_hash", *SEGMENT_KEY, "block")
    centring = [f"n{x}" for x in ("", "_priced")] + [name for x in ("", "_priced") for name in exact.names(f"value{x}")]
    cells = cells.withColumns({f"sum_{c}": F.sum(c).over(group) for c in centring})

    # Means and centres are columns of their own, so that each is computed once per row.
    used = {"_priced" if s.priced else "" for s in specs if s.strategy == MEAN}
    cells = cells.withColumns({f"_mean{x}": exact.centre(f"sum_value{x}", f"sum_n{x}") for x in sorted(used)})

    def centre_of(spec: RangeSpec) -> Column:
        mean = F.col("_mean_priced" if spec.priced else "_mean")
        centre = bins.area_centre(mean) if spec.block == "area" else bins.step_centre(mean, spec.step)
        return F.when(F.col("block") == spec.block, centre)

    cells = cells.withColumns({f"_centre_{s.name}": centre_of(s) for s in specs if s.strategy == MEAN})

    # Rows are spread by a number, and each specification's columns are made for its own rows only.
    numbers, options = [], []
    for i, spec in enumerate(specs):
        suffix = "_priced" if spec.priced else ""
        if spec.strategy == FIXED:
            low, high = F.lit(spec.low).cast("bigint"), F.lit(spec.high).cast("bigint")
        else:
            low, high = bins.centred_edges(spec.block, F.col(f"`_centre_{spec.name}`"), spec.step)
        made = {"low": low, "high": high, "number": _bucket(spec, width[spec.block], low, high).cast("bigint"), "n": F.col(f"n{suffix}")}
        for a in ("price", "carpet"):
            made |= {to: F.col(own) for own, to in zip(exact.names(a + suffix), exact.names(a), strict=True)}
        numbers.append(F.when((F.col("block") == spec.block) & (F.col(f"n{suffix}") > 0), F.lit(i)))
        options.append(made)
    which = F.col("_spec")
    rows = cells.withColumn("_spec", F.explode(F.array(*numbers))).filter(which.isNotNull())
    rows = rows.select(*SEGMENT_KEY, "_spec", *[chosen(which, [made[c] for made in options]).alias(c) for c in options[0]])
    table = rows.filter("number IS NOT NULL").groupBy("_spec", *SEGMENT_KEY, "number", "low", "high").agg(
        F.sum("n").alias("unit_sold"), *exact.merged("price"), *exact.merged("carpet")
    )
    none = F.lit(0).cast("decimal(38,9)")
    table = table.withColumns(
        {
            "total_sales": F.coalesce(exact.total("price"), none),
            "ca_consumed_sqft": F.coalesce(exact.total("carpet"), none),
            "spec": chosen(which, [F.lit(s.name) for s in specs]),
            "step": chosen(which, [F.lit(s.step).cast("bigint") for s in specs]),
        }
    )
    ends = [F.col("number"), F.col("low"), F.col("high"), F.col("low") + F.col("number") * F.col("step"), F.col("step")]
    of = {"price": bins.price_range_label, "other": bins.label}
    styles = ["price" if s.block == "price" else "other" for s in specs]
    texts = {style: of[style](*ends) for style in dict.fromkeys(styles)}
    # Only the texts that are asked for, as long expressions are slow.
    if len(texts) == 1:
        (bucket,) = texts.values()
    else:
        bucket = F.when(which.isin([i for i, style in enumerate(styles) if style == "price"]), texts["price"]).otherwise(texts["other"])
    amounts = [money(c).alias(c) for c in ("total_sales", "ca_consumed_sqft")]
    return table.select("spec", *SEGMENT_KEY, bucket.alias("bucket"), "unit_sold", *amounts)
