"""Buckets of the range statistics.

Fixed buckets come from the row's city and are numbered directly. Buckets around a segment's mean
are known only after the mean is, so rows are first counted in cells that no bucket edge can cut:
edges lie on multiples of a common width, and cells are as wide. Cells are additive; they replace
rows in everything after the first aggregation.

Bucket numbers: LOW and HIGH stand for the open ends. ``>x`` holds x itself, except for prices,
where a value on an edge belongs to the bucket below.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column
from pyspark.sql import functions as F

from deedmill.config import Settings
from deedmill.functions.values import price_label

LOW, HIGH = -(1 << 40), 1 << 40
AREA_MEAN_ROUNDING = 100


def _int(c: Column) -> Column:
    return c.cast("bigint")


def _text(c: Column) -> Column:
    return _int(c).cast("string")


def area_cell(settings: Settings) -> int:
    return gcd(AREA_MEAN_ROUNDING, settings.area_step)


# --- fixed buckets ----------------------------------------------------------------------------


def _last(low: Column, high: Column, step: int) -> Column:
    """Last edge: the first one, counted from ``low``, that reaches ``high``."""
    return low + F.ceil((high - low) / step) * step


def fixed_area(v: Column, low: Column, high: Column, step: int) -> Column:
    """Number of the area bucket; null outside the edges."""
    return F.when((v >= low) & (v < _last(low, high, step)), F.floor((v - low) / step))


def fixed_rate(v: Column, low: Column, high: Column, step: int) -> Column:
    return F.when(v < low, LOW).when(v >= _last(low, high, step), HIGH).otherwise(F.floor((v - low) / step))


def fixed_price(v: Column, low: Column, high: Column, step: int) -> Column:
    inner = F.greatest(F.ceil((v - low) / step) - 1, F.lit(0))
    return F.when(v < low, LOW).when(v > high, HIGH).otherwise(inner)


def age_bucket(v: Column, settings: Settings) -> Column:
    return fixed_rate(v, F.lit(settings.age_min), F.lit(settings.age_max), settings.age_step)


def label(number: Column, low: Column, high: Column, start: Column, step: Column) -> Column:
    """Text of an area, rate or age bucket."""
    return (
        F.when(number == LOW, F.concat(F.lit("<"), _text(low)))
        .when(number == HIGH, F.concat(F.lit(">"), _text(_last(low, high, step))))
        .otherwise(F.concat(_text(start), F.lit("-"), _text(start + step)))
    )


def price_range_label(number: Column, low: Column, high: Column, start: Column, step: Column) -> Column:
    return (
        F.when(number == LOW, F.concat(F.lit("< "), price_label(low)))
        .when(number == HIGH, F.concat(F.lit("> "), price_label(high)))
        .otherwise(F.concat(price_label(start), F.lit(" - "), price_label(start + step)))
    )


# --- cells and mean-centred buckets -----------------------------------------------------------


def plain_cell(v: Column, width: int) -> Column:
    return F.floor(v / width)


def price_cell(v: Column, step: int) -> Column:
    """Even for exact multiples of the step, odd for the open stretch above one."""
    return F.floor(v / step) * 2 + F.when(v % step == 0, 0).otherwise(1)


def area_centre(mean: Column) -> Column:
    return _int(F.rint(mean / AREA_MEAN_ROUNDING) * AREA_MEAN_ROUNDING)


def step_centre(mean: Column, step: int) -> Column:
    return _int(F.rint(mean / step) * step)


def centred_edges(block: str, centre: Column, step: int) -> tuple[Column, Column]:
    """Lowest and highest edge around a centre: two steps either way, three for rates.

    Prices never start below one step.
    """
    reach = 3 if block == "rate" else 2
    low, high = centre - reach * step, centre + reach * step
    return (F.greatest(F.lit(step).cast("bigint"), low), high) if block == "price" else (low, high)


def mean_bucket(cell: Column, width: int, low: Column, high: Column, step: int) -> Column:
    """Bucket of a cell between the edges around a mean."""
    at = cell * width
    return F.when(at < low, LOW).when(at >= high, HIGH).otherwise(F.floor((at - low) / step))


def mean_price_bucket(cell: Column, low: Column, high: Column, step: int) -> Column:
    first, last = F.floor(low / step), F.floor(high / step)
    exact = cell % 2 == 0
    multiple = F.floor(cell / 2)
    start = F.when(exact, F.greatest(multiple - first - 1, F.lit(0))).otherwise(multiple - first)
    beyond = F.when(exact, multiple > last).otherwise(multiple >= last)
    return F.when(multiple < first, LOW).when(beyond, HIGH).otherwise(start)
