"""Loads of different schemas under one another.

Columns are matched by lower-case name. Types that one wider type can hold without loss are widened to it; a column
whose types have nothing in common becomes text, so that no value is lost, and is reported as a clash. Only schemas
are looked at, so nothing is read before the stacked frame is.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MISSING, WIDENED, CLASH = "missing", "widened", "clash"
# Whole numbers by the decimal digits they may have.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_MOST_DIGITS = 38


@dataclass(frozen=True)
class Finding:
    """What was done to a column of a source: it was missing, widened, or clashed with the others' types."""

    source: str
    column: str
    kind: str
    own: str | None
    stacked: str


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds all values of both; None if there is none."""
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    whole = [isinstance(t, tuple(_DIGITS)) for t in (a, b)]
    if all(whole):
        return max(a, b, key=lambda t: _DIGITS[type(t)])
    if any(isinstance(t, T.DecimalType) for t in (a, b)) and all(isinstance(t, (T.DecimalType, *_DIGITS)) for t in (a, b)):
        parts = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0) for t in (a, b)]
        before, after = (max(p[i] for p in parts) for i in (0, 1))
        return T.DecimalType(before + after, after) if before + after <= _MOST_DIGITS else None
    real = (T.FloatType, T.DoubleType)
    if any(isinstance(t, real) for t in (a, b)) and all(isinstance(t, (*real, T.ByteType, T.ShortType, T.IntegerType)) for t in (a, b)):
        return T.DoubleType()
    times = (T.DateType, T.TimestampType)
    if isinstance(a, times) and isinstance(b, times):
        return T.TimestampType()
    return None


def reconcile(loads: dict[str, DataFrame]) -> tuple[DataFrame, list[Finding]]:
    """All rows of all loads by column name, and what had to be done, by column and source.

    Columns stand in the order in which the loads bring them. A load with two columns that differ only in case is
    refused, as is an empty set of loads.
    """
    if not loads:
        raise ValueError("no loads to stack")
    lowered = {}
    for source, df in loads.items():
        names = [c.lower() for c in df.columns]
        if twice := sorted({n for n in names if names.count(n) > 1}):
            raise ValueError(f"{source}: columns differ only in case: {twice}")
        lowered[source] = df.toDF(*names)
    kinds: dict[str, dict[str, T.DataType]] = {}
    for source, df in lowered.items():
        for field in df.schema:
            kinds.setdefault(field.name, {})[source] = field.dataType
    stacked, findings = {}, []
    for column, own in kinds.items():
        types = list(own.values())
        common = reduce(lambda a, b: None if a is None else common_type(a, b), types)
        stacked[column] = kind = T.StringType() if common is None else common
        for source in lowered:
            if source not in own:
                findings.append(Finding(source, column, MISSING, None, kind.simpleString()))
            elif own[source] != kind or common is None:
                what = CLASH if common is None else WIDENED
                findings.append(Finding(source, column, what, own[source].simpleString(), kind.simpleString()))
    parts = [
        df.select(*[(F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in stacked.items()])
        for df in lowered.values()
    ]
    return reduce(DataFrame.union, parts), findings
