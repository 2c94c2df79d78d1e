"""Sums of amounts that do not depend on the order of their addition.

An amount is added up as two whole numbers, its whole part and its billionths, so that partial sums may be made and
merged in any order, and rounded once at the end. A total beyond what a bigint holds fails the job.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_BILLIONTH = Decimal("0.000000001")


def names(amount: str) -> list[str]:
    """The two columns that hold an amount's sums."""
    return [f"{amount}__whole", f"{amount}__part"]


def _halves(value: Column) -> list[Column]:
    whole = F.floor(value)
    return [whole, F.rint((value - whole) * 1e9).cast("bigint")]


def halves(amount: str, value: Column) -> list[Column]:
    """What `sums` adds up: the whole part and the billionths of a double."""
    return [half.alias(name) for half, name in zip(_halves(value), names(amount), strict=True)]


def sums(amount: str, value: Column) -> list[Column]:
    """Aggregates of a double; nulls are left out."""
    return [F.sum(half).alias(name) for half, name in zip(_halves(value), names(amount), strict=True)]


def merged(amount: str) -> list[Column]:
    """Aggregates of what `sums` or `merged` made."""
    return [F.sum(name).alias(name) for name in names(amount)]


def total(amount: str) -> Column:
    """The exact sum as a decimal; null if nothing was added."""
    whole, part = (F.col(name).cast("decimal(20,0)") for name in names(amount))
    return whole + part * F.lit(_BILLIONTH)


def rounded(amount: str) -> Column:
    """The sum with two decimals, ties to even."""
    return F.bround(total(amount), 2).cast("double")


def mean(amount: str, n: str) -> Column:
    """The sum over a count; null for a count of zero."""
    return total(amount).cast("double") / F.nullif(F.col(n), F.lit(0))


def centre(amount: str, n: str) -> Column:
    """`mean` without decimals, for each of many rows; the same where the sum is a whole number, as all ties of centres are."""
    whole, part = names(amount)
    billion = F.lit(10**9).cast("bigint")
    parts = (F.col(whole) + F.call_function("div", F.col(part), billion)).cast("double") + F.pmod(F.col(part), billion) / 1e9
    return parts / F.nullif(F.col(n), F.lit(0))
