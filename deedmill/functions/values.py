"""Column helpers for numbers and text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from deedmill.config import AGE_PATTERN, BUYER_MARK

_SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
# First digit of the decimal digit blocks that may stand in free text.
_ZEROS = [0x0660, 0x06F0, 0x0966, 0x09E6, 0x0A66, 0x0AE6, 0x0B66, 0x0BE6, 0x0C66, 0x0CE6, 0x0D66, 0xFF10]
_DIGITS = "".join(chr(zero + i) for zero in _ZEROS for i in range(10))


def round2(c: Column) -> Column:
    """Two decimals, ties to even.

    The order of additions differs from run to run, and with it the last bits of a sum. They are
    rounded off first, to six decimals, so that a tie is seen as one.
    """
    return F.bround(c.cast("double").try_cast("decimal(38,6)"), 2).cast("double")


def no_nan(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def to_number(c: Column) -> Column:
    """Text to double; anything that is no number gives null.

    Java reads ``1d`` and ``1f`` as numbers, hence the guard.
    """
    text = c.cast("string")
    return no_nan(F.when(~text.rlike("[dDfF]"), text.try_cast("double")))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_SPACE))


def label_key(c: Column) -> Column:
    """Form in which two labels are compared: without outer space, in lower case."""
    return F.lower(strip(c))


def title(c: Column) -> Column:
    """Upper case after every non-letter, lower case otherwise ("1.5bhk" -> "1.5Bhk")."""
    words = F.split(F.lower(c), r"(?<=[^\p{Lu}\p{Ll}\p{Lt}])")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), ""
    )


def buyer_ages(text: Column) -> Column:
    """Ages named in a numbered buyer list, one at most per buyer."""
    plain = F.translate(text, _DIGITS, "0123456789" * len(_ZEROS))
    pieces = F.split(plain, "(?U)" + BUYER_MARK)
    buyers = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    # Every alternative of the pattern holds exactly one pair of digits.
    ages = F.transform(
        buyers,
        lambda b: F.regexp_extract(F.regexp_extract(b, "(?U)" + AGE_PATTERN, 0), r"\d{2}", 0).try_cast("int"),
    )
    return F.coalesce(F.filter(ages, lambda a: a > 0), F.array().cast("array<int>"))


def price_label(c: Column) -> Column:
    """An amount in crore, lakh or thousand, e.g. ``1.45 Cr``."""

    def scaled(by: float, unit: str) -> Column:
        # format_number rounds the exact binary value, as printf does.
        return F.concat(F.translate(F.format_number(c / by, 2), ",", ""), F.lit(unit))

    return (
        F.when(c >= 1e7, scaled(1e7, " Cr")).when(c >= 1e5, scaled(1e5, " L")).when(c.isNotNull(), scaled(1e3, " K"))
    )
