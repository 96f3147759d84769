"""Leading digits and fixed-precision arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mantissa(col: Column) -> Column:
    """The text before a capital ``E``; the exponent never changes the first significant digit."""
    return F.when(col.contains("E"), F.element_at(F.split(F.trim(col), "E"), 1)).otherwise(col)


def first_digit(col: Column) -> Column:
    """First symbol that is not ``0``, ``.`` or ``|``; null for zero, blank or null amounts."""
    return F.nullif(F.regexp_extract(mantissa(col), r"^[0.]*([^0|.])", 1), F.lit(""))


def share_and_ratio(count: Column, total: Column, expected: Column) -> tuple[Column, Column]:
    """Percent of total, and that percent over the expected percent.

    The percent is cut to six significant digits before the division; both
    results are shown with two decimals.
    """
    wide = "decimal(38,12)"
    exact = (count.cast("decimal(20,0)") * 100 / total.cast("decimal(20,0)")).cast(wide)
    percent = _six_significant(exact)
    ratio = _six_significant((percent.cast("decimal(24,12)") / expected.cast("decimal(4,1)")).cast(wide))
    return F.round(percent, 2).cast("double"), F.round(ratio, 2).cast("double")


def _six_significant(value: Column) -> Column:
    out = F.round(value, 10)
    for scale, bound in ((9, "0.001"), (8, "0.01"), (7, "0.1"), (6, "1"), (5, "10"), (4, "100")):
        low = F.lit(bound).cast("decimal(38,12)") / 10
        out = F.when(value >= low, F.round(value, scale).cast("decimal(38,12)")).otherwise(out)
    return out
