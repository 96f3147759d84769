"""Array expressions that several operators use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Numbers summed by one fold; a fold copies its list at every step, so long lists are summed in parts.
PART = 256


def _grown(part: Column, base: Column) -> Column:
    """``base``, then ``base`` plus every leading sum of ``part``."""
    return F.aggregate(part, F.array(base), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))


def running_total(numbers: Column) -> Column:
    """Sums up to and including each number of an array of longs, in time that grows with its length."""
    count = F.size(numbers)
    parts = F.when(count > 0, F.transform(F.sequence(F.lit(0), F.floor((count - 1) / PART).cast("int")), lambda k: F.slice(numbers, k * PART + 1, PART)))
    zero = F.lit(0).cast("long")
    bases = _grown(F.transform(parts, lambda p: F.aggregate(p, zero, lambda s, x: s + x)), zero)
    sums = F.zip_with(parts, F.slice(bases, 1, F.size(bases) - 1), lambda p, b: F.slice(_grown(p, b), 2, PART))
    return F.coalesce(F.flatten(sums), F.array().cast("array<bigint>"))
