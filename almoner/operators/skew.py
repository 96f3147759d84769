"""Balanced work: joins with hot keys, inputs with too few splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyed_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join ``big``, in which keys may be hot, with ``small``, in which they are unique.

    Adaptive execution splits the partition of a hot key, but only where both
    sides are shuffled for this join alone. ``small`` is normally an
    aggregate that lies by the same keys already, so a second key, always 0,
    asks for an own shuffle of it; no row of it is repeated. Where it turns
    out to be tiny, it is broadcast as ever.
    """
    nought = F.pmod(F.xxhash64(*keys), F.lit(1)).alias("_nought")
    joined = big.select("*", nought).join(small.select("*", nought), [*keys, "_nought"], how)
    return joined.drop("_nought")


#: Inputs of more splits than this are never dealt out anew.
MOST_SPLITS = 64


def widen(df: DataFrame) -> DataFrame:
    """Spread an input of few splits over all cores before heavy work per row.

    With fewer splits than cores, some cores would idle. What is dealt out is
    at most MOST_SPLITS splits, however large the cluster; other inputs are
    returned as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < min(cores, MOST_SPLITS) else df


def dealt_out(df: DataFrame) -> DataFrame:
    """Rows dealt out by their content, before an aggregate whose keys are nearly as many as rows.

    What an aggregate holds of an input split grows with the split (128 MB of
    Parquet can be some ten million keys) and hardly gets less rows from it.
    Equal rows meet; no group is in one task.
    """
    return df.repartition(*df.columns)


#: Bits of the map that :func:`maybe_in` sends: 2 MB, whatever the input.
MAP_BITS = 24


def mark_maybe(rows: DataFrame, wanted: DataFrame, column: str, flag: str) -> DataFrame:
    """``rows`` with a ``flag``: false where ``column`` surely is none of those of ``wanted``.

    A bit map of fixed size is broadcast. The larger ``wanted``, the more rows are marked in vain.
    """
    bit = F.pmod(F.xxhash64(column), F.lit(1 << MAP_BITS))
    maps = wanted.select(bit.alias("_bit")).groupBy(F.bitmap_bucket_number("_bit").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_map"))
    placed = rows.withColumn("_bit", bit).withColumn("_bucket", F.bitmap_bucket_number("_bit")).withColumn("_at", F.bitmap_bit_position("_bit"))
    byte = F.conv(F.hex(F.substring(F.col("_map"), (F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    # at most 2 ** MAP_BITS / 32,768 rows of 4 KB
    found = placed.join(F.broadcast(maps), "_bucket", "left")
    return found.select(*rows.columns, F.coalesce(F.floor(byte / F.pow(F.lit(2), F.col("_at") % 8)) % 2 == 1, F.lit(False)).alias(flag))


def maybe_in(rows: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` may be among those of ``wanted``, which spares the others the shuffle of the join that follows."""
    return mark_maybe(rows, wanted, column, "_maybe").filter("_maybe").select(*rows.columns)
