"""Comparing the members of buckets of any size in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Members of a block; two blocks at most are in memory at once.
BLOCK = 512


def blocked(rows: DataFrame) -> DataFrame:
    """Each row (with ``key`` and its bucket's size ``n``) once for every pair of blocks of its bucket that it is needed in."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("key"), blocks).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: F.struct(F.least(j, own).alias("lo"), F.greatest(j, own).alias("hi")))
    return rows.withColumn("own", own).withColumn("_b", F.explode(pairs)).select(*rows.columns, "own", "_b.lo", "_b.hi")


def sorted_groups(rows: DataFrame) -> DataFrame:
    """Rows of one pair of blocks of one bucket (``leaf``) next to each other, the lower block first."""
    return rows.repartition(F.col("leaf"), F.col("lo"), F.col("hi")).sortWithinPartitions("leaf", "lo", "hi", "own", "key")


def sides(t: pa.Table) -> tuple[slice, slice, bool]:
    """The two sides to compare of such a group; the flag tells that they are one block."""
    lo, hi, own = t.column("lo")[0].as_py(), t.column("hi")[0].as_py(), t.column("own").to_numpy()
    if lo == hi:
        return slice(0, len(own)), slice(0, len(own)), True
    k = int(np.searchsorted(own, hi))
    return slice(0, k), slice(k, len(own)), False


def local_roots(linked: np.ndarray) -> np.ndarray:
    """The first member of each row's component in a small symmetric matrix of links."""
    root = np.arange(len(linked))
    while True:
        least = np.where(linked, root[None], len(root)).min(1, initial=len(root))
        new = np.minimum(root, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def matrix(column: pa.ChunkedArray, kind: type, width: int) -> np.ndarray:
    """Rows of equal length from a binary column."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def star_rows(t: pa.Table, both: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What a symmetric matrix of links leaves of a group: for every linked member ``a`` the first member ``b`` of its
    component, and ``links``, the rows that it is linked with (``copies`` of each)."""
    has = both.any(1)
    if has.any():
        keys, copies = np.array(t.column("key").to_pylist(), object), t.column("copies").to_numpy().astype(np.float64)
        more, root = (both @ copies).astype(np.int64), local_roots(both)
        yield pa.RecordBatch.from_arrays([pa.array(keys[has].tolist(), pa.binary()), pa.array(keys[root[has]].tolist(), pa.binary()), pa.array(more[has])], ["a", "b", "links"])
