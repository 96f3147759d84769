"""Sharding by sampled splitters: ranges of a key, near equal in bytes, dealt to shards."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from almoner.llm.tables import keep

#: Ranges per shard at least, and of all shards at most; sampled keys per range.
RANGES, MOST_RANGES, SAMPLES = 64, 1 << 14, 12
#: A range above this share of a shard is divided; one key alone only above WHOLE of a shard.
PART, WHOLE = 1 / 16, 1 / 2


def sample_keys(keyed: DataFrame, total: int, wanted: int) -> np.ndarray:
    """Keys drawn by size: a row of size s comes with chance ``min(1, s * wanted / total)``, so about ``wanted`` of them."""
    draw = F.pmod(F.xxhash64(F.lit(17), "_key", "_tie"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = keyed.where(draw * F.lit(float(max(total, 1))) < F.col("_size") * F.lit(float(wanted))).select("_key", F.greatest("_size", F.lit(total // max(wanted, 1))).alias("w")).collect()
    return np.array([(r[0], r[1]) for r in rows], np.int64).reshape(-1, 2)


def splitters(sample: np.ndarray, ranges: int) -> np.ndarray:
    """First keys of the ranges: weighted quantiles; a key that several quantiles meet gets a range of its own."""
    if not len(sample):
        return np.zeros(0, np.int64)
    key, weight = sample[np.argsort(sample[:, 0], kind="stable")].T
    at = np.searchsorted(np.cumsum(weight), weight.sum() * np.arange(1, ranges) / ranges)
    cuts, times = np.unique(key[np.minimum(at, len(key) - 1)], return_counts=True)
    heavy = cuts[(times > 1) & (cuts < np.iinfo(np.int64).max)]
    return np.unique(np.concatenate([cuts, heavy + 1]))


def _placed(cuts: np.ndarray, low: np.ndarray, width: np.ndarray, pieces: np.ndarray, alone: np.ndarray):
    """Adds to each row its range, and its piece of that range where ``pieces`` says that it is divided."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, tie = b.column("_key").to_numpy(), b.column("_tie").to_numpy()
            r = np.searchsorted(cuts, key, "right")
            place = np.zeros(len(key), np.int64)
            if len(pieces):
                n = pieces[r]
                spread = np.where(alone[r], tie.astype(np.float64) / 2.0**64 + 0.5, (key.astype(np.float64) - low[r]) / width[r])
                place = np.clip((spread * n).astype(np.int64), 0, n - 1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(r.astype(np.int64)), pa.array(place)], [*b.schema.names, "_range", "_piece"])

    return run


def deal(sizes: list[int], shards: int) -> list[int]:
    """A shard for every piece: the largest first, each to the shard with the least so far."""
    out, heap = [0] * len(sizes), [(0, s) for s in range(shards)]
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        full, s = heapq.heappop(heap)
        out[i] = s
        heapq.heappush(heap, (full + sizes[i], s))
    return out


def shard_documents(docs: DataFrame, shards: int, size: Column, key: Column, ties: list[str]) -> DataFrame:
    """``docs`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard); sizes of shards are near equal.

    Rows are in order of ``key`` (a long) and a hash of the columns ``ties``.
    A size-weighted sample of keys gives quantile boundaries, many ranges to
    a shard; rows are range-partitioned by them and the ranges' true sizes
    counted. A range that came out too large is subdivided, by key, or, if it
    is one key alone and more than half a shard, by the ties. Pieces then go
    to shards, the largest first. Rows of one key are in one shard, unless
    they are more than half a shard.

    Rows with a null key must be given one by the caller; sizes of null count
    0; equal rows get slots in any order; an empty table gives no rows.
    Columns ``shard`` and ``slot`` and those that begin with ``_`` are replaced. The driver
    gets at most MOST_RANGES * SAMPLES sampled keys (3 MB) and a row per piece.
    """
    spark = docs.sparkSession
    plain = [c for c in docs.columns if c not in ("shard", "slot") and not c.startswith("_")]
    keyed = keep(docs.select(*plain, F.coalesce(size, F.lit(0)).cast("long").alias("_size"), key.alias("_key"), F.xxhash64(F.lit(3), *ties).alias("_tie")), "keyed")
    total = int(keyed.agg(F.sum("_size")).first()[0] or 0)
    ranges = min(max(RANGES * shards, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))), MOST_RANGES)
    cuts = splitters(sample_keys(keyed, total, ranges * SAMPLES), ranges)
    none = np.zeros(0)
    with_range = lambda f: keyed.mapInArrow(f, keyed.select("*", F.lit(0).cast("long").alias("_range"), F.lit(0).cast("long").alias("_piece")).schema)
    found = with_range(_placed(cuts, none, none, none, none)).groupBy("_range").agg(F.sum("_size").alias("s"), F.min("_key").alias("a"), F.max("_key").alias("b")).collect()
    low, width, pieces, alone = np.zeros(len(cuts) + 1), np.ones(len(cuts) + 1), np.ones(len(cuts) + 1, np.int64), np.zeros(len(cuts) + 1, bool)
    for r in found:
        i, most = r["_range"], total / shards
        low[i], width[i], alone[i] = float(r["a"]), float(r["b"]) - float(r["a"]) + 1, r["a"] == r["b"]
        if r["s"] > most * (WHOLE if alone[i] else PART):
            pieces[i] = -(-r["s"] // max(1, int(most * PART)))
    placed = with_range(_placed(cuts, low, width, pieces, alone))
    counts = sorted(tuple(r) for r in placed.groupBy("_range", "_piece").agg(F.sum("_size").alias("s"), F.count("*").alias("n")).collect())
    given, filled, rows = deal([c[2] for c in counts], shards), [0] * shards, []
    for (r, p, _, n), s in zip(counts, given, strict=True):
        rows.append((r, p, s, filled[s]))
        filled[s] += n
    # a row per piece, as many as there are ranges and their divisions
    facts = F.broadcast(spark.createDataFrame(rows, "_range long, _piece long, shard int, _start long"))
    order = W.partitionBy("_range", "_piece").orderBy("_key", "_tie", *ties)
    return placed.withColumn("_at", F.row_number().over(order)).join(facts, ["_range", "_piece"]).select(*plain, "shard", (F.col("_start") + F.col("_at") - 1).alias("slot"))
