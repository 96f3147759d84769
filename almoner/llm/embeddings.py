"""Near-duplicate vectors: sign hashes of random hyperplanes in several tables, exact cosine, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoner.llm.components import components
from almoner.llm.groups import blocked, matrix, sides, sorted_groups, star_rows
from almoner.llm.tables import keep, same_key_runs
from almoner.llm.words import mix
from almoner.operators.skew import keyed_join

#: Vectors of one label that a bucket holds on average, and the limits of bits in a table.
BUCKET, LEAST_BITS, MOST_BITS = 64, 5, 24


def tables_for(recall: float, threshold: float, bits: int) -> int:
    """Tables after which a pair at the threshold shares a bucket with chance ``recall``."""
    agree = 1 - math.acos(threshold) / math.pi
    return math.ceil(math.log(1 - recall) / math.log(1 - agree**bits))


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest of every vector that can be compared, of its label and length too."""
    for batch in batches:
        keys, values = [], []
        for v, label in zip(batch.column("embedding").to_pylist(), batch.column("label").to_pylist(), strict=True):
            a = np.array([], float) if v is None or label is None or None in v else np.array(v, np.float64)
            if not a.size or not np.isfinite(a).all() or not a.any():
                keys.append(None)
                values.append(None)
                continue
            a = a / np.abs(a).max() + 0.0
            raw = np.append(a, [float(label), a.size]).view(np.uint64)
            salt = np.arange(1, len(raw) + 1, dtype=np.uint64)
            keys.append(b"".join(mix(mix(raw) + salt * np.uint64(c)).sum().tobytes() for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)))
            values.append(a.tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(keys, pa.binary()), pa.array(values, pa.binary())], ["vec_id", "label", "key", "vector"])


def _hashed(bits: int, count: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        powers = 1 << np.arange(bits)
        for batch in batches:
            signs = []
            for raw in batch.column("vector").to_pylist():
                v = np.frombuffer(raw)
                if len(v) not in planes:
                    planes[len(v)] = np.random.default_rng([seed, len(v)]).normal(size=(count * bits, len(v)))
                signs.append((((planes[len(v)] @ v) > 0).reshape(count, bits) @ powers).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(signs, pa.binary())], [*batch.schema.names, "signs"])

    return run


def _links(threshold: float, count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in same_key_runs(batches, ["leaf", "lo", "hi"]):
            if t.num_rows < 2:
                continue
            a, b, same = sides(t)
            at, signs = t.column("at")[0].as_py(), matrix(t.column("signs"), np.int32, count)
            v = np.stack([np.frombuffer(x) for x in t.column("vector").to_pylist()])
            norm = np.sqrt((v * v).sum(1))
            linked = v[a] @ v[b].T / (norm[a][:, None] * norm[b][None]) >= threshold
            if same:
                np.fill_diagonal(linked, False)
            # a pair counts in the first table that has it in one bucket
            for earlier in range(at if linked.any() else 0):
                linked &= signs[a, earlier][:, None] != signs[b, earlier][None]
            both = np.zeros((t.num_rows, t.num_rows), bool)
            both[a, b] |= linked
            both[b, a] |= linked.T
            yield from star_rows(t, both)

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.93, recall: float = 0.9999, seed: int = 4) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding, label; others are ignored).

    Two vectors are linked if they have one label and length and a cosine, in
    double precision, of ``threshold`` or more. Null, empty and zero vectors,
    vectors with null or non-finite components, and vectors without a label
    link with nothing. Vectors of one direction are equal from the start, so a
    group of copies is one representative; n_links counts its members.
    component_id is the least vec_id reachable, null ids aside; repeated rows
    link like other copies. An empty table gives no rows.

    The tables' bits grow with the largest label, their number with the bits,
    so that buckets stay small and a pair at the threshold is missed with less
    than ``1 - recall``. Larger buckets are compared in pairs of blocks; links
    leave a task as counts and a spanning star, never as pairs.
    """
    keyed = keep(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("int").alias("label")).mapInArrow(
        _keyed, "vec_id long, label int, key binary, vector binary"), "keyed")
    reps = keyed.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.min("label").alias("label"), F.min("vector").alias("vector"))
    reps = keep(reps, "vectors")
    largest = reps.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    bits = min(max(math.ceil(math.log2(largest / BUCKET)), LEAST_BITS), MOST_BITS)
    count = tables_for(recall, threshold, bits)
    hashed = keep(reps.drop("vec_id").mapInArrow(_hashed(bits, count, seed), "key binary, copies long, label int, vector binary, signs binary"), "hashed")
    one = lambda t: F.struct(t.alias("at"), F.xxhash64(t, "label", F.octet_length("vector"), F.substring(F.col("signs"), t * 4 + 1, F.lit(4))).alias("leaf"))
    leaves = F.explode(F.transform(F.sequence(F.lit(0), F.lit(count - 1)), one))
    sizes = hashed.select(leaves.alias("_l")).groupBy("_l.leaf").agg(F.count("*").alias("n")).where("n > 1")
    rows = hashed.withColumn("_l", leaves).select("key", "copies", "vector", "signs", "_l.at", "_l.leaf")
    rows = keyed_join(rows, sizes, ["leaf"])
    found = keep(sorted_groups(blocked(rows)).mapInArrow(_links(threshold, count), "a binary, b binary, links long"), "links")
    roots = components(found)
    least = roots.join(reps.select(F.col("key").alias("node"), "vec_id"), "node").groupBy("root").agg(F.min("vec_id").alias("component_id"))
    linked = found.groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    facts = reps.select("key", "vec_id", "copies").join(roots.join(least, "root").select(F.col("node").alias("key"), "component_id"), "key", "left").join(linked, "key", "left")
    facts = facts.select("key", F.coalesce("component_id", "vec_id").alias("component_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")).where("n_links > 0")
    out = keyed.select("vec_id", "key").join(keep(facts, "components"), "key", "left")
    own = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), own.eqNullSafe(F.col("vec_id")).alias("kept"))
