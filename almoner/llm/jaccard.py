"""Jaccard self-join of texts by chosen paths.

Each text is a set of word shingles, embedded as min-hash tokens. A run
sends a set down a path: at each node one coordinate is drawn and the sets
part by their token there, so two sets stay together with a chance equal to
their similarity. Buckets of at most ``SMALL`` sets, and larger ones that a
further token would hardly divide, are compared completely; the rest are
split again. Runs repeat until a pair at the threshold is missed with less
than ``1 - recall``; each draws coordinates that no other run has, so that runs
are independent.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.llm.components import components
from almoner.llm.groups import BLOCK, blocked, matrix, sides, sorted_groups, star_rows
from almoner.llm.tables import cut, keep, same_key_runs, text_bytes
from almoner.llm.words import mix, shingles, words_of
from almoner.operators.skew import keyed_join, maybe_in

#: Tokens that similarity is estimated from before sets are compared; a sketch has a byte of each.
COORDINATES = 64
#: A bucket up to this many sets is not split.
SMALL = BLOCK
#: A bucket is dense, and not split, if one token is common to this share of it.
DENSE = 0.5
MAX_DEPTH = 6
#: A pair is looked at exactly if its tokens agree in this many standard deviations below the threshold.
SLACK = 5.0
_CHUNK, MAP_BITS = 4 << 20, 24


def _seeds(first: int, count: int) -> np.ndarray:
    return (mix(np.arange(first, first + count, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def minhash(sets: list[np.ndarray], width: int = COORDINATES) -> np.ndarray:
    """``width`` tokens (sets x coordinates) of sets that are not empty."""
    factor, plus = _seeds(1, width) | np.uint32(1), _seeds(1 << 32, width)
    h = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), width), np.uint32)
    for j in range(width):
        v = h * factor[j] + plus[j]
        v ^= v >> np.uint32(15)
        v *= np.uint32(0x85EBCA6B)
        out[:, j] = np.minimum.reduceat(v, starts)
    return out


def _signed(width: int, coordinates: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in cut(whole, "text", _CHUNK):
                w = words_of(*text_bytes(batch.column("text")))
                sets = shingles(w.hashes, w.bounds, width)
                full = [i for i, s in enumerate(sets) if len(s)]
                keys, tokens, sketches = [None] * len(sets), [None] * len(sets), [None] * len(sets)
                if full:
                    some = [sets[i] for i in full]
                    starts, flat = np.cumsum([0, *map(len, some[:-1])]), np.concatenate(some)
                    one, two = (np.add.reduceat(mix(flat ^ np.uint64(s)), starts) for s in (0x5851F42D4C957F2D, 0x14057B7EF767814F))
                    digest, sig = np.stack([one, two], 1), minhash(some, coordinates)
                    short = sig[:, :COORDINATES].astype(np.uint8)
                    for k, i in enumerate(full):
                        keys[i], tokens[i], sketches[i] = digest[k].tobytes(), sig[k].tobytes(), short[k].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text_hash"), pa.array(keys, pa.binary()), pa.array(map(len, sets), pa.int64()), pa.array(tokens, pa.binary()), pa.array(sketches, pa.binary())],
                    ["doc_id", "text_hash", "key", "n_shingles", "tokens", "sketch"],
                )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in cut(whole, "text", _CHUNK):
                w = words_of(*text_bytes(batch.column("text")))
                sets = [s.tobytes() for s in shingles(w.hashes, w.bounds, width)]
                yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sets, pa.binary())], ["key", "shingles"])

    return run


def _token(coordinate: int) -> Column:
    return F.substring("tokens", 4 * coordinate + 1, 4)


def runs_for(recall: float, threshold: float, depth: int) -> int:
    """Runs after which a pair at the threshold was together in a bucket ``depth`` tokens down with chance ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**depth) - 1e-9)


def _coordinate(run: int, level: int) -> int:
    """A coordinate that no other level of any run has."""
    return run * MAX_DEPTH + level


def coordinates_for(runs: int) -> int:
    return max(COORDINATES, runs * MAX_DEPTH)


def _bucket(run: int, depth: int) -> Column:
    """The bucket that a set's first ``depth`` tokens of a run lead to: a hash down the path."""
    number = F.lit(run)
    for level in range(depth):
        number = F.xxhash64(number, _token(_coordinate(run, level)))
    return number


def _in_runs(signed: DataFrame, first: int, last: int, **buckets: int) -> DataFrame:
    """Rows (key, run) with the buckets at these depths, from the tokens where they lie."""
    each = [F.struct(F.lit(r).alias("run"), *[_bucket(r, depth).alias(name) for name, depth in buckets.items()]) for r in range(first, last)]
    return signed.select("key", F.explode(F.array(*each)).alias("_p")).select("key", "_p.*")


def _paths(signed: DataFrame, first: int, last: int) -> tuple[DataFrame, DataFrame | None, int]:
    """Buckets of two or more sets in these runs, as rows (key, run, leaf, n); rows (key, run, leaf, depth) of sets that went
    further than one token, also of those that ended alone; the greatest depth.

    Tokens are not moved: a further token is read where it lies, and only rows of buckets that are too large leave.
    """
    level = _in_runs(signed, first, last, leaf=1)
    done, deeper, depth = [], [], 1
    while True:
        sizes = level.groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1")
        now = keep(keyed_join(level, sizes, ["leaf"]).select("key", "run", "leaf", "n"), "paths")
        large = now.where(F.col("n") > SMALL).groupBy("leaf").agg(F.min("n").alias("n"))
        if depth == MAX_DEPTH or large.isEmpty():
            done.append(now)
            break
        large = keep(large, "large")
        # a bucket's number tells the whole path to it, so whoever has it came through buckets that were split
        further = maybe_in(_in_runs(signed, first, last, leaf=depth, child=depth + 1), large, "leaf")
        below = keep(keyed_join(further, large, ["leaf"]).select("key", "run", "leaf", "n", "child"), "paths")
        most = below.groupBy("leaf", "n", "child").count().groupBy("leaf").agg((F.max("count") >= DENSE * F.first("n")).alias("dense"))
        split = keep(most.where("not dense").select("leaf"), "split")
        done.append(now.join(split, "leaf", "left_anti").select("key", "run", "leaf", "n"))
        level = below.join(split, "leaf", "left_semi").select("key", "run", F.col("child").alias("leaf"))
        depth += 1
        deeper.append(level.select("key", "run", "leaf", F.lit(depth).alias("depth")))
    return reduce(DataFrame.unionByName, done), reduce(DataFrame.unionByName, deeper) if deeper else None, depth


_LOW = 0xFFFFFFFF


def _leaves(reps: DataFrame, runs: int, deeper: DataFrame | None) -> DataFrame:
    """``key, sketch, leaves``: the bucket that a set ends in, in every run, as four bytes of its number: that of the first
    token, or of the greatest depth that ``deeper`` has for the set and run."""
    four = lambda number: F.lpad(F.hex(number.bitwiseAND(F.lit(_LOW))), 8, "0")
    about = reps.select("key", "sketch", F.unhex(F.concat(*[four(_bucket(r, 1)) for r in range(runs)])).alias("leaves"))
    if deeper is None:
        return about
    last = F.shiftleft(F.col("depth").cast("long"), 32) + F.col("leaf").bitwiseAND(F.lit(_LOW))
    ends = deeper.groupBy("key").agg(*[F.max(F.when(F.col("run") == r, last)).alias(f"_{r}") for r in range(runs)])
    each = [F.coalesce(four(F.col(f"_{r}")), F.hex(F.substring("leaves", 4 * r + 1, 4))) for r in range(runs)]
    return about.join(ends, "key", "left").select("key", "sketch", F.unhex(F.concat(*each)).alias("leaves"))


def _first_time(leaves: np.ndarray, a: slice, b: slice, run: int) -> np.ndarray:
    """Of pairs in one bucket of ``run``: those that no earlier run has in one bucket."""
    new = np.ones((len(leaves[a]), len(leaves[b])), bool)
    for r in range(run):
        new &= leaves[a, r][:, None] != leaves[b, r][None]
    return new


def _candidates(runs: int, least: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in same_key_runs(batches, ["leaf", "lo", "hi"]):
            if t.num_rows < 2:
                continue
            sketch, leaves = matrix(t.column("sketch"), np.uint8, COORDINATES), matrix(t.column("leaves"), np.uint32, runs)
            run, hit = t.column("run")[0].as_py(), np.zeros(t.num_rows, bool)
            a, b, same = sides(t)
            agree = np.zeros((len(sketch[a]), len(sketch[b])), np.uint8)
            for j in range(COORDINATES):
                agree += sketch[a, j][:, None] == sketch[b, j][None]
            ok = agree >= least
            if same:
                np.fill_diagonal(ok, False)
            if ok.any():
                ok &= _first_time(leaves, a, b, run)
                hit[a] |= ok.any(1)
                hit[b] |= ok.any(0)
            if hit.any():
                yield from t.select(["key", "run", "leaf", "n"]).filter(pa.array(hit)).combine_chunks().to_batches()

    return go


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of sorted distinct arrays."""
    n = len(sets)
    out = np.zeros((n, n), np.float32)
    np.fill_diagonal(out, [len(s) for s in sets])
    if n == 2:
        out[0, 1] = out[1, 0] = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return out
    flat, row = np.concatenate(sets), np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    used = shared[column]
    row, column = row[used], number[column[used]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width, total = max(1, (8 << 20) // n), int(shared.sum())
    inter = np.zeros((n, n), np.float32)
    for start in range(0, total, width):
        i, j = np.searchsorted(column, (start, start + width))
        m = np.zeros((n, min(width, total - start)), np.float32)
        m[row[i:j], column[i:j] - start] = 1
        inter += m @ m.T
    np.fill_diagonal(inter, np.diag(out))
    return inter


def _links(runs: int, threshold: float):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in same_key_runs(batches, ["leaf", "lo", "hi"]):
            if t.num_rows < 2:
                continue
            leaves = matrix(t.column("leaves"), np.uint32, runs)
            sets = [np.frombuffer(s, np.uint64) for s in t.column("shingles").to_pylist()]
            run = t.column("run")[0].as_py()
            inter = intersections(sets).astype(np.float64)
            sizes = np.diag(inter)
            linked = inter >= threshold * (sizes[:, None] + sizes[None] - inter) - 1e-9
            np.fill_diagonal(linked, False)
            a, b, _ = sides(t)
            part, both = linked[a, b] & _first_time(leaves, a, b, run), np.zeros_like(linked)
            both[a, b] |= part
            both[b, a] |= part.T
            yield from star_rows(t, both)

    return go


def _maybe_in(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose text_hash may be in ``wanted``: a bit map of fixed size (2 MB) spares the others a shuffle."""
    bit = lambda h: F.pmod(h, F.lit(1 << MAP_BITS))
    maps = wanted.withColumn("_bit", bit(F.col("text_hash"))).groupBy(F.bitmap_bucket_number("_bit").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_map"))
    own = docs.withColumn("_bit", bit(F.col("text_hash"))).withColumn("_bucket", F.bitmap_bucket_number("_bit")).withColumn("_at", F.bitmap_bit_position("_bit"))
    byte = F.conv(F.hex(F.substring(F.col("_map"), (F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    # at most 2 ** MAP_BITS / 32,768 rows of 4 KB
    found = own.join(F.broadcast(maps), "_bucket").where(F.floor(byte / F.pow(F.lit(2), F.col("_at") % 8)) % 2 == 1)
    return found.select(*docs.columns)


def similar_texts(docs: DataFrame, threshold: float = 0.8, width: int = 5, recall: float = 0.9999) -> DataFrame:
    """Classes of near-duplicate texts and every text's number of links.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. Two texts
    are linked if the Jaccard similarity of their sets of ``width``-word
    shingles is ``threshold`` or more; texts with equal sets always are. One
    row per input row: doc_id, text_hash (xxhash64 of the text), class_id
    (least doc_id reachable by links, null ids last), n_links, n_shingles.
    Texts of fewer words are one shingle; null texts and texts without words
    link with nothing and are their own class. Repeated rows link like any
    other copies. An empty table gives no rows.

    Equal sets are one representative from the start, so a group of copies,
    however large, is one row in all that follows. Counts and classes are
    exact for the pairs found; verification reads the whole sets.
    """
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    signed = keep(named.mapInArrow(_signed(width, coordinates_for(runs_for(recall, threshold, MAX_DEPTH))), "doc_id long, text_hash long, key binary, n_shingles long, tokens binary, sketch binary"), "signed")
    # equal texts have equal keys, so one text_hash and one row of tokens stand for a key
    reps = keep(
        signed.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.min("text_hash").alias("text_hash"), F.min("tokens").alias("tokens"), F.min("sketch").alias("sketch")), "sets"
    )
    runs, wanted, depth = 0, runs_for(recall, threshold, 2), 1
    paths, deeper = [], []
    while wanted > runs:
        more, below, reached = _paths(reps, runs, wanted)
        paths.append(more)
        deeper += [below] if below is not None else []
        # later runs may go deeper than those before
        runs, depth = wanted, max(depth, reached)
        wanted = runs_for(recall, threshold, depth)
    paths = reduce(DataFrame.unionByName, paths)
    about = _leaves(reps, runs, reduce(DataFrame.unionByName, deeper) if deeper else None)
    # a row of a bucket takes a sketch and the numbers of its buckets along, no tokens
    about = keep(about, "about")
    least = math.floor(COORDINATES * (threshold - SLACK * math.sqrt(threshold * (1 - threshold) / COORDINATES)))
    rows = sorted_groups(blocked(paths.select("key", "run", "leaf", "n").join(about, "key")))
    hits = rows.mapInArrow(_candidates(runs, least), "key binary, run int, leaf long, n long")
    hits = keep(hits.distinct(), "candidates")
    left = keep(hits.select("key").distinct().join(reps.select("key", "text_hash"), "key"), "candidates")
    texts = _maybe_in(named, left.select("text_hash")).groupBy("text_hash").agg(F.min("text").alias("text"))
    texts = texts.join(left.select("text_hash", "key"), "text_hash").select("key", "text")
    sets = keep(texts.mapInArrow(_sets(width), "key binary, shingles binary"), "shingles")
    counted = hits.groupBy("leaf").agg(F.count("*").alias("n"))
    rows = keyed_join(hits.drop("n"), counted, ["leaf"]).join(about.drop("sketch"), "key").join(reps.select("key", "copies"), "key").join(sets, "key")
    found = keep(sorted_groups(blocked(rows)).mapInArrow(_links(runs, threshold), "a binary, b binary, links long"), "links")
    roots = components(found)
    least_id = roots.join(reps.select(F.col("key").alias("node"), "doc_id"), "node").groupBy("root").agg(F.min("doc_id").alias("class_id"))
    classes = roots.join(least_id, "root").select(F.col("node").alias("key"), "class_id")
    links = found.groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    facts = keep(
        reps.select("key", "doc_id", "copies").join(classes, "key", "left").join(links, "key", "left")
        .select("key", F.coalesce("class_id", "doc_id").alias("class_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
        .where("n_links > 0"), "classes",
    )
    return signed.drop("tokens", "sketch").join(facts, "key", "left").select(
        "doc_id", "text_hash", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "n_shingles"
    )


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stand for their class: all columns, one row per class (rows without words all stay)."""
    found = similar_texts(docs, **options)
    stay = found.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("doc_id", "text_hash").agg(F.count("*").alias("_n"), F.max("n_links").alias("_l"))
    stay = keep(stay.withColumnsRenamed({"doc_id": "_id", "text_hash": "_h"}), "stay")
    joined = docs.withColumn("_t", F.xxhash64("text")).join(stay, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_t") == F.col("_h")))
    repeated = stay.where("_n > 1 and _l > 0")
    if repeated.isEmpty():
        return joined.select(*docs.columns)
    # rows that repeat id and text: one of them
    once, again = joined.where("_n = 1 or _l = 0").select(*docs.columns), joined.where("_n > 1 and _l > 0")
    return once.unionByName(again.dropDuplicates(["_id", "_h"]).select(*docs.columns))
