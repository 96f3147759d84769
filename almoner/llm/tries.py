"""The prefix trie of conversations: digests of prefixes, count-min screening, exact grouping of what may be shared."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almoner.llm.tables import keep
from almoner.llm.words import mix
from almoner.operators.skew import keyed_join

#: Conversations of a family share the head of its first one; heads have fewer turns than this.
FAMILY, HEADS = 5, 9
#: Turns that one window adds up; longer conversations are added up by block.
BLOCK = 4096
#: Rows of the sketch; cells of a row for each prefix; powers of two between which cells of a row stay.
ROWS, SPARE, LEAST_BITS, MOST_BITS = 3, 4, 16, 24
#: Cells that travel together (as two bit maps of 8 KB).
CELLS = 1 << 16
#: Characters of joined ids that travel as one row.
CHUNK = 1 << 16
KEYS = ["depth", "d1", "d2"]
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_NO_END = hashlib.sha256(b"").hexdigest()


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, a 128-bit digest of role and text, the text's size, and the part of the sorted table that a row is in."""
    empty = F.lit("")
    role, text = F.coalesce(F.col("role").cast("string"), empty), F.coalesce(F.col("text").cast("string"), empty)
    told = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    half = lambda at: F.conv(F.substring("_told", at, 16), 16, -10).cast("long")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), told.alias("_told"), F.octet_length(text).cast("long").alias("bytes"))
    light = rows.where("conv_id is not null").select("conv_id", "turn", half(1).alias("q1"), half(17).alias("q2"), "bytes")
    # a long conversation is divided among parts, so none is ordered by one task
    return light.repartitionByRange("conv_id", F.col("turn").asc_nulls_first(), "q1", "q2").withColumn("_part", F.spark_partition_id())


def _carried(rows: DataFrame, block: str, order: list[Column], values: dict[str, Column], combine, total) -> DataFrame:
    """Running totals along a conversation: within its blocks, plus what the blocks before (in order of ``block``) come to.

    ``combine(old, new)`` joins two totals; ``total(column)`` is the aggregate.
    """
    here = Window.partitionBy("conv_id", block).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("conv_id").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    within = rows.select("*", *[total(v).over(here).alias(f"_in_{k}") for k, v in values.items()])
    blocks = rows.groupBy("conv_id", block).agg(*[total(v).alias(f"_all_{k}") for k, v in values.items()])
    carry = blocks.select("conv_id", block, *[F.coalesce(total(F.col(f"_all_{k}")).over(before), F.lit(0)).alias(f"_to_{k}") for k in values])
    met = within.join(carry, ["conv_id", block])
    return met.select(*rows.columns, *[combine(F.col(f"_to_{k}"), F.col(f"_in_{k}")).alias(k) for k in values])


def head_turns(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string")) % HEADS).cast("int")


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, size) and their turns (conv_id, p, size, q1, q2, bytes) as rebuilt."""
    order = [F.col("turn").asc_nulls_first(), F.col("q1"), F.col("q2")]
    placed = _carried(turns, "_part", order, {"i": F.lit(1).cast("long")}, lambda a, b: a + b, F.sum)
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    first = placed.where((F.col("conv_id") == base) & (F.col("i") < HEADS)).groupBy("conv_id")
    heads = first.agg(F.array_sort(F.collect_list(F.struct("i", "q1", "q2", "bytes"))).alias("_head"))
    own = turns.groupBy("conv_id").agg(F.count("*").alias("_own"))
    convs = own.withColumns({"_base": base, "_h": head_turns(F.col("conv_id"))}).join(heads.withColumnRenamed("conv_id", "_base"), "_base", "left")
    head = F.coalesce(F.slice("_head", F.lit(1), F.col("_h")), F.array().cast("array<struct<i:bigint,q1:bigint,q2:bigint,bytes:bigint>>"))
    convs = convs.withColumn("_head", head).withColumn("_kept", F.size("_head"))
    convs = keep(convs.select("conv_id", "_h", "_head", "_kept", (F.col("_kept") + F.greatest(F.col("_own") - F.col("_h"), F.lit(0))).alias("size")), "conversations")
    given = convs.select("conv_id", "size", F.explode("_head").alias("_t")).select("conv_id", F.col("_t.i").alias("p"), "size", "_t.q1", "_t.q2", "_t.bytes")
    tail = keyed_join(placed, convs.select("conv_id", "_h", "_kept", "size"), ["conv_id"]).where("i > _h")
    tail = tail.select("conv_id", (F.col("i") - F.col("_h") + F.col("_kept")).alias("p"), "size", "q1", "q2", "bytes")
    return convs.select("conv_id", "size"), given.unionByName(tail)


def prefixes(conversations: DataFrame) -> DataFrame:
    """A row for every prefix of every rebuilt conversation: conv_id, depth, size (turns in all), bytes (of the last
    turn's text), the prefix' digest d1, d2 and that of the prefix before, p1, p2. The empty prefix has depth 0."""
    convs, turns = _rebuilt(keep(_turns(conversations), "turns"))
    marked = turns.withColumns({"_b": F.floor((F.col("p") - 1) / BLOCK), "t1": F.xxhash64("p", "q1", "q2"), "t2": F.xxhash64("q2", F.lit(HEADS), "p", "q1")})
    # a turn's mark depends on its place, so marks can be combined in any grouping
    done = _carried(marked, "_b", [F.col("p")], {"d1": F.col("t1"), "d2": F.col("t2")}, lambda a, b: a.bitwiseXOR(b), F.bit_xor)
    long = lambda v: F.lit(v).cast("long")
    rows = done.select("conv_id", F.col("p").alias("depth"), "size", "bytes", "d1", "d2", F.col("d1").bitwiseXOR(F.col("t1")).alias("p1"), F.col("d2").bitwiseXOR(F.col("t2")).alias("p2"))
    root = convs.select("conv_id", long(0).alias("depth"), "size", *[long(0).alias(c) for c in ("bytes", "d1", "d2")], *[long(None).alias(c) for c in ("p1", "p2")])
    return rows.unionByName(root)


def cells(d1: np.ndarray, d2: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The cell of each digest in every row of the sketch."""
    a, b = d1.astype(np.int64).view(np.uint64), d2.astype(np.int64).view(np.uint64)
    for k in range(ROWS):
        yield (mix(a ^ mix(b + np.uint64(k + 1))) >> np.uint64(64 - bits)).astype(np.int64) + (k << bits)


def _longs(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).fill_null(0).to_numpy(zero_copy_only=False)


def _count(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(ROWS << bits, np.uint8)
    for batch in batches:
        for at in cells(_longs(batch, "d1"), _longs(batch, "d2"), bits):
            found, times = np.unique(at, return_counts=True)
            counts[found] = np.minimum(counts[found] + np.minimum(times, 2), 2)
    for k, block in enumerate(counts.reshape(-1, CELLS)):
        if block.any():
            yield pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int32()), "once": [np.packbits(block > 0).tobytes()], "twice": [np.packbits(block > 1).tobytes()]})


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, once, twice = None, np.zeros(0, np.uint8), np.zeros(0, np.uint8)
    row = lambda: pa.RecordBatch.from_pydict({"block": pa.array([last], pa.int32()), "once": [once.tobytes()], "twice": [twice.tobytes()]})
    for batch in batches:
        for block, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
            if block == last:
                once, twice = once | a, twice | b | (once & a)
            else:
                if last is not None:
                    yield row()
                last, once, twice = block, a, b
    if last is not None:
        yield row()


def sketch(rows: DataFrame, bits: int) -> np.ndarray:
    """Bit map of the cells that hold two or more prefixes of ``rows``: count-min counters that stop at two.

    A task sends a bit map for each block of cells that it has met, and blocks are merged one by one; the driver gets
    ROWS * 2 ** bits bits (6 MB at most), whatever the input.
    """
    kind = "block int, once binary, twice binary"
    parts = rows.select("d1", "d2").mapInArrow(partial(_count, bits=bits), kind)
    merged = parts.repartition("block").sortWithinPartitions("block").mapInArrow(_merge, kind).select("block", "twice")
    full = np.zeros((ROWS << bits) // 8, np.uint8).reshape(-1, CELLS // 8)
    for r in merged.collect():
        full[r["block"]] = np.frombuffer(r["twice"], np.uint8)
    return full.ravel()


def _screen(batches: Iterator[pa.RecordBatch], full: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    def alone(d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
        out = np.zeros(len(d1), bool)
        for at in cells(d1, d2, bits):
            out |= (full[at >> 3] >> (7 - (at & 7)) & 1) == 0
        return out

    for batch in batches:
        depth = _longs(batch, "depth")
        now = alone(_longs(batch, "d1"), _longs(batch, "d2")) & (depth > 0)
        before = alone(_longs(batch, "p1"), _longs(batch, "p2")) & (depth > 1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(now), pa.array(before)], [*batch.schema.names, "alone", "alone_before"])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and id to joined ids of a bounded length."""
    last, first, ids, size = None, None, [], 0

    def row():
        return pa.RecordBatch.from_pydict({**{k: pa.array([v], pa.int64()) for k, v in zip(KEYS, last, strict=True)}, "first": pa.array([first], pa.int64()), "ids": [",".join(ids)]})

    for batch in batches:
        for *key, conv in zip(*(batch.column(c).to_pylist() for c in [*KEYS, "conv_id"]), strict=True):
            if key != last or size >= CHUNK:
                if last is not None:
                    yield row()
                last, first, ids, size = key, conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
    if last is not None:
        yield row()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, state = None, None

    def row():
        return pa.RecordBatch.from_pydict({**{k: pa.array([v], pa.int64()) for k, v in zip(KEYS, last, strict=True)}, "ends_sha256": [state.hexdigest()]})

    for batch in batches:
        for *key, ids in zip(*(batch.column(c).to_pylist() for c in [*KEYS, "ids"]), strict=True):
            if key == last:
                state.update(b",")
            else:
                if last is not None:
                    yield row()
                last, state = key, hashlib.sha256()
            state.update(ids.encode())
    if last is not None:
        yield row()


def ends(rows: DataFrame) -> DataFrame:
    """KEYS and ``ends_sha256`` of the conversations in ``rows`` that end at a node.

    Ids are joined range by range; only the joined pieces of a node meet in one task, which takes them in one after the
    other and holds one at a time.
    """
    kind = "depth long, d1 long, d2 long, "
    some = rows.select(*KEYS, "conv_id").repartitionByRange(*KEYS, "conv_id").sortWithinPartitions(*KEYS, "conv_id")
    pieces = some.mapInArrow(_chunks, kind + "first long, ids string")
    return pieces.repartition(*KEYS).sortWithinPartitions(*KEYS, "first").mapInArrow(_hashes, kind + "ends_sha256 string")


def _single_nodes(rows: DataFrame, parent: str = "conv_id") -> DataFrame:
    """Nodes of one conversation only."""
    ended = F.col("depth") == F.col("size")
    one = F.lit(1).cast("long")
    end = F.when(ended, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(_NO_END)
    return rows.select("conv_id", "depth", F.col(parent).alias("parent_conv_id"), one.alias("n_convs"), (~ended).cast("long").alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), end.alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """The trie of all rebuilt conversations, one row per node: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens (bytes that sharing saves in the subtree), ends_sha256.

    A conversation is rebuilt from the first turns of its family's first one and its own turns after as many (see
    FAMILY, HEADS, :func:`head_turns`). Turns are ordered by ``turn``, null first; ties by a digest of role and text;
    repeated rows are repeated turns. Null roles and texts are empty. Rows without conv_id belong to no conversation and
    are left out. Other columns are not used. An empty table has no node, not even a root.

    Prefixes are told apart by 128-bit digests made from SHA-256 of each turn; texts are not moved. A count-min sketch
    of all prefixes (counters stop at two) proves most prefixes single: their nodes are made where they are read. The
    others are grouped exactly. The sketch grows with the prefixes up to 2 ** ``most_bits`` cells a row; beyond that
    it proves fewer, and more prefixes are grouped, with the same result. Sums over a subtree are sums over its members:
    a node's own amounts lie with its smallest member, and what a member has below a prefix is a running sum along it.
    """
    found = keep(prefixes(conversations), "prefixes")
    inner = found.where("depth > 0")
    bits = min(max((SPARE * inner.count()).bit_length(), LEAST_BITS), most_bits)
    full = sketch(inner, bits)
    kind = found.schema.simpleString()[len("struct<") : -1] + ",alone:boolean,alone_before:boolean"
    seen = keep(found.mapInArrow(partial(_screen, full=full, bits=bits), kind), "screened")
    sure = _single_nodes(seen.where("alone and alone_before"))
    # the first prefix proven single; all longer ones of the conversation are single, too
    single = seen.where("alone and not alone_before").groupBy("conv_id").agg(F.min("depth").alias("_from"))
    rest = keep(keyed_join(seen.where("not (alone and alone_before)"), single, ["conv_id"], "left"), "shared")
    late, edge, shared = rest.where("depth > _from"), rest.where("depth = _from"), rest.where("_from is null or depth < _from")

    groups = shared.groupBy(*KEYS).agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("rep"), F.max("size").alias("_most"), *[F.max(c).alias(c) for c in ("bytes", "p1", "p2")])
    nodes = keep(groups, "nodes")
    members = keyed_join(shared.select("conv_id", "size", *KEYS), nodes.select(*KEYS, "n_convs", "rep", "_most", "bytes"), KEYS)
    own = F.col("rep") == F.col("conv_id")
    nought = F.lit(0).cast("long")
    amounts = members.select("conv_id", *KEYS, F.when(own, (F.col("n_convs") - 1) * F.col("bytes")).otherwise(nought).alias("_saves"), (own & (F.col("depth") == F.col("size")) & (F.col("_most") == F.col("size"))).cast("long").alias("_leaf"))
    amounts = amounts.unionByName(edge.select("conv_id", *KEYS, nought.alias("_saves"), F.lit(1).cast("long").alias("_leaf")))
    # from the end of a conversation towards its beginning
    below = _carried(amounts.withColumn("_b", -F.floor(F.col("depth") / BLOCK)), "_b", [F.col("depth").desc()], {"saved_tokens": F.col("_saves"), "n_leaves": F.col("_leaf")}, lambda a, b: a + b, F.sum)
    # a conversation's edge is no member of a shared node; sums by its key go nowhere
    sums = below.groupBy(*KEYS).agg(F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"))

    up = lambda df: df.select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2"))
    kids = up(nodes.where("depth > 0")).unionByName(up(edge)).groupBy(*KEYS).agg(F.count("*").alias("n_children"))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("rep").alias("parent_conv_id"))
    parents = lambda df: keyed_join(df, above, ["depth", "p1", "p2"], "left")

    whole = parents(nodes).join(sums, KEYS).join(kids, KEYS, "left").join(ends(shared.where("depth = size")), KEYS, "left")
    whole = whole.select(
        F.col("rep").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", nought).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_NO_END)).alias("ends_sha256"),
    )
    first = _single_nodes(parents(edge), "parent_conv_id")
    return whole.select(*NODE).unionByName(first).unionByName(sure).unionByName(_single_nodes(late))
