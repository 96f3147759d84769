"""Benchmark decontamination by suffix arrays over the training words.

Every task cuts its documents into shards of whole documents, sorts all word
suffixes of a shard, and binary-searches every suffix of the benchmark in
them: the longest verbatim match of each, and all places of the windows that
decide. The benchmark is a stated query set; it is sent in blocks of bounded
size. Documents never move.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almoner.llm.tables import cut, keep, text_bytes
from almoner.llm.words import words_of

#: Text of the benchmark held by a task at once, and text of a shard (a longer document is a shard by itself).
BLOCK_BYTES, SHARD_BYTES = 4 << 20, 6 << 20
MATCH = "item_id long, item_start long, doc_start long, n_words long"


@dataclass
class Block:
    """Benchmark items end to end, one separator (0) after each. ``depth``: words of the longest item."""

    hashes: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    left: np.ndarray
    window: np.ndarray
    depth: int


def block_of(rows: list[tuple[int, str | None]], window: int) -> Block:
    w = words_of(*text_bytes(pa.array([t for _, t in rows], pa.string())))
    sizes = np.diff(w.bounds)
    n = int((sizes + 1).sum())
    hashes, item, offset, left, need = np.zeros(n, np.uint64), np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, window, np.int64)
    at = 0
    for (name, _), a, size in zip(rows, w.bounds[:-1], sizes, strict=True):
        hashes[at : at + size] = w.hashes[a : a + size] | np.uint64(1)
        item[at : at + size], offset[at : at + size], left[at : at + size] = name, np.arange(size), size - np.arange(size)
        need[at : at + size] = min(window, size)
        at += size + 1
    return Block(hashes, item, offset, left, need, int(sizes.max(initial=0)))


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes ordered by their first ``depth`` symbols at least (prefix doubling, only unsettled groups are sorted again)."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    change = np.ones(n, bool)
    change[1:] = symbols[order[1:]] != symbols[order[:-1]]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    # a group's rank is the place of its first suffix, so ranks of settled suffixes never change
    rank[order] = np.maximum.accumulate(np.where(change, np.arange(n), 0))
    have = 1
    while have < depth:
        open_ = ~(change & np.append(change[1:], True))
        places = np.flatnonzero(open_)
        if not len(places):
            break
        who = order[places]
        key = (rank[who] << np.int64(32)) | (rank[np.minimum(who + have, n)] + 1)
        by = np.argsort(key, kind="stable")
        order[places], key = who[by], key[by]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        change[places] = new
        rank[order[places]] = np.maximum.accumulate(np.where(new, places, 0))
        have *= 2
    return order


def common(symbols: np.ndarray, at: np.ndarray, block: Block, query: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Words in which the suffix ``at`` of the shard and the suffix ``query`` of the block agree, up to ``most``."""
    out = np.zeros(len(at), np.int64)
    live = np.flatnonzero(most > 0)
    while len(live):
        k = out[live]
        ok = (at[live] + k < len(symbols)) & (k < most[live])
        live, k = live[ok], k[ok]
        same = symbols[at[live] + k] == block.hashes[query[live] + k]
        live = live[same]
        out[live] += 1
    return out


def bound(symbols: np.ndarray, order: np.ndarray, block: Block, query: np.ndarray, most: np.ndarray, after: bool) -> np.ndarray:
    """Binary search: the first place whose suffix, cut to ``most`` words, is not below (``after``: is above) the query's."""
    low, high = np.zeros(len(query), np.int64), np.full(len(query), len(order), np.int64)
    while (live := np.flatnonzero(low < high)).size:
        middle = (low[live] + high[live]) // 2
        at, q = order[middle], query[live]
        k = common(symbols, at, block, q, most[live])
        whole = k == most[live]
        inside = at + k < len(symbols)
        mine = np.where(inside, symbols[np.minimum(at + k, len(symbols) - 1)], np.uint64(0))
        theirs = block.hashes[np.minimum(q + k, len(block.hashes) - 1)]
        below = np.where(whole, after, ~inside | (mine < theirs))
        low[live] = np.where(below, middle + 1, low[live])
        high[live] = np.where(below, high[live], middle)
    return low


def search(hashes: np.ndarray, bounds: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Longest match of every benchmark suffix in one shard: (words, start in the shard); documents don't run into each other."""
    symbols, order = _sorted_shard(hashes, bounds, block.depth)
    place, _, length = _longest(symbols, order, block)
    return length, place


def _sorted_shard(hashes: np.ndarray, bounds: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    docs = len(bounds) - 1
    symbols = np.zeros(len(hashes) + docs, np.uint64)
    symbols[np.arange(len(hashes)) + np.repeat(np.arange(docs), np.diff(bounds))] = hashes | np.uint64(1)
    return symbols, suffix_array(symbols, depth)


def _longest(symbols: np.ndarray, order: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    query = np.flatnonzero(block.left > 0)
    place, length = np.zeros(len(query), np.int64), np.zeros(len(query), np.int64)
    if len(order):
        here = bound(symbols, order, block, query, block.left[query], False)
        for near in (here - 1, here):
            at = order[np.clip(near, 0, len(order) - 1)]
            k = common(symbols, at, block, query, block.left[query])
            better = k > length
            place, length = np.where(better, at, place), np.where(better, k, length)
    return place, query, length


def matches(symbols: np.ndarray, order: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in the block, place in the shard, words) of every longest match that holds a window.

    A match begins where a window occurs and the words before it differ. The
    occurrences of a window are grouped by the word before them, once however
    often the benchmark repeats it, so pairs within a match are never formed.
    """
    _, query, length = _longest(symbols, order, block)
    need = block.window[query]
    query = query[(length >= need) & (block.left[query] >= need)]
    if not len(query):
        return query, query, query
    need = block.window[query]
    first, last = (bound(symbols, order, block, query, need, after) for after in (False, True))
    _, one, which = np.unique(np.stack([first, last]), axis=1, return_index=True, return_inverse=True)
    which, size = which.ravel(), (last - first)[one]
    base = np.cumsum(size) - size
    places = order[_spread(first[one], size)]
    before = np.where(places > 0, symbols[places - 1], np.uint64(0))
    words, rank = np.unique(before, return_inverse=True)
    key = np.repeat(np.arange(len(one)), size) * np.int64(len(words)) + rank.ravel()
    by = np.lexsort((places, key))
    places, key = places[by], key[by]
    # what begins an item or a document has no word before it, and differs
    mine = np.where(block.offset[query] > 0, block.hashes[query - 1], np.uint64(0))
    at = np.minimum(np.searchsorted(words, mine), len(words) - 1)
    same = (words[at] == mine) & (mine > 0)
    start, end = base[which], base[which] + size[which]
    low, high = (np.where(same, np.searchsorted(key, which * np.int64(len(words)) + at, side), end) for side in ("left", "right"))
    s = np.concatenate([np.repeat(query, low - start), np.repeat(query, end - high)])
    p = places[np.concatenate([_spread(start, low - start), _spread(high, end - high)])]
    return s, p, common(symbols, p, block, s, block.left[s])


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers ``start`` to ``start + size`` of every range, one after the other."""
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)


def _searched(block: Block, column: str, width: int):
    """Adds to each batch the number of words and the maximal matches found so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in cut(whole, column, SHARD_BYTES):
                w = words_of(*text_bytes(batch.column(column)))
                symbols, order = _sorted_shard(w.hashes, w.bounds, block.depth)
                s, p, n = matches(symbols, order, block)
                begin = w.bounds[:-1] + np.arange(len(w.bounds) - 1)
                doc = np.searchsorted(begin, p, "right") - 1
                by = np.lexsort((s, p, doc))
                values = [x[by] for x in (block.item[s], block.offset[s], p - begin[doc], n)] if len(s) else [np.zeros(0, np.int64)] * 4
                old = batch.column(batch.schema.get_field_index("_matches")).to_pylist()
                edges = np.searchsorted(doc[by], np.arange(batch.num_rows + 1)) if len(s) else np.zeros(batch.num_rows + 1, np.int64)
                names = ["item_id", "item_start", "doc_start", "n_words"]
                new = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in values], names))
                if any(old):
                    new = pa.array([a + b for a, b in zip(old, new.to_pylist(), strict=True)], new.type)
                columns = [new if f.name == "_matches" else pa.array(np.diff(w.bounds)) if f.name == "_n_words" else batch.column(i) for i, f in enumerate(batch.schema)]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in batch.schema])

    return run


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = 10, column: str = "text") -> DataFrame:
    """``docs`` with ``_n_words`` and ``_matches``, an array of (item_id, item_start, doc_start, n_words).

    A match is a longest run of words that document and item share verbatim,
    of ``window`` words or more; an item of fewer words matches as a whole.
    Null texts have no words. Matches are in order of doc_start. Repeated
    documents are each reported, repeated items once; items without words
    match nothing; an empty benchmark gives empty arrays. Columns of ``docs``
    of those two names are replaced.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    total = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    parts = -(-int(total) // BLOCK_BYTES)
    out = docs.withColumn("_n_words", F.lit(0).cast("long")).withColumn("_matches", F.array().cast(T.ArrayType(T.StructType.fromDDL(MATCH))))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in out.schema])
    for k in range(max(parts, 1)):
        # about BLOCK_BYTES each, as the items' hash deals them
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).sort("item_id", "text").collect() if parts else []
        block = block_of([(-1 if r[0] is None else r[0], r[1]) for r in rows], window)
        if k:
            out = keep(out, "matched")
        out = out.mapInArrow(_searched(block, column, window), schema)
    return out


def hit_words() -> F.Column:
    """How many words lie in any of ``_matches`` (which are in order of doc_start)."""
    ordered = F.array_sort("_matches", lambda a, b: (a["doc_start"] - b["doc_start"]).cast("int"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(
        ordered, zero,
        lambda s, m: F.struct(
            (s["n"] + F.greatest(F.lit(0).cast("long"), m["doc_start"] + m["n_words"] - F.greatest(s["end"], m["doc_start"]))).alias("n"),
            F.greatest(s["end"], m["doc_start"] + m["n_words"]).alias("end"),
        ), lambda s: s["n"],
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs`` without any match, unchanged."""
    return find_matches(docs, benchmark, window).where(F.size("_matches") == 0).select(*docs.columns)
