"""Packing token ids into rows of equal length: best fit, longest first, in bins found by a segment tree."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from almoner.llm.tables import cut

#: Ids in a packed row, and tokens that a task gathers before it packs them.
LENGTH, GATHER = 2048, 4 << 20
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed values: the vocabulary's pattern, and its id for the end of a text
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_OF_TEXT = 50256
SCHEMA = "pack_id long, input_ids array<int>, cu_seqlens array<int>, position_ids array<int>, segments array<struct<doc_id:long,token_start:long,n_tokens:int>>"
_CHUNK = 4 << 20


def encoder(vocabulary: bytes):
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in vocabulary.splitlines() if line)}
    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Capacities:
    """Open bins by the room that is left, under a segment tree that tells where there are any."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.any = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, room: int, number: int) -> None:
        self.bins[room].append(number)
        i = self.leaves + room
        while i and not self.any[i]:
            self.any[i] = 1
            i >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """The bin of least room that is ``least`` or more, as (room, number), taken out."""
        i = self.leaves + least
        while not self.any[i]:
            # up while there is nothing to the right, then over
            while i & 1:
                i >>= 1
            if not i:
                return None
            i += 1
        while i < self.leaves:
            i = 2 * i if self.any[2 * i] else 2 * i + 1
        room = i - self.leaves
        number = self.bins[room].pop()
        if not self.bins[room]:
            self.any[i] = 0
            while i > 1 and not (self.any[i] or self.any[i ^ 1]):
                i >>= 1
                self.any[i] = 0
        return room, number


def best_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Bins of pieces (their numbers), best fit decreasing; no size is above ``length``."""
    out, open_ = [], Capacities(length)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        found = open_.take(size)
        if found is None:
            found = (length, len(out))
            out.append([])
        room, number = found
        out[number].append(i)
        if room > size:
            open_.add(room - size, number)
    return out


def split_long(tokens: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces (text, first token, size) of at most ``length`` tokens that cover every text without overlap."""
    sizes = np.array([len(t) for t in tokens], np.int64)
    n = -(-sizes // length)
    text = np.repeat(np.arange(len(sizes)), n)
    start = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * length
    return text, start, np.minimum(sizes[text] - start, length)


def pack(ids: list[int | None], tokens: list[np.ndarray], length: int, first: int, filler: int) -> Iterator[pa.RecordBatch]:
    """Packed rows of these texts, numbered from ``first``."""
    text, start, size = split_long(tokens, length)
    bins, count = best_fit(size, length), np.arange(length, dtype=np.int32)
    for k in range(0, len(bins), 512):
        some = bins[k : k + 512]
        matrix, place = np.full((len(some), length), filler, np.int32), np.zeros((len(some), length), np.int32)
        ends, heads, flat = [0], [], [p for b in some for p in b]
        for row, b in enumerate(some):
            at, sums = 0, [0]
            for p in b:
                s, n = int(start[p]), int(size[p])
                matrix[row, at : at + n] = tokens[text[p]][s : s + n]
                place[row, at : at + n] = count[:n]
                at += n
                sums.append(at)
            heads.append(np.array(sums, np.int32))
            ends.append(ends[-1] + len(b))
        even = pa.array(np.arange(len(some) + 1, dtype=np.int32) * length)
        bounds = np.cumsum([0, *map(len, heads)]).astype(np.int32)
        segments = pa.StructArray.from_arrays(
            [pa.array([ids[text[p]] for p in flat], pa.int64()), pa.array(start[flat], pa.int64()), pa.array(size[flat].astype(np.int32))], ["doc_id", "token_start", "n_tokens"]
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(first + k + np.arange(len(some))), pa.ListArray.from_arrays(even, pa.array(matrix.ravel())),
                pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(heads))), pa.ListArray.from_arrays(even, pa.array(place.ravel())),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), segments),
            ], ["pack_id", "input_ids", "cu_seqlens", "position_ids", "segments"],
        )


def _packed(vocabulary: bytes, length: int, gather: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, number = encoder(vocabulary).encode_ordinary, TaskContext.get().partitionId() << 33
        ids: list[int | None] = []
        tokens: list[np.ndarray] = []
        # copies of a text that meet in a part are encoded once
        known: dict[str, np.ndarray] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, number
            for b in pack(ids, tokens, length, number, END_OF_TEXT):
                number += b.num_rows
                yield b
            ids.clear()
            tokens.clear()
            known.clear()
            held = 0

        for whole in batches:
            for batch in cut(whole, "text", _CHUNK):
                for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    text = text or ""
                    t = known.get(text)
                    if t is None:
                        t = known[text] = np.array([*encode(text), END_OF_TEXT], np.int32)
                    ids.append(name)
                    tokens.append(t)
                    held += len(t)
                    if held >= gather:
                        yield from flush()
        if ids:
            yield from flush()

    return run


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH, gather: int = GATHER) -> DataFrame:
    """Packed rows of all texts: pack_id, input_ids (``length`` ids), cu_seqlens, position_ids, segments.

    A text's ids end with END_OF_TEXT. A text of more than ``length`` ids is
    split into pieces that cover it; pieces are packed best fit, longest
    first. ``cu_seqlens`` are the cumulative lengths of a row's segments from
    0; behind the last one the row is filled with END_OF_TEXT. Positions
    begin at 0 in every segment and are 0 in the filling. ``segments`` names
    each segment's doc_id, first token and length, so all texts can be put
    together again. Null and empty texts are END_OF_TEXT alone; repeated rows
    are packed as often; null doc_ids stay null; only doc_id and text of
    ``docs`` are used; an empty table gives no rows.

    Each task packs the texts it reads, ``gather`` tokens at a time, so
    nothing is shuffled and memory is bounded; a row at the end of each such
    part may be filled badly. The driver reads the vocabulary (under 1 MB)
    and sends it along.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(_packed(Path(vocabulary).read_bytes(), length, gather), SCHEMA)
