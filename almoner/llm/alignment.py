"""Aligning two tokenizers over a corpus: pairs of ids that share bytes, counted from compressed runs merged by a heap."""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
from collections.abc import Iterator
from functools import partial
from itertools import groupby
from operator import itemgetter
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoner.llm.tables import cut, keep

VOCABULARY_A, VOCABULARY_B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
# fixed value: how the first vocabulary's texts are split before its merges
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Links of a run (and texts, at most), radix partitions by A id, and runs that one merge takes.
RUN, TEXTS, RADIX, FAN_IN = 6 << 20, 1 << 20, 32, 64
_CHUNK = 1 << 20
#: Groups of more links than this are counted by distinct ids.
_LARGE = 4096
_LOCAL = 20
RUNS = "run long, radix int, pairs binary, docs binary, texts binary"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Vocabularies:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, a: bytes, b: bytes):
        import sentencepiece
        import tiktoken

        whole = json.loads(a)
        # the printable characters that stand for bytes: themselves where they are printable, else from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [x for x in range(256) if x not in set(shown)]
        byte_of = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(hidden)}
        special = {t["content"] for t in whole["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in whole["model"]["vocab"].items() if token not in special}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.a_size[i] = len(token)
        self.b = sentencepiece.SentencePieceProcessor()
        self.b.LoadFromSerializedProto(b)
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.b_size = np.array([len(p) for p in self.b_bytes], np.int64)
        self.n_b = n
        # a number and what follows it: more of its side, the other side, the next group, nothing
        self.told = [b"%d%s" % (i, end) for i in range(max(n, len(self.a_size))) for end in (b",", b"|", b";", b"")]


class Texts:
    """Tokens and groups of some texts, end to end."""

    def __init__(self, voc: Vocabularies, texts: list[str | None]):
        none = np.zeros(0, np.int64)
        a, b = [], []
        for text, pieces in zip(texts, voc.b.encode([t or "" for t in texts], num_threads=1), strict=True):
            x, y = none, none
            if text:
                given = (" " + text).encode("utf-8", "surrogatepass")
                if b"".join(map(voc.b_bytes.__getitem__, pieces)) == given:
                    x, y = voc.a.encode_to_numpy(" " + text, disallowed_special=()).astype(np.int64), np.array(pieces, np.int64)
                    if int(voc.a_size[x].sum()) != len(given):
                        x, y = none, none
            a.append(x)
            b.append(y)
        self.voc = voc
        self.a, self.b = np.concatenate([none, *a]), np.concatenate([none, *b])
        self.n_a, self.n_b = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
        ends_a, ends_b = np.cumsum(voc.a_size[self.a]), np.cumsum(voc.b_size[self.b])
        size = int(ends_a[-1]) + 1 if len(ends_a) else 1
        at_a, at_b = np.zeros(size, bool), np.zeros(size, bool)
        at_a[ends_a], at_b[ends_b] = True, True
        # a text ends where both do, so groups never reach over texts
        shared = at_a & at_b
        last_a, last_b = shared[ends_a], shared[ends_b]
        #: group of every token, and the tokens of every group
        self.group_a, self.group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        self.last_a, self.last_b = last_a, last_b
        groups = int(last_a.sum())
        self.count_a, self.count_b = np.bincount(self.group_a, minlength=groups), np.bincount(self.group_b, minlength=groups)
        bounds = np.concatenate([[0], np.cumsum(last_a)])[np.concatenate([[0], np.cumsum(self.n_a)])]
        self.n_groups = np.diff(bounds)
        links = np.concatenate([[0], np.cumsum(self.count_a * self.count_b)])
        self.n_links = np.diff(links[bounds])
        self.doc = np.repeat(np.arange(len(texts)), self.n_groups)

    def told(self) -> list[str]:
        """Digest of every text's groups, or nothing without tokens."""
        before_a, before_b = np.cumsum(self.count_a) - self.count_a, np.cumsum(self.count_b) - self.count_b
        at_a = np.arange(len(self.a)) + before_b[self.group_a]
        at_b = np.arange(len(self.b)) + (before_a + self.count_a)[self.group_b]
        out = np.empty(len(self.a) + len(self.b), np.int64)
        out[at_a] = self.a * 4 + self.last_a
        out[at_b] = self.b * 4 + 2 * self.last_b
        ends = np.cumsum(self.n_a + self.n_b)
        out[ends[self.n_a > 0] - 1] += 1
        codes, begin, digests = out.tolist(), 0, []
        for end in ends.tolist():
            digests.append(hashlib.sha256(b"".join(map(self.voc.told.__getitem__, codes[begin:end]))).hexdigest() if end > begin else "")
            begin = end
        return digests

    def linked(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(A id * B ids + B id, text, times) of all links; what is linked at several places may come several times."""
        links = self.count_a * self.count_b
        first_a, first_b = np.cumsum(self.count_a) - self.count_a, np.cumsum(self.count_b) - self.count_b
        small = links <= _LARGE
        n = links * small
        group = np.repeat(np.arange(len(n)), n)
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        a, b = np.divmod(k, self.count_b[group])
        yield self.a[first_a[group] + a] * self.voc.n_b + self.b[first_b[group] + b], self.doc[group], np.ones(len(k), np.int64)
        for g in np.flatnonzero(~small):
            ids_a, times_a = np.unique(self.a[first_a[g] : first_a[g] + self.count_a[g]], return_counts=True)
            ids_b, times_b = np.unique(self.b[first_b[g] : first_b[g] + self.count_b[g]], return_counts=True)
            for x, times in zip(ids_a.tolist(), times_a.tolist(), strict=True):
                yield x * self.voc.n_b + ids_b, np.full(len(ids_b), self.doc[g]), times * times_b


def squeezed(*columns: np.ndarray) -> bytes:
    """Columns of numbers as one zstd block, each in the narrowest width."""
    import zstandard

    parts = []
    for c in columns:
        most = int(c.max()) if len(c) else 0
        width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8
        parts += [struct.pack("<BQ", width, len(c)), c.astype(f"<u{width}").tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unsqueezed(blob: bytes) -> list[np.ndarray]:
    import zstandard

    whole, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(whole):
        width, n = struct.unpack_from("<BQ", whole, at)
        out.append(np.frombuffer(whole, f"<u{width}", n, at + 9).astype(np.int64))
        at += 9 + width * n
    return out


def _steps(sorted_numbers: np.ndarray) -> np.ndarray:
    return np.diff(sorted_numbers, prepend=0)


def _run_rows(run: int, keys: np.ndarray, times: np.ndarray, texts: list[pa.Table], n_b: int) -> pa.RecordBatch:
    """A run: for every radix partition its pair-document records in order of A id, B id and text, and the texts' own figures."""
    # the same pair and text at several places
    order = np.argsort(keys, kind="stable") if (times != 1).any() else None
    keys = np.sort(keys) if order is None else keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    total = np.add.reduceat(times[order], first) if order is not None else np.diff(np.append(first, len(keys))) if len(first) else first
    keys = keys[first]
    radix, pair, local = keys >> (31 + _LOCAL), keys >> _LOCAL & ((1 << 31) - 1), keys & ((1 << _LOCAL) - 1)
    rows = []
    for r in range(RADIX):
        a, b = np.searchsorted(radix, [r, r + 1])
        if a < b:
            heads = np.flatnonzero(np.diff(pair[a:b], prepend=-1))
            rows.append((run, r, squeezed(_steps(pair[a:b][heads]), np.diff(np.append(heads, b - a))), squeezed(local[a:b], total[a:b]), None))
    sink = pa.BufferOutputStream()
    whole = pa.concat_tables(texts)
    with pa.ipc.new_stream(sink, whole.schema) as writer:
        writer.write_table(whole)
    rows.append((run, -1, None, None, sink.getvalue().to_pybytes()))
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["run", "radix", "pairs", "docs", "texts"])


def _runs(batches: Iterator[pa.RecordBatch], a: bytes, b: bytes, size: int) -> Iterator[pa.RecordBatch]:
    voc = Vocabularies(a, b)
    number = TaskContext.get().partitionId() << 32
    keys, times, texts, links, rows = [], [], [], 0, 0

    def flush():
        nonlocal number, links, rows
        out = _run_rows(number, np.concatenate(keys), np.concatenate(times), texts, voc.n_b)
        keys.clear()
        times.clear()
        texts.clear()
        number, links, rows = number + 1, 0, 0
        return out

    for whole in batches:
        for batch in cut(whole, "text", _CHUNK):
            if rows + batch.num_rows > TEXTS:
                yield flush()
            t = Texts(voc, batch.column("text").to_pylist())
            for pair, doc, n in t.linked():
                # the radix is that of the A id, so all pairs of an id are in one partition
                keys.append(((pair // voc.n_b) % RADIX << (31 + _LOCAL)) | (pair << _LOCAL) | (doc + rows))
                times.append(n)
                links += len(n)
            figures = [t.n_a, t.n_b, t.n_groups, t.n_links]
            texts.append(pa.table([batch.column("doc_id"), *map(pa.array, figures), pa.array(t.told(), pa.string())], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]))
            rows += batch.num_rows
            if links >= size:
                yield flush()
    if rows:
        yield flush()


def _blob(radix: int, group: int, blob: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([radix], pa.int32()), pa.array([group], pa.int64()), pa.array([blob], pa.binary())], ["radix", "group", "pairs"])


def merged(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs in order and how many documents hold each, from runs that count them in order: a merge by a heap."""
    sides = []
    for blob in blobs:
        step, n = unsqueezed(blob)
        sides.append(zip(np.cumsum(step).tolist(), n.tolist(), strict=True))
    if len(sides) == 1:
        both = list(sides[0])
    else:
        both = [(pair, sum(map(itemgetter(1), some))) for pair, some in groupby(heapq.merge(*sides), itemgetter(0))]
    whole = np.array(both, np.int64).reshape(-1, 2)
    return whole[:, 0], whole[:, 1]


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list]]:
    """Rows by radix and group, from batches sorted by them."""
    rows = ((x, g, p) for batch in batches for x, g, p in zip(*(batch.column(c).to_pylist() for c in ("radix", "group", "pairs")), strict=True))
    for key, some in groupby(rows, lambda r: r[:2]):
        yield key, [r[2] for r in some]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (radix, group), blobs in _grouped(batches):
        pair, n = merged(blobs)
        yield _blob(radix, group, squeezed(_steps(pair), n))


def _answer(batches: Iterator[pa.RecordBatch], n_b: int) -> Iterator[pa.RecordBatch]:
    """For each run of a group, in its own order of pairs: the pair's count, and whether that is its A id's highest.

    The counted pairs (run -1) come first; pairs of an A id are neighbours, so its highest count is a maximum over a run of them.
    """
    last = None
    for batch in batches:
        for radix, group, run, blob in zip(*(batch.column(c).to_pylist() for c in ("radix", "group", "run", "pairs")), strict=True):
            if run < 0:
                step, n = unsqueezed(blob)
                pair = np.cumsum(step)
                first = np.flatnonzero(np.diff(pair // n_b, prepend=-1))
                best = n == np.repeat(np.maximum.reduceat(n, first), np.diff(np.append(first, len(n))))
                last = (radix, group)
                continue
            assert last == (radix, group)
            at = np.searchsorted(pair, np.cumsum(unsqueezed(blob)[0]))
            yield pa.RecordBatch.from_arrays([pa.array([run], pa.int64()), pa.array([radix], pa.int32()), pa.array([squeezed(n[at], best[at])], pa.binary())], ["run", "radix", "answers"])


def _back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their sums, run by run: the texts' own figures, then for every radix the answers and the records."""
    last, texts, sums, best, answer = None, None, None, None, None

    def done():
        columns = {c: texts.column(c) for c in texts.column_names}
        columns |= {"n_best": pa.array(best), "count_sum": pa.array(sums)}
        names = [c.split()[0] for c in RESULT.split(", ")]
        return pa.table({c: columns[c] for c in names}).to_batches()

    for batch in batches:
        for run, radix, kind, blob in zip(*(batch.column(c).to_pylist() for c in ("run", "radix", "kind", "blob")), strict=True):
            if run != last:
                if last is not None:
                    yield from done()
                last, texts = run, pa.ipc.open_stream(blob).read_all()
                sums, best = np.zeros(texts.num_rows, np.int64), np.zeros(texts.num_rows, np.int64)
            elif kind == 0:
                answer = unsqueezed(blob)
            elif kind == 1:
                sizes = unsqueezed(blob)
            else:
                local, times = unsqueezed(blob)
                # whole numbers below 2 ** 53 stay exact
                for out, of_pair in zip((sums, best), answer, strict=True):
                    out += np.rint(np.bincount(local, np.repeat(of_pair, sizes[1]) * times, len(out))).astype(np.int64)
    if last is not None:
        yield from done()


def align(docs: DataFrame, a: str = VOCABULARY_A, b: str = VOCABULARY_B, run: int = RUN, fan_in: int = FAN_IN) -> DataFrame:
    """How two tokenizers' ids go together, for every row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256.

    Byte offsets where tokens of both end cut a text into groups; every A token is linked with every B token of its
    group. A pair's count is the number of rows of the corpus in which it is linked; ``count_sum`` adds it up over a
    text's links, ``n_best`` counts the links whose pair is the most counted of its A id, ties included. A text that is
    null, empty or not given back by both tokenizers has no tokens. Repeated rows count as often; a null doc_id stays
    null; other columns are not used; an empty table gives no rows.

    Tasks write the pair-document records of about ``run`` links as a run: radix partitions by A id, each in order of
    A id, B id and text, compressed by zstd. Runs are kept in the shared folder. At most ``fan_in`` runs of a partition
    are merged at once by a heap, and merged runs again until one is left, so no task holds more than ``fan_in``
    partitions of runs and none takes in a frequent id's documents; only pairs with their counts are merged. In the
    last one pairs of an A id are neighbours, which gives its highest count. Answers go back to the runs, whose records
    they meet in the order of pairs.
    """
    import sentencepiece

    files = Path(a).read_bytes(), Path(b).read_bytes()
    n_b = sentencepiece.SentencePieceProcessor(model_file=b).get_piece_size()
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    runs = keep(rows.mapInArrow(partial(_runs, a=files[0], b=files[1], size=run), RUNS), "runs")
    n_groups = -(-runs.where("radix = -1").count() // fan_in) or 1
    grouped = runs.where("radix >= 0").select("run", "radix", F.pmod(F.xxhash64("run"), F.lit(n_groups)).alias("group"), "pairs")
    kind = "radix int, group long, pairs binary"
    counted, left = grouped.select("radix", "group", "pairs"), n_groups
    while True:
        counted = keep(counted.repartition("radix", "group").sortWithinPartitions("radix", "group").mapInArrow(_merge, kind), "counted")
        if left == 1:
            break
        counted, left = counted.withColumn("group", F.floor(F.col("group") / fan_in)), -(-left // fan_in)
    given = counted.select("radix", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_groups - 1).cast("long"))).alias("group"), F.lit(-1).cast("long").alias("run"), "pairs")
    asked = given.unionByName(grouped).repartition("radix", "group").sortWithinPartitions("radix", "group", "run")
    answers = asked.mapInArrow(partial(_answer, n_b=n_b), "run long, radix int, answers binary")
    part = lambda df, number, column: df.where(f"{column} is not null").select("run", "radix", F.lit(number).alias("kind"), F.col(column).alias("blob"))
    parts = part(answers, 0, "answers").unionByName(part(runs, 1, "pairs")).unionByName(part(runs, 2, "docs")).unionByName(part(runs, 3, "texts"))
    return parts.repartition("run").sortWithinPartitions("run", "radix", "kind").mapInArrow(_back, RESULT)
