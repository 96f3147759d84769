"""Language-model scores: causal self-attention over subword ids, trained in numpy by Spark tasks, and a unigram base.

The network predicts the class of the next subword from a window of those before; how likely a subword is within its
class, and a word for the base, comes from counts over all training texts. Scores are log10 probabilities.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import partial
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.llm.packing import VOCABULARY, encoder
from almoner.llm.tables import cut, keep, text_bytes
from almoner.operators.skew import keyed_join

#: Inputs of a window, and how many of its places score: the others are context only.
WINDOW, SCORED = 32, 20
CONTEXT = WINDOW - SCORED
DIM, INNER = 16, 32
#: Frequent subwords with a class, and with an input vector, of their own; the others have classes by mass on either side of a word's start.
OWN_CLASS, OWN_INPUT, SIDE_CLASSES = 192, 4096, 16
CLASSES = OWN_CLASS + 2 * SIDE_CLASSES
#: A round of the fit reads its part of the training texts, or more for at least so many words.
LEAST_WORDS = 400_000
#: Windows that a task of the fit holds at once; rounds of it; steps of a task in a round, at least; windows of a step; rate of the first round.
SHARE, ROUNDS, STEPS, BATCH, RATE = 16384, 4, 48, 256, 0.02
#: Greatest length of a slope.
LONGEST = 1.0
#: Words whose counts every task knows; the counts of the others are joined.
FREQUENT = 1 << 17
#: Texts to be counted and to be scored at once, in bytes; subwords whose windows are made at once, and windows that a cache holds.
_COUNTED, _CHUNK, _BLOCK, _CACHED = 2 << 20, 1 << 20, 8192, 32
PARTS = 8


def held_out(doc_id: Column) -> Column:
    """Texts that nothing is learned from. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(False))


@dataclass
class Network:
    embed: np.ndarray
    place: np.ndarray
    query: np.ndarray
    both: np.ndarray
    up: np.ndarray
    up_bias: np.ndarray
    down: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def like(self, flat: np.ndarray) -> Network:
        out, at = [], 0
        for p in self.parts():
            out.append(flat[at : at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return Network(*out)


#: What stands before a text's first subword, behind the own inputs and the classes.
PAD = OWN_INPUT + CLASSES


def fresh(seed: int = 12) -> Network:
    r = np.random.default_rng(seed)
    n = lambda *shape, s=0.1: r.normal(0, s, shape).astype(np.float32)
    return Network(
        n(PAD + 1, DIM, s=0.3), n(WINDOW, DIM), n(DIM, DIM, s=0.25), n(DIM, 2 * DIM, s=0.25), n(DIM, INNER, s=0.25), np.zeros(INNER, np.float32),
        n(INNER, DIM, s=0.15), n(DIM, CLASSES, s=0.2), np.zeros(CLASSES, np.float32),
    )


#: Places that a scored place looks at: those before it, and itself.
_ONES = np.ones(max(WINDOW, CLASSES), np.float32)
_SEEN = (np.arange(WINDOW)[None] <= np.arange(SCORED)[:, None] + CONTEXT).astype(np.float32)


def forward(net: Network, inputs: np.ndarray):
    """What the classes of every scored place (windows x SCORED) are told from, and the steps to it; place i's input is the subword before it."""
    n = len(inputs)
    x = net.embed.take(inputs, 0)
    x += net.place
    kv = (x.reshape(-1, DIM) @ net.both).reshape(n, WINDOW, 2 * DIM)
    k, v = kv[:, :, :DIM], kv[:, :, DIM:]
    own = np.ascontiguousarray(x[:, CONTEXT:]).reshape(-1, DIM)
    q = (own @ net.query).reshape(n, SCORED, DIM)
    a = np.matmul(q, k.transpose(0, 2, 1))
    # within these bounds no sum of weights vanishes or overflows
    np.clip(a, -60, 60, out=a)
    np.exp(a, out=a)
    a *= _SEEN
    a /= (a.reshape(-1, WINDOW) @ _ONES[:WINDOW]).reshape(n, SCORED, 1)
    seen = np.matmul(a, v)
    h = own + seen.reshape(-1, DIM)
    u = h @ net.up
    u += net.up_bias
    np.maximum(u, 0, out=u)
    g = np.empty((len(h), DIM + 1), h.dtype)
    np.matmul(u, net.down, out=g[:, :DIM])
    g[:, :DIM] += h
    # the last one meets the classes' bias
    g[:, DIM] = 1
    return g, (x, k, v, own, q, a, seen, h, u)


def _classes(net: Network, g: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each place's weights of the classes, their sum and the natural logarithm of the probability of the wanted class."""
    out = np.concatenate([net.out, net.out_bias[None]])
    rows, at = np.arange(len(want)), np.maximum(want, 0)
    z = g @ out
    picked = z[rows, at]
    with np.errstate(over="ignore"):
        np.exp(z, out=z)
        total = z @ _ONES[:CLASSES]
    # far from where products with them vanish or overflow
    if not (total.min(initial=1) > 1e-30 and total.max(initial=0) < 1e30):
        z = g @ out
        z -= z.max(1, keepdims=True)
        picked = z[rows, at]
        np.exp(z, out=z)
        total = z @ _ONES[:CLASSES]
    return z, total, picked - np.log(total)


def class_logs(net: Network, inputs: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each scored place's class; 0 where there is none (-1)."""
    want = classes.ravel()
    logs = _classes(net, forward(net, inputs)[0], want)[2]
    return np.where(want >= 0, logs, 0).reshape(classes.shape)


def gradients(net: Network, inputs: np.ndarray, classes: np.ndarray) -> tuple[float, Network]:
    """Mean loss over the scored places and its slope in every part. Few windows at a time, for a cache to hold them."""
    count = max(int((classes >= 0).sum()), 1)
    d_x = np.empty((len(inputs), WINDOW, DIM), net.embed.dtype)
    loss, sums = 0.0, [np.zeros_like(p) for p in net.parts()[2:-2]] + [np.zeros((DIM + 1, CLASSES), net.out.dtype)]
    both, query, up, down, out = (np.ascontiguousarray(p.T) for p in (net.both, net.query, net.up, net.down, net.out))
    for i in range(0, len(inputs), _CACHED):
        g, (x, k, v, own, q, a, seen, h, u) = forward(net, inputs[i : i + _CACHED])
        n, want = len(x), classes[i : i + _CACHED].ravel()
        p, total, logs = _classes(net, g, want)
        real = (want >= 0).astype(p.dtype)
        loss -= float((logs * real).sum())
        # the slopes of a place's classes, but for a factor that is left to narrower rows
        p[np.arange(len(want)), np.maximum(want, 0)] -= total
        real /= total * count
        d_g = p @ out
        d_g *= real[:, None]
        g *= real[:, None]
        d_u = d_g @ down
        d_u *= u > 0
        d_h = d_g + d_u @ up
        d_seen = d_h.reshape(n, SCORED, DIM)
        d_s = np.matmul(d_seen, v.transpose(0, 2, 1))
        d_s -= ((d_seen * seen).reshape(-1, DIM) @ _ONES[:DIM]).reshape(n, SCORED, 1)
        d_s *= a
        d_q = np.matmul(d_s, k).reshape(-1, DIM)
        d_kv = np.empty((n, WINDOW, 2 * DIM), p.dtype)
        np.matmul(d_s.transpose(0, 2, 1), q, out=d_kv[:, :, :DIM])
        np.matmul(a.transpose(0, 2, 1), d_seen, out=d_kv[:, :, DIM:])
        d_kv = d_kv.reshape(-1, 2 * DIM)
        d_x[i : i + n] = (d_kv @ both).reshape(n, WINDOW, DIM)
        d_h += d_q @ query
        d_x[i : i + n, CONTEXT:] += d_h.reshape(n, SCORED, DIM)
        for s, d in zip(sums, (own.T @ d_q, x.reshape(-1, DIM).T @ d_kv, h.T @ d_u, d_u.sum(0), u.T @ d_g, g.T @ p), strict=True):
            s += d.reshape(s.shape)
    d_embed = np.zeros_like(net.embed)
    flat = inputs.ravel()
    order = np.argsort(flat, kind="stable")
    first = np.flatnonzero(np.diff(flat[order], prepend=-1))
    if len(first):
        d_embed[flat[order[first]]] = np.add.reduceat(d_x.reshape(-1, DIM)[order], first, axis=0)
    return loss / count, Network(d_embed, d_x.sum(0), *sums[:-1], sums[-1][:DIM], sums[-1][DIM])


class Adam:
    """A network on its way, from window to window."""

    def __init__(self, net: Network, rate: float, seed: int = 0):
        self.shape, self.now = net, net.flat()
        self.mean, self.square = np.zeros_like(self.now), np.zeros_like(self.now)
        self.rate, self.random, self.done = rate, np.random.default_rng(seed), 0

    def net(self) -> Network:
        return self.shape.like(self.now)

    def over(self, inputs: np.ndarray, classes: np.ndarray, steps: int = 1, batch: int = BATCH) -> None:
        """As many passes over these windows as ``steps`` need."""
        each = -(-len(inputs) // batch)
        for _ in range(max(1, -(-steps // each)) if each else 0):
            order = self.random.permutation(len(inputs))
            for i in range(0, len(order), batch):
                some = order[i : i + batch]
                self.step(inputs[some], classes[some])

    def step(self, inputs: np.ndarray, classes: np.ndarray) -> None:
        d = gradients(self.net(), inputs, classes)[1].flat()
        # a step that leads too far is shortened, one that leads nowhere is left out
        length = math.sqrt(float(d @ d))
        if not math.isfinite(length):
            return
        self.done += 1
        d *= min(1.0, LONGEST / max(length, 1e-12))
        self.mean *= 0.9
        self.mean += 0.1 * d
        d *= d
        d *= 0.01
        self.square *= 0.99
        self.square += d
        np.divide(self.square, 1 - 0.99**self.done, out=d)
        np.sqrt(d, out=d)
        d += 1e-8
        np.divide(self.mean, d, out=d)
        d *= self.rate / (1 - 0.9**self.done)
        self.now -= d


def train(net: Network, inputs: np.ndarray, classes: np.ndarray, rate: float, steps: int = STEPS, batch: int = BATCH, seed: int = 0) -> Network:
    """Adam over these windows, as many passes as ``steps`` need."""
    adam = Adam(net, rate, seed)
    adam.over(inputs, classes, steps, batch)
    return adam.net()


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of all texts, end to end, and where each text's begin (one more for the end). Null: empty."""
    data, offsets = text_bytes(column)
    lowered = data | ((data - np.uint8(65) < 26).view(np.uint8) << 5)
    # an array of its own: Arrow's string functions misread slices
    texts = pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(lowered))
    lists = pc.ascii_split_whitespace(texts)
    words, bounds = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    full = pc.greater(pc.binary_length(words), 0)
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return words.filter(full), before[bounds - bounds[0]]


class Subwords:
    """The ids of words, each with a blank before it."""

    def __init__(self, vocabulary: bytes):
        self.encode = encoder(vocabulary)
        self.end = self.encode.max_token_value + 1
        self.size = np.zeros(self.end + 1, np.int64)
        for token in self.encode.token_byte_values():
            self.size[self.encode.encode_single_token(token)] = len(token)

    def starts_word(self) -> np.ndarray:
        out = np.zeros(self.end + 1, bool)
        for token in self.encode.token_byte_values():
            out[self.encode.encode_single_token(token)] = token.startswith(b" ")
        return out

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these words, end to end, and where each word's begin (one more for the end)."""
        if not len(words):
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        # one text for all of them, made without a Python string for each
        said = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), pa.scalar(" ", words.type))[0].as_py()
        ids = self.encode.encode_to_numpy(" " + said, disallowed_special=()).astype(np.int64)
        ends, word_ends = np.cumsum(self.size[ids]), np.cumsum(pc.binary_length(words).to_numpy().astype(np.int64) + 1)
        at = np.searchsorted(ends, word_ends)
        if ends[-1] == word_ends[-1] and (ends[at] == word_ends).all():
            return ids, np.concatenate([[0], at + 1])
        # some white space outside of ASCII ties words together: one by one
        each = [self.encode.encode_ordinary(" " + w) for w in words.to_pylist()]
        return np.array([i for e in each for i in e], np.int64), np.cumsum([0, *map(len, each)])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in cut(whole, "text", _COUNTED):
            words, _ = split_words(batch.column(0))
            known = words.dictionary_encode()
            n = np.bincount(known.indices.to_numpy(), minlength=len(known.dictionary))
            yield pa.RecordBatch.from_arrays([known.dictionary.cast(pa.string()), pa.array(n)], ["word", "n"])
        pa.default_memory_pool().release_unused()


def _count_subwords(batches: Iterator[pa.RecordBatch], vocabulary: bytes) -> Iterator[pa.RecordBatch]:
    voc = Subwords(vocabulary)
    total = np.zeros(voc.end + 1, np.int64)
    for batch in batches:
        ids, starts = voc.of(batch.column(0))
        # exact below 2 ** 53
        total += np.rint(np.bincount(ids, np.repeat(batch.column(1).to_numpy(), np.diff(starts)), len(total))).astype(np.int64)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["id", "n"])


@dataclass
class Language:
    """What all training texts tell: tokens, distinct ones, texts; of each subword its class, its input and the natural
    logarithm of its probability within the class."""

    tokens: int
    distinct: int
    texts: int
    classes: np.ndarray
    inputs: np.ndarray
    within: np.ndarray
    #: Windows of all training texts, about
    windows: int = 0

    def base(self, count) -> np.ndarray:
        return np.log10((np.asarray(count, np.float64) + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))


def classify(counts: np.ndarray, starts_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class, input and log probability within the class of every subword, by how often it occurs (ties: smaller id).

    The end of a text is the last one and always has a class of its own.
    """
    order = np.lexsort((np.arange(len(counts)), -counts))
    rank = np.empty(len(counts), np.int64)
    rank[order] = np.arange(len(counts))
    classes = np.full(len(counts), -1, np.int64)
    classes[order[: OWN_CLASS - 1]] = np.arange(OWN_CLASS - 1)
    classes[-1] = OWN_CLASS - 1
    for side in (0, 1):
        rest = order[(classes[order] < 0) & (starts_word[order] == bool(side))]
        mass = counts[rest] + 0.5
        part = (np.cumsum(mass) - mass) * SIDE_CLASSES // max(mass.sum(), 1)
        classes[rest] = OWN_CLASS + side * SIDE_CLASSES + np.minimum(part, SIDE_CLASSES - 1).astype(np.int64)
    total = np.bincount(classes, counts + 0.5, CLASSES)
    return classes.astype(np.int32), np.where(rank < OWN_INPUT, rank, OWN_INPUT + classes).astype(np.int32), np.log((counts + 0.5) / total[classes])


def windows(ids: np.ndarray, bounds: np.ndarray, language: Language) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs and classes of all windows of texts (subword ids end to end), and each window's text.

    Text i's ids are ``bounds[i]`` to ``bounds[i + 1]``. Every id is scored in one window; a window's first CONTEXT
    inputs lie in the window before it, too.
    """
    size = np.diff(bounds)
    n = -(-size // SCORED)
    text = np.repeat(np.arange(len(size)), n)
    first = (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)) * SCORED
    at = first[:, None] + np.arange(SCORED)
    classes = np.append(language.classes[ids], np.int32(-1))[np.where(at < size[text][:, None], bounds[text][:, None] + at, len(ids))]
    before = first[:, None] + np.arange(-CONTEXT - 1, SCORED - 1)
    real = (before >= 0) & (before < size[text][:, None])
    inputs = np.append(language.inputs[ids], np.int32(PAD))[np.where(real, bounds[text][:, None] + before, len(ids))]
    return inputs, classes, text


class Reader:
    """Words and subword ids of batches of texts."""

    def __init__(self, vocabulary: bytes):
        self.subwords = Subwords(vocabulary)

    def read(self, column: pa.Array):
        """Distinct words, the number of each word's, where texts' words begin, subword ids, where texts' ids begin."""
        words, starts = split_words(column)
        known = words.dictionary_encode()
        number = known.indices.to_numpy()
        ids, own = self.subwords.of(known.dictionary)
        size = np.diff(own)
        n = size[number]
        before = np.concatenate([[0], np.cumsum(n)])
        # one end behind every text
        texts = len(starts) - 1
        place = before[:-1] + np.repeat(np.arange(texts), np.diff(starts))
        flat = np.full(int(before[-1]) + texts, self.subwords.end, np.int64)
        inner = np.arange(int(before[-1])) - np.repeat(before[:-1], n)
        flat[np.repeat(place, n) + inner] = ids[np.repeat(own[:-1][number], n) + inner]
        return known.dictionary, number, starts, flat, before[starts] + np.arange(texts + 1)


def _read_windows(batches: Iterator[pa.RecordBatch], vocabulary: bytes, language: Language) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Inputs and classes of all windows, those of some texts at a time."""
    reader = Reader(vocabulary)
    for whole in batches:
        for batch in cut(whole, "text", _CHUNK):
            _, _, _, ids, bounds = reader.read(batch.column(0))
            for a in range(0, batch.num_rows, 256):
                b = min(a + 256, batch.num_rows)
                x, y, _ = windows(ids[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], language)
                yield x.astype(np.int16), y.astype(np.int16)


def _trained(batches: Iterator[pa.RecordBatch], vocabulary: bytes, language: Language, net: Network, rate: float) -> Iterator[pa.RecordBatch]:
    """What the windows of a task's texts make of the network, times their number. About SHARE windows are held at once."""
    part = TaskContext.get().partitionId()
    adam, held, n = Adam(net, rate, part), [], 0
    for x, y in _read_windows(batches, vocabulary, language):
        held.append((x, y))
        n += len(x)
        if sum(len(x) for x, _ in held) >= SHARE:
            adam.over(*map(np.concatenate, zip(*held, strict=True)))
            held = []
    if held:
        adam.over(*map(np.concatenate, zip(*held, strict=True)), steps=max(1, STEPS - adam.done))
    if n:
        sums = adam.now.astype(np.float64) * n
        yield pa.RecordBatch.from_arrays([pa.array([part % PARTS], pa.int32()), pa.array([part], pa.int32()), pa.array([sums.tobytes()], pa.binary()), pa.array([n], pa.int64())], ["slot", "part", "sums", "n"])
    pa.default_memory_pool().release_unused()


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = None, 0
    for batch in batches:
        for sums, count in zip(batch.column("sums").to_pylist(), batch.column("n").to_pylist(), strict=True):
            total = np.frombuffer(sums) if total is None else total + np.frombuffer(sums)
            n += count
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([n], pa.int64())], ["sums", "n"])


def texts_of_round(training: DataFrame, k: int, rounds: int, words: int) -> DataFrame:
    """The texts that round ``k`` reads: its part of all, or more for LEAST_WORDS words. Every text is in a round."""
    whole = 1 << 20
    size = min(whole, max(-(-whole // rounds), round(whole * LEAST_WORDS / max(words, 1))))
    return training.where(F.pmod(F.xxhash64("doc_id", "text") - F.lit(k * whole // rounds), F.lit(whole)) < size)


def fit(training: DataFrame, language: Language, vocabulary: bytes, rounds: int = ROUNDS) -> Network:
    """The network after some rounds, which together read all training texts; each reads LEAST_WORDS words at least, if there are so many.

    In a round every task trains on the windows of its own texts from the same network, and the results' mean is the
    next one. Texts are read where they lie, in no more tasks than have SHARE windows each. Means are added up in PARTS
    tasks; the driver holds PARTS networks of some 0.6 MB.
    """
    words = language.tokens - language.texts
    net = fresh()
    for k in range(rounds if language.texts else 0):
        some = texts_of_round(training, k, rounds, words)
        parts = max(1, math.ceil(min(1, max(1 / rounds, LEAST_WORDS / max(words, 1))) * language.windows / SHARE))
        task = partial(_trained, vocabulary=vocabulary, language=language, net=net, rate=RATE / 2**k)
        own = some.select("text").coalesce(parts).mapInArrow(task, "slot int, part int, sums binary, n long")
        added = own.repartition(PARTS, "slot").sortWithinPartitions("slot", "part").mapInArrow(_added, "sums binary, n long").collect()
        total = sum(r["n"] for r in added)
        if total:
            net = net.like(sum(np.frombuffer(r["sums"]) for r in sorted(added, key=lambda r: (r["n"], bytes(r["sums"])))) / total)
    return net


def _scored(batches: Iterator[pa.RecordBatch], vocabulary: bytes, language: Language, net: Network, words: bytes, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for every text, and for every word of it whose count has to be joined."""
    reader, number = Reader(vocabulary), TaskContext.get().partitionId() << 33
    frequent = pa.ipc.open_stream(words).read_all().column(0).combine_chunks()
    logs = np.append(language.base(counts), 0)
    end = float(language.base(language.texts))
    for whole in batches:
        for batch in cut(whole, "text", _CHUNK):
            texts = batch.num_rows
            known, which, starts, ids, bounds = reader.read(batch.column("text"))
            rank = pc.fill_null(pc.index_in(known.cast(pa.string()), value_set=frequent), -1).to_numpy(zero_copy_only=False)
            text = np.repeat(np.arange(texts), np.diff(starts))
            found = rank[which]
            n_known = np.bincount(text[found >= 0], minlength=texts) + (language.texts > 0)
            base = np.bincount(text, logs[found], texts) + end
            score = np.bincount(np.repeat(np.arange(texts), np.diff(bounds)), language.within[ids], texts)
            # windows of whole texts, some texts at a time
            pieces = np.concatenate([[0], np.flatnonzero(np.diff(bounds[1:] // _BLOCK)) + 1, [texts]])
            for a, b in zip(pieces[:-1].tolist(), pieces[1:].tolist(), strict=True):
                x, y, of = windows(ids[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], language)
                for i in range(0, len(x), _CACHED):
                    some = slice(i, i + _CACHED)
                    score[a:b] += np.bincount(of[some], class_logs(net, x[some], y[some]).sum(1, dtype=np.float64), b - a)
            key = number + np.arange(texts)
            number += texts
            none = pa.nulls(texts)
            columns = ["key", "doc_id", "n_tokens", "n_known", "base", "score", "word", "n"]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string(), pa.int64()]
            rows = [key, batch.column("doc_id"), np.diff(starts) + 1, n_known, base, score / np.log(10), none, none]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) if isinstance(c, np.ndarray) else c.cast(t) for c, t in zip(rows, kinds, strict=True)], columns)
            # words that are not among the frequent ones, once for each text
            at = np.flatnonzero(found < 0)
            if len(at):
                once, times = np.unique(text[at] * len(known) + which[at], return_counts=True)
                t, w = np.divmod(once, len(known))
                none = pa.nulls(len(once))
                rows = [key[t], none, none, none, none, none, known.take(pa.array(w)).cast(pa.string()), times]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) if isinstance(c, np.ndarray) else c.cast(k) for c, k in zip(rows, kinds, strict=True)], columns)
        # idle workers give memory back
        pa.default_memory_pool().release_unused()


def score_texts(docs: DataFrame, vocabulary: str = VOCABULARY, frequent: int = FREQUENT) -> DataFrame:
    """Log10 probabilities of all texts: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A-Z are lowered; tokens are words between ASCII white space, then one end. ``base_score`` adds up smoothed unigram
    logs from the counts of all training texts (those not :func:`held_out`). ``score`` is the network's: the same words
    as subword ids, each scored once in windows of WINDOW inputs, CONTEXT of them shared with the window before. The network
    is trained on all training texts.

    Null texts are empty and have the end alone. Repeated rows count and are scored as often; null doc_ids stay null and
    are learned from; other columns are not used; an empty table gives no rows; without training texts every base
    probability is 1 and the network is the untrained one.

    Texts are read where they lie. Counts of all words are an aggregate; tasks know those of the ``frequent`` most
    frequent words (some MB), and the counts of other words are joined, one row for each text and word.
    """
    file = Path(vocabulary).read_bytes()
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    training = rows.where(~held_out(F.col("doc_id")))
    words = keep(training.select("text").mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("c")), "words")
    texts = training.count()
    distinct, tokens = words.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    voc = Subwords(file)
    counts = np.zeros(voc.end + 1, np.int64)
    for r in words.mapInArrow(partial(_count_subwords, vocabulary=file), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[r["id"]] = r["n"]
    counts[voc.end] = texts
    language = Language(tokens + texts, distinct + (texts > 0), texts, *classify(counts, voc.starts_word()), int(counts.sum()) // SCORED + texts // 2)
    net = fit(training, language, file)

    top = words.orderBy(F.desc("c"), "word").limit(frequent).toArrow()
    sink = pa.BufferOutputStream()
    value_set = pa.table({"word": top.column("word").combine_chunks().cast(pa.string())})
    with pa.ipc.new_stream(sink, value_set.schema) as writer:
        writer.write_table(value_set)
    scored = partial(_scored, vocabulary=file, language=language, net=net, words=sink.getvalue().to_pybytes(), counts=top.column("c").to_numpy())
    kind = "key long, doc_id long, n_tokens long, n_known long, base double, score double, word string, n long"
    both = keep(rows.mapInArrow(scored, kind), "scored")
    rare = keyed_join(both.where("word is not null").select("key", "word", "n"), words, ["word"], "left")
    known = F.coalesce("c", F.lit(0))
    log = F.log10((known + 0.5) / F.lit(language.tokens + 0.5 * (language.distinct + 1)))
    more = rare.groupBy("key").agg(F.sum(F.when(known > 0, F.col("n")).otherwise(0)).alias("_known"), F.sum(F.col("n") * log).alias("_base"))
    whole = both.where("word is null").select("key", "doc_id", "n_tokens", "n_known", "base", "score").join(more, "key", "left")
    return whole.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(language.tokens).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("_base", F.lit(0.0))).alias("base_score"), "score",
    )
