"""Toxicity by a small bidirectional gated recurrent network over overlapping word windows, trained in numpy.

A word enters as an embedding of its hashed identity and the mean embedding
of its hashed character (byte) n-grams. Two gated recurrent passes read a
window, attention weighs their states, and a logistic unit scores the
window. A document's score is the highest of its windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.llm.tables import cut, text_bytes
from almoner.llm.words import Words, mix, words_of

#: Words of a window, and from one window's start to the next.
WINDOW, STRIDE = 32, 16
WORD_BITS, GRAM_BITS, DIM, HIDDEN = 16, 16, 8, 8
#: Byte n-grams of a word, its ends marked.
GRAMS = (3, 4, 5)
#: The bounded sample that the network is fitted on: labelled rows of either class, and bytes of a row's text.
SAMPLE_ROWS, SAMPLE_BYTES = 1000, 12000
#: Passes over the sample, more of them if it is small, up to so many steps.
EPOCHS, STEPS, BATCH, RATE, TABLE_RATE, DROP = 12, 400, 64, 0.004, 5, 0.3
#: Words and n-grams of fewer sampled texts stay unknown: their inputs are nought.
LEAST_TEXTS = 3
_CHUNK = 2 << 20


@dataclass
class Network:
    words: np.ndarray
    grams: np.ndarray
    inputs: np.ndarray
    gates: np.ndarray
    bias: np.ndarray
    look: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def parts(self) -> dict[str, np.ndarray]:
        return self.__dict__


def fresh(seed: int = 5) -> Network:
    r = np.random.default_rng(seed)
    n = lambda *shape, s=0.1: r.normal(0, s, shape).astype(np.float32)
    return Network(
        n(1 << WORD_BITS, DIM, s=0.01), n(1 << GRAM_BITS, DIM, s=0.01), n(2, 2 * DIM, 3 * HIDDEN, s=0.25), n(2, HIDDEN, 3 * HIDDEN, s=0.25),
        np.zeros((2, 3 * HIDDEN), np.float32), n(2 * HIDDEN), n(2 * HIDDEN, s=0.5), np.full(1, -2, np.float32),
    )


def grams_of(w: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the chosen words, end to end, and where each word's begin."""
    starts, size = w.starts[which], w.ends[which] - w.starts[which]
    # every word between two marks
    begin = np.cumsum(size + 2) - (size + 2)
    flat = np.ones(int((size + 2).sum()), np.uint64)
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    flat[np.repeat(begin + 1, size) + inner] = w.lowered[np.repeat(starts, size) + inner]
    owner = np.repeat(np.arange(len(which)), size + 2)
    found, owners = [], []
    for n in GRAMS:
        if len(flat) < n:
            continue
        h = np.zeros(len(flat) - n + 1, np.uint64)
        for k in range(n):
            h = h * np.uint64(257) + flat[k : len(flat) - n + 1 + k]
        one = owner[: len(h)] == owner[n - 1 :]
        found.append(mix(h[one] + np.uint64(n << 56)) & np.uint64((1 << GRAM_BITS) - 1))
        owners.append(owner[: len(h)][one])
    ids, own = np.concatenate(found).astype(np.int32), np.concatenate(owners)
    order = np.argsort(own, kind="stable")
    return ids[order], np.searchsorted(own[order], np.arange(len(which)))


@dataclass
class Batch:
    """Distinct words with their features, and windows as rows of numbers of them (-1: none)."""

    ids: np.ndarray
    grams: np.ndarray
    starts: np.ndarray
    windows: np.ndarray
    doc: np.ndarray


def windows_of(counts: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all windows' words (-1 past the end) and each window's text; a text without words has none."""
    n = np.where(counts > WINDOW, -(-(counts - WINDOW) // STRIDE) + 1, (counts > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(counts)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    # the last window ends with the text
    first = np.minimum(k * STRIDE, np.maximum(counts[doc] - WINDOW, 0))
    at = first[:, None] + np.arange(WINDOW)[None]
    return np.where(at < counts[doc][:, None], starts[doc][:, None] + at, -1), doc


def batch_of(column: pa.Array) -> Batch:
    w = words_of(*text_bytes(column))
    distinct, which, number = np.unique(w.hashes, return_index=True, return_inverse=True)
    grams, starts = grams_of(w, which) if len(which) else (np.zeros(0, np.int32), np.zeros(0, np.int64))
    places, doc = windows_of(np.diff(w.bounds), w.bounds[:-1])
    number = np.append(number.astype(np.int32), -1)
    return Batch((distinct & np.uint64((1 << WORD_BITS) - 1)).astype(np.int32), grams, starts, number[places], doc)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In float32, far from its limits up to |x| = 80."""
    x = np.negative(x)
    np.exp(np.minimum(x, 80, out=x), out=x)
    x += 1
    return np.reciprocal(x, out=x)


def word_inputs(net: Network, b: Batch) -> np.ndarray:
    count = np.diff(np.append(b.starts, len(b.grams))).astype(np.float32)
    return np.concatenate([net.words[b.ids], np.add.reduceat(net.grams[b.grams], b.starts) / np.sqrt(count)[:, None]], 1)


def forward(net: Network, x: np.ndarray, windows: np.ndarray, trace: bool = False):
    """Logits of windows over word inputs ``x``; with ``trace`` also what the way back needs."""
    n, t = windows.shape
    alive, by_step = (windows >= 0).astype(np.float32), np.ascontiguousarray(windows.T)
    full = bool(alive.all())
    states, steps = np.zeros((2, t, n, HIDDEN), np.float32), []
    for d in range(2):
        # a last row of zeros stands for the place past a text's end
        pre = np.concatenate([x @ net.inputs[d] + net.bias[d], np.zeros((1, 3 * HIDDEN), np.float32)])
        h = np.zeros((n, HIDDEN), np.float32)
        for i in range(t) if d == 0 else range(t - 1, -1, -1):
            g = pre[by_step[i]]
            r = h @ net.gates[d]
            zr = _sigmoid(g[:, : 2 * HIDDEN] + r[:, : 2 * HIDDEN])
            z, reset = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = 2 * _sigmoid(2 * (g[:, 2 * HIDDEN :] + reset * r[:, 2 * HIDDEN :])) - 1
            new = h + z * (c - h) if full else h + alive[:, i, None] * z * (c - h)
            if trace:
                steps.append((d, i, h, z, reset, c, r[:, 2 * HIDDEN :]))
            h = new
            states[d, i] = h
    both = np.concatenate([states[0], states[1]], 2)
    a = both @ net.look + np.where(alive.T > 0, 0, -1e9).astype(np.float32)
    a = np.exp(a - a.max(0, keepdims=True))
    a /= a.sum(0, keepdims=True)
    context = np.einsum("tn,tnh->nh", a, both)
    logit = context @ net.out + net.out_bias[0]
    return (logit, (alive, steps, both, a, context)) if trace else logit


def backward(net: Network, b: Batch, x: np.ndarray, windows: np.ndarray, kept, drop: np.ndarray, d_logit: np.ndarray) -> dict[str, np.ndarray]:
    alive, steps, both, a, context = kept
    grad = {k: np.zeros_like(v) for k, v in net.parts().items() if k not in ("words", "grams")}
    grad["out"], grad["out_bias"] = context.T @ d_logit, np.array([d_logit.sum()], np.float32)
    d_context = d_logit[:, None] * net.out
    d_both = a[:, :, None] * d_context[None]
    d_a = np.einsum("tnh,nh->tn", both, d_context)
    d_score = a * (d_a - (a * d_a).sum(0, keepdims=True))
    grad["look"] = np.einsum("tn,tnh->h", d_score, both)
    d_both += d_score[:, :, None] * net.look
    d_pre = np.zeros((2, len(x) + 1, 3 * HIDDEN), np.float32)
    flow = np.zeros((2, len(windows), HIDDEN), np.float32)
    for d, i, h, z, reset, c, r in reversed(steps):
        dh = flow[d] + d_both[i][:, d * HIDDEN : (d + 1) * HIDDEN]
        live = dh * alive[:, i, None]
        dz, dc = live * (c - h) * z * (1 - z), live * z * (1 - c * c)
        dr = dc * r * reset * (1 - reset)
        d_hidden = np.concatenate([dz, dr, dc * reset], 1)
        grad["gates"][d] += h.T @ d_hidden
        flow[d] = dh - live * z + d_hidden @ net.gates[d].T
        np.add.at(d_pre[d], windows[:, i], np.concatenate([dz, dr, dc], 1))
    d_x = np.zeros_like(x)
    for d in range(2):
        g = d_pre[d, :-1]
        grad["inputs"][d], grad["bias"][d] = x.T @ g, g.sum(0)
        d_x += g @ net.inputs[d].T
    d_x *= np.repeat(~drop, DIM, 1)
    count = np.diff(np.append(b.starts, len(b.grams)))
    grams = np.repeat(d_x[:, DIM:] / np.sqrt(count).astype(np.float32)[:, None], count, 0)
    return grad | {"words": _by_row(b.ids, d_x[:, :DIM]), "grams": _by_row(b.grams, grams)}


def _by_row(ids: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of values by id: only these rows of a large table change."""
    order = np.argsort(ids, kind="stable")
    heads = np.flatnonzero(np.diff(ids[order], prepend=-1))
    return ids[order[heads]], np.add.reduceat(values[order], heads)


def _used(b: Batch, windows: np.ndarray) -> tuple[Batch, np.ndarray]:
    """The same windows over their own words only."""
    numbers, back = np.unique(windows, return_inverse=True)
    back = back.reshape(windows.shape)
    if numbers[0] < 0:
        numbers, back = numbers[1:], back - 1
    count = np.diff(np.append(b.starts, len(b.grams)))[numbers]
    inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return Batch(b.ids[numbers], b.grams[np.repeat(b.starts[numbers], count) + inner], np.cumsum(count) - count, windows, b.doc), back


def _common(b: Batch, ids: np.ndarray, count: np.ndarray, bits: int) -> np.ndarray:
    """1 for table rows that LEAST_TEXTS texts use, else 0."""
    used, first = np.zeros(1 << bits, np.int32), np.cumsum(count) - count
    edges = np.append(np.flatnonzero(np.diff(b.doc, prepend=-1)), len(b.doc))
    for i, j in zip(edges, edges[1:], strict=False):
        word = np.unique(b.windows[i:j])
        word = word[word >= 0]
        inner = np.arange(count[word].sum()) - np.repeat(np.cumsum(count[word]) - count[word], count[word])
        used[np.unique(ids[np.repeat(first[word], count[word]) + inner])] += 1
    return (used >= LEAST_TEXTS).astype(np.float32)[:, None]


def train(texts: list[str], labels: list[int], seed: int = 5) -> Network:
    """Fit on whole texts, every fifth of which only settles the level of the scores."""
    net, y = fresh(seed), np.asarray(labels, np.float32)
    aside = np.arange(len(texts)) % 5 == 4
    _descend(net, [t for t, a in zip(texts, aside, strict=True) if not a], y[~aside], seed)
    if len(set(y[aside])) == 2:
        logit = logits_of(net, pa.array([t for t, a in zip(texts, aside, strict=True) if a], pa.string()))
        sign = np.where(y[aside] > 0, 1, -1)
        levels = [(scale, shift) for scale in (1, 2, 4) for shift in np.arange(-8, 8.25, 0.25)]
        scale, shift = min(levels, key=lambda x: np.logaddexp(0, -sign * x[0] * (logit + x[1])).sum())
        net.out *= scale
        net.out_bias[:] = scale * (net.out_bias + shift)
    return net


def _descend(net: Network, texts: list[str], y: np.ndarray, seed: int) -> Network:
    """Of every text a window is taught its label, the higher ones rather (multiple-instance learning); of texts labelled 0 also one at random."""
    r = np.random.default_rng(seed)
    b = batch_of(pa.array(texts, pa.string()))
    first = np.searchsorted(b.doc, np.arange(len(y) + 1))
    docs = np.flatnonzero(np.diff(first) > 0)
    if not len(docs) or y[docs].min() == y[docs].max():
        net.out[:], net.out_bias[0] = 0, np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
        return net
    known = {"words": _common(b, b.ids, np.ones(len(b.ids), np.int64), WORD_BITS), "grams": _common(b, b.grams, np.diff(np.append(b.starts, len(b.grams))), GRAM_BITS)}
    for name, common in known.items():
        net.parts()[name][:] *= common
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.parts().items()}
    step, epochs = 0, max(EPOCHS, STEPS * BATCH // (2 * len(docs)))
    for epoch in range(epochs):
        logits = np.concatenate([forward(net, word_inputs(net, b), b.windows[i : i + 2048]) for i in range(0, len(b.windows), 2048)])
        pick = []
        for d in docs:
            own = logits[first[d] : first[d + 1]]
            # at first any window of a text stands for it, later the higher ones rather
            heat = min(1.0, 2 * epoch / epochs) if y[d] else 4.0
            pick.append((first[d] + int((heat * own + r.gumbel(size=len(own))).argmax()), y[d]))
            if not y[d]:
                pick.append((first[d] + r.integers(len(own)), 0.0))
        order = r.permutation(len(pick))
        rate = RATE * (1 - epoch / epochs)
        for i in range(0, len(order), BATCH):
            some = [pick[j] for j in order[i : i + BATCH]]
            own, windows = _used(b, b.windows[[p for p, _ in some]])
            # a word's inputs are left out now and then, so that no single word is learned by heart
            drop = r.random((len(own.ids), 2)) < DROP
            x = word_inputs(net, own) * np.repeat(~drop, DIM, 1)
            logit, kept = forward(net, x, windows, True)
            want = np.array([t for _, t in some], np.float32)
            grad = backward(net, own, x, windows, kept, drop, ((_sigmoid(logit) - want) / len(some)).astype(np.float32))
            step += 1
            for name, p in net.parts().items():
                m, v = moment[name]
                if isinstance(g := grad[name], tuple):
                    rows, g = g
                    m[rows] += 0.1 * (g - m[rows])
                    v[rows] += 0.01 * (g * g - v[rows])
                    p[rows] -= known[name][rows] * TABLE_RATE * rate * (m[rows] / (1 - 0.9**step)) / (np.sqrt(v[rows] / (1 - 0.99**step)) + 1e-6)
                else:
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return net


def logits_of(net: Network, column: pa.Array) -> np.ndarray:
    """Logit of the highest window of every text; without words that of an empty window."""
    b = batch_of(column)
    best = np.full(len(column), net.out_bias[0], np.float64)
    if len(b.doc):
        x = word_inputs(net, b)
        logits = np.concatenate([forward(net, x, b.windows[i : i + 2048]) for i in range(0, len(b.windows), 2048)])
        heads = np.flatnonzero(np.diff(b.doc, prepend=-1))
        best[b.doc[heads]] = np.maximum.reduceat(logits, heads)
    return best


def score_texts(net: Network, column: pa.Array) -> np.ndarray:
    return 1 / (1 + np.exp(-logits_of(net, column)))


def held_out(doc_id: Column) -> Column:
    """Rows that no network learns from: crc32 of the id as text, mod 4, is 2 (a null id counts as empty)."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> Network:
    """A network from a bounded sample: of either label at most ``rows`` rows not held out, whose texts have ``size`` bytes at most.

    The sample is the rows of least hash of the id, so it is the same in every
    run; at most 2 * rows * size bytes (24 MB) reach the driver. Null labels,
    ids and texts are left out; of repeated labels the greatest counts.
    Without rows of both labels the score is constant.
    """
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    short = docs.where(F.octet_length("text") <= size)
    there = short.select("doc_id").join(known, "doc_id").distinct()
    # ids first, so that no task sends texts that are not taken
    ids = [r for mark in (0, 1) for r in there.where(F.col("toxic") == mark).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()]
    # at most 2 * rows ids
    taken = F.broadcast(docs.sparkSession.createDataFrame([(r["doc_id"],) for r in ids], "doc_id long"))
    text = dict(short.join(taken, "doc_id").groupBy("doc_id").agg(F.min("text")).collect())
    texts, marks = [text[r["doc_id"]] for r in ids], [r["toxic"] for r in ids]
    return train(texts, marks)


def _scored(net: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in cut(whole, "text", _CHUNK):
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score_texts(net, batch.column("text")))], [*batch.schema.names, "_score"])

    return run


def score_documents(docs: DataFrame, net: Network) -> DataFrame:
    """``docs`` with ``_score``, 0 to 1, of every whole text.

    Only the text is read for it. Null, empty and wordless texts get the score
    of no words; equal texts get equal scores; an empty table gives no rows.
    A column ``_score`` is replaced. Nothing is shuffled; the network (under
    1 MB, whatever the input) goes with the tasks.
    """
    docs = docs.drop("_score")
    return docs.mapInArrow(_scored(net), docs.withColumn("_score", F.lit(0.0)).schema)
