"""Cross-tokenizer alignment, language-model scores and the conversation trie, against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from almoner.llm import alignment as al
from almoner.llm import scoring as sc
from almoner.llm import tries as tr
from almoner.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"

# --- trie ---

CONV = "conv_id long, turn long, role string, text string, depth string, q1 int, _part int"


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            told = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            halves = tuple(int.from_bytes(told[i : i + 8], "big", signed=True) for i in (0, 8))
            own[conv].append((turn is not None, turn or 0, halves, (role, text)))
    own = {c: [t[-1] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    below = lambda p: [q for q in members if q[: len(p)] == p]
    out = set()
    for p, convs in members.items():
        sub = below(p)
        kids = lambda q: sum(len(x) == len(q) + 1 and x[: len(q)] == q for x in members)
        ends = ",".join(map(str, sorted(c for c in convs if whole[c] == p)))
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in sub if q)
        out.add((min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), kids(p), sum(not kids(q) for q in sub), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def conversations():
    r = np.random.default_rng(3)
    rows = []
    for c in [*range(40), -3, -7, 100_000]:
        n = int(r.integers(1, 12))
        rows += [(c, t, ["user", "assistant", None][(t + c) % 2 if c % 7 else 2], f"turn {int(r.integers(0, 2)) if c % 3 else 0} é" * (t % 3 + 1)) for t in range(n)]
    # copies, ties, repeated rows, nulls, a long conversation and a copy of it
    rows += [(c, t, "user", f"copy {t}") for c in (200, 205, 210, 215) for t in range(6)]
    rows += [(50, None, "user", "first"), (50, 0, None, None), (50, 0, "b", "tie"), (50, 0, "a", "tie"), (50, 1, "a", "x"), (50, 1, "a", "x"), (None, 0, "user", "nobody")]
    rows += [(c, t, "user", f"long {t}") for c in (305, 310) for t in range(60)]
    return [(*x, "clash", 1, 2) for x in rows]


@pytest.mark.parametrize(("block", "bits"), [(4096, 24), (7, 16)])
def test_trie_equals_plain_python(spark, monkeypatch, block, bits):
    monkeypatch.setattr(tr, "BLOCK", block)
    rows = conversations()
    got = tr.conversation_trie(spark.createDataFrame(rows, CONV).repartition(5), most_bits=bits).collect()
    assert len(got) == len({(r["conv_id"], r["depth"]) for r in got})
    assert {tuple(r) for r in got} == plain_trie(rows)


def test_full_sketch_proves_nothing_and_changes_nothing(spark, monkeypatch):
    rows = conversations()
    monkeypatch.setattr(tr, "sketch", lambda rows, bits: np.full((tr.ROWS << bits) // 8, 255, np.uint8))
    got = tr.conversation_trie(spark.createDataFrame(rows, CONV)).collect()
    assert {tuple(r) for r in got} == plain_trie(rows)


def test_sketch_never_proves_a_shared_prefix_single():
    r = np.random.default_rng(1)
    d1, d2 = r.integers(-(2**62), 2**62, 5000), r.integers(-(2**62), 2**62, 5000)
    batch = lambda a, b: pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["d1", "d2"])
    bits = 16
    parts = [*tr._count(iter([batch(d1, d2)]), bits), *tr._count(iter([batch(d1[:100], d2[:100])]), bits)]
    parts.sort(key=lambda p: p.column("block")[0].as_py())
    full = np.zeros((tr.ROWS << bits) // 8, np.uint8).reshape(-1, tr.CELLS // 8)
    for p in tr._merge(iter(parts)):
        full[p.column("block")[0].as_py()] = np.frombuffer(p.column("twice")[0].as_py(), np.uint8)
    rows = pa.RecordBatch.from_pydict({"depth": np.ones(5000, np.int64), "d1": d1, "d2": d2, "p1": d1, "p2": d2})
    alone = next(tr._screen(iter([rows]), full.ravel(), bits)).column("alone").to_numpy(zero_copy_only=False)
    assert not alone[:100].any() and alone[100:].mean() > 0.95


def test_pieces_of_ends_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(tr, "CHUNK", 16)
    rows = spark.range(-50, 3000).select(F.lit(2).cast("long").alias("depth"), (F.col("id") % 2).alias("d1"), F.lit(0).cast("long").alias("d2"), F.col("id").alias("conv_id"))
    for r in tr.ends(rows.repartition(6)).collect():
        ids = [i for i in range(-50, 3000) if int(math.fmod(i, 2)) == r["d1"]]
        assert r["ends_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_trie_of_no_conversation(spark):
    assert tr.conversation_trie(spark.createDataFrame([], CONV)).collect() == []


# --- alignment ---

TEXTS = [
    "The quick brown fox", "The quick brown fox", None, "", " ", "  two  blanks ", "tab\tand\nline\r\n\n\n", "naïve façade Ünïcödé", "日本語のテキスト 한국어", "emoji 👩‍👩‍👧‍👦 🇩🇪",
    "<|endoftext|> and <s> </s> <unk>", "a ▁ mark", "it's they'll 1234567 !!! ...", "x" * 3000, "ab " * 2000, "\x00\x01\x7f", "ﬁ ligature Ａ", "   wide", "0x" + "f" * 500, "word" * 40,
]


def plain_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(al.VOCABULARY_A)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=al.VOCABULARY_B)
    # a character of the first vocabulary for every byte, from its own tokens of single bytes
    alphabet = {}
    for b in range(256):
        if b < 128:
            alphabet[one.id_to_token(one.encode(chr(b)).ids[0])] = b
    for code in range(128, 0x800):
        said, made = chr(code).encode(), "".join(one.id_to_token(i) for i in one.encode(chr(code)).ids)
        alphabet |= dict(zip(made, said, strict=True))
    for code in [*range(0x800, 0xD800, 0x400), *range(0xE000, 0x110000, 0x400)]:
        said, made = chr(code).encode(), "".join(one.id_to_token(i) for i in one.encode(chr(code)).ids)
        alphabet |= dict(zip(made, said, strict=True))
    bytes_a = lambda i: bytes(alphabet[c] for c in one.id_to_token(i))
    bytes_b = lambda i: bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode()
    docs, count = [], Counter()
    for text in texts:
        a, b = (one.encode(" " + text, add_special_tokens=False).ids, two.encode(text)) if text else ([], [])
        given = (" " + text).encode() if text else b""
        if b"".join(map(bytes_a, a)) != given or b"".join(map(bytes_b, b)) != given:
            a, b = [], []
        ends = [np.cumsum([len(f(i)) for i in ids]) for f, ids in ((bytes_a, a), (bytes_b, b))]
        both = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
        groups = [([i for i, e in zip(a, ends[0], strict=True) if lo < e <= hi], [i for i, e in zip(b, ends[1], strict=True) if lo < e <= hi]) for lo, hi in zip([0, *both], both, strict=False)]
        links = Counter((x, y) for g, h in groups for x in g for y in h)
        count.update(links.keys())
        docs.append((a, b, groups, links))
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    for a, b, groups, links in docs:
        told = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        yield (
            len(a), len(b), len(groups), sum(links.values()), sum(n for p, n in links.items() if count[p] == most[p[0]]),
            sum(n * count[p] for p, n in links.items()), hashlib.sha256(told.encode()).hexdigest() if groups else "",
        )


@pytest.mark.parametrize(("run", "fan_in", "large"), [(al.RUN, al.FAN_IN, al._LARGE), (200, 2, 2)])
def test_alignment_equals_plain_python(spark, monkeypatch, run, fan_in, large):
    texts = [*TEXTS, *(f"{t} {i} the end" for i, t in enumerate(TEXTS[:12] * 3)), *TEXTS[:3]]
    rows = [(i, t, 7, "clash", "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, run int, radix string, n_a string").repartition(7)
    if large != al._LARGE:
        linked = al.Texts.linked

        def by_distinct_ids(self):
            al._LARGE = large
            return linked(self)

        monkeypatch.setattr(al, "_LARGE", large)
        monkeypatch.setattr(al.Texts, "linked", by_distinct_ids)
    got = {r["doc_id"]: tuple(r)[1:] for r in al.align(docs, run=run, fan_in=fan_in).collect()}
    want = dict(enumerate(plain_alignment(texts)))
    assert got == want


def test_alignment_of_given_documents(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op11_alignment"](spark, SF).collect()}
    assert got == dict(zip([d["doc_id"] for d in docs], plain_alignment([d["text"] for d in docs]), strict=True))


def test_alignment_of_nothing(spark):
    kind = "doc_id long, text string"
    assert al.align(spark.createDataFrame([], kind)).collect() == []
    got = al.align(spark.createDataFrame([(None, None), (1, "")], kind)).collect()
    assert {tuple(r) for r in got} == {(None, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, "")}


def test_merging_counted_runs():
    r = np.random.default_rng(2)
    sides = [np.unique(r.integers(0, 500, 200)) for _ in range(9)]
    blobs = [al.squeezed(al._steps(s), np.full(len(s), k + 1)) for k, s in enumerate(sides)]
    pair, n = al.merged(blobs)
    want = Counter()
    for k, s in enumerate(sides):
        want.update({int(x): k + 1 for x in s})
    assert dict(zip(pair.tolist(), n.tolist(), strict=True)) == want and (np.diff(pair) > 0).all()


# --- language model ---

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_base(rows):
    said = [(d, [*re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOW)), None], d is not None and zlib.crc32(str(d).encode()) % 5 == 1) for d, t, *_ in rows]
    count = Counter(w for _, ws, held in said if not held for w in ws)
    n, v = sum(count.values()), len(count)
    log = lambda c: math.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    return sorted((str(d), held, len(ws), sum(count[w] > 0 for w in ws), n, round(sum(log(count[w]) for w in ws), 6)) for d, ws, held in said)


def figures(got):
    return sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got)


KIND = "doc_id long, text string, word string, c int, held_out string"


@pytest.mark.parametrize("frequent", [5, 1 << 17])
def test_base_scores_equal_plain_python(spark, frequent):
    r = np.random.default_rng(4)
    words = ["the", "The", "É", "é", "naïve", "a b", " ", "x\x1cy", "日本", "long" * 300] + [f"w{i}" for i in range(60)]
    rows = [(i, " \t".join(r.choice(words, int(r.integers(0, 60)))), "w", 1, "c") for i in range(80)]
    rows += [(900, None, "w", 1, "c"), (901, "", "w", 1, "c"), (902, " \n\x0b\x0c ", "w", 1, "c"), (None, "the nobody", "w", 1, "c"), (3, rows[3][1], "w", 1, "c"), (903, "the " * 5000, "w", 1, "c")]
    got = sc.score_texts(spark.createDataFrame(rows, KIND).repartition(3), frequent=frequent).collect()
    assert figures(got) == plain_base(rows)
    assert all(x["score"] < 0 and math.isfinite(x["score"]) for x in got)


def test_scores_without_texts_to_learn_from(spark):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    rows = [(i, "some words", "w", 1, "c") for i in held]
    got = sc.score_texts(spark.createDataFrame(rows, KIND)).collect()
    assert figures(got) == plain_base(rows) and all(r["base_score"] == 0 for r in got)
    assert sc.score_texts(spark.createDataFrame([], KIND)).collect() == []


def small_language(reader, column):
    _, _, _, ids, bounds = reader.read(column)
    counts = np.bincount(ids, minlength=reader.subwords.end + 1)
    return sc.Language(0, 0, 0, *sc.classify(counts, reader.subwords.starts_word())), ids, bounds


def test_words_of_any_kind_are_joined_as_one_text(monkeypatch):
    joined, join = [], sc.pc.binary_join
    monkeypatch.setattr(sc.pc, "binary_join", lambda *a: joined.append(1) or join(*a))
    sub = sc.Subwords(Path(sc.VOCABULARY).read_bytes())
    words = ["road", "x\u2003y", "\u00e9t\u00e9", "<|endoftext|>", "a" * 300]
    for kind in (pa.string(), pa.large_string()):
        for some in (pa.array(words, kind), pa.array(["cut", *words, "off"], kind).slice(1, len(words))):
            ids, starts = sub.of(some)
            assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)] == [sub.encode.encode_ordinary(" " + w) for w in words]
    assert len(joined) == 4


def test_every_subword_is_scored_once_with_its_own_context():
    reader = sc.Reader(Path(sc.VOCABULARY).read_bytes())
    texts = ["the cat sat on the mat and " * k + "end" * (k % 3) for k in range(12)]
    whole = pa.array(["left out", *texts, None])
    language, ids, bounds = small_language(reader, whole.slice(1))
    x, y, text = sc.windows(ids, bounds, language)
    for i in range(len(bounds) - 1):
        own = ids[bounds[i] : bounds[i + 1]]
        assert own[-1] == reader.subwords.end and (own[:-1] != reader.subwords.end).all()
        assert (y[text == i][y[text == i] >= 0] == language.classes[own]).all()
        shown = np.concatenate([np.full(sc.CONTEXT + 1, sc.PAD), language.inputs[own], np.full(sc.SCORED, sc.PAD)])
        for k, w in enumerate(x[text == i]):
            assert (w == shown[k * sc.SCORED : k * sc.SCORED + sc.WINDOW]).all()
    # one place after the other, with explicit sums
    net = sc.fresh()
    got = sc.class_logs(net, x[:6], y[:6])
    for w in range(6):
        e = net.embed[x[w]] + net.place
        for s in range(sc.SCORED):
            at = s + sc.CONTEXT
            weigh = np.array([math.exp((e[at] @ net.query) @ (e[j] @ net.both[:, : sc.DIM])) for j in range(at + 1)])
            h = e[at] + sum(a * (e[j] @ net.both[:, sc.DIM :]) for j, a in enumerate(weigh / weigh.sum()))
            z = (h + np.maximum(h @ net.up + net.up_bias, 0) @ net.down) @ net.out + net.out_bias
            want = z[y[w, s]] - math.log(np.exp(z.astype(float)).sum()) if y[w, s] >= 0 else 0
            assert abs(got[w, s] - want) < 1e-3


def test_probabilities_within_classes_sum_to_one():
    counts = np.random.default_rng(5).integers(0, 50, 3000)
    classes, inputs, within = sc.classify(counts, np.arange(3000) % 3 == 0)
    assert np.allclose(np.bincount(classes, np.exp(within), sc.CLASSES)[np.unique(classes)], 1)
    assert len(np.unique(classes)) == sc.CLASSES and inputs.max() < sc.PAD


def test_slopes_by_differences():
    r = np.random.default_rng(6)
    net = sc.fresh()
    net = sc.Network(*[p.astype(np.float64) for p in net.parts()])
    x, y = r.integers(0, 30, (4, sc.WINDOW)), r.integers(-1, sc.CLASSES, (4, sc.SCORED))
    _, slope = sc.gradients(net, x, y)
    for part, d in zip(net.parts(), slope.parts(), strict=True):
        for _ in range(4):
            at = tuple(int(r.integers(0, min(n, 30))) for n in part.shape)
            old, step = part[at], 1e-5
            part[at] = old + step
            up, _ = sc.gradients(net, x, y)
            part[at] = old - step
            down, _ = sc.gradients(net, x, y)
            part[at] = old
            assert abs((up - down) / (2 * step) - d[at]) < 1e-5 + 1e-3 * abs(d[at])


def test_training_beats_counts_on_texts_with_an_order():
    reader = sc.Reader(Path(sc.VOCABULARY).read_bytes())
    r = np.random.default_rng(7)
    # each word tells the next one
    words = [f"word{i}" for i in range(30)]
    texts = [" ".join(words[(s + 7 * k) % 30] for k in range(60)) for s in r.integers(0, 30, 300)]
    language, ids, bounds = small_language(reader, pa.array(texts[:250]))
    x, y, _ = sc.windows(ids, bounds, language)
    net = sc.train(sc.fresh(), x, y, sc.RATE, steps=120)
    _, _, _, late, b = reader.read(pa.array(texts[250:]))
    x, y, _ = sc.windows(late, b, language)
    counts = np.bincount(ids, minlength=reader.subwords.end + 1) + 0.5
    assert sc.class_logs(net, x, y).sum() + language.within[late].sum() > 0.5 * np.log(counts / counts.sum())[late].sum()


def test_the_fit_reads_every_training_text(spark, monkeypatch):
    monkeypatch.setattr(sc, "LEAST_WORDS", 1)
    file = Path(sc.VOCABULARY).read_bytes()
    texts = [f"said {i} of the {i % 7} roads " * (1 + i % 3) for i in range(40)]
    language, ids, _ = small_language(sc.Reader(file), pa.array(texts))
    language.tokens, language.texts = len(ids) * 10, len(texts)
    net = lambda left_out: sc.fit(spark.createDataFrame([(i, t) for i, t in enumerate(texts) if i != left_out], "doc_id long, text string").coalesce(1), language, file, rounds=2).flat()
    whole = net(None)
    assert np.isfinite(whole).all() and (whole == net(None)).all()
    assert all((whole != net(i)).any() for i in (0, 13, 39))


def test_a_task_trains_on_all_of_its_windows(spark, monkeypatch):
    """Also where it can't hold them at once."""
    file = Path(sc.VOCABULARY).read_bytes()
    texts = pa.array([f"word {i} of many" for i in range(700)])
    language, ids, bounds = small_language(sc.Reader(file), texts)
    seen = []
    monkeypatch.setattr(sc, "SHARE", 300)
    monkeypatch.setattr(sc.TaskContext, "get", classmethod(lambda _: type("T", (), {"partitionId": lambda _: 3})()))
    monkeypatch.setattr(sc.Adam, "step", lambda self, x, y: seen.extend(y[y >= 0].tolist()))
    monkeypatch.setattr(sc, "STEPS", 1)
    (out,) = sc._trained(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), file, language, sc.fresh(), sc.RATE)
    assert out.column("n").to_pylist() == [700] and sorted(seen) == sorted(language.classes[ids].tolist())


def test_language_model_query_keeps_every_document(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert figures(QUERIES["op12_language_model"](spark, SF).collect()) == plain_base(rows)
