"""Near duplicates of texts and vectors against all-pairs versions."""

import re
from itertools import combinations

import numpy as np
import pytest

from almoner.llm import jaccard as ja
from almoner.llm.components import components
from almoner.llm.embeddings import near_vectors, tables_for
from almoner.llm.jaccard import one_of_each, similar_texts
from almoner.llm.words import shingles, words_of
from tests.conftest import moved_columns

DOC = "doc_id long, text string, lang string, key string, n int"


def shingle_set(text, width=5):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute(rows):
    """(class, links) by row from all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    near = [[] for _ in rows]
    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
            near[i].append(j)
            near[j].append(i)
    out = []
    for i in range(len(rows)):
        seen, stack = {i}, [i]
        while stack:
            for j in near[stack.pop()]:
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        out.append((min(rows[j][0] for j in seen), len(near[i])))
    return out


def corpus(seed=1):
    r = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)]
    rows, shared = [], " ".join(r.choice(words, 30))
    for g in range(12):
        base = list(r.choice(words, int(r.integers(8, 90))))
        for k in range(int(r.integers(1, 7))):
            t = list(base)
            for _ in range(k // 2):
                t[int(r.integers(len(t)))] = str(r.choice(words))
            rows.append((len(rows), " ".join(t) + (" " + shared if g % 3 == 0 else "")))
    rows += [(len(rows) + i, rows[0][1]) for i in range(30)]
    rows += [(900, None), (901, ""), (902, "... !"), (903, "two words"), (904, "Two, WORDS"), (905, "two words"), (906, "x " * 3000)]
    return rows


def test_similar_texts_equal_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "en", "clash", 1) for i, t in rows], DOC)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in similar_texts(docs).collect()}
    assert got == {i: b for (i, _), b in zip(rows, brute(rows), strict=True)}


def test_splitting_and_blocks_lose_nothing(spark, monkeypatch):
    """Small limits force deep paths, dense buckets and pairs of blocks."""
    monkeypatch.setattr(ja, "SMALL", 4)
    monkeypatch.setattr("almoner.llm.groups.BLOCK", 3)
    rows = corpus(2)
    r = np.random.default_rng(5)
    base = [f"v{i}" for i in range(120)]
    for i in range(40):
        t = list(base)
        t[int(r.integers(120))] = f"z{i}"
        rows.append((2000 + i, " ".join(t)))
    got = {x["doc_id"]: (x["class_id"], x["n_links"]) for x in similar_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: b for (i, _), b in zip(rows, brute(rows), strict=True)}


def test_one_of_each_keeps_columns_and_one_row_of_repeats(spark):
    text = " ".join(f"a{i}" for i in range(20))
    rows = [(7, text, "en", "k", 1), (3, text, "en", "k", 2), (3, text, "en", "k", 3), (9, None, None, None, None), (9, None, None, None, None), (None, "quite other words stand here now", "x", "y", 0)]
    got = one_of_each(spark.createDataFrame(rows, DOC))
    assert got.columns == ["doc_id", "text", "lang", "key", "n"]
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in got.collect()) == [(0, rows[5][1]), (3, text), (9, ""), (9, "")]


def test_empty_tables(spark):
    assert similar_texts(spark.createDataFrame([], DOC)).count() == 0
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_intersections_match_sets():
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 60, n).astype(np.uint64)) for n in (1, 5, 20, 40, 60)]
    assert ja.intersections(sets).tolist() == [[float(len(np.intersect1d(a, b))) for b in sets] for a in sets]


def test_runs_reach_the_recall():
    assert 1 - (1 - 0.8**2) ** ja.runs_for(0.9999, 0.8, 2) >= 0.9999 > 1 - (1 - 0.8**2) ** (ja.runs_for(0.9999, 0.8, 2) - 1)
    agree = (1 - np.arccos(0.93) / np.pi) ** 6
    assert 1 - (1 - agree) ** tables_for(0.9999, 0.93, 6) >= 0.9999


@pytest.mark.parametrize("depth", range(2, ja.MAX_DEPTH + 1))
def test_pairs_at_the_threshold_meet_in_some_run(depth):
    """20,000 pairs of similarity 0.8: those whose tokens part on every path of ``depth`` tokens, by the operator's own tokens."""
    n, runs = 20_000, ja.runs_for(0.9999, 0.8, depth)
    assert ja._coordinate(runs - 1, depth - 1) < ja.coordinates_for(runs) <= ja.coordinates_for(ja.runs_for(0.9999, 0.8, ja.MAX_DEPTH))
    values = np.random.default_rng(depth).integers(0, 1 << 63, (n, 50), dtype=np.int64).astype(np.uint64) << np.uint64(1)
    # 40 of 50 values are shared
    one, two = (ja.minhash(list(v), ja.coordinates_for(runs)) for v in (values[:, :45], values[:, 5:]))
    same = one == two
    assert abs(same.mean() - 0.8) < 0.005
    met = np.zeros(n, bool)
    for r in range(runs):
        met |= same[:, [ja._coordinate(r, level) for level in range(depth)]].all(1)
    # 2 are expected to be missed at most
    assert n - met.sum() <= 8


def test_runs_are_counted_again_when_later_ones_go_deeper(spark, monkeypatch):
    """Whatever depth any runs reach, so many runs are made."""
    asked, paths, reached = [], ja._paths, iter([2, 4, 5])

    def deeper_each_time(signed, first, last):
        asked.append((first, last))
        done, below, depth = paths(signed, first, last)
        return done, below, max(depth, next(reached, depth))

    monkeypatch.setattr(ja, "_paths", lambda s, a, b: deeper_each_time(s, a, b))
    monkeypatch.setattr(ja, "runs_for", lambda recall, threshold, depth: 2 * depth)
    rows = corpus(4)
    similar_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert asked == [(0, 4)]
    asked.clear()
    reached = iter([3, 4, 5])
    got = similar_texts(spark.createDataFrame(rows, "doc_id long, text string")).count()
    assert got == len(rows) and asked == [(0, 4), (4, 6), (6, 8), (8, 10)]


def test_tokens_stay_where_they_are_when_buckets_are_split(spark, monkeypatch):
    """Splitting moves numbers of buckets only; a set's leaves are the ends of its paths."""
    monkeypatch.setattr(ja, "SMALL", 4)
    kept, moved = ja.keep, []
    monkeypatch.setattr(ja, "keep", lambda df, label: moved.extend(moved_columns(df)) or kept(df, label))
    r = np.random.default_rng(9)
    tokens = r.integers(0, 3, (200, ja.coordinates_for(3))).astype("<u4")
    rows = [(f"{i:03}".encode(), tokens[i].tobytes(), tokens[i, :64].astype(np.uint8).tobytes()) for i in range(200)]
    signed = spark.createDataFrame(rows, "key binary, tokens binary, sketch binary")
    done, deeper, depth = ja._paths(signed, 0, 3)
    assert depth > 2 and moved and not any("tokens" in c for c in moved)
    about = ja._leaves(signed, 3, deeper)
    assert not any("tokens" in c for c in moved_columns(about))
    leaves = {bytes(x["key"]): np.frombuffer(bytes(x["leaves"]), ">u4") for x in about.collect()}
    assert len(leaves) == 200
    # plainly: a bucket of more than SMALL sets, of which no token has half, is split
    want = {}

    def down(members, run, level):
        for token in {int(tokens[i, ja._coordinate(run, level)]) for i in members}:
            part = [i for i in members if tokens[i, ja._coordinate(run, level)] == token]
            following = [int(tokens[i, ja._coordinate(run, level + 1)]) for i in part] if level + 1 < ja.MAX_DEPTH else []
            if len(part) > ja.SMALL and following and 2 * max(map(following.count, following)) < len(part):
                down(part, run, level + 1)
            else:
                want.update({(i, run): frozenset(part) for i in part})

    for run in range(3):
        down(range(200), run, 0)
    ends = {}
    for x in done.collect():
        ends.setdefault((x["run"], x["leaf"]), set()).add(int(bytes(x["key"])))
    assert sorted(map(sorted, ends.values())) == sorted(sorted(m) for _, m in {(run, m) for (_, run), m in want.items()} if len(m) > 1)
    for run in range(3):
        for i in range(200):
            assert {j for j in range(200) if leaves[f"{j:03}".encode()][run] == leaves[f"{i:03}".encode()][run]} == want[i, run]


def test_words_and_shingles_of_bytes():
    text = "Ünïted, THE x2 end".encode()
    w = words_of(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert [w.lowered[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends, strict=True)] == ["Ünïted", "the", "x2", "end"]
    assert [len(s) for s in shingles(w.hashes, w.bounds, 5)] == [1]
    assert [len(s) for s in shingles(w.hashes, w.bounds, 2)] == [3]


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 130)] + [(200, 200), (5, 4), (300, 299)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 130)} | {200: 200, 300: 299, 299: 299}
    assert got == want


@pytest.mark.parametrize("block", [512, 4])
def test_vectors_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr("almoner.llm.groups.BLOCK", block)
    r = np.random.default_rng(2)
    rows = []
    for g in range(20):
        base = r.normal(size=16)
        for _ in range(int(r.integers(1, 8))):
            rows.append([len(rows), (base + r.normal(scale=0.22, size=16)).tolist(), g % 3])
    rows += [[500 + i, rows[0][1], 0] for i in range(9)]
    rows += [[600, None, 0], [601, [0.0] * 16, 0], [602, [float("nan")] * 16, 0], [603, [None] * 16, 0], [604, rows[0][1], None], [605, [1.0, 2.0], 0], [606, [], 0], [607, [float("inf")] * 16, 1]]
    good = [(i, np.array(v), c) for i, v, c in rows if v and c is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    near = {i: [j for j, w, d in good if i != j and c == d and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.93] for i, v, c in good}
    want = {}
    for i, _, _ in rows:
        seen, stack = {i}, [i]
        while stack:
            for j in near.get(stack.pop(), []):
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        want[i] = (len(near.get(i, [])), min(seen), min(seen) == i)
    df = spark.createDataFrame([(*x, "clash") for x in rows], "vec_id long, embedding array<double>, label int, key string")
    assert {x["vec_id"]: (x["n_links"], x["component_id"], x["kept"]) for x in near_vectors(df).collect()} == want
    assert any(n > 2 for n, _, _ in want.values())
