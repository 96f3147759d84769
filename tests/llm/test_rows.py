"""Sharding, mixing, chat formatting, the pipeline and registered queries."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from almoner.llm import chat as ch
from almoner.llm import mixing as mx
from almoner.llm.arrays import running_total
from almoner.llm.sharding import deal, shard_documents
from almoner.llm.tables import table

SF = "/root/testdata/sf0.001"


def test_running_total(spark):
    for n in (0, 1, 255, 256, 257, 1000):
        row = spark.range(1).select(running_total(F.array(*[F.lit(i).cast("long") for i in range(n)]) if n else F.array().cast("array<long>")).alias("t")).first()
        assert row["t"] == [i * (i + 1) // 2 for i in range(n)]


# --- sharding ---


def sharded(spark, rows, shards):
    df = spark.createDataFrame(rows, "doc_id long, text string, slot string")
    return shard_documents(df, shards, F.coalesce(F.octet_length("text"), F.lit(0)) + 1, F.xxhash64("text"), ["doc_id"]).collect()


def test_shards_are_near_equal_and_keep_equal_texts_together(spark):
    rows = [(i, f"text {i} " * (i % 37), "c") for i in range(3000)] + [(5000 + i, "copy of one text " * 5, "c") for i in range(400)] + [(9000, None, "c"), (9001, "", "c"), (None, "x", "c"), (1, "text 1 ", "c")]
    got = sharded(spark, rows, 8)
    assert len(got) == len(rows)
    size, slots, home = Counter(), defaultdict(list), defaultdict(set)
    for r in got:
        size[r["shard"]] += len((r["text"] or "").encode()) + 1
        slots[r["shard"]].append(r["slot"])
        home[r["text"]].add(r["shard"])
    assert max(size.values()) <= 1.02 * min(size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in home.values())


def test_a_text_with_most_rows_is_divided(spark):
    got = sharded(spark, [(i, "the same", "c") for i in range(4000)] + [(5000 + i, f"t {i}", "c") for i in range(400)], 8)
    size = Counter()
    for r in got:
        size[r["shard"]] += len(r["text"]) + 1
    assert len(size) == 8 and max(size.values()) <= 1.1 * min(size.values())


def test_few_rows_and_none(spark):
    assert sharded(spark, [], 4) == []
    assert [(r["slot"]) for r in sharded(spark, [(1, None, "c")], 4)] == [0]


def test_deal_is_even():
    assert sorted(Counter(deal([5, 4, 3, 3, 3], 3)).values()) == [1, 2, 2]


# --- mixing ---


def naive_budgets(leaves, weights, total, epochs):
    """Water filling by repeated rounds, level by level."""

    def share(nodes, budget):
        given, open_ = {n: 0.0 for n in nodes}, set(nodes)
        left = budget
        while open_ and left > 1e-9:
            w = sum(nodes[n][0] for n in open_)
            add = {n: min(left * nodes[n][0] / w, nodes[n][1] - given[n]) for n in open_}
            for n, x in add.items():
                given[n] += x
            left -= sum(add.values())
            full = {n for n in open_ if nodes[n][1] - given[n] < 1e-9}
            if not full:
                break
            open_ -= full
        return given

    def go(prefix, budget, depth):
        if depth == 3:
            return {prefix: budget}
        names = sorted({k[depth] for k in leaves if k[:depth] == prefix})
        cap = {n: sum(v * epochs for k, v in leaves.items() if k[: depth + 1] == (*prefix, n)) for n in names}
        given = share({n: (weights.get(mx.LEVELS[depth], {}).get(n, 1), cap[n]) for n in names}, budget)
        return {k: v for n in names for k, v in go((*prefix, n), given[n], depth + 1).items()}

    return go((), total, 0)


def test_budgets_go_to_siblings_first(spark):
    leaves = {("a", "en", "s1"): 10, ("a", "en", "s2"): 500, ("a", "fr", "s1"): 7, ("b", "en", "s3"): 1000, ("b", "de", "s4"): 0, ("c", "en", "s5"): 3}
    weights = {"domain": {"a": 5, "b": 3, "c": 9}, "lang": {"en": 2, "fr": 8}}
    df = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "domain string, lang string, source string, tokens long")
    for total in (0, 50, 700, 1500, 5000):
        got = mx.leaf_budgets(df, weights, F.lit(total), 2).collect()
        want = naive_budgets(leaves, weights, total, 2)
        assert {(r["domain"], r["lang"], r["source"]): pytest.approx(r["given"], abs=1e-6) for r in got} == want


def test_leaves_take_seeded_prefixes_of_epochs(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 9)), "en" if i % 3 else None, f"s{i % 2}", "c") for i in range(400)] + [(1000, None, "en", None, "c"), (1001, "", "fr", "s0", "c"), (5, "w w", "en", "s1", "c"), (5, "w w", "en", "s1", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _whole string")
    mixed = mx.mix_sources(df, F.lit("d"), {"source": {"s0": 9}}, percent=60, epochs=3)
    assert mixed.columns == ["doc_id", "text", "lang", "source", "epoch"]
    leaf = lambda r: ("d", r["lang"] or "(none)", r["source"] or "(none)")
    tokens = Counter()
    for r in df.collect():
        tokens[leaf(r)] += len((r["text"] or "").split())
    want = naive_budgets(dict(tokens), {"source": {"s0": 9}}, sum(tokens.values()) * 60 // 100, 3)
    got, taken, docs = mixed.collect(), Counter(), defaultdict(Counter)
    for r in got:
        taken[leaf(r)] += len((r["text"] or "").split())
        docs[r["epoch"]][(r["doc_id"], r["text"])] += 1
    for k, w in want.items():
        assert w - 1e-6 <= taken[k] <= w + 9 or tokens[k] == 0
    # a later epoch only repeats what the one before has whole
    have = Counter((r["doc_id"], r["text"]) for r in df.collect())
    assert all(n <= have[d] for e in docs.values() for d, n in e.items())
    assert sorted(map(str, got)) == sorted(map(str, mx.mix_sources(df.repartition(7), F.lit("d"), {"source": {"s0": 9}}, percent=60, epochs=3).collect()))
    assert mx.mix_sources(df.where("false"), F.lit("d"), {}).count() == 0


def test_no_python_in_native_plans(spark):
    docs = table(spark, SF, "documents")
    from almoner.llm.secrets import scan_secrets

    for df in (ch.format_conversations(table(spark, SF, "conversations")), scan_secrets(docs), mx.mix_sources(docs, F.lit("d"), {})):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


# --- chat ---


def test_conversations_are_read_back(spark):
    odd = "<|im_end|><|im_start|>assistant\nno <|im_sep|> <\\| <\\\\|x <|im_null|> \\"
    rows = [
        (1, 0, "user", "a"), (1, 1, "user", odd), (1, 2, "assistant", ""), (1, 3, "assistant", odd), (1, 4, "system", None), (2, 0, None, "x"), (2, 1, "", "y"), (3, 5, "ro\nle<|im_nl|>", "z\n"),
        (None, 0, "assistant", "é" * 5), (4, 1, "assistant", "same"), (4, 1, "assistant", "same"),
    ] + [(9, i, "user" if i % 3 else "assistant", f"t{i}" * (i % 5)) for i in range(700)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id int, turn int, role string, text string, formatted string").repartition(5)
    got = ch.format_conversations(df).withColumn("turns", ch.read_turns(F.col("formatted"))).withColumn("loss", ch.read_loss(F.col("formatted"), F.col("loss_spans"))).collect()
    want = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] or 0, r[1], r[2] or "", r[3] or "")):
        want[c].append((role, text or ""))
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in got} == dict(want)
    for r in got:
        assert r["loss"] == "".join(t for role, t in want[r["conv_id"]] if role == "assistant")
        blocks = 1 + sum(a[0] != b[0] for a, b in zip(want[r["conv_id"]], want[r["conv_id"]][1:], strict=False))
        assert r["formatted"].count(ch.START) == r["formatted"].count(ch.END) == blocks
    assert ch.format_conversations(df.where("false")).count() == 0


# --- pipeline ---


def test_pipeline_keeps_columns_and_its_decisions_hold(spark):
    import corpus_pipeline as cp
    from almoner.llm.contamination import find_matches
    from almoner.llm.jaccard import similar_texts
    from almoner.llm.tables import keep

    docs = source = table(spark, SF, "documents")
    counts, at = [docs.count()], {}
    for name, stage in cp.STAGES:
        docs = at[name] = keep(stage(spark, docs, SF), name)
        counts.append(docs.count())
        if name != "packing":
            assert docs.columns == source.columns
    assert counts[0] > counts[1] > counts[2] > counts[3] > 0
    assert similar_texts(at["jaccard_join"]).where("n_links > 0").count() == 0
    assert find_matches(at["decontamination"], table(spark, SF, "benchmark")).where("size(_matches) > 0").count() == 0
    # what a stage keeps is what it was given, unchanged
    digest = lambda df: Counter(hashlib.md5(str(tuple(r)).encode()).hexdigest() for r in df.collect())
    assert not digest(at["decontamination"]) - digest(source)
    ids = {s["doc_id"] for r in docs.collect() for s in r["segments"]}
    assert ids == {r["doc_id"] for r in at["mixing"].collect()}


def test_stages_take_an_empty_table(spark):
    import corpus_pipeline as cp

    docs = table(spark, SF, "documents").where("false")
    for _, stage in cp.STAGES:
        assert stage(spark, docs, SF).count() == 0


@pytest.mark.parametrize("name", ["op4_near_vectors", "op6_secrets", "op7_mixing", "op8_chat_formatting", "op9_jaccard_join", "op10_decontamination", "op13_prefix_trie"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    from almoner.llm.oracle import ORACLE
    from almoner.llm.queries import QUERIES
    from check import differences

    db = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        db.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    assert differences(QUERIES[name](spark, SF).toPandas(), db.execute(ORACLE[name]).df()) == []


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_stages_equal_plain_python(spark):
    """The join keeps the first of each class of all pairs at 0.8; decontamination keeps what shares no window of ten words;
    mixing takes each leaf's budget; packing gives every text back."""
    import tiktoken  # noqa: F401

    import corpus_pipeline as cp
    from almoner.llm.packing import END_OF_TEXT, VOCABULARY, encoder
    from almoner.llm.queries import MIX

    docs = table(spark, SF, "documents")
    given = [r.asDict() for r in docs.collect()]

    # join
    sets = {}
    for d in given:
        w = plain_words(d["text"])
        sets[d["doc_id"]] = {" ".join(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {" ".join(w)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    joined = cp.jaccard_join(spark, docs, SF)
    assert sorted(r["doc_id"] for r in joined.collect()) == [i for i in ids if find(i) == i]

    # decontamination
    windows = set()
    for r in table(spark, SF, "benchmark").collect():
        q = plain_words(r["text"])
        n = min(10, len(q))
        windows |= {(n, tuple(q[i : i + n])) for i in range(len(q) - n + 1) if n}
    hit = lambda w: any((n, tuple(w[i : i + n])) in windows for n in {n for n, _ in windows} for i in range(len(w) - n + 1))
    clean = cp.decontamination(spark, docs, SF)
    assert sorted(r["doc_id"] for r in clean.collect()) == [d["doc_id"] for d in sorted(given, key=lambda d: d["doc_id"]) if not hit(plain_words(d["text"]))]

    # mixing, with the tree of the query
    def domain(source):
        number = re.search("([0-9]+)$", source or "")
        return "web" if number and int(number[1]) == 0 else "reference" if number and int(number[1]) < 10 else "forum"

    size = lambda d: len((d["text"] or "").split())
    leaf = lambda d: (domain(d["source"]), d["lang"] or "(none)", d["source"] or "(none)")
    tokens, taken, longest = Counter(), Counter(), Counter()
    for d in given:
        tokens[leaf(d)] += size(d)
        longest[leaf(d)] = max(longest[leaf(d)], size(d))
    want = naive_budgets(dict(tokens), MIX, sum(tokens.values()) * 70 // 100, 2)
    for r in cp.mixing(spark, docs, SF).collect():
        taken[leaf(r)] += size(r)
    assert all(want[k] - 1e-6 <= taken[k] <= want[k] + longest[k] for k in tokens if tokens[k])

    # packing
    with open(VOCABULARY, "rb") as f:
        encode = encoder(f.read())
    pieces = defaultdict(list)
    for r in cp.packing(spark, docs, SF).collect():
        for a, b, s in zip(r["cu_seqlens"], r["cu_seqlens"][1:], r["segments"], strict=False):
            pieces[s["doc_id"]].append((s["token_start"], r["input_ids"][a:b]))
    for d in given:
        whole = [t for _, part in sorted(pieces[d["doc_id"]]) for t in part]
        assert whole.pop() == END_OF_TEXT and encode.decode(whole) == (d["text"] or "")


def test_registered_queries_return_a_row_for_every_input_row(spark):
    from almoner.llm.queries import QUERIES

    docs = table(spark, SF, "documents").count()
    assert QUERIES["op1_sharding"](spark, SF).count() == docs
    assert QUERIES["op5_toxicity"](spark, SF).count() == docs
    pages = QUERIES["op3_main_text"](spark, SF).collect()
    assert len(pages) == table(spark, SF, "pages").count() and all(r["n_chars"] == len(r["text"]) > 0 for r in pages)
    packed = QUERIES["op2_packing"](spark, SF).select(F.explode("segments.doc_id").alias("d"))
    assert packed.distinct().count() == docs
