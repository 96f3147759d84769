"""Approximate search against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from almoner.operators import gazetteer as gz
from almoner.operators import sentences as se
from tests.conftest import edit_distance, moved_columns, plan_of

WORD = re.compile(r"\w+")


def windows(text):
    spans = [m.span() for m in WORD.finditer(text)]
    return [(a, text[a:b]) for i, (a, _) in enumerate(spans) for _, b in spans[i:]]


def gaz_table(spark, names):
    return spark.createDataFrame(
        [(i, n, alt, 1.0, 2.0) for i, (n, alt) in enumerate(names)], "geonameid bigint, name string, alternatenames string, latitude double, longitude double"
    )


def test_alternate_names_replace_the_main_name(spark):
    got = gz.explode_names(gaz_table(spark, [("Main", "A|b,,C"), ("Only", ""), ("Null", None)])).collect()
    assert sorted((r["geonameid"], r["placename"]) for r in got) == [(0, "A b"), (0, "C"), (1, "Only"), (2, "Null")]


def test_name_is_literal_case_sensitive_and_whole_word(spark):
    gaz = gaz_table(spark, [("a.c", ""), ("Rome", "")])
    docs = spark.createDataFrame([(1, "abc a.c"), (2, "rome Romeo"), (3, "in Rome, of Rome")], "id int, text string")
    got = sorted((r["id"], r["placename"], r["match_text"]) for r in gz.geocode(gaz, docs, 0, "id", ["text"]).collect())
    assert got == [(1, "a.c", "a.c"), (3, "Rome", "Rome")]


@pytest.mark.parametrize("errors", [1, 2, 3])
@pytest.mark.parametrize("by_deletion", [False, True])
def test_blocking_misses_no_pair(spark, errors, by_deletion):
    rng = random.Random(errors)
    word = lambda n: "".join(rng.choice("ab ") for _ in range(n)) or "a"
    names = sorted({word(rng.randint(errors + 1, 16)) for _ in range(150)})
    texts = sorted({word(rng.randint(1, 17)) for _ in range(150)})
    if by_deletion and errors == 3:
        names, texts = names[:60], texts[:60]
    want = {(a, b, edit_distance(a, b)) for a in names for b in texts if edit_distance(a, b) <= errors}
    left = spark.createDataFrame([(n,) for n in names], "placename string")
    right = spark.createDataFrame([(t,) for t in texts], "run string")
    got = {tuple(r) for r in gz.similar_texts(left, right, errors, by_deletion).select("placename", "run", "cost").distinct().collect()}
    assert got == want and want


@pytest.mark.parametrize("errors", [1, 3])
def test_rare_keys_miss_no_pair(spark, errors):
    rng = random.Random(errors)
    word = lambda n: "".join(rng.choice("ab ") for _ in range(n)) or "a"
    names = {word(rng.randint(errors + 1, 26)) for _ in range(60)}
    changed = []
    for n in names:
        for _ in range(6):
            chars = list(n)
            for _ in range(rng.randint(0, errors)):
                at = rng.randrange(len(chars) + 1)
                chars[at : at + rng.choice([0, 1])] = rng.choice(["", "b", "x"])
            changed.append("".join(chars))
    texts = sorted({t for t in changed if t} | {word(rng.randint(1, 17)) for _ in range(40)})
    want = {(a, b, edit_distance(a, b)) for a in names for b in texts if edit_distance(a, b) <= errors}
    left = spark.createDataFrame([(n,) for n in sorted(names)], "placename string")
    right = spark.createDataFrame([(t,) for t in texts], "run string")
    got = {tuple(r) for r in gz.similar_by_rare_keys(left, right, errors).select("placename", "run", "cost").distinct().collect()}
    assert got == want and len(want) > 100


def test_a_common_word_makes_no_block(spark):
    names = spark.range(100_000).select(F.concat(F.lit("San "), F.substring(F.md5(F.col("id").cast("string")), 1, 14)).alias("placename"))
    largest = lambda keys: keys.groupBy("key").count().agg(F.max("count")).first()[0]
    by_segment = names.select("placename", F.explode(gz.name_keys(F.col("placename"), 3)).alias("key"))
    # what names share by chance: a blank and two of sixteen letters
    assert largest(by_segment) == 100_000 and largest(gz.rare_keys(names, 3)) < 600
    assert gz.rare_keys(names, 3).groupBy("placename").count().agg(F.min("count"), F.max("count")).first()[:] == (4, 4)


@pytest.mark.parametrize("errors", [0, 1, 2, 3])
@pytest.mark.parametrize("limit", [0, 500_000])
def test_geocode_equals_brute_force(spark, errors, limit, monkeypatch):
    monkeypatch.setattr(gz, "BROADCAST_KEYS", limit)
    rng = random.Random(7)
    syllable = lambda: rng.choice(["ba", "né", "to", "ri"])
    word = lambda: "".join(syllable() for _ in range(rng.randint(1, 3)))
    names = [(" ".join(word() for _ in range(rng.randint(1, 3))), "") for _ in range(25)]
    texts = [rng.choice(["", "- "]) + " ".join(word() + rng.choice(["", ",", " -"]) for _ in range(rng.randint(1, 25))) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    want = set()
    for name in {n for n, _ in names if len(n) > errors}:
        for i, text in enumerate(texts):
            fits = [(edit_distance(name, run), at, -len(run), run) for at, run in windows(text)]
            fits = [f for f in fits if f[0] <= errors]
            if fits:
                want |= {(g, i, min(fits)[3], min(fits)[0]) for g, (n, _) in enumerate(names) if n == name}
    got = {(r["geonameid"], r["id"], r["match_text"], r["cost"]) for r in gz.geocode(gaz_table(spark, names), docs, errors, "id", ["text"]).collect()}
    assert got == want and want


def test_empty_inputs_give_no_rows(spark):
    docs = spark.createDataFrame([(1, "Rome")], "id int, text string")
    gaz = gaz_table(spark, [("Rome", "")])
    assert gz.geocode(gaz.limit(0), docs, 1, "id", ["text"]).count() == 0
    assert gz.geocode(gaz, docs.limit(0), 1, "id", ["text"]).count() == 0
    src = se.source_sentences(docs, "id", "text")
    hits = se.clean_candidates(docs.withColumn("h", F.lit(1)), "id", "h", "text")
    assert se.match_sentences(src.limit(0), hits).count() == 0
    assert se.match_sentences(src, hits.limit(0)).count() == 0


def test_report_has_nine_columns(spark):
    docs = spark.createDataFrame([(1, "Rome", "s", "l")], "id int, title string, short_description string, long_description string")
    columns = ["id", "title", "short_description", "long_description"]
    out = gz.geocode_report(gz.geocode(gaz_table(spark, [("Rome", "")]), docs, 0, "id", columns), docs, "id", columns)
    assert out.columns == ["geonameid", "latitude", "longitude", "placename", "match_text", *columns] and out.count() == 1


def test_geocode_plan_has_no_all_pairs_join(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "Rome")], "id int, text string")
    for limit in (0, 500_000):
        monkeypatch.setattr(gz, "BROADCAST_KEYS", limit)
        plan = plan_of(gz.geocode(gaz_table(spark, [("Rome", "")]), docs, 1, "id", ["text"]))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("errors", [1, 2, 3])
def test_names_that_share_a_word_meet_by_deletions(spark, errors, monkeypatch):
    """Pairs are not formed of all names that begin alike, and none within the edits is lost."""
    rng = random.Random(errors)
    word = lambda n: "".join(rng.choice("abcdé") for _ in range(n))
    names = sorted({f"San {word(6)}" for _ in range(300)} | {f"San {word(20)}" for _ in range(5)} | {word(n) for n in (4, 5, 30)})
    texts = set()
    for n in rng.sample(names, 60):
        chars = list(n)
        for _ in range(rng.randint(0, errors)):
            at = rng.randrange(len(chars))
            chars[at : at + rng.choice([0, 1])] = rng.choice(["", "b", "x"])
        texts.add("".join(chars).strip())
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(sorted(texts))], "id int, text string")
    want = {(n, i, min(c)) for i, t in enumerate(sorted(texts)) for n in names if (c := [d for _, run in windows(t) if (d := edit_distance(n, run)) <= errors])}
    met = []
    within = gz._within
    monkeypatch.setattr(gz, "_within", lambda pairs, e: met.append(pairs) or within(pairs, e))
    monkeypatch.setattr(gz, "SHARED", {errors: 20})
    got = {(r["placename"], r["id"], r["cost"]) for r in gz.geocode(gaz_table(spark, [(n, "") for n in names]), docs, errors, "id", ["text"]).collect()}
    assert got == want and len(want) >= 60
    runs = len({run for t in texts for _, run in windows(t)})
    assert met[0].count() < runs * 60


def test_three_edits_of_names_that_share_a_word_need_no_deletions(spark, monkeypatch):
    """Blocks are compared in tiles: neither texts by deletion nor a map of them is made, whatever the lengths, and no pair is lost or added."""
    from almoner.operators import runs as ru

    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdé😀") for _ in range(n))
    names = sorted({f"San {word(6)}" for _ in range(150)} | {f"San {word(n)}" for n in (20, 59, 60, 61, 62, 80)})
    texts = []
    for n in names[::4] + names[-6:]:
        chars = list(n)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(chars) + 1)
            chars[at : at + rng.choice([0, 1])] = rng.choice(["", "b", "x"])
        texts.append("".join(chars))
    made = []
    monkeypatch.setattr(ru, "TILE", 32)
    monkeypatch.setattr(gz, "SHARED", {3: 20})
    monkeypatch.setattr(gz, "deletion_keys", lambda *a: made.append(a) or pytest.fail("texts by deletion"))
    names_, runs = spark.createDataFrame([(n,) for n in names], "placename string"), spark.createDataFrame([(t,) for t in sorted(set(texts))], "run string")
    keys = ru.segment_keys(names_, 3)
    # every run has every key: all pairs meet in some block
    met = gz.near_names(keys, runs.crossJoin(spark.createDataFrame(keys.select("_key").distinct().collect(), "_key long")), 3, False)
    want = {(n, t, d) for n in names for t in set(texts) if (d := edit_distance(n, t)) <= 3}
    assert {tuple(r) for r in met.select("placename", "run", "cost").collect()} == want and len(want) > 60 and not made


def test_runs_that_share_no_segment_stay_in_their_task(spark):
    """Only runs with an unchanged segment of a name leave, whatever else a line holds; a name of few letters makes no deletions of the text."""
    from almoner.operators.runs import key_map, runs_near, segment_keys

    names = spark.createDataFrame([("Rome",), ("New York",), ("Brand#7",)], "placename string")
    count, sizes = gz.name_sizes(names)
    lines = spark.createDataFrame([(5, "😀 rain of Rome, " + "other words " * 2000 + "Nw York"), (None, ""), (7, "Brnd#7")], "id int, line string")
    lengths = sorted({n for s in sizes.values() for n in s})
    near = runs_near(lines, "id", "line", gz.run_lengths(sizes, 1), lengths, 1, key_map(segment_keys(names, 1), 2 * count)).collect()
    found = {(r["id"], r["start"], r["run"]) for r in near}
    assert {(5, 2, "Rome"), (5, 4003, "Nw York"), (7, 0, "Brnd#7")} <= found and len(near) < 12


def brute_sentences(sources, candidates, errors, per_error):
    out = set()
    for (sid, no), sentence in sources.items():
        for (source, hit), line in candidates.items():
            if source != sid:
                continue
            fits = [(edit_distance(sentence, w), a, -len(w), w) for a, w in windows(line) if abs(len(w) - len(sentence)) <= errors]
            fits = [f for f in fits if f[0] <= errors]
            if not fits:
                continue
            cost, _, _, match = min(fits)
            both = len(sentence) + len(match) + 2
            if cost == 0 or both * 50 // cost / 100 >= per_error:
                out.add((sid, no, hit, cost, match))
    return out


@pytest.mark.parametrize("errors,per_error", [(5, 15), (3, 4), (0, 15)])
@pytest.mark.parametrize("broadcast", [0, 250_000])
@pytest.mark.parametrize("few", [0, 30, 1000])
def test_sentences_equal_brute_force(spark, errors, per_error, broadcast, few, monkeypatch):
    monkeypatch.setattr(se, "BROADCAST_SEEDS", broadcast)
    monkeypatch.setattr(se, "FEW_SEEDS", few)
    rng = random.Random(errors * 100 + per_error)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.choice([1, 2, 3, 5, 9, 24])))
    texts, lines = [], []
    for s in range(3):
        parts = [" ".join(word() for _ in range(rng.choice([1, 2, 5, 9, 14]))) + "z." for _ in range(7)] + ["--- --- ---- --- --- ---a.", "tail " + word() + " of it"]
        texts.append((s, " ".join(parts)))
        for h in range(4):
            noisy = []
            for p in parts:
                chars = list(p)
                for _ in range(rng.choice([0, 0, 1, 2, 4])):
                    at = rng.randrange(len(chars))
                    chars[at : at + rng.choice([0, 1])] = rng.choice(["", "x", " "])
                noisy.append("".join(chars))
            rng.shuffle(noisy)
            lines.append((s, h, " ".join(word() for _ in range(3)) + " " + "\n".join(noisy) + "|"))
    sources = se.source_sentences(spark.createDataFrame(texts, "s int, t string"), "s", "t")
    hits = se.clean_candidates(spark.createDataFrame(lines, "s int, h int, t string"), "s", "h", "t")
    listed = {(r["source_id"], r["sentence_no"]): r["sentence"] for r in sources.collect()}
    cleaned = {(r["source_id"], r["hit_id"]): r["line"] for r in hits.collect()}
    want = brute_sentences(listed, cleaned, errors, per_error)
    found = se.match_sentences(sources, hits, errors, per_error).collect()
    assert {(r["source_id"], r["sentence_no"], r["hit_id"], r["cost"], r["matched_text"]) for r in found} == want and want


def test_places_of_a_seed(spark):
    cases = [("aaaa", "aa"), ("abab ab", "ab"), ("x", "x"), ("no", "yes"), ("éaé aé", "aé"), ("a.b*a.b", "a.b"), (r"a\Eb a\Eb", r"a\Eb"), (r"\Q\E", r"\E"), ("..", ".")]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, line string, gram string")
    got = df.filter(F.contains("line", "gram")).select("i", se.seed_places(F.col("line"), F.col("gram")).alias("p")).collect()
    want = {i: [k for k in range(len(line)) if line.startswith(gram, k)] for i, (line, gram) in enumerate(cases)}
    assert {r["i"]: r["p"] for r in got} == {i: p for i, p in want.items() if p}


@pytest.mark.parametrize("few", [0, 1000])
def test_lines_stay_where_they_are_read(spark, few, monkeypatch, tmp_path):
    monkeypatch.setattr(se, "FEW_SEEDS", few)
    spark.range(64).select(F.lit(1).alias("s"), F.col("id").alias("h"), F.lit("Now the road is open at last and the long line goes on").alias("t")).repartition(16).write.parquet(str(tmp_path / "lines"))
    src = se.source_sentences(spark.createDataFrame([(1, "The road is open.")], "s int, t string"), "s", "t")
    found = se.match_sentences(src, se.clean_candidates(spark.read.parquet(str(tmp_path / "lines")), "s", "h", "t"), 5, 8)
    moved = moved_columns(found)
    assert found.count() == 64 and any("region" in columns for columns in moved)
    assert not any({"line", "t"} & set(columns) for columns in moved)


def test_every_copy_of_a_sentence_is_reported(spark):
    src = spark.createDataFrame([(1, "The road is open. Other words here. The road is open. "), (2, "The road is open.")], "s int, t string")
    hits = spark.createDataFrame([(1, 7, "Now the road is open at last"), (2, 8, "nothing of the kind")], "s int, h int, t string")
    found = se.match_sentences(se.source_sentences(src, "s", "t"), se.clean_candidates(hits, "s", "h", "t"), 5, 8).collect()
    assert sorted((r["source_id"], r["sentence_no"], r["hit_id"], r["cost"], r["num_char_source"]) for r in found) == [(1, 0, 7, 2, 3 * 18), (1, 2, 7, 2, 3 * 18)]


def test_scores_and_lengths(spark):
    df = spark.createDataFrame([("a" * 29, "a" * 30, 2), ("a" * 29, "a" * 28, 2), ("abc", "abc", 0)], "s string, m string, c int")
    got = [(r["num_char_text"], r["num_char_match"], r["mean_char"], r["mean_char_per_cost"]) for r in se.score_columns(df, "s", "m", "c", 15).collect()]
    assert got == [(30, 31, 30.5, 15.25), (4, 4, 4.0, 9999.0)]


def test_source_length_counts_line_ends(spark):
    df = spark.createDataFrame([(1, "One. Two.")], "s int, t string")
    assert {r["num_char_source"] for r in se.source_sentences(df, "s", "t").collect()} == {10}


def test_allowed_errors_follow_the_score(spark):
    df = spark.createDataFrame([(n,) for n in (5, 13, 14, 28, 29, 72, 400)], "n int")
    assert [r[0] for r in df.select(se.allowed_errors(F.col("n"), 5, 15)).collect()] == [0, 0, 1, 2, 2, 5, 5]


def test_runs_are_made_of_the_numbers_of_words_that_occur(spark):
    """One long name adds one pattern, not one for every number of words below its own."""
    names = spark.createDataFrame([("Rome",), ("New York",), (" ".join(["w"] * 20),)], "placename string")
    keys, lengths = gz.name_limits(names, 0)
    assert keys == 3 and lengths == {1: [4], 2: [8], 20: [39]}
    lines = spark.createDataFrame([(1, "a new York and Rome or " + " ".join(["w"] * 22))], "id int, line string")
    got = gz.word_runs(lines, "id", "line", lengths).collect()
    assert sorted(r["run"] for r in got if len(r["run"]) < 20) == ["Rome", "York", "York and", "and Rome", "new York"] and sum(len(r["run"]) == 39 for r in got) == 3


@pytest.mark.parametrize("errors", [0, 1, 3])
def test_distances_are_bounded_by_the_edits_allowed(spark, errors):
    """Up to ``errors`` edits of a sentence with letters of several bytes are found with their number, one more is not; no distance is computed in full."""
    text = "Äußere Straßen führen übers Gebirge zum großen Hafen der Könige"
    at = [3, 10, 18, 27]
    lines = []
    for n in range(errors + 2):
        chars = list(text)
        for i in at[:n]:
            chars[i] = "é"
        lines.append((1, n, f"vorn {''.join(chars)} hinten"))
    src = se.source_sentences(spark.createDataFrame([(1, text)], "s int, t string"), "s", "t")
    found = se.match_sentences(src, se.clean_candidates(spark.createDataFrame(lines, "s int, h int, t string"), "s", "h", "t"), errors, 2)
    assert sorted((r["hit_id"], r["cost"]) for r in found.collect()) == [(n, n) for n in range(errors + 1)]
    distances = re.findall(r"levenshtein\([^()]*(?:\([^()]*\)[^()]*)*\)", found._jdf.queryExecution().optimizedPlan().toString())
    assert distances and all(re.search(rf"Some\({max(errors, 1)}\)|, {max(errors, 1)}\)$", d) for d in distances)
