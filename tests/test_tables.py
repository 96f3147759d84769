"""Digit audits, vocabularies, weights, extracts."""

import math

import pytest
from pyspark.sql import functions as F

from almoner.operators import extracts as ex
from almoner.operators import shares as sh
from almoner.operators import skew as sk
from almoner.operators import vocabulary as vo
from almoner.operators import weights as we
from almoner.operators.benford import benford
from almoner.operators.skew import keyed_join
from tests.conftest import moved_columns, plan_of


def strings(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_benford_compares_by_rank_and_sorts_by_digit(spark):
    got = benford(strings(spark, ["12", "13", "2", "2.5", "30", "0", "-7", " 9"]), "v").collect()
    # ties: the later symbol ranks first, so 2 is compared with 30.1 and 1 with 17.6
    assert [tuple(r) for r in got] == [
        ("-", 16.67, 1.72), ("1", 33.33, 1.89), ("2", 33.33, 1.11), ("3", 16.67, 1.33),
    ]


def test_benford_by_frequency_keeps_blanks(spark):
    got = benford(strings(spark, ["1", "1", " 9"]), "v", order="frequency").collect()
    assert [r["leading_digit"] for r in got] == ["1", " "]


def test_benford_by_digit_drops_other_symbols(spark):
    got = benford(strings(spark, ["1", "-1", "2"]), "v", expect_by="digit").collect()
    assert [tuple(r) for r in got] == [("1", 50.0, 1.66), ("2", 50.0, 2.84)]


def test_benford_beyond_nine_symbols_has_zero_ratio(spark):
    got = benford(strings(spark, list("123456789") * 2 + ["x"]), "v").collect()
    assert {r["leading_digit"]: r["ratio_to_benfords"] for r in got}["x"] == 0.0
    assert sum(r["percent_frequency"] for r in got) == pytest.approx(100, abs=0.05)


def test_bag_of_words(spark):
    df = strings(spark, ["The &amp;lt;b&amp;gt;well-known&amp;lt;/b&amp;gt; cafés", "l’eau e.g. don't ABC1DEF", None])
    got = lambda **k: {r["term"] for r in vo.bag_of_words(df, "v", **k).collect()}
    assert got() == {"the", "well", "known", "cafes", "l", "eau", "eg", "don", "t", "abc", "def"}
    stop = strings(spark, ["the", "don't", "cafés"], "word")
    assert got(stopwords=stop, min_len=2) == {"well", "known", "cafes", "eau", "don", "abc", "def"}
    assert got(stopwords=stop, min_len=2, normalize_stopwords=True) == {"well", "known", "eau", "abc", "def"}


def test_term_weights(spark):
    df = spark.createDataFrame(
        [("a", "Roads roads bridge"), ("a", "Roads roads bridge"), ("a", "bridge café"), ("b", "roads"), ("c", "12 of"), ("d", None)],
        "id string, text string",
    )
    tf = {(r["doc"], r["term"]): (r["f"], r["atf"]) for r in we.augmented_tf(we.term_freq(df, "id", "text")).collect()}
    # the repeated description counts once; accents vanish without transliteration
    assert tf == {("a", "roads"): (2, 1.0), ("a", "bridge"): (2, 1.0), ("a", "caf"): (1, 0.75), ("b", "roads"): (1, 1.0)}
    weights = {r["term"]: (r["df"], r["idf"]) for r in we.idf(we.term_freq(df, "id", "text"), we.document_count(df, "id")).collect()}
    assert weights["roads"][0] == 2 and weights["roads"][1] == pytest.approx(math.log10(4 / 3))
    both = {(r["doc"], r["term"]): r["tfidf"] for r in we.tfidf(df, "id", "text").collect()}
    assert both["a", "caf"] == pytest.approx(0.75 * math.log10(2))


def test_idf_is_negative_for_a_term_in_every_document(spark):
    df = spark.createDataFrame([("a", "road"), ("b", "road")], "id string, text string")
    assert we.idf(we.term_freq(df, "id", "text"), we.document_count(df, "id")).first()["idf"] < 0


def test_tags_and_lexicon(spark):
    tagged = spark.createDataFrame([("a", "Build", "VB"), ("a", "Paris", "NNP"), ("a", "roads", "NNS"), ("a", "in", "NN")], "d string, t string, p string")
    lexicon = strings(spark, ["roads"], "word")
    all_terms = {r["term"] for r in we.term_freq_tagged(tagged, "d", "t", "p").collect()}
    assert all_terms == {"build", "roads"}
    assert [r["term"] for r in we.term_freq_tagged(tagged, "d", "t", "p", lexicon).collect()] == ["roads"]


def test_predicates(spark):
    df = spark.createDataFrame([("a", None, "5"), ("bcd", "ef", "7"), (None, None, "6")], "x string, y string, c string")
    assert df.filter(ex.any_not_null("x", "y")).count() == 2
    assert df.filter(ex.not_null("x", "y")).count() == 1
    assert [r[0] for r in df.select(ex.text_length("x", "y")).collect()] == [1, 5, 0]
    assert df.filter(ex.length_between(ex.text_length("x", "y"), 1, 5)).count() == 1
    assert df.filter(ex.has_code("c", "5 6 8")).count() == 2
    assert df.filter(ex.matches_ci("x", "B|Z")).count() == 1
    assert ex.apply_optional(df, None, F.col("c") == "7").count() == 1


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(500).select(
        F.col("id").alias("record_id"), F.lit("World Bank").alias("donor"), F.lit("x").alias("sector"), F.lit("t").alias("title"),
        F.lit(None).cast("string").alias("short_description"), F.lit("long").alias("long_description"), F.lit("c").alias("activity_code"),
    )
    first = [r["record_id"] for r in ex.sample_records(df, 50, seed=1, donor="world").collect()]
    again = [r["record_id"] for r in ex.sample_records(df.repartition(7), 50, seed=1, donor="world").collect()]
    assert first == again and len(set(first)) == 50
    assert first != [r["record_id"] for r in ex.sample_records(df, 50, seed=2).collect()]
    assert ex.sample_records(df, 900).count() == 500
    assert ex.sample_records(df, 5, length=(1, 5)).count() == 0


def test_lookup_keeps_all_records_of_known_ids(spark):
    gaz = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "geonameid bigint, name string")
    ids = spark.createDataFrame([("1",), ("1",), ("3",), ("9",)], "g string")
    assert sorted(r["name"] for r in ex.lookup(gaz, ids, "g").collect()) == ["a", "b", "d"]


def test_list_distinct_is_sorted_and_skips_nulls(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None)], "k int, v string")
    assert {r["k"]: r["l"] for r in ex.list_distinct(df, ["k"], "v", "l").collect()} == {1: "a|b", 2: ""}


def test_shares_fan_out_over_amounts(spark):
    locs = spark.createDataFrame(
        [("p", "1", 1.0, 1.0, 10.0), ("p", "1", 2.0, 2.0, 10.0), ("p", "1", 3.0, 3.0, 10.0), ("p", "3", 4.0, 4.0, 5.0), ("p", "3", None, 4.0, 5.0), ("q", "1", 1.0, 1.0, None)],
        "project_id string, precision_code string, longitude double, latitude double, amount double",
    )
    shares = sh.location_share(locs, "amount")
    got = sorted((r["project_id"], r["count_locs"], None if r["financials_per_loc"] is None else float(r["financials_per_loc"])) for r in shares.collect())
    assert got == [("p", 1, 5.0), ("p", 3, 3.33), ("q", 1, None)]
    assert sh.attach_share(locs, shares).count() == 5 * 2 + 1
    assert float(sh.project_total_share(shares).filter("project_id = 'p'").first()["financials_per_loc"]) == 8.33


def test_share_rounds_half_away_from_zero(spark):
    got = spark.range(1).select(sh.share(F.lit(0.05), F.lit(2)), sh.share(F.lit(-0.05), F.lit(2))).first()
    assert [float(v) for v in got] == [0.03, -0.03]


def test_lookup_of_a_bucketed_table_moves_no_record(spark, tmp_path):
    from almoner.sources import delimited as de

    gaz = spark.range(1000).selectExpr("id as geonameid", "cast(id as string) as name")
    de.bucket_gazetteer(gaz, "bucketed_names", 8, str(tmp_path / "b"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = ex.lookup(spark.table("bucketed_names"), strings(spark, ["5", "7", "7", "2000"]), "v")
        plan = plan_of(found)
        assert found.count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("drop table bucketed_names")
    records = plan[plan.index("Join") : plan.index("FileScan")]
    assert "Exchange" not in records and "Bucketed: true" in plan


def test_keyed_join_repeats_no_row_and_shuffles_for_itself(spark):
    big = spark.range(5000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as k", "id")
    small = big.groupBy("k").count()
    joined = keyed_join(big.hint("merge"), small, ["k"])
    assert joined.count() == 5000 and joined.columns == ["k", "id", "count"]
    plan = plan_of(joined)
    # one shuffle for the aggregate and one for each side of the join, which adaptive execution may split
    assert "Generate" not in plan and plan.count("Exchange hashpartitioning") == 3
    assert plan.count("_nought") >= 2


def test_term_freq_counts_repeated_texts_of_a_document_once(spark):
    df = spark.createDataFrame([("a", "red red fox"), ("a", "red red fox"), ("a", "red dog"), ("b", "red red fox"), (None, "x"), ("c", None)], "d string, t string")
    got = {(r["doc"], r["term"]): r["f"] for r in we.term_freq(df, "d", "t").collect()}
    assert got == {("a", "red"): 3, ("a", "fox"): 1, ("a", "dog"): 1, ("b", "red"): 2, ("b", "fox"): 1}
    moved = [line for line in plan_of(we.term_freq(df, "d", "t")).split("\n") if "Exchange" in line]
    assert moved and all("t#" not in line for line in moved)


def test_extract_filters_are_optional(spark):
    from almoner.plans import fixtures as fx

    tables = fx.project_tables(spark, "/root/testdata/sf0.001")
    some = ex.project_extract(tables, purpose_prefix="R", before_year=1997)
    assert some.filter("year >= 1997 or crs_purpose_code not like 'R%'").count() == 0 and some.count() > 0
    assert ex.project_extract(tables, before_year=1).count() == 0


@pytest.mark.parametrize("limit", [0, 400_000])
def test_texts_are_counted_where_they_are_read(spark, monkeypatch, tmp_path, limit):
    monkeypatch.setattr(we, "BROADCAST_COPIES", limit)
    rows = [(i % 7, f"roads and bridges number{'abcdefgh'[i % 8]} roads") for i in range(300)] + [(8, None), (None, "roads"), (9, ""), (9, "")]
    want = {}
    for d, t in {r for r in rows if r[0] is not None and r[1]}:
        for w in t.split():
            want[d, w] = want.get((d, w), 0) + 1
    spark.createDataFrame(rows, "d int, t string").repartition(16).write.parquet(str(tmp_path / "texts"))
    tf = we.term_freq(spark.read.parquet(str(tmp_path / "texts")), "d", "t")
    assert {(r["doc"], r["term"]): r["f"] for r in tf.collect()} == want
    moved = moved_columns(tf)
    # beyond the limit texts whose digest may be repeated are moved
    assert moved and (limit == 0 or not any({"t", "text"} & set(c) for c in moved))


def test_marks_are_never_wrongly_false(spark):
    rows = spark.range(5000).withColumnRenamed("id", "k")
    got = sk.mark_maybe(rows, rows.filter("k % 10 = 0"), "k", "m").collect()
    assert all(r["m"] for r in got if r["k"] % 10 == 0) and sum(r["m"] for r in got) < 600
    assert not any(r["m"] for r in sk.mark_maybe(rows, rows.limit(0), "k", "m").collect())


@pytest.mark.parametrize("few", [0, 3, 10_000])
def test_large_samples_are_the_first_rows_by_draw(spark, monkeypatch, few):
    df = spark.range(3000).select(F.col("id").alias("record_id"), F.lit("a").alias("activity_code"), F.lit("t").alias("title"), F.lit("s").alias("short_description"), F.lit("l").alias("long_description"))
    want = [r["record_id"] for r in ex.sample_records(df, 1500, seed=3).collect()]
    monkeypatch.setattr(ex, "FEW_ROWS", few)
    for n in (1, 100, 1500, 2999, 3000, 3001):
        got = [r["record_id"] for r in ex.sample_records(df, n, seed=3).collect()]
        assert got[:1500] == want[:n] and len(got) == min(n, 3000) == len(set(got))
    plan = plan_of(ex.sample_records(df, 1500, seed=3))
    # rows with the very last draw only
    assert few == 10_000 or ("TakeOrdered" not in plan and "Range" in plan and "filter" in plan.lower())
    # one key over and over
    same = df.withColumn("record_id", F.lit(5))
    assert ex.sample_records(same, 700, seed=3).count() == 700 and ex.sample_records(same.limit(0), 700).count() == 0


def test_cut_counts_rows_with_the_last_draw(spark):
    draws = spark.createDataFrame([(f"{i // 3:032x}",) for i in range(30)], "draw string")
    order = sorted(f"{i // 3:032x}" for i in range(30))
    for n in (1, 2, 3, 4, 15, 29, 30):
        assert ex._cut(draws, n) == (order[n - 1], n - order.index(order[n - 1]))
    assert ex._cut(draws, 31) is None
