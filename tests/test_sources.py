"""Reading, writing, nested records, arriving files."""

import json
import random

import pytest
from pyspark.sql import functions as F

from almoner.functions import text as tx
from almoner.operators import extracts as ex
from almoner.operators import sentences as se
from almoner.sources import delimited as de
from almoner.sources import documents as do
from almoner.streaming import changes as ch
from tests.conftest import plan_of


def test_utf16_dump_of_several_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_bytes('id|na\0me\r\n1|"é\r\n\x002|x\0y\r\n'.encode("utf-16"))
    (tmp_path / "sub" / "b.txt").write_bytes("id|name\r\n3|z\r\n".encode("utf-16"))
    df = de.read_utf16_dump(spark, str(tmp_path))
    assert df.columns == ["id", "name"]
    assert sorted(tuple(r) for r in df.collect()) == [("1", '"é'), ("2", "xy"), ("3", "z")]


@pytest.mark.parametrize("order", ["utf-16-le", "utf-16-be"])
@pytest.mark.parametrize("end", ["\r\n", "\n"])
def test_one_utf16_file_is_read_by_several_tasks(spark, tmp_path, monkeypatch, order, end):
    rng = random.Random(2)
    letters = ["a", "é", "\u0a05", "\u0100", "\u0d00", "\u0a0d", "\U0001f600", '"', "\0", "\u3000", " ", "\u000d" if end == "\r\n" else "x"]
    rows = [(str(i), "x" + "".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) + "y", rng.choice(["", "z"])) for i in range(4000)]
    body = end.join("|".join(r) for r in [("id", "te\0xt", "rest"), *rows]) + end
    (tmp_path / "dump").mkdir()
    (tmp_path / "dump" / "a.txt").write_bytes(("\ufeff" + body).encode(order))
    (tmp_path / "dump" / "b.txt").write_bytes(("\ufeff" + f"id|text|rest{end}b|c{end}{end}d|e|f|g").encode(order))
    want = sorted([(a, t.replace("\0", ""), r or None) for a, t, r in rows] + [("b", "c", None), ("d", "e", "f")])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        df = de.read_utf16_dump(spark, str(tmp_path / "dump"))
        assert df.columns == ["id", "text", "rest"]
        split = df.rdd.getNumPartitions()
        got = sorted((tuple(r) for r in df.collect()), key=str)
        monkeypatch.setattr(de, "_lines_by_bytes", lambda *_: False)
        one = de.read_utf16_dump(spark, str(tmp_path / "dump"))
        assert one.rdd.getNumPartitions() <= 2
        assert got == sorted((tuple(r) for r in one.collect()), key=str) == sorted(want, key=str)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert split > 8 if (order, end) == ("utf-16-le", "\r\n") else split <= 2


def test_uniform_table_and_replacement(spark, tmp_path):
    (tmp_path / "aid.dat.txt").write_text('"id"|"usd"\n1|2.5\n2|x\n')
    df = de.read_uniform(spark, str(tmp_path / "aid.dat.txt"), "|", "double")
    assert df.columns == ["id", "usd"] and [tuple(r) for r in df.collect()] == [(1.0, 2.5), (2.0, None)]
    for frame in (df, df.limit(1)):
        assert de.write_table_replace(frame, str(tmp_path / "aid.dat.txt"), str(tmp_path / "t")) == "aid"
    assert spark.table("aid").count() == 1


def test_columns_by_number(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    assert de.cols(df, 2, 3).columns == ["b", "c"] and de.cols(df, 2).columns == list("abcd")
    assert de.col_at(df, 4).columns == ["d"]


def test_gazetteer_file(spark, tmp_path):
    line = "\t".join(['7', 'Fès "x"', "Fes", "Fez,Fès", "34.03", "-5.0", "P", "PPLA", "MA", "", "05", "", "", "", "964891", "", "406", "Africa/Casablanca", "2012-01-17"])
    (tmp_path / "g.txt").write_text(line + "\n")
    row = de.read_gazetteer(spark, str(tmp_path / "g.txt")).first()
    assert len(row) == 19 and row["name"] == 'Fès "x"' and row["population"] == 964891 and str(row["modificationdate"]) == "2012-01-17"
    de.bucket_gazetteer(de.read_gazetteer(spark, str(tmp_path / "g.txt")), "gaz", 2, str(tmp_path / "b"))
    ids = spark.createDataFrame([(7,)], "geonameid bigint")
    assert spark.table("gaz").join(ids, "geonameid").count() == 1


def test_split_by_key_keeps_digit_codes(spark, tmp_path):
    df = spark.createDataFrame([("12", "a"), ("12", "b"), ("7", "c"), ("x", "d"), (None, "e")], "code string, v string")
    de.split_by_key(df, "code", str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()} == {"code=12", "code=7"}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_written_text_reads_back(spark, tmp_path):
    df = spark.createDataFrame([(" a b ", 'q"q'), ("", "x")], "a string, b string")
    de.write_delimited(df, str(tmp_path / "o"), "|")
    text = "".join(p.read_text() for p in sorted((tmp_path / "o").glob("part-*")) if p.stat().st_size > 4)
    assert " a b |q\"q" in text and "|x" in text


def test_manifest_uses_column_and_file_year(spark, tmp_path):
    head = ",".join(f"c{i}" for i in range(1, 36))
    (tmp_path / "dec_2011.csv").write_text(head + "\n" + ",".join(['"a, b"'] + ["x"] * 33 + ["PN-ABC-123"]) + "\n")
    got = de.download_manifest(de.read_quoted_csv(spark, str(tmp_path / "dec_2011.csv")), "http://x/").collect()
    assert [tuple(r) for r in got] == [("2011", "http://x/PNABC123.pdf")]


def test_document_folders(spark, tmp_path):
    mark = '<p class="articleParagraph">'
    for path, text in {
        "src/1/1.html": f"{mark}The council approved the road project today.\n More</p>{mark}end</p>", "src/2/2.html": "none", "src/x/x.html": "skip",
        "alt/1/5/a.html": "Yesterday the council approved the road project todxy in town|", "alt/1/url.csv": "u", "alt/3/6/b.html": "other",
    }.items():
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text(text)
    sources = do.read_source_docs(spark, f"{tmp_path}/src")
    hits = do.read_hit_docs(spark, f"{tmp_path}/alt")
    assert sorted(r["source_id"] for r in sources.collect()) == ["1", "2"]
    assert sorted((r["source_id"], r["hit_id"]) for r in hits.collect()) == [("1", "5"), ("3", "6")]
    assert [r["source_id"] for r in do.with_candidates(sources, hits).collect()] == ["1"]
    found = se.match_sentences(
        se.source_sentences(sources, "source_id", "html", mark), se.clean_candidates(hits, "source_id", "hit_id", "html"), errors=5, min_per_error=10
    ).collect()
    assert [(r["source_text"], r["matched_text"], r["cost"]) for r in found] == [
        ("The council approved the road project today.", "the council approved the road project todxy", 3)
    ]


def test_candidates_are_written_by_tasks(spark, tmp_path):
    """A folder for each candidate, without checksums or what a commit leaves; rows of one folder are one file; many files make few tasks."""
    rows = [(k % 7, k, f"é {k}" if k % 5 else None) for k in range(300)] + [(3, 3, "again"), (None, 5, "x")]
    docs = spark.createDataFrame(rows, "source_id bigint, hit_id bigint, text string").repartition(9)
    do.write_hit_docs(docs, f"file://{tmp_path}/hits")
    do.write_hit_docs(docs.limit(0), f"{tmp_path}/none")
    files = sorted(str(f.relative_to(tmp_path / "hits")) for f in (tmp_path / "hits").rglob("*") if f.is_file())
    assert files == sorted({f"source_id={'__HIVE_DEFAULT_PARTITION__' if s is None else s}/hit_id={h}/part-00000.txt" for s, h, _ in rows})
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    with do.small_files(spark):
        hits = do.read_hit_docs(spark, f"{tmp_path}/hits")
        assert spark.read.text(f"{tmp_path}/hits", wholetext=True, recursiveFileLookup=True).rdd.getNumPartitions() <= 16
        found = {(r["source_id"], r["hit_id"]): r["html"] for r in hits.collect()}
    want = {(str(s), str(h)): f"{t or ''}\n" for s, h, t in rows if s is not None}
    assert found == want | {("3", "3"): "again\né 3\n"} and spark.conf.get("spark.sql.files.openCostInBytes") == before
    assert do.read_hit_docs(spark, f"{tmp_path}/none").count() == 0


def test_folders_are_listed_from_the_top(spark, tmp_path):
    base = tmp_path / "7"
    for path in ("1/5/a.html", "1/5/b.html", "2/source_id=9", "3/8/4/deep.html", "source_id=2/hit_id=6/part-0", "4/x/c.html"):
        (base / path).parent.mkdir(parents=True, exist_ok=True)
        (base / path).write_text(path)
    hits = do.read_hit_docs(spark, str(base))
    assert "InMemoryFileIndex(1 paths)" in plan_of(hits)
    assert sorted(map(tuple, hits.collect())) == [("1", "5", "1/5/a.html\n1/5/b.html"), ("2", "6", "source_id=2/hit_id=6/part-0")]
    (tmp_path / "none").mkdir()
    assert do.read_hit_docs(spark, f"{tmp_path}/none/").count() == 0


def test_locations_of_activities(spark, tmp_path):
    one = (
        '<iati-activity default="x"><title>A &amp; B</title><sector code="1">S1</sector><sector>S2</sector>'
        '<location><coordinates latitude="1" longitude="2" precision="3"/><coordinates latitude="4" longitude="5"/></location>'
        "<location><name>n</name></location><transaction><flow-type>f</flow-type></transaction>"
        '<transaction><value currency="USD">12</value><transaction-date>2014-01-01</transaction-date></transaction></iati-activity>'
    )
    (tmp_path / "a.xml").write_text(f"<?xml version='1.0'?>\n<iati-activities>\n{one}\n<iati-activity><title>none</title></iati-activity>\n{one}</iati-activities>")
    got = do.flatten_locations(do.read_activities(spark, str(tmp_path)))
    assert len(got.columns) == 14
    assert sorted(r["line"] for r in do.location_lines(got).collect()) == sorted(
        ["A & B||||||S1|12|f|2014-01-01||1|2|3", "A & B||||||S1|12|f|2014-01-01||4|5|"] * 2
    )


def test_closing_tags_in_comments_and_literal_sections_end_nothing(spark, tmp_path):
    from xml.etree import ElementTree

    odd = [
        "<!-- </iati-activity> -->", "<![CDATA[ </iati-activity> & <b> ]]>", "<![CDATA[ <!-- ]]>", "<!-- <![CDATA[ -->", "<!-- <iati-activity> <title>no</title> -->",
        "<!-- a </iati-activity> <![CDATA[ b </iati-activity> c -->", "<![CDATA[]]>", "<!-- - -->", "<![CDATA[ x ]] > ]]>", "plain &lt;text&gt;",
    ]
    rng = random.Random(3)
    one = lambda i, k: (
        f"<iati-activity n='{i}'><title>{''.join(rng.choice(odd) for _ in range(k))}T{i}</title>{rng.choice(odd) if k else ''}"
        f"<description>D{i}</description><location><coordinates latitude='{i}' longitude='{i + 1}'/></location></iati-activity>"
    )
    (tmp_path / "in").mkdir()
    for name, k in (("odd", 4), ("odder", 9), ("plain", 0)):
        (tmp_path / "in" / f"{name}.xml").write_text("<iati-activities>" + "\n".join(one(i, k) for i in range(120)) + "</iati-activities>")
    # sections that close before the next tag break no cut
    (tmp_path / "in" / "few.xml").write_text("<iati-activities>" + "".join(f"<iati-activity><!-- <iati-activity> --><title><![CDATA[a < b]]></title><location><coordinates latitude='{i}' longitude='0'/></location></iati-activity>" for i in range(9)) + "</iati-activities>")
    want = []
    for f in (tmp_path / "in").iterdir():
        for a in ElementTree.parse(f).getroot():
            c = a.find("location/coordinates")
            want.append(((a.findtext("title") or "").strip(), a.findtext("description") or "", c.get("latitude"), c.get("longitude")))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = do.flatten_locations(do.read_activities(spark, str(tmp_path / "in"))).select("title", "description", "latitude", "longitude").collect()
        none = do.read_activities(spark, str(tmp_path / "in" / "plain.xml"), sections=False).count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r[0].strip(), *r[1:]) for r in got) == sorted(want) and none == 120


def test_api_answers(spark):
    answer = json.dumps({"documents": {"D1": {"txturl": "http://a"}, "D2": {"txturl": None}, "facets": {}}})
    df = spark.createDataFrame([(answer,)], "j string")
    assert [r["txturl"] for r in do.explode_api_documents(df, "j").collect()] == ["http://a"]


def test_lines_naming_other_codes(spark):
    text = "P102792 and P111111\nxP102792 P222222\nno code\nsee P333333"
    df = spark.createDataFrame([(text,)], "t string")
    lines = do.lines_with_other_code(df, "t", "P102792").select("line", tx.project_codes(F.col("line")).alias("c")).collect()
    assert [(r["line"], r["c"]) for r in lines] == [("xP102792 P222222", ["P102792", "P222222"]), ("see P333333", ["P333333"])]


def test_stopword_files_and_defaults(spark, tmp_path):
    (tmp_path / "stopwords_fr.txt").write_text("le\nla\n\n")
    (tmp_path / "stopwords_de.txt").write_text("der\n")
    got = do.load_stopwords(spark, str(tmp_path)).collect()
    assert sorted((r["lang"], r["word"]) for r in got) == [("de", "der"), ("fr", "la"), ("fr", "le")]
    assert do.default_stopwords(spark, "english", "french").filter("word = 'the'").count() == 1


def test_grid_is_written_by_layer(spark, tmp_path):
    do.export_grid(spark.createDataFrame([("prec1", 1, 2, 3.0), ("prec2", 1, 2, 4.0)], "layer string, col int, row int, value double"), str(tmp_path / "g"))
    assert spark.read.parquet(str(tmp_path / "g")).filter("layer = 'prec2'").first()["value"] == 4.0


def test_change_files_are_taken_once(spark, tmp_path):
    landing, target = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()
    (landing / "deletes-2014-10-01.txt").write_text('1\tA "q"\n')
    (landing / "other.txt").write_text("9\tno\n")
    schema = "id bigint, name string"
    ch.ingest_change_files(spark, str(landing), schema, target)
    (landing / "modifications-2014-10-02.txt").write_text("2\tB\n")
    ch.ingest_change_files(spark, str(landing), schema, target)
    got = ch.read_changes(spark, target)
    assert sorted((r["kind"], r["id"], r["name"]) for r in got.collect()) == [("deletes", 1, 'A "q"'), ("modifications", 2, "B")]
    assert got.filter("retrieved is null").count() == 0


def test_release_check(spark, tmp_path):
    pages = spark.createDataFrame([("old 16/06/2014 new 03/12/2014, bad 99/99/2020",)], "page string")
    files = spark.createDataFrame([("in/CRS2014-06-16.txt",), ("in/crs2014-09-01.txt",), ("in/crs2015-01-01.csv",)], "path string")
    got = ch.is_newer(pages, "page", files, "path").first()
    assert tuple(got) == ("2014-12-03", "2014-09-01", True)
    assert ch.is_newer(pages, "page", files.limit(0), "path").first()["newer"] is True
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "page.txt").write_text("updated 01/01/2013")
    answers = []
    stream = spark.readStream.text(str(tmp_path / "p")).withColumnRenamed("value", "page")
    ch.check_each_batch(stream, "page", files, "path", lambda df: answers.append(df.first()["newer"]), str(tmp_path / "c")).awaitTermination()
    assert answers == [False]


def rows_scanned(df):
    """Rows that the scan of a plan without shuffles has given."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


@pytest.mark.parametrize("ids", [[5], [17, 40_000, 99_999, 250_000, 399_999, 123, 124, 310_000, 77_000, 200_000], list(range(0, 400_000, 9001)), [-4, 10**12], [None]])
def test_few_keys_read_few_rows(spark, tmp_path, ids):
    df = spark.range(400_000).select(F.expr("(id * 7919) % 400000").alias("geonameid"), F.md5(F.col("id").cast("string")).alias("name"))
    de.store_by_key(df, str(tmp_path / "stored"), "geonameid", 128 << 10)
    found = ex.lookup_few(spark.read.parquet(str(tmp_path / "stored")), ids)
    assert sorted(r["geonameid"] for r in found.collect()) == sorted(i for i in ids if i is not None and 0 <= i < 400_000)
    # pages of some thousand rows
    if ids != [None]:
        assert rows_scanned(found) < 400_000 * len(ids) / 100


def test_key_ranges_part_at_the_widest_gaps():
    assert ex.key_ranges([]) == [] and ex.key_ranges([3, 3]) == [(3, 3)]
    assert ex.key_ranges([1, 2, 3, 50, 51, 900], 3) == [(1, 3), (50, 51), (900, 900)]
    assert ex.key_ranges([1, 2, 3, 50, 51, 900], 1) == [(1, 900)]
    many = ex.key_ranges(list(range(0, 10_000, 3)))
    assert len(many) == ex.RANGES and many[0][0] == 0 and many[-1][1] == 9999
