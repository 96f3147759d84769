import datetime as dt

import pytest
from pyspark.sql import functions as F

from almoner.functions import dates, geo, numbers
from almoner.functions import text as tx


def test_entities_are_decoded_twice(rows):
    got = rows(
        ["a &amp;lt;b&amp;gt;", "caf&eacute; &Eacute", "&#8217;&#x1F600;&#0;", "&nosuch; &", "R&D", "&OElig x &OElig;", None, "&amp;amp;amp;"],
        lambda v: tx.decode_entities(v),
    )
    assert got == ["a <b>", "café É", "’😀&#0;", "&nosuch; &", "R&D", "&OElig x Œ", None, "&amp;"]


def test_decoding_once_leaves_the_second_level(rows):
    assert rows(["&amp;quot;"], lambda v: tx.decode_entities(v, times=1)) == ["&quot;"]


def test_html_to_text_drops_scripts_comments_and_joins_inline_tags(rows):
    html = "<p>Hel<b>lo</b><!-- x > y --><script>var a='<p>';</script>world</p><style>p{}</style>end"
    assert rows([html], lambda v: tx.squeeze(tx.html_to_text(v))) == ["Hello world end"]


def test_separators_split_and_punctuation_joins(rows):
    assert rows(["e.g. well-known a/b l'eau x_y"], lambda v: tx.drop_punct(tx.separators_to_space(v))) == ["eg well known a b l eau x y"]


def test_transliteration_and_its_absence(rows):
    words = ["café", "Straße", "œuvre", "naïve Ångström", "日本x", "é"]
    assert rows(words, lambda v: tx.to_ascii(v)) == ["cafe", "Strasse", "oeuvre", "naive Angstrom", "x", "e"]
    assert rows(words[:1], lambda v: tx.drop_non_ascii(v)) == ["caf"]


def test_body_runs_from_first_to_last_marker(rows):
    m = '<p class="x">'
    assert rows([f"a{m}one</p>{m}two <b>B</b></p>{m}three</p>", f"a{m}only"], lambda v: tx.body_between(v, m)) == ["onetwo B", ""]


def test_sentences_split_after_letter_or_digit_and_stop(rows):
    assert rows(["One.  Two 3.5 x!.  \n Last"], lambda v: tx.sentences(v)) == [["One.", "Two 3.", "5 x!.    Last"]]


def test_scrub_squeeze_join(rows):
    assert rows(["a\n\r\tb|c"], lambda v: tx.scrub(v)) == ["a b|c"]
    assert rows(["a", None], lambda v: tx.join_fields([v, F.lit("x"), v])) == ["a|x|a", "|x|"]
    assert rows(["see P123456 and P1234567"], lambda v: tx.project_codes(v)) == [["P123456", "P123456"]]


def test_first_digit_quirks(rows):
    got = rows(["3E-1", "EUR", "0.0E5", "-5", "NA", " 12", "0.00", "", "0.031", "1e5", None], lambda v: numbers.first_digit(v))
    assert got == ["3", None, None, "-", "N", " ", None, None, "3", "1", None]


def test_tiny_numbers_are_kept(rows):
    assert rows(["4E-50"], lambda v: numbers.first_digit(v)) == ["4"]


def test_day_first_dates(rows):
    assert rows(["03/12/2014", "31/02/2014", "x"], lambda v: dates.dmy_to_date(v)) == [dt.date(2014, 12, 3), None, None]
    assert rows(["a/crs2014-06-16.txt", "a/b.txt"], lambda v: dates.date_in_path(v)) == ["2014-06-16", ""]


def test_jalaali_known_days(rows):
    got = rows(["26/5/1360", "30/12/1399", "30/12/1400", "1/1/1403", "31/7/1380", "31/6/1380", "x", "1/13/1380"], lambda v: dates.jalaali_to_date(v))
    assert got == [dt.date(1981, 8, 17), dt.date(2021, 3, 20), None, dt.date(2024, 3, 20), None, dt.date(2001, 9, 22), None, None]
    assert rows(["1360/5/26"], lambda v: dates.jalaali_to_date(v, "ymd")) == [dt.date(1981, 8, 17)]


def test_jalaali_round_trip_over_three_centuries(spark):
    days = spark.sql("select date_add(date'1800-01-01', cast(id as int)) as v from range(0, 110000, 3)")
    back = dates.jalaali_to_date(dates.date_to_jalaali(F.col("v"), "ymd"), "ymd")
    assert days.filter(~back.eqNullSafe(F.col("v"))).count() == 0


def test_cells_and_distance(spark):
    grid = geo.Grid(-180.0, 90.0, 0.5, 720, 360)
    col, row = geo.to_cell(F.lit(-179.9), F.lit(89.9), grid)
    x, y = geo.cell_centre(F.lit(1), F.lit(2), grid)
    got = spark.range(1).select(col, row, x, y, geo.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))).first()
    assert list(got)[:4] == [0, 0, -179.25, 88.75]
    assert got[4] == pytest.approx(111195, abs=1)


def test_persian_calendar_ends_where_it_says(rows):
    # the last day of 2400 has a date; the day after it, and years outside, have no Persian date
    last = rows(["29/12/2400", "30/12/2400", "1/1/2401", "1/1/1"], lambda c: dates.jalaali_to_date(c).cast("string"))
    assert last[0] is not None and last[2] is None and last[3] == "0622-03-22"
    after = rows([last[1] or last[0]], lambda c: dates.date_to_jalaali(F.date_add(c.cast("date"), 1)))
    assert after == [None]
    assert rows([last[0]], lambda c: dates.date_to_jalaali(c.cast("date"))) == ["2400/12/29"]
