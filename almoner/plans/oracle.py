"""Checking statements: what each registered query must return, in plain SQL.

They restate the semantics without the library's strategies: points are
tested against every area, runs of words are compared with every name of a
like length, cells are tested one by one.
"""

from __future__ import annotations

from almoner.functions.geo import EARTH_RADIUS_M, EQUATOR_M, FLATTENING, PLACES
from almoner.operators.benford import EXPECTED
from almoner.operators.vocabulary import TAGS
from almoner.plans import fixtures as fx

W = r"[\p{L}\p{M}\p{N}_]"
N = r"[^\p{L}\p{M}\p{N}_]"
ORACLE: dict[str, str] = {}


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


# --- leading digits ----------------------------------------------------------


def _benford(amounts: str, keep: str, by_digit: bool = False) -> str:
    place = "cast(leading_digit as int)" if by_digit else "row_number() over (order by n desc, leading_digit desc)"
    six = lambda v: f"cast(format('{{:.6g}}', {v}) as decimal(24, 12))"
    return f"""
    with d as (select nullif(regexp_extract(split_part(amount, 'E', 1), '^[0.]*([^0|.])', 1), '') as leading_digit from ({amounts})),
    c as (select leading_digit, count(*) as n from d where leading_digit is not null and {keep} group by 1),
    r as (select leading_digit, n, sum(n) over () as total, cast([{", ".join(EXPECTED)}][{place}] as double) as expected from c),
    p as (select leading_digit, expected, {six("n * 100e0 / total")} as percent from r)
    select leading_digit, cast(round(percent, 2) as double) as percent_frequency,
           coalesce(cast(round({six("cast(percent as double) / expected")}, 2) as double), 0) as ratio_to_benfords
    from p"""


ORACLE["benford_amounts"] = _benford(
    "select cast(cast(round(l_extendedprice * 100) as bigint) as varchar) as amount from lineitem", "trim(leading_digit) <> ''"
)
ORACLE["benford_signed"] = _benford("select cast(cast(round(c_acctbal * 100) as bigint) as varchar) as amount from customer", "true")
ORACLE["benford_by_digit"] = _benford(
    "select cast(cast(round(o_totalprice * 100) as bigint) as varchar) || 'E-2' as amount from orders", "leading_digit between '1' and '9'", True
)

# --- vocabularies and weights --------------------------------------------------

ASCII = "regexp_replace(strip_accents(replace(replace(replace({0}, 'ß', 'ss'), '©', '(C)'), '·', '.')), '[^\\x00-\\x7f]', '', 'g')"


def words(text: str) -> str:
    plain = f"regexp_replace(translate({text}, '-/''_', '    '), '[[:punct:]]', '', 'g')"
    return f"regexp_extract_all(lower({ASCII.format(plain)}), '[a-z]+')"


def _replace_all(text: str, *pairs: tuple[str, str, str]) -> str:
    for pattern, to, flags in pairs:
        text = f"regexp_replace({text}, '{pattern}', '{to}', '{flags}')"
    return text


DECODED = "replace(replace(replace(replace(html, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;', '&')"
VISIBLE = _replace_all(
    DECODED,
    ("<!--.*?-->", " ", "gs"),
    (r"<script\b.*?</script\s*>", " ", "gis"),
    (r"<style\b.*?</style\s*>", " ", "gis"),
    (r"</?(?:a|abbr|b|big|code|em|font|i|s|small|span|strong|sub|sup|tt|u)(?:\s[^>]*)?/?>", "", "gi"),
    ("<[^>]*>", " ", "g"),
)
ORACLE["page_text"] = rf"select page_id, trim(regexp_replace({VISIBLE}, '\s+', ' ', 'g')) as text from pages"
ORACLE["page_body"] = """
    select page_id, regexp_replace(regexp_replace(regexp_extract(html, '(?s)<p>.*<p>'), '<[^>]*', '', 'g'), '>', '', 'g') as body from pages"""
ORACLE["bag_of_words"] = f"""
    select distinct term from (select unnest({words("text")}) as term from documents)
    where length(term) > 2 and term not in ({quoted(fx.STOPWORDS)})"""
ORACLE["stopword_files"] = f"""
    with lists as (
        select distinct term from (select unnest({words("text")}) as term from documents where lang in ('en', 'fr')) where length(term) <= 3)
    select distinct term from (select unnest({words("text")}) as term from documents) where term not in (select term from lists)"""
ORACLE["bag_of_words_html"] = f"""
    select distinct term from (select unnest({words(VISIBLE)}) as term from pages)
    where length(term) > 3 and term not in (select unnest({words("w")}) from unnest([{quoted(fx.STOPWORDS)}]) t(w))"""

LETTERS = r"regexp_extract_all(regexp_replace(lower({0}), '[^\x00-\x7f]', '', 'g'), '[a-z]+')"


def _tf(doc: str) -> str:
    return f"""tf as (
        select doc, term, count(*) as f from (
            select doc, unnest({LETTERS.format("text")}) as term from (select distinct {doc} as doc, text from documents where text is not null))
        where length(term) > 2 group by doc, term)"""


ATF = "atf as (select doc, term, f, 0.5e0 + f * 0.5e0 / max(f) over (partition by doc) as atf from tf)"


def _idf(doc: str) -> str:
    return f"""idf as (
        select term, count(distinct doc) as df, log10((select count(distinct {doc}) from documents) / (1e0 + count(distinct doc))) as idf
        from tf group by term)"""


ORACLE["term_freq"] = f"with {_tf('source')} select * from tf"
ORACLE["augmented_tf"] = f"with {_tf('source')}, {ATF} select doc, term, f, round(atf, 6) as atf from atf"
ORACLE["idf"] = f"with {_tf('doc_id')}, {_idf('doc_id')} select term, df, round(idf, 6) as idf from idf"
ORACLE["tfidf"] = f"""
    with {_tf("source")}, {ATF}, {_idf("source")}
    select doc, term, f, round(atf, 6) as atf, round(idf, 6) as idf, round(atf * idf, 6) as tfidf from atf join idf using (term)"""
ORACLE["lexicon_terms"] = f"""
    with {_tf("doc_id")} select * from tf where term in (select unnest({words("text")}) from benchmark)"""
ORACLE["tagged_terms"] = rf"""
    with t as (select conv_id, unnest(regexp_split_to_array(text, '\s+')) as token from conversations),
    p as (select conv_id, token, case length(token) % 3 when 0 then 'NNP' when 1 then 'NN' else 'VBD' end as pos from t),
    w as (select conv_id as doc, unnest({LETTERS.format("token")}) as term from p where pos in ({quoted(TAGS)}))
    select doc, term, count(*) as f from w where length(term) > 2 group by doc, term"""

# --- gazetteer and approximate search --------------------------------------------

NAMES = f"""names as (
    select * from (
        select p_partkey as geonameid, {fx.PLACE_LAT} as latitude, {fx.PLACE_LNG} as longitude,
               replace(unnest(case when {fx.ALTERNATES} <> '' then string_split({fx.ALTERNATES}, ',') else [{fx.PLACE}] end), '|', ' ') as placename
        from part) where placename <> '')"""
ORACLE["gazetteer_explode"] = f"with {NAMES} select * from names"
ORACLE["gazetteer_lookup"] = """
    select s_suppkey as geonameid, s_name, s_nationkey, s_acctbal from supplier where s_suppkey in (select l_suppkey from lineitem)"""
ORACLE["gazetteer_bucketed"] = f"""
    select p_partkey as geonameid, {fx.PLACE} as name, cast(p_partkey * 10 as bigint) as population from part where p_partkey in (select l_partkey from lineitem)"""
ORACLE["gazetteer_few_ids"] = f"""
    select p_partkey as geonameid, {fx.PLACE} as name, cast(p_partkey * 10 as bigint) as population from part
    where p_partkey in (select l_partkey from lineitem group by l_partkey order by sum(l_quantity) desc, l_partkey limit 10)"""
ORACLE["gazetteer_file"] = f"""
    select p_partkey as geonameid, {fx.PLACE} as name, nullif({fx.ALTERNATES}, '') as alternatenames, {fx.PLACE_LAT} as latitude,
           {fx.PLACE_LNG} as longitude, cast(p_partkey * 10 as bigint) as population, p_size as dem, '2014-09-29' as modificationdate
    from part"""

# documents and their runs of up to four words
PLACE_DOCS = f"docs as (select doc_id, lang, coalesce({fx.PLACE_TEXT}, text) as text from documents left join part on doc_id = p_partkey)"
RUNS = f"""pieces as (
        select doc_id, unnest(regexp_extract_all(line, '{W}+{N}*')) as p, unnest(regexp_extract_all(line, '{W}+')) as w,
               unnest(range(len(regexp_extract_all(line, '{W}+')))) as i
        from (select doc_id, cast(doc_id as varchar) || '|' || lang || '|' || text as line from docs)),
    led as (
        select doc_id, i, w as r1, p || lead(w, 1) over d as r2, p || lead(p, 1) over d || lead(w, 2) over d as r3,
               p || lead(p, 1) over d || lead(p, 2) over d || lead(w, 3) over d as r4
        from pieces window d as (partition by doc_id order by i)),
    runs as (select * from (select doc_id, i, unnest([r1, r2, r3, r4]) as run from led) where run is not null)"""
# two edits can part a name's words twice
LONG_RUNS = RUNS.replace("lead(w, 3) over d as r4", "lead(w, 3) over d as r4, p || lead(p, 1) over d || lead(p, 2) over d || lead(p, 3) over d || lead(w, 4) over d as r5").replace(
    "unnest([r1, r2, r3, r4])", "unnest([r1, r2, r3, r4, r5])"
)
# one edit leaves either the first or the second half of a name as it is
ONE_EDIT = """halves as (
        select distinct placename, length(placename) as m, placename[:length(placename) // 2] as head, placename[length(placename) // 2 + 1:] as tail
        from names where length(placename) > 1),
    texts as (
        select run, m, run[:m // 2] as head, right(run, m - m // 2) as tail
        from (select run, unnest([length(run) - 1, length(run), length(run) + 1]) as m from (select distinct run from runs))),
    met as (
        select placename, run from halves join texts using (m, head) union select placename, run from halves join texts using (m, tail)),
    found as (
        select placename, run, cost from (
            select *, levenshtein(placename, regexp_replace(run, '[^\\x00-\\x7f]', '~', 'g')) as cost from met)
        where cost <= 1)"""
# two edits leave one of three parts as it is, moved by at most two places
TWO_EDITS = """thirds as (
        select distinct placename, m, k, placename[m * k // 3 + 1:m * (k + 1) // 3] as part
        from (select placename, length(placename) as m from names where length(placename) > 2), (select unnest(range(3)) as k)),
    texts as (
        select distinct run, m, k, run[m * k // 3 + 1 + s:m * (k + 1) // 3 + s] as part
        from (select run, unnest(range(length(run) - 2, length(run) + 3)) as m from (select distinct run from runs)),
             (select unnest(range(3)) as k), (select unnest(range(-2, 3)) as s)
        where m > 2 and m * k // 3 + s >= 0),
    met as (
        select distinct placename, run from thirds join texts using (m, k, part)),
    found as (
        select placename, run, cost from (
            select *, levenshtein(placename, regexp_replace(run, '[^\\x00-\\x7f]', '~', 'g')) as cost from met)
        where cost <= 2)"""
# three edits leave one of four parts as it is, moved by at most three places, and can part a name's words three times
THREE_EDITS = TWO_EDITS.replace("thirds", "fourths").replace("length(placename) > 2", "length(placename) > 3").replace("// 3", "// 4").replace("range(3)", "range(4)").replace(
    "range(length(run) - 2, length(run) + 3)", "range(length(run) - 3, length(run) + 4)").replace("range(-2, 3)", "range(-3, 4)").replace("m > 2 and", "m > 3 and").replace("cost <= 2", "cost <= 3").replace(
    "(select distinct run from runs)", "(select distinct run from runs where length(run) between (select min(length(placename)) - 3 from names) and (select max(length(placename)) + 3 from names))")
LONGEST_RUNS = LONG_RUNS.replace("lead(w, 4) over d as r5", "lead(w, 4) over d as r5, p || lead(p, 1) over d || lead(p, 2) over d || lead(p, 3) over d || lead(p, 4) over d || lead(w, 5) over d as r6").replace(
    "r4, r5])", "r4, r5, r6])"
)
EXACTLY = "found as (select distinct placename, placename as run, 0 as cost from names where length(placename) > 0)"
BEST = """best as (
        select doc_id, placename, run, cost from runs join found using (run)
        qualify row_number() over (partition by doc_id, placename order by cost, i, length(run) desc) = 1)"""


def _geocode(found: str) -> str:
    return f"with {NAMES}, {PLACE_DOCS}, {RUNS}, {found}, {BEST}"


HIT = "geonameid, latitude, longitude, placename, replace(run, '|', '') as match_text"
ORACLE["geocode_exact"] = f"{_geocode(EXACTLY)} select {HIT}, cast(cost as int) as cost, doc_id from best join names using (placename)"
ORACLE["geocode_fuzzy"] = f"""
    {_geocode(ONE_EDIT)} select {HIT}, cast(cost as int) as cost, doc_id from best join names using (placename)"""
ORACLE["geocode_two_edits"] = f"""
    {_geocode(TWO_EDITS).replace(RUNS, LONG_RUNS)} select {HIT}, cast(cost as int) as cost, doc_id from best join names using (placename)"""
ORACLE["geocode_three_edits"] = f"""
    {_geocode(THREE_EDITS).replace(RUNS, LONGEST_RUNS)} select {HIT}, cast(cost as int) as cost, doc_id from best join names using (placename)"""
ORACLE["geocode_listing"] = f"""
    {_geocode(EXACTLY)} select {HIT}, doc_id, lang, text from best join names using (placename) join docs using (doc_id)"""


def _sentences(table: str, key: str) -> str:
    marked = r"regexp_replace(replace(text, chr(10), ' '), '([A-Za-z0-9]\.)', '\1' || chr(10), 'g')"
    return f"""cut as (
        select {key} as source_id, list_filter([trim(s, ' ' || chr(9)) for s in string_split({marked}, chr(10))], lambda s: s <> '') as s from {table}),
    sentences as (
        select source_id, cast(list_sum([length(x) + 1 for x in s]) as bigint) as num_char_source,
               unnest(s) as sentence, cast(unnest(range(len(s))) as int) as sentence_no from cut where len(s) > 0)"""


ORACLE["sentence_split"] = f"with {_sentences('documents', 'doc_id')} select * from sentences"
# letters outside ASCII occupy one byte each for the distance, which counts bytes
WIDE = "éóèñçüêäößíÉÈÑÓÇÄÊÜÖÍ"
NARROW = "".join(chr(c) for c in [*range(1, 9), *range(14, 27)])
ORACLE["match_sentences"] = rf"""
    with {_sentences("benchmark", "item_id")},
    docs as (
        select b.item_id as source_id, doc_id as hit_id, replace(replace(d.text || ' ' || {fx.NEAR_COPY}, chr(10), ' '), '|', '') as line
        from documents d join benchmark b on b.item_id = d.doc_id % (select count(*) from benchmark)),
    pieces as (
        select source_id, hit_id, length(regexp_extract(line, '^{N}*')) as lead_in, unnest(regexp_extract_all(line, '{W}+{N}*')) as p,
               unnest(regexp_extract_all(line, '{W}+')) as w, unnest(range(len(regexp_extract_all(line, '{W}+')))) as i
        from docs),
    places as (
        select source_id, hit_id, i, length(w) as n,
               lead_in + 1 + coalesce(sum(length(p)) over (partition by source_id, hit_id order by i rows between unbounded preceding and 1 preceding), 0) as a
        from pieces),
    windows as (
        select s.source_id, s.hit_id, t.sentence_no, t.sentence, t.num_char_source, s.a, z.a + z.n as past
        from places s
        join (select *, unnest(range(greatest(length(sentence) - 5, 1), length(sentence) + 6)) as len from sentences) t on t.source_id = s.source_id
        join places z on z.source_id = s.source_id and z.hit_id = s.hit_id and z.a + z.n = s.a + t.len),
    priced as (
        select w.source_id, w.hit_id, sentence_no, sentence, num_char_source, a, substr(line, cast(a as bigint), cast(past - a as bigint)) as match,
               levenshtein(translate(sentence, '{WIDE}', '{NARROW}'), translate(substr(line, cast(a as bigint), cast(past - a as bigint)), '{WIDE}', '{NARROW}')) as cost
        from windows w join docs d on d.source_id = w.source_id and d.hit_id = w.hit_id),
    best as (
        select * from priced where cost <= 5
        qualify row_number() over (partition by source_id, hit_id, sentence_no order by cost, a, length(match) desc) = 1),
    scored as (
        select cast(length(sentence) + 1 as int) as num_char_text, cast(length(match) + 1 as int) as num_char_match, source_id, num_char_source,
               hit_id, cast(cost as int) as cost, sentence as source_text, match as matched_text, sentence_no from best)
    select num_char_text, num_char_match, (num_char_text + num_char_match) / 2e0 as mean_char, source_id, num_char_source, hit_id, cost,
           case when cost = 0 then 9999e0 else ((num_char_text + num_char_match) * 50 // cost) / 100e0 end as mean_char_per_cost,
           source_text, matched_text, sentence_no
    from scored where cost = 0 or (num_char_text + num_char_match) * 50 // cost >= 1500"""

ORACLE["match_folders"] = ORACLE["match_sentences"]

# --- money on the map ----------------------------------------------------------

LOCS = f"""locs as (
        select l_orderkey as project_id, {fx.CODE} as precision_code, {fx.LNG} as longitude, {fx.LAT} as latitude, {fx.CENTS} as cents
        from lineitem join orders on l_orderkey = o_orderkey),
    shares as (
        select project_id, cents, count(*) as n, (2 * cents + count(*)) // (2 * count(*)) as share_cents
        from locs where longitude is not null and latitude is not null group by project_id, cents),
    located as (select l.project_id, precision_code, longitude, latitude, share_cents from locs l join shares s on l.project_id = s.project_id)"""


def _areas() -> str:
    quad = [("u0", "v0"), ("u1", "v0"), ("u1", "v1"), ("u0", "v1")]
    points = {f"{axis}{i}": fx.corner(axis, u, v) for i, (u, v) in enumerate(quad) for axis in "xy"}
    points |= {f"{axis}h{i}": f"p{axis} + {shift}" for i, h in enumerate(fx.HOLE) for axis, shift in zip("xy", h)}
    side = lambda a, b: f"struct_pack(x1 := x{a}, y1 := y{a}, x2 := x{b}, y2 := y{b})"
    ring = lambda names: ", ".join(side(a, b) for a, b in zip(names, names[1:] + names[:1]))
    outer, hole = ring(["0", "1", "2", "3"]), ring(["h0", "h1", "h2", "h3"])
    corners = ", ".join(f"{e} as {n}" for n, e in fx.CORNERS.items())
    levels = " union all ".join(f"select {n} as number, {p} as parts" for n, p in ((0, 1), (1, 2), (2, 4)))
    return f"""cut as (
        select *, (part % parts) / parts as u0, (part % parts + 1) / parts as u1, floor(part / parts) / parts as v0, (floor(part / parts) + 1) / parts as v1
        from (
            select n_nationkey, number, cast(parts as double) as parts, unnest(range(parts * parts)) as part, {corners}
            from nation, ({levels}))),
    cornered as (select *, {", ".join(f"{e} as {n}" for n, e in points.items())} from cut),
    areas as (
        select cast(number * 1000000 + n_nationkey * 100 + part as bigint) as gid, cast(number as varchar) as adm_level,
               case when n_nationkey = {fx.HOLED} and number = 0 then [{outer}, {hole}] else [{outer}] end as sides
        from cornered)"""


AREAS = _areas()


def settled(value: str) -> str:
    """Units of 1e-13, a whole number, rounded to four decimals as the queries do."""
    return f"cast(({value} + 500000000) // 1000000000 as bigint) / 10000e0"


def inside(x: str, y: str) -> str:
    return (
        f"len([1 for e in sides if (e.y1 > {y}) <> (e.y2 > {y}) and {x} < (e.x2 - e.x1) * ({y} - e.y1)"
        f" / (e.y2 - e.y1) + e.x1]) % 2 = 1"
    )


SPOT_AREAS = f"""spots as (
        select precision_code, longitude, latitude, sum(share_cents) as cents from located
        where longitude is not null and latitude is not null group by 1, 2, 3),
    wanted as (
        select *, case precision_code when '3' then '2' when '4' then '1' else '0' end as adm_level,
               case when precision_code in ('5', '6', '8') then '5 6 8' else precision_code end as codes
        from spots where precision_code <> '1'),
    held as (
        select w.codes, w.longitude, w.latitude, w.cents, a.gid from wanted w join areas a on a.adm_level = w.adm_level
        where {inside("longitude", "latitude")}),
    by_area as (select codes, gid, sum(cents) as cents from held where codes <> '2' group by codes, gid)"""
INT_CELL = "cast(col as int) as col, cast(row as int) as row"


def UNITS(count: str) -> str:  # noqa: N802
    """Cents by a number of cells, in units of 1e-13 of the currency, half rounded up."""
    return f"((2 * cast(cents as hugeint) * 100000000000 + {count}) // (2 * {count}))"


def _on_grid(g, metres: float) -> dict[str, str]:
    """Cells of areas, discs and points on a grid, each as a statement part."""
    x, y = f"({g.x0}e0 + (c.col + 0.5e0) * {g.px}e0)", f"({g.y0}e0 - (c.row + 0.5e0) * {g.px}e0)"
    # no degree of latitude is shorter than this
    reach = metres / 110000
    wide = f"{reach}e0 / greatest(cos(radians(least(89.9, abs(latitude) + {reach}e0))), 1e-3)"
    near = lambda middle, half, count: (
        f"unnest(range(greatest(0, cast(floor({middle} - {half} / {g.px}e0) as int) - 1), least({count}, cast(ceil({middle} + {half} / {g.px}e0) as int) + 2)))"
    )
    span = lambda low, high, count: f"unnest(range(greatest(0, cast(floor({low}) as int) - 1), least({count}, cast(ceil({high}) as int) + 1)))"
    # columns go on around the globe
    middle = f"((longitude - {g.x0}e0) / {g.px}e0)"
    start = f"(cast(floor({middle} - {wide} / {g.px}e0) as int) - 1)"
    around = f"unnest(list_transform(range({start}, least({start} + {g.ncols}, cast(ceil({middle} + {wide} / {g.px}e0) as int) + 2)), lambda k: ((k % {g.ncols}) + {g.ncols}) % {g.ncols}))"
    reduced = lambda lat: f"atan2({1 - FLATTENING!r} * sin(radians({lat})), cos(radians({lat})))"
    shorter = (
        f"{FLATTENING / 2!r} * ((angle - sin(angle)) * (sin((b1 + b2) / 2) * cos((b2 - b1) / 2)) ** 2 / (cos(angle / 2) ** 2)"
        " + coalesce((angle + sin(angle)) * (cos((b1 + b2) / 2) * sin((b2 - b1) / 2)) ** 2 / nullif(sin(angle / 2) ** 2, 0), 0))"
    )
    return {
        "area_cells": f"""boxed as (
        select gid, sides, {span(f"({g.y0}e0 - list_max([e.y1 for e in sides])) / {g.px}e0", f"({g.y0}e0 - list_min([e.y1 for e in sides])) / {g.px}e0", g.nrows)} as row from areas),
    near_cells as (
        select gid, sides, row, {span(f"(list_min([e.x1 for e in sides]) - {g.x0}e0) / {g.px}e0", f"(list_max([e.x1 for e in sides]) - {g.x0}e0) / {g.px}e0", g.ncols)} as col from boxed),
    area_cells as materialized (select gid, col, row from near_cells c where {inside(x, y)})""",
        "discs": f"""disc_rows as (
        select *, {near(f"(({g.y0}e0 - latitude) / {g.px}e0)", f"{reach}e0", g.nrows)} as row from held where codes = '2' and cents <> 0),
    disc_near as (select *, {around} as col from disc_rows),
    disc_reduced as (
        select longitude, latitude, gid, cents, c.col, c.row, {x} as x, {reduced("latitude")} as b1, {reduced(y)} as b2
        from disc_near c join area_cells using (gid, col, row)),
    disc_angles as (
        select *, 2 * asin(least(1, sqrt(sin((b2 - b1) / 2) ** 2 + cos(b1) * cos(b2) * sin(radians(x - longitude) / 2) ** 2))) as angle from disc_reduced),
    disc_cells as materialized (
        select longitude, latitude, gid, cents, col, row from disc_angles where {EQUATOR_M}e0 * (angle - {shorter}) <= {metres}e0),
    disc_values as (
        select *, {UNITS("n_cells")} as value from (
            select *, count(*) over (partition by longitude, latitude, gid) as n_cells from disc_cells))""",
        "sums": f"""cell_sums as (
        select precision_code, cast(least(floor((longitude - {g.x0}) / {g.px}e0), {g.ncols - 1}) as int) as col,
               cast(least(floor(({g.y0} - latitude) / {g.px}e0), {g.nrows - 1}) as int) as row, sum(share_cents) as cents from located
        where longitude is not null and latitude is not null group by 1, 2, 3)""",
    }


AREA_VALUES = f"""area_values as (
        select codes, gid, col, row, {UNITS("n_cells")} as value from (
            select b.codes, b.gid, col, row, b.cents, count(*) over (partition by b.codes, b.gid) as n_cells
            from by_area b join area_cells using (gid) where b.cents <> 0))"""
LAYERS = """layers as (
        select 'prec1' as layer, col, row, cast(cents as hugeint) * 100000000000 as value from cell_sums where precision_code = '1'
        union all select 'prec2', col, row, sum(value) from disc_values group by col, row
        union all select 'prec' || replace(codes, ' ', ''), col, row, sum(value) from area_values group by codes, col, row)"""


def _allocated(parts: dict[str, str]) -> str:
    return f"with {LOCS}, {AREAS}, {SPOT_AREAS}, {parts['area_cells']}, {AREA_VALUES}, {parts['discs']}, {parts['sums']}, {LAYERS}"


G = fx.GRID
COARSE = _on_grid(G, fx.DISC_METRES)
AREA_CELLS, DISCS, CELL_SUMS = COARSE["area_cells"], COARSE["discs"], COARSE["sums"]
ALLOCATED, FINE = _allocated(COARSE), _allocated(_on_grid(fx.FINE_GRID, fx.FINE_METRES))

ORACLE["location_share"] = f"with {LOCS} select project_id, coalesce(cents, -1) as amount_cents, n as count_locs, coalesce(cast(share_cents as bigint), -1) as share_cents from shares"
ORACLE["attach_share"] = f"with {LOCS} select project_id, precision_code, longitude, latitude, coalesce(cast(share_cents as bigint), -1) as share_cents from located"
ORACLE["location_points"] = f"""
    with {LOCS} select distinct longitude as lng, latitude as lat,
           round(2 * {EARTH_RADIUS_M}e0 * asin(sqrt(least(1, sin(radians(latitude) / 2) ** 2 + cos(radians(latitude)) * sin(radians(longitude) / 2) ** 2))), 2) as metres
    from locs where longitude is not null and latitude is not null"""
ORACLE["points_within"] = f"""
    with {LOCS}, {AREAS} select project_id, longitude, latitude, gid from locs join areas on adm_level = '0' where {inside("longitude", "latitude")}"""
ORACLE["sum_by_area"] = f"with {LOCS}, {AREAS}, {SPOT_AREAS} select codes, gid, coalesce(cast(cents as bigint), -1) as cents from by_area"
ORACLE["sum_by_cell"] = f"""
    with {LOCS}, {CELL_SUMS}
    select col, row, {G.x0}e0 + (col + 0.5e0) * {G.px}e0 as lng, {G.y0}e0 - (row + 0.5e0) * {G.px}e0 as lat, coalesce(cast(cents as bigint), -1) as cents
    from cell_sums where precision_code = '1'"""
ORACLE["spread_over_cells"] = f"""
    with {LOCS}, {AREAS}, {SPOT_AREAS}, {AREA_CELLS}, {AREA_VALUES}
    select gid, {INT_CELL}, {settled("value")} as value from area_values where codes = '5 6 8'"""
ORACLE["sum_by_area_level"] = f"with {LOCS}, {AREAS}, {SPOT_AREAS} select gid, coalesce(cast(cents as bigint), -1) as cents from by_area where codes = '5 6 8'"
ORACLE["spread_over_disc"] = f"""
    with {LOCS}, {AREAS}, {SPOT_AREAS}, {AREA_CELLS}, {DISCS}
    select longitude, latitude, gid, {INT_CELL}, {settled("value")} as value from disc_values"""
DISC_ROWS = f"""{LOCS}, {AREAS}, {SPOT_AREAS}, {AREA_CELLS}, {DISCS},
    location_rows as materialized (
        select row_number() over () as n, longitude, latitude, gid, share_cents from located join areas on adm_level = '0'
        where precision_code = '2' and longitude is not null and latitude is not null and {inside("longitude", "latitude")}),
    own_cells as materialized (
        select n, col, row from location_rows join disc_cells using (longitude, latitude, gid) where share_cents <> 0),
    crowded as materialized (
        select col, row from own_cells group by col, row having min(n) <> max(n)),
    meeting as materialized (
        select distinct n from own_cells join crowded using (col, row)),
    flagged as (
        select longitude, latitude, gid, m.n is not null as overlaps from location_rows l left join meeting m on l.n = m.n)"""
ORACLE["overlapping_discs"] = f"with {DISC_ROWS} select * from flagged"
ORACLE["lone_discs"] = f"with {DISC_ROWS} select longitude, latitude, gid from flagged f group by 1, 2, 3 having not bool_or(f.overlaps)"


def on_outline(x: str, y: str) -> str:
    """By exact products of decimals."""
    d = lambda v: f"cast({v} as decimal(16,{PLACES}))"
    return (
        f"len([1 for e in sides if {x} between least(e.x1, e.x2) and greatest(e.x1, e.x2) and {y} between least(e.y1, e.y2) and greatest(e.y1, e.y2)"
        f" and ({d('e.x2')} - {d('e.x1')}) * ({d(y)} - {d('e.y1')}) = ({d('e.y2')} - {d('e.y1')}) * ({d(x)} - {d('e.x1')})]) > 0"
    )


ORACLE["points_on_borders"] = f"""
    with {AREAS}, points as (
        select c_custkey as point_id, {fx.BORDER_LNG} as longitude, {fx.BORDER_LAT} as latitude
        from customer join (select n_nationkey, {", ".join(f"{e} as {n}" for n, e in fx.CORNERS.items())} from nation) on c_nationkey = n_nationkey)
    select point_id, adm_level, gid from points, areas where {inside("longitude", "latitude")} and not {on_outline("longitude", "latitude")}"""


def _ring(points: list[tuple[str, str]]) -> str:
    return ", ".join(f"struct_pack(x1 := {a[0]}, y1 := {a[1]}, x2 := {b[0]}, y2 := {b[1]})" for a, b in zip(points, points[1:] + points[:1], strict=True))


ORACLE["discs_across_date_line"] = f"""
    with areas as (
        select cast(n_nationkey as bigint) as gid, [{", ".join(map(_ring, fx.DATE_LINE_RINGS))}] as sides from nation),
    spots as (
        select {fx.DATE_LINE_LNG} as longitude, {fx.DATE_LINE_LAT} as latitude, sum(c_custkey * 100 + 1) as cents
        from customer join nation on c_nationkey = n_nationkey group by 1, 2),
    held as (
        select '2' as codes, longitude, latitude, cents, gid from spots, areas where {inside("longitude", "latitude")}),
    {AREA_CELLS}, {DISCS}
    select longitude, latitude, gid, {INT_CELL}, {settled("value")} as value from disc_values"""
ORACLE["allocate_money"] = f"{ALLOCATED} select layer, {INT_CELL}, {settled("value")} as value from layers where value is not null"
ORACLE["export_grid"] = ORACLE["allocate_money"]
ORACLE["allocate_fine"] = f"""
    {FINE} select layer, cast(col // 10 as int) as col, cast(row // 10 as int) as row, count(*) as cells, {settled("sum(value)")} as value
    from layers where value is not null group by all"""
ORACLE["total_layers"] = f"{ALLOCATED} select {INT_CELL}, {settled("sum(value)")} as value from layers where value is not null group by col, row"

# --- extracts --------------------------------------------------------------------


def _pick(table: str, columns: dict[str, str], distinct: str = "") -> str:
    return f"(select {distinct} {', '.join(f'{e} as {c}' for c, e in columns.items())} from {table})"


T = {name: _pick(source, columns) for name, (source, columns) in fx.PROJECT_TABLES.items()}
T["code_round"] = _pick("lineitem", fx.ROUND, "distinct")
_AMOUNTS = ", ".join(f"{e} as {c}" for c, e in fx.AMOUNT.items())
T["project_amount"] = (
    f"(select {_AMOUNTS}, '1' as amount_type_id from orders union all"
    f" select project_id, value + 1, '2' from (select {_AMOUNTS} from orders))"
)
_CLEAN = lambda c: rf"regexp_replace(any_value(p.{c}), '[\n\r\t]+', ' ', 'g') as {c}"
ORACLE["project_extract"] = f"""
    select p.id as project_id, any_value(p.donor_project_id) as donor_project_id, any_value(p.donor_secondary_project_id) as donor_secondary_project_id,
           d.id as donor_id, any_value(d.name) as donor_name, any_value(d.iso3) as donor_iso3,
           r.id as recipient_id, any_value(r.name) as recipient_name, any_value(r.iso3) as recipient_iso3,
           cast(cast(any_value(p.start_date) as date) as varchar) as start_date, cast(cast(any_value(p.end_date) as date) as varchar) as end_date, cast(cast(any_value(p.commitment_date) as date) as varchar) as commitment_date,
           cast(cast(any_value(p.effective_date) as date) as varchar) as effective_date, any_value(p.year) as year, a.value as commitment_current_usd,
           {_CLEAN("title")}, {_CLEAN("short_description")}, {_CLEAN("long_description")},
           cfv.value as crs_purpose_code, pc.code as classified_purpose_code, string_agg(distinct c.code, '|' order by c.code) as activity_codes
    from {T["project"]} p
    join {T["custom_field_value"]} cfv on p.id = cfv.project_id
    join {T["code_round"]} cr on p.id = cr.project_id
    join {T["purpose_code"]} pc on cr.purpose_code_id = pc.id
    join {T["code_round_crs_code"]} x on cr.id = x.code_round_id
    join {T["crs_code"]} c on x.crs_code_id = c.id
    join {T["recipient"]} r on p.recipient_id = r.id
    join {T["donor"]} d on p.donor_id = d.id
    join {T["project_amount"]} a on p.id = a.project_id
    where cfv.field_id = 4735940 and cr.is_master and a.amount_type_id = '1'
    group by p.id, cfv.value, pc.code, r.id, d.id, a.value"""
ORACLE["project_extract_filtered"] = f"""
    select project_id, crs_purpose_code, classified_purpose_code, activity_codes, commitment_current_usd from ({ORACLE["project_extract"]})
    where crs_purpose_code like 'R%' and year < 1997"""
ORACLE["activity_codes"] = """
    select l_orderkey, string_agg(distinct cast(cast(l_shipdate as date) as varchar), '|' order by cast(cast(l_shipdate as date) as varchar)) as days
    from lineitem group by l_orderkey"""
RELEASE = f"""release as (
        select doc_id as record_id, {", ".join(f"{e} as {c}" for c, e in fx.RELEASE.items())}, lang as sector, text as long_description from documents),
    measured as (select *, cast(length(concat(title, short_description, long_description)) as int) as length from release
                 where activity_code is not null)"""
ORACLE["sample_records"] = f"""
    with {RELEASE}
    select record_id, donor, recipient, sector, title, short_description, long_description, activity_code, length from measured
    where coalesce(title, short_description, long_description) is not null and length >= 50 and length < 2000
          and regexp_matches(donor, 'world fund|none', 'i') and regexp_matches(sector, '^(EN|fr)$', 'i')
    order by md5(cast(record_id as varchar) || '#7'), record_id limit 100"""
ORACLE["sample_large"] = """
    select l_orderkey * 10 + l_linenumber as record_id, l_returnflag as activity_code, cast(length(l_returnflag || l_linestatus) as int) as length from lineitem
    order by md5(cast(l_orderkey * 10 + l_linenumber as varchar) || '#3'), 1 limit 20000"""
ORACLE["code_rule_records"] = f"""
    with {RELEASE}
    select record_id, donor, sector, length from measured
    where (title is not null or short_description is not null) and length >= 100 and length < 5000"""
ORACLE["cross_references"] = rf"""
    with lines as (select doc_id, {fx.OWN_CODE} as own, unnest(string_split({fx.CODED_TEXT}, chr(10))) as line from documents)
    select doc_id, line, array_to_string(regexp_extract_all(line, 'P[0-9]{{6}}'), ',') as codes from lines
    where regexp_matches(line, 'P[0-9]{{6}}') and not regexp_matches(line, '\b' || own || '\b')"""
ORACLE["distinct_difference"] = "select o_orderkey, o_orderstatus from orders where o_orderkey not in (select l_orderkey from lineitem)"
ORACLE["top_amount"] = "select o_orderkey from orders order by o_totalprice desc, o_orderkey desc limit 1"

# --- formats ---------------------------------------------------------------------

LOCATIONS = """locations as (
        select 'T ' || o_orderpriority || ' & more' as title, case when o_orderkey % 3 = 0 then '' else 'D' || cast(o_custkey as varchar) end as description,
               cast(o_orderkey as varchar) as iati_identifier, '' as other_identifier, '' as participating_org, '' as recipient_country,
               'S' || o_orderstatus as sector, cast(cast(round(o_totalprice * 100) as bigint) as varchar) as transaction_value,
               'F' || o_orderstatus as transaction_flow_type, '' as transaction_date, '' as transaction_type,
               unnest(list_filter([
                   case when o_orderkey % 5 <> 0 then {'a': cast(o_orderkey % 90 as varchar), 'b': cast(o_custkey % 180 as varchar), 'c': '1'} end,
                   case when o_orderkey % 2 = 0 then {'a': '1', 'b': '2', 'c': ''} end], lambda x: x is not null)) as c
        from orders)"""
LOCATION_FIELDS = [
    "title", "description", "iati_identifier", "other_identifier", "participating_org", "recipient_country", "sector",
    "transaction_value", "transaction_flow_type", "transaction_date", "transaction_type",
]
ORACLE["flatten_locations"] = f"""
    with {LOCATIONS} select {", ".join(LOCATION_FIELDS)}, c.a as latitude, c.b as longitude, c.c as precision from locations"""
ORACLE["location_lines"] = f"""
    with {LOCATIONS} select {" || '|' || ".join(LOCATION_FIELDS)} || '|' || c.a || '|' || c.b || '|' || c.c as line from locations"""
ORACLE["api_documents"] = """
    select event_id, 'http://docs.example/' || cast(event_id as varchar) || '.txt' as txturl from events where event_type <> 'error'"""
ORACLE["read_utf16_by_splits"] = """
    select cast(o_orderkey as varchar) as id, '"' || o_orderpriority || ' é' as priority, case when o_custkey % 3 <> 0 then o_orderstatus end as status from orders"""
ORACLE["read_utf16"] = "select cast(c_custkey as varchar) as id, c_name || ' é' as name, c_mktsegment as segment from customer"
ORACLE["read_uniform"] = "select l_orderkey, l_partkey, l_suppkey from lineitem"
ORACLE["write_delimited"] = r"""
    select doc_id, lang, trim(regexp_replace(regexp_replace(text, '[|\n\r\t"]+', ' ', 'g'), '\s+', ' ', 'g')) as text from documents"""
ORACLE["split_by_key"] = """
    select 'c_level1' as level, c_custkey, cast(c_nationkey // 5 as int) as code from customer
    union all select 'c_nationkey', c_custkey, c_nationkey from customer"""
ORACLE["column_at"] = "select o_totalprice from orders"
ORACLE["document_lines"] = r"select * from (select doc_id, unnest(regexp_split_to_array(text, '[.\n]')) as line from documents) where regexp_matches(line, '\S')"
ORACLE["column_range"] = "select o_orderkey, o_custkey, o_orderstatus from orders"
ORACLE["download_manifest"] = """
    select '2011' as year, 'http://docs.example/pdf/PNA' || cast(page_id as varchar) || 'B.pdf' as url from pages"""
# the first day of the Persian years the orders fall in
NEW_YEARS = {
    1373: "1994-03-21", 1374: "1995-03-21", 1375: "1996-03-20", 1376: "1997-03-21", 1377: "1998-03-21",
    1378: "1999-03-21", 1379: "2000-03-20", 1380: "2001-03-21", 1381: "2002-03-21",
}
ORACLE["jalaali_dates"] = f"""
    with years as (select * from (values {", ".join(f"({y}, date '{d}')" for y, d in NEW_YEARS.items())}) v(y, start)),
    placed as (
        select o_orderkey, cast(o_orderdate as date) as day, y, cast(o_orderdate as date) - start as k
        from orders asof join years on cast(o_orderdate as date) >= start)
    select o_orderkey, case when k < 186 then (k % 31 + 1) || '/' || (k // 31 + 1) else ((k - 186) % 30 + 1) || '/' || ((k - 186) // 30 + 7) end
           || '/' || y as jalaali, cast(day as varchar) as gregorian
    from placed"""
ORACLE["latest_release"] = rf"""
    with dates as (select unnest(regexp_extract_all({fx.DATED_PAGE}, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}')) as d from pages),
    remote as (select strftime(max(try_strptime(d, '%d/%m/%Y')), '%Y-%m-%d') as r from dates),
    local as (select regexp_extract(max(path), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') as l from (select {fx.RELEASE_PATH} as path from documents)
              where regexp_matches(path, '(?i)^.*crs.*[.]txt$'))
    select r as remote_latest, l as local_latest, r > l as newer from remote, local"""
ORACLE["release_batches"] = ORACLE["latest_release"]
ORACLE["ingest_changes"] = """
    select case when event_type = 'error' then 'deletes' else 'modifications' end as kind, event_id, event_type, user_id from events"""
