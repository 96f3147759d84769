"""Aid-like tables derived from the given tables.

The SQL fragments below are plain arithmetic and text on keys; the same text
is used by the checking statements, so both sides start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almoner.functions.geo import Grid
from almoner.operators.skew import widen

GRID = Grid(x0=-180.0, y0=90.0, px=1.0, ncols=360, nrows=180)
DISC_METRES = 150000.0
# the working resolution: a tenth of a degree, discs of 25 km
FINE_GRID = Grid(x0=-180.0, y0=90.0, px=0.1, ncols=3600, nrows=1800)
FINE_METRES = 25000.0

# --- located aid: one lineitem is one location of the project that is its order
CODE = "case when l_linenumber = 7 then '8' else cast(l_linenumber as varchar(1)) end"
NO_PLACE = "(l_orderkey + l_partkey) % 97 = 0"
# some points lie exactly on the edges of the grid
LNG = f"case when {NO_PLACE} then null when l_orderkey % 53 = 1 then 180e0 when l_orderkey % 53 = 2 then -180e0 else (((l_orderkey * 7919 + l_partkey * 104729 + l_suppkey * 13) % 36000) * 2 - 35999) / 200e0 end"
LAT = f"case when {NO_PLACE} then null when l_orderkey % 59 = 1 then -90e0 when l_orderkey % 59 = 2 then 90e0 else (((l_orderkey * 15485863 + l_partkey * 32452843 + l_suppkey * 7) % 18000) * 2 - 17999) / 200e0 end"
# some projects have two amounts, some none
CENTS = (
    "case when l_orderkey % 101 = 0 then null else cast(round(o_totalprice * 100) as bigint)"
    " + case when l_orderkey % 50 = 0 and l_linenumber % 2 = 0 then 100000 else 0 end end"
)

# --- areas: a 5 x 5 layout of slanted quadrilaterals, one per nation; corners p q r s
LEFT = "(-178e0 + 72 * (n_nationkey % 5))"
LOW = "(-88e0 + 35 * floor(n_nationkey / 5e0))"
CORNERS = {
    "px": LEFT, "py": LOW,
    "qx": f"({LEFT} + 67.5e0)", "qy": f"({LOW} + 0.75e0)",
    "rx": f"({LEFT} + 66e0)", "ry": f"({LOW} + 32e0)",
    "sx": f"({LEFT} + 1.25e0)", "sy": f"({LOW} + 31.125e0)",
}
# the twelfth nation has a hole
HOLED = 12
HOLE = [("20e0", "8e0"), ("38e0", "9.5e0"), ("36e0", "21e0"), ("21.5e0", "20e0")]


def corner(axis: str, u: str, v: str) -> str:
    """A point of the quadrilateral at relative position u, v."""
    p, q, r, s = (f"{k}{axis}" for k in "pqrs")
    return f"((1 - {u}) * ((1 - {v}) * {p} + {v} * {s}) + {u} * ((1 - {v}) * {q} + {v} * {r}))"


# points on a lattice of eighths of a nation's area: on outlines of all levels and inside; some a billionth of a degree off
BORDER_U, BORDER_V = "(c_custkey % 9) / 8e0", "(floor(c_custkey / 9e0) % 9) / 8e0"
BORDER_LNG = corner("x", BORDER_U, BORDER_V)
BORDER_LAT = f"{corner('y', BORDER_U, BORDER_V)} + (floor(c_custkey / 81e0) % 3 - 1) * 1e-9"

# --- areas on both sides of the date line, one per nation, and points near it
DATE_LINE_SOUTH = "(-87.5e0 + 7 * n_nationkey)"
_EAST = [("168.25e0", 0), ("180e0", 0), ("180e0", 6.5), ("169.5e0", 6.25)]
_WEST = [("-180e0", 0), ("-170.25e0", 0.25), ("-171.5e0", 6.5), ("-180e0", 6.5)]
DATE_LINE_RINGS = [[(x, f"({DATE_LINE_SOUTH} + {y}e0)") for x, y in ring] for ring in (_EAST, _WEST)]
_OFF = "((c_custkey * 7919 % 800) * 2 - 799) / 400e0"
DATE_LINE_LNG = f"case when {_OFF} > 0 then {_OFF} - 180e0 else {_OFF} + 180e0 end"
DATE_LINE_LAT = f"{DATE_LINE_SOUTH} + 0.5e0 + (c_custkey * 104729 % 500) / 100e0 + 0.0013e0"

# --- gazetteer: parts as places
PLACE = "p_name || ' ' || translate(lpad(cast(p_partkey * 104729 % 9999991 as varchar(7)), 7, '0'), '0123456789', 'bcdfghjklm')"
ALTERNATES = f"case p_partkey % 3 when 0 then '' when 1 then {PLACE} || ',' || p_brand else p_brand || '|x,,' || {PLACE} end"
PLACE_LAT = "((p_partkey * 7919) % 18000 - 9000) / 100e0"
PLACE_LNG = "((p_partkey * 104729) % 36000 - 18000) / 100e0"
# the place named in a document, with no typo, a substitution, a deletion or an insertion
TYPO_AT = "(3 + doc_id % 7)"
MISSPELT = (
    f"case doc_id % 4 when 0 then {PLACE}"
    f" when 1 then substr({PLACE}, 1, cast({TYPO_AT} as int)) || 'Q' || substr({PLACE}, cast({TYPO_AT} + 2 as int))"
    f" when 2 then substr({PLACE}, 1, cast({TYPO_AT} as int)) || substr({PLACE}, cast({TYPO_AT} + 2 as int))"
    f" else substr({PLACE}, 1, cast({TYPO_AT} as int)) || 'Q' || substr({PLACE}, cast({TYPO_AT} + 1 as int)) end"
)
PLACE_TEXT = f"case when doc_id % 2 = 0 then {MISSPELT} || '. ' || text else text || ' ' || {MISSPELT} end"

# --- candidates: each document ends with a near copy of one benchmark passage
COPY_AT = "(5 + doc_id % 60)"
NEAR_COPY = (
    "case doc_id % 5 when 0 then b.text"
    f" when 1 then substr(b.text, 1, cast({COPY_AT} as int)) || 'q' || substr(b.text, cast({COPY_AT} + 2 as int))"
    f" when 2 then substr(b.text, 1, cast({COPY_AT} as int)) || substr(b.text, cast({COPY_AT} + 2 as int))"
    f" when 3 then substr(b.text, 1, cast({COPY_AT} as int)) || 'q' || substr(b.text, cast({COPY_AT} + 1 as int))"
    f" else 'q' || substr(b.text, 2, cast({COPY_AT} as int)) || 'qq' || substr(b.text, cast({COPY_AT} + 4 as int)) end"
)

# --- texts with codes, dates, markup
OWN_CODE = "'P' || lpad(cast(doc_id as varchar(9)), 6, '0')"
OTHER_CODE = "'P' || lpad(cast((doc_id * 7 + 3) % 1000000 as varchar(9)), 6, '0')"
CODED_TEXT = (
    f"text || chr(10) || 'see ' || {OTHER_CODE} || ' and ' || {OTHER_CODE} || chr(10) || 'own ' || {OWN_CODE} || ' with ' || {OTHER_CODE}"
)
PAGE_DATE = (
    "lpad(cast(page_id % 28 + 1 as varchar(2)), 2, '0') || '/' || lpad(cast(page_id * 5 % 12 + 1 as varchar(2)), 2, '0')"
    " || '/' || cast(2000 + page_id % 20 as varchar(4))"
)
DATED_PAGE = f"html || ' updated ' || {PAGE_DATE}"
RELEASE_PATH = (
    "'in/' || case when doc_id % 2 = 0 then 'CRS' else 'crs' end || cast(1990 + doc_id % 29 as varchar(4)) || '-'"
    " || lpad(cast(doc_id % 12 + 1 as varchar(2)), 2, '0') || '-' || lpad(cast(doc_id % 28 + 1 as varchar(2)), 2, '0')"
    " || case when doc_id % 3 = 0 then '.csv' else '.txt' end"
)
ESCAPED_PAGE = "replace(html, '&', '&amp;')"
API_ANSWER = (
    "'{\"documents\": {\"D' || cast(event_id as varchar(20)) || '\": {\"txturl\": ' || case when event_type = 'error' then 'null'"
    " else '\"http://docs.example/' || cast(event_id as varchar(20)) || '.txt\"' end || '}, \"E\": {\"other\": 1}}}'"
)
ACTIVITY_XML = (
    "'<iati-activity><title>T ' || o_orderpriority || ' &amp; more</title><title>second</title>'"
    " || '<iati-identifier>' || cast(o_orderkey as varchar(20)) || '</iati-identifier>'"
    " || case when o_orderkey % 3 = 0 then '' else '<description>D' || cast(o_custkey as varchar(20)) || '</description>' end"
    " || '<sector code=\"1\">S' || o_orderstatus || '</sector><sector>other</sector>'"
    " || '<transaction><flow-type>F' || o_orderstatus || '</flow-type></transaction>'"
    " || '<transaction><value currency=\"USD\">' || cast(cast(round(o_totalprice * 100) as bigint) as varchar(20)) || '</value></transaction>'"
    " || case when o_orderkey % 5 = 0 then '<location><name>none</name></location>' else '<location><coordinates latitude=\"'"
    " || cast(o_orderkey % 90 as varchar(9)) || '\" longitude=\"' || cast(o_custkey % 180 as varchar(9)) || '\" precision=\"1\"/></location>' end"
    " || case when o_orderkey % 2 = 0 then '<location><coordinates latitude=\"1\" longitude=\"2\"/></location>' else '' end"
    " || '</iati-activity>'"
)

# A short list for the vocabulary queries; real lists are files passed to load_stopwords.
STOPWORDS = "the and for that with les des que est pour der die und nicht los las una por para don't été".split()


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def locations(spark: SparkSession, sf: str) -> DataFrame:
    """``project_id, precision_code, longitude, latitude, amount``."""
    items = widen(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice")
    return items.join(orders, "l_orderkey").select(
        F.col("l_orderkey").alias("project_id"), F.expr(CODE).alias("precision_code"),
        F.expr(LNG).alias("longitude"), F.expr(LAT).alias("latitude"),
        (F.expr(CENTS).cast("decimal(18,0)") / 100).cast("decimal(20,2)").alias("amount"),
    )


def areas(spark: SparkSession, sf: str) -> DataFrame:
    """``gid, adm_level, geom``: nations, their quarters and their sixteenths."""
    nations = table(spark, sf, "nation").select("n_nationkey", *[F.expr(e).alias(n) for n, e in CORNERS.items()])

    def level(number: int, parts: int) -> DataFrame:
        cut = (
            nations.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts * parts - 1))))
            .withColumn("u0", F.expr(f"(part % {parts}) / {parts}e0"))
            .withColumn("u1", F.expr(f"(part % {parts} + 1) / {parts}e0"))
            .withColumn("v0", F.expr(f"floor(part / {parts}e0) / {parts}e0"))
            .withColumn("v1", F.expr(f"(floor(part / {parts}e0) + 1) / {parts}e0"))
        )
        at = lambda u, v: F.struct(F.expr(corner("x", u, v)).alias("x"), F.expr(corner("y", u, v)).alias("y"))
        outer = F.array(at("u0", "v0"), at("u1", "v0"), at("u1", "v1"), at("u0", "v1"))
        hole = F.array(*[F.struct(F.expr(f"px + {x}").alias("x"), F.expr(f"py + {y}").alias("y")) for x, y in HOLE])
        rings = F.when((F.col("n_nationkey") == HOLED) & F.lit(number == 0), F.array(outer, hole)).otherwise(F.array(outer))
        gid = F.lit(number * 1000000) + F.col("n_nationkey") * 100 + F.col("part")
        return cut.select(gid.cast("bigint").alias("gid"), F.lit(str(number)).alias("adm_level"), rings.alias("geom"))

    return level(0, 1).unionByName(level(1, 2)).unionByName(level(2, 4))


def border_points(spark: SparkSession, sf: str) -> DataFrame:
    """``point_id, longitude, latitude``"""
    nations = table(spark, sf, "nation").select("n_nationkey", *[F.expr(e).alias(n) for n, e in CORNERS.items()])
    met = table(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return met.select(F.col("c_custkey").alias("point_id"), F.expr(BORDER_LNG).alias("longitude"), F.expr(BORDER_LAT).alias("latitude"))


def date_line_areas(spark: SparkSession, sf: str) -> DataFrame:
    """``gid, adm_level, geom``: every area has a part on either side."""
    rings = F.array(*[F.array(*[F.struct(F.expr(x).alias("x"), F.expr(y).alias("y")) for x, y in ring]) for ring in DATE_LINE_RINGS])
    return table(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("gid"), F.lit("0").alias("adm_level"), rings.alias("geom"))


def date_line_points(spark: SparkSession, sf: str) -> DataFrame:
    """``longitude, latitude, financials``"""
    met = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    cents = F.col("c_custkey").cast("decimal(18,0)") * 100 + 1
    return met.select(F.expr(DATE_LINE_LNG).alias("longitude"), F.expr(DATE_LINE_LAT).alias("latitude"), (cents / 100).cast("decimal(20,2)").alias("financials"))


def gazetteer(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(
        "p_partkey as geonameid", f"{PLACE} as name", "p_name as asciiname", f"{ALTERNATES} as alternatenames",
        f"{PLACE_LAT} as latitude", f"{PLACE_LNG} as longitude", "'P' as featureclass", "p_type as featurecode",
        "p_brand as countrycode", "'' as cc2", "cast(p_size as string) as admin1code", "'' as admin2code",
        "'' as admin3code", "'' as admin4code", "cast(p_partkey * 10 as bigint) as population", "'' as elevation",
        "p_size as dem", "'UTC' as timezone", "date'2014-09-29' as modificationdate",
    )


def place_docs(spark: SparkSession, sf: str) -> DataFrame:
    """``doc_id, lang, text``: documents name the place with their own number, if there is one."""
    docs = widen(table(spark, sf, "documents").select("doc_id", "lang", "text"))
    places = table(spark, sf, "part").select("p_partkey", "p_name")
    joined = docs.join(places, docs["doc_id"] == places["p_partkey"], "left")
    return joined.select("doc_id", "lang", F.coalesce(F.expr(PLACE_TEXT), "text").alias("text"))


def candidate_docs(spark: SparkSession, sf: str) -> DataFrame:
    """``source_id, doc_id, text``: every document is a candidate of one passage."""
    passages = table(spark, sf, "benchmark")
    count = passages.agg(F.count("*").alias("n"))
    docs = widen(table(spark, sf, "documents").select("doc_id", "text")).withColumn("item", F.col("doc_id") % count.scalar())
    return docs.alias("d").join(passages.alias("b"), F.col("d.item") == F.col("b.item_id")).select(
        F.col("item_id").alias("source_id"), "doc_id", F.concat(F.col("d.text"), F.lit(" "), F.expr(NEAR_COPY)).alias("text")
    )


# --- project tables ----------------------------------------------------------

ROUND_ID = "l_orderkey * 100000 + l_suppkey"
PROJECT = {
    "id": "o_orderkey", "donor_project_id": "'D' || cast(o_custkey as varchar(20))", "donor_secondary_project_id": "o_orderstatus",
    "donor_id": "o_custkey", "recipient_id": "cast(o_custkey % 25 as int)",
    "start_date": "cast(o_orderdate as date)", "end_date": "cast(o_orderdate as date) + 30",
    "commitment_date": "cast(o_orderdate as date) - 7", "effective_date": "cast(o_orderdate as date) + 1",
    "year": "cast(year(o_orderdate) as int)",
    "title": "'Project' || chr(9) || chr(10) || o_orderpriority",
    "short_description": "case when o_orderkey % 7 = 0 then null else o_orderpriority || chr(13) || 'x' end",
    "long_description": "'long ' || o_orderstatus",
}
PROJECT_TABLES = {
    "project": ("orders", PROJECT),
    "custom_field_value": ("lineitem", {"project_id": "l_orderkey", "field_id": "case when l_linenumber % 2 = 1 then 4735940 else 1 end", "value": "l_returnflag || l_linestatus"}),
    "code_round_crs_code": ("lineitem", {"code_round_id": ROUND_ID, "crs_code_id": "l_partkey"}),
    "purpose_code": ("supplier", {"id": "s_suppkey", "code": "'C' || cast(s_suppkey % 10 as varchar(2))"}),
    "crs_code": ("part", {"id": "p_partkey", "code": "p_brand"}),
    "donor": ("customer", {"id": "c_custkey", "name": "c_name", "iso3": "c_mktsegment"}),
    "recipient": ("nation", {"id": "n_nationkey", "name": "n_name", "iso3": "'N' || cast(n_nationkey as varchar(2))"}),
}
# tables with one row per distinct key, or two rows per order
ROUND = {"id": ROUND_ID, "project_id": "l_orderkey", "purpose_code_id": "l_suppkey", "is_master": "l_suppkey % 3 <> 0"}
AMOUNT = {"project_id": "o_orderkey", "value": "cast(round(o_totalprice * 100) as bigint)"}


def project_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    pick = lambda name, columns: table(spark, sf, name).select(*[F.expr(e).alias(c) for c, e in columns.items()])
    out = {name: pick(source, columns) for name, (source, columns) in PROJECT_TABLES.items()}
    out["code_round"] = pick("lineitem", ROUND).distinct()
    amount = pick("orders", AMOUNT)
    out["project_amount"] = amount.withColumn("amount_type_id", F.lit("1")).unionByName(
        amount.withColumn("amount_type_id", F.lit("2")).withColumn("value", F.col("value") + 1)
    )
    return out


def research_release(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as records; the customer segment text is the donor, the language the sector."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("record_id"),
        F.expr(RELEASE["donor"]).alias("donor"), F.expr(RELEASE["recipient"]).alias("recipient"),
        F.col("lang").alias("sector"), F.expr(RELEASE["title"]).alias("title"),
        F.expr(RELEASE["short_description"]).alias("short_description"), F.col("text").alias("long_description"),
        F.expr(RELEASE["activity_code"]).alias("activity_code"),
    )


RELEASE = {
    "donor": "case when doc_id % 3 = 0 then 'World Fund' else 'Other' end",
    "recipient": "source",
    "title": "case when doc_id % 4 = 0 then null else 'Title ' || source end",
    "short_description": "cast(null as varchar(9))",
    "activity_code": "case when doc_id % 11 = 0 then null else source end",
}
