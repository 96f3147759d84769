"""The registered queries: each operator over whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almoner.functions import dates as dt
from almoner.functions import geo as ge
from almoner.functions import text as tx
from almoner.operators import areas as ar
from almoner.operators import extracts as ex
from almoner.operators import gazetteer as gz
from almoner.operators import grid as gr
from almoner.operators import sentences as se
from almoner.operators import shares as sh
from almoner.operators import vocabulary as vo
from almoner.operators import weights as we
from almoner.operators.benford import benford
from almoner.plans import fixtures as fx
from almoner.plans.allocation import allocate
from almoner.session import scratch_dir, settle, stored
from almoner.sources import delimited as de
from almoner.sources import documents as do
from almoner.streaming import changes as ch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def cents(name: str) -> F.Column:
    """Money as whole cents; unknown amounts show as -1."""
    return F.coalesce((F.col(name) * 100).cast("bigint"), F.lit(-1).cast("bigint"))


def settled(name: str) -> F.Column:
    """An exact decimal, shown to four places."""
    return F.round(name, 4).cast("double").alias(name)


def rounded(name: str, places: int) -> F.Column:
    return F.round(name, places).alias(name)


# --- leading digits ----------------------------------------------------------


@query
def benford_amounts(spark, sf):
    items = fx.table(spark, sf, "lineitem").select(F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string").alias("amount"))
    return benford(items, "amount")


@query
def benford_signed(spark, sf):
    balances = fx.table(spark, sf, "customer").select(F.round(F.col("c_acctbal") * 100).cast("bigint").cast("string").alias("amount"))
    return benford(balances, "amount", order="frequency")


@query
def benford_by_digit(spark, sf):
    totals = fx.table(spark, sf, "orders").select(F.concat(F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string"), F.lit("E-2")).alias("amount"))
    return benford(totals, "amount", expect_by="digit")


# --- vocabularies and weights --------------------------------------------------


def _stopwords(spark):
    return spark.createDataFrame([(w,) for w in fx.STOPWORDS], "word string")


@query
def bag_of_words(spark, sf):
    return vo.bag_of_words(fx.table(spark, sf, "documents"), "text", _stopwords(spark), min_len=2, html=False)


@query
def bag_of_words_html(spark, sf):
    pages = fx.table(spark, sf, "pages").select(F.expr(fx.ESCAPED_PAGE).alias("html"))
    return vo.bag_of_words(pages, "html", _stopwords(spark), min_len=3, normalize_stopwords=True)


@query
def page_text(spark, sf):
    pages = fx.table(spark, sf, "pages")
    return pages.select("page_id", tx.squeeze(tx.html_to_text(tx.decode_entities(F.expr(fx.ESCAPED_PAGE)))).alias("text"))


@query
def page_body(spark, sf):
    return fx.table(spark, sf, "pages").select("page_id", tx.body_between(F.col("html"), "<p>").alias("body"))


@query
def term_freq(spark, sf):
    return we.term_freq(fx.table(spark, sf, "documents"), "source", "text")


@query
def augmented_tf(spark, sf):
    tf = we.augmented_tf(we.term_freq(fx.table(spark, sf, "documents"), "source", "text"))
    return tf.select("doc", "term", "f", rounded("atf", 6))


@query
def idf(spark, sf):
    docs = fx.table(spark, sf, "documents")
    weights = we.idf(we.term_freq(docs, "doc_id", "text"), we.document_count(docs, "doc_id"))
    return weights.select("term", "df", rounded("idf", 6))


@query
def tfidf(spark, sf):
    out = we.tfidf(fx.table(spark, sf, "documents"), "source", "text")
    return out.select("doc", "term", "f", *[rounded(c, 6) for c in ("atf", "idf", "tfidf")])


@query
def stopword_files(spark, sf):
    # word lists as files, one per language; here the short words of each language
    folder = scratch_dir(spark, "lists")
    words = fx.table(spark, sf, "documents").select("lang", F.explode(vo.tokens(F.col("text"))).alias("word"))
    short = words.filter(F.length("word") <= 3).distinct()
    for lang in ("de", "en", "es", "fr"):
        short.filter(F.col("lang") == lang).select("word").write.text(f"{folder}/stopwords_{lang}.txt")
    lists = do.load_stopwords(spark, f"{folder}/*")
    return vo.bag_of_words(fx.table(spark, sf, "documents"), "text", lists.filter("lang in ('en', 'fr')"), html=False)


@query
def lexicon_terms(spark, sf):
    words = vo.bag_of_words(fx.table(spark, sf, "benchmark"), "text", html=False)
    return we.term_freq(fx.table(spark, sf, "documents"), "doc_id", "text", words.withColumnRenamed("term", "word"))


@query
def tagged_terms(spark, sf):
    # tags as a tagger would deliver them, one per token; here by the token's length
    turns = fx.table(spark, sf, "conversations").select("conv_id", F.explode(F.split("text", r"\s+")).alias("token"))
    tagged = turns.withColumn("pos", F.when(F.length("token") % 3 == 0, "NNP").when(F.length("token") % 3 == 1, "NN").otherwise("VBD"))
    return we.term_freq_tagged(tagged, "conv_id", "token", "pos")


# --- gazetteer and approximate search --------------------------------------------


@query
def gazetteer_explode(spark, sf):
    return gz.explode_names(fx.gazetteer(spark, sf))


@query
def gazetteer_lookup(spark, sf):
    suppliers = fx.table(spark, sf, "supplier").withColumnRenamed("s_suppkey", "geonameid")
    return ex.lookup(suppliers, fx.table(spark, sf, "lineitem"), "l_suppkey")


@query
def gazetteer_bucketed(spark, sf):
    path = scratch_dir(spark, "bucketed")
    name = "g" + path.rsplit("-", 1)[-1]
    de.bucket_gazetteer(fx.gazetteer(spark, sf), name, 8, path)
    found = ex.lookup(spark.table(name), fx.table(spark, sf, "lineitem"), "l_partkey")
    return found.select("geonameid", "name", "population")


@query
def gazetteer_few_ids(spark, sf):
    """Places of the ten parts that are sold most, read by key."""
    path = scratch_dir(spark, "by-key")
    de.store_by_key(fx.gazetteer(spark, sf), path, "geonameid")
    sold = fx.table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"))
    ids = [r["l_partkey"] for r in sold.orderBy(F.desc("q"), "l_partkey").limit(10).collect()]
    return ex.lookup_few(spark.read.parquet(path), ids).select("geonameid", "name", "population")


@query
def gazetteer_file(spark, sf):
    path = scratch_dir(spark, "gazetteer")
    de.write_delimited(fx.gazetteer(spark, sf), path, "\t", header=False)
    return de.read_gazetteer(spark, path).select("geonameid", "name", "alternatenames", "latitude", "longitude", "population", "dem", F.col("modificationdate").cast("string").alias("modificationdate"))


def _geocode(spark, sf, errors):
    return gz.geocode(fx.gazetteer(spark, sf), fx.place_docs(spark, sf), errors, "doc_id", ["doc_id", "lang", "text"])


@query
def geocode_exact(spark, sf):
    return _geocode(spark, sf, 0)


@query
def geocode_fuzzy(spark, sf):
    return _geocode(spark, sf, 1)


@query
def geocode_two_edits(spark, sf):
    return _geocode(spark, sf, 2)


@query
def geocode_three_edits(spark, sf):
    return _geocode(spark, sf, 3)


@query
def geocode_listing(spark, sf):
    docs = fx.place_docs(spark, sf)
    return gz.geocode_report(_geocode(spark, sf, 0), docs, "doc_id", ["doc_id", "lang", "text"])


@query
def match_sentences(spark, sf):
    sources = se.source_sentences(fx.table(spark, sf, "benchmark"), "item_id", "text")
    hits = se.clean_candidates(fx.candidate_docs(spark, sf), "source_id", "doc_id", "text")
    return se.match_sentences(sources, hits)


@query
def match_folders(spark, sf):
    """Document folders on disk: the text lies between two marker tags, every candidate has a folder of its own."""
    path = scratch_dir(spark, "folders")
    html = F.concat(F.lit("<html>before <hr/> "), "text", F.lit(" <hr/> after</html>")).alias("html")
    fx.table(spark, sf, "benchmark").select(F.col("item_id").alias("source_id"), html).write.partitionBy("source_id").text(f"{path}/sources")
    do.write_hit_docs(fx.candidate_docs(spark, sf).withColumnRenamed("doc_id", "hit_id"), f"{path}/hits")
    # read several times: many small files are opened once
    with do.small_files(spark):
        hits = stored(do.read_hit_docs(spark, f"{path}/hits"), "hits")
    sources = se.source_sentences(do.with_candidates(do.read_source_docs(spark, f"{path}/sources"), hits), "source_id", "html", marker="<hr/>")
    found = se.match_sentences(sources, se.clean_candidates(hits, "source_id", "hit_id", "html"))
    return found.withColumns({c: F.col(c).cast("bigint") for c in ("source_id", "hit_id")})


@query
def sentence_split(spark, sf):
    return se.source_sentences(fx.table(spark, sf, "documents"), "doc_id", "text")


# --- money on the map ----------------------------------------------------------


def _located(spark, sf):
    locs = fx.locations(spark, sf)
    return sh.attach_share(locs, sh.location_share(locs, "amount"))


@query
def location_share(spark, sf):
    shares = sh.location_share(fx.locations(spark, sf), "amount")
    return shares.select("project_id", cents("amount").alias("amount_cents"), "count_locs", cents("financials_per_loc").alias("share_cents"))


@query
def attach_share(spark, sf):
    return _located(spark, sf).select("project_id", "precision_code", "longitude", "latitude", cents("financials_per_loc").alias("share_cents"))


@query
def location_points(spark, sf):
    """Different points of all locations, with their distance to the origin of the grid."""
    placed = fx.locations(spark, sf).filter(ex.not_null("longitude", "latitude")).select(ge.point(F.col("longitude"), F.col("latitude")).alias("p"))
    away = ge.haversine_m(F.lit(0.0), F.lit(0.0), F.col("p.lng"), F.col("p.lat")).alias("metres")
    return placed.distinct().select("p.lng", "p.lat", F.round(away, 2).alias("metres"))


@query
def points_within(spark, sf):
    points = fx.locations(spark, sf).select("project_id", "longitude", "latitude")
    return ar.within(points, fx.areas(spark, sf), "0")


@query
def sum_by_area(spark, sf):
    # one pass: a location's level goes with it
    levels = {"3": "2", "4": "1", "5 6 8": "0"}
    codes = F.when(ex.has_code("precision_code", "5 6 8"), "5 6 8").when(ex.has_code("precision_code", "3 4"), F.col("precision_code"))
    level = F.element_at(F.create_map(*[F.lit(v) for pair in levels.items() for v in pair]), F.col("codes"))
    located = _located(spark, sf).withColumn("codes", codes).filter("codes is not null and longitude is not null and latitude is not null")
    spots = located.groupBy("codes", "longitude", "latitude").agg(F.sum("financials_per_loc").cast(sh.MONEY).alias("financials"))
    found = ar.within(spots.withColumn("adm_level", level), fx.areas(spark, sf))
    return found.groupBy("codes", "gid").agg(F.sum("financials").cast(sh.MONEY).alias("financials")).select("codes", "gid", cents("financials").alias("cents"))


@query
def sum_by_area_level(spark, sf):
    sums = ar.sum_by_area(_located(spark, sf), "5 6 8", "0", fx.areas(spark, sf))
    return sums.select("gid", cents("financials").alias("cents"))


@query
def sum_by_cell(spark, sf):
    cells = gr.sum_by_cell(_located(spark, sf).filter(ex.has_code("precision_code", "1")).filter(ex.not_null("longitude", "latitude")), fx.GRID)
    return cells.select("col", "row", "lng", "lat", cents("financials").alias("cents"))


@query
def spread_over_cells(spark, sf):
    shapes = fx.areas(spark, sf)
    sums = ar.sum_by_area(_located(spark, sf), "5 6 8", "0", shapes)
    cells = gr.spread_over_cells(sums.join(shapes.select("gid", "geom"), "gid"), "financials", fx.GRID)
    return cells.select("gid", "col", "row", settled("value"))


def _spots(spark, sf):
    """Places of discs with their country: money, location rows, and those of them that have any."""
    located = _located(spark, sf).filter(ex.has_code("precision_code", "2"))
    spots = located.groupBy("longitude", "latitude").agg(
        F.sum("financials_per_loc").alias("financials"), F.count("*").alias("n_rows"), F.count_if(F.col("financials_per_loc") != 0).alias("n_discs")
    )
    return ar.within(spots, fx.areas(spark, sf), "0")


def _countries(spark, sf):
    return fx.areas(spark, sf).filter("adm_level = '0'")


@query
def spread_over_disc(spark, sf):
    cells = gr.spread_over_disc(_spots(spark, sf), ["longitude", "latitude"], "financials", fx.DISC_METRES, _countries(spark, sf), fx.GRID)
    return cells.select("longitude", "latitude", "gid", "col", "row", settled("value"))


def _disc_flags(spark, sf):
    """Spots, and the keys of those whose discs overlap: every location row has a disc of its own."""
    keys = ["longitude", "latitude", "gid"]
    spots = _spots(spark, sf)
    discs = settle(gr.disc_cells(spots, keys[:2], "n_discs", fx.DISC_METRES, _countries(spark, sf), fx.GRID))
    meeting = gr.overlapping(gr.shape_cells(discs, keys), keys)
    return spots, meeting.unionByName(discs.filter("n_discs > 1").select(*keys)).distinct(), keys


@query
def overlapping_discs(spark, sf):
    """Two discs at one spot overlap as well as two at neighbouring ones."""
    spots, meeting, keys = _disc_flags(spark, sf)
    marked = spots.join(meeting.withColumn("overlaps", F.lit(True)), keys, "left").withColumn("overlaps", F.coalesce("overlaps", F.lit(False)))
    row = lambda n, overlaps: F.array_repeat(overlaps, n.cast("int"))
    each = F.concat(row(F.col("n_discs"), F.col("overlaps")), row(F.col("n_rows") - F.col("n_discs"), F.lit(False)))
    return marked.select(*keys, F.explode(each).alias("overlaps"))


@query
def lone_discs(spark, sf):
    """Spots that share no cell with another disc, those without a disc included."""
    spots, meeting, keys = _disc_flags(spark, sf)
    return gr.not_overlapping(spots.select(*keys), meeting, keys)


@query
def points_on_borders(spark, sf):
    """Points on and near outlines of all levels: those on one are in none of its areas."""
    points, areas = fx.border_points(spark, sf), fx.areas(spark, sf)
    leveled = points.withColumn("adm_level", F.explode(F.array(*map(F.lit, "012"))))
    return ar.within(leveled, areas).select("point_id", "adm_level", "gid")


@query
def discs_across_date_line(spark, sf):
    """Discs near the date line go on at the other end of the grid."""
    areas = fx.date_line_areas(spark, sf)
    spots = fx.date_line_points(spark, sf).groupBy("longitude", "latitude").agg(F.sum("financials").alias("financials"))
    cells = gr.spread_over_disc(ar.within(spots, areas, "0"), ["longitude", "latitude"], "financials", fx.DISC_METRES, areas, fx.GRID)
    return cells.select("longitude", "latitude", "gid", "col", "row", settled("value"))


def _allocated(spark, sf):
    return allocate(fx.locations(spark, sf), "amount", fx.areas(spark, sf), fx.GRID, fx.DISC_METRES)


@query
def allocate_money(spark, sf):
    return _allocated(spark, sf).select("layer", "col", "row", settled("value"))


@query
def allocate_fine(spark, sf):
    """The working resolution; cells are added up to whole degrees to compare them."""
    cells = allocate(fx.locations(spark, sf), "amount", fx.areas(spark, sf), fx.FINE_GRID, fx.FINE_METRES)
    coarse = cells.groupBy("layer", F.floor(F.col("col") / 10).cast("int").alias("col"), F.floor(F.col("row") / 10).cast("int").alias("row"))
    return coarse.agg(F.count("*").alias("cells"), F.sum("value").alias("value")).select("layer", "col", "row", "cells", settled("value"))


@query
def total_layers(spark, sf):
    return gr.total_layers(_allocated(spark, sf)).select("col", "row", settled("value"))


@query
def export_grid(spark, sf):
    path = scratch_dir(spark, "grid")
    do.export_grid(_allocated(spark, sf).select("layer", "col", "row", settled("value")), path)
    return spark.read.parquet(path).select("layer", "col", "row", "value")


# --- extracts --------------------------------------------------------------------


@query
def project_extract(spark, sf):
    out = ex.project_extract(fx.project_tables(spark, sf))
    return out.withColumns({c: F.col(c).cast("string") for c in ("start_date", "end_date", "commitment_date", "effective_date")})


@query
def project_extract_filtered(spark, sf):
    out = ex.project_extract(fx.project_tables(spark, sf), purpose_prefix="R", before_year=1997)
    return out.select("project_id", "crs_purpose_code", "classified_purpose_code", "activity_codes", "commitment_current_usd")


@query
def activity_codes(spark, sf):
    items = fx.table(spark, sf, "lineitem").select("l_orderkey", F.col("l_shipdate").cast("date").cast("string").alias("day"))
    return ex.list_distinct(items, ["l_orderkey"], "day", "days")


@query
def sample_records(spark, sf):
    return ex.sample_records(fx.research_release(spark, sf), 100, length=(50, 2000), donor="world fund|none", sector="^(EN|fr)$", seed=7)


@query
def sample_large(spark, sf):
    """More records than one task should hold."""
    none = F.lit(None).cast("string")
    items = fx.table(spark, sf, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("record_id"), F.col("l_returnflag").alias("activity_code"), F.concat("l_returnflag", "l_linestatus").alias("title"), none.alias("short_description"), none.alias("long_description"))
    return ex.sample_records(items, 20000, seed=3).select("record_id", "activity_code", "length")


@query
def code_rule_records(spark, sf):
    release = fx.research_release(spark, sf).withColumn("length", ex.text_length("title", "short_description", "long_description"))
    kept = release.filter(ex.not_null("activity_code") & ex.any_not_null("title", "short_description"))
    return kept.filter(ex.length_between(F.col("length"), 100, 5000)).select("record_id", "donor", "sector", "length")


@query
def cross_references(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", F.expr(fx.CODED_TEXT).alias("text"), F.expr(fx.OWN_CODE).alias("own"))
    lines = do.lines_with_other_code(docs, "text", F.col("own"))
    return lines.select("doc_id", "line", F.array_join(tx.project_codes(F.col("line")), ",").alias("codes"))


@query
def distinct_difference(spark, sf):
    used = de.distinct_values(fx.table(spark, sf, "lineitem"), "l_orderkey").withColumnRenamed("l_orderkey", "o_orderkey")
    return de.difference(fx.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), used, ["o_orderkey"])


@query
def top_amount(spark, sf):
    orders = fx.table(spark, sf, "orders").withColumn("rank", F.struct("o_totalprice", "o_orderkey"))
    return de.first_by(orders, "o_orderkey", "rank")


# --- formats ---------------------------------------------------------------------


@query
def flatten_locations(spark, sf):
    path = scratch_dir(spark, "activities")
    fx.table(spark, sf, "orders").select(F.expr(fx.ACTIVITY_XML).alias("value")).write.text(path)
    return do.flatten_locations(do.read_activities(spark, path))


@query
def location_lines(spark, sf):
    activities = fx.table(spark, sf, "orders").select(F.expr(fx.ACTIVITY_XML).alias("xml"))
    return do.location_lines(do.flatten_locations(activities))


@query
def api_documents(spark, sf):
    answers = fx.table(spark, sf, "events").select("event_id", F.expr(fx.API_ANSWER).alias("json"))
    return do.explode_api_documents(answers, "json", "event_id")


@query
def read_utf16(spark, sf):
    path = scratch_dir(spark, "utf16")
    customers = fx.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.concat("c_name", F.lit(" é")).alias("name"), F.col("c_mktsegment").alias("segment"))
    customers.repartition(4, "id").write.csv(path, sep="|", header=True, encoding="UTF-16")
    return de.read_utf16_dump(spark, path)


@query
def read_utf16_by_splits(spark, sf):
    """Lines that end with CR LF: a file is read by several tasks."""
    path = scratch_dir(spark, "utf16")
    fields = F.concat_ws("|", F.col("o_orderkey").cast("string"), F.concat(F.lit('"'), "o_orderpriority", F.lit(" é")), F.when(F.col("o_custkey") % 3 != 0, F.col("o_orderstatus")).otherwise(""))
    rows = fx.table(spark, sf, "orders").select(F.floor(F.col("o_orderkey") / 20000).alias("part"), F.lit(1).alias("k"), fields.alias("value"))
    heads = rows.select("part").distinct().select("part", F.lit(0).alias("k"), F.lit("\ufeffid|priority|status").alias("value"))
    # a folder for every part, each line with the first byte of its end
    lines = rows.unionByName(heads).repartition("part").sortWithinPartitions("part", "k")
    written = lines.select("part", F.concat(F.encode(F.concat("value", F.lit("\r")), "UTF-16LE"), F.lit(b"\n")).cast("string").alias("value"))
    written.write.option("lineSep", "\0").partitionBy("part").text(path)
    return de.read_utf16_dump(spark, path)


@query
def read_uniform(spark, sf):
    path = scratch_dir(spark, "uniform")
    keys = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    de.write_delimited(keys, path, "|")
    name = de.write_table_replace(de.read_uniform(spark, path, "|", "bigint"), f"{path.replace('-', '_')}.dat.txt", f"{path}-table")
    return spark.table(name)


@query
def write_delimited(spark, sf):
    path = scratch_dir(spark, "pipes")
    docs = fx.table(spark, sf, "documents").select("doc_id", "lang", tx.squeeze(tx.scrub(F.col("text"), r"[|\n\r\t\"]+")).alias("text"))
    de.write_delimited(docs, path, "|")
    return de.read_uniform(spark, path, "|").select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "text")


@query
def split_by_key(spark, sf):
    path = scratch_dir(spark, "districts")
    customers = fx.table(spark, sf, "customer").select("c_custkey", "c_nationkey", F.floor(F.col("c_nationkey") / 5).cast("int").alias("c_level1"))
    de.split_by_keys(customers, ["c_level1", "c_nationkey"], path)
    levels = [spark.read.parquet(f"{path}/{key}").select(F.lit(key).alias("level"), "c_custkey", F.col(key).alias("code")) for key in ("c_level1", "c_nationkey")]
    return de.append(*levels)


@query
def column_at(spark, sf):
    return de.col_at(fx.table(spark, sf, "orders"), 4)


@query
def document_lines(spark, sf):
    lines = fx.table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", r"[.\n]")).alias("line"))
    return tx.drop_blank(lines, "line")


@query
def column_range(spark, sf):
    return de.cols(fx.table(spark, sf, "orders"), 1, 3)


@query
def download_manifest(spark, sf):
    path = f"{scratch_dir(spark, 'records')}/dec_2011.csv"
    filler = [F.lit('a, "quoted", field').alias(f"c{i}") for i in range(1, 35)]
    pages = fx.table(spark, sf, "pages").select(*filler, F.concat(F.lit('"PN-A'), F.col("page_id").cast("string"), F.lit('-B"')).alias("document"))
    de.write_delimited(pages, path, ",", quote='"')
    return de.download_manifest(de.read_quoted_csv(spark, path), "http://docs.example/pdf/")


@query
def jalaali_dates(spark, sf):
    orders = fx.table(spark, sf, "orders").select("o_orderkey", dt.date_to_jalaali(F.col("o_orderdate"), "dmy").alias("jalaali"))
    return orders.withColumn("gregorian", dt.jalaali_to_date(F.col("jalaali"), "dmy").cast("string"))


@query
def latest_release(spark, sf):
    pages = fx.table(spark, sf, "pages").select(F.expr(fx.DATED_PAGE).alias("page"))
    files = fx.table(spark, sf, "documents").select(F.expr(fx.RELEASE_PATH).alias("path"))
    return ch.is_newer(pages, "page", files, "path")


@query
def release_batches(spark, sf):
    """The release check on arriving pages, a few files to a batch; the answers say what each batch had."""
    path = scratch_dir(spark, "releases")
    pages = fx.table(spark, sf, "pages").select(F.expr(fx.DATED_PAGE).alias("page"))
    pages.repartition(4).write.parquet(f"{path}/landing")
    files = fx.table(spark, sf, "documents").select(F.expr(fx.RELEASE_PATH).alias("path"))
    arriving = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 2).parquet(f"{path}/landing")
    ch.check_each_batch(arriving, "page", files, "path", lambda df: df.write.mode("append").parquet(f"{path}/answers"), f"{path}/checkpoint").awaitTermination()
    answers = spark.read.parquet(f"{path}/answers")
    return answers.agg(F.max("remote_latest").alias("remote_latest"), F.max("local_latest").alias("local_latest"), F.max("newer").alias("newer"))


@query
def ingest_changes(spark, sf):
    landing, target = scratch_dir(spark, "landing"), scratch_dir(spark, "changes")
    events = fx.table(spark, sf, "events").select("event_id", "event_type", "user_id")
    deleted = F.col("event_type") == "error"
    de.write_delimited(events.filter(deleted), f"{landing}/deletes-2024-02-01.txt", "\t", header=False)
    de.write_delimited(events.filter(~deleted), f"{landing}/modifications-2024-02-01.txt", "\t", header=False)
    ch.ingest_change_files(spark, landing, "event_id bigint, event_type string, user_id bigint", target)
    return ch.read_changes(spark, target).select("kind", "event_id", "event_type", "user_id")
