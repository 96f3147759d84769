"""Document folders, nested records, word lists, grids on disk."""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial, reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almoner.functions.text import join_fields, let

# functions that run inside tasks travel with them: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What opening a file counts as, in bytes, where files of a few KB are read: some thousand to a task.
SMALL_FILE = 1 << 16


def read_source_docs(spark: SparkSession, path: str) -> DataFrame:
    """``source_id, html`` from ``<path>/<source>/<source>.html``; folders not named by digits are ignored.

    Folders ``source_id=<source>``, as Spark writes them, are read as well, whatever their files are called.
    """
    return _numbered(spark, path, r"(?:/([0-9]+)/\1\.html|/source_id=([0-9]+)/[^/]+)$", 2).select(F.col("id")[0].alias("source_id"), "html")


def read_hit_docs(spark: SparkSession, path: str) -> DataFrame:
    """``source_id, hit_id, html`` from ``<path>/<source>/<hit>/<file>``, or folders ``source_id=…/hit_id=…``.

    Several files of one hit are one document, in order of their names.
    """
    docs = _numbered(spark, path, r"/(?:source_id=)?([0-9]+)/(?:hit_id=)?([0-9]+)/[^/]+$", 2)
    parts = docs.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("file", "html"))).alias("parts"))
    html = F.array_join(F.transform("parts", lambda p: p["html"]), "\n").alias("html")
    return parts.select(F.col("id")[0].alias("source_id"), F.col("id")[1].alias("hit_id"), html)


def write_hit_docs(docs: DataFrame, path: str) -> None:
    """``source_id, hit_id, text`` (numbers and text) as folders ``source_id=…/hit_id=…`` with one text file each, a line feed behind every text.

    In a folder that all machines mount, tasks write the files themselves: there Spark's writer starts processes for the rights of every
    file and its driver moves every folder. All of a folder is written by one task, in one order, and put in place at once, so a repeated task
    writes the same. Elsewhere Spark's writer is used.
    """
    spark = docs.sparkSession
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    keys = ["source_id", "hit_id"]
    docs = docs.select(*keys, "text")
    if files.getScheme() != "file":
        docs.write.partitionBy(*keys).text(path)
        return
    top = files.makeQualified(root).toUri().getPath()
    os.makedirs(top)
    dealt = docs.repartition(*keys).sortWithinPartitions(*keys, "text")
    dealt.mapInArrow(partial(_in_folders, top=top), "n long").write.format("noop").mode("overwrite").save()


def _in_folders(batches: Iterator[pa.RecordBatch], top: str) -> Iterator[pa.RecordBatch]:
    """Writes a file for each run of rows that agree in their keys."""
    last, texts, count = None, [], 0

    def put() -> None:
        folder = os.path.join(top, *(f"{n}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for n, v in zip(("source_id", "hit_id"), last, strict=True)))
        os.makedirs(folder, exist_ok=True)
        # names that begin with a point are not read
        with open(part := f"{folder}/.{uuid.uuid4().hex}", "wb") as f:
            f.write("".join([f"{t or ''}\n" for t in texts]).encode())
        os.replace(part, f"{folder}/part-00000.txt")

    for b in batches:
        for source, hit, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if texts and (source, hit) != last:
                put()
                texts, count = [], count + 1
            last = (source, hit)
            texts.append(text)
    if texts:
        put()
        count += 1
    yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], ["n"])


@contextmanager
def small_files(spark: SparkSession) -> Iterator[None]:
    """While files of a few KB are read: a task opens many of them."""
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(SMALL_FILE))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _numbered(spark: SparkSession, path: str, pattern: str, groups: int) -> DataFrame:
    """``id`` (the groups of ``pattern`` that are not empty), ``file, html`` of the files whose path below ``path`` fits.

    Folders are listed from the top, by tasks where there are many; a pattern of folders would be expanded file by file on the driver.
    """
    read = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    depth = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).depth()
    below = rf"^[^:/]+:(?://[^/]*)?(?:/[^/]*){{{depth}}}{pattern}"
    found = F.array(*[F.regexp_extract("_metadata.file_path", below, k + 1) for k in range(groups)])
    named = read.select(F.filter(found, lambda g: g != "").alias("id"), F.col("_metadata.file_path").alias("file"), F.col("value").alias("html"))
    return named.filter(F.size("id") > 0)


def with_candidates(sources: DataFrame, hits: DataFrame) -> DataFrame:
    """Sources that have at least one candidate."""
    return sources.join(hits, "source_id", "left_semi")


# The elements of an activity that are read, in output order.
ACTIVITY = (
    "title array<string>, description array<string>, `iati-identifier` array<string>, `other-identifier` array<string>,"
    " `participating-org` array<string>, `recipient-country` array<string>, sector array<string>,"
    " transaction array<struct<value:array<string>,`flow-type`:array<string>,`transaction-date`:array<string>,"
    "`transaction-type`:array<string>>>,"
    " location array<struct<coordinates:array<struct<_latitude:string,_longitude:string,_precision:string>>>>"
)
FIELDS = ["title", "description", "iati-identifier", "other-identifier", "participating-org", "recipient-country", "sector"]
TRANSACTION_FIELDS = ["value", "flow-type", "transaction-date", "transaction-type"]


_CLOSING = "</iati-activity>"
# What begins and ends text in which tags are no tags.
_COMMENT, _LITERAL = ("<!--", "-->"), ("<![CDATA[", "]]>")


def plain_xml(text: Column) -> Column:
    """XML without comments, and with literal sections as escaped text."""
    after = lambda t, mark: F.substring(t, F.length(F.substring_index(t, mark, 1)) + len(mark) + 1, F.length(t))

    def escaped(t: Column) -> Column:
        for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            t = F.replace(t, F.lit(raw), F.lit(entity))
        return t

    def step(state: Column, chunk: Column) -> Column:
        inside = F.when(state["inside"] != "", state["inside"]).when(F.startswith(chunk, F.lit(_COMMENT[0])), "comment").when(F.startswith(chunk, F.lit(_LITERAL[0])), "literal").otherwise("")
        # a section's own opening is no part of it
        own = F.when((state["inside"] == "") & (inside == "literal"), F.substring(chunk, F.lit(len(_LITERAL[0]) + 1), F.length(chunk))).otherwise(chunk)

        def told(x: Column) -> Column:
            kind, t = x["inside"], x["own"]
            ends = F.when(kind == "comment", F.contains(t, F.lit(_COMMENT[1]))).when(kind == "literal", F.contains(t, F.lit(_LITERAL[1]))).otherwise(F.lit(True))
            said = (
                F.when(kind == "", t)
                .when(kind == "comment", F.when(ends, after(t, _COMMENT[1])).otherwise(""))
                .otherwise(F.when(ends, F.concat(escaped(F.substring_index(t, _LITERAL[1], 1)), after(t, _LITERAL[1]))).otherwise(escaped(t)))
            )
            return F.struct(F.when(ends, "").otherwise(kind).alias("inside"), F.concat(state["out"], F.array(said)).alias("out"))

        return let(F.struct(inside.alias("inside"), own.alias("own")), told)

    start = F.struct(F.lit("").alias("inside"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(F.split(text, r"(?=<!--|<!\[CDATA\[)"), start, step, lambda state: F.array_join(state["out"], ""))


def read_activities(spark: SparkSession, path: str, sections: bool = True) -> DataFrame:
    """``xml``: one row per activity element.

    Files are cut at the closing tag, so one very large file is still read by
    many tasks. A closing tag within a comment or a literal (CDATA) section
    ends nothing: a first pass finds the files in which a cut lies within one
    (their names go to the driver), and one task each reads those as a whole.
    ``sections=False`` says that there are none and spares that pass.
    """
    raw = spark.read.text(path, lineSep=_CLOSING, recursiveFileLookup=True)
    pieces, whole = raw.select("value"), []
    if sections:
        some = F.contains("value", F.lit(_COMMENT[0])) | F.contains("value", F.lit(_LITERAL[0]))
        left = F.regexp_replace("value", r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>", "")
        broken = raw.select("value", F.col("_metadata.file_path").alias("file")).filter(some).filter(left.rlike(r"<!--|<!\[CDATA\["))
        files = sorted(r["file"] for r in broken.select("file").distinct().collect())
        if files:
            pieces = raw.filter(~F.col("_metadata.file_path").isin(files)).select("value")
            texts = spark.read.text(files, wholetext=True)
            whole = [texts.select(F.explode(F.split(plain_xml(F.col("value")), _CLOSING)).alias("value"))]
        pieces = pieces.select(F.when(some, plain_xml(F.col("value"))).otherwise(F.col("value")).alias("value"))
    body = F.regexp_extract("value", r"(?s)<iati-activity[\s>].*", 0)
    bodies = reduce(DataFrame.unionByName, [pieces, *whole]).select(body.alias("body")).filter("body != ''")
    return bodies.select(F.concat("body", F.lit(_CLOSING)).alias("xml"))


def flatten_locations(activities: DataFrame) -> DataFrame:
    """One row per coordinates element, fourteen columns.

    Repeated elements give their first occurrence, and a transaction field the
    first found in any transaction; missing ones are empty text.
    """
    record = activities.select(F.from_xml("xml", ACTIVITY, {"rowTag": "iati-activity", "ignoreNamespace": "true"}).alias("r")).select("r.*")
    flat = lambda c: F.flatten(F.coalesce(c, F.array().cast("array<array<string>>")))
    first = lambda c: F.coalesce(F.get(c, F.lit(0)), F.lit(""))
    own = [first(F.col(f"`{f}`")).alias(f.replace("-", "_")) for f in FIELDS]

    def of_transaction(field: str) -> Column:
        values = F.transform("transaction", lambda t: F.coalesce(t[field], F.array().cast("array<string>")))
        return first(flat(values)).alias(f"transaction_{field}".replace("transaction_transaction-", "transaction_").replace("-", "_"))

    places = F.flatten(F.transform("location", lambda l: F.coalesce(l["coordinates"], F.array().cast("array<struct<_latitude:string,_longitude:string,_precision:string>>"))))
    rows = record.select(*own, *[of_transaction(f) for f in TRANSACTION_FIELDS], F.explode(places).alias("c"))
    at = lambda a: F.coalesce(F.col(f"c._{a}"), F.lit("")).alias(a)
    return rows.select(*rows.columns[:-1], at("latitude"), at("longitude"), at("precision"))


def location_lines(locations: DataFrame) -> DataFrame:
    """The same as one pipe-joined line per location."""
    return locations.select(join_fields([F.col(c) for c in locations.columns]).alias("line"))


def explode_api_documents(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """``txturl`` of every document in a landed API answer that has one."""
    parsed = F.from_json(F.col(column), "documents map<string,struct<txturl:string>>")
    values = df.select(*keep, F.explode(F.map_values(parsed["documents"])).alias("d"))
    return values.filter("d.txturl is not null").select(*keep, "d.txturl")


def lines_with_other_code(docs: DataFrame, text: str, own_id: str | Column, pattern: str = r"P[0-9]{6}") -> DataFrame:
    """``line`` of each document line that names a code and does not name its own.

    The line is the unit: one that names the own code as a word is left out
    even if it names others. ``own_id`` may be a column; an id that is no code
    is looked for as it is, letter by letter.
    """
    own = own_id if isinstance(own_id, Column) else F.lit(own_id)
    lines = docs.withColumn("line", F.explode(F.split(text, "\n")))
    codes = F.regexp_extract_all("line", F.lit(rf"\b({pattern})\b"), F.lit(1))
    literal = F.concat(F.lit(r"\b\Q"), F.replace(own, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E\b"))
    named = F.when(own.rlike(rf"^(?:{pattern})$"), F.array_contains(codes, own)).otherwise(F.regexp_like("line", literal))
    return lines.filter(F.regexp_like("line", F.lit(pattern)) & ~named)


def load_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """``word, lang`` from word lists, one word per line.

    The language is what follows the first underscore of the file name
    (``stopwords_fr.txt`` gives ``fr``), or of a folder of that name with parts.
    """
    name = F.regexp_extract("_metadata.file_path", r"([^/]+?)(?:/part-[^/]*)?$", 1)
    read = spark.read.text(path).select(F.col("value").alias("word"), F.regexp_extract(name, r"_([^.]+)\.", 1).alias("lang"))
    return read.filter("word != ''").distinct()


def default_stopwords(spark: SparkSession, *languages: str) -> DataFrame:
    """The lists that come with Spark, e.g. ``english``, ``french``; a few hundred words each."""
    from pyspark.ml.feature import StopWordsRemover

    rows = [(w, lang) for lang in languages for w in StopWordsRemover.loadDefaultStopWords(lang)]
    return spark.createDataFrame(rows, "word string, lang string")


def export_grid(cells: DataFrame, path: str) -> None:
    """Grid cells as one folder per layer; large layers are written by several tasks."""
    cells.hint("rebalance", F.col("layer")).write.mode("overwrite").partitionBy("layer").parquet(path)
