"""Delimited text, in and out."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A character that occurs in no text: switches quoting off while NULs stay ordinary data.
NO_QUOTE = "￿"

# The nineteen gazetteer columns, tab separated and without a header.
GAZETTEER = (
    "geonameid bigint, name string, asciiname string, alternatenames string, latitude double, longitude double,"
    " featureclass string, featurecode string, countrycode string, cc2 string, admin1code string, admin2code string,"
    " admin3code string, admin4code string, population bigint, elevation string, dem int, timezone string,"
    " modificationdate date"
)


# How a dump of low byte first begins, and the bytes that end its lines.
_LOW_FIRST, _LINE_END = b"\xff\xfe", "\r\0\n\0"


def _lines_by_bytes(spark: SparkSession, path: str) -> bool:
    """Whether a dump has the low byte first and lines that end with CR LF."""
    first = spark.read.text(path, lineSep="\n", recursiveFileLookup=True).select(F.col("value").cast("binary").alias("b")).first()
    head = bytes(first["b"]) if first else b""
    return head.startswith(_LOW_FIRST) and head.endswith(_LINE_END[:2].encode())


def read_utf16_dump(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    """All files of a folder, UTF-16 with one header each, as one table of text columns.

    Byte order marks and header lines go, NULs are removed, empty fields are
    null; quotes are text. With the low byte first, as dumps commonly have it,
    CR LF at the end of lines is found by its bytes, so a file is read by as
    many tasks as it has splits: those four bytes across units would need the
    unit 0A00, which no valid text has. Files of one folder have one byte order.
    Where lines end otherwise, with the high byte first or without a mark, one
    task reads one file. Only then do broken units become U+FFFD; else they are an error.
    """
    whole = spark.read.csv(
        path, sep=sep, header=True, encoding="UTF-16", multiLine=True, recursiveFileLookup=True,
        quote=NO_QUOTE, escape=NO_QUOTE,
    )
    names = [c.replace("\0", "").lstrip("\ufeff") for c in whole.columns]
    if not _lines_by_bytes(spark, path):
        return whole.select([F.translate(F.col(f"`{c}`"), "\0", "").alias(n) for c, n in zip(whole.columns, names, strict=True)])
    raw = spark.read.text(path, lineSep=_LINE_END, recursiveFileLookup=True).select(F.col("value").cast("binary").alias("b"))
    data = raw.filter(F.substring("b", 1, 2) != F.lit(_LOW_FIRST)).select(F.explode(F.split(F.translate(F.decode("b", "UTF-16LE"), "\0", ""), "\n")).alias("line")).filter("line != ''")
    fields = F.split("line", F.lit(re.escape(sep)), -1)
    return data.select(fields.alias("f")).select([F.nullif(F.get("f", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)])


def read_uniform(spark: SparkSession, path: str, sep: str, dtype: str = "string") -> DataFrame:
    """A table whose columns all have one type; quotes in the header are not part of the names."""
    raw = spark.read.csv(path, sep=sep, header=True, quote=NO_QUOTE, escape=NO_QUOTE, inferSchema=False)
    return raw.select([F.col(f"`{c}`").try_cast(dtype).alias(c.replace('"', "")) for c in raw.columns])


def table_name(path: str) -> str:
    """File name up to its first dot."""
    return path.rstrip("/").rsplit("/", 1)[-1].split(".", 1)[0]


def write_table_replace(df: DataFrame, source_path: str, location: str | None = None) -> str:
    """Replace the table named after a file; returns the table's name."""
    name = table_name(source_path)
    writer = df.write.mode("overwrite")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(f"`{name}`")
    return name


def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(GAZETTEER).csv(path, sep="\t", quote=NO_QUOTE, escape=NO_QUOTE, header=False)


def bucket_gazetteer(gaz: DataFrame, table: str, buckets: int, location: str | None = None) -> None:
    """Store a gazetteer for repeated access by id.

    Later joins on it need no shuffle of this side, if it has as many buckets as joins have partitions.
    """
    writer = gaz.write.mode("overwrite").bucketBy(buckets, "geonameid").sortBy("geonameid")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table)


def store_by_key(df: DataFrame, path: str, key: str, group_bytes: int = 8 << 20) -> None:
    """Write Parquet for quick access by key: sorted, in row groups of ``group_bytes``, with statistics and a bloom filter.

    Few row groups, and few pages of them, hold any given key; what reads a few keys skips the others.
    """
    ordered = df.repartitionByRange(key).sortWithinPartitions(key)
    ordered.write.option("parquet.block.size", group_bytes).option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(path)


def write_delimited(df: DataFrame, path: str, sep: str, header: bool = True, quote: str | None = None) -> None:
    """Delimited text. Without ``quote`` fields are written as they are, so scrub the separator first."""
    df.write.mode("overwrite").csv(
        path, sep=sep, header=header, quote=quote or "", escape=quote or "\\", emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def split_by_key(df: DataFrame, key: str, path: str) -> None:
    """One folder per distinct code (digits only), written in one pass.

    Rebalancing gathers the rows of small codes and splits large ones, so a
    dominant code is written by several tasks.
    """
    coded = df.filter(F.col(key).cast("string").rlike("^[0-9]+$"))
    coded.hint("rebalance", F.col(key)).write.mode("overwrite").partitionBy(key).parquet(path)


def split_by_keys(df: DataFrame, keys: list[str], path: str) -> None:
    """The same for several levels of codes, each below its own folder."""
    for key in keys:
        split_by_key(df, key, f"{path.rstrip('/')}/{key}")


def cols(df: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Columns ``start .. end``, counted from 1; all columns unless both are given."""
    if start is None or end is None:
        return df
    return df.select([F.col(f"`{c}`") for c in df.columns[start - 1 : end]])


def col_at(df: DataFrame, i: int) -> DataFrame:
    """One column by its number, counted from 1."""
    return df.select(F.col(f"`{df.columns[i - 1]}`"))


def download_manifest(df: DataFrame, base: str, path: str | None = None, position: int = 35) -> DataFrame:
    """``year, url``: one address per record, the id without quotes and hyphens.

    The year is the first number in the file name, taken from the file each
    record was read from unless ``path`` is given.
    """
    ident = F.col(f"`{df.columns[position - 1]}`")
    origin = F.lit(path) if path else F.col("_metadata.file_path")
    name = F.regexp_extract(origin, r"([^/]*[.]csv)", 1)
    year = F.regexp_extract(name, "[0-9]+", 0)
    return df.select(year.alias("year"), F.concat(F.lit(base), F.regexp_replace(ident, '["-]', ""), F.lit(".pdf")).alias("url"))


def read_quoted_csv(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated text whose quoted fields may hold commas and line ends."""
    return spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True)


def append(*tables: DataFrame) -> DataFrame:
    """All rows of tables with the same columns."""
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``a`` whose key is not in ``b``."""
    return a.join(b.select(*keys).distinct(), keys, "left_anti")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def first_by(df: DataFrame, value: str, order: str) -> DataFrame:
    """One row: the value at the largest ``order``."""
    return df.agg(F.max_by(value, order).alias(value))


