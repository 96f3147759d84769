"""Files that arrive: gazetteer changes, new releases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almoner.functions.dates import date_in_path, dmy_to_date, page_dates

KINDS = ("deletes", "modifications")


def ingest_change_files(spark: SparkSession, folder: str, schema: str, target: str, sep: str = "\t") -> None:
    """Append every change file not seen before to ``target``, by kind and retrieval date.

    Runs until the files present are processed, then stops; the checkpoint in
    ``target`` remembers them for the next run.
    """
    pattern = f"{folder.rstrip('/')}/{{{','.join(k + '*' for k in KINDS)}}}"
    arriving = spark.readStream.schema(schema).csv(pattern, sep=sep, quote="￿", escape="￿")
    kind = F.regexp_extract("_metadata.file_path", rf"/({'|'.join(KINDS)})[^/]*(?:/[^/]*)?$", 1)
    labelled = arriving.withColumn("kind", kind).withColumn("retrieved", F.current_date())
    query = (
        labelled.writeStream.format("parquet")
        .partitionBy("kind", "retrieved")
        .option("path", f"{target}/data")
        .option("checkpointLocation", f"{target}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_changes(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/data")


def is_newer(pages: DataFrame, page_text: str, files: DataFrame, path: str) -> DataFrame:
    """One row ``remote_latest, local_latest, newer``.

    Remote is the latest ``dd/mm/yyyy`` in the pages; local the ISO date in
    the path that sorts last among release files.
    """
    dates = pages.select(F.explode(page_dates(F.col(page_text))).alias("d")).select(dmy_to_date(F.col("d")).alias("d"))
    releases = files.filter(F.col(path).rlike(r"(?i)^.*crs.*[.]txt$"))
    local = releases.agg(date_in_path(F.max(path)).alias("d"))
    return dates.agg(F.date_format(F.max("d"), "yyyy-MM-dd").alias("remote_latest")).select(
        "remote_latest", local.scalar().alias("local_latest")
    ).withColumn("newer", F.col("remote_latest") > F.coalesce("local_latest", F.lit("")))


def check_each_batch(stream: DataFrame, page_text: str, files: DataFrame, path: str, sink, checkpoint: str):
    """The same test on every batch of arriving pages; ``sink`` gets the one-row answer."""
    return (
        stream.writeStream.foreachBatch(lambda pages, _: sink(is_newer(pages, page_text, files, path)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
