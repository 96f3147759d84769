"""Leading-digit frequency against the logarithmic law."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almoner.functions.numbers import first_digit, share_and_ratio

# Expected percentage of the leading digits 1 to 9.
EXPECTED = ["30.1", "17.6", "12.5", "9.7", "7.9", "6.7", "5.8", "5.1", "4.6"]


def digit_counts(df: DataFrame, column: str, keep_blank: bool = False) -> DataFrame:
    """Rows per leading symbol. Amounts without one (zero, blank) vanish."""
    counts = df.select(first_digit(F.col(column)).alias("leading_digit")).groupBy("leading_digit").agg(F.count("*").alias("n"))
    kept = F.col("leading_digit").isNotNull()
    if not keep_blank:
        kept &= F.col("leading_digit").rlike(r"\S")
    return counts.filter(kept)


def by_count() -> list[Column]:
    """Most frequent first; equal counts in descending order of the symbol."""
    return [F.col("n").desc(), F.col("leading_digit").desc()]


def benford(df: DataFrame, column: str, order: str = "digit", expect_by: str = "rank") -> DataFrame:
    """``leading_digit, percent_frequency, ratio_to_benfords``.

    ``expect_by="rank"`` compares the i-th most frequent symbol with the i-th
    expected value; beyond nine symbols the ratio is 0. ``expect_by="digit"``
    compares each digit with its own expectation and leaves other symbols out.
    ``order="frequency"`` is the form without header cleaning: blanks count.

    The windows below run on the counts, one row per distinct symbol.
    """
    counts = digit_counts(df, column, keep_blank=order == "frequency")
    if expect_by == "digit":
        counts = counts.filter(F.col("leading_digit").rlike("^[1-9]$"))
        place = F.col("leading_digit").cast("int")
    else:
        place = F.row_number().over(Window.orderBy(*by_count()))
    expected = F.get(F.array(*[F.lit(e).cast("decimal(4,1)") for e in EXPECTED]), place - 1)
    counted = counts.withColumn("expected", expected).withColumn("total", F.sum("n").over(Window.partitionBy()))
    percent, ratio = share_and_ratio(F.col("n"), F.col("total"), F.col("expected"))
    out = counted.select("leading_digit", percent.alias("percent_frequency"), F.coalesce(ratio, F.lit(0.0)).alias("ratio_to_benfords"), "n")
    symbol = F.col("leading_digit").try_cast("int")
    ordering = [symbol.asc_nulls_first(), "leading_digit"] if order == "digit" else by_count()
    return out.orderBy(*ordering).drop("n")
