"""Money per location of a project."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.operators.extracts import not_null
from almoner.operators.skew import keyed_join

MONEY = "decimal(38,2)"


def share(amount: Column, count: Column) -> Column:
    """``round(amount / count, 2)``, exact, half away from zero."""
    return F.round(amount.cast("decimal(22,4)") / count.cast("decimal(16,0)"), 2).cast(MONEY)


def location_share(locs: DataFrame, amount: str, project: str = "project_id") -> DataFrame:
    """``project, amount, count_locs, financials_per_loc``.

    Only rows with both coordinates count. Each distinct amount of a project,
    null included, is a group of its own.
    """
    located = locs.filter(not_null("longitude", "latitude"))
    counted = located.groupBy(project, amount).agg(F.count("*").alias("count_locs"))
    return counted.withColumn("financials_per_loc", share(F.col(amount), F.col("count_locs")))


def attach_share(locs: DataFrame, shares: DataFrame, project: str = "project_id") -> DataFrame:
    """Every location with every share of its project.

    A project with k distinct amounts gives k rows per location; locations
    without coordinates stay.
    """
    per_loc = shares.select(project, "financials_per_loc")
    return keyed_join(locs, per_loc, [project])


def project_total_share(shares: DataFrame, project: str = "project_id") -> DataFrame:
    """All shares of a project added up: what one of its locations receives in total."""
    return shares.groupBy(project).agg(F.sum("financials_per_loc").cast(MONEY).alias("financials_per_loc"))
