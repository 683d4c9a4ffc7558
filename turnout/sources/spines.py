"""Generated sequences: the day calendar and calendar-page URLs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import swedish_month


def calendar(spark: SparkSession, start: dt.date, end_exclusive: dt.date) -> DataFrame:
    """One row per day in [start, end_exclusive), column ``date_day``.

    Built from ``spark.range`` so the days are generated in parallel.
    """
    n = (end_exclusive - start).days
    base = F.lit(start)
    return spark.range(0, max(n, 0)).select(F.date_add(base, F.col("id").cast("int")).alias("date_day"))


def default_calendar(spark: SparkSession, spine_start: dt.date, as_of: dt.date) -> DataFrame:
    """The model calendar: spine start up to one year after the as-of day (exclusive)."""
    try:
        end = as_of.replace(year=as_of.year + 1)
    except ValueError:  # 29 February
        end = as_of.replace(year=as_of.year + 1, day=28)
    return calendar(spark, spine_start, end)


def month_urls(starts: DataFrame, as_of: dt.date, domain: str) -> DataFrame:
    """Calendar page URLs per team: one per month from each team's start day
    up to ``as_of`` (inclusive), stepping one month from the start day.

    ``starts`` has ``team_slug`` and ``start_date``.  Output: team_slug,
    month_start (the stepped day), year, month_name, url.
    """
    seq = F.sequence(F.col("start_date"), F.lit(as_of), F.expr("interval 1 month"))
    months = (starts.where(F.col("start_date") <= F.lit(as_of))
              .select("team_slug", F.explode(seq).alias("month_start")))
    path = F.concat(F.lit("kalender/"), F.year("month_start").cast("string"), F.lit("/"), swedish_month("month_start"))
    return months.select(
        "team_slug", "month_start",
        F.year("month_start").cast("bigint").alias("year"),
        swedish_month("month_start").alias("month_name"),
        F.concat(F.lit(f"https://{domain}/"), F.col("team_slug"), F.lit("/"), path).alias("url"),
    )


__all__ = ["calendar", "default_calendar", "month_urls"]
