"""Training participation of players over rolling 4, 12 and 24 week windows."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions import local_day, safe_pct

TRAINING_TYPE_ID = 1          # fixed value: activity type "Training"
WINDOWS_WEEKS = (4, 12, 24)   # fixed values: look-back windows


def training_activities(activity: DataFrame, cfg: Config) -> DataFrame:
    """Trainings that started before ``now`` and on a day of the longest
    look-back window: (activity_id, activity_date).  Older ones count in no
    window; the bound is an instant, so it reaches the scan."""
    first = cfg.as_of - dt.timedelta(weeks=max(WINDOWS_WEEKS))
    since = dt.datetime(first.year, first.month, first.day, tzinfo=ZoneInfo(cfg.day_zone))
    return (activity.where((F.col("activity_type_id") == TRAINING_TYPE_ID)
                           & (F.col("start_at") >= F.lit(since)) & (F.col("start_at") < F.lit(cfg.now_instant)))
                    .select("activity_id", local_day("start_at", cfg.day_zone).alias("activity_date")))


def _window_counts(prefix: str, as_of: dt.date):
    return [F.count_if(F.col("activity_date") >= F.lit(as_of - dt.timedelta(weeks=w))).alias(f"{prefix}_{w}w")
            for w in WINDOWS_WEEKS]


def available_trainings(activity: DataFrame, cfg: Config) -> DataFrame:
    """One row: trainings held in each look-back window (lower bound inclusive)."""
    return training_activities(activity, cfg).agg(*_window_counts("available", cfg.as_of))


def attended_trainings(attended: DataFrame, activity: DataFrame, cfg: Config) -> DataFrame:
    tr = training_activities(activity, cfg)
    return (attended.select("activity_id", "member_id").join(tr, "activity_id", "inner")
                    .groupBy("member_id").agg(*_window_counts("trainings", cfg.as_of)))


def training_participation(attended: DataFrame, member: DataFrame, activity: DataFrame, cfg: Config) -> DataFrame:
    players = member.where(F.col("member_type") == "Player").select("member_id", "full_name", "member_type")
    # the totals are one row: a struct-valued scalar subquery, computed once and
    # used as a constant in the projection (no join)
    av = available_trainings(activity, cfg)
    totals = av.select(F.struct(*av.columns).alias("t")).scalar()
    j = (players.join(attended_trainings(attended, activity, cfg), "member_id", "left")
                .withColumn("_totals", totals))          # referenced once: one subquery
    cols = ["member_id", "full_name", "member_type"]
    for w in WINDOWS_WEEKS:
        n = F.coalesce(F.col(f"trainings_{w}w"), F.lit(0)).cast("bigint")
        cols += [n.alias(f"trainings_{w}w"), safe_pct(n, F.col(f"_totals.available_{w}w")).alias(f"rate_{w}w")]
    return j.select(*cols)
