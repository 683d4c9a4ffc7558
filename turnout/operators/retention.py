"""Daily member retention series of a birth-year cohort of players.

For every cohort player, one row per day from the first activity (or the
calendar spine start, whichever is later) up to the day before ``as_of``,
with days since the last activity, an Active/Churned status and New/Churn
events.

The series is generated from the member's activity days alone: the days
from one activity day up to the next are a run whose "days since last
activity" is simply the distance to the run's first day.  So instead of
joining a members x calendar grid back to the activity counts and searching
each day's last activity, one window pass over the (few) activity days per
member yields run boundaries, and one narrow ``explode(sequence(...))``
writes the runs out.  No grid, range join or self join is planned: the
attendance is combined to (member, day) with partial aggregation, clustered
by member once (the cohort semi join), and the window and the series
generation reuse that clustering.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions import local_day

CHURN_DAYS = 91          # fixed value: 91 days without activity is a churn
ACTIVE_MAX_DAYS = 90     # fixed value: active while the last activity is <= 90 days ago


def daily_activity_counts(attended: DataFrame, member: DataFrame, activity: DataFrame, cfg: Config) -> DataFrame:
    """(member_id, date_day, activities) for cohort players.

    Attendance is restricted to the cohort first (a semi join; AQE splits a
    member with a huge history), so that only the cohort's rows meet the
    activities; counts are combined map-side before they are shuffled.
    """
    cohort = member.where((F.col("member_type") == "Player") & F.col(cfg.cohort_flag)).select("member_id")
    rows = (attended.select("activity_id", "member_id").join(cohort, "member_id", "left_semi")
            .join(activity.select("activity_id", "start_at"), "activity_id", "left"))
    return (rows.groupBy("member_id", local_day("start_at", cfg.day_zone).alias("date_day"))
                .agg(F.count(F.lit(1)).alias("activities")))


def _runs(daily: DataFrame, spine_start: dt.date, as_of: dt.date) -> DataFrame:
    """Runs of days per member: (member_id, run_start, run_end (exclusive),
    last_activity_at, activities, prev_activity_at, series_start)."""
    s0, end = F.lit(spine_start), F.lit(as_of)
    d = daily.where(F.col("date_day").isNotNull())
    w = Window.partitionBy("member_id").orderBy("date_day")
    w_all = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = d.select(
        "member_id", "date_day", "activities",
        F.min("date_day").over(w_all).alias("first_activity"),
        F.lead("date_day").over(w).alias("next_day"),
        F.lag("date_day").over(w).alias("prev_day"),
    )
    day, nxt = F.col("date_day"), F.col("next_day")
    series_start = F.greatest(F.col("first_activity"), s0)
    in_range = (day >= s0) & (day < end)
    run_end = F.least(F.coalesce(nxt, end), end)
    # the run that starts at this activity day
    own = F.when(in_range, F.struct(
        day.alias("run_start"), run_end.alias("run_end"), day.alias("last_activity_at"),
        F.col("activities").alias("activities"),
        F.when(F.col("prev_day") >= s0, F.col("prev_day")).alias("prev_activity_at")))
    # days from the spine start up to the first activity inside the spine
    # (only when the member began before the spine): no last activity yet
    lead_in = F.when((day < s0) & (F.coalesce(nxt, end) >= s0) & (s0 < run_end), F.struct(
        s0.alias("run_start"), run_end.alias("run_end"), F.lit(None).cast("date").alias("last_activity_at"),
        F.lit(None).cast("bigint").alias("activities"), F.lit(None).cast("date").alias("prev_activity_at")))
    runs = d.select("member_id", series_start.alias("series_start"),
                    F.explode(F.filter(F.array(lead_in, own), lambda r: r.isNotNull())).alias("r"))
    return runs.select("member_id", "series_start", "r.*")


def _in_order(runs: DataFrame, everywhere: bool) -> DataFrame:
    """The runs by member and day: in each partition, or over all partitions, one after the
    other.  Runs of a member do not overlap, so the days written out of them stand in order too, and
    only runs are ever sorted.  ``everywhere`` keeps the session's shuffle partitions, whose
    number the few bytes of the runs say nothing about."""
    if everywhere:
        parts = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        runs = runs.repartitionByRange(parts, "member_id", "run_start")
    return runs.sortWithinPartitions("member_id", "run_start")


def member_day_metrics(daily: DataFrame, cfg: Config, order=None) -> DataFrame:
    """(member_id, date_day, activities, last_activity_at, calendar_row,
    days_since_last_activity, prev_days_since_last_activity).  ``order`` may sort the runs."""
    runs = _runs(daily, cfg.spine_start, cfg.as_of)
    runs = order(runs) if order else runs
    k = F.explode(F.sequence(F.col("run_start"), F.date_sub(F.col("run_end"), 1))).alias("date_day")
    days = runs.where(F.col("run_start") < F.col("run_end")).select(
        "member_id", "series_start", "last_activity_at", "activities", "prev_activity_at", k)
    last = F.col("last_activity_at")
    since = F.datediff(F.col("date_day"), last).cast("bigint")
    on_activity_day = F.col("date_day") == last
    # the previous day's value matters only on an activity day: it is the gap
    # to the previous activity minus one (NULL when there was none)
    prev_since = F.when(on_activity_day, F.datediff(F.date_sub(last, 1), F.col("prev_activity_at"))) \
                  .otherwise(since - 1).cast("bigint")
    return days.select(
        "member_id", "date_day",
        F.when(on_activity_day, F.col("activities")).alias("activities"),
        "last_activity_at",
        (F.datediff(F.col("date_day"), F.col("series_start")) + 1).cast("bigint").alias("calendar_row"),
        since.alias("days_since_last_activity"),
        prev_since.alias("prev_days_since_last_activity"),
    )


def status_columns(m: DataFrame) -> DataFrame:
    since = F.col("days_since_last_activity")
    event = (F.when((F.col("calendar_row") == 1)
                    | ((F.col("prev_days_since_last_activity") > CHURN_DAYS) & (since == 0)), F.lit("New"))
              .when(since == CHURN_DAYS, F.lit("Churn")))
    status = F.when(since <= ACTIVE_MAX_DAYS, F.lit("Active")).otherwise(F.lit("Churned"))
    return m.select("member_id", "date_day", event.alias("status_event"), status.alias("status"))


def player_status(attended: DataFrame, member: DataFrame, activity: DataFrame, cfg: Config,
                  ordered: bool = False) -> DataFrame:
    daily = daily_activity_counts(attended, member, activity, cfg)
    # By default only the rows of each partition are ordered (good write locality).
    return status_columns(member_day_metrics(daily, cfg, lambda runs: _in_order(runs, ordered)))
