"""Retention series: churn gaps, spine start, future members, and a brute-force
check (calendar grid + per-day search of the last activity, as the original
model computes it) on random activity histories."""

import datetime as dt
import random

import pytest
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnout.config import Config
from turnout.operators.retention import member_day_metrics, status_columns

SPINE = dt.date(2019, 1, 1)


def member_day_metrics_grid(daily: DataFrame, cfg: Config) -> DataFrame:
    """The same metrics in the original's shape, for comparison and for
    callers that already hold the member x day grid: every day from the first
    activity (or the spine start) to the day before ``as_of`` joined with the
    daily counts, then windows per member ordered by day: ``row_number``
    (calendar row), a running ``max`` of activity days (last activity) and
    ``lag`` (previous day's value).  Window partitions are bounded by the
    calendar length; ``member_day_metrics`` produces the same rows without the
    join.
    """
    firsts = daily.groupBy("member_id").agg(F.min("date_day").alias("first_activity"))
    start = F.greatest(F.col("first_activity"), F.lit(cfg.spine_start))
    last_day = F.date_sub(F.lit(cfg.as_of), 1)
    grid = (firsts.where(start <= last_day)
                  .select("member_id", F.explode(F.sequence(start, last_day)).alias("date_day")))
    g = grid.join(daily.where(F.col("date_day").isNotNull()), ["member_id", "date_day"], "left")
    w = Window.partitionBy("member_id").orderBy("date_day")
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.max(F.when(F.col("activities") > 0, F.col("date_day"))).over(running)
    g = g.select("member_id", "date_day", "activities", last.alias("last_activity_at"),
                 F.row_number().over(w).cast("bigint").alias("calendar_row"))
    since = F.datediff(F.col("date_day"), F.col("last_activity_at")).cast("bigint")
    g = g.withColumn("days_since_last_activity", since)
    return g.withColumn("prev_days_since_last_activity", F.lag("days_since_last_activity").over(w))


SCHEMA = T.StructType([T.StructField("member_id", T.LongType()), T.StructField("date_day", T.DateType()),
                       T.StructField("activities", T.LongType())])


def series(spark, daily_rows, as_of, spine=SPINE):
    cfg = Config.warehouse(as_of=as_of, spine_start=spine)
    m = member_day_metrics(spark.createDataFrame(daily_rows, SCHEMA), cfg)
    return {(r.member_id, r.date_day): r for r in status_columns(m).collect()}


def brute_force(daily_rows, as_of, spine=SPINE):
    """The original model's formulation, row by row in Python."""
    by_member = {}
    for mid, day, n in daily_rows:
        by_member.setdefault(mid, {})[day] = by_member.get(mid, {}).get(day, 0) + n
    spine_end = as_of.replace(year=as_of.year + 1)
    out = {}
    for mid, days in by_member.items():
        first = min(d for d in days if d is not None)
        cal = [spine + dt.timedelta(i) for i in range((spine_end - spine).days)]
        grid = [d for d in cal if d >= first and d < as_of]
        prev_since = None
        for i, d in enumerate(grid):
            acts = [x for x in grid[:i + 1] if days.get(x, 0) > 0]
            last = max(acts) if acts else None
            since = (d - last).days if last else None
            if i == 0 or (prev_since is not None and prev_since > 91 and since == 0):
                event = "New"
            elif since == 91:
                event = "Churn"
            else:
                event = None
            out[(mid, d)] = (event, "Active" if since is not None and since <= 90 else "Churned")
            prev_since = since
    return out


@pytest.mark.parametrize("gap,churn,second_new", [(90, False, False), (91, False, False),
                                                  (92, True, False), (93, True, True)])
def test_churn_gaps(spark, gap, churn, second_new):
    d0 = dt.date(2023, 1, 1)
    back = d0 + dt.timedelta(gap)
    s = series(spark, [(1, d0, 1), (1, back, 1)], as_of=dt.date(2023, 12, 31))
    assert s[(1, d0)].status_event == "New"
    churn_day = d0 + dt.timedelta(91)
    assert (s.get((1, churn_day)) is not None and s[(1, churn_day)].status_event == "Churn") == churn
    assert (s[(1, back)].status_event == "New") == second_new
    assert s[(1, back)].status == "Active"


def test_member_before_spine_start(spark):
    s = series(spark, [(1, dt.date(2018, 6, 1), 1)], as_of=dt.date(2019, 1, 10))
    rows = [s[(1, SPINE + dt.timedelta(i))] for i in range(9)]
    assert rows[0].status_event == "New" and all(r.status_event is None for r in rows[1:])
    assert all(r.status == "Churned" for r in rows)
    assert len(s) == 9


def test_future_member_has_no_rows_and_today_is_excluded(spark):
    s = series(spark, [(1, dt.date(2024, 5, 1), 1), (2, dt.date(2024, 4, 29), 1)], as_of=dt.date(2024, 5, 1))
    assert {k[0] for k in s} == {2}
    assert max(k[1] for k in s) == dt.date(2024, 4, 30)


def test_matches_brute_force_on_random_histories(spark):
    rng = random.Random(7)
    as_of = dt.date(2020, 1, 15)
    rows = []
    for mid in range(1, 9):
        start = SPINE + dt.timedelta(rng.randint(-200, 300))
        d = start
        while d < as_of + dt.timedelta(30):
            rows.append((mid, d, rng.randint(1, 2)))
            d += dt.timedelta(rng.choice([1, 2, 5, 30, 89, 90, 91, 92, 93, 94, 150]))
    got = {k: (v.status_event, v.status) for k, v in series(spark, rows, as_of).items()}
    assert got == brute_force(rows, as_of)


def test_grid_window_form_equals_run_form(spark):
    rng = random.Random(11)
    as_of = dt.date(2019, 9, 1)
    rows = []
    for mid in range(1, 6):
        d = SPINE + dt.timedelta(rng.randint(-100, 150))
        while d < as_of + dt.timedelta(10):
            rows.append((mid, d, rng.randint(1, 3)))
            d += dt.timedelta(rng.choice([1, 3, 60, 91, 92, 93, 120]))
    cfg = Config.warehouse(as_of=as_of, spine_start=SPINE)
    daily = spark.createDataFrame(rows, SCHEMA)
    cols = ["member_id", "date_day", "activities", "last_activity_at", "calendar_row", "days_since_last_activity"]
    runs = sorted(map(tuple, member_day_metrics(daily, cfg).select(*cols).collect()))
    grid = sorted(map(tuple, member_day_metrics_grid(daily, cfg).select(*cols).collect()))
    assert runs == grid
    a = sorted(map(tuple, status_columns(member_day_metrics(daily, cfg)).collect()))
    b = sorted(map(tuple, status_columns(member_day_metrics_grid(daily, cfg)).collect()))
    assert a == b


def test_series_in_order_is_sorted_by_runs_alone(spark):
    """the days are written out after the sort, in its order, also where a run began before the spine."""
    from turnout.operators.retention import player_status
    rng = random.Random(5)
    as_of, members = dt.date(2019, 9, 1), range(1, 21)
    days = sorted({dt.date(2018, 11, 1) + dt.timedelta(rng.randint(0, 250)) for _ in range(60)})
    attended = spark.createDataFrame([(i, m) for m in members for i in rng.sample(range(len(days)), 9)], "activity_id long, member_id long")
    member = spark.createDataFrame([(m, "Player", True) for m in members], "member_id long, member_type string, is_cohort boolean")
    activity = spark.createDataFrame([(i, dt.datetime(d.year, d.month, d.day, 12, tzinfo=dt.timezone.utc)) for i, d in enumerate(days)], "activity_id long, start_at timestamp")
    cfg = Config.warehouse(as_of=as_of, spine_start=SPINE)
    member = member.withColumnRenamed("is_cohort", cfg.cohort_flag)
    got = player_status(attended, member, activity, cfg, ordered=True)
    rows = [tuple(r) for r in got.collect()]
    assert rows and rows == sorted(rows, key=lambda r: r[:2])
    assert sorted(rows, key=str) == sorted((tuple(r) for r in player_status(attended, member, activity, cfg).collect()), key=str)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(sequence(") < plan.index("Sort [")   # the sort stands below the days
    parts = got.select("member_id", "date_day", F.spark_partition_id().alias("p")).collect()
    assert len({r.p for r in parts}) > 1 and parts == sorted(parts, key=lambda r: (r.p, r.member_id, r.date_day))
