"""State grant (ladder, daily repeats, leaders, eligibility) and municipal grant."""

import datetime as dt

from pyspark.sql import functions as F

from turnout.config import Config
from turnout.operators import grants
from turnout.operators.activities import activity, attended_activity
from turnout.operators.members import member
from turnout.operators.staging import stg_activity, stg_presence
from tests.fixtures import activity_row, eligible_crowd, person, presence_row, raw_activity, raw_presence

LOCAL = Config.local()
WH = Config.warehouse(as_of=dt.date(2024, 6, 1))


def models(spark, acts, pres, cfg):
    sa = stg_activity(raw_activity(spark, acts), cfg)
    sp = stg_presence(raw_presence(spark, pres), cfg)
    m = member(sp, cfg)
    a = activity(sa, cfg) if cfg.is_local else activity(sa, cfg, sp, m)
    return attended_activity(sp, cfg), m, a


def amounts(spark, acts, pres, cfg, uid):
    o = grants.activity_ordinals(*models(spark, acts, pres, cfg), cfg)
    rows = (o.where(F.col("member_id") == uid).withColumn("amount", grants.player_amount())
             .orderBy("start_at", "activity_id").select("amount").collect())
    return [r.amount for r in rows]


def test_grant_ladder_by_age(spark):
    days = [f"2024-05-{d:02d}" for d in range(6, 12)]     # Monday..Saturday of one week
    acts = [activity_row(i + 1, d) for i, d in enumerate(days)]
    young, older = person(1, 1, "2016-03-01"), person(2, 1, "2012-03-01")
    pres = [presence_row(i + 1, [young, older] + eligible_crowd(10)) for i in range(6)]
    assert amounts(spark, acts, pres, LOCAL, 1) == [7.5, 7.5, 5.0, 0.0, 0.0, 0.0]
    assert amounts(spark, acts, pres, LOCAL, 2) == [7.5, 7.5, 5.0, 2.5, 2.5, 0.0]


def test_same_day_repeat_counts_in_week_but_pays_zero(spark):
    acts = [activity_row(1, "2024-05-06", "10:00", "11:00"), activity_row(2, "2024-05-06", "18:00", "19:00"),
            activity_row(3, "2024-05-07"), activity_row(4, "2024-05-08")]
    p = person(1, 1, "2012-03-01")
    pres = [presence_row(i, [p] + eligible_crowd(10)) for i in range(1, 5)]
    assert amounts(spark, acts, pres, LOCAL, 1) == [7.5, 0.0, 5.0, 2.5]


def test_week_start_differs_between_families(spark):
    # Sunday 2024-05-12 then Monday 2024-05-13: one week under Sunday weeks, two under Monday weeks
    acts = [activity_row(1, "2024-05-12"), activity_row(2, "2024-05-13")]
    p = person(1, 1, "2012-03-01")
    pres = [presence_row(i, [p] + eligible_crowd(10)) for i in (1, 2)]
    loc = grants.activity_ordinals(*models(spark, acts, pres, LOCAL), LOCAL).where("member_id = 1")
    wh = grants.activity_ordinals(*models(spark, acts, pres, WH), WH).where("member_id = 1")
    assert sorted(r.acc_weekly_activities for r in loc.collect()) == [1, 1]
    assert sorted(r.acc_weekly_activities for r in wh.collect()) == [1, 2]


def test_young_leader_earns_player_amount(spark):
    acts = [activity_row(1, "2024-05-06")]
    pres = [presence_row(1, [person(1, 2, "2007-01-01")] + eligible_crowd(10))]
    assert amounts(spark, acts, pres, LOCAL, 1) == [7.5]


def test_eligibility_and_leader_amount(spark):
    acts = [activity_row(i, "2024-05-06", f"{8 + i}:00", f"{9 + i}:00") for i in range(1, 5)]
    pres = [presence_row(1, eligible_crowd(10, 2, 1)), presence_row(2, eligible_crowd(20, 3, 0)),
            presence_row(3, eligible_crowd(30, 3, 1)), presence_row(4, eligible_crowd(40, 3, 2))]
    g = {r.activity_id: r for r in grants.state_grant(*models(spark, acts, pres, LOCAL), LOCAL).collect()}
    assert set(g) == {3, 4}
    assert g[3].lok_amount_leaders == 20 and g[4].lok_amount_leaders == 25
    assert g[3].lok_amount_players == 3 * 7.5


def test_eligibility_age_reference_as_of(spark):
    # players born 2000 are 24 at the activity (2024) but 26 at an as-of in 2026
    acts = [activity_row(1, "2024-05-06")]
    pres = [presence_row(1, eligible_crowd(10, 3, 1, dob="2000-01-01"))]
    assert grants.eligible_activities(*models(spark, acts, pres, LOCAL), LOCAL).count() == 1
    late = Config.warehouse(as_of=dt.date(2026, 1, 1))
    assert grants.eligible_activities(*models(spark, acts, pres, late), late).count() == 0


def test_municipal_grant_branches(spark):
    def crowd(base, n):
        return [person(base + i, 1, "2012-01-01") for i in range(n)]

    acts = [activity_row(1, "2024-05-06", "10:00", "10:59"),   # 59 minutes -> 0
            activity_row(2, "2024-05-07", "10:00", "11:00"),   # 4 players -> 0
            activity_row(3, "2024-05-08", "10:00", "11:00"),   # 5 players, ages
            activity_row(4, "2024-05-09", "10:00", "11:00"),   # 16 players -> multiplier 2
            activity_row(5, "2024-05-09", "12:00", "13:00")]   # 10 players same day -> multiplier 1
    ages = {101: "2018-01-01", 102: "2017-01-01", 103: "2012-01-01", 104: "2011-01-01", 105: "2004-01-01",
            106: "2003-01-01", 107: None}
    pres = [presence_row(1, crowd(200, 5) + [person(103, 1, ages[103])]),
            presence_row(2, crowd(300, 3) + [person(103, 1, ages[103])]),
            presence_row(3, [person(u, 1, d) for u, d in ages.items()]),
            presence_row(4, crowd(400, 15) + [person(500, 1, "2012-01-01")]),
            presence_row(5, crowd(600, 9) + [person(500, 1, "2012-01-01")])]
    g = grants.municipal_grant(*models(spark, acts, pres, WH), WH)
    by = {(r.date_day.isoformat(), r.member_id, r.multiplier): r.contribution_municipality for r in g.collect()}
    assert by[("2024-05-06", 103, 1)] == 0.0
    assert by[("2024-05-07", 103, 1)] == 0.0
    day3 = {u: by[("2024-05-08", u, 1)] for u in ages}
    assert day3 == {101: 0.0, 102: 8.5, 103: 8.5, 104: 11.0, 105: 11.0, 106: 0.0, 107: 0.0}
    assert by[("2024-05-09", 500, 2)] == 8.5 and by[("2024-05-09", 500, 1)] == 8.5
