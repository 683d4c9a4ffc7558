"""Training participation and the data-quality checks."""

import datetime as dt


from turnout.config import Config
from turnout.operators import quality
from turnout.operators.activities import activity, attended_activity
from turnout.operators.members import member
from turnout.operators.participation import available_trainings, training_participation
from turnout.operators.staging import stg_activity, stg_presence
from turnout.sources import seeds
from tests.fixtures import activity_row, person, presence_row, raw_activity, raw_presence

AS_OF = dt.date(2024, 6, 1)
CFG = Config.warehouse(as_of=AS_OF)


def models(spark, acts, pres):
    sa = stg_activity(raw_activity(spark, acts), CFG)
    sp = stg_presence(raw_presence(spark, pres), CFG)
    m = member(sp, CFG)
    return attended_activity(sp, CFG), m, activity(sa, CFG, sp, m)


def test_windows_rates_and_zero_available(spark):
    acts = [activity_row(1, "2024-05-20"),                 # within 4 weeks
            activity_row(2, "2024-04-01"),                 # within 12 weeks
            activity_row(3, "2024-01-01"),                 # within 24 weeks
            activity_row(4, "2024-05-04"),                 # exactly 4 weeks back: inclusive
            activity_row(5, "2024-06-01"),                 # today after "now" (midnight UTC): not past
            activity_row(6, "2024-05-21", etype=7)]        # not a training
    p, q = person(1, 1), person(2, 1)
    pres = [presence_row(1, [p]), presence_row(2, [p, q]), presence_row(3, [p]), presence_row(4, [q]),
            presence_row(5, [p]), presence_row(6, [p, person(3, 4)])]
    att, mem, act = models(spark, acts, pres)
    av = available_trainings(act, CFG).first()
    assert (av.available_4w, av.available_12w, av.available_24w) == (2, 3, 4)
    tp = {r.member_id: r for r in training_participation(att, mem, act, CFG).collect()}
    assert set(tp) == {1, 2}                                  # parents excluded
    assert (tp[1].trainings_4w, tp[1].rate_4w) == (1, 50.0)
    assert (tp[1].trainings_24w, tp[1].rate_24w) == (3, 75.0)
    assert (tp[2].trainings_12w, tp[2].rate_12w) == (2, 66.7)
    none_cfg = Config.warehouse(as_of=dt.date(2023, 1, 1))
    z = training_participation(att, mem, act, none_cfg).where("member_id = 1").first()
    assert z.trainings_4w == 0 and z.rate_4w is None


def test_checks_find_planted_faults(spark):
    df = spark.createDataFrame([(1, "Active", None, 10), (1, "Active", "New", 10), (2, "Gone", "Oops", None),
                                (3, None, None, 99)], "member_id long, status string, status_event string, season_id long")
    parent = spark.createDataFrame([(10,)], "season_id long")
    assert quality.not_null(df, "status").count() == 1
    assert quality.not_null(df, "status", where="member_id > 2").count() == 1
    assert quality.not_null(df, "status", where="member_id < 3").count() == 0
    assert [r.unique_field for r in quality.unique(df, "member_id").collect()] == [1]
    assert sorted(r.value_field for r in quality.accepted_values(df, "status", ["Active", "Churned"]).collect()) == ["Gone"]
    assert [r.value_field for r in quality.accepted_values(df, "status_event", ["New", "Churn"]).collect()] == ["Oops"]
    assert quality.unique_combination(df, ["member_id", "status"]).count() == 1
    assert [r.from_field for r in quality.relationships(df, "season_id", parent, "season_id").collect()] == [99]


def test_suite_reports_every_declared_check(spark):
    assert len(quality.LOCAL_CHECKS) == 18 and len(quality.WAREHOUSE_CHECKS) == 30
    acts = [activity_row(1, "2024-05-20", etype=3), activity_row(2, "2024-05-21", etype=7, result=9, season=123)]
    pres = [presence_row(1, [person(1, 1), person(2, 2)]), presence_row(2, [person(1, 1)])]
    att, mem, act = models(spark, acts, pres)
    from turnout.operators.retention import player_status
    ms = {"activity": act, "member": mem, "attended_activity": att, "season": seeds.season(spark),
          "player_status": player_status(att, mem, act, CFG),
          "training_participation": training_participation(att, mem, act, CFG)}
    res = {(r.model, r.column, r.test): r.failures for r in quality.run_checks(ms, quality.WAREHOUSE_CHECKS).collect()}
    assert len(res) == 30
    assert res[("activity", "activity", "not_null")] == 1           # unknown type 3
    assert res[("activity", "result", "not_null")] == 1             # unknown result 9
    assert res[("activity", "season_id", "relationships")] == 1     # orphan season
    assert res[("member", "member_id", "unique")] == 0
    assert sum(v for k, v in res.items() if k[0] == "attended_activity") == 0
