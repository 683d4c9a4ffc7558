"""Staging (load filter, unnesting, cup text) and the member dimension."""

import datetime as dt


from turnout.config import Config
from turnout.operators.activities import attended_activity
from turnout.operators.members import member
from turnout.operators.quality import unique
from turnout.operators.staging import latest_load, stg_activity, stg_presence
from tests.fixtures import activity_row, person, presence_row, raw_activity, raw_presence

W, L = Config.warehouse(), Config.local()
OLD = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def test_presence_groups(spark):
    p1, p2, lead = person(1), person(2), person(3, 2)
    rows = [
        presence_row(10, [], groups=[]),                                   # empty list -> 0 rows
        presence_row(11, [], groups=None) | {"teamPresenceGroups": None},  # null -> 0 rows
        presence_row(12, [], groups=[{"leaders": [lead], "participants": [p1]},
                                     {"leaders": [], "participants": [p2]}]),  # first group only
        presence_row(13, [], groups=[{"leaders": None, "participants": [p2]}]),  # participants only
    ]
    st = stg_presence(raw_presence(spark, rows), W)
    got = sorted((r.schedule_id, r.user_id) for r in st.collect())
    assert got == [(12, 1), (12, 3), (13, 2)]


def test_latest_load_only(spark):
    rows = [activity_row(1, "2024-01-10", place="old", load="L1", ts=OLD),
            activity_row(1, "2024-01-10", place="new", load="L2")]
    raw = raw_activity(spark, rows)
    assert [r.place for r in stg_activity(raw, W).collect()] == ["new"]
    assert sorted(r.place for r in stg_activity(raw, L).collect()) == ["new", "old"]


def test_latest_load_ties_go_to_greatest_load_id(spark):
    rows = [activity_row(1, "2024-01-10", place="a", load="A"), activity_row(1, "2024-01-10", place="b", load="B")]
    assert [r.place for r in latest_load(raw_activity(spark, rows)).collect()] == ["b"]


def test_cup_games_from_info_text(spark):
    rows = [activity_row(1, "2024-01-10", info="x [matcher=4] y"), activity_row(2, "2024-01-10", info="none"),
            activity_row(3, "2024-01-10", info=None)]
    got = dict(stg_activity(raw_activity(spark, rows), W).select("schedule_id", "cup_nr_of_games").collect())
    assert got == {1: 4, 2: None, 3: None}


def test_member_latest_profile_by_schedule_id(spark):
    rows = [presence_row(5, [person(7, 4)]), presence_row(9, [person(7, 1)]), presence_row(3, [person(7, 2)])]
    st = stg_presence(raw_presence(spark, rows), W)
    m = member(st, W).collect()
    assert len(m) == 1 and m[0].member_type == "Player" and m[0].member_type_id == 1


def test_member_names_deleted_and_pseudonym(spark):
    rows = [presence_row(1, [person(5, 1, first="", last=None), person(6, 1, first="Ann", last="")])]
    raw = raw_presence(spark, rows)
    loc = {r.member_id: r for r in member(stg_presence(raw, L), L).collect()}
    assert (loc[5].first_name, loc[5].last_name) == ("<DELETED>", "<DELETED>")
    assert (loc[6].first_name, loc[6].last_name) == ("Ann", "<DELETED>")
    wh = {r.member_id: r for r in member(stg_presence(raw, W), W).collect()}
    tag = spark.sql("select left(base64(unhex(md5('5'))), 6)").first()[0]
    assert wh[5].first_name == f"FN-{tag}" and wh[5].last_name == f"EN-{tag}"
    assert wh[5].full_name == f"FN-{tag} EN-{tag}"
    assert wh[6].is_f2014 is False


def test_attendance_id_collision_and_styles(spark):
    rows = [presence_row(1, [person(23)]), presence_row(12, [person(3)])]
    st = stg_presence(raw_presence(spark, rows), L)
    att = attended_activity(st, L)
    ids = [r.attendance_id for r in att.collect()]
    assert ids[0] == ids[1] == spark.sql("select md5('123')").first()[0]
    dup = unique(att, "attendance_id").collect()
    assert len(dup) == 1 and dup[0].n_records == 2
    w = attended_activity(stg_presence(raw_presence(spark, rows), W), W).first().attendance_id
    assert w.startswith('"') and w.endswith('"') and len(w) == 26


def test_cohort_flag_null_birth_is_false(spark):
    rows = [presence_row(1, [person(5, 1, dob=None), person(6, 1, dob="2014-03-01")])]
    m = {r.member_id: r.is_f2014 for r in
         member(stg_presence(raw_presence(spark, rows), W), W).collect()}
    assert m == {5: False, 6: True}


def test_loads_agree_check(spark):
    from turnout.operators.staging import loads_agree
    ra = raw_activity(spark, [activity_row(1, "2024-01-10", load="L1", ts=OLD), activity_row(1, "2024-01-10")])
    rp_same = raw_presence(spark, [presence_row(1, [person(1)])])
    rp_old = raw_presence(spark, [presence_row(1, [person(1)], load="L1", ts=OLD)])
    r = loads_agree(ra, rp_same).first()
    assert (r.activity_load_id, r.presence_load_id, r.agree) == ("L2", "L2", True)
    assert loads_agree(ra, rp_old).first().agree is False
