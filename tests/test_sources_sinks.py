"""Sources and sinks: NDJSON, appended loads with new fields, CSV export,
load stamps, empty-payload guard, row counts, seeds, calendar and month URLs."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from turnout.config import Config
from turnout.operators.staging import stg_activity, stg_presence
from turnout.session import scratch_path
from turnout.sources import (append_load, calendar, default_calendar, export_csv, month_urls, read_raw_activity,
                             read_raw_presence, read_raw_table, read_seed, replace_table, require_non_empty,
                             row_count, season, stamp_load, write_ndjson)
from turnout.sources.sinks import new_load_stamp
from tests.fixtures import activity_row, person, presence_row, raw_activity, raw_presence

W = Config.warehouse()


def test_ndjson_roundtrip(spark):
    path = scratch_path(spark, "t-ndjson")
    ra = raw_activity(spark, [activity_row(1, "2024-01-10"), activity_row(2, "2024-01-11", info="[matcher=3]")])
    rp = raw_presence(spark, [presence_row(1, [person(5), person(6, 2)])])
    write_ndjson(ra, f"{path}/a")
    write_ndjson(rp, f"{path}/p")
    back_a = read_raw_activity(spark, f"{path}/a")
    back_p = read_raw_presence(spark, f"{path}/p")
    assert sorted(map(tuple, stg_activity(back_a, W).collect())) == sorted(map(tuple, stg_activity(ra, W).collect()))
    assert sorted(map(tuple, stg_presence(back_p, W).collect())) == sorted(map(tuple, stg_presence(rp, W).collect()))


def test_append_loads_with_added_field(spark):
    path = scratch_path(spark, "t-append")
    old = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    first = raw_activity(spark, [activity_row(1, "2024-01-10", place="old", load="L1", ts=old)]).drop("scheduleInfo")
    assert replace_table(first, path) == 1
    assert append_load(raw_activity(spark, [activity_row(1, "2024-01-10", place="new", info="[matcher=2]"),
                                            activity_row(2, "2024-01-11", place="x", info=None)]), path) == 2
    raw = read_raw_table(spark, path)
    assert "scheduleInfo" in raw.columns and raw.count() == 3
    got = sorted(stg_activity(raw, W).collect())
    assert [(r.place, r.cup_nr_of_games) for r in got] == [("new", 2), ("x", None)]


def test_stamp_and_guard_and_count(spark):
    lid, ts = new_load_stamp()
    df = stamp_load(spark.range(3).withColumnRenamed("id", "scheduleId"), lid, ts)
    assert df.select("load_id").distinct().count() == 1
    assert row_count(df).first().row_count == 3
    require_non_empty(activity=df, presence=df)
    with pytest.raises(ValueError, match="presence"):
        require_non_empty(activity=df, presence=df.limit(0))


def test_csv_export(spark):
    path = scratch_path(spark, "t-csv")
    df = spark.createDataFrame([(1, "a,b", None), (2, "x", 3.5)], "id long, s string, v double")
    export_csv(df, path)
    back = spark.read.schema(df.schema).option("header", True).csv(path)
    assert sorted(map(tuple, back.collect())) == [(1, "a,b", None), (2, "x", 3.5)]
    assert any(f.endswith(".csv") for f in os.listdir(path.removeprefix("file:")))


def test_seeds(spark):
    assert read_seed(spark, "activity_types").count() == 8
    assert dict(read_seed(spark, "member_types").collect()) == {4: "Parent", 2: "Leader", 1: "Player"}
    s = season(spark)
    assert s.columns == ["season_id", "season_name", "year", "difficulty"] and s.count() == 12
    assert s.where("difficulty = 'Svår' AND season_name = 'S:t Eriks-Cupen'").count() == 1


def test_calendar_spine(spark):
    c = default_calendar(spark, dt.date(2019, 1, 1), dt.date(2024, 2, 1))
    r = c.agg(F.min("date_day"), F.max("date_day"), F.count("*")).first()
    assert r[0] == dt.date(2019, 1, 1) and r[1] == dt.date(2025, 1, 31)
    assert r[2] == (dt.date(2025, 2, 1) - dt.date(2019, 1, 1)).days
    assert calendar(spark, dt.date(2020, 1, 1), dt.date(2020, 1, 1)).count() == 0


def test_month_urls_swedish_names(spark):
    starts = spark.createDataFrame([("lag-a", dt.date(2023, 11, 15)), ("lag-b", dt.date(2024, 3, 1))],
                                   "team_slug string, start_date date")
    got = [(r.team_slug, r.url) for r in month_urls(starts, dt.date(2024, 2, 10), "www.x.se").collect()]
    assert got == [("lag-a", "https://www.x.se/lag-a/kalender/2023/november"),
                   ("lag-a", "https://www.x.se/lag-a/kalender/2023/december"),
                   ("lag-a", "https://www.x.se/lag-a/kalender/2024/januari")]


def test_streaming_ingest_is_incremental_and_exactly_once(spark):
    from turnout.streaming import ingest_loads
    root = scratch_path(spark, "t-stream")
    old = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    write_ndjson(raw_activity(spark, [activity_row(1, "2024-01-10", place="old", load="L1", ts=old)]),
                 f"{root}/landing/L1")
    t = ingest_loads(spark, "activity", f"{root}/landing/*", f"{root}/table", f"{root}/ckpt")
    assert t.count() == 1
    # a rerun without new files appends nothing
    assert ingest_loads(spark, "activity", f"{root}/landing/*", f"{root}/table", f"{root}/ckpt").count() == 1
    write_ndjson(raw_activity(spark, [activity_row(1, "2024-01-10", place="new")]), f"{root}/landing/L2")
    t = ingest_loads(spark, "activity", f"{root}/landing/*", f"{root}/table", f"{root}/ckpt")
    assert t.count() == 2
    assert [r.place for r in stg_activity(t, W).collect()] == ["new"]


def test_full_run_writes_models_checks_views_and_export(spark):
    from turnout.plans.run import run
    acts = [activity_row(1, "2024-05-06"), activity_row(2, "2024-05-07", etype=3)]
    pres = [presence_row(1, [person(1, 1, "2014-02-01"), person(2, 1), person(3, 1), person(4, 2)]),
            presence_row(2, [person(1, 1, "2014-02-01")])]
    cfg = Config.warehouse(as_of=dt.date(2024, 6, 1))
    res = run(spark, raw_activity(spark, acts), raw_presence(spark, pres), cfg, scratch_path(spark, "t-run"))
    assert {"statligt_lok", "kommunalt_lok", "player_status", "training_participation", "export_all",
            "calendar", "season"} <= set(res.models)
    fails = {(r.model, r.column, r.test): r.failures for r in res.checks.collect()}
    assert len(fails) == 30 and fails[("activity", "activity", "not_null")] == 1
    assert spark.sql("SELECT * FROM member LIMIT 11").count() == 4
    back = spark.read.option("header", True).csv(res.export_path)
    assert back.count() == 5 and "full_name" in back.columns
    loc = run(spark, raw_activity(spark, acts), raw_presence(spark, pres), Config.local(),
              scratch_path(spark, "t-run-local"))
    assert set(loc.models) >= {"lok", "export_all", "member"} and loc.checks.count() == 18


def test_bad_lines_fail_or_are_set_aside(spark):
    from turnout import schemas
    from turnout.sources.raw import split_load
    path = scratch_path(spark, "t-bad")
    lines = ['{"scheduleId": 1, "newField": "n"}', "not json at all", '{"scheduleId": "x6"}', "", '{"scheduleId": 2}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    with pytest.raises(Exception):
        read_raw_activity(spark, path).collect()
    rows, rejects = split_load(spark, path, schemas.RAW_ACTIVITY)
    assert sorted((r.scheduleId, r.newField) for r in rows.collect()) == [(1, "n"), (2, None)]
    assert sorted(r.line for r in rejects.collect()) == ["not json at all", '{"scheduleId": "x6"}']


def test_new_fields_pass_the_landing_path(spark):
    from turnout.streaming import ingest_loads
    root = scratch_path(spark, "t-new")
    old = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    write_ndjson(raw_activity(spark, [activity_row(1, "2024-01-10", load="L1", ts=old)]), f"{root}/landing/L1")
    ingest_loads(spark, "activity", f"{root}/landing/*", f"{root}/table", f"{root}/ckpt")
    write_ndjson(raw_activity(spark, [activity_row(2, "2024-01-10")]).withColumn("newField", F.lit("n")), f"{root}/landing/L2")
    t = ingest_loads(spark, "activity", f"{root}/landing/*", f"{root}/table", f"{root}/ckpt")
    assert sorted((r.scheduleId, r.newField) for r in t.collect()) == [(1, None), (2, "n")]


def test_csv_doubles_quotes(spark):
    import duckdb
    path = scratch_path(spark, "t-quotes")
    rows = [('"abc=="', 'say "hi"'), ("a,b", "back\\slash")]
    df = spark.createDataFrame(rows, "a string, b string")
    export_csv(df, path)
    plain = path.removeprefix("file:")
    assert sorted(duckdb.sql(f"SELECT * FROM read_csv('{plain}/*.csv', header = true, escape = '\"')").fetchall()) == sorted(rows)


def test_activity_ids_of_many_teams_differ(spark):
    from turnout.sources import adapters as ad
    rows = [(dt.datetime(2024, 1, 1, 18 + h, 5), u) for h in (0, 1) for u in (0, 49, 50, 150_000, 50_000_000)]
    ev = spark.createDataFrame(rows, "ts timestamp_ntz, user_id long")
    a = ad.ev_attendance(ev, 1).select("bucket", "team", "schedule_id").distinct().collect()
    assert len(a) == 8 == len({r.schedule_id for r in a})


def test_run_refuses_empty_loads_and_fails_on_checks(spark):
    from turnout.plans.run import run
    cfg = Config.local()
    with pytest.raises(ValueError, match="presence"):
        run(spark, raw_activity(spark, [activity_row(1, "2024-05-06")]), raw_presence(spark, []), cfg, scratch_path(spark, "t-empty"))
    with pytest.raises(RuntimeError, match="event_type_label"):
        run(spark, raw_activity(spark, [activity_row(1, "2024-05-06", etype=3)]), raw_presence(spark, [presence_row(1, [person(1)])]), cfg,
            scratch_path(spark, "t-fail"), fail_on_check=True)
