"""Midnight, DST, day/week cutting and age rules under several session zones."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from turnout.config import Config
from turnout.functions import calendar_age, end_instant, local_day, local_instant, minutes_between, week_start
from turnout.operators.activities import activity
from turnout.operators.staging import stg_activity
from tests.fixtures import activity_row, raw_activity

ZONES = ["UTC", "Europe/Stockholm", "America/New_York"]
Z = "Europe/Stockholm"


def _minutes(spark, rows, mode="calendar"):
    df = spark.createDataFrame(rows, "d string, s string, e string")
    start = local_instant("d", "s", Z)
    end = end_instant("d", "s", "e", Z, mode)
    return [r[0] for r in df.select(minutes_between(start, end)).collect()]


@pytest.mark.parametrize("zone", ZONES)
def test_midnight_rule(spark, session_zone, zone):
    session_zone(zone)
    rows = [("2024-01-10", "22:00", "00:00"), ("2024-01-10", "23:00", "01:00"), ("2024-01-10", "00:00", "00:00")]
    assert _minutes(spark, rows) == [120, -1320, 1440]


@pytest.mark.parametrize("zone", ZONES)
def test_dst_elapsed_minutes(spark, session_zone, zone):
    session_zone(zone)
    rows = [("2024-03-31", "00:00", "06:00"), ("2024-03-30", "23:00", "00:00"), ("2024-03-31", "22:00", "00:00")]
    assert _minutes(spark, rows) == [300, 60, 120]
    assert _minutes(spark, rows, "plus24h")[2] == 180


@pytest.mark.parametrize("zone", ZONES)
def test_local_day_edge(spark, session_zone, zone):
    session_zone(zone)
    df = spark.createDataFrame([("2024-06-02", "00:30")], "d string, s string")
    ts = local_instant("d", "s", Z)
    r = df.select(local_day(ts, Z).alias("sto"), local_day(ts, "UTC").alias("utc")).first()
    assert r.sto == dt.date(2024, 6, 2) and r.utc == dt.date(2024, 6, 1)


def test_null_time_gives_null_instant(spark):
    df = spark.createDataFrame([("2024-06-02", None), (None, "18:00")], "d string, s string")
    assert [r[0] for r in df.select(local_instant("d", "s", Z)).collect()] == [None, None]


def test_week_start_monday_and_sunday(spark):
    df = spark.createDataFrame([(dt.date(2024, 5, 12),), (dt.date(2024, 5, 13),)], "d date")
    r = df.select(week_start("d", "monday").alias("m"), week_start("d", "sunday").alias("s")).collect()
    assert (r[0].m, r[0].s) == (dt.date(2024, 5, 6), dt.date(2024, 5, 12))
    assert (r[1].m, r[1].s) == (dt.date(2024, 5, 13), dt.date(2024, 5, 12))


def test_calendar_age_is_year_difference(spark):
    df = spark.createDataFrame([(dt.date(2014, 12, 31), dt.date(2021, 1, 1))], "dob date, at date")
    assert df.select(calendar_age("dob", "at")).first()[0] == 7


@pytest.mark.parametrize("zone", ZONES)
def test_activity_model_is_session_zone_independent(spark, session_zone, zone):
    session_zone(zone)
    raw = raw_activity(spark, [activity_row(1, "2024-03-31", "22:00", "00:00"),
                               activity_row(2, "2024-01-10", "23:00", "01:00", etype=3),
                               activity_row(3, "2024-01-10", None, "01:00", etype=7, result=9)])
    cfg = Config.local()
    a = activity(stg_activity(raw, cfg), cfg)
    got = {r.activity_id: r for r in a.select("activity_id", F.unix_seconds("start_at").alias("s"),
                                              "duration_minutes", "event_type_label", "result_label").collect()}
    assert got[1].s == int(dt.datetime(2024, 3, 31, 20, 0, tzinfo=dt.timezone.utc).timestamp())
    assert got[1].duration_minutes == 120
    assert got[2].duration_minutes == -1320 and got[2].event_type_label is None
    assert got[3].s is None and got[3].event_type_label == "Match" and got[3].result_label is None
