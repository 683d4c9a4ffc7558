"""Column helpers: digests, pseudonyms, regex extraction, URL pieces, month names."""

import datetime as dt
import hashlib
import base64


from turnout.functions import (activity_edit_url, activity_id_from_url, attendance_id, is_match_url, is_team_url,
                               presence_url, pseudonym, regexp_first, safe_pct, swedish_month)
from turnout.operators.latest import latest_per_key


def test_attendance_id_styles_and_nulls(spark):
    df = spark.createDataFrame([(12, 3), (None, 7), (5, None)], "s long, u long")
    hexes = [r[0] for r in df.select(attendance_id("s", "u", "hex")).collect()]
    assert hexes == [hashlib.md5(b"123").hexdigest(), hashlib.md5(b"7").hexdigest(), hashlib.md5(b"5").hexdigest()]
    j = df.select(attendance_id("s", "u", "json_base64")).first()[0]
    assert j == '"' + base64.b64encode(hashlib.md5(b"123").digest()).decode() + '"'


def test_pseudonym(spark):
    df = spark.createDataFrame([(42,), (None,)], "u long")
    got = [r[0] for r in df.select(pseudonym("u")).collect()]
    assert got == [base64.b64encode(hashlib.md5(b"42").digest()).decode()[:6], "null"]


def test_regexp_first_null_on_no_match(spark):
    df = spark.createDataFrame([("a [matcher=12] b",), ("nothing",), (None,)], "t string")
    got = [r[0] for r in df.select(regexp_first("t", r"\[matcher=([^\]]+)\]")).collect()]
    assert got == ["12", None, None]


def test_url_pieces(spark):
    df = spark.createDataFrame([("/lag/kalender/aktivitet/123/",), ("/lag/match/9/",), ("x",), (None,)], "u string")
    r = df.select(activity_id_from_url("u").alias("id"), is_match_url("u").alias("m"),
                  is_team_url("u", "lag").alias("t")).collect()
    assert [x.id for x in r] == ["123", "9", None, None]
    assert [x.m for x in r] == [False, True, False, False]
    assert [x.t for x in r] == [True, True, False, False]
    one = spark.createDataFrame([("77", True)], "a string, g boolean").select(
        presence_url("a", "d.se", "lag").alias("p"), activity_edit_url("a", "g", "d.se", "lag").alias("e")).first()
    assert one.p == "https://d.se/lag/controlpanel/presence/chooseparticipants/77"
    assert one.e == "https://d.se/lag/match/redigera/77"


def test_swedish_month_names(spark):
    df = spark.createDataFrame([(dt.date(2024, m, 1),) for m in (1, 5, 8, 12)], "d date")
    assert [r[0] for r in df.select(swedish_month("d")).collect()] == ["januari", "maj", "augusti", "december"]


def test_safe_pct_rounding(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (9, 400), (0, None)], "a long, b long")
    assert [r[0] for r in df.select(safe_pct("a", "b")).collect()] == [33.3, None, 2.3, None]


def test_latest_per_key_order_and_nulls(spark):
    df = spark.createDataFrame([(1, 5, 2, "a"), (1, 9, 4, "b"), (1, 9, 1, "c"), (1, None, 0, "d"), (2, None, 3, "e")],
                               "k long, s long, t long, v string")
    got = {r.k: r.v for r in latest_per_key(df, ["k"], [("s", "desc"), ("t", "asc")]).collect()}
    assert got == {1: "c", 2: "e"}
