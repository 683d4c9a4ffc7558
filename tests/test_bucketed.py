"""Tables in buckets: no exchange of the stored sides, refusal of hot keys, same results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from turnout.config import Config
from turnout.operators import activities, grants
from turnout.plans import pipeline
from turnout.session import scratch_path
from turnout.sources import bucketed

from tests.fixtures import activity_row, eligible_crowd, person, presence_row, raw_activity, raw_presence

W = Config.warehouse(as_of=dt.date(2024, 6, 1))


@pytest.fixture()
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip(" +-:") for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def loads(spark, n=40):
    acts = [activity_row(i, f"2024-05-{1 + i % 28:02d}", etype=1 + i % 2) for i in range(1, n)]
    pres = [presence_row(i, eligible_crowd(10 * (i % 5), 4, 1 + i % 2) + [person(900 + i, 1, "2011-03-03")]) for i in range(1, n)]
    return raw_activity(spark, acts), raw_presence(spark, pres)


def rows(df):
    return sorted(map(str, df.collect()))


def test_a_stored_side_is_not_shuffled_again(spark, no_broadcast):
    a = bucketed.write_bucketed(spark.range(1000).select("id", (F.col("id") % 7).alias("x")), scratch_path(spark, "b"), "id", 4)
    b = bucketed.write_bucketed(spark.range(500).select("id", (F.col("id") % 5).alias("y")), scratch_path(spark, "b"), "id", 4)
    both = a.join(b, "id")
    assert exchanges(both) == [] and both.count() == 500
    assert exchanges(a.groupBy("id").count()) == []
    assert len(exchanges(spark.range(2000).join(a, "id"))) == 1
    assert bucketed.forget(spark) >= 2


def test_files_of_an_earlier_session_are_attached(spark, no_broadcast):
    path = scratch_path(spark, "b")
    bucketed.write_bucketed(spark.range(100).select("id", F.current_date().alias("d"), F.lit("å").alias("odd name")), path, "id", 4)
    bucketed.forget(spark)
    t = bucketed.attach(spark, path, "id", 4)
    assert t.columns == ["id", "d", "odd name"] and t.count() == 100
    assert exchanges(t.groupBy("id").count()) == []
    assert t.where("id = 7").count() == 1


def test_empty_tables_and_nulls(spark):
    empty = bucketed.write_bucketed(spark.range(0).select("id"), scratch_path(spark, "b"), "id", 4)
    assert empty.count() == 0 and empty.columns == ["id"]
    nulls = spark.createDataFrame([(None, 1), (None, 2), (3, 3)], "id long, v int")
    t = bucketed.write_bucketed(nulls, scratch_path(spark, "b"), "id", 4)
    assert rows(t) == rows(nulls)
    assert bucketed.hottest(nulls, "id", "v") == {"id": pytest.approx(2 / 3), "v": pytest.approx(1 / 3)}
    assert bucketed.hottest(empty, "id") == {"id": 0.0}


def test_a_hot_key_keeps_the_table_out_of_buckets():
    assert bucketed.even(0.01, 200) and not bucketed.even(1 / 3, 200)
    assert bucketed.even(1.0, 1)


def test_models_in_buckets_join_without_moving_and_give_the_same(spark, no_broadcast):
    ra, rp = loads(spark)
    plain = pipeline.build_all(spark, ra, rp, W, scratch_path(spark, "plain"))
    stored = pipeline.build_all(spark, ra, rp, W, scratch_path(spark, "stored"), buckets=4)
    for name in ("member", "activity", "attended_activity", "statligt_lok", "kommunalt_lok", "export_all", "player_status", "training_participation"):
        assert rows(stored[name].select(*plain[name].columns)) == rows(plain[name]), name
    args = stored["attended_activity"], stored["member"], stored["activity"]
    wide = exchanges(activities.export_all(*args))  # the attendance on its way to the activities
    assert len(wide) == 1 and "activity_id" in wide[0].split("]")[0]
    assert len(exchanges(grants.eligible_activities(*args, W))) == 1  # neither joins nor the count move more
    unstored = plain["attended_activity"], plain["member"], plain["activity"]
    assert len(exchanges(activities.export_all(*unstored))) == 4


def test_a_build_with_a_hot_member_goes_without_buckets(spark):
    ra, _ = loads(spark)
    rp = raw_presence(spark, [presence_row(i, [person(1)]) for i in range(1, 40)])
    m = pipeline.Materialized(spark, scratch_path(spark, "hot"), pipeline.model_builders(spark, W, lambda: ra, lambda: rp),
                              frozenset({"member", "attended_activity", "activity"}), buckets=16)
    assert m.bucket_key("member") is None and m.bucket_key("attended_activity") is None
    assert m.bucket_key("activity") == "activity_id"
    assert m.bucket_key("export_all") is None
    assert m["member"].count() == 1 and m["attended_activity"].count() == 39 and m["activity"].count() == 39
