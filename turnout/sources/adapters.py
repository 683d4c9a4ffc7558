"""Deterministic mappings from the driver's generic tables to club data.

The test tables hold no club data, so these adapters derive it with plain
DataFrame expressions (FIXTURES.md section 3):

* ``EV`` turns the ``events`` stream into raw activity and nested presence
  loads: an activity is one time bucket of one team (a team is 50 users),
  the people who had an event in that bucket attended it.  Presence arrays
  are therefore bounded by the team size.
* ``OR`` turns ``orders`` into a long history (1995-2001): one activity per
  order day and attendance = who ordered that day.  Because an activity of
  this adapter grows with the data, it yields flat person rows and never
  nests them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import day_text_of_seconds, epoch_seconds_ntz, hhmm_of_seconds
from .seeds import _rows

# Fixed values of the adapters (FIXTURES.md section 3).
EVENT_TYPE_CYCLE = [1, 2, 3, 4, 5, 6, 7, 9, 10]   # 3 is an unknown code on purpose
DURATION_CYCLE = [60, 45, 30, 60]                 # minutes, by bucket % 4
TEAM_SIZE = 50
TEAM_SPAN = 1 << 32
L1_TIMESTAMP = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)
L2_TIMESTAMP = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
EV_AS_OF = dt.date(2024, 2, 1)
OR_AS_OF = dt.date(2001, 8, 2)
OR_SPINE_START = dt.date(1995, 7, 1)


def season_ids() -> list[int]:
    return [r[0] for r in _rows("seasons")]


def _pick(values: list, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def member_type_of(user_id: Column, bucket: Column | None = None) -> Column:
    """0 -> Leader (2), 1 -> Parent (4), otherwise Player (1), by ``user_id % 10``.
    With a bucket, users ending in 9 appear as Parent in odd buckets, so the
    member type changes over time and only the latest one is kept."""
    t = (F.when(user_id % 10 == 0, F.lit(2)).when(user_id % 10 == 1, F.lit(4)))
    if bucket is not None:
        t = t.when((user_id % 10 == 9) & (bucket % 2 == 1), F.lit(4))
    return t.otherwise(F.lit(1)).cast("bigint")


def _person(user_id: Column, member_type: Column, team: Column, birth_year: Column) -> Column:
    return F.struct(
        (F.lit(1_000_000) + user_id).cast("bigint").alias("id"),
        F.when(user_id % 13 == 0, F.lit("")).otherwise(F.concat(F.lit("F"), user_id.cast("string"))).alias("firstName"),
        F.when(user_id % 17 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("L"), user_id.cast("string"))).alias("lastName"),
        user_id.cast("bigint").alias("userId"),
        F.concat(F.lit("Team "), team.cast("string")).alias("teamName"),
        F.when(user_id % 19 == 0, F.lit("2023-12-31")).alias("inactivatedDate"),
        F.struct((user_id % 5).cast("bigint").alias("star")).alias("stats"),
        F.make_date(birth_year.cast("int"), (F.lit(1) + user_id % 12).cast("int"),
                    (F.lit(1) + user_id % 28).cast("int")).cast("string").alias("birthDate"),
        (member_type == 2).alias("isLeader"),
        (member_type == 1).alias("isPlayer"),
        member_type.alias("memberTypeId"),
    )


# ---------------------------------------------------------------- EV adapter

def ev_attendance(events: DataFrame, bucket_hours: int, parts: int | None = None) -> DataFrame:
    """Distinct (bucket, team, user_id) with schedule_id = bucket * 2^32 + team
    (no two activities share an id while there are fewer than 2^32 teams).  ``parts``: the
    activities are dealt to so many partitions, for steps that write much text of each."""
    sec = epoch_seconds_ntz("ts")
    e = events.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
    out = (e.select(F.floor(sec / (3600 * bucket_hours)).cast("bigint").alias("bucket"),
                    F.floor(F.col("user_id") / TEAM_SIZE).cast("bigint").alias("team"),
                    F.col("user_id"))
            .distinct()
            .withColumn("schedule_id", F.col("bucket") * TEAM_SPAN + F.col("team")))
    return out.repartition(parts, "schedule_id") if parts else out


def _ev_activity_rows(activities: DataFrame, bucket_hours: int, place: Column, keep: list[str] = ()) -> DataFrame:
    b = F.col("bucket")
    start_sec = b * (3600 * bucket_hours)
    hour = ((start_sec % 86400) / 3600).cast("bigint")
    etype = _pick(EVENT_TYPE_CYCLE, b % 9).cast("bigint")
    duration = _pick(DURATION_CYCLE, b % 4)
    is_match = etype == 7
    end_txt = F.when(hour == 23, F.lit("00:00")).otherwise(hhmm_of_seconds(start_sec + duration * 60))
    return activities.select(
        F.col("team").alias("teamId"),
        F.col("schedule_id").alias("scheduleId"),
        F.concat(F.lit("coach"), F.col("team").cast("string")).alias("username"),
        day_text_of_seconds(start_sec).alias("scheduleDate"),
        hhmm_of_seconds(start_sec).alias("startTime"),
        end_txt.alias("endTime"),
        etype.alias("eventTypeId"),
        place.alias("place"),
        (b % 2 == 0).alias("isHomeFacility"),
        F.when(is_match, F.lit(5000) + b % 11).cast("bigint").alias("opponentClubId"),
        F.when(is_match, F.concat(F.lit("Opponent "), (b % 11).cast("string"))).alias("opponent"),
        F.when(is_match, F.lit(1) + b % 4).cast("bigint").alias("resultId"),
        F.when(is_match, b % 5).cast("bigint").alias("goalsFor"),
        F.when(is_match, b % 3).cast("bigint").alias("goalsAgainst"),
        _pick(season_ids() + [None], b % 13).cast("bigint").alias("seasonId"),
        F.concat(F.lit("Activity "), F.col("schedule_id").cast("string")).alias("scheduleText"),
        F.when(etype == 6, F.concat(F.lit("info [matcher="), (b % 5).cast("string"), F.lit("]")))
         .otherwise(F.lit("info")).alias("scheduleInfo"),
        *keep,
    )


def _stamp(df: DataFrame, load_id: str, ts: dt.datetime) -> DataFrame:
    return df.withColumns({"load_id": F.lit(load_id),
                           "load_timestamp": F.timestamp_seconds(F.lit(int(ts.timestamp())))})


def _load_stamps(loads: tuple[str, ...]) -> Column:
    """One struct per load batch; exploding it copies each row into every
    batch in one narrow step (the rows are computed once)."""
    ts = {"L1": L1_TIMESTAMP, "L2": L2_TIMESTAMP}
    return F.array(*[F.struct(F.lit(l).alias("load_id"),
                              F.timestamp_seconds(F.lit(int(ts[l].timestamp()))).alias("load_timestamp"))
                     for l in loads])


def ev_raw_activity(events: DataFrame, bucket_hours: int = 1, loads: tuple[str, ...] = ("L1", "L2"), parts: int | None = None) -> DataFrame:
    """Raw activity rows; the older batch L1 has another place than L2."""
    act = ev_attendance(events, bucket_hours, parts).select("bucket", "team", "schedule_id").distinct()
    act = act.select("*", F.explode(_load_stamps(loads)).alias("_load"))
    place = (F.when(F.col("_load.load_id") == "L1", F.lit("Old hall"))
              .otherwise(F.concat(F.lit("Hall "), (F.col("team") % 3).cast("string"))))
    rows = _ev_activity_rows(act.withColumn("_place", place), bucket_hours, F.col("_place"), keep=["_load"])
    return rows.select(*[c for c in rows.columns if c != "_load"], "_load.load_id", "_load.load_timestamp")


def ev_raw_presence(events: DataFrame, bucket_hours: int = 1, loads: tuple[str, ...] = ("L1", "L2"), parts: int | None = None) -> DataFrame:
    """Nested presence: per activity one group holding leaders (type 2) and
    participants (everyone else), each sorted by person id."""
    att = ev_attendance(events, bucket_hours, parts)
    u, b = F.col("user_id"), F.col("bucket")
    mtype = member_type_of(u, b)
    birth_year = F.lit(2024) - (F.lit(5) + u % 24)
    persons = att.select("schedule_id", mtype.alias("t"),
                         _person(u, mtype, F.col("team"), birth_year).alias("p"))
    nested = (persons.groupBy("schedule_id")
              .agg(F.sort_array(F.collect_list(F.when(F.col("t") == 2, F.col("p")))).alias("leaders"),
                   F.sort_array(F.collect_list(F.when(F.col("t") != 2, F.col("p")))).alias("participants"))
              .select(F.col("schedule_id").alias("scheduleId"),
                      F.array(F.struct("leaders", "participants")).alias("teamPresenceGroups")))
    return (nested.select("*", F.explode(_load_stamps(loads)).alias("_load"))
                  .select("scheduleId", "teamPresenceGroups", "_load.load_id", "_load.load_timestamp"))


# ---------------------------------------------------------------- OR adapter

def _or_days(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("o_orderdate").isNotNull() & F.col("o_custkey").isNotNull()).select(
        F.unix_date(F.to_date("o_orderdate")).cast("bigint").alias("d"), "o_custkey")


def or_raw_activity(orders: DataFrame) -> DataFrame:
    """One activity per order day: id = epoch day, 18:00-19:00 local,
    a training (type 1) on every third day, otherwise a match (7)."""
    days = _or_days(orders).select("d").distinct()
    d = F.col("d")
    return _stamp(days.select(
        F.lit(0).cast("bigint").alias("teamId"),
        d.alias("scheduleId"),
        F.lit(None).cast("string").alias("username"),
        F.date_from_unix_date(d.cast("int")).cast("string").alias("scheduleDate"),
        F.lit("18:00").alias("startTime"),
        F.lit("19:00").alias("endTime"),
        F.when(d % 3 == 0, F.lit(1)).otherwise(F.lit(7)).cast("bigint").alias("eventTypeId"),
        F.lit("Home").alias("place"),
        F.lit(True).alias("isHomeFacility"),
        F.lit(None).cast("bigint").alias("opponentClubId"),
        F.lit(None).cast("string").alias("opponent"),
        F.lit(None).cast("bigint").alias("resultId"),
        F.lit(None).cast("bigint").alias("goalsFor"),
        F.lit(None).cast("bigint").alias("goalsAgainst"),
        F.lit(None).cast("bigint").alias("seasonId"),
        F.lit(None).cast("string").alias("scheduleText"),
        F.lit(None).cast("string").alias("scheduleInfo"),
    ), "L0", L2_TIMESTAMP)


def or_persons(orders: DataFrame) -> DataFrame:
    """Flat presence rows (schedule_id, p) = distinct (order day, customer).

    Customers ending in 4 are players born in 2014 (the retention cohort);
    others are born 2005-2013."""
    c = F.col("o_custkey")
    birth_year = F.when(c % 10 == 4, F.lit(2014)).otherwise(F.lit(2005) + c % 9)
    mtype = member_type_of(c)
    return (_or_days(orders).distinct()
            .select(F.col("d").alias("schedule_id"),
                    _person(c, mtype, F.lit(0), birth_year).alias("p")))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
