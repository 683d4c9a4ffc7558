"""Staging: newest load batch, flat activity rows, unnested presence rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..config import Config
from ..functions import regexp_first

CUP_GAMES_PATTERN = r"\[matcher=([^\]]+)\]"


def latest_load(raw: DataFrame, newest: str | None = None) -> DataFrame:
    """Rows of the newest load batch (greatest load_timestamp; ties go to the
    greatest load_id).

    With ``newest`` (its id, from a raw table's ledger) the filter prunes the scan's partitions
    and no other load is looked at.  Without, the id is a scalar subquery over the load columns.
    """
    return raw.where(F.col("load_id") == (newest_load_id(raw).scalar() if newest is None else F.lit(newest)))


def newest_load_id(raw: DataFrame) -> DataFrame:
    """One row: the load_id of the newest batch (ties: greatest load_id)."""
    return raw.select(F.max_by("load_id", F.struct("load_timestamp", "load_id")).alias("load_id"))


def loads_agree(raw_activity: DataFrame, raw_presence: DataFrame) -> DataFrame:
    """One row (activity_load_id, presence_load_id, agree): the two raw tables
    choose their newest batch independently; this reports whether they match."""
    tagged = (raw_activity.select(F.lit("a").alias("t"), "load_id", "load_timestamp")
              .unionByName(raw_presence.select(F.lit("p").alias("t"), "load_id", "load_timestamp")))

    def newest(tag: str):
        mine = F.col("t") == tag
        return F.max_by(F.when(mine, F.col("load_id")), F.when(mine, F.struct("load_timestamp", "load_id")))

    out = tagged.agg(newest("a").alias("activity_load_id"), newest("p").alias("presence_load_id"))
    return out.withColumn("agree", F.coalesce(F.col("activity_load_id") == F.col("presence_load_id"), F.lit(False)))


def stg_activity(raw: DataFrame, cfg: Config, newest: str | None = None) -> DataFrame:
    src = latest_load(raw, newest) if cfg.latest_load_only else raw
    common = [
        F.col("teamId").alias("team_id"),
        F.col("scheduleId").alias("schedule_id"),
        F.col("username"),
        F.col("scheduleDate").alias("schedule_date"),
        F.col("startTime").alias("start_time"),
        F.col("endTime").alias("end_time"),
    ]
    mid = [F.col("place"), F.col("isHomeFacility").alias("is_home_facility"),
           F.col("opponentClubId").alias("opponent_club_id"), F.col("opponent")]
    tail = [F.col("goalsFor").alias("goals_for"), F.col("goalsAgainst").alias("goals_against")]
    if cfg.is_local:
        return src.select(*common, F.col("eventTypeId").alias("event_type_id"), *mid,
                          F.col("resultId").alias("result_id"), *tail)
    return src.select(
        *common, F.col("eventTypeId").alias("activity_type_id"), *mid,
        F.col("resultId").alias("result_type_id"), *tail,
        F.col("seasonId").alias("season_id"),
        F.col("scheduleText").alias("schedule_text"),
        F.col("scheduleInfo").alias("schedule_info"),
        regexp_first("scheduleInfo", CUP_GAMES_PATTERN).cast("bigint").alias("cup_nr_of_games"),
    )


def explode_presence(raw: DataFrame) -> DataFrame:
    """(schedule_id, p): leaders then participants of the FIRST presence group.

    A missing, null or empty group list, or a null list of people, yields no
    rows.  Written as two unnests + UNION ALL so each branch prunes the nested
    fields it reads.
    """
    first = F.get(F.col("teamPresenceGroups"), 0)
    def people(kind: str) -> DataFrame:
        rows = raw.select(F.col("scheduleId").alias("schedule_id"), F.explode(first.getField(kind)).alias("p"))
        # a load may give one of the lists fields that the other has not
        return rows.select("schedule_id", F.struct(*[F.col("p").getField(f).alias(f) for f in schemas.PERSON.names]).alias("p"))
    return people("leaders").unionByName(people("participants"))


def stage_persons(persons: DataFrame, cfg: Config) -> DataFrame:
    """Flat person-in-activity columns from (schedule_id, p)."""
    p = F.col("p")
    cols = [
        p.getField("id").alias("id"),
        F.col("schedule_id"),
        p.getField("firstName").alias("first_name"),
        p.getField("lastName").alias("last_name"),
        p.getField("userId").alias("user_id"),
        p.getField("teamName").alias("team_name"),
        p.getField("inactivatedDate").alias("inactivated_at"),
        p.getField("stats").getField("star").alias("stats_star"),
        p.getField("birthDate").cast("date").alias("date_of_birth"),
    ]
    if cfg.is_local:
        cols += [p.getField("isLeader").alias("is_leader"), p.getField("isPlayer").alias("is_player")]
    cols.append(p.getField("memberTypeId").alias("member_type_id"))
    return persons.select(*cols)


def stg_presence(raw: DataFrame, cfg: Config, newest: str | None = None) -> DataFrame:
    src = latest_load(raw, newest) if cfg.latest_load_only else raw
    return stage_persons(explode_presence(src), cfg)
