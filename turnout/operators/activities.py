"""Activity dimension, attendance bridge, headcounts and the wide export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions import attendance_id, end_instant, label, local_instant, minutes_between
from ..sources.seeds import labels
from .members import member_type_col


def attended_activity(stg_presence: DataFrame, cfg: Config) -> DataFrame:
    """One row per person row of presence (duplicates kept, as staged)."""
    style = "hex" if cfg.is_local else "json_base64"
    return stg_presence.select(
        attendance_id("schedule_id", "user_id", style).alias("attendance_id"),
        F.col("schedule_id").alias("activity_id"),
        F.col("user_id").alias("member_id"),
    )


def headcounts(stg_presence: DataFrame, member: DataFrame, cfg: Config) -> DataFrame:
    """Players, leaders and parents per activity by each person's latest member type."""
    mt = member_type_col(cfg)
    m = member.select(F.col("member_id").alias("user_id"), F.col(mt).alias("_type"))
    j = stg_presence.select("schedule_id", "user_id").join(m, "user_id", "left")

    def n(label: str):
        return F.sum(F.when(F.col("_type") == label, 1).otherwise(0)).cast("bigint")

    return j.groupBy(F.col("schedule_id").alias("activity_id")).agg(
        n("Player").alias("players_attended"),
        n("Leader").alias("leader_attended"),
        n("Parent").alias("parents_attended"),
    )


def activity(stg_activity: DataFrame, cfg: Config, stg_presence: DataFrame | None = None,
             member: DataFrame | None = None, lookups: dict[str, dict[int, str]] | None = None) -> DataFrame:
    """Activities with labels, start/end instants and duration.

    The warehouse family also carries the season, the cup game count and the
    headcounts per member type (needs ``stg_presence`` and ``member``).
    """
    type_col = "event_type_id" if cfg.is_local else "activity_type_id"
    result_col = "result_id" if cfg.is_local else "result_type_id"
    lk = lookups or {"activity_types": labels("activity_types"), "result_types": labels("result_types")}
    a = stg_activity.withColumns({"_type_name": label(type_col, lk["activity_types"]),
                                  "_result_name": label(result_col, lk["result_types"])})
    start = local_instant("schedule_date", "start_time", cfg.zone)
    end = end_instant("schedule_date", "start_time", "end_time", cfg.zone, cfg.midnight)
    a = a.withColumns({"_start": start, "_end": end})
    duration = minutes_between("_start", "_end")
    if cfg.is_local:
        return a.select(
            F.col("schedule_id").alias("activity_id"), "event_type_id",
            F.col("_type_name").alias("event_type_label"), F.col("_start").alias("start_at"),
            "place", "is_home_facility", "opponent_club_id", "opponent", "result_id",
            F.col("_result_name").alias("result_label"), "goals_for", "goals_against",
            F.col("_end").alias("end_at"), duration.alias("duration_minutes"),
        )
    out = a.select(
        F.col("schedule_id").alias("activity_id"), "activity_type_id",
        F.col("_type_name").alias("activity"), F.col("_start").alias("start_at"),
        "place", "is_home_facility", "opponent_club_id", "opponent", "result_type_id",
        F.col("_result_name").alias("result"), "goals_for", "goals_against", "season_id",
        "cup_nr_of_games", F.col("_end").alias("end_at"),
        duration.alias("duration_minutes"), (duration / 60).alias("duration_hours"),
    )
    if stg_presence is None or member is None:
        return out
    return out.join(headcounts(stg_presence, member, cfg), "activity_id", "left")


def export_all(attended: DataFrame, member: DataFrame, activity_df: DataFrame) -> DataFrame:
    """Every attendance with its member and activity columns (left joins)."""
    j = attended.join(member, "member_id", "left").join(activity_df, "activity_id", "left")
    cols = (["attendance_id", "activity_id", "member_id"]
            + [c for c in member.columns if c != "member_id"]
            + [c for c in activity_df.columns if c != "activity_id"])
    return j.select(*cols)
