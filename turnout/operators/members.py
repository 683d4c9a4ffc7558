"""The member dimension: each user's latest profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions import cohort_flag, label, pseudonym
from ..sources.seeds import labels
from .latest import latest_per_key

# Profile precedence: the highest schedule id wins; equal schedule ids (a user
# listed twice in one activity) go to the lower member type, then lower row id.
PROFILE_ORDER = [("schedule_id", "desc"), ("member_type_id", "asc"), ("id", "asc")]


def latest_profiles(stg_presence: DataFrame) -> DataFrame:
    return latest_per_key(stg_presence, ["user_id"], PROFILE_ORDER)


def member(stg_presence: DataFrame, cfg: Config, member_types: dict[int, str] | None = None) -> DataFrame:
    """Latest profile per user with the member-type name (from the lookup)."""
    prof = latest_profiles(stg_presence)
    names = labels("member_types") if member_types is None else member_types
    prof = prof.withColumn("_type_name", label("member_type_id", names))
    if cfg.is_local:
        deleted = F.lit("<DELETED>")
        return prof.select(
            F.col("user_id").alias("member_id"),
            F.coalesce(F.nullif("first_name", F.lit("")), deleted).alias("first_name"),
            F.coalesce(F.nullif("last_name", F.lit("")), deleted).alias("last_name"),
            "team_name", "inactivated_at", "date_of_birth", "is_leader", "is_player", "member_type_id",
            F.col("_type_name").alias("member_type_label"),
        )
    tag = pseudonym("user_id")
    first = F.coalesce(F.nullif("first_name", F.lit("")), F.concat(F.lit("FN-"), tag))
    last = F.coalesce(F.nullif("last_name", F.lit("")), F.concat(F.lit("EN-"), tag))
    return prof.select(
        F.col("user_id").alias("member_id"),
        "team_name", "inactivated_at", "date_of_birth",
        cohort_flag("date_of_birth", cfg.cohort_year).alias(cfg.cohort_flag),
        "member_type_id",
        F.col("_type_name").alias("member_type"),
        first.alias("first_name"),
        last.alias("last_name"),
        F.concat(first, F.lit(" "), last).alias("full_name"),
    )


def member_type_col(cfg: Config) -> str:
    return "member_type_label" if cfg.is_local else "member_type"
