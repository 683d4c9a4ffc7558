"""Relational operators, one module per model family."""

from . import activities, grants, latest, members, participation, quality, retention, staging  # noqa: F401
from .activities import activity, attended_activity, export_all, headcounts
from .grants import activity_ordinals, eligible_activities, municipal_grant, state_grant
from .latest import latest_per_key
from .members import member
from .participation import available_trainings, training_participation
from .quality import run_checks
from .retention import daily_activity_counts, member_day_metrics, player_status
from .staging import explode_presence, latest_load, stage_persons, stg_activity, stg_presence

__all__ = [n for n in dir() if not n.startswith("_")]
