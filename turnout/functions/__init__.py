"""Column-level helpers (all JVM-side built-in expressions)."""

from .text import (activity_edit_url, activity_id_from_url, attendance_id, html_hash, is_match_url,
                   is_team_url, presence_url, pseudonym, regexp_first, short_snippet, site_url,
                   swedish_month, SWEDISH_MONTHS)
from .time import (calendar_age, cohort_flag, day_text_of_seconds, end_instant, epoch_seconds_ntz,
                   hhmm_of_seconds, local_day, local_instant, minutes_between, week_start)
from pyspark.sql import functions as _F


def label(code, mapping: dict):
    """Name of a code from a small fixed lookup; NULL for unknown or NULL codes.
    A literal map inside the expression: no join, no broadcast, codegen'd."""
    code = _F.col(code) if isinstance(code, str) else code
    pairs = [x for k, v in sorted(mapping.items()) for x in (_F.lit(k), _F.lit(v))]
    return _F.try_element_at(_F.create_map(*pairs), code.cast("bigint"))


def safe_pct(num, den, digits: int = 1):
    """100 * num / den rounded half away from zero; NULL when den is 0 or NULL."""
    num = _F.col(num) if isinstance(num, str) else num
    den = _F.col(den) if isinstance(den, str) else den
    return _F.round(_F.try_divide(num.cast("double"), den.cast("double")) * 100, digits)


__all__ = [n for n in dir() if not n.startswith("_")]
