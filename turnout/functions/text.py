"""Text, digest and URL Column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _id_text(x) -> Column:
    return F.coalesce(_c(x).cast("string"), F.lit(""))


def attendance_id(schedule_id, user_id, style: str) -> Column:
    """Digest of schedule id and user id concatenated without separator.

    ``hex``: 32 lower-case hex digits.  ``json_base64``: the 16 digest bytes
    in base64 inside double quotes (a JSON string of BYTES).
    """
    digest = F.md5(F.concat(_id_text(schedule_id), _id_text(user_id)))
    if style == "hex":
        return digest
    if style == "json_base64":
        return F.concat(F.lit('"'), F.base64(F.unhex(digest)), F.lit('"'))
    raise ValueError(f"unknown id style {style!r}")


def pseudonym(user_id) -> Column:
    """First 6 characters of the base64 MD5 of the id text; ``null`` for a null id."""
    return F.coalesce(F.left(F.base64(F.unhex(F.md5(_c(user_id).cast("string")))), F.lit(6)), F.lit("null"))


def regexp_first(c, pattern: str, group: int = 1) -> Column:
    """First match of a regex group, NULL when the text does not match."""
    c = _c(c)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def html_hash(c) -> Column:
    """First 12 hex digits of SHA-256 of the UTF-8 text."""
    return F.substring(F.sha2(_c(c), 256), 1, 12)


def short_snippet(c, length: int = 200) -> Column:
    """Runs of (Unicode) white space collapsed to one blank, trimmed, cut to ``length``; '' for null/empty."""
    collapsed = F.trim(F.regexp_replace(_c(c), r"(?U)\s+", " "))
    return F.coalesce(F.substring(collapsed, 1, length), F.lit(""))


def activity_id_from_url(url) -> Column:
    """Second-last ``/`` segment (``.../12345/`` -> ``12345``); NULL when absent."""
    parts = F.split(_c(url), "/", -1)
    return F.get(parts, F.size(parts) - 2)


def is_match_url(url) -> Column:
    return F.coalesce(F.contains(_c(url), F.lit("/match/")), F.lit(False))


def is_team_url(url, team_slug: str) -> Column:
    return F.coalesce(F.contains(_c(url), F.lit(f"/{team_slug}/")), F.lit(False))


def site_url(domain: str, team_slug: str, path) -> Column:
    return F.concat(F.lit(f"https://{domain}/{team_slug}/"), _c(path))


def presence_url(activity_id, domain: str, team_slug: str) -> Column:
    return site_url(domain, team_slug, F.concat(F.lit("controlpanel/presence/chooseparticipants/"), _c(activity_id)))


def activity_edit_url(activity_id, is_game, domain: str, team_slug: str) -> Column:
    path = F.when(_c(is_game), F.concat(F.lit("match/redigera/"), _c(activity_id))) \
            .otherwise(F.concat(F.lit("kalender/redigera-aktivitet/"), _c(activity_id)))
    return site_url(domain, team_slug, path)


# The Swedish month names used in calendar page URLs, January first.
SWEDISH_MONTHS = ["januari", "februari", "mars", "april", "maj", "juni",
                  "juli", "augusti", "september", "oktober", "november", "december"]


def swedish_month(d) -> Column:
    return F.get(F.array(*[F.lit(m) for m in SWEDISH_MONTHS]), F.month(_c(d)) - 1)
