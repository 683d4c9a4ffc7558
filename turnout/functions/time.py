"""Date and time Column helpers.

All of them are independent of ``spark.sql.session.timeZone``: instants are
built from wall-clock text with an explicit zone, and cut into days in an
explicit zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def local_instant(date_txt, time_txt, zone: str) -> Column:
    """``yyyy-MM-dd`` + ``HH:mm`` wall-clock text in ``zone`` -> TIMESTAMP (an instant).

    Null text gives null (never "today at that time"); malformed text fails
    the job under ANSI mode, as a cast would in the original models.
    """
    return F.concat(_c(date_txt), F.lit(" "), _c(time_txt), F.lit(f":00 {zone}")).cast("timestamp")


def end_instant(date_txt, start_txt, end_txt, zone: str, mode: str = "calendar") -> Column:
    """End of an activity.  An end time of exactly ``00:00`` means midnight
    after the schedule day; any other end keeps its own day (so 23:00 -> 01:00
    stays negative, as the models have it).

    ``calendar``: the next local midnight (23 or 25 hours after the previous
    midnight on DST days).  ``plus24h``: the instant of 00:00 on the schedule
    day plus exactly 24 hours.
    """
    end_txt = _c(end_txt)
    same_day = local_instant(date_txt, end_txt, zone)
    if mode == "plus24h":
        shifted = F.timestamp_micros(F.unix_micros(same_day) + F.lit(86_400_000_000))
    elif mode == "calendar":
        next_day = F.date_add(_c(date_txt).cast("date"), 1).cast("string")
        shifted = local_instant(next_day, end_txt, zone)
    else:
        raise ValueError(f"unknown midnight mode {mode!r}")
    return F.when(end_txt == F.lit("00:00"), shifted).otherwise(same_day)


def minutes_between(start, end) -> Column:
    """Whole minutes from ``start`` to ``end`` (elapsed time, DST-correct)."""
    return ((F.unix_seconds(_c(end)) - F.unix_seconds(_c(start))) / 60).cast("bigint")


def local_day(ts, zone: str) -> Column:
    """Calendar day of an instant in ``zone``."""
    return F.to_date(F.convert_timezone(None, F.lit(zone), _c(ts)))


def week_start(day, first_day: str) -> Column:
    """First day of the week containing DATE ``day``; weeks start on Monday or Sunday."""
    day = _c(day)
    if first_day == "monday":
        return F.date_sub(day, (F.dayofweek(day) + 5) % 7)
    if first_day == "sunday":
        return F.date_sub(day, F.dayofweek(day) - 1)
    raise ValueError(f"unknown week start {first_day!r}")


def calendar_age(date_of_birth, at_day) -> Column:
    """Age as a difference of calendar years (not completed years)."""
    return (F.year(_c(at_day)) - F.year(_c(date_of_birth))).cast("bigint")


def cohort_flag(date_of_birth, year: int) -> Column:
    """Born in ``year``; unknown birth date counts as not born in it."""
    return F.coalesce(F.year(_c(date_of_birth)) == F.lit(year), F.lit(False))


def epoch_seconds_ntz(ts) -> Column:
    """Seconds since 1970-01-01 00:00 of a TIMESTAMP_NTZ wall-clock value (no zone involved)."""
    ts = _c(ts)
    return (F.unix_date(F.to_date(ts)).cast("bigint") * 86400
            + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts))


def hhmm_of_seconds(sec) -> Column:
    """``HH:mm`` of a second-of-day count."""
    sec = _c(sec) % 86400
    return F.concat(F.lpad((sec / 3600).cast("bigint").cast("string"), 2, "0"), F.lit(":"),
                    F.lpad(((sec % 3600) / 60).cast("bigint").cast("string"), 2, "0"))


def day_text_of_seconds(sec) -> Column:
    """``yyyy-MM-dd`` of a count of seconds since the epoch (wall clock)."""
    return F.date_from_unix_date((_c(sec) / 86400).cast("int")).cast("string")
