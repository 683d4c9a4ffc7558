"""Run configuration.

Every rule that differs between the two model families (the single-file
"local" family and the "warehouse" family) is a field here, so one set of
DataFrame functions serves both.  Dates that the original models take from
the clock (today, now) are explicit: results never depend on when or in
which session time zone a job runs.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

LOCAL = "local"
WAREHOUSE = "warehouse"


@dataclass(frozen=True)
class Config:
    variant: str = WAREHOUSE
    # zone of the wall-clock schedule text (date + HH:MM) of an activity
    zone: str = "Europe/Stockholm"
    # zone in which an instant is cut into a calendar day / week (the warehouse cuts in UTC)
    day_zone: str = "Europe/Stockholm"
    # "monday" (local family) or "sunday" (warehouse family)
    week_start: str = "sunday"
    # age reference of the state grant: "activity" start or "as_of" date
    age_at: str = "as_of"
    # end time 00:00 means next local midnight ("calendar"), or end + exactly 24h ("plus24h")
    midnight: str = "calendar"
    # birth year of the cohort followed by the retention series
    cohort_year: int = 2014
    # first day of the calendar spine
    spine_start: dt.date = dt.date(2019, 1, 1)
    # "today": the calendar spine ends a year after it, the series stops before it
    as_of: dt.date = dt.date(2024, 2, 1)
    # "now": trainings that started before this instant are past (default: as_of midnight, UTC)
    now: dt.datetime | None = None
    # staging keeps only the newest load batch (accumulating raw tables)
    latest_load_only: bool = True

    @property
    def is_local(self) -> bool:
        return self.variant == LOCAL

    @property
    def now_instant(self) -> dt.datetime:
        if self.now is not None:
            return self.now
        return dt.datetime(self.as_of.year, self.as_of.month, self.as_of.day, tzinfo=dt.timezone.utc)

    @property
    def cohort_flag(self) -> str:
        return f"is_f{self.cohort_year}"

    def with_(self, **kw) -> "Config":
        return replace(self, **kw)

    @staticmethod
    def local(**kw) -> "Config":
        base = Config(variant=LOCAL, week_start="monday", age_at="activity", latest_load_only=False)
        return replace(base, **kw)

    @staticmethod
    def warehouse(**kw) -> "Config":
        base = Config(variant=WAREHOUSE, week_start="sunday", age_at="as_of", latest_load_only=True,
                      day_zone="UTC", midnight="plus24h")
        return replace(base, **kw)
