"""The crawler's data path as one Spark job over captured pages.

Calendar pages -> guards (status, login) -> activity links -> team filter ->
presence and activity-edit request URLs; presence and activity pages -> status
guard -> payload records -> load stamp -> raw tables.  Fetching is not part of
this engine: pages arrive as a table (page_id, url, html[, status]).

    python -m turnout.plans.extract --pages PATH --out DIR --domain D --slug S [--replace]
"""

from __future__ import annotations

import argparse
import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import pages as pg
from ..session import scratch_path, spread
from ..sources import sinks
from ..sources.sinks import new_load_stamp, stamp_load


def page_kind(url="url"):
    u = F.col(url) if isinstance(url, str) else url
    return (F.when(u.contains("/controlpanel/presence/"), F.lit("presence"))
             .when(u.contains("/redigera"), F.lit("activity")).otherwise(F.lit("calendar")))


class Extracted:
    """What the pages hold; a kind of pages is planned, and kept, when it is first asked for."""

    def __init__(self, pages: DataFrame, domain: str, team_slug: str, load_id: str, load_timestamp: dt.datetime,
                 link_parent: str, link_class: str | None, keep):
        self._pages, self._site, self._stamp = pages, (domain, team_slug), (load_id, load_timestamp)
        self._link, self._keep = (link_parent, link_class), keep
        self._login = page_kind() == "calendar"           # only calendar pages show the login

    def _typed(self, kind: str) -> DataFrame:
        return spread(pg.accepted_pages(self._pages, self._login).where(page_kind() == kind))

    def _kept(self, kind: str):
        return (lambda df: self._keep(kind, df)) if self._keep else (lambda df: df)

    @cached_property
    def _activity(self) -> tuple[DataFrame, DataFrame]:
        return pg.extract_activity(self._typed("activity"), self._kept("activity"))

    @cached_property
    def _presence(self) -> tuple[DataFrame, DataFrame]:
        return pg.extract_presence(self._typed("presence"), self._kept("presence"))

    @cached_property
    def requests(self) -> DataFrame:
        """page_id, pos, href, activity_id, is_match, presence_url, activity_url"""
        return pg.activity_requests(pg.extract_links(self._typed("calendar"), *self._link), *self._site)

    @cached_property
    def raw_activity(self) -> DataFrame:
        """RAW_ACTIVITY rows (stamped)"""
        return stamp_load(self._activity[0].drop("page_id", "callee"), *self._stamp)

    @cached_property
    def raw_presence(self) -> DataFrame:
        """RAW_PRESENCE rows (stamped)"""
        return stamp_load(self._presence[0].drop("page_id"), *self._stamp)

    @cached_property
    def rejects(self) -> DataFrame:
        """page_id, url, reason"""
        return pg.rejected_pages(self._pages, self._login).unionByName(self._presence[1]).unionByName(self._activity[1])


def extract(pages: DataFrame, domain: str, team_slug: str, load_id: str | None = None,
            load_timestamp: dt.datetime | None = None, link_parent: str = "td",
            link_class: str | None = "invisible-link", keep=None) -> Extracted:
    """Lazy plans; ``keep(name, df)`` may store the parsed payload pages.  Pages are
    dealt evenly before they are parsed, in whatever files they come."""
    if load_id is None or load_timestamp is None:
        load_id, load_timestamp = new_load_stamp()
    return Extracted(pages, domain, team_slug, load_id, load_timestamp, link_parent, link_class, keep)


def ingest(pages: DataFrame, domain: str, team_slug: str, out: str, append: bool = True,
           load_id: str | None = None, load_timestamp: dt.datetime | None = None) -> dict[str, int]:
    """Extract and write: raw tables (one load, appended or replacing), the
    request URLs and the rejects under ``out``; returns the rows written.  A
    run whose activity or presence payload is empty writes no raw table.  Payload
    pages are parsed once, into a scratch folder that the records and rejects are read from."""
    spark = pages.sparkSession
    ex = extract(pages, domain, team_slug, load_id, load_timestamp, keep=lambda name, df: sinks.materialize(df, scratch_path(spark, f"parsed-{name}")))
    ex.requests.write.mode("overwrite").parquet(f"{out}/requests")
    ex.rejects.write.mode("overwrite").parquet(f"{out}/rejects")
    sinks.require_non_empty(activity=ex.raw_activity, presence=ex.raw_presence)
    write = sinks.append_load if append else sinks.replace_table
    return {"raw_activity": write(ex.raw_activity, f"{out}/raw_activity"), "raw_presence": write(ex.raw_presence, f"{out}/raw_presence")}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    for name in ("--pages", "--out", "--domain", "--slug"):
        ap.add_argument(name, required=True)
    ap.add_argument("--replace", action="store_true", help="replace the raw tables by this load")
    a = ap.parse_args(argv)
    from ..session import get_session
    spark = get_session()
    print(ingest(spark.read.parquet(a.pages), a.domain, a.slug, a.out, append=not a.replace))


if __name__ == "__main__":
    main()
