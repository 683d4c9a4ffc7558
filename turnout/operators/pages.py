"""Page extraction: links, team filter, activity ids and URLs, page evidence,
authentication, and the presence/activity payloads embedded in pages.

Structure is read JVM-side: tags and scripts are cut out by regular expressions that
skip comments and quoted text, nesting is a fold over the tags.  Payloads are JavaScript
object literals, written as JSON from their tokens (functions/script.py) and
read by Spark's JSON reader, which ignores what follows the literal.  One
step runs as an Arrow-batched function: resolving relative URLs (RFC 3986).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import (activity_edit_url, activity_id_from_url, html_hash, is_match_url, is_team_url,
                         presence_url, short_snippet)
from ..functions.html import INSIDE, attribute, children, computed, decode_references, head_scripts, once, tags, without_comments
from ..functions.script import assignments, calls, literal, tokens


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


# ------------------------------------------------------------------ links

def extract_links(pages: DataFrame, parent_tag: str = "td", link_class: str | None = "invisible-link") -> DataFrame:
    """Hrefs of the ``<a>`` elements directly inside a ``parent_tag`` element (optionally
    with exactly this class attribute), in document order, duplicates kept:
    (page_id, url, pos, href).  A page without such links yields no rows."""
    anchors = children("html", parent_tag, "a")
    found = F.transform(anchors, lambda a: F.struct(attribute(a, "href").alias("href"), attribute(a, "class").alias("cls")))
    kept = F.filter(found, lambda x: x["href"].isNotNull() & (F.lit(True) if link_class is None else x["cls"].eqNullSafe(F.lit(link_class))))
    return pages.select("page_id", "url", F.posexplode(F.transform(kept, lambda x: x["href"])).alias("pos", "href"))


@F.pandas_udf(T.StringType())
def resolve_url(base: pd.Series, href: pd.Series) -> pd.Series:
    """Resolve a (relative) link against its page URL."""
    from urllib.parse import urljoin
    return pd.Series([None if b is None or h is None else urljoin(b, h) for b, h in zip(base, href)],
                     dtype=object)


def split_team_links(links: DataFrame, team_slug: str) -> DataFrame:
    """Flag links of the team (``/{slug}/`` in the href): adds ``kept``."""
    return links.withColumn("kept", is_team_url("href", team_slug))


def team_link_counts(links: DataFrame, team_slug: str) -> DataFrame:
    """Per page: links, kept (team) and removed (other) counts."""
    s = split_team_links(links, team_slug)
    return s.groupBy("page_id").agg(F.count(F.lit(1)).alias("total_links"),
                                    F.count_if("kept").alias("kept"),
                                    F.count_if(~F.col("kept")).alias("removed"))


def activity_requests(links: DataFrame, domain: str, team_slug: str) -> DataFrame:
    """Kept team links -> activity id, match flag, presence and edit URLs."""
    kept = split_team_links(links, team_slug).where("kept")
    aid = activity_id_from_url("href")
    return kept.select("page_id", "pos", "href", aid.alias("activity_id"), is_match_url("href").alias("is_match"),
                       presence_url(aid, domain, team_slug).alias("presence_url"),
                       activity_edit_url(aid, is_match_url("href"), domain, team_slug).alias("activity_url"))


# ------------------------------------------------------------------ evidence

def page_title(html="html") -> Column:
    t = F.regexp_extract(without_comments(html), r"(?is)<title\b[^>]*>(.*?)</title>", 1)
    return _strip(decode_references(t))


def canonical_link(html="html") -> Column:
    """href of the first ``<link rel="canonical">`` that has one."""
    links = F.transform(tags(without_comments(html), "link"), lambda a: F.struct(attribute(a, "rel").alias("rel"), attribute(a, "href").alias("href")))
    return F.get(F.filter(links, lambda x: (x["rel"] == "canonical") & x["href"].isNotNull()), 0)["href"]


def _forms(html) -> Column:
    """(attribute text, inside) of every form."""
    text = without_comments(html)
    whole = F.regexp_extract_all(text, F.lit(rf"(?is)(<form(?=[\s>]){INSIDE}>.*?)(?=</form\s*>|$(?![\s\S]))"), F.lit(1))
    return F.transform(whole, lambda f: F.struct(F.regexp_extract(f, rf"(?is)^<form{INSIDE}>", 1).alias("a"), f.alias("b")))


def forms(html="html", max_forms: int = 5, max_inputs: int = 8) -> Column:
    """First ``max_forms`` forms: action, method and the first ``max_inputs`` input names."""
    def names(body: Column) -> Column:
        return F.slice(F.filter(F.transform(tags(body, "input"), lambda i: attribute(i, "name")), lambda n: n.isNotNull()), 1, max_inputs)
    return F.transform(F.slice(_forms(html), 1, max_forms), lambda f: F.struct(
        attribute(f["a"], "action").alias("action"), attribute(f["a"], "method").alias("method"), names(f["b"]).alias("input_names")))


def login_form_count(html="html") -> Column:
    """Forms with an input named UserName, one whose name holds Pass, or one of
    type password (names and values as written, upper and lower case differ)."""
    def login(i: Column) -> Column:
        name = F.coalesce(attribute(i, "name"), F.lit(""))
        return (name == "UserName") | F.contains(name, F.lit("Pass")) | attribute(i, "type").eqNullSafe(F.lit("password"))
    return F.size(F.filter(_forms(html), lambda f: F.exists(tags(f["b"], "input"), login))).cast("bigint")


def page_evidence(pages: DataFrame) -> DataFrame:
    return pages.select(
        "page_id", "url",
        page_title().alias("title"),
        canonical_link().alias("canonical"),
        F.contains(F.col("html"), F.lit("Logga ut")).alias("has_logout"),
        login_form_count().alias("login_form_count"),
        F.length("html").cast("bigint").alias("html_len"),
        html_hash("html").alias("html_sha256"),
        forms().alias("forms"),
    )


def _auth_flags(pages: DataFrame):
    has_logout = F.coalesce(F.contains(F.col("html"), F.lit("Logga ut")), F.lit(False))
    is_login = F.coalesce(F.contains(F.lower(F.col("url")), F.lit("logga-in")), F.lit(False))
    status_ok = F.coalesce(F.col("status") < 400, F.lit(True)) if "status" in pages.columns else F.lit(True)
    return has_logout, is_login, status_ok


def page_auth(pages: DataFrame) -> DataFrame:
    """Authenticated = the page shows "Logga ut" and its URL is not the login
    page; ``status_ok`` = HTTP status below 400 (true when no status is kept)."""
    has_logout, is_login, status_ok = _auth_flags(pages)
    return pages.select("page_id", has_logout.alias("has_logout"), is_login.alias("is_login_url"),
                        (has_logout & ~is_login).alias("authenticated"), status_ok.alias("status_ok"))


def reject_reason(pages: DataFrame, require_login: Column | bool = True) -> Column:
    """Why a page is refused, NULL when it is accepted: an error status (any
    page), or no sign of a login (pages for which ``require_login`` holds)."""
    has_logout, is_login, status_ok = _auth_flags(pages)
    needs = require_login if isinstance(require_login, Column) else F.lit(require_login)
    return (F.when(~status_ok, F.lit("error status")).when(needs & ~(has_logout & ~is_login), F.lit("not authenticated")))


def accepted_pages(pages: DataFrame, require_login: Column | bool = True) -> DataFrame:
    """Pages that pass the guards."""
    return pages.where(reject_reason(pages, require_login).isNull())


def rejected_pages(pages: DataFrame, require_login: Column | bool = True) -> DataFrame:
    """(page_id, url, reason) of the pages that do not."""
    return pages.select("page_id", "url", reject_reason(pages, require_login).alias("reason")).where("reason IS NOT NULL")


def require_accepted(pages: DataFrame, require_login: Column | bool = True) -> DataFrame:
    """Pass pages through, failing the job on a page that is refused (the
    crawler's guard)."""
    why = reject_reason(pages, require_login)
    bad = F.raise_error(F.concat(F.lit("page rejected: page_id="), F.col("page_id").cast("string"), F.lit(", "), why))
    return pages.where(F.when(why.isNull(), F.lit(True)).otherwise(bad.cast("boolean")))


# ------------------------------------------------------------------ payloads

JSON_OPTIONS = {"allowBackslashEscapingAnyCharacter": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
def _literal(text: Column, schema: T.StructType) -> Column:
    """The object literal at the start of a JSON text, ``_corrupt`` set when it does
    not parse or does not fit."""
    return F.from_json(text, T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())]), JSON_OPTIONS)


def presence_scan(pages: DataFrame) -> DataFrame:
    """Per page: the number of head scripts, and of the scripts that assign an
    ``initData`` literal the first that parses, or else the first at all (an assignment
    inside brackets is none that can be read):
    (page_id, url, n_head_scripts, n_candidates, script_index, r)."""
    def candidate(script: Column, i: Column) -> Column:
        return once(tokens(script), lambda ts: once(assignments(ts, "initData"), lambda a: F.struct(
            i.alias("i"), a["any"].isNotNull().alias("named"), F.when(a["top"].isNull(), "").otherwise(literal(ts, a["top"])).alias("s"))))
    # a script without the name is not cut into tokens
    named = F.transform("scripts", lambda s, i: F.when(F.contains(s, F.lit("initData")), candidate(s, i)))
    pre = (pages.select("page_id", "url", computed(head_scripts("html")).alias("scripts"))
           .select("page_id", "url", F.size("scripts").cast("bigint").alias("n_head_scripts"), computed(F.filter(named, lambda c: c["named"])).alias("c")))
    parsed = F.transform("c", lambda c: F.struct(c["i"].alias("i"), F.when(c["s"] != "", _literal(c["s"], schemas.PRESENCE_PAYLOAD)).alias("r")))
    best = once(parsed, lambda p: F.coalesce(F.get(F.filter(p, lambda x: x["r"].isNotNull() & x["r"]["_corrupt"].isNull()), 0), F.get(p, 0)))
    return (pre.select("page_id", "url", "n_head_scripts", F.size("c").alias("n_candidates"), computed(best).alias("_best"))
            .select("page_id", "url", "n_head_scripts", "n_candidates", F.col("_best.i").alias("script_index"), F.col("_best.r").alias("r")))


def _same(df: DataFrame) -> DataFrame:
    return df


def extract_presence(pages: DataFrame, keep=_same) -> tuple[DataFrame, DataFrame]:
    """(records, rejects): presence payloads read with the declared schema, and
    pages without an ``initData`` literal or with one that does not parse or fit.
    ``keep`` may store the parsed pages, so that both read them and no page is parsed twice."""
    scan = keep(presence_scan(pages))
    good = F.col("r").isNotNull() & F.col("r._corrupt").isNull()
    rec = scan.where(good).select("page_id", "r.*").drop("_corrupt")
    reason = F.when(F.col("n_candidates") == 0, F.lit("initData not found")).otherwise(F.lit("initData not readable"))
    return rec, scan.where(~good).select("page_id", "url", reason.alias("reason"))


def body_init(html="html") -> Column:
    """Decoded ``data-ng-init`` of the body tag."""
    return attribute(F.get(tags(without_comments(html), "body"), 0), "data-ng-init")


def extract_activity(pages: DataFrame, keep=_same) -> tuple[DataFrame, DataFrame]:
    """(records, rejects): one activity record per top-level call in the body's
    ``data-ng-init`` (its first argument), and pages lacking it or with a call
    that is not readable (all calls of such a page are refused)."""
    init = F.col("init")

    def read(ts: Column, found: Column) -> Column:
        return F.transform(found, lambda c: F.struct(c["callee"].alias("callee"), _literal(literal(ts, c["place"]), schemas.ACTIVITY_PAYLOAD).alias("r")))
    found = once(tokens(init), lambda ts: once(calls(ts), lambda c: F.when(F.get(c, 0)["start"] == 0, read(ts, c))))
    scan = (pages.select("page_id", "url", computed(body_init()).alias("init")).select("page_id", "url", "init", computed(found).alias("calls")))
    scan = keep(scan)
    bad = F.col("calls").isNull() | F.exists("calls", lambda c: c["r"].isNull() | c["r"]["_corrupt"].isNotNull())
    rec = (scan.where(~bad).select("page_id", F.explode("calls").alias("z"))
           .select("page_id", "z.callee", "z.r.*").drop("_corrupt"))
    reason = F.when(F.trim(F.coalesce(init, F.lit(""))) == "", F.lit("data-ng-init missing")).otherwise(F.lit("data-ng-init not readable"))
    return rec, scan.where(bad).select("page_id", "url", reason.alias("reason"))


# ------------------------------------------------------------------ reports over the driver pages

NAV_PARENT = "li"          # the driver pages list their links as <li><a href=...>
DEMO_SLUG = "en"
DEMO_DOMAIN = "www.example-club.se"


def page_links_report(pages: DataFrame) -> DataFrame:
    links = extract_links(pages, NAV_PARENT, None)
    aid = activity_id_from_url("href")
    return links.select("page_id", F.col("pos").cast("bigint").alias("pos"), "href",
                        resolve_url(F.col("url"), F.col("href")).alias("link_url"),
                        aid.alias("activity_id"), is_match_url("href").alias("is_match"),
                        presence_url(aid, DEMO_DOMAIN, DEMO_SLUG).alias("presence_url"),
                        activity_edit_url(aid, is_match_url("href"), DEMO_DOMAIN, DEMO_SLUG).alias("activity_url"))


def team_link_counts_report(pages: DataFrame) -> DataFrame:
    return team_link_counts(extract_links(pages, NAV_PARENT, None), DEMO_SLUG)


def page_digest(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", html_hash("html").alias("html_sha256"),
                        short_snippet("html").alias("snippet"),
                        F.length("html").cast("bigint").alias("html_len"))


def page_evidence_report(pages: DataFrame) -> DataFrame:
    e = page_evidence(pages)
    return e.select("page_id", "title", "canonical", "has_logout", "login_form_count", "html_len",
                    F.size("forms").cast("bigint").alias("n_forms"))


def presence_scan_report(pages: DataFrame) -> DataFrame:
    return presence_scan(pages).select("page_id", "n_head_scripts", (F.col("n_candidates") > 0).alias("has_init_data"))
