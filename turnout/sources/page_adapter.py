"""Captured club pages derived from ``events``: calendar, presence and activity
pages as the page extraction reads them, with the faults that it must survive.

Every activity of the EV adapter has a presence page and an edit page, every team
and day a calendar page.  By fixed rules (below) some pages lack their payload,
hold one of a wrong type, have an error status or are the login page.  The text is
built with SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import adapters as ad

DOMAIN = "www.example-club.se"
SLUG = "team-0"

# Which pages are faulty, by hour bucket, or by day plus team.
NO_INIT, BAD_STATUS, BAD_TYPE, HOURS = 0, 1, 2, 11   # presence: bucket % 11
NO_NG_INIT = 13                                      # activity: bucket % 13 = 0
LOGIN_PAGE = 17                                      # calendar: (day + team) % 17 = 0
DAY_SECONDS = 86400


def _unquoted(json):
    """JSON text as a JavaScript literal: names without quotes."""
    return F.regexp_replace(json, r'"([A-Za-z]+)":', "$1:")


def _parts(events: DataFrame) -> int:
    return int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def presence_pages(events: DataFrame) -> DataFrame:
    raw = ad.ev_raw_presence(events, 1, ("L2",), _parts(events)).drop("load_id", "load_timestamp")
    sid = F.col("scheduleId")
    bucket = F.expr(f"scheduleId div {ad.TEAM_SPAN}")
    fault = bucket % HOURS
    literal = _unquoted(F.to_json(F.struct("scheduleId", "teamPresenceGroups")))
    literal = F.when(fault == BAD_TYPE, F.regexp_replace(literal, "scheduleId: ?", "scheduleId:'x6',was:")).otherwise(literal)
    # a name of Swedish letters, a trailing comma
    literal = F.regexp_replace(literal, "\\}$", ", \u00e5lder: 1,}")
    before = (F.when(bucket % 3 == 0, F.lit("<script>var broken = {a: ; var initData = {scheduleId: 1, oops</script>"))
              .when(bucket % 3 == 1, F.lit('<script src="/x.js"></script>')).otherwise(F.lit("<!-- <script>var initData = {scheduleId: 1};</script> -->")))
    # what looks like the assignment in a comment, in a string and after it; a blank in the end tag
    script = F.when(fault == NO_INIT, F.lit("<script>var other = 1;</script>")).otherwise(F.concat(
        F.lit("<script>\n// initData = {scheduleId: 8}\nvar s = 'initData = {scheduleId: 7}'; /* initData = {} */ var initData = /* now */ "), literal,
        F.lit("; var other = \"</head> initData = {\";</script >")))
    html = F.concat(F.lit("<html><head><title>N&auml;rvaro</title>"), before, script, F.lit("</head><body><p>list</p></body></html>"))
    return raw.select((sid * 4 + 1).alias("page_id"), F.concat(F.lit(f"https://{DOMAIN}/{SLUG}/controlpanel/presence/chooseparticipants/"), sid.cast("string")).alias("url"),
                      html.alias("html"), F.when(fault == BAD_STATUS, 503).otherwise(200).alias("status"))


def activity_pages(events: DataFrame) -> DataFrame:
    raw = ad.ev_raw_activity(events, 1, ("L2",), _parts(events)).drop("load_id", "load_timestamp")
    sid = F.col("scheduleId")
    bucket = F.expr(f"scheduleId div {ad.TEAM_SPAN}")
    # brackets, commas and quotes that belong to strings; a number and a text in other spellings
    json = F.to_json(F.struct(*raw.columns))
    json = F.regexp_replace(json, '"place":"Hall', '"place":"Ha"+ "ll')
    json = F.regexp_replace(json, '"scheduleId":([0-9]+)', F.concat(F.lit('"scheduleId":0x'), F.hex(sid)))
    json = F.regexp_replace(json, "\\}$", ',"note":"[a,] ,} x: undefined; go({y",}')
    double = F.concat(F.lit('"init('), F.replace(json, F.lit('"'), F.lit("&quot;")), F.lit(', &quot;x; go({y&quot;); done()"'))
    single = F.concat(F.lit("'/* c */ init("), json, F.lit(", 5); done()'"))
    attr = F.when(bucket % NO_NG_INIT == 0, F.lit("")).otherwise(F.concat(F.lit(" data-ng-init="), F.when(bucket % 2 == 0, single).otherwise(double)))
    html = F.concat(F.lit("<html><head></head>\n<body class='x'"), attr, F.lit(">form</body></html>"))
    return raw.select((sid * 4 + 2).alias("page_id"), F.concat(F.lit(f"https://{DOMAIN}/{SLUG}/kalender/redigera-aktivitet/"), sid.cast("string")).alias("url"),
                      html.alias("html"), F.lit(200).alias("status"))


def calendar_pages(events: DataFrame) -> DataFrame:
    """One page a team and day.  Activities stand two to a cell in order of
    start; a comment repeats a link, a link of another class and one without
    href are no activity links."""
    acts = ad.ev_attendance(events, 1).select("bucket", "team", "schedule_id").distinct()
    day = F.expr("bucket div 24")
    match = ad._pick(ad.EVENT_TYPE_CYCLE, F.col("bucket") % 9) == 7
    href = F.concat(F.lit("/team-"), F.col("team").cast("string"), F.when(match, F.lit("/match/")).otherwise(F.lit("/kalender/aktivitet/")), F.col("schedule_id").cast("string"), F.lit("/"))
    hrefs = acts.groupBy("team", day.alias("day")).agg(F.transform(F.sort_array(F.collect_list(F.struct("bucket", href.alias("h")))), lambda x: x["h"]).alias("h"))
    anchor = F.transform("h", lambda h, i: F.concat(
        F.when(i % 2 == 0, F.lit("<td><span>x</span>")).otherwise(F.lit("")),
        F.when(i % 3 == 0, F.concat(F.lit("<a class='invisible-link' data-href='/no/' href='"), h, F.lit("'>a</a>")))
        .otherwise(F.concat(F.lit('<a title="x > y" href="'), h, F.lit('" class="invisible-link">a</a>'))),
        F.when(i % 2 == 1, F.lit("</td>")).otherwise(F.lit(""))))
    cells = F.concat(F.array_join(anchor, ""), F.lit("<!-- <td><a class=\"invisible-link\" href=\"/team-0/kalender/aktivitet/9/\">c</a></td> -->"),
                     F.lit("<td><div><a class=\"invisible-link\" href=\"/team-0/kalender/aktivitet/7/\">d</a></div></td><td><a class=\"other\" href=\"/team-0/kalender/aktivitet/8/\">o</a><a class=\"invisible-link\">n</a></td>"))
    login = (F.col("day") + F.col("team")) % LOGIN_PAGE == 0
    html = F.when(login, F.lit("<html><head><title>Logga in</title></head><body><form action=\"/logga-in\" method='post'><input name='UserName'><input name=\"UserPass\" type=password></form></body></html>")) \
        .otherwise(F.concat(F.lit("<html><head><title> Kalender &amp; mer </title><link rel='canonical' href='/kalender'></head><body>Logga ut<form action='/sok'><input name='compass_id'></form><table><tr>"), cells, F.lit("</tr></table></body></html>")))
    page = (F.col("team") * 100000 + F.col("day")) * 4 + 3
    return hrefs.select(page.alias("page_id"), F.concat(F.lit(f"https://{DOMAIN}/team-"), F.col("team").cast("string"), F.lit("/kalender/"), F.col("day").cast("string")).alias("url"),
                        html.alias("html"), F.lit(200).alias("status"))


def captured_pages(events: DataFrame) -> DataFrame:
    return calendar_pages(events).unionByName(presence_pages(events)).unionByName(activity_pages(events))
