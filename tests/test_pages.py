"""Page operators on hand-made pages (the driver pages carry no club payloads)."""


from turnout.operators import pages as pg

SLUG = "lag-f2014"
DOMAIN = "www.example-club.se"

CALENDAR = f"""<html><head><title> Kalender &amp; mer </title>
<link rel="canonical" href="https://{DOMAIN}/{SLUG}/kalender"></head>
<body>Logga ut<table><tr>
<td><a class="invisible-link" href="/{SLUG}/kalender/aktivitet/123/">x</a></td>
<td> <a href="/other-team/kalender/aktivitet/5/" class="invisible-link">y</a>
<td><a class="invisible-link" href="/{SLUG}/match/456/">z</a></td>
<td><a class="other" href="/{SLUG}/kalender/aktivitet/999/">ignored</a></td>
<td><a class="invisible-link" href="/{SLUG}/kalender/aktivitet/123/">dup</a></td>
</tr></table>
<form action="/sok" method="get"><input name="q"><input name="page"></form>
</body></html>"""

EMPTY_MONTH = "<html><body>Logga ut</body></html>"
LOGIN = """<html><head><title>Logga in</title></head><body>
<form action="/logga-in" method="post"><input name="UserName"><input name="UserPass" type="password"></form>
</body></html>"""

PRESENCE = """<html><head><title>Närvaro</title>
<script>var broken = {a: ; var initData = {scheduleId: 1, oops</script>
<script src="/x.js"></script>
<script>
  var initData = {scheduleId: 77, teamPresenceGroups: [{leaders: [{id: 1, userId: 10, firstName: 'Ann',
     lastName: "O'Neil", memberTypeId: 2, stats: {star: 3}, isLeader: true,}],
     participants: [{id: 2, userId: 11, firstName: 'Bo', birthDate: '2014-02-03', memberTypeId: 1}]}]};
  var other = 1;
</script></head><body>Logga ut</body></html>"""

ACTIVITY = """<html><head></head>
<body data-ng-init="init({scheduleId: 77, scheduleDate: '2024-05-06', startTime: '18:00', endTime: '19:30',
 eventTypeId: 1, place: 'Hall &amp; Arena', isHomeFacility: true}, 5); extra({scheduleId: 78})">Logga ut</body></html>"""


def _pages(spark):
    rows = [(1, f"https://{DOMAIN}/{SLUG}/kalender/2024/maj", CALENDAR),
            (2, f"https://{DOMAIN}/{SLUG}/kalender/2024/juni", EMPTY_MONTH),
            (3, f"https://{DOMAIN}/logga-in", LOGIN),
            (4, f"https://{DOMAIN}/{SLUG}/controlpanel/presence/chooseparticipants/77", PRESENCE),
            (5, f"https://{DOMAIN}/{SLUG}/kalender/redigera-aktivitet/77", ACTIVITY)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_links_in_document_order_with_duplicates(spark):
    links = pg.extract_links(_pages(spark), "td", "invisible-link")
    got = [(r.page_id, r.pos, r.href) for r in links.orderBy("page_id", "pos").collect()]
    assert got == [(1, 0, f"/{SLUG}/kalender/aktivitet/123/"), (1, 1, "/other-team/kalender/aktivitet/5/"),
                   (1, 2, f"/{SLUG}/match/456/"), (1, 3, f"/{SLUG}/kalender/aktivitet/123/")]


def test_empty_month_yields_no_links_not_an_error(spark):
    p = _pages(spark).where("page_id = 2")
    assert pg.extract_links(p).count() == 0
    assert pg.team_link_counts(pg.extract_links(p), SLUG).count() == 0


def test_team_filter_counts_and_requests(spark):
    links = pg.extract_links(_pages(spark))
    c = pg.team_link_counts(links, SLUG).first()
    assert (c.total_links, c.kept, c.removed) == (4, 3, 1)
    req = {r.pos: r for r in pg.activity_requests(links, DOMAIN, SLUG).collect()}
    assert req[0].activity_id == "123" and req[0].is_match is False
    assert req[0].presence_url == f"https://{DOMAIN}/{SLUG}/controlpanel/presence/chooseparticipants/123"
    assert req[0].activity_url == f"https://{DOMAIN}/{SLUG}/kalender/redigera-aktivitet/123"
    assert req[2].is_match and req[2].activity_url == f"https://{DOMAIN}/{SLUG}/match/redigera/456"


def test_resolve_url(spark):
    df = spark.createDataFrame([("https://a.se/x/y/z?q=1", "/p/1/"), ("https://a.se/x/y/z", "../w"),
                                ("https://a.se/x/", "//b.se/k"), ("https://a.se/x/", None)], "b string, h string")
    got = [r[0] for r in df.select(pg.resolve_url("b", "h")).collect()]
    assert got == ["https://a.se/p/1/", "https://a.se/x/w", "https://b.se/k", None]


def test_page_evidence_and_auth(spark):
    ev = {r.page_id: r for r in pg.page_evidence(_pages(spark)).collect()}
    assert ev[1].title == "Kalender & mer"
    assert ev[1].canonical == f"https://{DOMAIN}/{SLUG}/kalender"
    assert ev[1].login_form_count == 0 and ev[3].login_form_count == 1
    assert [(f.action, f.method, list(f.input_names)) for f in ev[3].forms] == [("/logga-in", "post", ["UserName", "UserPass"])]
    assert ev[2].title == "" and ev[2].canonical is None
    auth = {r.page_id: r.authenticated for r in pg.page_auth(_pages(spark)).collect()}
    assert auth == {1: True, 2: True, 3: False, 4: True, 5: True}
    assert sorted(r.page_id for r in pg.rejected_pages(_pages(spark)).collect()) == [3]


def test_require_accepted_fails_job(spark):
    import pytest
    with pytest.raises(Exception, match="page rejected"):
        pg.require_accepted(_pages(spark)).collect()
    assert pg.require_accepted(_pages(spark).where("page_id <> 3")).count() == 4


def test_status_guard(spark):
    p = spark.createDataFrame([(1, "https://a/x", "Logga ut", 200), (2, "https://a/y", "Logga ut", 503)],
                              "page_id long, url string, html string, status int")
    assert [r.page_id for r in pg.accepted_pages(p).collect()] == [1]


def test_extract_presence_skips_unparsable_script(spark):
    rec, rej = pg.extract_presence(_pages(spark))
    r = rec.collect()
    assert len(r) == 1 and r[0].page_id == 4 and r[0].scheduleId == 77
    g = r[0].teamPresenceGroups[0]
    assert g.leaders[0].lastName == "O'Neil" and g.leaders[0].stats.star == 3
    assert g.participants[0].birthDate == "2014-02-03"
    assert sorted(x.page_id for x in rej.collect()) == [1, 2, 3, 5]


def test_extract_activity_first_argument_per_call(spark):
    rec, rej = pg.extract_activity(_pages(spark))
    got = sorted((r.page_id, r.callee, r.scheduleId, r.place) for r in rec.collect())
    assert got == [(5, "extra", 78, None), (5, "init", 77, "Hall & Arena")]
    assert sorted(r.page_id for r in rej.collect()) == [1, 2, 3, 4]


def test_digest_and_snippet(spark):
    p = spark.createDataFrame([(1, "  a \n\t b c  "), (2, None), (3, "x" * 500)], "page_id long, html string")
    from turnout.functions import html_hash, short_snippet
    got = {r.page_id: r for r in p.select("page_id", short_snippet("html").alias("s"),
                                          html_hash("html").alias("h")).collect()}
    assert got[1].s == "a b c" and got[2].s == "" and len(got[3].s) == 200
    import hashlib
    assert got[1].h == hashlib.sha256("  a \n\t b c  ".encode()).hexdigest()[:12]


def test_literals_are_read_by_the_json_reader(spark):
    def page(script):
        return f"<html><head><script>{script}</script></head><body></body></html>"
    scripts = ["var x = 1; window.initData = {scheduleId: 5, \u00e5lder: 1,}; more({a: 1})", "initData={'scheduleId': 6}", 'const initData = {"scheduleId": 7, teamPresenceGroups: undefined}',
               "var initData = {scheduleId: 'x6'}", "var initData = {scheduleId: someVar}", "var x = 1;", "var initData = 5", "var myinitData = {scheduleId: 8}"]
    p = spark.createDataFrame([(i, "u", page(s)) for i, s in enumerate(scripts)], "page_id long, url string, html string")
    rec, rej = pg.extract_presence(p)
    assert sorted((r.page_id, r.scheduleId) for r in rec.collect()) == [(0, 5), (1, 6), (2, 7)]
    assert sorted((r.page_id, r.reason) for r in rej.collect()) == [(3, "initData not readable"), (4, "initData not readable"),
                                                                    *[(i, "initData not found") for i in (5, 6, 7)]]


def test_activity_attribute_quotes_and_faults(spark):
    bodies = ["<body data-ng-init='init({\"scheduleId\": 1})'>", '<body class="a" data-ng-init="x.y({&quot;scheduleId&quot;: 2}); z({scheduleId: 3, \u00e5lder: 1})">',
              "<body data-ng-init=''>", "<body>", '<body data-ng-init="init(5)">', "<body data-ng-init=\"init({scheduleId: 'x'})\">", "<body data-x-data-ng-init='init({scheduleId: 9})'>"]
    p = spark.createDataFrame([(i, "u", f"<html>{b}x</body></html>") for i, b in enumerate(bodies)], "page_id long, url string, html string")
    rec, rej = pg.extract_activity(p)
    assert sorted((r.page_id, r.callee, r.scheduleId) for r in rec.collect()) == [(0, "init", 1), (1, "x.y", 2), (1, "z", 3)]
    assert sorted((r.page_id, r.reason) for r in rej.collect()) == [(2, "data-ng-init missing"), (3, "data-ng-init missing"), (4, "data-ng-init not readable"),
                                                                    (5, "data-ng-init not readable"), (6, "data-ng-init missing")]


def test_links_of_difficult_cells(spark):
    html = ("""<td><a class="invisible-link" href="/s/a/1/">1</a><br><a class='invisible-link' href="/s/o'k/5/">2</a></td>"""
            """<td><span>x</span><a data-href="/bad/" class="invisible-link" href='/s/b/2/'>3</a><!-- <td><a class="invisible-link" href="/s/c/3/">no</a> -->"""
            """<td title="a > b"><a title="x href='/no/' > y" class="invisible-link" href=/s/d/6/>4</a></td><a class="invisible-link" href="/s/out/7/">5</a>"""
            """<td><a class="invisible-link big" href="/s/e/8/">6</a><a class="invisible-link">7</a><a class="invisible-link" href="/s/f/?a=1&amp;b=&aring;&#246;&#x1F600;">8</a></td>""")
    p = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    assert [r.href for r in pg.extract_links(p).orderBy("pos").collect()] == ["/s/a/1/", "/s/o'k/5/", "/s/b/2/", "/s/d/6/", "/s/f/?a=1&b=\u00e5\u00f6\U0001F600"]


def test_references_and_login_forms(spark):
    from pyspark.sql import functions as F
    from turnout.functions.html import decode_references
    cases = ["N&auml;rvaro f&ouml;r lag", "&amp;lt; &lt;b&gt; &quot;&#39;&nbsp;", "&unknown; & &#0; &#1114112;", None, "plain", "&amp;amp;"]
    got = [r[0] for r in spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c string").orderBy("i").select(decode_references(F.col("c"))).collect()]
    assert got == ["N\u00e4rvaro f\u00f6r lag", "&lt; <b> \"'\u00a0", "&unknown; & &#0; &#1114112;", None, "plain", "&amp;"]
    pages = [(1, "<form><input name='compass_id'></form>"), (2, "<form><input type=password></form><form><input name='username'></form>"),
             (3, "<form><input NAME='UserName'></form><form><p><input name=\"myPass\"></form>"), (4, "<!-- <form><input type='password'></form> -->")]
    p = spark.createDataFrame(pages, "page_id long, html string").withColumn("url", F.lit("u"))
    assert {r.page_id: r.login_form_count for r in pg.page_evidence(p).collect()} == {1: 0, 2: 1, 3: 2, 4: 0}


def test_guards_by_page_kind(spark):
    """Only calendar pages must show the login; every page must have a good status."""
    from turnout.plans.extract import extract
    presence = "<html><head><script>var initData = {scheduleId: 1}</script></head><body></body></html>"
    rows = [(1, f"https://{DOMAIN}/{SLUG}/controlpanel/presence/chooseparticipants/1", presence, 200),
            (2, f"https://{DOMAIN}/{SLUG}/controlpanel/presence/chooseparticipants/2", presence, 500),
            (3, f"https://{DOMAIN}/{SLUG}/kalender/2024/maj", "<td>", None), (4, f"https://{DOMAIN}/logga-in", "Logga ut", 200)]
    ex = extract(spark.createDataFrame(rows, "page_id long, url string, html string, status int"), DOMAIN, SLUG)
    assert [r.scheduleId for r in ex.raw_presence.collect()] == [1]
    assert sorted((r.page_id, r.reason) for r in ex.rejects.collect()) == [(2, "error status"), (3, "not authenticated"), (4, "not authenticated")]


def test_extract_job_end_to_end(spark):
    import datetime as dt
    from turnout.config import Config
    from turnout.operators.staging import stg_activity, stg_presence
    from turnout.plans.extract import extract
    ts = dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc)
    ex = extract(_pages(spark), DOMAIN, SLUG, "L9", ts)
    assert sorted(r.activity_id for r in ex.requests.collect()) == ["123", "123", "456"]
    cfg = Config.warehouse()
    sp = stg_presence(ex.raw_presence, cfg).collect()
    assert sorted((r.schedule_id, r.user_id) for r in sp) == [(77, 10), (77, 11)]
    sa = stg_activity(ex.raw_activity, cfg).collect()
    assert sorted((r.schedule_id, r.place) for r in sa) == [(77, "Hall & Arena"), (78, None)]
    assert {r.load_id for r in ex.raw_activity.collect()} == {"L9"}
    assert [r.page_id for r in ex.rejects.collect()] == [3]


def _payload_pages(spark, n):
    rows = [(4 * i + 1, f"https://{DOMAIN}/{SLUG}/controlpanel/presence/chooseparticipants/{i}", PRESENCE.replace("77", str(i)), 200) for i in range(n)]
    rows += [(4 * i + 2, f"https://{DOMAIN}/{SLUG}/kalender/redigera-aktivitet/{i}", ACTIVITY.replace("77", str(i)), 200) for i in range(n)]
    rows += [(None, f"https://{DOMAIN}/{SLUG}/kalender/redigera-aktivitet/9", "<html><body></body></html>", 200)] * n
    return spark.createDataFrame(rows, "page_id long, url string, html string, status int").coalesce(1)


def test_pages_of_one_file_are_parsed_by_many_tasks(spark):
    """whatever files the pages come in, every task parses its share, of copies and null ids too."""
    from pyspark.sql import functions as F
    from turnout.plans.extract import extract
    ex = extract(_payload_pages(spark, 40), DOMAIN, SLUG)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for df, rows in ((ex.raw_presence, 40), (ex.raw_activity, 80), (ex.rejects.where("reason = 'data-ng-init missing'"), 40)):
        parts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(parts) == rows and len(parts) == n and max(parts) <= 2 * rows / n


def test_one_kind_of_pages_is_parsed_alone_and_once(spark):
    """what is not asked for is not parsed, and a kept kind is parsed once."""
    from turnout.plans.extract import extract
    from turnout.session import scratch_path
    from turnout.sources.sinks import materialize
    kept = []

    def keep(name, df):
        kept.append(name)
        return materialize(df, scratch_path(spark, name))
    ex = extract(_payload_pages(spark, 3), DOMAIN, SLUG, keep=keep)
    assert kept == []
    assert ex.raw_presence.count() == 3 and kept == ["presence"]
    assert ex.rejects.count() == 3 and kept == ["presence", "activity"]
    assert ex.raw_activity.count() == 6 and kept == ["presence", "activity"]


def test_captured_queries_parse_each_page_once(spark):
    """no second parse to find the newest load, or for the second list of people."""
    import os

    import pytest
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver tables not present")
    activity, presence = (E.queries()[f"captured_{k}"](spark, sf)._jdf.queryExecution().optimizedPlan().toString() for k in ("activity", "presence"))
    assert activity.count("from_json") == 1 and activity.count("Relation [") == 1
    assert "from_json" not in presence
