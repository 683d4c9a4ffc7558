"""Payload literals as a JavaScript reader takes them, and the child axis of links."""

import pytest
from pyspark.sql import functions as F

from turnout.functions import html, script
from turnout.operators import pages as pg

PRESENCE = "https://www.example-club.se/team-0/controlpanel/presence/chooseparticipants/1"
COLUMNS = "page_id int, url string, html string"


def presence(spark, *heads):
    rows = [(i, PRESENCE, f"<html><head>{h}</head><body></body></html>") for i, h in enumerate(heads)]
    rec, rej = pg.extract_presence(spark.createDataFrame(rows, COLUMNS))
    return {r.page_id: r for r in rec.collect()}, {r.page_id: r.reason for r in rej.collect()}


def activity(spark, *inits):
    rows = [(i, "u", f"<html><head></head><body data-ng-init=\"{t.replace('&', '&amp;').replace(chr(34), '&quot;')}\">x</body></html>") for i, t in enumerate(inits)]
    rec, rej = pg.extract_activity(spark.createDataFrame(rows, COLUMNS))
    return sorted((r.page_id, r.callee, r.scheduleId, r.place, r.opponent) for r in rec.collect()), {r.page_id: r.reason for r in rej.collect()}


def test_commented_and_quoted_assignments(spark):
    rec, rej = presence(
        spark,
        "<!-- <script>var initData = {scheduleId: 1};</script> --><script>var initData = {scheduleId: 2};</script>",
        "<script>// initData = {scheduleId: 8}\nvar initData = {scheduleId: 9};</script>",
        "<script>/* initData = {scheduleId: 8} */ window.initData = {/* c */ scheduleId: 9 // end\n};</script>",
        "<script>var s = 'initData = {scheduleId: 8}'; initData = {scheduleId: 0x10};</script >",
        "<script>var s = \"</head>\"; var initData = {scheduleId: 3};</script>",
        "<script>my.initData = {scheduleId: 8}; initDatas = {scheduleId: 8};</script>",
        "<script>function f() { initData = {scheduleId: 8}; }</script>",
        "<script>initData = {scheduleId: 8}; initData = {scheduleId: 4};</script>",
        "<script><!-- not a comment here\n var initData = {scheduleId: 5};</script>",
        "<script>var a = {b: ;</script><script>var initData = {scheduleId: 6, 'teamPresenceGroups': [],};</script>",
        "<style>script { }</style><SCRIPT type='text/javascript'>initData={\"scheduleId\":7}</SCRIPT\n>",
    )
    assert {i: r.scheduleId for i, r in rec.items()} == {0: 2, 1: 9, 2: 9, 3: 16, 4: 3, 7: 4, 8: 5, 9: 6, 10: 7}
    assert rej == {5: "initData not found", 6: "initData not readable"}


def test_contents_of_strings_stay(spark):
    place = "Hall [a,] b"
    rec, rej = activity(
        spark,
        "vm.init({scheduleId: 1, place: 'Hall [a,] b', opponent: 'x: undefined',})",
        "vm.init({scheduleId: 2, place: 'x; go({y', opponent: undefined}, 5); done()",
        "/* c */ vm.init({scheduleId: 0x10, place: \"a\"+\"b\" + 'c', opponent: 'it\\'s \"q\" // no /* no */'})",
        "init({scheduleId: 3, place: '\\x41\\u0042\\t\\\\x43', opponent: \"'\"}); next({scheduleId: 4, place: ')};({'})",
        "var x = 1; init({scheduleId: 5})",
        "init(5)",
        "init({scheduleId: 6, place: bare})",
        "init({scheduleId: 7, 'place': 'unclosed})",
        "init( { scheduleId : 8 , opponent : \"café \U0001F600\" } )",
    )
    assert rec == [(0, "vm.init", 1, place, "x: undefined"), (1, "vm.init", 2, "x; go({y", None), (2, "vm.init", 16, "abc", "it's \"q\" // no /* no */"),
                   (3, "init", 3, "AB\t\\x43", "'"), (3, "next", 4, ")};({", None), (8, "init", 8, None, "café \U0001F600")]
    assert rej == {4: "data-ng-init not readable", 5: "data-ng-init not readable", 6: "data-ng-init not readable", 7: "data-ng-init not readable"}


@pytest.mark.parametrize("text, json", [
    ("{a: 1, b: [1, 2,], c: {},}", '{"a":1,"b":[1,2],"c":{}}'),
    ("{'a\"b': .5, 7: 5., n: -0xFf}", '{"a\\"b":0.5,"7":5.0,"n":-255}'),
    ("{a: 'x\\\ny', b: '\\v\\0'}", '{"a":"xy","b":"\\u000b\\u0000"}'),
    ("{a: undefined, undefined: 'undefined'}", '{"a":null,"undefined":"undefined"}'),
    ("{a: '1' + 2}", '{"a":"1"+2}'),
])
def test_literals_as_json(spark, text, json):
    df = spark.createDataFrame([(text,)], "t string").select(html.once(script.tokens(F.col("t")), lambda ts: script.literal(ts, F.lit(0))).alias("j"))
    assert df.first().j == json


def test_a_long_script(spark):
    """Many tokens, long strings with many escapes."""
    people = ",".join("{userId: %d, firstName: '%s'}" % (i, "\\n" * 40) for i in range(3000))
    rec, _ = presence(spark, "<script>var initData = {scheduleId: 1, teamPresenceGroups: [{leaders: [], participants: [%s]}]};</script>" % people)
    people = rec[0].teamPresenceGroups[0].participants
    assert len(people) == 3000 and people[2999].firstName == "\n" * 40


def links(spark, body, parent="td"):
    df = spark.createDataFrame([(1, "u", f"<html><body><table>{body}</table></body></html>")], COLUMNS)
    return [r.href for r in pg.extract_links(df, parent).orderBy("pos").collect()]


def a(n):
    return f"<a class='invisible-link' href='/{n}/'>x</a>"


@pytest.mark.parametrize("body, found", [
    (f"<tr><td><div>{a(1)}</div>{a(2)}</td></tr>", ["/2/"]),
    (f"<tr><td>{a(1)}<td>{a(2)}<tr><td><span>s</span>{a(3)}", ["/1/", "/2/", "/3/"]),  # end tags left out
    (f"<tr><td><table><tr><td>{a(1)}</td></tr></table>{a(2)}</td><td>{a(3)}</td></tr>{a(4)}", ["/1/", "/2/", "/3/"]),  # nested
    (f"<tr><td><br><img src='x>y'>{a(1)}<hr/>{a(2)}</td></tr>", ["/1/", "/2/"]),  # without content
    (f"<tr><td><!-- <td>{a(1)} --><script>'<td>{a(2)}'</script>{a(3)}</td></tr>", ["/3/"]),
    (f"<tr><td><p>t</p>{a(1)}<b>{a(2)}</b></i>{a(3)}</td><th>{a(4)}</th></tr>", ["/1/", "/3/"]),
    ("<TR><TD><A HREF='/1/' CLASS='invisible-link'>x</A></TD></TR>", ["/1/"]),
    ("<tr><td></td></tr>", []),
])
def test_links_are_children_of_their_cell(spark, body, found):
    assert links(spark, body) == found


def test_tokens_places_and_folds_of_difficult_scripts(spark):
    """blanks and comments go with the token after them, also at the end; folds see brackets and names alone."""
    scripts = ["a /* x */ = 1 // end", "a = 1 /* open", " \n\t", "", "/* c */", "x//y\n;/**/z", "`a ( b` \"{\" '}' initData = {", None,
               "f({a: 1}); g.h /* c */ ({b: 2}); k(1)({c: 3}); i j ({d: 4}) ; ({e: 5}); (f({f: 6}); x) ; l({g: 7})", "a = b({x: 1}); c({y: 1})",
               "[initData = {a: 1}]; initData = {b: 2}; window.initData = [1]; x.initData = {c: 3}; y.window.initData = {}", "} initData = {a: 1}", "} { f({a: 1}) ; f({b: 1})"]
    df = spark.createDataFrame(list(enumerate(scripts)), "i int, s string")
    got = df.select("i", script.tokens(F.col("s")).alias("t"), html.once(script.tokens(F.col("s")), lambda t: script.assignments(t, "initData")).alias("a"),
                    html.once(script.tokens(F.col("s")), script.calls).alias("c")).orderBy("i").collect()
    text = [None if r.t is None else " ".join(r.t) for r in got]
    assert text[:8] == ["a = 1", "a = 1 / * open", "", "", "", "x ; z", '`a ( b` "{" "}" initData = {', None]
    assert [r.a and tuple(r.a) for r in got][6:] == [(5, 5), None, (None, None), (None, None), (22, 3), (None, 3), (None, None)]
    assert [[c.callee for c in r.c] for r in got[8:]] == [["f", "g.h", "ij", "l"], ["c"], [], [], ["f"]]
