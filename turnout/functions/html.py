"""Column helpers for the text of HTML pages: comments, attributes, character
references.  All are built-in expressions; patterns use possessive quantifiers,
so they stay linear on any input."""

from __future__ import annotations

import html as _html

from pyspark.sql import Column
from pyspark.sql import functions as F

#: the inside of a tag: quoted values may hold ">"
INSIDE = r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)"""
# the predefined and Latin-1 character references (names of code points up to 255)
NAMED = {n: chr(c) for n, c in _html.entities.name2codepoint.items() if c < 256}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def once(c: Column, use) -> Column:
    """``use(c)`` with ``c`` evaluated a single time, however often ``use`` names it."""
    return F.get(F.transform(F.array(c), use), 0)


def computed(c: Column) -> Column:
    """``c`` as a generated column: a later filter on it stays above it, so that
    it is evaluated once a row, not again for the filter."""
    return F.explode(F.array(c))


def without_comments(c) -> Column:
    return F.regexp_replace(_c(c), r"(?s)<!--.*?-->", "")


def tags(c, name: str) -> Column:
    """Attribute texts of all ``name`` start tags, in document order."""
    return F.regexp_extract_all(_c(c), F.lit(rf"(?i)<{name}(?=[\s/>]){INSIDE}>"), F.lit(1))


def attribute(attrs: Column, name: str) -> Column:
    """Value of an attribute (either quote, or none), references decoded; NULL
    when it is absent.  A name is preceded by a blank, so ``data-href`` is not
    ``href``; quoted text is skipped over."""
    pattern = (rf"""(?is)^(?:[^"'\s]++|\s++(?!{name}\s*=)|"[^"]*+"|'[^']*+')*+\s++{name}\s*=\s*+"""
               r"""(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""")
    return once(F.concat(F.lit(" "), attrs), lambda text: F.when(
        text.rlike(pattern), decode_references(F.concat(*[F.regexp_extract(text, pattern, i) for i in (1, 2, 3)]))))


def decode_references(c) -> Column:
    """Named (Latin-1) and numeric character references; others stay as they are."""
    named = F.create_map(*[F.lit(x) for n, ch in NAMED.items() for x in (f"&{n};", ch)])

    def char(ref: Column) -> Column:
        body = F.regexp_extract(ref, r"#[xX]?([0-9a-fA-F]+)", 1)
        code = F.when(ref.rlike("^&#[xX]"), F.conv(body, 16, 10)).when(ref.startswith("&#"), body).cast("int")
        numeric = once(code, lambda n: F.when(n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF), F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")))
        return F.when(ref.startswith("&#"), numeric).otherwise(F.element_at(named, ref))

    def decoded(text: Column) -> Column:
        found = F.array_distinct(F.regexp_extract_all(text, F.lit(r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,7});"), F.lit(0)))
        pairs = F.filter(F.transform(found, lambda r: F.struct(r.alias("ref"), char(r).alias("to"))), lambda p: p["to"].isNotNull())
        # references to "&" last, so that what they make is not decoded again
        ordered = once(pairs, lambda all_: F.concat(F.filter(all_, lambda p: p["to"] != "&"), F.filter(all_, lambda p: p["to"] == "&")))
        return F.aggregate(ordered, text, lambda acc, p: F.replace(acc, p["ref"], p["to"]))
    return once(_c(c), lambda text: F.when(F.contains(text, F.lit("&")), decoded(text)).otherwise(text))


# ------------------------------------------------------------------ elements

#: comments and raw text first, so that nothing inside them counts as a tag
_TAG = rf"(?is)<!--.*?(?:-->|$(?![\s\S]))|<(script|style)(?=[\s/>]).*?</\1\s*>|</?[a-z][^\s/>]*+{INSIDE}>"
# Elements without content, and start tags that end an open element
# (the nearest of the first kind, unless one of the second kind stands between).
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
ENDS_OPEN = {"td": (["td", "th"], ["table"]), "th": (["td", "th"], ["table"]), "tr": (["tr"], ["table"]),
             "li": (["li"], ["ul", "ol"]), "option": (["option"], ["select"]), "a": (["a"], ["td", "th", "table"])}


def children(html, parent: str, child: str) -> Column:
    """Attribute texts of the ``child`` elements that stand directly inside a
    ``parent`` element, in document order: the tags are folded over a stack of
    the open elements, the innermost first."""
    def name(tag: Column) -> Column:
        return F.lower(F.regexp_extract(tag, r"^</?([^\s/>]+)", 1))

    def nearest(stack: Column, names: list[str]) -> Column:
        """Place of the innermost element of these names; a large number when none is open."""
        places = [F.array_position(stack, n) for n in names]
        return F.least(*[F.when(p > 0, p).otherwise(1 << 30) for p in places], F.lit(1 << 30).cast("long"))

    def without(stack: Column, place: Column) -> Column:
        return F.when(place < (1 << 30), F.slice(stack, place.cast("int") + 1, F.size(stack))).otherwise(stack)

    def opened(stack: Column, n: Column) -> Column:
        """The stack at the start tag ``n``: after what it ends."""
        out = stack
        for key, (kinds, bounds) in ENDS_OPEN.items():
            at = nearest(stack, kinds)
            out = F.when(n == key, F.when(at < nearest(stack, bounds), without(stack, at)).otherwise(stack)).otherwise(out)
        return out

    def step(state: Column, tag: Column) -> Column:
        n = tag["n"]
        closed = F.struct(once(nearest_of(state["stack"], n), lambda at: without(state["stack"], at)).alias("stack"), state["found"].alias("found"))
        started = once(opened(state["stack"], n), lambda stack: F.struct(
            F.when(n.isin(VOID) | tag["t"].endswith("/>") & n.isin("br", "img", "input"), stack).otherwise(F.concat(F.array(n), stack)).alias("stack"),
            F.when((n == child) & (F.get(stack, 0) == parent), F.concat(state["found"], F.array(F.regexp_extract(tag["t"], rf"(?is)^<[^\s/>]+{INSIDE}>$", 1)))).otherwise(state["found"]).alias("found")))
        return F.when(tag["t"].startswith("</"), closed).otherwise(started)

    def nearest_of(stack: Column, n: Column) -> Column:
        at = F.array_position(stack, n)
        return F.when(at > 0, at).otherwise(F.lit(1 << 30).cast("long"))
    tags_ = F.filter(F.regexp_extract_all(_c(html), F.lit(_TAG), F.lit(0)), lambda t: ~t.rlike(r"(?i)^<(?:!--|script|style)"))
    named = F.transform(tags_, lambda t: F.struct(t.alias("t"), name(t).alias("n")))
    none = F.array().cast("array<string>")
    return F.aggregate(named, F.struct(none.alias("stack"), none.alias("found")), step, lambda s: s["found"])


def head_scripts(html) -> Column:
    """Non-empty inline script texts before the end of the head, in order.
    Comments outside scripts hide theirs; markup inside a script is its text."""
    parts = F.regexp_extract_all(_c(html), F.lit(rf"(?is)<!--.*?(?:-->|$(?![\s\S]))|<script(?=[\s/>]){INSIDE}>.*?</script(?=[\s/>])[^>]*+>|</head\s*>|<body(?=[\s>])"), F.lit(0))
    end = r"(?i)^(?:</head|<body)"
    before = once(parts, lambda p: F.coalesce(F.slice(p, 1, F.get(F.filter(F.transform(p, lambda x, i: F.when(x.rlike(end), i)), lambda i: i.isNotNull()), 0)), p))
    texts = F.transform(F.filter(before, lambda x: x.rlike("(?i)^<script")), lambda x: F.regexp_extract(x, rf"(?is)^<script{INSIDE}>(.*)</script[^>]*>$", 2))
    return F.filter(texts, lambda s: s != "")
