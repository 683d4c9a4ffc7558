"""Reading object literals out of JavaScript text with built-in expressions.

A script is cut into tokens by ONE alternation (string | comment | blank | name |
number | any other character), so nothing inside a string or a comment is ever taken for
code, and no edit touches the content of a string.  What follows works on the array of
tokens: assignments and calls are found at the outer level of brackets, and a
literal is written as JSON from its tokens: names of fields quoted, trailing commas
dropped, ``undefined`` as null, hexadecimal numbers in decimal, neighbouring strings joined by
``+`` as one.  Regular-expression literals are not told from divisions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .html import once

# blanks and comments go before a token, or stand at the end with none
_SKIPPED = r"(?s)(?:\s++|/\*.*?\*/|//[^\r\n]*+)*+"
_TOKEN = (r"""("(?:[^"\\\r\n]++|\\.)*+"|'(?:[^'\\\r\n]++|\\.)*+'|`(?:[^`\\]++|\\.)*+`"""
          r"""|[\p{L}_$][\p{L}\p{N}_$]*+|0[xX][0-9a-fA-F]++|(?:[0-9]++(?:\.[0-9]*+)?|\.[0-9]++)(?:[eE][+-]?[0-9]++)?|.|$(?![\s\S]))""")
_NAME = r"^[\p{L}_$][\p{L}\p{N}_$]*$"


def _string(token: Column) -> Column:
    """A string token as a JSON string (what JSON lacks: the other quote, \\x41,
    \\v, \\0 and lines continued by a backslash)."""
    inner = F.substring(token, F.lit(2), F.length(token) - 2)
    odd = r"(?<!\\)((?:\\\\)*)"  # an unescaped place
    quoted = F.when(token.startswith("'"), F.regexp_replace(inner, odd + '"', '$1\\\\"')).otherwise(inner)
    easy = F.when(quoted.contains("\\"), _replaced(quoted, odd)).otherwise(quoted)
    return F.concat(F.lit('"'), easy, F.lit('"'))


def _replaced(text: Column, odd: str) -> Column:
    for pattern, to in ((r"\\x([0-9a-fA-F]{2})", r"$1\\u00$2"), (r"\\v", r"$1\\u000b"), (r"\\0(?![0-9])", r"$1\\u0000"), (r"\\(?:\r\n|\r|\n)", "$1"), (r"\\'", "$1'")):
        text = F.regexp_replace(text, odd + pattern, to)
    return text


def tokens(text) -> Column:
    """Tokens of a script without blanks and comments; strings in double quotes."""
    found = F.filter(F.regexp_extract_all(text, F.lit(_SKIPPED + _TOKEN), F.lit(1)), lambda t: t != "")
    return F.transform(found, lambda t: F.when((F.length(t) > 1) & t.rlike("""^["']"""), _string(t)).otherwise(t))


def _places(ts: Column, wanted) -> Column:
    """Places of the tokens that ``wanted(token, place)`` holds for; a fold then goes over these alone."""
    return F.filter(F.transform(ts, lambda t, i: F.when(wanted(t, i), i)), lambda i: i.isNotNull())


def _among(token: Column, characters: str) -> Column:
    """Whether a token is one of these characters (no token is empty, and none holds two of them but a string)."""
    return F.contains(F.lit(characters), token)


def _depth(depth: Column, token: Column) -> Column:
    return depth + F.when(_among(token, "{(["), 1).when(_among(token, "})]"), -1).otherwise(0)


def assignments(ts: Column, name: str) -> Column:
    """struct(top, any): places of the object literal last assigned to ``name``
    (or to window.name) at the outer level, and of the first at any level; NULL when there is none."""
    def starts(i: Column) -> Column:
        before = F.get(ts, i - 1)
        free = before.isNull() | (before != ".") | ((F.get(ts, i - 2) == "window") & (F.get(ts, i - 3).isNull() | (F.get(ts, i - 3) != ".")))
        return (F.get(ts, i) == name) & (F.get(ts, i + 1) == "=") & F.get(ts, i + 2).isin("{", "[") & free

    def step(s: Column, i: Column) -> Column:
        t = F.get(ts, i)
        return F.struct(_depth(s["depth"], t).alias("depth"),
                        F.when((t == name) & (s["depth"] == 0), i + 2).otherwise(s["top"]).alias("top"),
                        F.when((t == name) & s["any"].isNull(), i + 2).otherwise(s["any"]).alias("any"))
    none = F.lit(None).cast("int")
    places = _places(ts, lambda t, i: _among(t, "{}()[]") | (t == name) & starts(i))
    return F.aggregate(places, F.struct(F.lit(0).alias("depth"), none.alias("top"), none.alias("any")), step,
                       lambda s: F.struct(s["top"].alias("top"), s["any"].alias("any")))


def calls(ts: Column) -> Column:
    """array<struct(start, callee, place)> of the statements at the outer level that
    are calls with an object literal first: the first token, the name and the literal's place."""
    none = F.array().cast("array<struct<start:int,callee:string,place:int>>")

    def step(s: Column, i: Column) -> Column:
        t = F.get(ts, i)
        ends = (t == ";") & (s["depth"] == 0)
        # the first bracket of a statement, after nothing but a name
        words = F.slice(ts, s["start"] + 1, F.greatest(i - s["start"], F.lit(0)))
        named = s["open"] & (s["depth"] == 0) & (t == "(") & (i > s["start"]) & (F.get(ts, i + 1) == "{")
        call = F.coalesce(named, F.lit(False)) & F.forall(words, lambda w: w.rlike(_NAME) | (w == "."))
        return F.struct(_depth(s["depth"], t).alias("depth"), F.when(ends, i + 1).otherwise(s["start"]).alias("start"), ends.alias("open"),
                        F.when(call, F.concat(s["calls"], F.array(F.struct(s["start"].alias("start"), F.array_join(words, "").alias("callee"), (i + 1).alias("place"))))).otherwise(s["calls"]).alias("calls"))
    zero = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("start"), F.lit(True).alias("open"), none.alias("calls"))
    return F.aggregate(_places(ts, lambda t, i: _among(t, "{}()[];")), zero, step, lambda s: s["calls"])


def literal(ts: Column, place: Column) -> Column:
    """JSON text of the tokens from ``place`` on; a JSON reader takes the literal and ignores what follows it."""
    def string(x: Column) -> Column:
        return x.isNotNull() & x.startswith('"') & (F.length(x) > 1)

    def piece(part: Column, t: Column, i: Column) -> Column:
        before, after = F.get(part, i - 1), F.get(part, i + 1)
        glued = string(before) & string(after)
        joined_before = (before == "+") & string(F.get(part, i - 2))
        joined_after = (after == "+") & string(F.get(part, i + 2))
        no, quote = F.lit(""), F.lit('"')
        text = F.concat(F.when(joined_before, no).otherwise(quote), F.substring(t, F.lit(2), F.length(t) - 2), F.when(joined_after, no).otherwise(quote))
        field = (after == ":") & before.isin("{", ",") & t.rlike(r"^[\p{L}_$0-9]")
        return (F.when(t == ":", t).when(string(t), text).when((t == "+") & glued, no).when((t == ",") & after.isin("}", "]"), no)
                .when(field, F.concat(quote, t, quote)).when(t == "undefined", F.lit("null"))
                .when(t.startswith("0") & t.rlike("^0[xX]"), F.conv(F.substring(t, F.lit(3), F.length(t)), 16, 10))
                .when(t.endswith(".") & t.rlike(r"^[0-9]+\.$"), F.concat(t, F.lit("0"))).when(t.startswith(".") & (F.length(t) > 1), F.concat(F.lit("0"), t)).otherwise(t))
    part = F.slice(ts, place + 1, F.greatest(F.size(ts) - place, F.lit(0)))
    return once(part, lambda p: F.array_join(F.transform(p, lambda t, i: piece(p, t, i)), ""))
