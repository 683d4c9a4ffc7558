"""Personal data: fixed patterns, and a linear-chain conditional random field.

The base patterns (email, ip, card, phone) are taken leftmost and without
overlaps per kind.  The field adds what they miss: telephone numbers without a
plus, cards and addresses written with other separators, spelt-out e-mail
addresses.  It labels tokens (words, digit runs, signs) from the shapes of a token
and its neighbours.  It is trained by full-batch gradient steps on the small
labelled table below (pii_labels.py: every sentence is a row) and decoded by Viterbi over padded
numpy batches over the whole text, in blocks of INNER tokens with LAP more on either side
(a span belongs to the block in which it begins).  A labelled span counts if its kind's
plain checks hold (number of digits, check sum, parts up to 255, an at and a dotted name) and it overlaps
no base span.  What the checks can accept is told by one pattern (_POSSIBLE: enough digits in a
row, or an at followed by a dotted name); a block without such a place is not decoded, as it
could add nothing.

An empty table gives no rows; null and empty texts have no spans.  Long texts are whole, their
blocks decoded as those of short ones.  Rows are scanned one by one, so null or
repeated doc_ids need no rule; extra columns are ignored (the stage keeps them).
Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, table
from .pii_labels import SENTENCES

KINDS = ["email", "ip", "card", "phone"]

# ------------------------------------------------------------------ base patterns

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGIT = re.compile(r"[0-9]")
# A match of the two number patterns never begins inside a run of digits.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def is_card(text: str) -> bool:
    digits = re.sub("[^0-9]", "", text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def is_ip(text: str) -> bool:
    parts = re.findall("[0-9]+", text)
    return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def is_phone(text: str, least: int = 9) -> bool:
    return least <= len(re.sub("[^0-9]", "", text)) <= 15


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of local part, at-sign and host: from every at-sign to both sides."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(_LOCAL))
        free = at + 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            out.append((start, host.end()))
            free = host.end()
        at = text.find("@", free)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans by kind as listed, then start."""
    out = [("email", *s) for s in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if is_ip(m[0])]
        out += [("card", *m.span()) for m in _CARD.finditer(text) if is_card(m[0])]
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if is_phone(m[0])]
    return out


# ------------------------------------------------------------------ tokens and shapes

_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\w\s]|[\w]")
AT_WORDS, DOT_WORDS = "at arobase arroba", "dot punkt punto point"
_BLANK = r"[\x20\t]*"


def _spelt(words: str, sign: str) -> str:
    """A sign, a word for it between blanks, or either in brackets."""
    either = "|".join([*words.split(), re.escape(sign)])
    return rf"(?:{_BLANK}[\[({{<]{_BLANK}(?:{either}){_BLANK}[\])}}>]{_BLANK}|[\x20\t]+(?:{'|'.join(words.split())})[\x20\t]+|{re.escape(sign)})"


_ADDRESS = rf"(?<![\w.%+-])[\w.%+-]++{_spelt(AT_WORDS, '@')}[\w-]++(?:{_spelt(DOT_WORDS, '.')}[\w-]++)+"
_SPELT = re.compile(rf"(?i:{_ADDRESS})")
_POSSIBLE = re.compile(rf"(?:[0-9][\x20()./+-]*+){{7,}}|[0-9]++(?:[\x20.-]++[0-9]++){{3,}}|(?i:{_ADDRESS})")
# Words that the shapes know.
WORDS = {w: k for k, some in {
    "at": AT_WORDS, "dot": DOT_WORDS, "domain": "com org net edu info example de fr es",
    "call": "call phone tel telephone mobile fax telefon ring", "card": "card visa mastercard amex credit karte",
    "ip": "ip address host server", "version": "version v chapter section page isbn order item no number release",
}.items() for w in some.split()}
INNER, LAP = 192, 40
NEAR = (-3, -2, -1, 0, 1, 2, 3)


def shape(token: str, gap: bool) -> str:
    if token[0] in "0123456789":
        return f"{'_' * gap}d{min(len(token), 9)}"
    if token.isalpha():
        known = WORDS.get(token.lower())
        return f"w:{known}" if known else "w1" if len(token) == 1 else "w"
    return f"{'_' * gap}{token}" if token in "@.-+()/:=_,\"'[]" else "sign"


def tokens(text: str) -> list[tuple[str, int, int]]:
    """(shape, start, end); the shape tells if a blank comes before."""
    return [(shape(m[0], m.start() > 0 and text[m.start() - 1].isspace()), *m.span()) for m in _TOKEN.finditer(text)]


# ------------------------------------------------------------------ the field

LABELS = ["O", *[f"{p}-{k}" for k in KINDS for p in "BI"]]


class Field:
    """Weights of (offset, shape, label), label pairs, and first labels."""

    def __init__(self, shapes: list[str]):
        self.shapes = {s: i + 1 for i, s in enumerate(shapes)}  # 0: unknown or outside
        n = len(LABELS)
        self.near = np.zeros((len(NEAR), len(shapes) + 1, n))
        self.step = np.zeros((n, n))
        self.first = np.zeros(n)
        self.allowed = np.array([[b[0] != "I" or a[1:] == b[1:] and a != "O" for b in LABELS] for a in LABELS])
        self.starts = np.array([b[0] != "I" for b in LABELS])

    def ids(self, runs: list[list[str]]) -> np.ndarray:
        """Padded shape numbers (sequences, length); -1 beyond the end."""
        out = np.full((len(runs), max(map(len, runs))), -1)
        for r, run in enumerate(runs):
            out[r, :len(run)] = [self.shapes.get(s, 0) for s in run]
        return out

    def _shifted(self, ids: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros_like(ids)
        if k < 0:
            out[:, -k:] = ids[:, :k]
        elif k > 0:
            out[:, :-k] = ids[:, k:]
        else:
            out = ids
        return np.maximum(out, 0)

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        return sum(self.near[j][self._shifted(ids, k)] for j, k in enumerate(NEAR))

    def viterbi(self, ids: np.ndarray) -> np.ndarray:
        """Best label numbers; padding repeats the last state for free."""
        e = self.emissions(ids)
        step = np.where(self.allowed, self.step, -np.inf)
        score = np.where(self.starts, self.first + e[:, 0], -np.inf)
        back = np.zeros(e.shape, np.int8)
        same = np.arange(len(LABELS))
        for t in range(1, ids.shape[1]):
            total = score[:, :, None] + step
            best = total.argmax(axis=1)
            live = (ids[:, t] >= 0)[:, None]
            back[:, t] = np.where(live, best, same)
            score = np.where(live, np.take_along_axis(total, best[:, None, :], 1)[:, 0] + e[:, t], score)
        out = np.zeros(ids.shape, np.int64)
        out[:, -1] = score.argmax(axis=1)
        rows = np.arange(len(ids))
        for t in range(ids.shape[1] - 1, 0, -1):
            out[:, t - 1] = back[rows, t, out[:, t]]
        return out

    def train(self, ids: np.ndarray, gold: np.ndarray, rounds: int = 150, rate: float = 0.3, decay: float = 1e-3) -> None:
        """Adaptive gradient ascent on the log-likelihood (forward-backward)."""
        n, length = ids.shape
        live = ids >= 0
        one = np.eye(len(LABELS))
        truth = one[np.maximum(gold, 0)] * live[:, :, None]
        pairs = np.einsum("nta,ntb->ab", truth[:, :-1], truth[:, 1:])
        moment = [np.full_like(x, 1e-8) for x in (self.near, self.step, self.first)]
        where = [self._shifted(ids, k) for k in NEAR]
        for _ in range(rounds):
            e = self.emissions(ids)
            step = np.where(self.allowed, np.exp(self.step), 0.0)
            a = np.zeros(e.shape)
            b = np.ones(e.shape)
            peak = e.max(axis=2, keepdims=True)
            p = np.exp(e - peak)
            a[:, 0] = np.where(self.starts, np.exp(self.first) * p[:, 0], 0.0)
            a[:, 0] /= a[:, 0].sum(axis=1, keepdims=True)
            for t in range(1, length):
                x = (a[:, t - 1] @ step) * p[:, t]
                a[:, t] = np.where(live[:, t, None], x / x.sum(axis=1, keepdims=True), a[:, t - 1])
            for t in range(length - 2, -1, -1):
                x = (p[:, t + 1] * b[:, t + 1]) @ step.T
                b[:, t] = np.where(live[:, t + 1, None], x / x.sum(axis=1, keepdims=True), b[:, t])
            own = a * b
            own = own / own.sum(axis=2, keepdims=True) * live[:, :, None]
            two = np.zeros_like(step)
            for t in range(1, length):
                x = a[:, t - 1, :, None] * step * (p[:, t] * b[:, t])[:, None, :]
                two += (x / np.maximum(x.sum(axis=(1, 2), keepdims=True), 1e-300) * live[:, t, None, None]).sum(axis=0)
            gap = truth - own
            slope = np.stack([np.stack([np.bincount(w.ravel(), gap[:, :, k].ravel(), self.near.shape[1]) for k in range(len(LABELS))], 1) for w in where])
            for x, g, m in zip((self.near, self.step, self.first), (slope, pairs - two, gap[:, 0].sum(axis=0)), moment):
                g = g - decay * x
                m += g * g
                x += rate * g / np.sqrt(m)


def labelled() -> list[tuple[list[str], list[str]]]:
    """Shapes and labels of the labelled table: ``[kind|text]`` marks data."""
    out = []
    for row in SENTENCES:
        plain, marks = "", []
        for part in re.split(r"(\[(?:email|ip|card|phone)\|(?:[^\[\]]|\[[^\]]*\])*\])", row):
            m = re.fullmatch(r"\[(\w+)\|(.*)\]", part)
            if m:
                marks.append((m[1], len(plain), len(plain) + len(m[2])))
            plain += m[2] if m else part
        shapes, labels = [], []
        for s, a, b in tokens(plain):
            kind = next((k for k, lo, hi in marks if lo <= a < hi), None)
            begin = any(a == lo for _, lo, _ in marks)
            shapes.append(s)
            labels.append("O" if kind is None else f"{'B' if begin else 'I'}-{kind}")
        out.append((shapes, labels))
    return out


_trained: dict = {}


def field() -> Field:
    """The trained field; trained once a process, always the same."""
    if "field" not in _trained:
        rows = labelled()
        f = Field(sorted({s for shapes, _ in rows for s in shapes}))
        ids = f.ids([s for s, _ in rows])
        gold = np.full(ids.shape, -1)
        for r, (_, labels) in enumerate(rows):
            gold[r, :len(labels)] = [LABELS.index(x) for x in labels]
        f.train(ids, gold)
        _trained["field"] = f
    return _trained["field"]


def _holds(kind: str, text: str) -> bool:
    """Plain checks of a labelled span."""
    if kind == "phone":
        return re.fullmatch(r"[\x20()./+0-9-]+", text) is not None and is_phone(text, 7)
    if kind == "card":
        return re.fullmatch(r"[\x20./0-9-]+", text) is not None and is_card(text)
    if kind == "ip":
        return re.fullmatch(r"[\x20.0-9-]+", text) is not None and is_ip(text)
    return _SPELT.fullmatch(text) is not None


def field_spans(f: Field, texts: list[str], base: list[list[tuple[str, int, int]]], most: int = 1 << 16) -> list[list[tuple[str, int, int]]]:
    """Spans that the field adds to the base spans of each text; a batch holds
    blocks of like length, about ``most`` tokens with padding."""
    runs, places = [], {}  # text, first token of the block, of its inner part, end of that, shape numbers
    for i, t in enumerate(texts):
        possible = [m.span() for m in _POSSIBLE.finditer(t)]
        if not possible:
            continue
        places[i] = found = tokens(t)
        start = np.array([a for _, a, _ in found])
        hot = np.zeros(len(found) + 1, np.int64)
        for a, b in possible:
            hot[np.searchsorted(start, a, "right") - 1:np.searchsorted(start, b)] = 1
        hot = np.cumsum(hot)
        n = np.array([f.shapes.get(s, 0) for s, _, _ in found], np.int32)
        for first in range(0, len(n), INNER):
            last = min(first + INNER, len(n))
            lo, hi = max(0, first - LAP), min(len(n), last + LAP)
            if hot[hi - 1] - (hot[first - 1] if first else 0):
                runs.append((i, lo, first, last, n[lo:hi]))
    runs.sort(key=lambda r: len(r[4]))
    labelled_, lo = [], 0
    while lo < len(runs):
        hi = lo + 1
        while hi < len(runs) and (hi + 1 - lo) * len(runs[hi][4]) <= most:
            hi += 1
        part, lo = runs[lo:hi], hi
        ids = np.full((len(part), len(part[-1][4])), -1)
        for r, run in enumerate(part):
            ids[r, :len(run[4])] = run[4]
        best = f.viterbi(ids)
        for (i, begin, first, last, n), row in zip(part, best):
            if row[first - begin:last - begin].any():
                labelled_.append((i, begin, first, last, row[:len(n)]))
    out: list[list] = [[] for _ in texts]
    for i, begin, first, last, row in sorted(labelled_, key=lambda r: r[:2]):
        t = texts[i]
        where, names = places[i], [LABELS[k] for k in row]
        at = first - begin
        while at < last - begin:
            if names[at][0] != "B":
                at += 1
                continue
            end, kind = at + 1, names[at][2:]
            while end < len(names) and names[end] == f"I-{kind}":
                end += 1
            s, e = where[begin + at][1], where[begin + end - 1][2]
            clear = not (s and (t[s - 1].isalnum() or t[s - 1] in "-./+_") or e < len(t) and (t[e].isalnum() or t[e] == "_"))
            if clear and _holds(kind, t[s:e]) and not any(a < e and s < b for _, a, b in base[i]) and not any(a < e and s < b for _, a, b in out[i]):
                out[i].append((kind, s, e))
            at = end
    return out


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def _parts(texts: list[str | None], limit: int = 1 << 19):
    """Slices of about ``limit`` characters."""
    lo, n = 0, 0
    for i, t in enumerate(texts):
        n += len(t or "")
        if n >= limit:
            yield lo, i + 1
            lo, n = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def _found(f: Field, texts: list[str]) -> tuple[list[list], list[list]]:
    base = [base_spans(t) for t in texts]
    return base, field_spans(f, texts, base)


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, counts of base spans, their digest, and all spans of every row."""
    prepare(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(field())

    def run(batches):
        f = shared.value
        for b in batches:
            every = b.column("text").to_pylist()
            for lo, hi in _parts(every):
                base, more = _found(f, [t or "" for t in every[lo:hi]])
                number = [[sum(s[0] == k for s in x) for x in base] for k in KINDS]
                joined = [_joined(x) for x in base]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), *[pa.array(x, pa.int64()) for x in number],
                     pa.array([hashlib.sha256(x.encode()).hexdigest() for x in joined], pa.string()),
                     pa.array([_joined(x + y) for x, y in zip(base, more)], pa.string())],
                    names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])
    kind = dict(documents.dtypes)["doc_id"]
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Every span is replaced by its kind in angle brackets; overlapping ones
    are one, named after the first."""
    out, done = [], 0
    merged: list[list] = []
    for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([k, a, b])
    for k, a, b in merged:
        out += [text[done:a], f"<{k}>"]
        done = b
    return "".join([*out, text[done:]])


def query(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced and n_chars counted anew."""
    prepare(spark)
    shared = spark.sparkContext.broadcast(field())

    def run(batches):
        f = shared.value
        for b in batches:
            every = b.column("text").to_pylist()
            for lo, hi in _parts(every):
                texts = [t or "" for t in every[lo:hi]]
                base, more = _found(f, texts)
                clean = [None if old is None else redact(t, x + y) if x or y else t for old, t, x, y in zip(every[lo:hi], texts, base, more)]
                part = b.slice(lo, hi - lo)
                yield part.set_column(part.schema.get_field_index("text"), part.schema.field("text"), pa.array(clean, part.schema.field("text").type))
    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" not in docs.columns:
        return out
    kind = dict(docs.dtypes)["n_chars"]
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
