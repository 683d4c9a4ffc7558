"""Language identification with interpolated Kneser-Ney character models.

One model of order four per language, learnt from labelled documents.  Texts are
lower-cased; every run of characters that are neither letters nor marks is one
space; three start symbols come first.  The highest order uses counts, lower
orders the number of different left neighbours; each order has one discount
n1 / (n1 + 2 n2) and is interpolated down to a uniform distribution.

Each language keeps, per order, sorted arrays of gram hashes with their
discounted shares and of context hashes with their back-off weights.  Grams of
the highest order that any language has seen are also kept in one sorted array
with the finished log-probabilities of all languages, so most characters need
one look-up; the others are computed from the languages' own arrays.

The prediction is the language of lowest cross-entropy per character.  It is
rejected if that is above the language's limit, learnt from labelled documents
outside the counted ones: their median under their own language plus WIDE robust
spreads (median deviations; a spread shrinks with the root of the length down to that
of LONG symbols), or, where that is more, half way from the median to what the other
languages' documents reach, each scored as if its own language had not been learnt (the
lowest but FOREIGN of them).  Odd or mislabelled documents so hardly move it.  A language
without such documents takes the median and spread of all languages together; with
none in any language nothing is rejected.

Only text and non-null lang of documents with crc32(doc_id as text) mod 4 <> 2 are
learnt from: about SAMPLE documents of each language, picked by hash (the
documented bound of the sample); three quarters give counts, one quarter calibrates.
Every document is scored over its whole text.

Null texts and texts without a letter are ``und``, score 0, rejected.  With nothing to
learn from every text is ``und``.  Rows are scored one by one, so repeated rows
and null doc_ids (not held out, not learnt from) need no rule; extra columns are ignored.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, mix, prepare, table, text_bytes

ORDER, SAMPLE, SHARP = 4, 400, 40
WIDE, LONG, FOREIGN, FEW = 4.0, 256, 0.05, 8  # the limits; below FEW texts the spread is that of all languages
BLOCK = 1 << 18  # bytes scored at a time: every symbol takes a few rows of doubles
START = 1  # a control character; texts have a space in its place
_cache: dict = {}


# ------------------------------------------------------------------ text to symbols

def _kinds() -> np.ndarray:
    """Per code point: 2 letter, 1 mark, 0 other."""
    if "kinds" not in _cache:
        k = np.zeros(0x110000, np.uint8)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                k[i] = 2
            elif unicodedata.combining(c):
                k[i] = 1
        _cache["kinds"] = k
    return _cache["kinds"]


def symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts in a row (START begins a text, thrice), the position of
    each text's first symbol (one more at the end), and whether it has a letter."""
    kinds = _kinds()
    low = [chr(START) * 3 + (t or "").lower().replace(chr(START), " ") for t in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.zeros(len(low) + 1, np.int64)
    np.cumsum([len(t) for t in low], out=at[1:])
    kind = kinds[code]
    letters = np.zeros(len(code) + 1, np.int64)
    np.cumsum(kind == 2, out=letters[1:])
    code = np.where((kind > 0) | (code == START), code, np.uint32(32))
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 32) | (code[:-1] != 32)
    where = np.zeros(len(code) + 1, np.int64)
    np.cumsum(keep, out=where[1:])
    return code[keep], where[at], letters[at[1:]] > letters[at[:-1]]


def gram_hash(columns: list[np.ndarray]) -> np.ndarray:
    acc = np.full(len(columns[0]), len(columns), np.uint64)
    for c in columns:
        acc = (acc + c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return mix(acc)


def _columns(code: np.ndarray, at: np.ndarray, n: int) -> list[np.ndarray]:
    """The n symbols that end at each position."""
    return [code[at - k] for k in range(n - 1, -1, -1)]


# ------------------------------------------------------------------ sorted hash arrays

class Table:
    """Sorted hashes with values; look-up by the leading bits, then in order."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], values[order]
        self.shift = np.uint64(64 - max(1, (2 * max(1, len(hashes)) - 1).bit_length()))
        size = 1 << (64 - int(self.shift))
        top = (self.hashes >> self.shift).astype(np.int64)
        self.start = np.searchsorted(top, np.arange(size)).astype(np.int32)
        self.longest = int(np.bincount(top, minlength=1).max()) if len(top) else 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of each hash, -1 if it is missing."""
        out = np.full(len(h), -1, np.int64)
        if not len(self.hashes):
            return out
        first = self.start[(h >> self.shift).astype(np.int64)].astype(np.int64)
        todo = None
        for k in range(self.longest):
            i = np.minimum(first + k, len(self.hashes) - 1)
            if todo is None:
                hit = self.hashes[i] == h
                out[hit] = i[hit]
                todo = np.flatnonzero(~hit)
            else:
                hit = self.hashes[i] == h[todo]
                out[todo[hit]] = i[hit]
                todo = todo[~hit]
            first = first[~hit]
            if not len(todo):
                break
        return out


class Language:
    """Interpolated Kneser-Ney from the counts of the highest-order grams."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, alphabet: int):
        self.base = 1.0 / (alphabet + 1)
        self.orders: dict[int, tuple[Table, Table]] = {}
        count = counts.astype(np.float64)
        for n in range(ORDER, 0, -1):
            n1, n2 = (count == 1).sum(), (count == 2).sum()
            discount = float(np.clip(n1 / max(1.0, n1 + 2 * n2), 0.1, 0.95))
            if n > 1:
                context = gram_hash([grams[:, k] for k in range(n - 1)])
            else:
                context = np.zeros(len(grams), np.uint64)
            seen, of = np.unique(context, return_inverse=True)
            total, kinds = np.bincount(of, count), np.bincount(of)
            share = Table(gram_hash([grams[:, k] for k in range(n)]), (count - discount) / total[of])
            self.orders[n] = share, Table(seen, discount * kinds / total)
            if n > 1:
                grams, count = np.unique(grams[:, 1:], axis=0, return_counts=True)
                count = count.astype(np.float64)

    def logs(self, columns: list[np.ndarray]) -> np.ndarray:
        """log p(last symbol | the ones before)."""
        p = np.full(len(columns[-1]), self.base)
        for n in range(1, ORDER + 1):
            own = columns[ORDER - n:]
            share, weight = self.orders[n]
            context = gram_hash(own[:-1]) if n > 1 else np.zeros(len(p), np.uint64)
            i, j = share.find(gram_hash(own)), weight.find(context)
            p = np.where(i >= 0, share.values[i], 0.0) + np.where(j >= 0, weight.values[j], 1.0) * p
        return np.log(p)


class Model:
    """All languages, the shared table of finished log-probabilities, and the limits."""

    def __init__(self, counts: pd.DataFrame):
        self.names = sorted(counts["lang"].unique())
        self.middle = np.full(len(self.names), np.inf)  # no limit before calibrate()
        self.spread = np.ones(len(self.names))
        self.half = np.full(len(self.names), np.inf)
        code = {g: [ord(c) for c in g] for g in counts["gram"].unique()}
        rows = np.array([code[g] for g in counts["gram"]], np.uint32).reshape(-1, ORDER)
        alphabet = len(np.unique(rows)) if len(rows) else 1
        lang, number = counts["lang"].to_numpy(), counts["n"].to_numpy()
        self.languages = [Language(rows[lang == x], number[lang == x], alphabet) for x in self.names]
        every = np.unique(rows, axis=0)
        columns = [every[:, k] for k in range(ORDER)]
        logs = np.stack([x.logs(columns) for x in self.languages], 1) if self.names else np.zeros((0, 0))
        self.shared = Table(gram_hash(columns), logs.astype(np.float32))

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text and language the mean of -log p, the symbols scored, and
        whether the text has a letter."""
        code, first, has = symbols(texts)
        at = np.flatnonzero(code != START)
        columns = _columns(code, at, ORDER)
        i = self.shared.find(gram_hash(columns))
        logs = self.shared.values[np.maximum(i, 0)].astype(np.float64)
        miss = np.flatnonzero(i < 0)
        if len(miss):
            rest = [c[miss] for c in columns]
            for k, x in enumerate(self.languages):
                logs[miss, k] = x.logs(rest)
        cut = np.searchsorted(at, first)
        n = np.diff(cut)
        sums = np.zeros((len(at) + 1, len(self.names)))
        np.cumsum(logs, axis=0, out=sums[1:])
        return -(sums[cut[1:]] - sums[cut[:-1]]) / np.maximum(n, 1)[:, None], n, has

    def calibrate(self, frame: pd.DataFrame) -> None:
        """frame: lang, entropy, n of labelled texts under their own language, and
        other, foreign: the best of the other languages and its entropy."""
        if not len(frame):
            return
        middles = frame.groupby("lang")["entropy"].median()
        away = (frame["entropy"] - frame["lang"].map(middles)).abs() / np.sqrt(1 / LONG + 1 / np.maximum(frame["n"], 1))
        # the surprise of one symbol spreads by about a nat
        pooled, wide = frame["entropy"].median(), max(1.0, 1.4826 * away.median())
        for k, x in enumerate(self.names):
            own = frame["lang"] == x
            self.middle[k] = middles.get(x, pooled)
            self.spread[k] = max(1.0, 1.4826 * away[own].median()) if own.sum() >= FEW else wide
            foreign = frame.loc[frame["other"] == x, "foreign"]
            self.half[k] = (self.middle[k] + foreign.quantile(FOREIGN)) / 2 if len(foreign) else -np.inf

    def limits(self, k: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Highest accepted cross-entropy of texts of n symbols in language k."""
        return np.maximum(self.middle[k] + WIDE * self.spread[k] * np.sqrt(1 / LONG + 1 / np.maximum(n, 1)), self.half[k])

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy and acceptance of each text."""
        if not self.names or not texts:
            z = np.zeros(len(texts))
            return ["und"] * len(texts), z, z, z > 0
        entropy, n, has = self.entropies(texts)
        best = entropy.argmin(axis=1)
        low = entropy[np.arange(len(best)), best]
        score = 1.0 / np.exp(-(entropy - low[:, None]) * np.minimum(n, SHARP)[:, None]).sum(axis=1)
        taken = has & (low <= self.limits(best, n))
        return [self.names[k] if h else "und" for k, h in zip(best, has)], np.where(has, score, 0.0), np.where(has, low, 0.0), taken


# ------------------------------------------------------------------ Spark

def _count(batches):
    """lang, gram, n of the sampled texts, added up per batch."""
    for b in batches:
        langs = b.column("lang").to_pylist()
        texts = b.column("text").to_pylist()
        for x in sorted(set(langs)):
            code, _, _ = symbols([t for t, own in zip(texts, langs) if own == x])
            at = np.flatnonzero(code != START)
            rows = np.stack(_columns(code, at, ORDER), 1).astype(np.uint32) if len(at) else np.zeros((0, ORDER), np.uint32)
            rows, n = np.unique(rows, axis=0, return_counts=True)
            grams = [r.tobytes().decode("utf-32-le", "replace") for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array([x] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(n, pa.int64())], names=["lang", "gram", "n"])


def fit(documents: DataFrame, sample: int = SAMPLE) -> Model:
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    labelled = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (rest != 2)).select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    if not sizes:
        return Model(pd.DataFrame({"lang": [], "gram": [], "n": []}))
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(17)), F.lit(1 << 30))
    share = F.create_map(*[v for k, n in sizes.items() for v in (F.lit(k), F.lit(int(min(1.0, sample / n) * (1 << 30))))])
    picked = labelled.where(draw < F.element_at(share, F.col("lang")))
    part = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(23)), F.lit(4))


    def counted(rows: DataFrame) -> pd.DataFrame:
        return (rows.select("lang", "text").mapInArrow(_count, "lang string, gram string, n long")
                .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())
    counts = counted(picked.where(part > 0))
    late = sorted(set(sizes) - set(counts["lang"]))  # languages whose few texts are all set aside: they learn from these
    if late:
        counts = pd.concat([counts, counted(picked.where(F.col("lang").isin(late)))], ignore_index=True)
    model = Model(counts)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def own(batches):
        m = shared.value
        for b in batches:
            langs = b.column("lang").to_pylist()
            entropy, n, has = m.entropies(b.column("text").to_pylist())
            known = np.array([i for i, x in enumerate(langs) if x in m.names and has[i]], np.int64)
            k = np.array([m.names.index(langs[i]) for i in known], np.int64)
            mine, rest = entropy[known, k], entropy[known]
            rest[np.arange(len(known)), k] = np.inf  # as if the text's language had not been learnt
            best, several = rest.argmin(axis=1), len(m.names) > 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([langs[i] for i in known], pa.string()), pa.array(mine, pa.float64()), pa.array(n[known], pa.int64()),
                 pa.array([m.names[j] if several else None for j in best], pa.string()), pa.array(rest[np.arange(len(known)), best], pa.float64())],
                names=["lang", "entropy", "n", "other", "foreign"])
    if model.names:
        model.calibrate(picked.where((part == 0) & ~F.col("lang").isin(late)).select("lang", "text").mapInArrow(own, "lang string, entropy double, n long, other string, foreign double").toPandas())
    return model


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, text_id, lang_pred, score, entropy, accepted of every row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in batches:
            data, offsets = text_bytes(b.column("text"))
            for lo, hi, _, _ in blocks(data, offsets, BLOCK):
                name, score, entropy, taken = m.predict(b.column("text").slice(lo, hi - lo).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), b.column("text_id").slice(lo, hi - lo), pa.array(name, pa.string()),
                                                  pa.array(score, pa.float64()), pa.array(entropy, pa.float64()), pa.array(taken, pa.bool_())],
                                                 names=["doc_id", "text_id", "lang_pred", "score", "entropy", "accepted"])
    kind = dict(documents.dtypes)["doc_id"]
    return (documents.select("doc_id", "text", F.xxhash64("text").alias("text_id"))
            .mapInArrow(run, f"doc_id {kind}, text_id long, lang_pred string, score double, entropy double, accepted boolean"))


def query(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return identify(docs, fit(docs)).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score", "entropy", "accepted")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; rejected ones go.  Learns from
    the documents that it is given."""
    prepare(spark)
    model = fit(docs)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in batches:
            data, offsets = text_bytes(b.column("text"))
            for lo, hi, _, _ in blocks(data, offsets, BLOCK):
                part = b.slice(lo, hi - lo)
                yield part.filter(pa.array(m.predict(part.column("text").to_pylist())[3], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
