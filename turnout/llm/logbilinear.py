"""Language-model scoring with a log-bilinear neural model.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of the lower-cased (A-Z) whole text and
one end.  Every training token is counted in Spark; tokens are told apart by 96-bit
digests, so a token of any length has a fixed width.

Base score: add-one unigrams over all training tokens.  The HEAVY most frequent
tokens (a bounded table of 6 MB, sent to every task) are scored where the text is read, so no hot token is
shuffled; all others are joined with their counts by digest.

Model: of the VOCABULARY most frequent tokens (end among them) and one class for
all others, the next one is predicted from the CONTEXT classes before it.  The context
gives q = sum_i c_i * r[w_i] (the log-bilinear form with diagonal c_i) and class w has
the score q . t[w] + b[w].  The parameters are trained by noise-contrastive estimation on
ALL training documents, dealt into ROUNDS: in a round every task runs mini-batches over
its own rows from the common start, and the tasks' parameters are averaged by their tokens
(an exact fixed-point sum in Spark).  The driver sees one set of parameters, whose size is
fixed by VOCABULARY and WIDTH, never texts.

Scoring normalises exactly: batched matrix products give log sum exp over all classes for
each distinct context of a task.  A token outside the vocabulary has the probability of its
class times (c + 1) / (N' + V' + 1), where N' and V' count training tokens and types
outside the vocabulary, so the probabilities of all known tokens and one unknown add up to 1.

The same table read in the same splits gives the same model; other splits average other
parts.  Null and empty texts consist of their end.  A null doc_id counts as an empty one (it
trains, held_out is false).  Repeated rows are documents of their own.  Very long texts
are whole: memory is some hundred bytes per byte of the longest one.  An empty table gives no rows; without
training documents every class is equally likely.  Of equally frequent tokens those with the smaller digests enter
the tables.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_CODE, LOWER, blocks, list_column, mix, powers, prepare, stored, table, text_bytes, words

VOCABULARY, WIDTH, CONTEXT, HEAVY = 1024, 16, 2, 1 << 18
ROUNDS, MINIBATCH, NOISE, RATE = 2, 1024, 32, 0.25
#: bytes of text, and tokens, that are worked on at once
BLOCK, TOKENS = 2 << 20, 1 << 18
IS_TOKEN = np.ones(256, bool)
IS_TOKEN[9:14] = IS_TOKEN[32] = False
#: digest of the end of a text: no word has it but by a 96-bit collision
END = (np.uint64(0x656E64), np.int32(0x656E64))
_SECOND = mix(BYTE_CODE ^ np.uint64(0x5851F42D4C957F2D))
_SCALE = 1 << 20  # fixed point of the averaged parameters


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both parts of the digest of every token of a block (each text's end last), and the first
    token of each text, one more at the end."""
    w = words(data, offsets, IS_TOKEN)
    p, q = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_SECOND[LOWER[data]] * p[:len(data)], out=sums[1:])
    second = (mix((sums[w.end] - sums[w.start]) * q[w.start] + (w.end - w.start).astype(np.uint64)) >> np.uint64(33)).astype(np.int32)
    n = len(offsets) - 1
    first = w.first + np.arange(n + 1)
    ends = first[1:] - 1
    d1, d2 = np.full(len(w.code) + n, END[0]), np.full(len(w.code) + n, END[1])
    word = np.ones(len(d1), bool)
    word[ends] = False
    d1[word], d2[word] = w.code, second
    return d1, d2, first


def _count(batches):
    """Tokens of each block with their number."""
    for b in batches:
        data, offsets = text_bytes(b.column("text"))
        for _, _, part, offs in blocks(data, offsets, BLOCK):
            d1, d2, _ = tokens(part, offs)
            order = np.argsort(d1)  # two second parts of one first part may alternate: more rows, same sums
            d1, d2 = d1[order], d2[order]
            new = np.flatnonzero(np.concatenate([[True], (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])]))
            yield pa.RecordBatch.from_arrays([pa.array(d1[new].view(np.int64)), pa.array(d2[new]), pa.array(np.diff(np.append(new, len(d1))))], names=["d1", "d2", "c"])


class Lexicon:
    """The HEAVY most frequent tokens: counts and classes by digest.  Class 0 is the
    end, ``len(counts) - 1`` any token outside the vocabulary; one more stands before a text's first token."""

    def __init__(self, d1: np.ndarray, d2: np.ndarray, count: np.ndarray, total: int, types: int, vocabulary: int):
        """Arrays by falling frequency; ``total`` and ``types`` of all training tokens."""
        d1 = d1.astype(np.int64).view(np.uint64)
        end = (d1 == END[0]) & (d2 == END[1])
        words_ = np.flatnonzero(~end)[:max(vocabulary - 2, 0)]
        classes = np.full(len(d1), len(words_) + 1, np.int16)
        classes[words_] = np.arange(1, len(words_) + 1)
        classes[end] = 0
        inside = count[words_].sum() + count[end].sum()
        self.counts = np.concatenate([[count[end].sum()], count[words_], [total - inside]]).astype(np.float64)
        self.total, self.types = int(total), int(types)
        self.other = float(total - inside + (types - len(words_) - int(end.any())) + 1)  # N' + V' + 1
        order = np.argsort(d1, kind="stable")
        self.d1, self.d2, self.count, self.classes = d1[order], d2[order].astype(np.int32), count[order].astype(np.int64), classes[order]

    def find(self, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
        """Place in the table, or -1.  Equal first parts are told apart by the second."""
        if not len(self.d1):
            return np.full(len(d1), -1)
        at = np.searchsorted(self.d1, d1)
        at[at == len(self.d1)] = 0
        for _ in range(4):  # more than one step only where first parts are equal
            wrong = np.flatnonzero((self.d1[at] == d1) & (self.d2[at] != d2) & (at + 1 < len(self.d1)))
            if not len(wrong):
                break
            at[wrong] += 1
        return np.where((self.d1[at] == d1) & (self.d2[at] == d2), at, -1)


def _encode(lexicon):
    """Per document: tokens, known ones and sums of log10(c + 1) among heavy tokens (all, and
    those outside the vocabulary), its classes, and the digests of the others."""
    def run(batches):
        lex = lexicon.value
        n_class = len(lex.counts)
        logs = np.log10(lex.count + 1.0)
        for b in batches:
            data, offsets = text_bytes(b.column("text"))
            for lo, hi, part, offs in blocks(data, offsets, BLOCK):
                d1, d2, first = tokens(part, offs)
                at = lex.find(d1, d2)
                found = at >= 0
                doc = np.repeat(np.arange(hi - lo), np.diff(first))
                cls = np.full(len(d1), n_class - 1, np.int16)
                cls[found] = lex.classes[at[found]]
                cls[first[1:] - 1] = 0
                value = np.zeros(len(d1))
                value[found] = logs[at[found]]
                rare = np.flatnonzero(~found & (lex.types > len(lex.d1)))  # counted, but not in the table
                outside = cls == n_class - 1
                raw = cls.tobytes()
                cut = (first * 2).astype(np.int32)
                ids = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(cut.tobytes()), pa.py_buffer(raw)])
                n = np.bincount(doc[rare], minlength=hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [b.column("key").slice(lo, hi - lo), b.column("doc_id").slice(lo, hi - lo), b.column("held_out").slice(lo, hi - lo), pa.array(np.diff(first)),
                     pa.array(np.bincount(doc[found], minlength=hi - lo)), pa.array(np.bincount(doc, value, hi - lo).astype(float)),
                     pa.array(np.bincount(doc[outside], minlength=hi - lo)), pa.array(np.bincount(doc[outside], value[outside], hi - lo).astype(float)),  # (no rows: whole numbers)
                     ids, list_column(d1[rare].view(np.int64), n, pa.int64()), list_column(d2[rare], n, pa.int32())],
                    names=["key", "doc_id", "held_out", "n_tokens", "n_known", "logs", "n_outside", "logs_outside", "ids", "d1", "d2"])
    return run


class Model:
    """Parameters: r (context classes, one more for the start), t and b (predicted
    classes), c (one diagonal per place of the context)."""

    def __init__(self, r, t, b, c):
        self.r, self.t, self.b, self.c = r, t, b, c

    @classmethod
    def start(cls, counts: np.ndarray) -> "Model":
        """Unigram biases, small seeded vectors: before training the model is the unigram."""
        rng = np.random.default_rng(7)
        k = len(counts)
        return cls(rng.normal(0, 0.1, (k + 1, WIDTH)).astype(np.float32), np.zeros((k, WIDTH), np.float32),
                   np.log((counts + 1) / (counts + 1).sum()).astype(np.float32), np.ones((CONTEXT, WIDTH), np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.r, self.t, self.b, self.c)])

    @classmethod
    def of(cls, flat: np.ndarray, k: int) -> "Model":
        flat = flat.astype(np.float32)
        a, e = (k + 1) * WIDTH, (2 * k + 1) * WIDTH
        return cls(flat[:a].reshape(k + 1, WIDTH), flat[a:e].reshape(k, WIDTH), flat[e:e + k], flat[e + k:].reshape(CONTEXT, WIDTH))


def contexts(ids: np.ndarray, first: np.ndarray, start: int) -> np.ndarray:
    """(tokens, CONTEXT): the classes before each token, the nearest one first; ``start`` before the text."""
    at = np.arange(len(ids)) - np.repeat(first[:-1], np.diff(first))
    out = np.full((len(ids), CONTEXT), start, np.int64)
    for i in range(CONTEXT):
        out[i + 1:, i] = ids[:-i - 1] if len(ids) > i + 1 else ids[:0]
        out[at <= i, i] = start
    return out


def train(model: Model, counts: np.ndarray, stream, seed: int) -> tuple[Model, int]:
    """Noise-contrastive estimation by mini-batches (Adagrad) over ``stream`` of (contexts, targets);
    the noise is the unigram.  Returns the parameters and the tokens seen."""
    k = len(counts)
    rng = np.random.default_rng(seed)
    p = (counts + 1) / (counts + 1).sum()
    edges = np.cumsum(p)
    log_kp = (np.log(p) + np.log(NOISE)).astype(np.float32)
    r, t, b, c = model.r.copy(), model.t.copy(), model.b.copy(), model.c.copy()
    past = [np.full(x.shape, 1e-2, np.float32) for x in (r, t, b, c)]
    lanes = np.arange(WIDTH)
    seen = 0

    def scatter(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        return np.bincount((rows[:, None] * WIDTH + lanes).ravel(), values.ravel(), n * WIDTH).reshape(n, WIDTH).astype(np.float32)

    def sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    for ctx, target in stream:
        for lo in range(0, len(target), MINIBATCH):
            h, w = ctx[lo:lo + MINIBATCH], target[lo:lo + MINIBATCH]
            noise = np.minimum(np.searchsorted(edges, rng.random(NOISE), "right"), k - 1)
            parts = [r[h[:, i]] for i in range(CONTEXT)]
            q = sum(x * c[i] for i, x in enumerate(parts))
            good = 1 - sigmoid((q * t[w]).sum(axis=1) + b[w] - log_kp[w])
            bad = -sigmoid(q @ t[noise].T + b[noise] - log_kp[noise])
            dq = good[:, None] * t[w] + bad @ t[noise]
            grads = [sum(scatter(h[:, i], dq * c[i], k + 1) for i in range(CONTEXT)),
                     scatter(w, good[:, None] * q, k) + scatter(noise, bad.T @ q, k),
                     (np.bincount(w, good, k) + np.bincount(noise, bad.sum(axis=0), k)).astype(np.float32),
                     np.stack([(dq * x).sum(axis=0) for x in parts])]
            for x, g, s in zip((r, t, b, c), grads, past):
                g /= len(w)
                s += g * g
                x += RATE * g / np.sqrt(s)
            seen += len(w)
    return Model(r, t, b, c), seen


class Scorer:
    """Normalised log probabilities; the sums of a context are kept."""

    def __init__(self, model: Model):
        self.model, k = model, len(model.b)
        self.known = np.full((k + 1) ** CONTEXT, np.nan)
        self.place = (k + 1) ** np.arange(CONTEXT)

    def query(self, ctx: np.ndarray) -> np.ndarray:
        return sum(self.model.r[ctx[:, i]] * self.model.c[i] for i in range(CONTEXT))

    def __call__(self, ctx: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log probability of each target class."""
        m = self.model
        name = ctx @ self.place
        missing = np.zeros(len(self.known), bool)
        missing[name] = True
        missing &= np.isnan(self.known)
        new = np.flatnonzero(missing)
        for lo in range(0, len(new), 4096):
            part = new[lo:lo + 4096]
            s = self.query(part[:, None] // self.place % (len(m.b) + 1)) @ m.t.T + m.b
            top = s.max(axis=1)
            s -= top[:, None]
            self.known[part] = top + np.log(np.exp(s, out=s).sum(axis=1, dtype=np.float64))
        return (self.query(ctx) * m.t[target]).sum(axis=1, dtype=np.float64) + m.b[target] - self.known[name]


def _ids(col: pa.Array):
    """(classes, first one of each text) of blocks of whole texts; every text has its end."""
    if len(col):
        offsets = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
        raw = np.frombuffer(col.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(np.int16)
        for _, _, part, first in blocks(raw, (offsets - offsets[0]) // 2, TOKENS):
            yield part.astype(np.int64), first


def _learn(state):
    """A task's parameters after its rows, in fixed point, weighed by its tokens."""
    def run(batches):
        flat, counts = state.value
        k = len(counts)

        def stream():
            for b in batches:
                for ids, first in _ids(b.column("ids")):
                    ctx = contexts(ids, first, k)
                    mixed = np.random.default_rng(len(ids)).permutation(len(ids))
                    yield ctx[mixed], ids[mixed]
        model, seen = train(Model.of(flat, k), counts, stream(), 11)
        if seen:
            fixed = np.rint(np.clip(model.flat().astype(np.float64), -512, 512) * _SCALE).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(fixed), dtype=np.int32)), pa.array(fixed), pa.array(np.full(len(fixed), seen, np.int64))], names=["at", "value", "weight"])
    return run


def fit(encoded: DataFrame, counts: np.ndarray) -> Model:
    """The model of all rows of ``encoded`` (their classes in ids) that are not held out."""
    sc = encoded.sparkSession.sparkContext
    model = Model.start(counts)
    for i in range(ROUNDS):
        state = sc.broadcast((model.flat(), counts))
        parts = encoded.where("NOT held_out").where(F.pmod(F.xxhash64("key"), F.lit(ROUNDS)) == i).select("ids").mapInArrow(_learn(state), "at int, value long, weight long")
        whole = F.sum(F.col("value").cast("decimal(19,0)") * F.col("weight").cast("decimal(12,0)"))
        rows = parts.groupBy("at").agg((whole.cast("double") / F.sum("weight") / _SCALE).alias("mean")).toPandas()
        if len(rows):
            flat = np.empty(len(rows))
            flat[rows["at"].to_numpy()] = rows["mean"].to_numpy()
            model = Model.of(flat, len(counts))
        state.unpersist()
    return model


def _score(state):
    def run(batches):
        flat, k = state.value
        scorer = Scorer(Model.of(flat, k))
        for b in batches:
            parts = [np.add.reduceat(scorer(contexts(ids, first, k), ids), first[:-1]) for ids, first in _ids(b.column("ids"))]
            names = [x for x in b.schema.names if x != "ids"]
            if parts:
                yield pa.RecordBatch.from_arrays([*(b.column(x) for x in names), pa.array(np.concatenate(parts) / np.log(10))], names=[*names, "model"])
    return run


def frequent(counts: DataFrame, most: int) -> pa.Table:
    """At most about ``most`` of the most frequent tokens, by falling frequency: all
    of the highest classes of frequency (1/32 of a power of two wide) that fit, and of the
    next class those with the smallest digests."""
    classed = counts.withColumn("level", F.floor(F.log2("c") * 32).cast("int"))
    levels = sorted(classed.groupBy("level").agg(F.count("*").alias("n")).collect(), reverse=True)  # some 2,000 at most
    chosen = classed
    for r in levels:
        if r.n > most:
            cut = int(-(1 << 63) + 0.98 * most / r.n * (1 << 64))
            chosen = classed.where((F.col("level") > r.level) | ((F.col("level") == r.level) & (F.col("d1") < cut)))
            break
        most -= r.n
    return chosen.select("d1", "d2", "c").toArrow().sort_by([("c", "descending"), ("d1", "ascending"), ("d2", "ascending")])


def score(documents: DataFrame, vocabulary: int = VOCABULARY, heavy: int = HEAVY) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    spark = documents.sparkSession
    prepare(spark)
    sc = spark.sparkContext
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    held = F.crc32(name.cast("binary")) % 7 == 2
    docs = documents.select("doc_id", held.alias("held_out"), "text")
    parts = docs.where("NOT held_out").select("text").mapInArrow(_count, "d1 long, d2 int, c long")
    counts = stored(parts.groupBy("d1", "d2").agg(F.sum("c").alias("c")), "counts")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = frequent(counts, heavy)
    lex = Lexicon(*(top.column(x).to_numpy() for x in ("d1", "d2", "c")), total.n, total.v, vocabulary)
    shared = sc.broadcast(lex)
    kind = dict(documents.dtypes)["doc_id"]
    encoded = stored(docs.withColumn("key", F.monotonically_increasing_id()).select("key", "doc_id", "held_out", "text").mapInArrow(
        _encode(shared), f"key long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, logs double, n_outside long, logs_outside double, ids binary, d1 array<long>, d2 array<int>"), "encoded")
    model = fit(encoded, lex.counts)
    state = sc.broadcast((model.flat(), len(lex.counts)))
    scored = encoded.select("key", "doc_id", "held_out", "n_tokens", "n_known", "logs", "n_outside", "logs_outside", "ids").mapInArrow(
        _score(state), f"key long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, logs double, n_outside long, logs_outside double, model double")
    rare = encoded.where("size(d1) > 0").select("key", F.explode(F.arrays_zip("d1", "d2")).alias("x")).select("key", "x.d1", "x.d2")
    rare = (rare.join(counts, ["d1", "d2"]).groupBy("key").agg(F.count("*").alias("n_rare"), F.sum(F.log10(F.col("c") + 1.0)).alias("logs_rare")))
    rest = F.coalesce("logs_rare", F.lit(0.0))
    return (scored.join(rare, "key", "left")
            .select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("n_rare", F.lit(0))).alias("n_known"), F.lit(lex.total).cast("long").alias("train_tokens"),
                    (F.col("logs") + rest - F.col("n_tokens") * float(np.log10(lex.total + lex.types + 1))).alias("base_score"),
                    (F.col("model") + F.col("logs_outside") + rest - F.col("n_outside") * float(np.log10(lex.other))).alias("score")))


def query(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
