"""N-gram Jaccard join with Bayesian candidate pruning.

A text is the set of its runs of five consecutive words (a text of one to four
words: that one run).  Documents with Jaccard similarity of 0.8 or more are linked.

1. Documents with equal sets are one *class*; only its smallest doc_id (the
   representative) goes on, with the number of copies.
2. 128 MinHash values per representative.  Thirty-two bands of four values give
   candidate buckets: a pair of similarity 0.8 shares none with probability
   (1 - 0.8^4)^32 < 1e-7.  Buckets with the same members are kept once.
3. A bucket is cut into blocks of about BLOCK members, and every pair of blocks
   is a task's work, so no bucket must fit in one task and no pairs become
   rows.  Pairs are taken in the first band that they share; their MinHash
   values are compared STEP at a time and a pair is dropped as soon as the
   posterior probability (uniform prior) of similarity >= 0.8 given the matches
   so far falls below TOLERANCE.
4. What is left is verified exactly on the whole shingle sets, again by block
   pairs.  Only members travel, never pairs: the first pass returns the members that
   have a surviving partner, the second prunes these again and verifies the pairs
   that remain.  A task returns for each document the documents it links to (a number)
   and the smallest document linked to it inside the task; components join these.

Nothing is capped or sampled; a pair is lost only with the probabilities above.

Nulls and odd rows: a null, empty or word-free text links with nothing.  Rows
with a null doc_id are returned with null class and no links and take part in
nothing.  Repeated rows (equal doc_id and text) are copies of each other and each
gets a result; a doc_id with several texts is one document with several versions.
An empty table gives no rows.  Very long texts are whole: memory is some hundred bytes per
byte of the longest one.  Extra columns are ignored.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bitmap
from .common import binary_column, blocks, groups, list_column, mix, prepare, stored, table, text_bytes, words
from .components import connected

SHINGLE, THRESHOLD = 5, 0.8
HASHES, BANDS, STEP, TOLERANCE = 128, 32, 16, 1e-6
BLOCK = 1024
ROWS = HASHES // BANDS
_rng = np.random.default_rng(77)
_MULTIPLY = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)


def posterior(matches: int, compared: int, threshold: float = THRESHOLD) -> float:
    """P(similarity >= threshold | matches of compared), uniform prior: the
    upper tail of Beta(matches + 1, compared - matches + 1)."""
    n = compared + 1
    return sum(comb(n, k) * threshold**k * (1 - threshold) ** (n - k) for k in range(matches + 1))


def least_matches(compared: int) -> int:
    """Fewer matches than this drop the pair."""
    return next(m for m in range(compared + 1) if posterior(m, compared) >= TOLERANCE)


LEAST = {n: least_matches(n) for n in range(STEP, HASHES + 1, STEP)}


def shingles(w) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of a block of documents, and the row of each."""
    n = w.counts
    row = np.repeat(np.arange(len(n)), n)
    code, at = w.grams(SHINGLE)
    rows = [row[at]]
    codes = [code]
    for k in range(1, SHINGLE):
        short, start = w.grams(k)
        mine = n[row[start]] == k
        codes.append(mix(short[mine] + np.uint64(k)))
        rows.append(row[start[mine]])
    code, row = np.concatenate(codes), np.concatenate(rows)
    order = np.lexsort((code, row))
    code, row = code[order], row[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (row[1:] != row[:-1])
    return code[new], row[new]


def _minhash(code: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(code), 512):
        part = (code[None, lo:lo + 512] ^ _FLIP[:, None]) * _MULTIPLY[:, None]
        np.minimum(out, part.min(axis=1), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def _sketch(batches):
    """doc_id, text_id, set digest, signature and band keys of each document."""
    for b in batches:
        data, offsets = text_bytes(b.column("text"))
        for lo, hi, part, offs in blocks(data, offsets):
            code, row = shingles(words(part, offs))
            cut = np.searchsorted(row, np.arange(hi - lo + 1))
            n = np.diff(cut)
            some = np.flatnonzero(n)
            d1, d2 = np.zeros(hi - lo, np.uint64), np.zeros(hi - lo, np.uint64)
            sig = np.zeros((hi - lo, HASHES), np.uint32)
            if len(some):
                d1[some] = np.add.reduceat(mix(code), cut[some])
                d2[some] = np.add.reduceat(mix(code ^ np.uint64(0x5851F42D4C957F2D)), cut[some])
            for i in some:
                sig[i] = _minhash(code[cut[i]:cut[i + 1]])
            pair = sig.astype(np.uint64).reshape(hi - lo, BANDS, ROWS)
            key = np.zeros((hi - lo, BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
            for k in range(ROWS):
                key = mix((key ^ pair[:, :, k]) * np.uint64(0x9E3779B97F4A7C15))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(lo, hi - lo), b.column("text_id").slice(lo, hi - lo), pa.array(n.astype(np.int32)),
                 pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), binary_column(sig),
                 list_column(key.view(np.int64).ravel(), np.full(hi - lo, BANDS), pa.int64())],
                names=["doc_id", "text_id", "n", "d1", "d2", "sig", "bands"])


def _survivors(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows of a task (bucket, block pair) that the pruning leaves."""
    rep, side = t.column("rep").to_numpy(), t.column("side").to_numpy()
    sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint32).reshape(-1, HASHES)
    band = t.column("band")[0].as_py()
    within = t.column("bi")[0].as_py() == t.column("bj")[0].as_py()
    one = np.flatnonzero(side == 0)
    two = one if within else np.flatnonzero(side == 1)
    left, right = [], []
    for i in range(0, len(one), 256):
        part = one[i:i + 256]
        same = rep[part][:, None] < rep[two][None, :] if within else rep[part][:, None] != rep[two][None, :]
        a, c = np.nonzero(same)
        a, c = part[a], two[c]
        for k in range(band):  # a pair belongs to the first band that it shares
            cols = slice(k * ROWS, (k + 1) * ROWS)
            keep = (sig[a, cols] != sig[c, cols]).any(axis=1)
            a, c = a[keep], c[keep]
        seen = np.zeros(len(a), np.int32)
        for lo in range(0, HASHES, STEP):
            seen += (sig[a, lo:lo + STEP] == sig[c, lo:lo + STEP]).sum(axis=1, dtype=np.int32)
            keep = seen >= LEAST[lo + STEP]
            a, c, seen = a[keep], c[keep], seen[keep]
        left.append(a)
        right.append(c)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))


def _prune(batches):
    """The members of each task that have a surviving partner."""
    for t in groups(batches, ["key", "bi", "bj"]):
        a, c = _survivors(t)
        if len(a):
            used = t.select(["key", "bi", "bj", "band", "side", "rep", "text_id"]).take(pa.array(np.unique(np.concatenate([a, c]))))
            yield from used.combine_chunks().to_batches()


def _sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """rep, text_id and the sorted shingle hashes of the wanted (rep, text_id),
    whole texts; a bitmap leaves out most other texts where they are
    read, so that only few are shuffled, and the join the rest."""
    bits, n_bits = bitmap.build(wanted.select(F.xxhash64("rep", "text_id").alias("h")), "h")
    shared = documents.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for whole in batches:
            b = whole.take(pa.array(bitmap.passes(shared.value, n_bits, whole.column("h").to_numpy().view(np.uint64))))
            data, offsets = text_bytes(b.column("text"))
            for lo, hi, part, offs in blocks(data, offsets):
                code, row = shingles(words(part, offs))
                cut = np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32) * 8
                yield pa.RecordBatch.from_arrays(
                    [b.column("rep").slice(lo, hi - lo), b.column("text_id").slice(lo, hi - lo),
                     pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(cut.tobytes()), pa.py_buffer(code.tobytes())])],
                    names=["rep", "text_id", "set"])
    rows = documents.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("rep"), F.xxhash64("doc_id", "text_id").alias("h"), "text_id", "text")
    return rows.mapInArrow(run, "rep long, text_id long, set binary").join(wanted, ["rep", "text_id"]).dropDuplicates(["rep", "text_id"])


def _overlaps(sets: list[np.ndarray], a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs (a, c) of sets."""
    if len(a) <= 2 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a, c)], np.int64)
    # many pairs of few sets: the product of the 0/1 matrix of shared shingles with itself
    n = len(sets)
    of = np.repeat(np.arange(n), [len(s) for s in sets])
    _, where, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count[where] > 1
    of, where = of[keep], (np.cumsum(count > 1) - 1)[where[keep]]
    order = np.argsort(where, kind="stable")
    of, where = of[order], where[order]
    total = np.zeros((n, n), np.float32)
    width = 2048
    for lo in range(0, int(where[-1]) + 1 if len(where) else 0, width):
        s, e = np.searchsorted(where, [lo, lo + width])
        m = np.zeros((n, width), np.float32)
        m[of[s:e], where[s:e] - lo] = 1
        total += m @ m.T
    return total[a, c].astype(np.int64)


def _local_roots(n: int, a: np.ndarray, c: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Smallest label in the component of each of n nodes under links (a, c)."""
    low = label.copy()
    while True:
        was = low.copy()
        m = np.minimum(low[a], low[c])
        np.minimum.at(low, a, m)
        np.minimum.at(low, c, m)
        if (low == was).all():
            return low


def _verify(batches):
    """Exact links of a task: per document the documents linked, and a root."""
    for t in groups(batches, ["key", "bi", "bj"]):
        a, c = _survivors(t)
        if not len(a):
            continue
        rep, copies = t.column("rep").to_numpy(), t.column("copies").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in t.column("set").to_pylist()]
        size = np.array([len(s) for s in sets])
        both = _overlaps(sets, a, c)
        link = both >= THRESHOLD * (size[a] + size[c] - both) - 1e-9
        a, c = a[link], c[link]
        if not len(a):
            continue
        n_links = np.bincount(a, copies[c], len(rep)) + np.bincount(c, copies[a], len(rep))
        root = _local_roots(len(rep), a, c, rep)
        some = np.unique(np.concatenate([a, c]))
        yield pa.RecordBatch.from_arrays([pa.array(rep[some]), pa.array(n_links[some].astype(np.int64)), pa.array(root[some])], names=["rep", "n_links", "root"])


def join(documents: DataFrame) -> DataFrame:
    """doc_id, text_id, class_id, n_links: class_id is the smallest doc_id that
    links reach, n_links the number of other documents at 0.8 or more."""
    spark = documents.sparkSession
    prepare(spark)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_id"))
    sketch = stored(docs.mapInArrow(_sketch, "doc_id long, text_id long, n int, d1 long, d2 long, sig binary, bands array<long>"), "sketch")
    usable = sketch.where("doc_id IS NOT NULL AND n > 0")
    classes = usable.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    classes = stored(classes, "classes")
    # one row for each class; a representative with several versions of its text has several
    reps = stored(usable.select("doc_id", "text_id", "d1", "d2", "sig", "bands").join(classes, ["d1", "d2"]).where("doc_id = rep")
                  .dropDuplicates(["d1", "d2"]).select("rep", "text_id", "sig", "bands"), "reps")
    sigs = reps.select("rep", "text_id", "sig")

    places = reps.select("rep", "text_id", F.posexplode("bands").alias("band", "key"))
    buckets = (places.groupBy("key").agg(F.first("band").alias("band"), F.count("*").alias("n"), F.min("rep").alias("low"),
                                         F.max("rep").alias("high"), F.bit_xor(F.xxhash64("rep", "text_id")).alias("sum"))
               .where("n > 1").groupBy("n", "low", "high", "sum").agg(F.min(F.struct("band", "key")).alias("b"))
               .select("b.band", "b.key", "n"))
    key = ["key", "bi", "bj"]
    members = (places.drop("band").join(buckets, "key").join(sigs, ["rep", "text_id"])
               .withColumn("nb", F.ceil(F.col("n") / BLOCK).cast("int"))
               .withColumn("own", F.pmod(F.xxhash64("rep"), "nb").cast("int"))
               .withColumn("other", F.explode(F.expr("sequence(0, nb - 1)")))
               .select("key", "band", "rep", "text_id", "sig", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"),
                       (F.col("own") > F.col("other")).cast("int").alias("side")))
    dealt = members.repartition(*key).sortWithinPartitions(*key)
    left = stored(dealt.mapInArrow(_prune, "key long, bi int, bj int, band int, side int, rep long, text_id long"), "pruned")

    sets = _sets(docs, stored(left.select("rep", "text_id").distinct(), "wanted"))
    sizes = classes.groupBy("rep").agg(F.sum("copies").alias("copies"))
    checked = left.join(sets.join(sizes, "rep").join(sigs, ["rep", "text_id"]), ["rep", "text_id"]).repartition(*key).sortWithinPartitions(*key)
    links = stored(checked.mapInArrow(_verify, "rep long, n_links long, root long"), "links")

    component = connected(links.select(F.col("rep").alias("a"), F.col("root").alias("b")).distinct())
    per = (classes.join(links.groupBy("rep").agg(F.sum("n_links").alias("far")), "rep", "left")
           .join(component, F.col("rep") == F.col("node"), "left")
           .select("d1", "d2", F.coalesce("component", "rep").alias("class_id"), (F.coalesce("far", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    return (sketch.select("doc_id", "text_id", F.when(F.expr("n > 0 AND doc_id IS NOT NULL"), F.col("d1")).alias("d1"), "d2")
            .join(per, ["d1", "d2"], "left")
            .select("doc_id", "text_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def query(spark, sf_dir: str) -> DataFrame:
    out = join(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "class_id", "n_links", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (its smallest doc_id); of
    repeated rows of that doc_id, one.  Rows without a doc_id stay."""
    found = stored(join(docs).where("doc_id IS NOT NULL").select("doc_id", "class_id"), "found")
    out = stored(found.where("doc_id <> class_id").select(F.col("doc_id").alias("_d")).distinct(), "copies")
    again = stored(found.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("_d")), "again")
    kept = docs.join(out, docs["doc_id"] == out["_d"], "left_anti")
    if again.isEmpty():
        return kept
    twice = kept["doc_id"] == again["_d"]
    return kept.join(again, twice, "left_anti").unionByName(kept.join(again, twice, "left_semi").dropDuplicates(["doc_id"]))


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, hash(array_to_string(w[p:p + 4], ' ')) AS g FROM d, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS t(p) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.r),
low AS (SELECT doc_id, min(r) AS class_id FROM reach GROUP BY doc_id),
num AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT documents.doc_id, class_id, coalesce(n_links, 0)::BIGINT AS n_links, documents.doc_id = class_id AS kept
FROM documents JOIN low USING (doc_id) LEFT JOIN num ON num.a = documents.doc_id
"""
