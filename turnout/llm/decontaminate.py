"""Benchmark decontamination by winnowing.

Fingerprints: of every window of w = n - k + 1 consecutive k-grams (k = 5 words, n = 10) the
one with the smallest hash is kept, the rightmost of equal ones; neighbouring windows mostly
keep the same one, so about 2 in w + 1 k-grams are kept.  Two texts that share any n words
keep the same k-gram inside them, so every shared span of n or more words has a common
fingerprint.  Fingerprints of documents and benchmark are joined by their hash alone; a
hit is then extended to the n-word windows around it, and those that are equal on both
sides (by the hash of all their words) are hits.  Pairs that share only the k-gram end there.

A benchmark text of 1 to n-1 words is one window of its own length (k is then
that length and w = 1).  Null, empty and word-free texts have no windows and
are never hit; an empty table gives no rows, an empty benchmark no hits.  Rows that repeat an
item_id or a doc_id: an item occurs if any of its rows does; every row of documents gets a
result of its own text (rows are told apart by doc_id and text, so identical rows get
identical results).  A null item_id occurs as any other but is not listed.  Very long texts
are whole: memory is some hundred bytes per byte of the longest one.  Extra columns are ignored.

Documents are fingerprinted where they are read; a bitmap of the benchmark's
fingerprints (bounded, bitmap.py) leaves out those that match nothing before the
shuffle.  One row per document, fingerprint and windows leaves a task, with the list of
its places, so a phrase repeated in a long text stays one row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bitmap
from .common import blocks, list_column, mix, prepare, stored, table, text_bytes, words

GRAM, SPAN = 5, 10


def fingerprints(w, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first word, hashes of the windows around) of the kept grams.  Windows stand in
    the order of their first words and end with the one that starts with the gram; 0: no such window."""
    whole, at = w.grams(length)
    if length != SPAN or not len(at):
        return whole, at, whole[:, None]
    gram, gram_at = w.grams(GRAM)
    of = np.zeros(len(w.code), np.uint64)
    of[gram_at] = gram
    low, place = of[at], at.copy()
    for k in range(1, SPAN - GRAM + 1):
        value = of[at + k]
        less = value <= low
        low[less], place[less] = value[less], at[less] + k
    place = np.unique(place)
    window = np.zeros(len(w.code) + 1, np.uint64)
    window[at] = whole
    start = place[:, None] + np.arange(GRAM - SPAN, 1)
    return of[place], place, np.where(start >= 0, window[start], np.uint64(0))


def _key(mark: np.ndarray, length: int) -> np.ndarray:
    """Hash of (fingerprint, length) for the bitmap."""
    return mix(mark ^ np.uint64(length))


def _windows_column(rows: np.ndarray) -> pa.Array:
    return list_column(np.ascontiguousarray(rows).ravel().view(np.int64), np.full(len(rows), rows.shape[1] if rows.ndim > 1 else 1), pa.int64())


def item_fingerprints(benchmark: DataFrame) -> DataFrame:
    """Distinct fingerprints of the benchmark: item_id, length, mark, around, key."""
    def run(batches):
        for b in batches:
            data, offsets = text_bytes(b.column("text"))
            for lo, hi, part, offs in blocks(data, offsets):
                w = words(part, offs)
                ids = b.column("item_id").slice(lo, hi - lo)
                n = w.counts
                row = np.repeat(np.arange(hi - lo), n)
                for length in range(1, SPAN + 1):
                    mark, at, around = fingerprints(w, length)
                    mine = n[row[at]] == length if length < SPAN else np.ones(len(at), bool)
                    mark, at, around = mark[mine], at[mine], around[mine]
                    if len(at):
                        yield pa.RecordBatch.from_arrays(
                            [ids.take(pa.array(row[at])), pa.array(np.full(len(at), length, np.int32)), pa.array(mark.view(np.int64)),
                             _windows_column(around), pa.array(_key(mark, length).view(np.int64))],
                            names=["item_id", "length", "mark", "around", "key"])
    kind = dict(benchmark.dtypes)["item_id"]
    return (benchmark.select("item_id", "text")
            .mapInArrow(run, f"item_id {kind}, length int, mark long, around array<long>, key long").distinct())


def _document_fingerprints(documents: DataFrame, lengths: list[int], bits: np.ndarray, n_bits: int) -> DataFrame:
    """A row of each document (length 0, with its word count) and one for each
    distinct fingerprint with its windows that the benchmark may have too."""
    shared = documents.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        known = shared.value
        for b in batches:
            data, offsets = text_bytes(b.column("text"))
            for lo, hi, part, offs in blocks(data, offsets):
                w = words(part, offs)
                n, total = w.counts, hi - lo
                row = np.repeat(np.arange(total), n)

                def batch(r, length, mark, around, places, where):
                    take = pa.array(r + lo)
                    return pa.RecordBatch.from_arrays(
                        [b.column("doc_id").take(take), b.column("text_id").take(take), pa.array(np.full(len(r), length, np.int32)), pa.array(mark.view(np.int64)),
                         around, pa.array(n[r]), list_column(where.astype(np.int32), places, pa.int32())],
                        names=["doc_id", "text_id", "length", "mark", "around", "n_words", "places"])
                none = np.zeros(total, np.int64)
                yield batch(np.arange(total), 0, none, list_column(none[:0], none, pa.int64()), none, none[:0])
                for length in lengths:
                    mark, at, around = fingerprints(w, length)
                    i = bitmap.passes(known, n_bits, _key(mark, length))
                    if not len(i):
                        continue
                    mark, at, around = mark[i], at[i], around[i]
                    r = row[at]
                    order = np.lexsort((at, *around.T, mark, r))
                    mark, at, around, r = mark[order], at[order], around[order], r[order]
                    new = np.ones(len(at), bool)
                    new[1:] = (r[1:] != r[:-1]) | (mark[1:] != mark[:-1]) | (around[1:] != around[:-1]).any(axis=1)
                    cut = np.flatnonzero(new)
                    yield batch(r[cut], length, mark[cut], _windows_column(around[cut]), np.diff(np.append(cut, len(at))), at - w.first[r])
    # text_id tells rows with one doc_id but different texts apart
    docs = documents.select("doc_id", "text", F.xxhash64("text").alias("text_id"))
    kind = dict(documents.dtypes)["doc_id"]
    return docs.mapInArrow(run, f"doc_id {kind}, text_id long, length int, mark long, around array<long>, n_words long, places array<int>")


def scan(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_id, n_words, n_hit, item_ids (sorted strings), one row per row of documents."""
    spark = documents.sparkSession
    prepare(spark)
    items = stored(item_fingerprints(benchmark), "items")
    bits, n_bits = bitmap.build(items.select("key").distinct(), "key")
    lengths = sorted(r.length for r in items.select("length").distinct().collect())  # 1 to SPAN
    rows = stored(_document_fingerprints(documents, lengths, bits, n_bits), "fingerprints")
    key, ids = ["length", "mark"], ["doc_id", "text_id"]
    theirs = items.select(*key, F.col("around").alias("theirs"), F.col("item_id").cast("string").alias("item"))
    # the hit extended: places in the list of windows around it that both have
    both = F.expr("filter(sequence(0, size(around) - 1), i -> around[i] = theirs[i] AND around[i] <> 0)")
    hits = (rows.where("length > 0").join(theirs, key).withColumn("both", both).where("size(both) > 0")
            .groupBy(*ids, *key, "around").agg(F.first("places").alias("places"), F.array_distinct(F.flatten(F.collect_set("both"))).alias("both"), F.collect_set("item").alias("items"))
            # the words hit, as one list of word numbers per document (bounded by its text)
            .withColumn("starts", F.expr("flatten(transform(places, p -> transform(both, i -> p + 1 + i - size(around))))"))
            .withColumn("hit", F.expr("flatten(transform(starts, s -> sequence(s, s + length - 1)))")))
    found = hits.groupBy(*ids).agg(F.size(F.array_distinct(F.flatten(F.collect_list("hit")))).cast("long").alias("n_hit"),
                                   F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("item_ids"))
    return (rows.where("length = 0").select(*ids, "n_words")
            .join(found.withColumnsRenamed({"doc_id": "d", "text_id": "t"}), F.col("doc_id").eqNullSafe(F.col("d")) & F.col("text_id").eqNullSafe(F.col("t")), "left")
            .select(*ids, "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")))


def query(spark, sf_dir: str) -> DataFrame:
    out = scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window, unchanged."""
    hit = stored(scan(docs, table(spark, sf_dir, "benchmark")).where("n_hit > 0").select(F.col("doc_id").alias("_d"), F.col("text_id").alias("_t")).distinct(), "hit")
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["_d"]) & F.xxhash64(docs["text"]).eqNullSafe(hit["_t"]), "left_anti")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT item_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS g
    FROM i, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(p) WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT rid, n, p, array_to_string(w[p:p + n - 1], ' ') AS g FROM d, lens, unnest(range(1, greatest(len(w) - n, -1) + 2)) AS t(p)),
hit AS (SELECT rid, dw.n, p, item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.g = iw.g),
words AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT rid, n, p FROM hit), unnest(range(p, p + n)) AS t(q) GROUP BY rid),
ids AS (SELECT rid, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s FROM (SELECT DISTINCT rid, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN ids USING (rid)
"""
