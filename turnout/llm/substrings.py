"""Substring deduplication with content-defined chunks.

A gear rolling hash runs over the bytes of every text (each byte shifts the sum
left and adds its table value; WINDOW bytes count).  A chunk ends where the hash is
the largest within RADIUS bytes on either side (the rightmost of equal ones does
not win), so a boundary depends on those bytes alone: an insertion moves only the
boundaries around it, and inside a passage that two texts share, from RADIUS +
WINDOW bytes after its start to RADIUS before its end, both have the same
boundaries and so equal chunks.  Chunks are RADIUS bytes long at least (but for
the last) and 2 * RADIUS + 1 on average.

A stretch of one short period (shorter than RADIUS) has equal hashes and so no boundary.

Chunks are deduplicated by a 96-bit digest (among 3 * 10**12 chunks two differing ones
are equal with a chance below 10**-4): the first place (smallest doc_id, then start) keeps its
chunk, all others are repeats, inside the keeping document as well as in others (n_inside tells
them apart).  Neighbouring repeats of a document are one span.  A span that is a whole text is
reported at any length; of the others those of LEAST_BYTES or more, as shorter ones are chance
(fixed phrases, stop words).  A passage of 51 words of two letters holds whole chunks of that many
bytes in 99 of 100 cases, one of longer words practically always.

Null and empty texts have no chunks; an empty table gives no rows.  Rows with a null doc_id take no
part.  Places are told apart by (doc_id, text_id, start), text_id being 0 but for a doc_id with several
texts, which is several documents of one id; rows that repeat one doc_id and text are one document, whose
places count as often.  Very long texts are whole: memory is some hundred bytes per byte of the longest
one.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BYTE_CODE, blocks, mix, powers, prepare, stored, table, text_bytes

WINDOW, RADIUS, LEAST_BYTES = 8, 16, 48
_GEAR = mix(BYTE_CODE)


def gear(data: np.ndarray) -> np.ndarray:
    """Rolling hash of the last WINDOW bytes at each position (doubling steps)."""
    h = _GEAR[data]
    width = 1
    while width < WINDOW:
        h[width:] += h[:-width].copy() << np.uint64(width)
        width *= 2
    return mix(h)


def boundaries(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ends of all chunks of a block; every text's end is one."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    h = gear(data)
    lengths = np.diff(offsets)
    start = np.repeat(offsets[:-1], lengths)
    stop = np.repeat(offsets[1:], lengths)
    at = np.arange(n)
    h[at - start < WINDOW - 1] = 0  # the window would reach into another text

    def side(x: np.ndarray) -> np.ndarray:
        """Largest value of the RADIUS positions before each one."""
        best = np.zeros(n, np.uint64)
        run, width, done, left = x, 1, 0, RADIUS  # run[i]: largest of the width values up to i
        while left:
            if left & 1 and done + 1 < n:
                best[done + 1:] = np.maximum(best[done + 1:], run[:n - done - 1])
                done += width
            left >>= 1
            if left:
                run = run.copy()
                run[width:] = np.maximum(run[width:], run[:-width].copy())
                width *= 2
        return best
    cut = (h > side(h)) & (h >= side(h[::-1])[::-1]) & (h > 0)
    cut &= (at - start >= RADIUS + WINDOW - 1) & (stop - at > RADIUS)  # both sides lie in the text
    cut[:-1] &= (data[1:] & 0xC0) != 0x80  # no character is split
    ends = np.flatnonzero(cut) + 1
    return np.unique(np.concatenate([ends, offsets[1:][lengths > 0]]))


def _chunks(batches):
    """doc_id, text_id, start, length, digest of every chunk, and if it is its text's last."""
    for b in batches:
        data, offsets = text_bytes(b.column("text"))
        for lo, hi, part, offs in blocks(data, offsets):
            ends = boundaries(part, offs)
            if not len(ends):
                continue
            begin = np.concatenate([[0], ends[:-1]])
            row = np.searchsorted(offs, begin, "right") - 1
            p, q = powers(len(part))
            digest = []
            for salt in (0, 1):
                code = BYTE_CODE[part] if not salt else _GEAR[part]
                sums = np.zeros(len(part) + 1, np.uint64)
                np.cumsum(code * p[:len(part)], out=sums[1:])
                digest.append(mix((sums[ends] - sums[begin]) * q[begin] + (ends - begin).astype(np.uint64)).view(np.int64))
            take = pa.array(row + lo)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(take), b.column("text_id").take(take), pa.array((begin - offs[row]).astype(np.int32)),
                 pa.array((ends - begin).astype(np.int32)), pa.array(ends == offs[row + 1]), pa.array(digest[0]), pa.array((digest[1] >> 32).astype(np.int32))],
                names=["doc_id", "text_id", "start", "length", "last", "d1", "d2"])


def _named(documents: DataFrame) -> DataFrame:
    """All rows with text_id: 0, or the text's hash where a doc_id has several texts."""
    h = F.xxhash64("text")
    several = stored(documents.groupBy(F.col("doc_id").alias("_id")).agg(F.min(h).alias("lo"), F.max(h).alias("hi")).where("lo <> hi").select("_id"), "several")
    return documents.join(several, documents["doc_id"] == several["_id"], "left").withColumn("text_id", F.when(F.col("_id").isNotNull(), h).otherwise(0)).drop("_id")


def repeats(documents: DataFrame, least_bytes: int = LEAST_BYTES, within: bool = True) -> DataFrame:
    """One row per repeated span: doc_id, text_id, start and end (bytes of the
    UTF-8 text), n_chunks, first_doc_id (the document that keeps the span's first
    chunk), n_places (the fewest places that one of its chunks has) and n_inside
    (how many of its chunks the document itself keeps, at an earlier place).
    ``within`` False leaves out chunks kept under the same doc_id."""
    prepare(documents.sparkSession)
    docs = _named(documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select("doc_id", "text_id", "text")
    chunks = stored(docs.mapInArrow(_chunks, "doc_id long, text_id long, start int, length int, last boolean, d1 long, d2 int"), "chunks")
    place = F.struct("doc_id", "start", "text_id")
    several = (chunks.groupBy("d1", "d2").agg(F.count("*").alias("n_places"), F.min(place).alias("kept")).where("n_places > 1"))
    # dealt once by document, for all steps that follow
    found = (chunks.join(several, ["d1", "d2"])
             .where((place != F.col("kept")) if within else (F.col("doc_id") != F.col("kept.doc_id")))
             .repartition("doc_id", "text_id")
             .groupBy("doc_id", "text_id", "start").agg(F.first("length").alias("length"), F.first("last").alias("last"), F.first("n_places").alias("n_places"), F.first("kept.doc_id").alias("first_doc_id"),
                  F.first((F.struct("doc_id", "text_id") == F.struct("kept.doc_id", "kept.text_id")).cast("int")).alias("inside")))
    order = Window.partitionBy("doc_id", "text_id").orderBy("start")
    new = F.coalesce((F.lag(F.col("start") + F.col("length")).over(order) != F.col("start")).cast("int"), F.lit(1))
    spans = (found.withColumn("new", new).withColumn("span", F.sum("new").over(order))
             .groupBy("doc_id", "text_id", "span")
             .agg(F.max("last").alias("last"), F.min("start").alias("start"), F.max(F.col("start") + F.col("length")).alias("end"), F.count("*").alias("n_chunks"),
                  F.min_by("first_doc_id", "start").alias("first_doc_id"), F.min("n_places").alias("n_places"), F.sum("inside").alias("n_inside")))
    whole = (F.col("start") == 0) & F.col("last")
    return spans.where(whole | (F.col("end") - F.col("start") >= least_bytes)).drop("span", "last")


def deduplicate(documents: DataFrame) -> DataFrame:
    """The documents with their repeated spans cut out (all columns kept; rows
    without repeats unchanged)."""
    spans = (repeats(documents).groupBy("doc_id", "text_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_spans"))
             .withColumnsRenamed({"doc_id": "_d", "text_id": "_t"}))
    named = _named(documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"))
    text, found = named["text"], spans["_spans"]
    joined = named.join(spans, (named["doc_id"] == spans["_d"]) & (named["text_id"] == spans["_t"]), "left")
    # the bytes before each span, and those after the last
    ends = F.concat(F.array(F.lit(0)), found["end"])
    starts = F.concat(found["start"], F.array(F.octet_length(text)))
    kept = F.concat_ws("", F.transform(F.arrays_zip(ends.alias("a"), starts.alias("b")), lambda x: F.substring(text.cast("binary"), x["a"] + 1, x["b"] - x["a"]).cast("string")))
    cut = F.when(found.isNull(), text).otherwise(kept).alias("text")
    return joined.select(*[cut if c == "text" else F.col("row").getField(c).alias(c) for c in documents.columns])


def query(spark, sf_dir: str) -> DataFrame:
    return (repeats(table(spark, sf_dir, "documents"))
            .select("doc_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "n_chunks", "first_doc_id", "n_places", "n_inside"))
