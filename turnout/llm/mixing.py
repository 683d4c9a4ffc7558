"""Mixing sources to target weights by Sainte-Lague apportionment.

Size of a document: its words (runs of ``[^\\x20\\x09-\\x0D]``).  Sources in
code-point order, null last, weigh 5, 2, 1, 5, 2, 1, ... and share the total size;
a target stops at MOST times its source's size and the excess goes to the others by
weight until none is above.

Texts are dealt in blocks of BLOCK words.  The blocks of the mix are given to
sources one by one, each to the highest quotient target / (2 * blocks so far + 1)
(equal ones: the source that comes first); those of a source to its shards in
the same way by the shards' sizes.  So every shard has an integer quota.  Only
totals per source and per shard are apportioned.

A shard is about SHARD documents of one source, picked by a seeded digest of
doc_id; in it documents stand in the order of that digest, as one stream of
words that is cut into blocks.  Of its n blocks the quota q is selected evenly
from a seeded start: block i is taken floor(((i + 1) q + o) / n) - floor((i q + o) / n)
times, so a block is taken floor(q / n) or one more times, MOST at most.  A
document's taken words follow from its place in the stream.

Null and empty texts have size 0 and take nothing.  Null sources are one source, null
doc_ids are drawn as an empty id.  Repeated rows are documents of their own; rows with
equal doc_ids stand together in the stream, by size.  An empty table
gives no rows; very long texts only count (their words are counted by Spark).  Extra columns stay in
the stage and are ignored otherwise.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, stored, table

WEIGHTS, MOST, BLOCK, SHARD, SEED = (5, 2, 1), 3, 32, 4096, "mix-1"


def highest_quotients(votes: np.ndarray, seats: int, most: np.ndarray) -> np.ndarray:
    """Seats of each vote by highest quotients votes / (2 j + 1), ``most`` at most;
    equal quotients: the first one."""
    votes, most = np.asarray(votes, float), np.asarray(most, np.int64)
    seats = int(min(seats, most[votes > 0].sum()))
    got = np.zeros(len(votes), np.int64)
    if seats <= 0:
        return got

    def at(x: float) -> np.ndarray:
        """Seats whose quotient is above x."""
        return np.minimum(np.ceil((votes / x - 1) / 2).clip(0), most).astype(np.int64)
    low, high = votes[votes > 0].min() / (2.0 * most.max() + 2), votes.max() * 2
    for _ in range(200):
        x = (low * high) ** 0.5
        if not low < x < high:
            break
        if at(x).sum() <= seats:
            high = x
        else:
            low = x
    got = at(high)
    while got.sum() < seats:  # equal quotients, and what rounding left
        quotient = np.where(got < most, votes / (2 * got + 1), -1.0)
        got[int(quotient.argmax())] += 1
    return got


def targets(totals: DataFrame) -> DataFrame:
    """totals: source, source_size (one row a source); adds place, weight and target."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    t = totals.withColumn("place", F.row_number().over(by_name))
    t = t.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(F.col("place") - 1, F.lit(len(WEIGHTS))) + 1))
    t = t.withColumn("ratio", MOST * F.col("source_size") / F.col("weight"))
    rising = Window.orderBy("ratio", "place")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    after = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    t = (t.withColumn("rest", F.sum("source_size").over(every) - F.coalesce(F.sum(MOST * F.col("source_size")).over(before), F.lit(0)))
         .withColumn("share", F.sum("weight").over(after)))
    # words a unit of weight gets where exactly the sources with smaller ratios are full
    t = t.withColumn("level", F.max(F.struct((F.col("rest") / F.col("share")).alias("v"), "rest", "share")).over(every))
    return t.withColumn("target", F.when(F.col("ratio") < F.col("level.v"), (MOST * F.col("source_size")).cast("double"))
                        .otherwise(F.col("level.rest") * F.col("weight") / F.col("level.share"))).drop("ratio", "rest", "share", "level")


def _quotas(frame: DataFrame, group: list[str], votes: str, seats: str, most: str, order: str, keep: str) -> DataFrame:
    """Adds quota to the rows of each group (totals only)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        return pdf.assign(quota=highest_quotients(pdf[votes].to_numpy(), int(pdf[seats].iloc[0]), pdf[most].to_numpy()))[[*keep.split(", "), "quota"]]
    kinds = dict(frame.dtypes)
    return frame.groupBy(*group).applyInPandas(run, ", ".join(f"`{c}` {kinds[c]}" for c in keep.split(", ")) + ", quota long")


def mix(documents: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every document (they go through the shuffle), with
    size, source_size, target and taken."""
    prepare(documents.sparkSession)
    digest = F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    facts = [F.col("source").alias("_source"), F.col("doc_id").alias("_doc"), digest.alias("_digest"),
             F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("_size")]
    narrow = stored(documents.select(*facts), "sizes")
    whole = documents.select(F.struct(*[c for c in documents.columns if c in keep]).alias("_row"), *facts)
    totals = stored(targets(narrow.groupBy(F.col("_source").alias("source")).agg(F.sum("_size").alias("source_size"), F.count("*").alias("n_docs"))), "totals")
    shards = totals.select(F.col("place").cast("int").alias("place"), F.col("source").alias("_s"), "source_size", "target", F.ceil(F.col("n_docs") / SHARD).cast("long").alias("_n_shards"))

    def place(rows: DataFrame) -> DataFrame:
        return (rows.join(shards, F.col("_source").eqNullSafe(F.col("_s")))
                .withColumn("_shard", F.pmod(F.conv(F.substring("_digest", 1, 8), 16, 10).cast("long"), "_n_shards")))
    parts = place(narrow).groupBy("place", "_shard").agg(F.sum("_size").alias("shard_size")).withColumn("blocks", F.ceil(F.col("shard_size") / BLOCK).cast("long"))
    parts = stored(parts, "shards").withColumn("most", MOST * F.col("blocks"))
    sources = (totals.select(F.col("place").cast("int").alias("place"), "target").join(parts.groupBy("place").agg(F.sum("most").alias("most")), "place")
               .withColumn("all", F.lit(1)).withColumn("seats", F.round(F.sum("target").over(Window.partitionBy()) / BLOCK).cast("long")))
    per_source = _quotas(sources, ["all"], "target", "seats", "most", "place", "place").withColumnRenamed("quota", "seats")
    quotas = stored(_quotas(parts.join(per_source, "place"), ["place"], "shard_size", "seats", "most", "_shard", "place, _shard, blocks"), "quotas")
    stream = Window.partitionBy("place", "_shard").orderBy("_digest", "_doc", "_size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(SEED), F.col("place").cast("string"), F.col("_shard").cast("string")).cast("binary")), 1, 8), 16, 10).cast("long")

    def chosen(block: str) -> str:
        """Blocks taken before this one, repeats counted."""
        return f"((({block}) * quota + _start) div _n)"

    def words(x: str) -> str:
        """Words taken before word x of the stream."""
        block = f"{x} div {BLOCK}"
        return f"({BLOCK} * {chosen(block)} + ({chosen(block + ' + 1')} - {chosen(block)}) * ({x} - {BLOCK} * ({block})))"
    out = (place(whole).join(quotas, ["place", "_shard"]).withColumn("_to", F.sum("_size").over(stream)).withColumn("_from", F.col("_to") - F.col("_size"))
           .withColumn("_n", F.greatest("blocks", F.lit(1))).withColumn("_start", F.pmod(start, "_n"))
           .withColumn("taken", F.expr(f"{words('_to')} - {words('_from')}")))
    return out.select("_row.*", F.col("_size").alias("size"), "source_size", "target", "taken")


def query(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), ["doc_id", "source"]).select("doc_id", "size", "source_size", "target", "taken", "source")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes words of, with how many."""
    plain = docs.drop("size", "source_size", "target", "taken")  # these names are the mix's
    return mix(plain, plain.columns).where("taken > 0")


SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')), 0)::BIGINT AS size,
    md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
t0 AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source),
t1 AS (SELECT *, [5, 2, 1][(place - 1) % 3 + 1] AS weight FROM t0),
t2 AS (SELECT *, 3 * source_size / weight AS ratio FROM t1),
t3 AS (SELECT *, ((SELECT sum(source_size) FROM t0) - coalesce(sum(3 * source_size) OVER (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS rest,
    (sum(weight) OVER (ORDER BY ratio, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS share FROM t2),
lvl AS (SELECT rest, share, rest / share AS v FROM t3 ORDER BY v DESC, rest DESC, share DESC LIMIT 1),
t AS (SELECT t3.*, CASE WHEN ratio < v THEN (3 * source_size)::DOUBLE ELSE lvl.rest * weight / lvl.share END AS target FROM t3, lvl),
p AS (SELECT d.*, place, source_size, target, ('0x' || substr(digest, 1, 8))::BIGINT % ceil(n_docs / 4096)::BIGINT AS shard
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
s AS (SELECT place, shard, sum(size)::BIGINT AS shard_size, ceil(sum(size) / 32)::BIGINT AS blocks FROM p GROUP BY ALL),
cap AS (SELECT place, 3 * sum(blocks)::BIGINT AS most FROM s GROUP BY place),
q1 AS (SELECT place, j FROM (SELECT place, j, row_number() OVER (ORDER BY target / (2 * j + 1) DESC, place) AS k
        FROM t JOIN cap USING (place), unnest(range(0, most)) AS u(j) WHERE target > 0)
    WHERE k <= (SELECT round(sum(target) / 32) FROM t)),
n1 AS (SELECT place, count(*) AS seats FROM q1 GROUP BY place),
q2 AS (SELECT place, shard FROM (SELECT place, shard, seats, row_number() OVER (PARTITION BY place ORDER BY shard_size / (2 * j + 1) DESC, shard) AS k
        FROM s JOIN n1 USING (place), unnest(range(0, 3 * blocks)) AS u(j) WHERE shard_size > 0) WHERE k <= seats),
n2 AS (SELECT place, shard, count(*) AS quota FROM q2 GROUP BY ALL),
f AS (SELECT p.*, coalesce(quota, 0) AS q, greatest(blocks, 1) AS n,
    ('0x' || substr(md5('mix-1:' || place || ':' || shard), 1, 8))::BIGINT % greatest(blocks, 1) AS o,
    (sum(size) OVER (PARTITION BY place, shard ORDER BY digest, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS b
    FROM p JOIN s USING (place, shard) LEFT JOIN n2 USING (place, shard)),
g AS (SELECT *, b - size AS a, (b - size) // 32 AS i, b // 32 AS k FROM f)
SELECT doc_id, size, source_size, target,
    ((32 * ((k * q + o) // n) + (((k + 1) * q + o) // n - (k * q + o) // n) * (b - 32 * k))
     - (32 * ((i * q + o) // n) + (((i + 1) * q + o) // n - (i * q + o) // n) * (a - 32 * i)))::BIGINT AS taken, source
FROM g
"""
