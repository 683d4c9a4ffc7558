"""Prefix trie of conversations, rolled up by bands of depth.

Turns stand in the order of (turn, role, text), nulls first; a null role or text is empty.  Every
conv_id c is rebuilt: the first h original turns of conversation c - c % 100 (all if it has fewer,
none if it is absent), then its own turns after its first h; h = crc32(decimal c) % 6.  A node is a
distinct sequence of the first d rebuilt turns of a conversation, the root the empty one.

Order.  Rows are sorted by range, so that even one conversation with a third of all
turns is sorted by several tasks; a turn's rank is its rank in its task's part plus the counts of the
parts before it.

Names.  A node is named by its depth and the 128-bit XOR of one digest for each (position, turn) on
its path, a running XOR inside a band of the conversation on top of that of the bands before
it.  Nodes are a pre-aggregated group of the rebuilt turns.

Roll-up.  Depths are cut into bands of equal height.  Each node sends its share (leaf, saved
characters; nothing if both are 0) only to its ancestors inside its band, so a
node gives at most ``height`` rows, summed before they are shuffled.  Then the tops of the
deepest band are complete, and band by band their totals are sent to the ancestors of
their parents inside the band above.  The height is HEIGHT, or the square root of the greatest depth
where that is more: rounds and rows a node both stay below that.

Ends.  The members that end at a node are joined in numeric order: pieces of at most PIECE ids
are joined where the rows lie (sorted by range, so a node with very many ends is cut among
tasks) and a node's pieces, in order, go through SHA-256 as a stream.

Rows with a null conv_id take no part.  Repeated rows are turns of their own.  Turns with equal
(turn, role, text) are the same.  An empty table gives no rows, not even a root.  Very long texts count whole;
only their digests and lengths are moved.  c % 100 has the sign of c.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, stored, table

STEM, SHARED, HEIGHT, PIECE = 100, 6, 16, 1 << 16
KEY = ["depth", "p1", "p2"]


def ranked(conversations: DataFrame) -> DataFrame:
    """conv_id, rank (from 1), digest and chars of every turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    sort = ["conv_id", "turn", "role", "text"]
    rows = (conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
            .repartitionByRange(*sort).sortWithinPartitions(*sort)
            .select("conv_id", "turn", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")).alias("digest"),
                    F.length("text").alias("chars"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")))
    rows = stored(rows, "turns")
    parts = rows.groupBy("conv_id", "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return rows.join(starts.select("conv_id", "part", (F.col("first") - F.col("before") - 1).alias("zero")), ["conv_id", "part"]).select(
        "conv_id", (F.col("place") - F.col("zero")).alias("rank"), "digest", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """conv_id, depth (0: the root), digest and chars of every rebuilt turn, and
    length, the number of turns of the rebuilt conversation; and all conversations with their lengths."""
    convs = (turns.groupBy("conv_id").agg(F.count("*").alias("n"))
             .withColumn("stem", F.col("conv_id") - F.col("conv_id") % STEM)
             .withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED))
    sizes = convs.where(F.col("conv_id") % STEM == 0).select(F.col("conv_id").alias("stem"), F.col("n").alias("stem_n"))
    convs = stored(convs.join(sizes, "stem", "left").withColumn("taken", F.least("h", F.coalesce("stem_n", F.lit(0))))
                   .withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).drop("stem_n"), "conversations")
    heads = turns.where((F.col("conv_id") % STEM == 0) & (F.col("rank") < SHARED)).withColumnRenamed("conv_id", "stem")
    a = heads.join(convs, "stem").where("rank <= taken").select("conv_id", F.col("rank").alias("depth"), "digest", "chars", "length")
    b = turns.join(convs, "conv_id").where("rank > h").select("conv_id", (F.col("taken") + F.col("rank") - F.col("h")).alias("depth"), "digest", "chars", "length")
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit("").alias("digest"), F.lit(0).alias("chars"), "length")
    return a.unionByName(b).unionByName(root), convs


def paths(rows: DataFrame, height: int) -> DataFrame:
    """Adds the node's name (p1, p2), its parent's (q1, q2) and the names of the nodes from the top of its band to itself."""
    def lane(salt: str):
        return F.when(F.col("depth") == 0, F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(salt), "depth", "digest"))
    rows = stored(rows.select("conv_id", "depth", "chars", "length", lane("a").alias("z1"), lane("b").alias("z2")).withColumn("band", F.expr(f"depth div {height}")), "rebuilt")
    before = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = rows.groupBy("conv_id", "band").agg(F.bit_xor("z1").alias("b1"), F.bit_xor("z2").alias("b2"))
    zero = F.lit(0).cast("long")
    bands = bands.select("conv_id", "band", *[F.coalesce(F.bit_xor(b).over(before), zero).alias(o) for b, o in (("b1", "o1"), ("b2", "o2"))])
    inside = Window.partitionBy("conv_id", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.join(bands, ["conv_id", "band"])
    for i in "12":
        rows = rows.withColumn(f"p{i}", F.bit_xor(f"z{i}").over(inside).bitwiseXOR(F.col(f"o{i}"))).withColumn(f"q{i}", F.col(f"p{i}").bitwiseXOR(F.col(f"z{i}")))
    return rows.withColumn("above", F.collect_list(F.struct("depth", "p1", "p2")).over(inside)).drop("z1", "z2", "o1", "o2")


def _joined(batches):
    """Pieces of the ascending ids of each node, from sorted rows."""
    key, ids, out, held = None, [], [], 0

    def batch():
        return pa.RecordBatch.from_arrays([*(pa.array([o[i] for o in out], pa.int64()) for i in range(4)), pa.array([o[4] for o in out])], names=[*KEY, "first", "ids"])
    for b in batches:
        for d, p1, p2, c in zip(*(b.column(x).to_pylist() for x in (*KEY, "conv_id"))):
            if (d, p1, p2) != key or len(ids) == PIECE:
                if ids:
                    out.append((*key, ids[0], ",".join(map(str, ids))))
                    held += len(ids)
                if held >= PIECE:
                    yield batch()
                    out, held = [], 0
                key, ids = (d, p1, p2), []
            ids.append(c)
    if ids:
        out.append((*key, ids[0], ",".join(map(str, ids))))
    if out:
        yield batch()


def _hashed(batches):
    """SHA-256 of each node's pieces, joined by commas, from sorted rows."""
    key, state, out = None, None, []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=[*KEY, "ends_sha256"])
    for b in batches:
        for d, p1, p2, ids in zip(*(b.column(x).to_pylist() for x in (*KEY, "ids"))):
            if (d, p1, p2) == key:
                state.update(b"," + ids.encode())
                continue
            if key is not None:
                out.append((*key, state.hexdigest()))
            key, state = (d, p1, p2), hashlib.sha256(ids.encode())
            if len(out) >= 1 << 14:
                yield batch()
                out = []
    if key is not None:
        out.append((*key, state.hexdigest()))
    if out:
        yield batch()


def ends(rows: DataFrame) -> DataFrame:
    """ends_sha256 of every node at which a conversation ends."""
    last = rows.where("depth = length").select(*KEY, "conv_id")
    pieces = stored(last.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id").mapInArrow(_joined, "depth long, p1 long, p2 long, first long, ids string"), "ends")
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_hashed, "depth long, p1 long, p2 long, ends_sha256 string")


def rollup(nodes: DataFrame, height: int, deepest: int) -> DataFrame:
    """(node, n_leaves, saved_tokens) of every node: nodes hold leaf, saved, q1, q2 and above."""
    def summed(shares: DataFrame) -> DataFrame:
        return (shares.withColumn("up", F.explode("above")).groupBy(*[F.col(f"up.{k}").alias(k) for k in KEY])
                .agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")))
    totals = stored(summed(nodes.where("leaf = 1 OR saved > 0").select("above", F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"))), "inside")
    parts = [totals]
    for band in range(deepest // height, 0, -1):
        # totals of this band's tops: their own band's, and what came from the band below
        top = [p.where(F.col("depth") == band * height) for p in ([totals, parts[-1]] if len(parts) > 1 else [totals])]
        done = top[0] if len(top) == 1 else top[0].unionByName(top[1])
        done = done.groupBy(*KEY).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
        tops = nodes.where(F.col("depth") == band * height).select(*KEY, "q1", "q2").join(done, KEY)
        by_parent = (tops.groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2"))
                     .agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")))
        parents = nodes.where(F.col("depth") == band * height - 1).select(*KEY, "above")
        parts.append(stored(summed(by_parent.join(parents, KEY).select("above", "n_leaves", "saved_tokens")), "across"))
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole.groupBy(*KEY).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")) if len(parts) > 1 else whole


def trie(conversations: DataFrame, height: int = HEIGHT) -> DataFrame:
    """One row per node: its name (depth, p1, p2) and the columns of the query."""
    prepare(conversations.sparkSession)
    rows, convs = rebuilt(ranked(conversations))
    deepest = convs.agg(F.max("length")).first()[0] or 0
    height = max(height, math.isqrt(deepest))
    rows = stored(paths(rows, height), "paths")
    nodes = rows.groupBy(*KEY).agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("chars").alias("chars"), F.first("q1").alias("q1"), F.first("q2").alias("q2"),
                                   F.first("above").alias("above"))
    nodes = stored(nodes, "nodes")
    parent = [(F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")]
    children = nodes.where("depth > 0").groupBy(*parent).agg(F.count("*").alias("n_children"))
    nodes = stored(nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
                   .withColumn("leaf", (F.col("n_children") == 0).cast("int")).withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")), "nodes")
    totals = rollup(nodes, height, deepest)
    above = nodes.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    zero = F.lit(0).cast("long")
    return (nodes.drop("above").join(totals, KEY, "left").join(ends(rows), KEY, "left").join(above, ["depth", "q1", "q2"], "left")
            .select(*KEY, "conv_id", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", zero).alias("n_leaves"), F.coalesce("saved_tokens", zero).alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))


def query(spark, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations")).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


#: Paths are whole texts here: each turn as md5 of role and text, a path as their list.
SQL = r"""
WITH c AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS r FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS stem,
        xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: [ord(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384::BIGINT * (a & 1)) END), 4294967295::BIGINT) % 6 AS h FROM c),
own AS (SELECT conv_id, list(md5(length(role) || ':' || role || text) ORDER BY r) AS turns, list(length(text) ORDER BY r) AS sizes FROM c GROUP BY conv_id),
re AS (SELECT ids.conv_id, list_concat(coalesce(s.turns[1:h], []), o.turns[h + 1:]) AS turns, list_concat(coalesce(s.sizes[1:h], []), o.sizes[h + 1:]) AS sizes
    FROM ids JOIN own o ON o.conv_id = ids.conv_id LEFT JOIN own s ON s.conv_id = stem),
steps AS (SELECT conv_id, d AS depth, array_to_string(turns[1:d], '/') AS path, array_to_string(turns[1:d - 1], '/') AS up, CASE WHEN d = 0 THEN 0 ELSE sizes[d] END AS chars, len(turns) = d AS ends
    FROM re, unnest(range(0, len(turns) + 1)) AS u(d)),
nodes AS MATERIALIZED (SELECT depth, path, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM steps GROUP BY depth, path),
kids AS (SELECT depth - 1 AS depth, up AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
facts AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (depth, path)),
below AS (SELECT d AS depth, array_to_string(string_split(path, '/')[1:d], '/') AS path, sum((n_children = 0)::INTEGER)::BIGINT AS n_leaves, sum((n_convs - 1) * chars)::BIGINT AS saved_tokens
    FROM facts, unnest(range(0, depth + 1)) AS u(d) GROUP BY ALL)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
FROM facts f JOIN below USING (depth, path) LEFT JOIN nodes p ON p.depth = f.depth - 1 AND p.path = f.up
"""
