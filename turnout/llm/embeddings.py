"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors of cosine >= 0.9 lie within eps = sqrt(2 - 2 * 0.9) of each other, and so
do their projections on any axes.  Vectors are rotated to principal axes (from a
bounded sample; the axes only decide how much is skipped, never a result) and
sorted by their grid cells of width eps on the LEADING axes, first axis first.  The
sorted sequence is cut into blocks, and these into intervals of at most about HELD_BYTES.  Two
intervals can hold a pair only if their cells on the first axis are equal or neighbours (an equal-key
join of the intervals' descriptions) and their bounding boxes over all axes come within eps.  Each such
pair of intervals is a task's work: it holds the blocks of one, takes those of the other one at a time,
and joins two blocks recursively, halving the longer one, skipping halves whose boxes are
further apart than eps, down to LEAF vectors that are compared by cosine in double precision.  A block
is sent once for each interval near its own, not for each block, and a task's memory is one interval.

Equal vectors are one: the smallest vec_id stands for its copies.  No pair
becomes a row; a task returns for each vector the number of vectors linked to it and the smallest
one that its links reach inside the task; components join these.

Vectors that are null, empty, zero or hold null or non-finite components link
with nothing, nor do vectors of different lengths with each other.  A null vec_id takes no part (its
row: no links, null component, kept).  Repeated rows are vectors of their own that
link with each other.  An empty table gives no rows.  Extra columns, labels among them, are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_column, mix, prepare, stored, table
from .components import connected
from .jaccard import _local_roots

COSINE, LEADING, BLOCK, LEAF, SAMPLE = 0.9, 8, 4096, 256, 5000
#: Bytes that a task holds of an interval, at most about (64 blocks of 64 components); smaller
#: tables get intervals enough for SHARES tasks a core.
HELD_BYTES, SHARES = 256 << 20, 3
EPS2 = 2 - 2 * COSINE + 1e-9


def _plain(column: str):
    """Valid rows of an embeddings column as raw double vectors."""
    def run(batches):
        for b in batches:
            col = b.column(column)
            flat = col.flatten()
            size = np.diff(col.offsets.to_numpy()) if len(col) else np.zeros(0, np.int64)
            size = np.where(col.is_valid().to_numpy(zero_copy_only=False), size, 0)
            value = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null components become NaN
            first = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64) if len(size) else size
            for n in np.unique(size[size > 0]):
                rows = np.flatnonzero(size == n)
                v = value[first[rows][:, None] + np.arange(n)]
                with np.errstate(all="ignore"):
                    good = np.isfinite(v).all(axis=1) & (np.abs(v).max(axis=1) > 0)
                rows, v = rows[good], v[good]
                if len(rows):
                    yield pa.RecordBatch.from_arrays([b.column("vec_id").take(pa.array(rows)), pa.array(np.full(len(rows), n, np.int32)), binary_column(v)],
                                                     names=["vec_id", "size", "raw"])
    return run


def _unit(t, n: int) -> np.ndarray:
    v = np.frombuffer(b"".join(t.column("raw").to_pylist()), np.float64).reshape(-1, n)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def axes(reps: DataFrame, n: int) -> np.ndarray:
    """Principal axes of a sample of at most about SAMPLE vectors."""
    total = reps.count()
    draw = F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) < int(min(1.0, SAMPLE / max(total, 1)) * (1 << 30))
    raw = [r.raw for r in reps.where(draw).select("raw").collect()]
    if len(raw) < 2:
        return np.eye(n)
    u = np.frombuffer(b"".join(raw), np.float64).reshape(-1, n)
    u = u / np.abs(u).max(axis=1, keepdims=True)
    u = u / np.sqrt((u * u).sum(axis=1, keepdims=True))
    u = u - u.mean(axis=0)
    return np.linalg.eigh(u.T @ u)[1][:, ::-1]


def _cells(batches_axes, n: int):
    """Vectors with their place in the grid order: the cell, then (as a fraction) a hash, so that one cell can be cut."""
    def run(batches):
        turn = batches_axes.value
        for b in batches:
            u = _unit(b, n)
            cell = np.floor(u @ turn[:, :LEADING] / np.sqrt(EPS2)).astype(np.int64) + 8  # 0..15: |x| <= 1 and eps > 1/8
            key = np.zeros(len(u), np.int64)
            for k in range(cell.shape[1]):
                key = key * 16 + cell[:, k]
            spread = (mix(b.column("rep").to_numpy().view(np.uint64)) >> np.uint64(44)).astype(np.float64) / (1 << 20)
            yield pa.RecordBatch.from_arrays([pa.array(key + spread), b.column("rep"), b.column("copies"), b.column("raw")], names=["at", "rep", "copies", "raw"])
    return run


def _blocks(batches_axes, n: int):
    """Consecutive vectors of a sorted partition as blocks with bounding boxes."""
    def run(batches):
        turn = batches_axes.value
        rest: pa.Table | None = None

        def block(t: pa.Table) -> pa.RecordBatch:
            u = _unit(t, n)
            y = u @ turn
            rep, copies = t.column("rep").to_numpy(), t.column("copies").to_numpy()
            first = np.floor(y[:, 0] / np.sqrt(EPS2)).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [t.column("at").slice(0, 1).combine_chunks(), pa.array([int(first.min())]), pa.array([int(first.max())]), pa.array([y.min(axis=0).tolist()], pa.list_(pa.float64())),
                 pa.array([y.max(axis=0).tolist()], pa.list_(pa.float64())), pa.array([rep.tobytes()], pa.binary()), pa.array([copies.tobytes()], pa.binary()),
                 pa.array([u.tobytes()], pa.binary())], names=["at", "low", "high", "box_low", "box_high", "reps", "copies", "vectors"])
        for b in batches:
            t = pa.Table.from_batches([b])
            rest = t if rest is None else pa.concat_tables([rest, t])
            while rest.num_rows >= BLOCK:
                yield block(rest.slice(0, BLOCK))
                rest = rest.slice(BLOCK)
        if rest is not None and rest.num_rows:
            yield block(rest)
    return run


class _Sequence:
    """A block's vectors in grid order with the boxes of its halves."""

    def __init__(self, unit: np.ndarray, turned: np.ndarray):
        self.unit, self.turned, self.known = unit, turned, {}

    def box(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        if (lo, hi) not in self.known:
            part = self.turned[lo:hi]
            self.known[lo, hi] = part.min(axis=0), part.max(axis=0)
        return self.known[lo, hi]


def _join(a: _Sequence, al: int, ah: int, b: _Sequence, bl: int, bh: int, out: list) -> None:
    """Pairs of a[al:ah] and b[bl:bh] with cosine >= COSINE, by halving."""
    if a is b and bl < al:
        return  # the mirrored half
    lo_a, hi_a = a.box(al, ah)
    lo_b, hi_b = b.box(bl, bh)
    gap = np.maximum(np.maximum(lo_a - hi_b, lo_b - hi_a), 0.0)
    if gap @ gap > EPS2:
        return
    if ah - al <= LEAF and bh - bl <= LEAF:
        i, j = np.nonzero(a.unit[al:ah] @ b.unit[bl:bh].T >= COSINE)
        i, j = i + al, j + bl
        if a is b:
            keep = i < j
            i, j = i[keep], j[keep]
        if len(i):
            out.append((i, j))
        return
    if a is b and (al, ah) == (bl, bh):
        mid = (al + ah) // 2
        for x, y, z, w in ((al, mid, al, mid), (al, mid, mid, ah), (mid, ah, mid, ah)):
            _join(a, x, y, b, z, w, out)
    elif ah - al >= bh - bl:
        mid = (al + ah) // 2
        _join(a, al, mid, b, bl, bh, out)
        _join(a, mid, ah, b, bl, bh, out)
    else:
        mid = (bl + bh) // 2
        _join(a, al, ah, b, bl, mid, out)
        _join(a, al, ah, b, mid, bh, out)


def _compare(batches_axes, n: int):
    """The join of two intervals: rows of (one, two, side, block), sorted by them.  Blocks of
    side 0 are held, those of side 1 come after them; an interval with itself has side 0 only."""
    def run(batches):
        turn = batches_axes.value
        cell, held, ids, copies, base = None, [], np.zeros(0, np.int64), np.zeros(0, np.int64), [0]
        for b in batches:
            for r in range(b.num_rows):
                now = b.column("one")[r].as_py(), b.column("two")[r].as_py()
                if now != cell:
                    cell, held, ids, copies, base = now, [], np.zeros(0, np.int64), np.zeros(0, np.int64), [0]
                u = np.frombuffer(b.column("vectors")[r].as_py(), np.float64).reshape(-1, n)
                mine = _Sequence(u, u @ turn)
                my_ids, my_copies = (np.frombuffer(b.column(k)[r].as_py(), np.int64) for k in ("reps", "copies"))
                left, right = [], []

                def pairs(other: _Sequence, at_other: int, at_mine: int) -> None:
                    found: list = []
                    _join(other, 0, len(other.unit), mine, 0, len(u), found)
                    left.extend(i + at_other for i, _ in found)
                    right.extend(j + at_mine for _, j in found)
                seen = base[-1]  # a block's own numbers follow those of the held ones
                for k, other in enumerate(held):
                    pairs(other, base[k], seen)
                if now[0] == now[1]:
                    pairs(mine, seen, seen)
                all_ids, all_copies = np.concatenate([ids, my_ids]), np.concatenate([copies, my_copies])
                if b.column("side")[r].as_py() == 0:
                    held, ids, copies, base = [*held, mine], all_ids, all_copies, [*base, seen + len(u)]
                if not left:
                    continue
                some, where = np.unique(np.concatenate([*left, *right]), return_inverse=True)
                i, j = np.split(where, 2)
                rep, weight = all_ids[some], all_copies[some]
                links = np.bincount(i, weight[j], len(some)) + np.bincount(j, weight[i], len(some))
                yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(links.astype(np.int64)), pa.array(_local_roots(len(some), i, j, rep))], names=["rep", "n_links", "root"])
    return run


def _intervals(blocks: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Blocks with their interval of the grid order, and the number of intervals.  Only the
    intervals' borders reach the driver: one number for each HELD_BYTES of vectors."""
    total = blocks.count()
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    held = max(1, HELD_BYTES // (BLOCK * size * 16))  # blocks; a vector is held twice, plain and turned
    n = max(1, min(total, max(-(-total // held), int(np.ceil(np.sqrt(2 * SHARES * cores))))))
    borders = blocks.agg(F.percentile_approx("at", [k / n for k in range(1, n)], max(10000, 50 * n))).first()[0] if n > 1 else []
    borders = sorted(set(borders or []))
    place = F.size(F.filter(F.array(*map(F.lit, borders)), lambda x: x < F.col("at"))) if borders else F.lit(0)
    return blocks.withColumn("interval", place), len(borders) + 1


def _near(blocks: DataFrame) -> DataFrame:
    """(one, two), one <= two: the intervals that can hold a pair."""
    cells = blocks.groupBy("interval").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    edges = blocks.select("interval", F.posexplode(F.arrays_zip("box_low", "box_high")).alias("axis", "e"))
    boxes = (edges.groupBy("interval", "axis").agg(F.min("e.box_low").alias("lo"), F.max("e.box_high").alias("hi"))
             .groupBy("interval").agg(F.sort_array(F.collect_list(F.struct("axis", "lo", "hi"))).alias("box")))
    about = stored(cells.join(boxes, "interval"), "intervals")
    # intervals meet where one's cells on the first axis are those of the other or next to them
    a = about.select(F.col("interval").alias("one"), F.col("box").alias("p"), F.explode(F.expr("sequence(low - 1, high + 1)")).alias("c"))
    b = about.select(F.col("interval").alias("two"), F.col("box").alias("q"), F.explode(F.expr("sequence(low, high)")).alias("c"))
    gap = F.expr("aggregate(arrays_zip(p, q), 0D, (s, x) -> s + power(greatest(x.p.lo - x.q.hi, x.q.lo - x.p.hi, 0D), 2))")
    return stored(a.join(b, "c").where("one <= two").where(gap <= EPS2).select("one", "two").distinct(), "near")


def _links(reps: DataFrame, n: int) -> DataFrame:
    """(rep, n_links, root) parts of the join of vectors of n components."""
    spark = reps.sparkSession
    turn = spark.sparkContext.broadcast(axes(reps, n))
    cells = reps.mapInArrow(_cells(turn, n), "at double, rep long, copies long, raw binary")
    blocks = stored(cells.repartitionByRange("at", "rep").sortWithinPartitions("at", "rep")
                    .mapInArrow(_blocks(turn, n), "at double, low long, high long, box_low array<double>, box_high array<double>, reps binary, copies binary, vectors binary"), "blocks")
    placed, count = _intervals(blocks, n)
    near = _near(placed)
    sides = near.select("one", "two", F.col("one").alias("interval"), F.lit(0).alias("side")).union(
        near.where("one < two").select("one", "two", F.col("two").alias("interval"), F.lit(1).alias("side")))
    tasks = max(1, min(count * (count + 1) // 2, 32 * spark.sparkContext.defaultParallelism))
    return (placed.select("interval", "at", "reps", "copies", "vectors").join(sides, "interval").drop("interval")
            .repartition(tasks, "one", "two").sortWithinPartitions("one", "two", "side", "at")
            .mapInArrow(_compare(turn, n), "rep long, n_links long, root long"))


def join(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    prepare(vectors.sparkSession)
    kind = dict(vectors.dtypes)["vec_id"]
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), column).where("vec_id IS NOT NULL")
    usable = stored(plain.mapInArrow(_plain(column), "vec_id long, size int, raw binary"), "vectors")
    reps = stored(usable.groupBy("size", "raw").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "distinct")
    sizes = [r.size for r in reps.groupBy("size").agg(F.count("*").alias("n")).select("size").collect()]  # lengths of vectors, not vectors
    result = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    if not sizes:
        return result.select(F.col("vec_id").cast(kind).alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = None
    for n in sorted(sizes):
        part = _links(reps.where(F.col("size") == n), n)
        found = part if found is None else found.union(part)
    found = stored(found, "links")
    component = connected(found.select(F.col("rep").alias("a"), F.col("root").alias("b")).distinct())
    # by vector: links beyond its copies, and the component of its representative
    far = reps.join(found.groupBy("rep").agg(F.sum("n_links").alias("far")), "rep", "left").join(component, F.col("rep") == F.col("node"), "left")
    per = far.select("size", "raw", (F.coalesce("far", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "rep").alias("c"))
    by_id = usable.join(per, ["size", "raw"]).groupBy("vec_id").agg(F.max("n").alias("n_links"), F.min("c").alias("component_id")).withColumnRenamed("vec_id", "v")
    return (result.join(by_id, F.col("vec_id") == F.col("v"), "left")
            .select(F.col("vec_id").cast(kind).alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def query(spark, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT reach.vec_id, link.b FROM reach JOIN link ON link.a = reach.r),
low AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
num AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM low LEFT JOIN num ON a = vec_id
"""
