"""Centroid clustering of integer vectors with PCA-rotated filtering.

Vectors of SIZE components become integers floor(SCALE * x).  Centroids start as the
vectors with the smallest digests of their ids; each round gives every vector to its
nearest centroid (ties: the smaller number) and moves every non-empty centroid to the exact
componentwise floor(sum / count).

Filter: vectors are rotated once to the principal axes of all vectors (their sums and
products are added up in Spark) and stored with their LEADING rotated coordinates and the norm of the
rest.  For a centroid rotated in the same way,

    |x - c|^2  >=  |lead(x) - lead(c)|^2 + (rest(x) - rest(c))^2,

as a rotation keeps lengths and the rest's difference is at least that of its norms.  The
centroid with the smallest bound is compared first, in integers; then only those
whose bound, less a margin for floating point, does not exceed the best distance so far.  Every
distance that decides is exact, so the axes change no result.

A round is one scan of the stored vectors; a task returns the sums of its rows by cluster and
component, and the driver sees K * SIZE sums.

Null vectors, vectors of another length, and those with null or non-finite components are left out.  Integers
beyond 2**27 (components beyond 131,072 in size) are held at that value, so
that every squared distance fits a long; sums of distances end at the largest long.  Fewer vectors than
K give fewer centroids, an empty table no rows.  A null vec_id is clustered
but is the last choice for a start; equal ids start by their components.  Repeated rows
are vectors of their own.  Extra columns, labels among them, are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_column, prepare, stored, table

SIZE, SCALE, K, ROUNDS, SEED, LEADING = 64, 1024, 8, 10, 3, 16
LARGEST = 1 << 27
_SIGN = 1 << 31


def _pack(x: np.ndarray) -> pa.Array:
    """Integers as bytes that sort as they do."""
    return binary_column(((x + _SIGN).astype(">u4")))


def _unpack(col: pa.Array, size: int) -> np.ndarray:
    if len(col) == 0:
        return np.zeros((0, size), np.int64)
    start = np.frombuffer(col.buffers()[1], np.int32)[col.offset]
    flat = np.frombuffer(col.buffers()[2], ">u4", len(col) * size, start)
    return flat.reshape(-1, size).astype(np.int64) - _SIGN


def _integers(column: str, size: int, scale: int):
    """Kept rows as packed integers."""
    def run(batches):
        for b in batches:
            col = b.column(column)
            if not len(col):
                continue
            offsets = col.offsets.to_numpy().astype(np.int64)
            right = (np.diff(offsets) == size) & col.is_valid().to_numpy(zero_copy_only=False)
            rows = np.flatnonzero(right)
            flat = col.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null components become NaN
            x = flat[offsets[rows][:, None] + np.arange(size)]
            good = np.isfinite(x).all(axis=1)
            with np.errstate(over="ignore"):
                x = np.clip(np.floor(scale * x[good]), -LARGEST, LARGEST).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("vec_id").take(pa.array(rows[good])), _pack(x)], names=["vec_id", "raw"])
    return run


def _products(size: int):
    """Sums of the components and of their products, one row each, of a task's rows."""
    def run(batches):
        total, n = np.zeros((size + 1, size + 1)), 0
        for b in batches:
            x = _unpack(b.column("raw"), size).astype(np.float64)
            x = np.hstack([x, np.ones((len(x), 1))])
            total += x.T @ x
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], names=["at", "value"])
    return run


def axes(vectors: DataFrame, size: int) -> np.ndarray:
    """Principal axes (columns, the widest first) of all vectors."""
    rows = vectors.select("raw").mapInArrow(_products(size), "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).toPandas()
    if not len(rows):
        return np.eye(size)
    total = np.zeros((size + 1) ** 2)
    total[rows["at"].to_numpy()] = rows["value"].to_numpy()
    total = total.reshape(size + 1, size + 1)
    mean = total[size, :size] / total[size, size]
    return np.linalg.eigh(total[:size, :size] / total[size, size] - np.outer(mean, mean))[1][:, ::-1]


def rotated(x: np.ndarray, turn: np.ndarray, leading: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading rotated coordinates and the norm of the others."""
    y = x.astype(np.float64) @ turn
    return y[:, :leading], np.sqrt((y[:, leading:] ** 2).sum(axis=1))


def _filter(shared, size: int, leading: int):
    """Adds the stored coordinates: leading ones, then the residual norm."""
    def run(batches):
        for b in batches:
            lead, rest = rotated(_unpack(b.column("raw"), size), shared.value, leading)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("raw"), binary_column(np.hstack([lead, rest[:, None]]))], names=["vec_id", "raw", "filter"])
    return run


def nearest(x: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, c_lead: np.ndarray, c_rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each vector, its squared distance, and the number of exact comparisons."""
    k = len(centroids)
    bound = ((lead ** 2).sum(axis=1)[:, None] - 2 * lead @ c_lead.T + (c_lead ** 2).sum(axis=1)) + (rest[:, None] - c_rest) ** 2
    # what rounding in the rotation and in the sums above can amount to, many times over
    bound -= 1e-9 * ((lead ** 2).sum(axis=1) + rest ** 2)[:, None] + 1e-9 * ((c_lead ** 2).sum(axis=1) + c_rest ** 2) + 1e-6
    cluster = bound.argmin(axis=1)
    best = ((x - centroids[cluster]) ** 2).sum(axis=1)
    first, compared = cluster.copy(), len(x)
    for j in range(k):
        rows = np.flatnonzero((bound[:, j] <= best) & (first != j))
        if len(rows):
            compared += len(rows)
            d = ((x[rows] - centroids[j]) ** 2).sum(axis=1)
            closer = (d < best[rows]) | ((d == best[rows]) & (j < cluster[rows]))
            best[rows[closer]], cluster[rows[closer]] = d[closer], j
    return cluster, best, compared


def _assigned(b: pa.RecordBatch, centroids: np.ndarray, turn: np.ndarray, leading: int):
    x = _unpack(b.column("raw"), centroids.shape[1])
    col = b.column("filter")
    start = np.frombuffer(col.buffers()[1], np.int32)[col.offset] if len(col) else 0
    f = np.frombuffer(col.buffers()[2], np.float64, len(x) * (leading + 1), start).reshape(len(x), leading + 1) if len(x) else np.zeros((0, leading + 1))
    return x, nearest(x, f[:, :leading], f[:, leading], centroids, *rotated(centroids, turn, leading))


def _sums(shared, centroids: np.ndarray, leading: int):
    """Sums by cluster and component of a task's rows (component -1: the rows' number)."""
    def run(batches):
        k, size = centroids.shape
        total, seen = np.zeros((k, size + 1), np.int64), 0

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(k, dtype=np.int32), size + 1)), pa.array(np.tile(np.arange(-1, size, dtype=np.int32), k)),
                                               pa.array(total.ravel().copy())], names=["cluster", "component", "total"])
        for b in batches:
            x, (cluster, _, _) = _assigned(b, centroids, shared.value, leading)
            for j in range(k):
                part = x[cluster == j]
                total[j, 0] += len(part)
                total[j, 1:] += part.sum(axis=0)
            seen += len(x)
            if seen > 1 << 34:  # a long holds 2**36 components
                yield rows()
                total[:], seen = 0, 0
        if seen:
            yield rows()
    return run


def _final(shared, centroids: np.ndarray, leading: int):
    def run(batches):
        for b in batches:
            _, (cluster, best, _) = _assigned(b, centroids, shared.value, leading)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(best)], names=["vec_id", "cluster", "distance"])
    return run


def cluster(vectors: DataFrame, column: str = "embedding", k: int = K, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE, seed: int = SEED,
            leading: int = LEADING) -> tuple[DataFrame, list[tuple[int, ...]]]:
    """(vec_id, cluster, distance) of every kept vector, written to the shared
    folder, and the final centroids."""
    spark = vectors.sparkSession
    prepare(spark)
    sc = spark.sparkContext
    kind = dict(vectors.dtypes)["vec_id"]
    whole = stored(vectors.select("vec_id", column).mapInArrow(_integers(column, size, scale), f"vec_id {kind}, raw binary"), "integers")
    turn = sc.broadcast(axes(whole, size))
    ready = stored(whole.mapInArrow(_filter(turn, size, leading), f"vec_id {kind}, raw binary, filter binary"), "rotated")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    start = whole.orderBy(digest.asc_nulls_last(), "raw").limit(k).select("raw").collect()
    if not start:
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long"), []
    centroids = np.stack([np.frombuffer(r.raw, ">u4").astype(np.int64) - _SIGN for r in start])
    for _ in range(rounds):
        parts = ready.select("raw", "filter").mapInArrow(_sums(turn, centroids, leading), "cluster int, component int, total long")
        total = {(r.cluster, r.component): int(r.total) for r in parts.groupBy("cluster", "component").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()}
        moved = centroids.copy()
        for j in range(len(centroids)):
            n = total.get((j, -1), 0)
            if n:
                moved[j] = [total[j, i] // n for i in range(size)]
        if (moved == centroids).all():
            break  # every further round would repeat this one
        centroids = moved
    return stored(ready.mapInArrow(_final(turn, centroids, leading), f"vec_id {kind}, cluster int, distance long"), "clusters"), [tuple(map(int, c)) for c in centroids]


def query(spark, sf_dir: str) -> DataFrame:
    found, centroids = cluster(table(spark, sf_dir, "embeddings"))
    most = (1 << 63) - 1
    sums = {r.cluster: int(r.total) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}  # K rows
    if not sums:
        return found.select("vec_id", "cluster", "distance", F.lit(0).cast("long").alias("cluster_inertia"), F.lit(0).cast("long").alias("inertia"), F.lit("").alias("centroid_sha256"))
    digests = {j: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for j, c in enumerate(centroids)}
    by = F.create_map(*[F.lit(x) for j, s in sums.items() for x in (j, min(s, most))])
    name = F.create_map(*[F.lit(x) for pair in digests.items() for x in pair])
    return found.select("vec_id", "cluster", "distance", by[F.col("cluster")].cast("long").alias("cluster_inertia"),
                        F.lit(min(sum(sums.values()), most)).cast("long").alias("inertia"), name[F.col("cluster")].alias("centroid_sha256"))


def _sql() -> str:
    """One step of the algorithm after the other, on lists of integers."""
    distance = "list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT"
    steps = [r"""v AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)::BIGINT) AS x FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0)""",
             "c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR) NULLS LAST, x) - 1)::INTEGER AS j, x FROM v QUALIFY j < 8)"]
    for i in range(11):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT id, vec_id, x, min(struct_pack(d := d, j := j)) AS best FROM
    (SELECT v.id, v.vec_id, v.x, {distance} AS d, c.j FROM v CROSS JOIN c{i} c) GROUP BY id, vec_id, x)""")
        if i < 10:
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT c.j, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN
    (SELECT j, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY k) AS x FROM
        (SELECT best.j AS j, k, sum(x[k])::BIGINT AS s, count(*) AS n FROM a{i}, unnest(range(1, 65)) AS u(k) GROUP BY ALL) GROUP BY j) m USING (j))""")
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, best.j AS cluster, best.d AS distance, (sum(best.d) OVER (PARTITION BY best.j))::BIGINT AS cluster_inertia, (sum(best.d) OVER ())::BIGINT AS inertia,
    sha256(array_to_string(c10.x, ',')) AS centroid_sha256
FROM a10 JOIN c10 ON c10.j = best.j"""


SQL = _sql()
