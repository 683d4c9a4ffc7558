"""Helpers shared by the operators: table access, written intermediates and
vectorised work on the UTF-8 bytes of an Arrow text column.

Texts are handled as whole byte buffers with numpy.  A *word* is a maximal run
of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z; every byte of a
non-ASCII character belongs to a word, so the rule can be read off the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir, scratch_path, ship_package

#: Texts are worked on in blocks of whole documents of about this many bytes.
BLOCK_BYTES = 1 << 20
#: Rows go to Python in batches of about this many bytes, so that a task's memory
#: does not depend on how long the texts are (but for the longest one).
BATCH_BYTES = 8 << 20

_rng = np.random.default_rng(20240229)
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[65:91] = IS_WORD[97:123] = IS_WORD[128:] = True
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
GRAM_BASE = 0xD6E8FEB86659FD93


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Shared folder, package on the workers, small batches; harmless when repeated."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and
    gives later steps a table that survives the loss of executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (every input bit changes every output bit)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers = {"n": 0, "p": np.ones(1, np.uint64), "q": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse for i <= n (kept, grown when needed)."""
    if _powers["n"] < n:
        m = max(n, BLOCK_BYTES)
        for key, b in (("p", BASE), ("q", BASE_INVERSE)):
            steps = np.full(m + 1, b, np.uint64)
            steps[0] = 1
            _powers[key] = np.cumprod(steps, dtype=np.uint64)
        _powers["n"] = m
    return _powers["p"], _powers["q"]


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its rows; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(col.buffers()[1], kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(data: np.ndarray, offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of blocks of whole documents."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


@dataclass
class Words:
    start: np.ndarray   # byte offsets in the block
    end: np.ndarray
    first: np.ndarray   # index of each document's first word; one more at the end
    code: np.ndarray    # 64-bit hash of each lower-cased word

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of n words inside one document, and the index of
        the first word of each."""
        total = len(self.code)
        if total < n:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        m = total - n + 1
        out = np.zeros(m, np.uint64)
        for k in range(n):
            out += self.code[k:k + m] * np.uint64(pow(GRAM_BASE, k, 1 << 64))
        last = np.repeat(self.first[1:], self.counts)
        at = np.flatnonzero(np.arange(m) + n <= last[:m])
        return mix(out[at]), at


def words(data: np.ndarray, offsets: np.ndarray, belongs: np.ndarray = IS_WORD) -> Words:
    """Maximal runs of the bytes that ``belongs`` marks."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(z, z, np.zeros(len(offsets), np.int64), np.zeros(0, np.uint64))
    inside = belongs[data]
    edge = offsets[offsets < n]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[edge] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edge[edge > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    p, q = powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_CODE[LOWER[data]] * p[:n], out=sums[1:])
    with np.errstate(over="ignore"):
        code = mix((sums[end] - sums[start]) * q[start] + (end - start).astype(np.uint64))
    return Words(start, end, np.searchsorted(start, offsets).astype(np.int64), code)


def list_column(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def binary_column(rows: np.ndarray) -> pa.Array:
    """One fixed-width numpy row per value, as a binary column."""
    n, width = len(rows), rows.dtype.itemsize * (rows.shape[1] if rows.ndim > 1 else 1)
    offsets = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of equal ``keys`` from batches sorted by them (a group may run
    over several batches)."""
    rest: list[pa.RecordBatch] = []
    for b in batches:
        if b.num_rows == 0:
            continue
        change = np.zeros(b.num_rows - 1, bool)
        for k in keys:
            v = b.column(k).to_numpy(zero_copy_only=False)
            change |= v[1:] != v[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), b.num_rows]
        same = bool(rest) and all(rest[-1].column(k)[rest[-1].num_rows - 1] == b.column(k)[0] for k in keys)
        if rest and not same:
            yield pa.Table.from_batches(rest)
            rest = []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            rest.append(b.slice(lo, hi - lo))
            if hi < b.num_rows:
                yield pa.Table.from_batches(rest)
                rest = []
    if rest:
        yield pa.Table.from_batches(rest)
