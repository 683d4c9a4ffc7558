"""Token counts with overlap resynchronisation.

Texts up to CHUNK bytes are encoded whole.  A longer one is encoded in chunks
that overlap: the tokens of the next chunk replace those of the chunk before it
from a position p inside the overlap at which both encodings have a token
boundary and which is proven stable.  Stable is a white-space byte after a
visible ASCII byte: no alternative of the splitting pattern runs from a visible
character into white space, so every encoding of any text around p starts a new
piece at p; pieces before p do not look past p and those after it do not look
back.  If the overlap has no such place, or the offsets of the two encodings
disagree, the chunk is widened (doubled) and encoded again, in the worst case to
the end of the text, so counts are exact always.

The vocabulary of byte_bpe_50k.json is used through its rank file (the same
tokens and merges); tests hold the counts equal to those of the ``tokenizers``
library, which also encodes any text that the rank encoder refuses.  Special strings
inside a text count as that library does by default: as one token.

Null is an empty text: no bytes, no tokens.  Rows are counted one by one, so
null or repeated doc_ids and repeated rows need no rule; an empty table gives no rows.  Very long texts are cut as
above.  Extra columns are ignored.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, table

VOCABULARY, RANKS, END = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "<|endoftext|>"
CHUNK, OVERLAP, LIMIT = 1 << 16, 1 << 10, 512
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VISIBLE = np.zeros(256, bool)
_VISIBLE[33:127] = True
_loaded: dict = {}


class Counter:
    """Counts and offsets of one vocabulary."""

    def __init__(self, vocabulary: str = VOCABULARY, ranks: str = RANKS):
        import public_tokenizers as files
        import tiktoken
        from tokenizers import Tokenizer

        with open(files.path(ranks), "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("counter", pat_str=files.PATTERN, mergeable_ranks=table, special_tokens={END: len(table)})
        self.exact = lambda: Tokenizer.from_file(files.path(vocabulary))
        self.size = np.zeros(len(table) + 1, np.int64)
        for piece, i in table.items():
            self.size[i] = len(piece)
        self.size[len(table)] = len(END)

    def encode(self, data: bytes) -> np.ndarray:
        text = data.decode("utf-8", "replace")
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except Exception:  # noqa: BLE001 - the pattern engine gives up on some very long runs
            return np.array(self.exact().encode(text, add_special_tokens=False).ids, np.int64)

    def ends(self, data: bytes) -> np.ndarray:
        """Byte offset of the end of every token."""
        return np.cumsum(self.size[self.encode(data)])

    def count(self, data: bytes, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        if len(data) <= chunk:
            return len(self.encode(data))
        raw = np.frombuffer(data, np.uint8)
        start, total, width = 0, 0, chunk
        ends = None  # of the tokens of the chunk that begins at start
        while True:
            stop = _edge(raw, start + width)
            ends = self.ends(data[start:stop])
            if stop >= len(raw):
                return total + len(ends)
            nxt = _edge(raw, max(start + 1, stop - overlap))
            place = self._common(raw, start, stop, nxt, ends)
            if place is None:
                width *= 2
                overlap *= 2
                continue
            total += int(np.searchsorted(ends, place - start, "right"))
            start, width = place, chunk

    def _common(self, raw: np.ndarray, start: int, stop: int, nxt: int, ends: np.ndarray) -> int | None:
        """The last stable position in the overlap that is a token boundary of
        the chunk and of the encoding of the overlap alone."""
        part = raw[nxt:stop]
        stable = np.flatnonzero(_SPACE[part[1:]] & _VISIBLE[part[:-1]]) + 1 + nxt
        if not len(stable):
            return None
        again = self.ends(part.tobytes()) + nxt
        stable = stable[np.isin(stable, ends + start) & np.isin(stable, again)]
        return int(stable[-1]) if len(stable) else None


def _edge(raw: np.ndarray, at: int) -> int:
    """The character boundary at or before ``at``."""
    if at >= len(raw):
        return len(raw)
    while at > 0 and (raw[at] & 0xC0) == 0x80:
        at -= 1
    return at


def _counter() -> Counter:
    if "counter" not in _loaded:
        _loaded["counter"] = Counter()
    return _loaded["counter"]


def _count(batches):
    counter = _counter()
    for b in batches:
        sizes, tokens = [], []
        for x in b.column("text").cast(pa.binary()):
            data = x.as_py() or b""
            sizes.append(len(data))
            tokens.append(counter.count(data))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])


def counts(documents: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row."""
    prepare(documents.sparkSession)
    kind = dict(documents.dtypes)["doc_id"]
    return (documents.select("doc_id", "text").mapInArrow(_count, f"doc_id {kind}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))


def query(spark, sf_dir: str) -> DataFrame:
    return counts(table(spark, sf_dir, "documents"))
