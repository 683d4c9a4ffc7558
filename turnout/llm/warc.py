"""Web archives in Zstandard: writer and reader.

An archive begins with a skippable frame that holds its dictionary (trained on its
own first records; their raw text where there is too little to train on). Every
record is one Zstandard frame with content size and check sum, compressed with that
dictionary.  The reader takes the dictionary from the leading frame, walks the
frames by their block headers, decodes each alone, and validates magic numbers,
frame and content lengths, the version line, mandatory headers, the closing blank
lines and the digest of each stored payload; anything wrong fails the read.

Files are written by Spark's text sink, so an archive can go to any file system that
Spark writes: a row is a frame's bytes followed by the head of a one-byte skippable
frame, whose byte is the line feed that the sink adds after each row.

Records: payload is the html in UTF-8 (null: empty).  Of equal payloads of LEAST
bytes or more, the record with the largest page_id is the response (rows that share it
all are), the others are revisits that refer to it and store no payload; smaller
payloads are responses always.  A null page_id counts as the smallest; null urls have
no target header; line breaks in urls are percent-encoded.  Repeated rows give
repeated records.  An empty table gives no archives and no rows.  A very long payload is one frame, as long
in memory as it is; an archive is read as a whole.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import prepare, table

LEAST, LEVEL = 1000, 3
TRAIN_RECORDS, TRAIN_BYTES, DICTIONARY_BYTES = 64, 1 << 20, 1 << 14
FRAME, SKIPPABLE, DICTIONARY, TRAINED = 0xFD2FB528, 0x184D2A50, 0x184D2A5D, 0xEC30A437
FILL = struct.pack("<II", SKIPPABLE, 1)  # the sink's line feed completes it
MANDATORY = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")


def plan(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_digest, payload_bytes, refers_to (null: response)."""
    raw = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", raw.alias("payload"), F.sha1(raw).alias("payload_digest"), F.octet_length(raw).cast("long").alias("payload_bytes"))
    several = (rows.where(F.col("payload_bytes") >= LEAST).groupBy("payload_digest")
               .agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1 AND last IS NOT NULL").drop("n"))
    other = ~F.col("page_id").eqNullSafe(F.col("last")) & F.col("last").isNotNull()
    return rows.join(several, "payload_digest", "left").withColumn("refers_to", F.when(other, F.col("last"))).drop("last")


def record(page_id, url, payload: bytes, digest: str, size: int, refers_to) -> bytes:
    """One record: headers, blank line, payload (none in a revisit), two line ends."""
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", "WARC-Date: 2024-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {size}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        payload = b""
    head += ["Content-Type: text/html", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def dictionary(samples: list[bytes]) -> bytes:
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def frames(records) -> Iterator[bytes]:
    """The frames of one archive."""
    import zstandard

    first, size = [], 0
    for r in records:
        first.append(r)
        size += len(r)
        if len(first) >= TRAIN_RECORDS or size >= TRAIN_BYTES:
            break
    if not first:
        return
    words = dictionary(first)
    yield struct.pack("<II", DICTIONARY, len(words)) + words
    c = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(words), write_checksum=True, write_content_size=True)
    for r in first:
        yield c.compress(r)
    del first
    for r in records:
        yield c.compress(r)


def _write(batches):
    def records():
        for b in batches:
            for i in range(0, b.num_rows, 64):
                yield from (record(r["page_id"], r["url"], r["payload"], r["payload_digest"], r["payload_bytes"], r["refers_to"]) for r in b.slice(i, 64).to_pylist())
    held, size = [], 0
    for f in frames(records()):
        held.append(f + FILL)
        size += len(f)
        if size >= 1 << 22:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["frame"])
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["frame"])


def write_archives(pages: DataFrame, path: str) -> None:
    """One archive for each partition of the planned records."""
    prepare(pages.sparkSession)
    (plan(pages).mapInArrow(_write, "frame binary").select(F.col("frame").cast("string").alias("value"))
     .write.option("lineSep", "\n").option("compression", "none").text(path))


def split(data: bytes) -> Iterator[tuple[int, int, int]]:
    """(magic, start, end) of every frame, from headers and block lengths."""
    at = 0
    while at < len(data):
        if at + 8 > len(data):
            raise ValueError(f"frame cut off at byte {at}")
        magic, size = struct.unpack_from("<II", data, at)
        if magic & 0xFFFFFFF0 == SKIPPABLE:
            end = at + 8 + size
        elif magic == FRAME:
            flags = data[at + 4]
            single = flags >> 5 & 1
            end = at + 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + ((1 if single else 0), 2, 4, 8)[flags >> 6]
            last = 0
            while not last:
                if end + 3 > len(data):
                    raise ValueError(f"frame cut off at byte {at}")
                head = int.from_bytes(data[end:end + 3], "little")
                last, kind = head & 1, head >> 1 & 3
                if kind == 3:
                    raise ValueError(f"reserved block at byte {end}")
                end += 3 + (1 if kind == 1 else head >> 3)
            end += 4 * (flags >> 2 & 1)
        else:
            raise ValueError(f"no frame at byte {at}")
        if end > len(data):
            raise ValueError(f"frame cut off at byte {at}")
        yield magic, at, end
        at = end


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record, validated."""
    head, blank, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not blank or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("not a record")
    fields = dict(line.partition(": ")[::2] for line in lines[1:])
    missing = [x for x in MANDATORY if x not in fields]
    if missing:
        raise ValueError(f"missing headers: {missing}")
    size = int(fields["Content-Length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"block of {len(rest) - 4} bytes, declared {size}")
    return fields, rest[:size]


def _id(value: str | None) -> int | None:
    return int(value[len("<urn:page:"):-1]) if value and value != "<urn:page:>" else None


def records(data: bytes):
    """(headers, payload) of every record of an archive."""
    import zstandard

    decoder = None
    for magic, start, end in split(data):
        if magic == DICTIONARY and start == 0:
            words = data[8:end]
            if words[:4] == struct.pack("<I", FRAME):
                words = zstandard.ZstdDecompressor().decompressobj().decompress(words)
            decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words))
        elif magic == FRAME:
            if decoder is None:
                raise ValueError("no leading dictionary frame")
            body = data[start:end]
            raw = decoder.decompress(body)
            declared = zstandard.frame_content_size(body)
            if declared >= 0 and len(raw) != declared:
                raise ValueError(f"frame of {len(raw)} bytes, declared {declared}")
            fields, payload = parse(raw)
            if fields["WARC-Type"] == "response" and "WARC-Payload-Digest" in fields:
                if fields["WARC-Payload-Digest"] != "sha1:" + hashlib.sha1(payload).hexdigest() or int(fields.get("WARC-Payload-Length", len(payload))) != len(payload):
                    raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its headers")
            yield fields, payload


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """page_id, url, record_type, payload_digest, payload_bytes, refers_to and,
    if wanted, payload (null in revisits) of all records."""
    prepare(spark)

    def run(batches):
        for b in batches:
            for where, content in zip(b.column("path").to_pylist(), b.column("content")):
                held, size = [], 0
                try:
                    for f, payload in records(content.as_py()):
                        kind = f["WARC-Type"]
                        held.append({"page_id": _id(f["WARC-Record-ID"]), "url": f.get("WARC-Target-URI"), "record_type": kind,
                                     "payload_digest": f.get("WARC-Payload-Digest", "").removeprefix("sha1:"), "payload_bytes": int(f.get("WARC-Payload-Length", len(payload))),
                                     "refers_to": _id(f.get("WARC-Refers-To")), **({"payload": payload if kind == "response" else None} if payloads else {})})
                        size += len(payload) * payloads + 200
                        if size >= 1 << 22:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, size = [], 0
                except ValueError as e:
                    raise ValueError(f"{where}: {e}") from e
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64())]
    schema = pa.schema([*fields, *([("payload", pa.binary())] if payloads else [])])
    return (spark.read.format("binaryFile").load(path).select("path", "content")
            .mapInArrow(run, "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long" + ", payload binary" * payloads))


def query(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM d),
t AS (SELECT *, payload_bytes >= 1000 AND last IS NOT NULL AND page_id IS DISTINCT FROM last AS other FROM m)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN other THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN other THEN last END AS refers_to FROM t
"""
