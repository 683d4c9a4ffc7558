"""Incremental ingestion of landed load batches into the raw tables.

The crawler lands each run as NDJSON files and appends them to the raw
tables, new fields allowed.  As a Structured Streaming job this is a file source over
the landing folder; every micro-batch reads the fields of its own files, splits
their lines and commits the rows to the raw table together with the batch's number, so
a batch that is run again after a failure is not added twice.
``trigger(availableNow=True)`` processes what has landed and stops, so the job can run
after each crawl like a batch step.

Lines that are not JSON or do not fit their declared types fail the run, or,
with ``quarantine``, go to a folder of that name, one sub-folder a batch.  A load whose fields
conflict with the table's is refused (``SchemaConflict``) in either case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..sources import rawtable
from ..sources.raw import load_schema, split_lines

RAW_SCHEMAS = {"activity": schemas.RAW_ACTIVITY, "presence": schemas.RAW_PRESENCE}


class BadLines(ValueError):
    """A landed file holds lines that cannot be read as records."""


def ingest_loads(spark: SparkSession, kind: str, landing_dir: str, table_dir: str, checkpoint_dir: str,
                 max_files_per_trigger: int | None = None, quarantine: str | None = None) -> DataFrame:
    """Append every not-yet-ingested NDJSON file under ``landing_dir`` to the
    raw ``kind`` table at ``table_dir``; returns the (accumulated) table."""
    def batch(lines: DataFrame, number: int) -> None:
        now = rawtable.version(spark, table_dir)
        if now is not None and now.batch.get(checkpoint_dir, -1) >= number:
            return  # committed before the run was cut off
        files = [r.file for r in lines.select("file").distinct().collect()]  # the batch's new files
        if not files:
            return
        rows, rejects = split_lines(spark.read.text(files), load_schema(spark, files, RAW_SCHEMAS[kind]))
        if quarantine is None:
            first = rejects.first()
            if first is not None:
                raise BadLines(f"line cannot be read: {first.line[:200]}")
        else:
            rejects.write.mode("overwrite").text(f"{quarantine}/batch={number}")
        rawtable.append_load(rows, table_dir, {checkpoint_dir: number})

    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.text(landing_dir).select(F.col("_metadata.file_path").alias("file"))
    query = (stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint_dir)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return rawtable.read_raw_table(spark, table_dir)


def rejected_lines(spark: SparkSession, quarantine: str) -> DataFrame:
    """(line, batch) of the lines set aside so far."""
    return spark.read.schema("value string, batch bigint").text(quarantine).select(F.col("value").alias("line"), "batch")
