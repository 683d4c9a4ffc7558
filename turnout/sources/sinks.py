"""Sinks and load steps: NDJSON, raw tables, load stamps, model tables, CSV export."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .rawtable import append_load, replace_table  # noqa: F401


def new_load_stamp() -> tuple[str, dt.datetime]:
    """A run-constant load id and UTC time, fixed once on the driver
    (``uuid()`` in SQL would differ per row)."""
    return str(uuid.uuid4()), dt.datetime.now(dt.timezone.utc)


def stamp_load(df: DataFrame, load_id: str, load_timestamp: dt.datetime) -> DataFrame:
    return df.withColumns({"load_id": F.lit(load_id),
                           "load_timestamp": F.lit(load_timestamp).cast("timestamp")})


def require_non_empty(**frames: DataFrame) -> None:
    """Refuse an empty payload: raise when any of the named inputs has no rows."""
    empty = [name for name, df in frames.items() if df.isEmpty()]
    if empty:
        raise ValueError(f"Scrape payload is empty: {', '.join(empty)}")


def write_ndjson(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)


def row_count(df: DataFrame) -> DataFrame:
    """One row, ``row_count``: the number of rows (a distributed count)."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def materialize(df: DataFrame, path: str, sort_within: list[str] | None = None, partition_by: str | None = None) -> DataFrame:
    """Write a model as a full-refresh Parquet table and return the table.

    Reading the written table back cuts the lineage: later models start from
    files on the shared file system, so a lost executor never recomputes the
    upstream models.
    """
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    writer = out.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Wide export as CSV with header, comma-separated.

    The export is a folder of part files written in parallel; it is never
    funnelled through one task.  A quote inside a value is doubled.
    """
    (df.write.mode("overwrite").option("header", True).option("sep", ",").option("escape", '"')
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ssXXX").csv(path))


def register_views(spark: SparkSession, models: dict[str, DataFrame]) -> None:
    """Expose models to ad-hoc SQL (``spark.sql('SELECT * FROM member LIMIT 11')``)."""
    for name, df in models.items():
        df.createOrReplaceTempView(name)
