"""Sources (raw loads, lookups, generated spines, captured pages) and sinks."""

from pyspark.sql import DataFrame, SparkSession

from .raw import read_raw_activity, read_raw_presence
from .rawtable import SchemaConflict, append_load, ledger, newest_load_id, read_raw_table, replace_table, vacuum
from .seeds import SEED_NAMES, dims, read_seed, season
from .sinks import (export_csv, materialize, new_load_stamp, register_views, require_non_empty,
                    row_count, stamp_load, write_ndjson)
from .spines import calendar, default_calendar, month_urls


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured web pages (page_id, url, html[, status]) stored as Parquet."""
    return spark.read.parquet(path)


__all__ = [n for n in dir() if not n.startswith("_")]
