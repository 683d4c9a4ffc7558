"""Raw inputs: newline-delimited JSON loads.

A load is read with the declared fields plus whatever new fields its lines hold, at
any depth.  A line that is not JSON, or a value that does not fit its declared type, fails the
read; ``split_lines`` sets such lines aside instead.  Accumulated raw tables are in
``rawtable``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from .rawtable import read_raw_table  # noqa: F401

CORRUPT = "_corrupt_line"


def extended(declared: T.DataType, found: T.DataType) -> T.DataType:
    """The declared type with the new fields of ``found``, inside structs and arrays
    too.  Where both name a field the declared type holds."""
    if isinstance(declared, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(extended(declared.elementType, found.elementType))
    if not (isinstance(declared, T.StructType) and isinstance(found, T.StructType)):
        return declared
    known = {f.name.lower(): f.dataType for f in found.fields}
    fields = [T.StructField(f.name, extended(f.dataType, known.get(f.name.lower(), f.dataType))) for f in declared.fields]
    have = {f.name.lower() for f in declared.fields} | {CORRUPT}
    return T.StructType([*fields, *[f for f in found.fields if f.name.lower() not in have]])


def load_schema(spark: SparkSession, path: str | list[str], declared: T.StructType) -> T.StructType:
    """The declared fields, then the new ones found in the load (a field that is always null has no type yet)."""
    return extended(declared, spark.read.option("columnNameOfCorruptRecord", CORRUPT).option("dropFieldIfAllNull", True).json(path).schema)


def _read_strict(spark: SparkSession, path: str, declared: T.StructType) -> DataFrame:
    return spark.read.schema(load_schema(spark, path, declared)).option("mode", "FAILFAST").json(path)


def read_raw_activity(spark: SparkSession, path: str) -> DataFrame:
    """NDJSON activity records (one per activity page)."""
    return _read_strict(spark, path, schemas.RAW_ACTIVITY)


def read_raw_presence(spark: SparkSession, path: str) -> DataFrame:
    """NDJSON presence records with nested groups of leaders/participants."""
    return _read_strict(spark, path, schemas.RAW_PRESENCE)


def split_lines(lines: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a column ``value`` of lines: the readable records, and
    the text of lines that are not JSON or hold a value of another type (blank
    lines are neither)."""
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    read = F.from_json("value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    parsed = lines.where(F.trim("value") != "").select("value", F.explode(F.array(read)).alias("r"))  # parsed once a line
    bad = F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull()
    return parsed.where(~bad).select("r.*").drop(CORRUPT), parsed.where(bad).select(F.col("value").alias("line"))


def split_load(spark: SparkSession, path: str, declared: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a landed load."""
    return split_lines(spark.read.text(path), load_schema(spark, path, declared))
