"""Lookup tables (activity, member and result types; seasons).

The files are tiny and fixed, so they are read on the driver: as a local
relation in the plan for the lookup models, and as literal maps for labels
(``labels`` + ``functions.label``), so no model joins them.  A shared path
can be given instead, read with Spark's CSV reader.
"""

from __future__ import annotations

import csv
from importlib import resources

from pyspark.sql import DataFrame, SparkSession

from ..schemas import SEED_SCHEMAS

SEED_NAMES = tuple(SEED_SCHEMAS)


def _rows(name: str):
    schema = SEED_SCHEMAS[name]
    text = resources.files("turnout.seeds").joinpath(f"{name}.csv").read_text(encoding="utf-8")
    reader = csv.DictReader(text.splitlines())
    out = []
    for rec in reader:
        row = []
        for f in schema.fields:
            v = rec[f.name]
            row.append(int(v) if f.dataType.typeName() == "long" else v)
        out.append(tuple(row))
    return out


def read_seed(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    schema = SEED_SCHEMAS[name]
    if path is not None:
        return spark.read.schema(schema).option("header", True).option("encoding", "UTF-8").csv(path)
    return spark.createDataFrame(_rows(name), schema)


def season(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Season dimension, columns in model order."""
    return read_seed(spark, "seasons", path).select("season_id", "season_name", "year", "difficulty")


def labels(name: str) -> dict[int, str]:
    """A lookup file as {id: name} (fixed, at most a dozen entries)."""
    return {r[0]: r[1] for r in _rows(name)}


def dims(spark: SparkSession) -> dict[str, DataFrame]:
    """The four lookup tables as DataFrames (the lookup models)."""
    return {n: read_seed(spark, n) for n in SEED_NAMES}
