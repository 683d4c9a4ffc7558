"""Tables stored by the hash of a key, so that joins on it need no exchange.

A bucketed table is one file per bucket, each in key order.  Two of them with the
same number of buckets, or one and rows that are shuffled anyway, join without
moving the stored side again: it is shuffled once, when it is written, however many
models read it.

A bucket is one task of every join that reads it, and a hot key cannot be split there (AQE splits
only shuffled partitions).  ``hottest`` therefore measures the keys first, and ``even`` says whether
the most frequent value is small enough; where it is not, the caller stores the
table without buckets and the join goes by AQE's skew handling.  Results are the same.

The layout is kept in the session's catalog; ``attach`` names it again for files
written by an earlier session.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: a key's rows may fill a bucket so many times over
MOST_BUCKETS_A_KEY = 4.0


def hottest(df: DataFrame, *keys: str) -> dict[str, float]:
    """Per key column the share of all rows that its most frequent value holds
    (NULL is a value too); 0 of an empty table.  One row a column comes to the driver."""
    parts = [df.groupBy(F.col(k).alias("k")).agg(F.count(F.lit(1)).alias("n"))
             .agg(F.max("n").alias("most"), F.sum("n").alias("rows")).select(F.lit(k).alias("key"), "most", "rows") for k in keys]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return {r.key: r.most / r.rows if r.rows else 0.0 for r in out.collect()}


def even(share: float, buckets: int) -> bool:
    """Whether the most frequent value fits buckets of that number."""
    return share * buckets <= MOST_BUCKETS_A_KEY or buckets == 1


def _name() -> str:
    return f"bucketed_{uuid.uuid4().hex}"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Replace the table at ``path`` by ``df`` in ``buckets`` buckets of ``key`` and
    return the table.  Rows go to their bucket's task first, so a bucket is one file."""
    spark, name = df.sparkSession, _name()
    (df.repartition(buckets, key).write.format("parquet").mode("overwrite")
       .bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name))
    return spark.table(name)


def attach(spark: SparkSession, path: str, key: str, buckets: int) -> DataFrame:
    """The bucketed table that another session wrote at ``path``."""
    name, schema = _name(), spark.read.parquet(path).schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def forget(spark: SparkSession) -> int:
    """Drop this module's names from the catalog (the files stay); returns their number."""
    names = [t.name for t in spark.catalog.listTables() if not t.isTemporary and t.name.startswith("bucketed_")]
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")
    return len(names)
