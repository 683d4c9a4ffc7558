"""Top-1 row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _rank_expr(name: str, direction: str) -> Column:
    c = F.col(name)
    if direction == "desc":
        return c
    if direction == "asc":
        return -c
    raise ValueError(direction)


def latest_per_key(df: DataFrame, keys: list[str], order: list[tuple[str, str]]) -> DataFrame:
    """Keep one row per ``keys``: the first by ``order`` (numeric columns,
    ``"desc"``/``"asc"``, nulls last), remaining ties broken by the row values.

    Same result as ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order) = 1``
    but computed as ``max(struct(rank..., row))`` per key: a partial aggregate
    runs before the shuffle, so each map task sends at most one row per key
    and a key holding a large share of the rows never lands whole in one task.
    """
    payload = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[_rank_expr(n, d).alias(f"_r{i}") for i, (n, d) in enumerate(order)],
                      F.struct(*payload).alias("row"))
    return (df.groupBy(*keys).agg(F.max(ranked).alias("_best"))
              .select(*keys, *[F.col("_best.row").getField(c).alias(c) for c in payload]))
