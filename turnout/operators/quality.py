"""Data-quality checks: each check returns its failing rows as a DataFrame;
a suite runs the declared checks and reports failures per check."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, col: str, where: str | None = None) -> DataFrame:
    src = df.where(where) if where else df
    return src.where(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values seen more than once (NULL ignored): (unique_field, n_records)."""
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("unique_field"))
              .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Distinct values outside the accepted list (NULL passes): (value_field, n_records)."""
    return (df.groupBy(F.col(col).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
              .where(~F.col("value_field").isin(values)))


def unique_combination(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def relationships(child: DataFrame, col: str, parent: DataFrame, field_: str) -> DataFrame:
    """Child rows whose non-null key has no parent (an anti join)."""
    keys = parent.select(F.col(field_).alias(col)).where(F.col(col).isNotNull())
    return child.where(F.col(col).isNotNull()).join(keys, col, "left_anti").select(F.col(col).alias("from_field"))


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str                      # not_null | unique | accepted_values | unique_combination | relationships
    where: str | None = None
    values: tuple = ()
    columns: tuple = ()
    to: str | None = None          # parent model (relationships)
    field: str | None = None       # parent column (relationships)


def _nn(model, *cols, where=None):
    return [Check(model, c, "not_null", where=where) for c in cols]


# The declared checks of the two model families, one entry per declaration.
LOCAL_CHECKS = (
    [Check("activity", "activity_id", "unique")] + _nn("activity", "activity_id", "event_type_label")
    + _nn("activity", "result_label", where="result_id IS NOT NULL")
    + _nn("activity", "start_at", "end_at", "duration_minutes")
    + [Check("member", "member_id", "unique")]
    + _nn("member", "member_id", "first_name", "last_name", "is_player", "is_leader", "member_type_label")
    + [Check("attended_activity", "attendance_id", "unique")]
    + _nn("attended_activity", "attendance_id", "member_id", "activity_id")
)

WAREHOUSE_CHECKS = (
    [Check("player_status", "date_day,member_id", "unique_combination", columns=("date_day", "member_id"))]
    + _nn("player_status", "date_day", "member_id", "status")
    + [Check("player_status", "status", "accepted_values", values=("Active", "Churned")),
       Check("player_status", "status_event", "accepted_values", values=("New", "Churn")),
       Check("activity", "activity_id", "unique")]
    + _nn("activity", "activity_id", "activity")
    + _nn("activity", "result", where="result_type_id IS NOT NULL")
    + _nn("activity", "start_at", "end_at", "duration_minutes", "duration_hours")
    + [Check("activity", "season_id", "relationships", to="season", field="season_id"),
       Check("member", "member_id", "unique")]
    + _nn("member", "member_id", "first_name", "last_name", "member_type", "full_name")
    + [Check("member", "full_name", "unique"),
       Check("attended_activity", "attendance_id", "unique")]
    + _nn("attended_activity", "attendance_id", "member_id", "activity_id")
    + [Check("training_participation", "member_id", "unique")]
    + _nn("training_participation", "member_id", "full_name", "member_type")
)


def failing_rows(models: dict[str, DataFrame], c: Check) -> DataFrame:
    df = models[c.model]
    if c.test == "not_null":
        return not_null(df, c.column, c.where)
    if c.test == "unique":
        return unique(df, c.column)
    if c.test == "accepted_values":
        return accepted_values(df, c.column, list(c.values))
    if c.test == "unique_combination":
        return unique_combination(df, list(c.columns))
    if c.test == "relationships":
        return relationships(df, c.column, models[c.to], c.field)
    raise ValueError(c.test)


def _label(c: Check) -> F.Column:
    return F.struct(F.lit(c.model).alias("model"), F.lit(c.column).alias("column"), F.lit(c.test).alias("test"))


def _entry(c: Check, number: int):
    """What a row adds to a check's groups: struct(check, key), NULL when nothing."""
    key = None
    if c.test == "not_null":
        bad = F.col(c.column).isNull() & (F.expr(c.where) if c.where else F.lit(True))
        key = F.when(F.coalesce(bad, F.lit(False)), F.array(F.lit("")))
    elif c.test == "unique":
        key = F.when(F.col(c.column).isNotNull(), F.array(F.col(c.column).cast("string")))
    elif c.test == "accepted_values":
        key = F.when(F.coalesce(~F.col(c.column).isin(list(c.values)), F.lit(False)), F.array(F.col(c.column).cast("string")))
    elif c.test == "unique_combination":
        key = F.array(*[F.col(x).cast("string") for x in c.columns])
    return F.when(key.isNotNull(), F.struct(F.lit(number).alias("c"), key.alias("k")))


def _failures(c: Check, number: int):
    """Failures of a check from the groups (c, k, n) of its model."""
    mine = F.col("c") == number
    if c.test == "not_null":
        return F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0))
    return F.count_if(mine & (F.lit(True) if c.test == "accepted_values" else F.col("n") > 1))


def run_checks(models: dict[str, DataFrame], checks) -> DataFrame:
    """(model, column, test, failures): one row per declared check.

    All checks of one model but foreign keys are one pass and one shuffle: a row is
    expanded to the (check, key) pairs it adds to (nothing for a value that is there, or
    accepted), pairs are counted, before the shuffle too, and the failing groups of each check
    are counted.  A foreign key is an anti join.  Nothing is collected to the driver.
    """
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        if c.test == "relationships":
            parts.append(failing_rows(models, c).agg(F.count(F.lit(1)).alias("failures")).select(_label(c).alias("k"), "failures"))
        else:
            by_model.setdefault(c.model, []).append(c)
    for model, cs in by_model.items():
        entries = F.filter(F.array(*[_entry(c, i) for i, c in enumerate(cs)]), lambda e: e.isNotNull())
        groups = models[model].select(F.explode(entries).alias("e")).groupBy("e.c", "e.k").agg(F.count(F.lit(1)).alias("n"))
        one = groups.agg(*[_failures(c, i).alias(f"c{i}") for i, c in enumerate(cs)])
        stacked = F.array(*[F.struct(_label(c).alias("k"), F.col(f"c{i}").cast("bigint").alias("failures")) for i, c in enumerate(cs)])
        parts.append(one.select(F.explode(stacked).alias("s")).select("s.k", "s.failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("k.model", "k.column", "k.test", F.col("failures").cast("bigint").alias("failures"))
