"""The model graph: raw loads -> staging -> dimensions/facts -> grants,
retention, participation, export.

``model_builders`` defines each model as a function of the models it reads.
``Materialized`` evaluates that graph: a model with several consumers is
written once as a Parquet table under a folder of the shared checkpoint
location and read back (the original project materializes every model as a
table too), cheap projections stay lazy.  ``build`` gives the lazy plans,
``build_all`` writes everything in dependency order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..config import Config
from ..operators import activities as act
from ..operators import grants, members, participation, quality, retention, staging
from ..sources import bucketed, rawtable, seeds, sinks
from ..sources.spines import default_calendar

Builder = Callable[["Materialized"], DataFrame]


class Materialized:
    """Models written on first use under ``root`` and read back from there.

    Each model is computed once per run however many consumers it has,
    consumers read only the columns they need, and a lost executor never
    recomputes upstream lineage.
    """

    # models that are only cheap projections of a written table stay lazy
    PROJECTIONS = frozenset({"stg_activity", "attended_activity", "activity_type", "member_type",
                             "result_type", "season", "calendar"})

    # the key that a model is joined on by every model that reads it
    JOIN_KEYS = {"member": "member_id", "attended_activity": "member_id", "activity": "activity_id"}

    def __init__(self, spark: SparkSession, root: str, builders: dict[str, Builder],
                 write: frozenset[str] | None = None, newest: dict[str, str] | None = None, buckets: int | None = None):
        """``write``: the models to write (default: all but projections); ``newest``: the newest
        load of raw tables that are given and not written; ``buckets``: store the models of
        JOIN_KEYS in so many buckets of their key, unless the attendance has a key too
        frequent for that."""
        self.spark, self.root, self.builders, self._done, self._newest = spark, root, builders, {}, dict(newest or {})
        self.write, self.buckets, self._shares = write, buckets, None

    def bucket_key(self, name: str) -> str | None:
        """The column by which a model is stored in buckets, if it is."""
        key = self.JOIN_KEYS.get(name) if self.buckets else None
        if key is None or not self._writes(name):
            return None
        if self._shares is None:
            attended = self.builders["attended_activity"](self)
            self._shares = bucketed.hottest(attended, *sorted(set(self.JOIN_KEYS.values())))
        return key if bucketed.even(self._shares[key], self.buckets) else None

    def _store(self, name: str, df: DataFrame, path: str) -> DataFrame:
        key = self.bucket_key(name)
        return bucketed.write_bucketed(df, path, key, self.buckets) if key else sinks.materialize(df, path)

    def _writes(self, name: str) -> bool:
        return name in self.write if self.write is not None else name not in self.PROJECTIONS

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._done:
            df, path = self.builders[name](self), f"{self.root}/{name}"
            if name in LANDING and self._writes(name):
                rawtable.replace_table(df, path)
                self._newest[name] = rawtable.newest_load_id(self.spark, path)
                df = rawtable.read_raw_table(self.spark, path)
            self._done[name] = self._store(name, df, path) if self._writes(name) and name not in LANDING else df
        return self._done[name]

    def newest(self, name: str) -> str | None:
        """Id of a raw table's newest load where a ledger tells it."""
        self[name]
        return self._newest.get(name)

    def __contains__(self, name: str) -> bool:
        return name in self.builders

    def lazy(self, name: str) -> DataFrame:
        """The model's plan without writing it (for a final, consumed-once step)."""
        return self.builders[name](self)

    def names(self) -> list[str]:
        return list(self.builders)


class Stopped(Exception):
    """A model is not built: its checks failed, or those of a model it reads."""

    def __init__(self, model: str):
        super().__init__(model)
        self.model = model


class Gated(Materialized):
    """A build in which every model is checked once it is written, before any
    model reads it; the descendants of a model with a failing check are not built.

    ``checked`` holds the results of the checks that ran, ``stopped`` the models that failed (with
    their failing checks) or were left out (with the model they wait for)."""

    def __init__(self, spark: SparkSession, root: str, builders: dict[str, Builder], checks, **kw):
        super().__init__(spark, root, builders, **kw)
        self.checks, self.checked, self.stopped = checks, [], {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._done and name not in self.stopped:
            try:
                super().__getitem__(name)
                mine = [c for c in self.checks if c.model == name]
                rows = quality.run_checks(self, mine).collect() if mine else []  # one row a declared check
                self.checked += rows
                failing = [f"{r.model}.{r.column} {r.test}={r.failures}" for r in rows if r.failures]
                if failing:
                    self.stopped[name] = ", ".join(failing)
            except Stopped as e:
                self.stopped[name] = f"waits for {e.model}"
        if name in self.stopped:
            raise Stopped(name)
        return self._done[name]


def _args(m):
    return m["attended_activity"], m["member"], m["activity"]


def model_builders(spark: SparkSession, cfg: Config, raw_activity: Callable[[], DataFrame],
                   raw_presence: Callable[[], DataFrame] | None) -> dict[str, Builder]:
    """Builders of every model of one family (local or warehouse)."""
    dims = seeds.dims(spark)
    b: dict[str, Builder] = {
        "raw_activity": lambda m: raw_activity(),
        "raw_presence": lambda m: raw_presence(),
        "stg_activity": lambda m: staging.stg_activity(m["raw_activity"], cfg, m.newest("raw_activity")),
        "stg_presence": lambda m: staging.stg_presence(m["raw_presence"], cfg, m.newest("raw_presence")),
        "member": lambda m: members.member(m["stg_presence"], cfg),
        "attended_activity": lambda m: act.attended_activity(m["stg_presence"], cfg),
        "export_all": lambda m: act.export_all(*_args(m)),
    }
    if cfg.is_local:
        b["activity"] = lambda m: act.activity(m["stg_activity"], cfg)
        b["lok"] = lambda m: grants.state_grant(*_args(m), cfg)
        return b
    b.update({
        "activity_type": lambda m: dims["activity_types"],
        "member_type": lambda m: dims["member_types"],
        "result_type": lambda m: dims["result_types"],
        "season": lambda m: seeds.season(spark),
        "calendar": lambda m: default_calendar(spark, cfg.spine_start, cfg.as_of),
        "activity": lambda m: act.activity(m["stg_activity"], cfg, m["stg_presence"], m["member"]),
        "statligt_lok": lambda m: grants.state_grant(*_args(m), cfg),
        "kommunalt_lok": lambda m: grants.municipal_grant(*_args(m), cfg),
        "player_status": lambda m: retention.player_status(*_args(m), cfg),
        "training_participation": lambda m: participation.training_participation(*_args(m), cfg),
    })
    return b


LANDING = frozenset({"raw_activity", "raw_presence"})


def store(spark: SparkSession, cfg: Config, root: str, raw_activity: Callable[[], DataFrame],
          raw_presence: Callable[[], DataFrame] | None, write: frozenset[str] | None = None,
          buckets: int | None = None, **overrides: Builder) -> Materialized:
    b = model_builders(spark, cfg, raw_activity, raw_presence)
    b.update(overrides)
    return Materialized(spark, root, b, write, buckets=buckets)


class _Lazy:
    def __init__(self, builders: dict[str, Builder]):
        self.builders, self.memo = builders, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.memo:
            self.memo[name] = self.builders[name](self)
        return self.memo[name]

    def newest(self, name: str) -> None:
        return None


def build(spark: SparkSession, raw_activity: DataFrame, raw_presence: DataFrame, cfg: Config) -> dict[str, DataFrame]:
    """Lazy plans of every model over the given raw tables (nothing written)."""
    lz = _Lazy(model_builders(spark, cfg, lambda: raw_activity, lambda: raw_presence))
    return {n: lz[n] for n in lz.builders}


def build_all(spark: SparkSession, raw_activity: DataFrame, raw_presence: DataFrame, cfg: Config,
              root: str, newest: dict[str, str] | None = None, buckets: int | None = None) -> dict[str, DataFrame]:
    """Write every model under ``root`` (a shared folder) and return the tables; the raw
    tables stay where they are."""
    b = model_builders(spark, cfg, lambda: raw_activity, lambda: raw_presence)
    m = Materialized(spark, root, b, frozenset(b) - LANDING, newest, buckets)
    return {n: m[n] for n in m.names()}


def build_checked(spark: SparkSession, raw_activity: DataFrame, raw_presence: DataFrame, cfg: Config,
                  root: str, checks, newest: dict[str, str] | None = None, buckets: int | None = None) -> Gated:
    """Write the models whose ancestors pass their checks."""
    b = model_builders(spark, cfg, lambda: raw_activity, lambda: raw_presence)
    m = Gated(spark, root, b, checks, write=frozenset(b) - LANDING, newest=newest, buckets=buckets)
    for n in m.names():
        try:
            m[n]
        except Stopped:
            continue
    return m
