"""One full run: raw loads -> models written and checked -> SQL views -> CSV
export.  (The original project's ``build`` + ``csv_export`` steps.)

    python -m turnout.plans.run --activity PATH --presence PATH --out DIR [--variant local|warehouse]
        [--as-of YYYY-MM-DD] [--now ISO-TIME] [--format json|parquet] [--keep-going] [--buckets N]

Trainings before ``--now`` (default: the current instant) are past.  Every model is
checked when it is written.  The models that read one with a failing check are not built, an
export that was not built is not written, and the command ends with an error.
``--keep-going`` builds everything and only reports.  ``--buckets`` stores member, activity and
attendance by their join keys, so the models that read them do not shuffle them again
(``sources/bucketed.py``).
"""

from __future__ import annotations

import argparse
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..config import Config
from ..operators import quality
from ..sources import newest_load_id, read_raw_activity, read_raw_presence, read_raw_table, register_views, sinks
from . import pipeline


@dataclass
class RunResult:
    models: dict[str, DataFrame]
    checks: DataFrame
    export_path: str


class ChecksFailed(RuntimeError):
    """Failing checks, and the models that were not built for them."""


def run(spark: SparkSession, raw_activity: DataFrame, raw_presence: DataFrame, cfg: Config, out: str,
        fail_on_check: bool = False, newest: dict[str, str] | None = None, buckets: int | None = None) -> RunResult:
    """``newest``: ids of the newest loads, where the raw tables' ledgers tell them; ``buckets``: see
    ``pipeline.Materialized``."""
    sinks.require_non_empty(activity=raw_activity, presence=raw_presence)
    spec = quality.LOCAL_CHECKS if cfg.is_local else quality.WAREHOUSE_CHECKS
    stopped: dict[str, str] = {}
    if fail_on_check:
        built = pipeline.build_checked(spark, raw_activity, raw_presence, cfg, f"{out}/models", spec, newest, buckets)
        stopped = built.stopped
        models = {n: built[n] for n in built.names() if n not in stopped}
        rows = spark.createDataFrame([tuple(r) for r in built.checked], "model string, column string, test string, failures bigint")
        checks = sinks.materialize(rows, f"{out}/checks")
    else:
        models = pipeline.build_all(spark, raw_activity, raw_presence, cfg, f"{out}/models", newest, buckets)
        checks = sinks.materialize(quality.run_checks(models, spec), f"{out}/checks")
    register_views(spark, models)
    export = f"{out}/export_all_csv"
    if "export_all" in models:
        sinks.export_csv(models["export_all"], export)
    if stopped:
        raise ChecksFailed("data checks failed: " + "; ".join(f"{n}: {why}" for n, why in stopped.items()))
    return RunResult(models, checks, export)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--activity", required=True)
    ap.add_argument("--presence", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--variant", default="warehouse", choices=["local", "warehouse"])
    ap.add_argument("--as-of", default=dt.date.today().isoformat())
    ap.add_argument("--now", default=None)
    ap.add_argument("--keep-going", action="store_true")
    ap.add_argument("--buckets", type=int, default=None)
    ap.add_argument("--format", default="json", choices=["json", "parquet"])
    a = ap.parse_args(argv)
    from ..session import get_session
    spark = get_session()
    as_of = dt.date.fromisoformat(a.as_of)
    now = dt.datetime.fromisoformat(a.now) if a.now else dt.datetime.now(dt.timezone.utc)
    now = now if now.tzinfo else now.replace(tzinfo=dt.timezone.utc)
    cfg = Config.local(as_of=as_of, now=now) if a.variant == "local" else Config.warehouse(as_of=as_of, now=now)
    if a.format == "json":
        ra, rp, newest = read_raw_activity(spark, a.activity), read_raw_presence(spark, a.presence), {}
    else:
        ra, rp = read_raw_table(spark, a.activity), read_raw_table(spark, a.presence)
        newest = {"raw_activity": newest_load_id(spark, a.activity), "raw_presence": newest_load_id(spark, a.presence)}
    res = run(spark, ra, rp, cfg, a.out, fail_on_check=not a.keep_going, newest=newest, buckets=a.buckets)
    for r in res.checks.collect():  # one row a declared check
        print(f"{r.model}.{r.column} {r.test}: {r.failures}")


if __name__ == "__main__":
    main()
