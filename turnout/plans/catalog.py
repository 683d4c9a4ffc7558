"""Named queries over the driver tables (one per implemented operator).

Each query takes ``(spark, sf_dir)``, derives club data from the given
tables with the adapters, runs the library, and returns a DataFrame whose
instants are reported as epoch seconds (so a comparison never depends on a
session time zone).  Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Config
from ..operators import activities as act
from ..operators import grants, participation, quality, retention, staging
from ..sources import adapters as ad
from ..operators import pages as pg
from ..sources import seeds, sinks, spines
from ..session import scratch_path
from ..sources.rawtable import SchemaConflict, ledger, read_raw_table
from ..streaming import ingest_loads, rejected_lines
from ..sources.page_adapter import DOMAIN as PAGE_DOMAIN
from ..sources.page_adapter import SLUG as PAGE_SLUG
from ..sources.page_adapter import captured_pages
from . import pipeline
from .extract import extract, ingest, page_kind

EV_BUCKET_HOURS = 1
ENTRY_BUCKET_HOURS = 6
DOMAIN = "www.example-club.se"

EV_WAREHOUSE = Config.warehouse(as_of=ad.EV_AS_OF)
EV_LOCAL = Config.local(as_of=ad.EV_AS_OF)
OR_WAREHOUSE = Config.warehouse(as_of=ad.OR_AS_OF, spine_start=ad.OR_SPINE_START)

INSTANT_COLS = ("start_at", "end_at", "load_timestamp")


def epochs(df: DataFrame) -> DataFrame:
    """Instants -> epoch seconds (bigint), same column names."""
    return df.withColumns({c: F.unix_seconds(F.col(c)) for c in df.columns if c in INSTANT_COLS})


# ------------------------------------------------------------------ inputs

def _events(spark, sf):
    return ad.read_table(spark, sf, "events")


def ev_core(spark, sf, cfg: Config, bucket_hours: int = EV_BUCKET_HOURS) -> pipeline.Materialized:
    """Models over the events adapter; the raw landing tables and each model
    with several consumers are written once to the shared folder when first needed."""
    loads = ("L2",) if cfg.is_local else ("L1", "L2")
    ev = _events(spark, sf)
    return pipeline.store(spark, cfg, scratch_path(spark, f"ev-{cfg.variant}"),
                          lambda: ad.ev_raw_activity(ev, bucket_hours, loads),
                          lambda: ad.ev_raw_presence(ev, bucket_hours, loads))


def or_core(spark, sf, cfg: Config = OR_WAREHOUSE) -> pipeline.Materialized:
    """Models over the orders adapter (flat presence rows, never nested)."""
    orders = ad.read_table(spark, sf, "orders")
    return pipeline.store(spark, cfg, scratch_path(spark, "or"), lambda: ad.or_raw_activity(orders), None,
                          stg_presence=lambda m: staging.stage_persons(ad.or_persons(orders), cfg))


def _args(core):
    return core["attended_activity"], core["member"], core["activity"]


# ------------------------------------------------------------------ queries

def q_stg_activity(cfg):
    def q(spark, sf):
        return ev_core(spark, sf, cfg).lazy("stg_activity")
    return q


def q_stg_presence(cfg):
    def q(spark, sf):
        return ev_core(spark, sf, cfg).lazy("stg_presence")
    return q


def q_latest_load(spark, sf):
    core = ev_core(spark, sf, EV_WAREHOUSE)
    ra = staging.latest_load(core["raw_activity"], core.newest("raw_activity"))
    return epochs(ra.select(F.col("scheduleId").alias("schedule_id"), "place", "load_id",
                                                 "load_timestamp"))


def q_raw_row_count(spark, sf):
    m = ev_core(spark, sf, EV_WAREHOUSE)
    ra, rp = m["raw_activity"], m["raw_presence"]
    return (sinks.row_count(ra).select(F.lit("raw_activity").alias("table_name"), "row_count")
            .unionByName(sinks.row_count(rp).select(F.lit("raw_presence").alias("table_name"), "row_count")))


def q_model(name, cfg, core_fn=ev_core):
    def q(spark, sf):
        return epochs(core_fn(spark, sf, cfg).lazy(name))
    return q


def q_headcounts(spark, sf):
    core = ev_core(spark, sf, EV_WAREHOUSE)
    return act.headcounts(core["stg_presence"], core["member"], EV_WAREHOUSE)


def q_eligible(cfg):
    def q(spark, sf):
        return grants.eligible_activities(*_args(ev_core(spark, sf, cfg)), cfg)
    return q


def q_ordinals(cfg):
    def q(spark, sf):
        return epochs(grants.activity_ordinals(*_args(ev_core(spark, sf, cfg)), cfg))
    return q


def q_state_grant(cfg, bucket_hours=EV_BUCKET_HOURS):
    def q(spark, sf):
        return epochs(grants.state_grant(*_args(ev_core(spark, sf, cfg, bucket_hours)), cfg))
    return q


def q_municipal(spark, sf):
    return grants.municipal_grant(*_args(ev_core(spark, sf, EV_WAREHOUSE)), EV_WAREHOUSE)


def q_export_all(cfg):
    def q(spark, sf):
        return epochs(act.export_all(*_args(ev_core(spark, sf, cfg))))
    return q


def q_daily_counts(spark, sf):
    return retention.daily_activity_counts(*_args(or_core(spark, sf)), OR_WAREHOUSE)


def q_member_day_metrics(spark, sf):
    daily = retention.daily_activity_counts(*_args(or_core(spark, sf)), OR_WAREHOUSE)
    return retention.member_day_metrics(daily, OR_WAREHOUSE).drop("prev_days_since_last_activity")


def q_player_status(spark, sf):
    return retention.player_status(*_args(or_core(spark, sf)), OR_WAREHOUSE)


def q_player_status_ordered(spark, sf):
    """The series written in one order over all files; ``place`` counts a row's
    predecessors in the files (rows before it in its file, and those of the files before)."""
    path = scratch_path(spark, "ordered")
    retention.player_status(*_args(or_core(spark, sf)), OR_WAREHOUSE, ordered=True).write.parquet(path)
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))  # one row a file
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(files), "_file").withColumn("place", F.col("_before") + F.col("_at") + 1).drop("_file", "_at", "_before")


def q_available_trainings(spark, sf):
    return participation.available_trainings(or_core(spark, sf).lazy("activity"), OR_WAREHOUSE)


def q_training_participation(spark, sf):
    return participation.training_participation(*_args(or_core(spark, sf)), OR_WAREHOUSE)


def q_dq_suite(cfg):
    def q(spark, sf):
        if cfg.is_local:
            return quality.run_checks(ev_core(spark, sf, cfg), quality.LOCAL_CHECKS)
        return quality.run_checks(ev_core(spark, sf, cfg), quality.WAREHOUSE_CHECKS)
    return q


# Planted faults: per model the key that picks rows, and the columns that are NULL where key % 7 is their place.
FAULT_KEYS = {"activity": f"activity_id div {ad.TEAM_SPAN}", "member": "member_id", "attended_activity": "member_id",
              "player_status": "member_id + datediff(date_day, DATE'2020-01-01')", "training_participation": "member_id"}
FAULTS = {
    "local": {"activity": {"event_type_label": 0, "start_at": 2, "end_at": 3, "duration_minutes": 4, "activity_id": 5},
              "member": {"first_name": 0, "last_name": 1, "is_player": 2, "is_leader": 3, "member_type_label": 4, "member_id": 5},
              "attended_activity": {"attendance_id": 0, "activity_id": 1, "member_id": 2}},
    "warehouse": {"activity": {"activity": 0, "start_at": 2, "end_at": 3, "duration_minutes": 4, "duration_hours": 5, "activity_id": 6},
                  "member": {"first_name": 0, "last_name": 1, "member_type": 2, "full_name": 3, "member_id": 4},
                  "attended_activity": {"attendance_id": 0, "activity_id": 1, "member_id": 2},
                  "player_status": {"date_day": 0, "status": 1, "member_id": 2}, "training_participation": {"full_name": 0, "member_type": 1, "member_id": 2}}}


def plant_faults(models, variant: str) -> dict[str, DataFrame]:
    """The checked models with every kind of fault: NULLs, values outside the
    accepted ones, an unknown season, rows that come twice."""
    out = {}
    for name, columns in FAULTS[variant].items():
        df, key = models[name], F.expr(FAULT_KEYS[name])
        place = F.pmod(key, F.lit(7))
        new = {c: F.when(place != i, F.col(c)) for c, i in columns.items()}
        if name == "player_status":
            new["status"] = F.when(place == 3, F.lit("Lost")).otherwise(new["status"])
            new["status_event"] = F.when(place == 4, F.lit("Odd")).otherwise(F.col("status_event"))
        if name == "activity":
            label, given = ("result_label", "result_id") if variant == "local" else ("result", "result_type_id")
            new[label] = F.when(F.col(given) != 2, F.col(label))
            if variant == "warehouse":
                new["season_id"] = F.when(place == 5, F.lit(-1).cast("bigint")).otherwise(F.col("season_id"))
        copies = F.explode(F.when(F.pmod(key, F.lit(5)) == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
        rows = df.select("*", copies.alias("_copy")).drop("_copy")
        out[name] = rows.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])
    return out


def q_dq_faults(cfg):
    def q(spark, sf):
        models = plant_faults(ev_core(spark, sf, cfg), cfg.variant)
        if cfg.is_local:
            return quality.run_checks(models, quality.LOCAL_CHECKS)
        return quality.run_checks({**models, "season": seeds.season(spark)}, quality.WAREHOUSE_CHECKS)
    return q


def captured(spark, sf) -> DataFrame:
    """The captured pages as a table, as a crawl leaves them."""
    return sinks.materialize(captured_pages(_events(spark, sf)), scratch_path(spark, "pages"))


def q_captured_requests(spark, sf):
    """Links of the calendar pages -> ids and request URLs of one team."""
    return extract_pages(spark, sf).requests.select("page_id", F.col("pos").cast("bigint").alias("pos"), "href", "activity_id", "is_match", "presence_url", "activity_url")


def extract_pages(spark, sf, keep=None):
    return extract(captured(spark, sf), PAGE_DOMAIN, PAGE_SLUG, "L2", ad.L2_TIMESTAMP, keep=keep)


def q_captured_links(spark, sf):
    calendar = page_kind() == "calendar"
    pages = pg.accepted_pages(captured(spark, sf), calendar).where(calendar)
    return pg.team_link_counts(pg.extract_links(pages), PAGE_SLUG)


def q_captured_presence(spark, sf):
    """The people of the presence pages; the pages are parsed once, into a scratch folder that both unnests read."""
    ex = extract_pages(spark, sf, keep=lambda name, df: sinks.materialize(df, scratch_path(spark, f"parsed-{name}")))
    return epochs(staging.stg_presence(ex.raw_presence, EV_WAREHOUSE))


def q_captured_activity(spark, sf):
    """The activities of the edit pages; the one load's id is given, so that the pages are not parsed to find it."""
    return epochs(staging.stg_activity(extract_pages(spark, sf).raw_activity, EV_WAREHOUSE, "L2"))


def q_captured_rejects(spark, sf):
    return extract_pages(spark, sf).rejects.select("page_id", "reason")


def q_captured_evidence(spark, sf):
    e = pg.page_evidence(captured(spark, sf))
    return e.select("page_id", "title", "canonical", "has_logout", "login_form_count", F.size("forms").cast("bigint").alias("n_forms"),
                    F.get("forms", 0)["action"].alias("action"), F.get("forms", 0)["method"].alias("method"),
                    F.array_join(F.get("forms", 0)["input_names"], ",").alias("input_names"))


def q_captured_scripts(spark, sf):
    s = pg.presence_scan(captured(spark, sf).where(page_kind() == "presence"))
    return s.select("page_id", "n_head_scripts", F.col("script_index").cast("bigint").alias("script_index"))


def q_page_ingest(spark, sf):
    """Pages -> raw tables (a replaced load, then an appended one) -> staging."""
    out = scratch_path(spark, "ingest")
    pages = captured(spark, sf)
    ingest(pages, PAGE_DOMAIN, PAGE_SLUG, out, append=False, load_id="L1", load_timestamp=ad.L1_TIMESTAMP)
    ingest(pages, PAGE_DOMAIN, PAGE_SLUG, out, load_id="L2", load_timestamp=ad.L2_TIMESTAMP)
    return staging.stg_activity(read_raw_table(spark, f"{out}/raw_activity"), EV_WAREHOUSE)


def q_presence_roundtrip(spark, sf):
    from ..sources.raw import read_raw_presence
    path = scratch_path(spark, "ndjson-presence")
    sinks.write_ndjson(ad.ev_raw_presence(_events(spark, sf), EV_BUCKET_HOURS, ("L2",)), path)
    return staging.stg_presence(read_raw_presence(spark, path), EV_WAREHOUSE)


def q_load_new_field(spark, sf):
    """An older load, then one with a new field, both through the landing path."""
    root, ev = scratch_path(spark, "evolve"), _events(spark, sf)
    for load, more in (("L1", []), ("L2", [(F.col("scheduleId") * 2).alias("newField")])):
        raw = ad.ev_raw_activity(ev, EV_BUCKET_HOURS, (load,))
        sinks.write_ndjson(raw.select("*", *more), f"{root}/landing/{load}")
        table = ingest_loads(spark, "activity", f"{root}/landing/*", f"{root}/raw_activity", f"{root}/_checkpoint")
    return table.select(F.col("scheduleId").alias("schedule_id"), "load_id", F.col("newField").alias("new_field"))


def q_load_conflict(spark, sf):
    """A load whose ``place`` is a number is refused; the table is what it was."""
    ev, path = _events(spark, sf), scratch_path(spark, "conflict")
    sinks.append_load(ad.ev_raw_activity(ev, EV_BUCKET_HOURS, ("L1",)), path)
    try:
        sinks.append_load(ad.ev_raw_activity(ev, EV_BUCKET_HOURS, ("L2",)).withColumn("place", F.col("scheduleId")), path)
    except SchemaConflict:
        refused = 1
    else:
        refused = 0
    return read_raw_table(spark, path).select(F.col("scheduleId").alias("schedule_id"), "place", "load_id", F.lit(refused).cast("bigint").alias("refused"))


def q_load_nested_field(spark, sf):
    """Landed loads, the second with a new field of every participant and a new
    list beside them: both arrive, the first load shows NULL."""
    root, ev = scratch_path(spark, "nested"), _events(spark, sf)
    for load, new in (("L1", False), ("L2", True)):
        raw = ad.ev_raw_presence(ev, EV_BUCKET_HOURS, (load,))
        if new:
            def more(g):
                people = F.transform(g["participants"], lambda p: p.withField("shirt", p["userId"] % 100))
                return g.withField("participants", people).withField("coaches", F.transform(g["leaders"], lambda p: p["userId"]))
            raw = raw.withColumn("teamPresenceGroups", F.transform("teamPresenceGroups", more))
        sinks.write_ndjson(raw, f"{root}/landing/{load}")
        table = ingest_loads(spark, "presence", f"{root}/landing/*", f"{root}/raw_presence", f"{root}/_checkpoint")
    g = F.get("teamPresenceGroups", 0)
    return table.select(F.col("scheduleId").alias("schedule_id"), "load_id", F.size(g["participants"]).cast("bigint").alias("participants"),
                        F.when(g["coaches"].isNotNull(), F.size(g["coaches"])).cast("bigint").alias("coaches"),
                        F.aggregate(F.transform(g["participants"], lambda p: p["shirt"]), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("shirts"))


def q_load_quarantine(spark, sf):
    """A landed load with lines that are no records: these are set aside, the others arrive."""
    root, ev = scratch_path(spark, "bad-lines"), _events(spark, sf)
    raw = ad.ev_raw_activity(ev, EV_BUCKET_HOURS, ("L2",))
    bucket = F.expr(f"scheduleId div {ad.TEAM_SPAN}")
    line = F.to_json(F.struct(*raw.columns))
    line = F.when(bucket % 5 == 0, F.concat(F.lit("oops "), line)).when(bucket % 7 == 0, F.regexp_replace(line, '"scheduleId":', '"scheduleId":"x","was":')).otherwise(line)
    raw.select(line.alias("value")).write.text(f"{root}/landing/L2")
    table = ingest_loads(spark, "activity", f"{root}/landing/*", f"{root}/raw_activity", f"{root}/_checkpoint", quarantine=f"{root}/rejected")
    lines = rejected_lines(spark, f"{root}/rejected")
    return (table.select(F.col("scheduleId").alias("schedule_id"), F.lit("read").alias("outcome"))
            .unionByName(lines.select(F.regexp_extract("line", r'"(?:was|scheduleId)":(\d+)', 1).cast("bigint").alias("schedule_id"), F.lit("set aside").alias("outcome"))))


def q_load_ledger(spark, sf):
    """Loads of a raw table with their rows, from its ledger."""
    ev, path = _events(spark, sf), scratch_path(spark, "ledger")
    for load in ("L1", "L2"):
        sinks.append_load(ad.ev_raw_activity(ev, EV_BUCKET_HOURS, (load,)), path)
    return epochs(ledger(spark, path))


# Models of a whole build whose rows the report adds up, with the column that it sums.
BUILT = {"member": "member_id", "attended_activity": "member_id", "activity": "activity_id", "statligt_lok": "lok_amount_players",
         "kommunalt_lok": "contribution_municipality", "export_all": "duration_minutes"}


def q_build_report(spark, sf):
    """The whole warehouse build with member, activity and attendance in buckets of their join
    keys: rows of each model and the sum of one column."""
    raw = ev_core(spark, sf, EV_WAREHOUSE)
    newest = {n: raw.newest(n) for n in sorted(pipeline.LANDING)}
    models = pipeline.build_all(spark, raw["raw_activity"], raw["raw_presence"], EV_WAREHOUSE, scratch_path(spark, "build"), newest,
                                buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    parts = [models[n].agg(F.count(F.lit(1)).alias("row_count"), F.sum(F.col(c).cast("decimal(38,2)")).cast("double").alias("total"))
             .select(F.lit(n).alias("model"), "row_count", "total") for n, c in BUILT.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_dq_not_null(spark, sf):
    a = ev_core(spark, sf, EV_WAREHOUSE).lazy("activity")
    return quality.not_null(a, "activity").select("activity_id", "activity_type_id")


def q_dq_not_null_where(spark, sf):
    a = ev_core(spark, sf, EV_WAREHOUSE).lazy("activity")
    return quality.not_null(a, "result", where="result_type_id IS NOT NULL").select("activity_id", "result_type_id")


def q_dq_unique(spark, sf):
    return quality.unique(ev_core(spark, sf, EV_WAREHOUSE).lazy("member"), "full_name")


def q_dq_unique_shared(spark, sf):
    """The same check on a column that repeats."""
    return quality.unique(ev_core(spark, sf, EV_WAREHOUSE).lazy("attended_activity"), "member_id")


def q_dq_accepted_values(spark, sf):
    return quality.accepted_values(ev_core(spark, sf, EV_WAREHOUSE).lazy("activity"), "activity",
                                   ["Training", "Match", "Cup"])


def q_dq_unique_combination(spark, sf):
    st = ev_core(spark, sf, EV_WAREHOUSE).lazy("stg_presence")
    return quality.unique_combination(st.select("team_name", "member_type_id"), ["team_name", "member_type_id"])


def q_dq_relationships(spark, sf):
    """Attendances of activities that are not eligible for the grant."""
    core = ev_core(spark, sf, EV_WAREHOUSE)
    return quality.relationships(core["attended_activity"], "activity_id", grants.eligible_activities(*_args(core), EV_WAREHOUSE), "activity_id")


def q_month_urls(spark, sf):
    st = ev_core(spark, sf, EV_WAREHOUSE).lazy("stg_activity")
    starts = (st.groupBy(F.concat(F.lit("team-"), F.col("team_id").cast("string")).alias("team_slug"))
                .agg(F.min(F.col("schedule_date").cast("date")).alias("start_date")))
    return spines.month_urls(starts, EV_WAREHOUSE.as_of, DOMAIN)


def q_json_roundtrip(spark, sf):
    ra = ad.ev_raw_activity(_events(spark, sf), EV_BUCKET_HOURS)
    path = scratch_path(spark, "ndjson")
    sinks.write_ndjson(ra, f"{path}/activity")
    from ..sources.raw import read_raw_activity
    return staging.stg_activity(read_raw_activity(spark, f"{path}/activity"), EV_WAREHOUSE)


def q_load_append(spark, sf):
    ev = _events(spark, sf)
    path = scratch_path(spark, "raw_presence")
    sinks.replace_table(ad.ev_raw_presence(ev, EV_BUCKET_HOURS, ("L1",)), path)
    sinks.append_load(ad.ev_raw_presence(ev, EV_BUCKET_HOURS, ("L2",)), path)
    return staging.stg_presence(read_raw_table(spark, path), EV_WAREHOUSE)


def q_load_stream(spark, sf):
    """Two load batches landed as NDJSON one after the other, each ingested by
    an availableNow streaming run into one raw table; staging keeps the newest."""
    ev = _events(spark, sf)
    root = scratch_path(spark, "stream")
    for load in ("L1", "L2"):
        sinks.write_ndjson(ad.ev_raw_activity(ev, EV_BUCKET_HOURS, (load,)), f"{root}/landing/{load}")
        raw = ingest_loads(spark, "activity", f"{root}/landing/*", f"{root}/raw_activity", f"{root}/_checkpoint")
    return staging.stg_activity(raw, EV_WAREHOUSE)


def q_csv_export(cfg):
    def q(spark, sf):
        wide = epochs(act.export_all(*_args(ev_core(spark, sf, cfg))))
        path = scratch_path(spark, "export_csv")
        sinks.export_csv(wide, path)
        return spark.read.schema(wide.schema).option("header", True).option("escape", '"').csv(path)
    return q


def q_extract_rejects(spark, sf):
    """The page-extraction job over the captured pages: pages failing the
    guards (and unparsable payload pages) with the reason."""
    pages = ad.read_table(spark, sf, "pages")
    return extract(pages, DOMAIN, "en", "L0", ad.L2_TIMESTAMP).rejects


def q_pages(fn):
    def q(spark, sf):
        return fn(ad.read_table(spark, sf, "pages"))
    return q


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "stg_activity_warehouse": q_stg_activity(EV_WAREHOUSE),
        "stg_activity_local": q_stg_activity(EV_LOCAL),
        "stg_presence_warehouse": q_stg_presence(EV_WAREHOUSE),
        "stg_presence_local": q_stg_presence(EV_LOCAL),
        "latest_load": q_latest_load,
        "raw_row_count": q_raw_row_count,
        "member_warehouse": q_model("member", EV_WAREHOUSE),
        "member_local": q_model("member", EV_LOCAL),
        "activity_warehouse": q_model("activity", EV_WAREHOUSE),
        "activity_local": q_model("activity", EV_LOCAL),
        "attended_activity_warehouse": q_model("attended_activity", EV_WAREHOUSE),
        "attended_activity_local": q_model("attended_activity", EV_LOCAL),
        "headcounts": q_headcounts,
        "eligible_activities": q_eligible(EV_WAREHOUSE),
        "eligible_activities_local": q_eligible(EV_LOCAL),
        "activity_ordinals": q_ordinals(EV_LOCAL),
        "activity_ordinals_warehouse": q_ordinals(EV_WAREHOUSE),
        "lok": q_state_grant(EV_LOCAL),
        "statligt_lok": q_state_grant(EV_WAREHOUSE),
        "kommunalt_lok": q_municipal,
        "export_all": q_export_all(EV_WAREHOUSE),
        "export_all_local": q_export_all(EV_LOCAL),
        "daily_activity_counts": q_daily_counts,
        "last_activity_running": q_member_day_metrics,
        "player_status": q_player_status,
        "player_status_ordered": q_player_status_ordered,
        "available_trainings": q_available_trainings,
        "training_participation": q_training_participation,
        "build_report": q_build_report,
        "dq_suite_warehouse": q_dq_suite(EV_WAREHOUSE),
        "dq_suite_local": q_dq_suite(EV_LOCAL),
        "dq_faults_warehouse": q_dq_faults(EV_WAREHOUSE),
        "dq_faults_local": q_dq_faults(EV_LOCAL),
        "dq_not_null": q_dq_not_null,
        "dq_not_null_where": q_dq_not_null_where,
        "dq_unique": q_dq_unique,
        "dq_unique_shared": q_dq_unique_shared,
        "dq_accepted_values": q_dq_accepted_values,
        "dq_unique_combination": q_dq_unique_combination,
        "dq_relationships": q_dq_relationships,
        "month_urls": q_month_urls,
        "json_roundtrip": q_json_roundtrip,
        "load_append": q_load_append,
        "load_stream": q_load_stream,
        "csv_export_roundtrip": q_csv_export(EV_LOCAL),
        "csv_export_warehouse": q_csv_export(EV_WAREHOUSE),
        "page_links": q_pages(pg.page_links_report),
        "team_links": q_pages(pg.team_link_counts_report),
        "page_digest": q_pages(pg.page_digest),
        "page_evidence": q_pages(pg.page_evidence_report),
        "page_auth": q_pages(pg.page_auth),
        "presence_scan": q_pages(pg.presence_scan_report),
        "extract_rejects": q_extract_rejects,
        "captured_links": q_captured_links,
        "captured_requests": q_captured_requests,
        "captured_presence": q_captured_presence,
        "captured_activity": q_captured_activity,
        "captured_rejects": q_captured_rejects,
        "captured_evidence": q_captured_evidence,
        "captured_scripts": q_captured_scripts,
        "page_ingest": q_page_ingest,
        "presence_roundtrip": q_presence_roundtrip,
        "load_new_field": q_load_new_field,
        "load_conflict": q_load_conflict,
        "load_nested_field": q_load_nested_field,
        "load_quarantine": q_load_quarantine,
        "load_ledger": q_load_ledger,
    }


def entry_query(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: the state grant (local family) with 6-hour activities."""
    return q_state_grant(EV_LOCAL, ENTRY_BUCKET_HOURS)(spark, sf)
