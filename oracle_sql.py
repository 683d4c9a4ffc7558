"""Independent DuckDB formulations of every registered query of the club models.

The driver registers the parquet tables as views (events, orders, pages, ...)
and runs these strings next to the Spark queries.  They are written from the
rules (amount tables, eligibility counts, gaps between activity days), share no
code, list or constant with the engine, and use other algorithms where there is
a choice: the retention series finds each day's last activity with an as-of
join, amounts come from range joins with small tables, head counts from one
count per kind.  Instants are compared as epoch seconds; zone arithmetic uses
DuckDB's ICU time zones.
"""

from __future__ import annotations

import datetime as dt

# The adapters' cycles, lookup labels, seasons and month names.
EVENT_TYPE_CYCLE = [1, 2, 3, 4, 5, 6, 7, 9, 10]
DURATION_CYCLE = [60, 45, 30, 60]
ACTIVITY_TYPES = {1: "Training", 2: "Meeting", 4: "Other", 5: "Competition", 6: "Cup", 7: "Match", 9: "Work Shift", 10: "Camp"}
RESULT_TYPES = {1: "Loss", 2: "Draw", 3: "Win"}
MEMBER_TYPES = {1: "Player", 2: "Leader", 4: "Parent"}
SEASONS = [(263345, 2022), (351193, 2025), (323509, 2024), (342818, 2025), (351194, 2025), (291851, 2023), (323511, 2024), (315585, 2024), (376226, 2026), (384395, 2026), (384400, 2026), (392979, 2026)]  # (season id, year)
SWEDISH_MONTHS = ["januari", "februari", "mars", "april", "maj", "juni", "juli", "augusti", "september", "oktober", "november", "december"]
# State amounts as (from age, to age, from ordinal of the week, to ordinal, amount);
# municipal amounts as (from age, to age, amount).
STATE_AMOUNTS = [(7, 25, 1, 2, 7.5), (7, 25, 3, 3, 5.0), (10, 25, 4, 5, 2.5)]
MUNICIPAL_AMOUNTS = [(7, 12, 8.5), (13, 20, 11.0)]

ZONE = "Europe/Stockholm"
EV_AS_OF = dt.date(2024, 2, 1)
EV_SPINE = dt.date(2019, 1, 1)
OR_AS_OF = dt.date(2001, 8, 2)
OR_SPINE = dt.date(1995, 7, 1)
DOMAIN = "www.example-club.se"
SLUG = "en"


def _d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def _list(vals) -> str:
    return "[" + ", ".join("NULL" if v is None else str(v) for v in vals) + "]"


def _hhmm(sec: str) -> str:
    return (f"lpad(CAST((({sec}) % 86400) // 3600 AS VARCHAR), 2, '0') || ':' || "
            f"lpad(CAST((({sec}) % 3600) // 60 AS VARCHAR), 2, '0')")


def _instant(date_txt: str, time_txt: str) -> str:
    return f"CAST({date_txt} || ' ' || {time_txt} || ':00 {ZONE}' AS TIMESTAMPTZ)"


def _day(ts: str, zone: str = ZONE) -> str:
    return f"CAST(timezone('{zone}', {ts}) AS DATE)"


def _labels(column: str, names: dict[int, str]) -> str:
    """A label looked up in a map literal."""
    return f"MAP {{{', '.join(f'{k}: {chr(39)}{v}{chr(39)}' for k, v in names.items())}}}[{column}]"


def _values(rows: list[tuple]) -> str:
    return ", ".join(f"({', '.join(map(str, r))})" for r in rows)


def _ep(ts: str) -> str:
    return f"CAST(epoch({ts}) AS BIGINT)"


def _tag(uid: str) -> str:
    return f"COALESCE(left(to_base64(unhex(md5(CAST({uid} AS VARCHAR)))), 6), 'null')"


# ------------------------------------------------------------------ EV adapter + models

def ev_ctes(variant: str, bucket_hours: int = 1) -> str:
    local = variant == "local"
    span = 3600 * bucket_hours
    pres_flags = ("member_type_id = 2 AS is_leader, member_type_id = 1 AS is_player, " if local else "")
    type_col = "event_type_id" if local else "activity_type_id"
    res_col = "result_id" if local else "result_type_id"
    extra_stg = "" if local else f""",
    CAST(({_list([i for i, _ in SEASONS] + [None])})[CAST(bucket % 13 AS INTEGER) + 1] AS BIGINT) AS season_id,
    'Activity ' || CAST(schedule_id AS VARCHAR) AS schedule_text,
    schedule_info,
    CAST(NULLIF(regexp_extract(schedule_info, '\\[matcher=([^\\]]+)\\]', 1), '') AS BIGINT) AS cup_nr_of_games"""
    ctes = f"""
ev_att AS (
  SELECT DISTINCT epoch_us(ts) // {span * 1_000_000} AS bucket, user_id // 50 AS team, user_id
  FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL
),
ev_sched AS (SELECT bucket, team, user_id, bucket * 4294967296 + team AS schedule_id FROM ev_att),
ev_person AS (
  SELECT schedule_id, bucket, team, user_id,
    CAST(CASE WHEN user_id % 10 = 0 THEN 2 WHEN user_id % 10 = 1 THEN 4
              WHEN user_id % 10 = 9 AND bucket % 2 = 1 THEN 4 ELSE 1 END AS BIGINT) AS member_type_id
  FROM ev_sched
),
stg_presence AS (
  SELECT CAST(1000000 + user_id AS BIGINT) AS id, schedule_id,
    CASE WHEN user_id % 13 = 0 THEN '' ELSE 'F' || CAST(user_id AS VARCHAR) END AS first_name,
    CASE WHEN user_id % 17 = 0 THEN NULL ELSE 'L' || CAST(user_id AS VARCHAR) END AS last_name,
    user_id,
    'Team ' || CAST(team AS VARCHAR) AS team_name,
    CASE WHEN user_id % 19 = 0 THEN '2023-12-31' END AS inactivated_at,
    CAST(user_id % 5 AS BIGINT) AS stats_star,
    make_date(2024 - (5 + user_id % 24), 1 + user_id % 12, 1 + user_id % 28) AS date_of_birth,
    {pres_flags}member_type_id
  FROM ev_person
),
ev_act AS (
  SELECT bucket, team, schedule_id, bucket * {span} AS start_sec,
    ({_list(EVENT_TYPE_CYCLE)})[CAST(bucket % 9 AS INTEGER) + 1] AS etype,
    ({_list(DURATION_CYCLE)})[CAST(bucket % 4 AS INTEGER) + 1] AS dur
  FROM (SELECT DISTINCT bucket, team, schedule_id FROM ev_sched)
),
ev_act2 AS (
  SELECT *, CASE WHEN etype = 6 THEN 'info [matcher=' || CAST(bucket % 5 AS VARCHAR) || ']' ELSE 'info' END AS schedule_info
  FROM ev_act
),
stg_activity AS (
  SELECT team AS team_id, schedule_id, 'coach' || CAST(team AS VARCHAR) AS username,
    CAST(DATE '1970-01-01' + CAST(start_sec // 86400 AS INTEGER) AS VARCHAR) AS schedule_date,
    {_hhmm('start_sec')} AS start_time,
    CASE WHEN (start_sec % 86400) // 3600 = 23 THEN '00:00' ELSE {_hhmm('start_sec + dur * 60')} END AS end_time,
    CAST(etype AS BIGINT) AS {type_col},
    'Hall ' || CAST(team % 3 AS VARCHAR) AS place,
    bucket % 2 = 0 AS is_home_facility,
    CASE WHEN etype = 7 THEN CAST(5000 + bucket % 11 AS BIGINT) END AS opponent_club_id,
    CASE WHEN etype = 7 THEN 'Opponent ' || CAST(bucket % 11 AS VARCHAR) END AS opponent,
    CASE WHEN etype = 7 THEN CAST(1 + bucket % 4 AS BIGINT) END AS {res_col},
    CASE WHEN etype = 7 THEN CAST(bucket % 5 AS BIGINT) END AS goals_for,
    CASE WHEN etype = 7 THEN CAST(bucket % 3 AS BIGINT) END AS goals_against{extra_stg}
  FROM ev_act2
)"""
    return ctes + "," + model_ctes(variant)


def model_ctes(variant: str) -> str:
    """member, attended, activity (+ headcounts) over stg_presence / stg_activity."""
    local = variant == "local"
    prof = """
prof AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
      ORDER BY schedule_id DESC NULLS LAST, member_type_id ASC NULLS LAST, id ASC NULLS LAST) AS rn
    FROM stg_presence) WHERE rn = 1
),"""
    if local:
        member = f"""
member AS (
  SELECT user_id AS member_id,
    COALESCE(NULLIF(first_name, ''), '<DELETED>') AS first_name,
    COALESCE(NULLIF(last_name, ''), '<DELETED>') AS last_name,
    team_name, inactivated_at, date_of_birth, is_leader, is_player, member_type_id,
    {_labels('member_type_id', MEMBER_TYPES)} AS member_type_label
  FROM prof
),
attended AS (
  SELECT md5(COALESCE(CAST(schedule_id AS VARCHAR), '') || COALESCE(CAST(user_id AS VARCHAR), '')) AS attendance_id,
    schedule_id AS activity_id, user_id AS member_id
  FROM stg_presence
),"""
        activity = f"""
act0 AS (
  SELECT schedule_id AS activity_id, event_type_id,
    {_labels('event_type_id', ACTIVITY_TYPES)} AS event_type_label,
    {_instant('schedule_date', 'start_time')} AS start_at,
    place, is_home_facility, opponent_club_id, opponent, result_id,
    {_labels('result_id', RESULT_TYPES)} AS result_label,
    goals_for, goals_against,
    CASE WHEN end_time = '00:00'
         THEN CAST(CAST(CAST(schedule_date AS DATE) + 1 AS VARCHAR) || ' 00:00:00 {ZONE}' AS TIMESTAMPTZ)
         ELSE {_instant('schedule_date', 'end_time')} END AS end_at
  FROM stg_activity
),
activity AS (
  SELECT *, CAST((epoch(end_at) - epoch(start_at)) // 60 AS BIGINT) AS duration_minutes FROM act0
)"""
        return prof + member + activity
    member = f"""
member AS (
  SELECT user_id AS member_id, team_name, inactivated_at, date_of_birth,
    COALESCE(year(date_of_birth) = 2014, FALSE) AS is_f2014,
    member_type_id,
    {_labels('member_type_id', MEMBER_TYPES)} AS member_type,
    COALESCE(NULLIF(first_name, ''), 'FN-' || {_tag('user_id')}) AS first_name,
    COALESCE(NULLIF(last_name, ''), 'EN-' || {_tag('user_id')}) AS last_name,
    COALESCE(NULLIF(first_name, ''), 'FN-' || {_tag('user_id')}) || ' ' ||
      COALESCE(NULLIF(last_name, ''), 'EN-' || {_tag('user_id')}) AS full_name
  FROM prof
),
attended AS (
  SELECT '"' || to_base64(unhex(md5(COALESCE(CAST(schedule_id AS VARCHAR), '') || COALESCE(CAST(user_id AS VARCHAR), '')))) || '"' AS attendance_id,
    schedule_id AS activity_id, user_id AS member_id
  FROM stg_presence
),
kinds AS (
  SELECT activity_id, member_type, COUNT(*) AS n FROM attended LEFT JOIN member USING (member_id) GROUP BY ALL
),
headcounts AS (
  SELECT activity_id, COALESCE(p.n, 0) AS players_attended, COALESCE(l.n, 0) AS leader_attended, COALESCE(r.n, 0) AS parents_attended
  FROM (SELECT DISTINCT activity_id FROM attended)
    LEFT JOIN (FROM kinds WHERE member_type = 'Player') p USING (activity_id)
    LEFT JOIN (FROM kinds WHERE member_type = 'Leader') l USING (activity_id)
    LEFT JOIN (FROM kinds WHERE member_type = 'Parent') r USING (activity_id)
),"""
    activity = f"""
act0 AS (
  SELECT schedule_id AS activity_id, activity_type_id,
    {_labels('activity_type_id', ACTIVITY_TYPES)} AS activity,
    {_instant('schedule_date', 'start_time')} AS start_at,
    place, is_home_facility, opponent_club_id, opponent, result_type_id,
    {_labels('result_type_id', RESULT_TYPES)} AS result,
    goals_for, goals_against, season_id, cup_nr_of_games,
    {_instant('schedule_date', 'end_time')} + CASE end_time WHEN '00:00' THEN INTERVAL 24 HOURS ELSE INTERVAL 0 HOURS END AS end_at
  FROM stg_activity
),
act1 AS (
  SELECT *, CAST((epoch(end_at) - epoch(start_at)) // 60 AS BIGINT) AS duration_minutes FROM act0
),
activity AS (
  SELECT act1.*, duration_minutes / 60 AS duration_hours,
    h.players_attended, h.leader_attended, h.parents_attended
  FROM act1 LEFT JOIN headcounts h USING (activity_id)
)"""
    return prof + member + activity


# ------------------------------------------------------------------ OR adapter + models

def or_ctes() -> str:
    first = f"CASE WHEN o_custkey % 13 = 0 THEN 'FN-' || {_tag('o_custkey')} ELSE 'F' || CAST(o_custkey AS VARCHAR) END"
    last = f"CASE WHEN o_custkey % 17 = 0 THEN 'EN-' || {_tag('o_custkey')} ELSE 'L' || CAST(o_custkey AS VARCHAR) END"
    return f"""
or_days AS (
  SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS BIGINT) AS d, o_custkey
  FROM orders WHERE o_orderdate IS NOT NULL AND o_custkey IS NOT NULL
),
activity AS (
  SELECT d AS activity_id, CAST(CASE WHEN d % 3 = 0 THEN 1 ELSE 7 END AS BIGINT) AS activity_type_id,
    CAST(CAST(DATE '1970-01-01' + CAST(d AS INTEGER) AS VARCHAR) || ' 18:00:00 {ZONE}' AS TIMESTAMPTZ) AS start_at
  FROM (SELECT DISTINCT d FROM or_days)
),
member AS (
  SELECT DISTINCT o_custkey AS member_id,
    CASE o_custkey % 10 WHEN 0 THEN 'Leader' WHEN 1 THEN 'Parent' ELSE 'Player' END AS member_type,
    o_custkey % 10 = 4 AS is_f2014,
    {first} || ' ' || {last} AS full_name
  FROM or_days
),
attended AS (SELECT d AS activity_id, o_custkey AS member_id FROM or_days)"""


# ------------------------------------------------------------------ model-level queries

def _rules(variant: str) -> tuple[str, str, str]:
    """(member type column, day zone, age at an activity of day ``day``)."""
    if variant == "local":
        return "member_type_label", ZONE, "year(day) - year(date_of_birth)"
    return "member_type", "UTC", f"{EV_AS_OF.year} - year(date_of_birth)"


def eligible_sql(variant: str) -> str:
    """Activities with at least three players of 7 to 25 and one leader: one
    count per kind, joined."""
    kind, zone, age = _rules(variant)
    return f"""
who AS (
  SELECT activity_id, member_id, {kind} AS kind, start_at, end_at, date_of_birth, {_day('start_at', zone)} AS day
  FROM attended LEFT JOIN activity USING (activity_id) LEFT JOIN member USING (member_id)
),
aged AS (SELECT *, CAST({age} AS BIGINT) AS age FROM who),
n_players AS (SELECT activity_id, COUNT(*) AS players_attended FROM aged WHERE kind = 'Player' AND age >= 7 AND age <= 25 GROUP BY activity_id),
n_leaders AS (SELECT activity_id, COUNT(*) AS leaders_attended FROM aged WHERE kind = 'Leader' GROUP BY activity_id),
eligible AS (
  SELECT activity_id, players_attended, leaders_attended FROM n_players JOIN n_leaders USING (activity_id) WHERE players_attended > 2
)"""


def ordinals_sql(variant: str) -> str:
    """Places in start order: the attendances of the same member that week which
    do not start later, counted by a join, and those of them on the same day."""
    week = "date_trunc('week', day)" if variant == "local" else "date_trunc('week', day + 1) - INTERVAL 1 DAY"
    return eligible_sql(variant) + f""",
held AS (
  SELECT aged.*, leaders_attended, CAST({week} AS DATE) AS week, COALESCE(epoch_us(start_at), 9223372036854775807) AS moment
  FROM aged JOIN eligible USING (activity_id)
),
ordinals AS (
  SELECT h.activity_id, h.member_id, h.kind AS member_type, h.start_at, h.end_at, h.week, h.age AS member_age,
    COUNT(*) FILTER (e.day IS NOT DISTINCT FROM h.day) AS acc_daily_activities, COUNT(*) AS acc_weekly_activities, h.leaders_attended
  FROM held h JOIN held e ON e.member_id IS NOT DISTINCT FROM h.member_id AND e.week IS NOT DISTINCT FROM h.week
    AND (e.moment < h.moment OR e.moment = h.moment AND e.activity_id <= h.activity_id)
  GROUP BY ALL
)"""


def lok_sql(variant: str) -> str:
    """Amounts by a range join of the first attendance of each day."""
    return "WITH " + ev_ctes(variant) + "," + ordinals_sql(variant) + f""",
rate(age_from, age_to, nth_from, nth_to, amount) AS (VALUES {_values(STATE_AMOUNTS)}),
paid AS (
  SELECT activity_id, SUM(amount) AS amount FROM ordinals JOIN rate
    ON acc_daily_activities = 1 AND member_age BETWEEN age_from AND age_to AND acc_weekly_activities BETWEEN nth_from AND nth_to
  GROUP BY activity_id
)
SELECT activity_id, {_ep('start_at')} AS start_at, CAST(COALESCE(amount, 0) AS DOUBLE) AS lok_amount_players,
  CAST(least(leaders_attended, 2) * 5 + 15 AS BIGINT) AS lok_amount_leaders
FROM eligible JOIN activity USING (activity_id) LEFT JOIN paid USING (activity_id)"""


def municipal_sql() -> str:
    """The best amount a member earns that day in small and in large activities."""
    return "WITH " + ev_ctes("warehouse") + f""",
rate(age_from, age_to, amount) AS (VALUES {_values(MUNICIPAL_AMOUNTS)}),
went AS (
  SELECT {_day('start_at', 'UTC')} AS date_day, member_id, 1 + CAST(COALESCE(players_attended, 0) >= 16 AS BIGINT) AS multiplier,
    duration_minutes, players_attended, date_of_birth
  FROM attended LEFT JOIN activity USING (activity_id) LEFT JOIN member USING (member_id)
),
earned AS (
  SELECT date_day, member_id, multiplier, MAX(amount) AS amount FROM went JOIN rate
    ON year(date_day) - year(date_of_birth) BETWEEN age_from AND age_to
  WHERE NOT (duration_minutes < 60) AND NOT (players_attended < 5)
  GROUP BY ALL
)
SELECT k.date_day, k.member_id, CAST(COALESCE(e.amount, 0) AS DOUBLE) AS contribution_municipality, k.multiplier
FROM (SELECT DISTINCT date_day, member_id, multiplier FROM went) k
LEFT JOIN earned e ON k.date_day IS NOT DISTINCT FROM e.date_day AND k.member_id IS NOT DISTINCT FROM e.member_id AND k.multiplier = e.multiplier"""


def player_status_ctes(as_of: dt.date, spine: dt.date, member_filter: str) -> str:
    """The retention series: activity days with their predecessors, every day's
    last activity day by an as-of join, statuses from the distances."""
    return f"""
daily AS (
  SELECT member_id, {_day('start_at', 'UTC')} AS date_day, COUNT(*) AS activities
  FROM attended LEFT JOIN activity USING (activity_id)
  WHERE member_id IN (SELECT m.member_id FROM member m WHERE {member_filter}) GROUP BY ALL
),
began AS (SELECT member_id, greatest(MIN(date_day), {_d(spine)}) AS first_row FROM daily GROUP BY member_id),
visits AS (
  SELECT member_id, date_day, activities, lag(date_day) OVER (PARTITION BY member_id ORDER BY date_day) AS previous
  FROM daily WHERE date_day >= {_d(spine)}
),
days AS (
  SELECT member_id, first_row, CAST(unnest(generate_series(first_row, {_d(as_of)} - 1, INTERVAL 1 DAY)) AS DATE) AS date_day
  FROM began WHERE first_row < {_d(as_of)}
),
seen AS (
  SELECT days.member_id, days.date_day, days.first_row, visits.date_day AS visit, visits.previous, visits.activities AS n
  FROM days ASOF LEFT JOIN visits ON days.member_id = visits.member_id AND days.date_day >= visits.date_day
),
metrics AS (
  SELECT member_id, date_day, CASE WHEN date_day = visit THEN n END AS activities, visit AS last_activity_at,
    date_day - first_row + 1 AS calendar_row, date_day - visit AS days_since_last_activity, previous
  FROM seen
),
status AS (
  SELECT member_id, date_day,
    CASE WHEN calendar_row = 1 THEN 'New'
         WHEN days_since_last_activity = 0 THEN if(date_day - previous > 92, 'New', NULL)
         WHEN days_since_last_activity = 91 THEN 'Churn' END AS status_event,
    if(COALESCE(days_since_last_activity, 91) < 91, 'Active', 'Churned') AS status
  FROM metrics
)"""


WEEKS = (4, 12, 24)


def participation_ctes(as_of: dt.date) -> str:
    """One row per member and window, by a range join with the windows; the
    columns are made from them last.  Rates are rounded in whole numbers."""
    now = f"TIMESTAMPTZ '{as_of.isoformat()} 00:00:00+00'"

    def wide(value: str, name: str) -> list[str]:
        return [f"MAX({value}) FILTER (weeks = {w}) AS {name}_{w}w" for w in WEEKS]
    return f"""
spans(weeks, since) AS (VALUES {_values([(w, _d(as_of - dt.timedelta(weeks=w))) for w in WEEKS])}),
held AS (
  SELECT weeks, activity_id FROM spans LEFT JOIN activity
    ON activity_type_id = 1 AND start_at < {now} AND {_day('start_at', 'UTC')} >= since
),
possible AS (SELECT weeks, COUNT(activity_id) AS n FROM held GROUP BY weeks),
available AS (SELECT {', '.join(wide('n', 'available'))} FROM possible),
per_span AS (
  SELECT member_id, weeks, COUNT(*) AS went FROM attended JOIN held USING (activity_id) GROUP BY ALL
),
participation AS (
  SELECT member_id, full_name, member_type, {', '.join(wide('COALESCE(went, 0)', 'trainings'))},
    {', '.join(wide('CASE WHEN n > 0 THEN ((2000 * COALESCE(went, 0) + n) // (2 * n)) / 10 END', 'rate'))}
  FROM (SELECT * FROM member WHERE member_type = 'Player') JOIN possible ON TRUE LEFT JOIN per_span USING (member_id, weeks)
  GROUP BY ALL
)"""


def _ev_cols(variant: str, table: str, instants=("start_at", "end_at")) -> str:
    return f"SELECT * REPLACE ({', '.join(f'{_ep(c)} AS {c}' for c in instants)}) FROM {table}"


def export_sql(variant: str) -> str:
    if variant == "local":
        mcols = ("first_name, last_name, team_name, inactivated_at, date_of_birth, is_leader, is_player, "
                 "member_type_id, member_type_label")
        acols = (f"event_type_id, event_type_label, {_ep('start_at')} AS start_at, place, is_home_facility, "
                 f"opponent_club_id, opponent, result_id, result_label, goals_for, goals_against, "
                 f"{_ep('end_at')} AS end_at, duration_minutes")
    else:
        mcols = ("team_name, inactivated_at, date_of_birth, is_f2014, member_type_id, member_type, first_name, "
                 "last_name, full_name")
        acols = (f"activity_type_id, activity, {_ep('start_at')} AS start_at, place, is_home_facility, "
                 f"opponent_club_id, opponent, result_type_id, result, goals_for, goals_against, season_id, "
                 f"cup_nr_of_games, {_ep('end_at')} AS end_at, duration_minutes, duration_hours, players_attended, "
                 f"leader_attended, parents_attended")
    return (f"WITH {ev_ctes(variant)} SELECT a.attendance_id, a.activity_id, a.member_id, {mcols}, {acols} "
            f"FROM attended a LEFT JOIN member m USING (member_id) LEFT JOIN activity act USING (activity_id)")


# ------------------------------------------------------------------ data-quality queries

# The declared checks, per model as "test column, column, ...".
CHECKS = {
    "local": {
        "activity": ["unique activity_id", "not_null activity_id, event_type_label, start_at, end_at, duration_minutes", "not_null_where result_label if result_id"],
        "member": ["unique member_id", "not_null member_id, first_name, last_name, is_player, is_leader, member_type_label"],
        "attended_activity": ["unique attendance_id", "not_null attendance_id, member_id, activity_id"],
    },
    "warehouse": {
        "player_status": ["combination date_day member_id", "not_null date_day, member_id, status", "accepted status: Active Churned", "accepted status_event: New Churn"],
        "activity": ["unique activity_id", "not_null activity_id, activity, start_at, end_at, duration_minutes, duration_hours", "not_null_where result if result_type_id", "season season_id"],
        "member": ["unique member_id, full_name", "not_null member_id, first_name, last_name, member_type, full_name"],
        "attended_activity": ["unique attendance_id", "not_null attendance_id, member_id, activity_id"],
        "training_participation": ["unique member_id", "not_null member_id, full_name, member_type"],
    },
}


def _check_sql(model: str, rule: str) -> list[str]:
    """One row (model, column, test, failures) per column of a rule."""
    test, _, rest = rule.partition(" ")

    def row(column: str, name: str, failures: str) -> str:
        return f"SELECT '{model}' AS model, '{column}' AS \"column\", '{name}' AS test, CAST(({failures}) AS BIGINT) AS failures"
    if test == "not_null":
        return [row(c, "not_null", f"SELECT COUNT(*) - COUNT({c}) FROM {model}") for c in rest.split(", ")]
    if test == "not_null_where":
        column, given = rest.split(" if ")
        return [row(column, "not_null", f"SELECT COUNT({given}) - COUNT(CASE WHEN {given} IS NOT NULL THEN {column} END) FROM {model}")]
    if test == "unique":
        return [row(c, "unique", f"SELECT COUNT(*) FROM (SELECT {c} FROM {model} WHERE {c} IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)") for c in rest.split(", ")]
    if test == "combination":
        keys = rest.replace(" ", ",")
        return [row(keys, "unique_combination", f"SELECT COUNT(*) FROM (SELECT {keys} FROM {model} GROUP BY {keys} HAVING COUNT(*) > 1)")]
    if test == "accepted":
        column, values = rest.split(": ")
        return [row(column, "accepted_values", f"SELECT COUNT(DISTINCT {column}) FILTER (NOT list_contains([{', '.join(repr(v) for v in values.split())}], {column})) FROM {model}")]
    return [row(rest, "relationships", f"SELECT COUNT(*) FROM {model} ANTI JOIN season USING ({rest}) WHERE {rest} IS NOT NULL")]


SEASON_VALUES = "season AS (SELECT unnest({ids}) AS season_id)"


def dq_models(variant: str) -> str:
    """The checked models as CTEs."""
    if variant == "local":
        return f"{ev_ctes('local')}, attended_activity AS (SELECT * FROM attended)"
    return (f"{ev_ctes('warehouse')}, attended_activity AS (SELECT * FROM attended), {SEASON_VALUES.format(ids=_list([i for i, _ in SEASONS]))}, "
            + player_status_ctes(EV_AS_OF, EV_SPINE, "m.member_type = 'Player' AND m.is_f2014").strip() + ", player_status AS (SELECT * FROM status), "
            + participation_ctes(EV_AS_OF).strip() + ", training_participation AS (SELECT * FROM participation)")


def dq_suite_sql(variant: str) -> str:
    checks = [q for model, rules in CHECKS[variant].items() for rule in rules for q in _check_sql(model, rule)]
    return f"WITH {dq_models(variant)} " + " UNION ALL ".join(checks)


# The faults that the fault queries plant: per model the key by which rows are hit, and per column
# the value that every row with key % 7 = place gets; rows with key % 5 = 0 come twice.
FAULTS = {
    "activity": ("activity_id // 4294967296", ["event_type_label", "activity", "result_label", "result", "start_at", "end_at", "duration_minutes", "duration_hours"]),
    "member": ("member_id", ["first_name", "last_name", "is_player", "is_leader", "member_type_label", "member_type", "full_name"]),
    "attended_activity": ("member_id", ["attendance_id", "activity_id"]),
    "player_status": ("member_id + (date_day - DATE '2020-01-01')", ["date_day", "status"]),
    "training_participation": ("member_id", ["full_name", "member_type"]),
}


def dq_faults_sql(variant: str) -> str:
    """The suite over models with planted faults."""
    columns = {m: {c.strip() for rule in rules if rule.startswith("not_null") for c in rule.split(" ", 1)[1].split(" if ")[0].split(",")} for m, rules in CHECKS[variant].items()}
    planted = []
    for model in CHECKS[variant]:
        key, names = FAULTS[model]
        first = {"activity": "activity_id", "member": "member_id", "attended_activity": "member_id", "player_status": "member_id", "training_participation": "member_id"}[model]
        hit = [n for n in names if n in columns[model]] + [first]
        sets = [f"CASE WHEN ({key}) % 7 <> {i % 7} THEN {c} END AS {c}" for i, c in enumerate(hit)]
        if model == "player_status":
            sets = [x for x in sets if not x.endswith(" AS status")] + [f"CASE ({key}) % 7 WHEN 1 THEN NULL WHEN 3 THEN 'Lost' ELSE status END AS status",
                                                                       f"CASE ({key}) % 7 WHEN 4 THEN 'Odd' ELSE status_event END AS status_event"]
        if model == "activity" and variant == "warehouse":
            sets.append(f"CASE WHEN ({key}) % 7 = 5 THEN -1 ELSE season_id END AS season_id")
        if model == "activity":
            given, shown = ("result_id", "result_label") if variant == "local" else ("result_type_id", "result")
            sets = [x for x in sets if not x.endswith(f" AS {shown}")] + [f"CASE WHEN {given} <> 2 THEN {shown} END AS {shown}"]
        planted.append(f"SELECT * EXCLUDE (k) REPLACE ({', '.join(sets)}) FROM {model}, (VALUES (1), (2)) twice(k) WHERE k = 1 OR ({key}) % 5 = 0")
    checks = [q for model, rules in CHECKS[variant].items() for rule in rules for q in _check_sql(f"bad_{model}", rule)]
    bad = ", ".join(f"bad_{m} AS ({q})" for m, q in zip(CHECKS[variant], planted))
    return f"WITH {dq_models(variant)}, {bad} " + " UNION ALL ".join(c.replace("SELECT 'bad_", "SELECT '", 1) for c in checks)


# ------------------------------------------------------------------ pages

def _unescape(x: str) -> str:
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&#x27;", "''"), ("&amp;", "&")):
        x = f"replace({x}, '{ent}', '{ch}')"
    return x


WS = r"[\t\n\x0B\f\r\x{85}\pZ]"
HREF = r"""(?is)\bhref\s*=\s*["']([^"']*)["']"""


def page_links_sql() -> str:
    anchors = r"""list_filter(regexp_extract_all(html, '(?is)<li\b[^>]*>\s*<a\b([^>]*)>', 1), lambda a: regexp_matches(a, '""" + HREF.replace("'", "''") + r"""'))"""
    aid = ("CASE WHEN len(string_split(href, '/')) >= 2 "
           "THEN string_split(href, '/')[len(string_split(href, '/')) - 1] END")
    resolved = ("CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href "
                "WHEN starts_with(href, '//') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*:)', 1) || href "
                "WHEN starts_with(href, '/') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || href "
                "ELSE NULL END")
    base = f"https://{DOMAIN}/{SLUG}/"
    return f"""
WITH l AS (
  SELECT page_id, url, unnest({anchors}) AS attrs, generate_subscripts({anchors}, 1) AS i FROM pages
), h AS (
  SELECT page_id, url, CAST(i - 1 AS BIGINT) AS pos,
    {_unescape("regexp_extract(attrs, '" + HREF.replace("'", "''") + "', 1)")} AS href
  FROM l
)
SELECT page_id, pos, href, {resolved} AS link_url, {aid} AS activity_id,
  contains(href, '/match/') AS is_match,
  '{base}controlpanel/presence/chooseparticipants/' || {aid} AS presence_url,
  '{base}' || CASE WHEN contains(href, '/match/') THEN 'match/redigera/' ELSE 'kalender/redigera-aktivitet/' END || {aid} AS activity_url
FROM h"""


def team_links_sql() -> str:
    inner = page_links_sql().replace("SELECT page_id, pos, href,", "SELECT page_id, pos, href, 1 AS one,", 1)
    return f"""
SELECT page_id, COUNT(*) AS total_links, COUNT(*) FILTER (WHERE contains(href, '/{SLUG}/')) AS kept,
  COUNT(*) FILTER (WHERE NOT contains(href, '/{SLUG}/')) AS removed
FROM ({inner}) GROUP BY page_id"""


def page_digest_sql() -> str:
    return f"""
SELECT page_id, left(sha256(html), 12) AS html_sha256,
  COALESCE(substr(trim(regexp_replace(html, '{WS}+', ' ', 'g')), 1, 200), '') AS snippet,
  CAST(length(html) AS BIGINT) AS html_len
FROM pages"""


def page_evidence_sql() -> str:
    title = _unescape(r"regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title>', 1)")
    title = f"regexp_replace(regexp_replace({title}, '^{WS}+', ''), '{WS}+$', '')"
    canon = (r"""list_filter(regexp_extract_all(html, '(?is)<link\b([^>]*)>', 1), """
             r"""lambda a: regexp_matches(a, '(?is)\brel\s*=\s*["'']canonical["'']'))[1]""")
    canon_href = (f"CASE WHEN regexp_matches({canon}, '" + HREF.replace("'", "''") + "') THEN "
                  + _unescape(f"regexp_extract({canon}, '" + HREF.replace("'", "''") + "', 1)") + " END")
    login = (r"""len(list_filter(regexp_extract_all(html, '(?is)<form\b[^>]*>(.*?)</form>', 1), lambda b: """
             r"""regexp_matches(b, '(?is)<input\b[^>]*(\bname\s*=\s*["'']UserName["'']|\bname\s*=\s*["''][^"'']*Pass[^"'']*["'']|\btype\s*=\s*["'']password["''])')))""")
    return f"""
SELECT page_id, {title} AS title, {canon_href} AS canonical, contains(html, 'Logga ut') AS has_logout,
  CAST({login} AS BIGINT) AS login_form_count, CAST(length(html) AS BIGINT) AS html_len,
  CAST(least(len(regexp_extract_all(html, '(?is)<form\\b([^>]*)>', 1)), 5) AS BIGINT) AS n_forms
FROM pages"""


def page_auth_sql() -> str:
    return """
SELECT page_id, COALESCE(contains(html, 'Logga ut'), FALSE) AS has_logout,
  COALESCE(contains(lower(url), 'logga-in'), FALSE) AS is_login_url,
  COALESCE(contains(html, 'Logga ut'), FALSE) AND NOT COALESCE(contains(lower(url), 'logga-in'), FALSE) AS authenticated,
  TRUE AS status_ok
FROM pages"""


def presence_scan_sql() -> str:
    head = (r"CASE WHEN regexp_matches(html, '(?is)</head>|<body\b') "
            r"THEN regexp_extract(html, '(?is)^(.*?)(?:</head>|<body\b)', 1) ELSE html END")
    scripts = f"regexp_extract_all({head}, '(?is)<script\\b[^>]*>(.*?)</script>', 1)"
    return f"""
SELECT page_id, CAST(len({scripts}) AS BIGINT) AS n_head_scripts,
  len(list_filter({scripts}, lambda s: regexp_matches(s, '\\binitData\\s*=\\s*[{{\\[]'))) > 0 AS has_init_data
FROM pages"""


# ------------------------------------------------------------------ captured pages

def captured_sql(ev: str) -> dict[str, str]:
    """What the captured pages must give, from the events alone: which
    activities and days have readable pages, and what was put into them."""
    bucket = "schedule_id // 4294967296"
    days = f"""days AS (
  SELECT team, bucket // 24 AS day, (team * 100000 + bucket // 24) * 4 + 3 AS page_id, (bucket // 24 + team) % 17 = 0 AS login, schedule_id, bucket, etype = 7 AS is_match
  FROM ev_act
)"""
    root = f"'https://{DOMAIN}/team-0/"
    path = "'/team-0/' || if(is_match, 'match/', 'kalender/aktivitet/') || schedule_id || '/'"
    no_form = "0 AS login_form_count, 0 AS n_forms, NULL AS action, NULL AS method, NULL AS input_names"
    return {
        "captured_presence": f"WITH {ev} SELECT * FROM stg_presence WHERE {bucket} % 11 > 2",
        "captured_activity": f"WITH {ev} SELECT * FROM stg_activity WHERE {bucket} % 13 > 0",
        "page_ingest": f"WITH {ev} SELECT * FROM stg_activity WHERE {bucket} % 13 > 0",
        "captured_links": f"""WITH {ev}, {days} SELECT page_id, COUNT(*) AS total_links, COUNT(*) FILTER (team = 0) AS kept,
  COUNT(*) FILTER (team > 0) AS removed FROM days WHERE NOT login GROUP BY page_id""",
        "captured_requests": f"""WITH {ev}, {days} SELECT page_id, COUNT(*) OVER (PARTITION BY page_id ORDER BY bucket) - 1 AS pos, {path} AS href,
  CAST(schedule_id AS VARCHAR) AS activity_id, is_match, {root}controlpanel/presence/chooseparticipants/' || schedule_id AS presence_url,
  {root}' || if(is_match, 'match/redigera/', 'kalender/redigera-aktivitet/') || schedule_id AS activity_url
FROM days WHERE team = 0 AND NOT login""",
        "captured_rejects": f"""WITH {ev}, {days}
SELECT schedule_id * 4 + 1 AS page_id, CASE WHEN bucket % 11 = 1 THEN 'error status'
  WHEN bucket % 11 = 0 AND bucket % 3 > 0 THEN 'initData not found' ELSE 'initData not readable' END AS reason FROM ev_act WHERE bucket % 11 < 3
UNION ALL SELECT schedule_id * 4 + 2, 'data-ng-init missing' FROM ev_act WHERE bucket % 13 = 0
UNION ALL SELECT DISTINCT page_id, 'not authenticated' FROM days WHERE login""",
        "captured_evidence": f"""WITH {ev}, {days}
SELECT schedule_id * 4 + 1 AS page_id, 'N\u00e4rvaro' AS title, NULL AS canonical, FALSE AS has_logout, {no_form} FROM ev_act
UNION ALL SELECT schedule_id * 4 + 2, '', NULL, FALSE, 0, 0, NULL, NULL, NULL FROM ev_act
UNION ALL SELECT DISTINCT page_id, if(login, 'Logga in', 'Kalender & mer'), if(login, NULL, '/kalender'), NOT login, if(login, 1, 0)::BIGINT, 1::BIGINT,
  if(login, '/logga-in', '/sok'), if(login, 'post', NULL), if(login, 'UserName,UserPass', 'compass_id') FROM days""",
        "captured_scripts": f"""WITH {ev} SELECT schedule_id * 4 + 1 AS page_id, CAST(if(bucket % 3 = 0, 2, 1) AS BIGINT) AS n_head_scripts,
  CAST(CASE WHEN bucket % 3 > 0 THEN if(bucket % 11 = 0, NULL, 0) WHEN bucket % 11 IN (0, 2) THEN 0 ELSE 1 END AS BIGINT) AS script_index FROM ev_act""",
    }


# ------------------------------------------------------------------ registry

def build_report_sql() -> str:
    """Rows of each model and the sum of one column, each from the model's own SQL."""
    sums = {"attended_activity": ("member_id", f"WITH {ev_ctes('warehouse')} SELECT * FROM attended"),
            "member": ("member_id", f"WITH {ev_ctes('warehouse')} SELECT * FROM member"),
            "activity": ("activity_id", f"WITH {ev_ctes('warehouse')} SELECT * FROM activity"),
            "statligt_lok": ("lok_amount_players", lok_sql("warehouse")),
            "kommunalt_lok": ("contribution_municipality", municipal_sql()),
            "export_all": ("duration_minutes", export_sql("warehouse"))}
    return " UNION ALL ".join(f"SELECT '{m}' AS model, COUNT(*) AS row_count, SUM({c}::DECIMAL(38, 2))::DOUBLE AS total FROM ({sql})"
                              for m, (c, sql) in sums.items())


def all_sql() -> dict[str, str]:
    W, L = "warehouse", "local"
    ev_w, ev_l = ev_ctes(W), ev_ctes(L)
    or_w = or_ctes()
    cohort = "m.member_type = 'Player' AND m.is_f2014"
    months = _list([f"'{m}'" for m in SWEDISH_MONTHS])
    q = {
        "stg_activity_warehouse": f"WITH {ev_w} SELECT * FROM stg_activity",
        "stg_activity_local": f"WITH {ev_l} SELECT * FROM stg_activity",
        "stg_presence_warehouse": f"WITH {ev_w} SELECT * FROM stg_presence",
        "stg_presence_local": f"WITH {ev_l} SELECT * FROM stg_presence",
        "latest_load": (f"WITH {ev_w} SELECT schedule_id, place, 'L2' AS load_id, "
                        f"CAST(epoch(TIMESTAMPTZ '2024-02-01 00:00:00+00') AS BIGINT) AS load_timestamp FROM stg_activity"),
        "raw_row_count": (f"WITH {ev_w} SELECT 'raw_activity' AS table_name, CAST(2 * COUNT(*) AS BIGINT) AS row_count "
                          f"FROM stg_activity UNION ALL SELECT 'raw_presence', CAST(2 * COUNT(DISTINCT schedule_id) AS BIGINT) "
                          f"FROM stg_presence"),
        "member_warehouse": f"WITH {ev_w} SELECT * FROM member",
        "member_local": f"WITH {ev_l} SELECT * FROM member",
        "activity_warehouse": f"WITH {ev_w} {_ev_cols(W, 'activity')}",
        "activity_local": f"WITH {ev_l} {_ev_cols(L, 'activity')}",
        "attended_activity_warehouse": f"WITH {ev_w} SELECT * FROM attended",
        "attended_activity_local": f"WITH {ev_l} SELECT * FROM attended",
        "headcounts": f"WITH {ev_w} SELECT * FROM headcounts",
        "eligible_activities": f"WITH {ev_w}, {eligible_sql(W)} SELECT * FROM eligible",
        "eligible_activities_local": f"WITH {ev_l}, {eligible_sql(L)} SELECT * FROM eligible",
        "activity_ordinals": f"WITH {ev_l}, {ordinals_sql(L)} {_ev_cols(L, 'ordinals')}",
        "activity_ordinals_warehouse": f"WITH {ev_w}, {ordinals_sql(W)} {_ev_cols(W, 'ordinals')}",
        "lok": lok_sql(L),
        "statligt_lok": lok_sql(W),
        "kommunalt_lok": municipal_sql(),
        "export_all": export_sql(W),
        "export_all_local": export_sql(L),
        "daily_activity_counts": f"WITH {or_w}, {player_status_ctes(OR_AS_OF, OR_SPINE, cohort)} SELECT * FROM daily",
        "last_activity_running": (f"WITH {or_w}, {player_status_ctes(OR_AS_OF, OR_SPINE, cohort)} "
                                  f"SELECT member_id, date_day, activities, last_activity_at, calendar_row, "
                                  f"days_since_last_activity FROM metrics"),
        "player_status": f"WITH {or_w}, {player_status_ctes(OR_AS_OF, OR_SPINE, cohort)} SELECT * FROM status",
        "player_status_ordered": (f"WITH {or_w}, {player_status_ctes(OR_AS_OF, OR_SPINE, cohort)} "
                                  f"SELECT *, ROW_NUMBER() OVER (ORDER BY member_id, date_day) AS place FROM status"),
        "available_trainings": f"WITH {or_w}, {participation_ctes(OR_AS_OF)} SELECT * FROM available",
        "training_participation": f"WITH {or_w}, {participation_ctes(OR_AS_OF)} SELECT * FROM participation",
        "build_report": build_report_sql(),
        "dq_suite_warehouse": dq_suite_sql(W),
        "dq_suite_local": dq_suite_sql(L),
        "dq_faults_warehouse": dq_faults_sql(W),
        "dq_faults_local": dq_faults_sql(L),
        "dq_not_null": f"WITH {ev_w} SELECT activity_id, activity_type_id FROM activity WHERE activity IS NULL",
        "dq_not_null_where": (f"WITH {ev_w} SELECT activity_id, result_type_id FROM activity "
                              f"WHERE result_type_id IS NOT NULL AND result IS NULL"),
        "dq_unique": (f"WITH {ev_w} SELECT full_name AS unique_field, COUNT(*) AS n_records FROM member "
                      f"WHERE full_name IS NOT NULL GROUP BY full_name HAVING COUNT(*) > 1"),
        "dq_unique_shared": (f"WITH {ev_w} SELECT member_id AS unique_field, COUNT(*) AS n_records FROM attended "
                             f"WHERE member_id IS NOT NULL GROUP BY member_id HAVING COUNT(*) > 1"),
        "dq_accepted_values": (f"WITH {ev_w} SELECT activity AS value_field, COUNT(*) AS n_records FROM activity "
                               f"GROUP BY activity HAVING activity NOT IN ('Training', 'Match', 'Cup')"),
        "dq_unique_combination": (f"WITH {ev_w} SELECT team_name, member_type_id, COUNT(*) AS n_records "
                                  f"FROM stg_presence GROUP BY team_name, member_type_id HAVING COUNT(*) > 1"),
        "dq_relationships": (f"WITH {ev_w}, {eligible_sql(W)} SELECT a.activity_id AS from_field FROM attended a "
                             f"LEFT JOIN eligible e USING (activity_id) WHERE e.activity_id IS NULL AND a.activity_id IS NOT NULL"),
        "month_urls": f"""WITH {ev_w},
starts AS (
  SELECT 'team-' || CAST(team_id AS VARCHAR) AS team_slug, MIN(CAST(schedule_date AS DATE)) AS start_date
  FROM stg_activity GROUP BY 1
),
m AS (
  SELECT team_slug, CAST(unnest(generate_series(start_date, {_d(EV_AS_OF)}, INTERVAL 1 MONTH)) AS DATE) AS month_start
  FROM starts WHERE start_date <= {_d(EV_AS_OF)}
)
SELECT team_slug, month_start, CAST(year(month_start) AS BIGINT) AS year,
  ({months})[month(month_start)] AS month_name,
  'https://{DOMAIN}/' || team_slug || '/kalender/' || CAST(year(month_start) AS VARCHAR) || '/' || ({months})[month(month_start)] AS url
FROM m""",
        "json_roundtrip": f"WITH {ev_w} SELECT * FROM stg_activity",
        "load_append": f"WITH {ev_w} SELECT * FROM stg_presence",
        "load_stream": f"WITH {ev_w} SELECT * FROM stg_activity",
        "csv_export_roundtrip": export_sql(L),
        "csv_export_warehouse": export_sql(W),
        "presence_roundtrip": f"WITH {ev_w} SELECT * FROM stg_presence",
        "load_new_field": (f"WITH {ev_w} SELECT schedule_id, l AS load_id, if(l = 'L2', schedule_id * 2, NULL) AS new_field "
                           f"FROM stg_activity, unnest(['L1', 'L2']) AS t(l)"),
        "load_conflict": f"WITH {ev_w} SELECT schedule_id, 'Old hall' AS place, 'L1' AS load_id, 1::BIGINT AS refused FROM stg_activity",
        "load_nested_field": f"""WITH {ev_w}, people AS (
  SELECT schedule_id, COUNT(*) FILTER (member_type_id <> 2) AS n, COUNT(*) FILTER (member_type_id = 2) AS coaches,
    COALESCE(SUM(user_id % 100) FILTER (member_type_id <> 2), 0)::BIGINT AS shirts FROM stg_presence GROUP BY schedule_id)
SELECT schedule_id, l AS load_id, n AS participants, if(l = 'L2', coaches, NULL) AS coaches, if(l = 'L2' OR n = 0, shirts, NULL) AS shirts
FROM people, unnest(['L1', 'L2']) AS t(l)""",
        "load_quarantine": f"WITH {ev_w} SELECT schedule_id, if(bucket % 5 = 0 OR bucket % 7 = 0, 'set aside', 'read') AS outcome FROM ev_act",
        "load_ledger": f"""WITH {ev_w} SELECT l.id AS load_id, l.seen AS load_timestamp, COUNT(*) AS row_count
FROM stg_activity, (VALUES ('L1', epoch(TIMESTAMPTZ '2024-01-31 00:00:00+00')::BIGINT), ('L2', epoch(TIMESTAMPTZ '2024-02-01 00:00:00+00')::BIGINT)) AS l(id, seen) GROUP BY ALL""",
        **captured_sql(ev_w),
        "page_links": page_links_sql(),
        "team_links": team_links_sql(),
        "page_digest": page_digest_sql(),
        "page_evidence": page_evidence_sql(),
        "page_auth": page_auth_sql(),
        "presence_scan": presence_scan_sql(),
        "extract_rejects": ("SELECT page_id, url, 'not authenticated' AS reason FROM pages "
                            "WHERE NOT (COALESCE(contains(html, 'Logga ut'), FALSE) "
                            "AND NOT COALESCE(contains(lower(url), 'logga-in'), FALSE))"),
    }
    return {k: v.strip() for k, v in q.items()}
