"""Hand-made raw inputs (FIXTURES.md section 2)."""

from __future__ import annotations

import datetime as dt

from turnout import schemas

L2_TS = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


def person(uid, mtype=1, dob="2012-05-01", first=..., last=..., pid=None, leader=None, player=None):
    first = f"F{uid}" if first is ... else first
    last = f"L{uid}" if last is ... else last
    return {"id": pid if pid is not None else 1000 + uid, "firstName": first, "lastName": last, "userId": uid,
            "teamName": "T", "inactivatedDate": None, "stats": {"star": 1}, "birthDate": dob,
            "isLeader": mtype == 2 if leader is None else leader,
            "isPlayer": mtype == 1 if player is None else player, "memberTypeId": mtype}


def presence_row(sid, people, load="L2", ts=L2_TS, groups=None):
    if groups is None:
        groups = [{"leaders": [p for p in people if p["memberTypeId"] == 2],
                   "participants": [p for p in people if p["memberTypeId"] != 2]}]
    return {"scheduleId": sid, "teamPresenceGroups": groups, "load_id": load, "load_timestamp": ts}


def activity_row(sid, date, start="18:00", end="19:00", etype=1, result=None, season=None, info="info",
                 place="Hall", load="L2", ts=L2_TS):
    return {"teamId": 1, "scheduleId": sid, "username": "u", "scheduleDate": date, "startTime": start,
            "endTime": end, "eventTypeId": etype, "place": place, "isHomeFacility": True,
            "opponentClubId": None, "opponent": None, "resultId": result, "goalsFor": None,
            "goalsAgainst": None, "seasonId": season, "scheduleText": None, "scheduleInfo": info,
            "load_id": load, "load_timestamp": ts}


def raw_presence(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_PRESENCE)


def raw_activity(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_ACTIVITY)


def eligible_crowd(base_uid, n_players=3, n_leaders=1, dob="2010-01-01"):
    """Extra people that make an activity eligible for the state grant."""
    return ([person(base_uid + i, 1, dob) for i in range(n_players)]
            + [person(base_uid + 100 + i, 2, "1980-01-01") for i in range(n_leaders)])
