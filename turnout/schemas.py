"""Declared schemas of the raw (nested) inputs and of the lookup files.

Raw loads are read with these schemas instead of inference, so an all-null
field in one batch does not change a column's type.
"""

from pyspark.sql import types as T

PERSON = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("firstName", T.StringType()),
    T.StructField("lastName", T.StringType()),
    T.StructField("userId", T.LongType()),
    T.StructField("teamName", T.StringType()),
    T.StructField("inactivatedDate", T.StringType()),
    T.StructField("stats", T.StructType([T.StructField("star", T.LongType())])),
    T.StructField("birthDate", T.StringType()),
    T.StructField("isLeader", T.BooleanType()),
    T.StructField("isPlayer", T.BooleanType()),
    T.StructField("memberTypeId", T.LongType()),
])

PRESENCE_GROUP = T.StructType([
    T.StructField("leaders", T.ArrayType(PERSON)),
    T.StructField("participants", T.ArrayType(PERSON)),
])

LOAD_FIELDS = [
    T.StructField("load_id", T.StringType()),
    T.StructField("load_timestamp", T.TimestampType()),
]

RAW_PRESENCE = T.StructType([
    T.StructField("scheduleId", T.LongType()),
    T.StructField("teamPresenceGroups", T.ArrayType(PRESENCE_GROUP)),
] + LOAD_FIELDS)

RAW_ACTIVITY = T.StructType([
    T.StructField("teamId", T.LongType()),
    T.StructField("scheduleId", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("scheduleDate", T.StringType()),
    T.StructField("startTime", T.StringType()),
    T.StructField("endTime", T.StringType()),
    T.StructField("eventTypeId", T.LongType()),
    T.StructField("place", T.StringType()),
    T.StructField("isHomeFacility", T.BooleanType()),
    T.StructField("opponentClubId", T.LongType()),
    T.StructField("opponent", T.StringType()),
    T.StructField("resultId", T.LongType()),
    T.StructField("goalsFor", T.LongType()),
    T.StructField("goalsAgainst", T.LongType()),
    T.StructField("seasonId", T.LongType()),
    T.StructField("scheduleText", T.StringType()),
    T.StructField("scheduleInfo", T.StringType()),
] + LOAD_FIELDS)

# Payload shapes without the load stamp (what a page yields before stamping).
PRESENCE_PAYLOAD = T.StructType([f for f in RAW_PRESENCE.fields if f.name not in ("load_id", "load_timestamp")])
ACTIVITY_PAYLOAD = T.StructType([f for f in RAW_ACTIVITY.fields if f.name not in ("load_id", "load_timestamp")])

SEED_SCHEMAS = {
    "activity_types": T.StructType([T.StructField("activity_type_id", T.LongType()),
                                    T.StructField("name", T.StringType())]),
    "member_types": T.StructType([T.StructField("member_type_id", T.LongType()),
                                  T.StructField("name", T.StringType())]),
    "result_types": T.StructType([T.StructField("result_type_id", T.LongType()),
                                  T.StructField("name", T.StringType())]),
    "seasons": T.StructType([T.StructField("season_id", T.LongType()),
                             T.StructField("year", T.LongType()),
                             T.StructField("difficulty", T.StringType()),
                             T.StructField("season_name", T.StringType())]),
}
