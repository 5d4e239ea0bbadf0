"""Schemas of the raw fixture document and the column sets of every layer.

The raw schema is explicit so that all-null fields (extra time, penalties)
keep a numeric type; inferring them yields ``string`` and a later file with a
number then cannot be merged.
"""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"


def _pair(t: T.DataType = T.LongType()) -> T.StructType:
    return T.StructType([T.StructField("home", t), T.StructField("away", t)])


def _team() -> T.StructType:
    return T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("logo", T.StringType()),
        T.StructField("winner", T.BooleanType()),
    ])


FIXTURE_RECORD = T.StructType([
    T.StructField("fixture", T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("referee", T.StringType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("periods", T.StructType([
            T.StructField("first", T.LongType()), T.StructField("second", T.LongType())])),
        T.StructField("venue", T.StructType([
            T.StructField("id", T.LongType()),
            T.StructField("name", T.StringType()),
            T.StructField("city", T.StringType())])),
        T.StructField("status", T.StructType([
            T.StructField("long", T.StringType()),
            T.StructField("short", T.StringType()),
            T.StructField("elapsed", T.LongType())])),
    ])),
    T.StructField("league", T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("logo", T.StringType()),
        T.StructField("flag", T.StringType()),
        T.StructField("season", T.LongType()),
        T.StructField("round", T.StringType()),
    ])),
    T.StructField("teams", T.StructType([
        T.StructField("home", _team()), T.StructField("away", _team())])),
    T.StructField("goals", _pair()),
    T.StructField("score", T.StructType([
        T.StructField("halftime", _pair()),
        T.StructField("fulltime", _pair()),
        T.StructField("extratime", _pair()),
        T.StructField("penalty", _pair()),
    ])),
])

RECORD_FIELDS = [f.name for f in FIXTURE_RECORD.fields]

# One API document: an envelope whose ``response`` array holds the records.
ENVELOPE = T.StructType([
    T.StructField("get", T.StringType()),
    T.StructField("parameters", T.StructType([
        T.StructField("league", T.StringType()),
        T.StructField("season", T.StringType()),
        T.StructField("date", T.StringType())])),
    T.StructField("errors", T.ArrayType(T.StringType())),
    T.StructField("results", T.LongType()),
    T.StructField("paging", T.StructType([
        T.StructField("current", T.LongType()), T.StructField("total", T.LongType())])),
    T.StructField("response", T.ArrayType(FIXTURE_RECORD)),
])

BRONZE_AUDIT = ["_ingest_timestamp", "_ingest_date", "_source_file", "_sport_type"]
BRONZE_PARTITIONS = ["_ingest_date", "_sport_type"]

# Silver: 20 flattened columns, then the derived ones.
SILVER_FLAT = [
    "match_id", "match_datetime", "match_date", "match_status", "venue_name", "venue_city",
    "league_id", "league_name", "season", "round",
    "home_team_id", "home_team_name", "away_team_id", "away_team_name",
    "home_goals", "away_goals", "ht_home_goals", "ht_away_goals",
    "_ingest_timestamp", "_source_file",
]
SILVER_COLUMNS = SILVER_FLAT + ["match_result", "total_goals", "_silver_processed_at"]
SILVER_KEYS = ["match_id"]
SILVER_PARTITIONS = ["league_id", "season"]

FACT_COLUMNS = [
    "match_id", "match_date", "match_datetime", "league_id", "season", "round",
    "home_team_id", "away_team_id", "home_goals", "away_goals", "ht_home_goals",
    "ht_away_goals", "total_goals", "match_result", "venue_name", "venue_city",
    "home_team_points", "away_team_points", "goal_difference",
]
FACT_KEYS = ["match_id"]
FACT_PARTITIONS = ["season", "league_id"]

DIM_TEAM_COLUMNS = ["team_id", "team_name", "league_id", "league_name", "season"]
DIM_TEAM_KEYS = ["team_id", "season"]

DIM_DATE_COLUMNS = [
    "date", "year", "month", "day", "quarter", "week_of_year", "day_of_week",
    "month_name", "day_name", "is_weekend",
]
DIM_DATE_KEYS = ["date"]
