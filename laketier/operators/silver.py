"""Silver layer: flatten the nested fixture record, cleanse it, keep the
latest version of each match, keep finished matches.

Every step is a projection except the dedup window, so Catalyst collapses
flatten + cleanse into one Project and prunes nested fields down to the
scan (``ReadSchema`` lists only the leaves used).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketier.functions.match import FINISHED, match_result, standard_status
from laketier.functions.parse import iso_calendar_date, iso_instant
from laketier.operators.dedup import latest_per_key
from laketier.schemas import SILVER_COLUMNS, SILVER_KEYS

# The silver columns and where the raw record holds them.
# (silver column, nested source field, target type / parser / None to keep)
FLATTEN_SPEC: list[tuple[str, str, object]] = [
    ("match_id", "fixture.id", "int"),
    ("match_datetime", "fixture.date", iso_instant),
    ("match_date", "fixture.date", iso_calendar_date),
    ("match_status", "fixture.status.short", None),
    ("venue_name", "fixture.venue.name", None),
    ("venue_city", "fixture.venue.city", None),
    ("league_id", "league.id", "int"),
    ("league_name", "league.name", None),
    ("season", "league.season", "int"),
    ("round", "league.round", None),
    ("home_team_id", "teams.home.id", "int"),
    ("home_team_name", "teams.home.name", None),
    ("away_team_id", "teams.away.id", "int"),
    ("away_team_name", "teams.away.name", None),
    ("home_goals", "goals.home", "int"),
    ("away_goals", "goals.away", "int"),
    ("ht_home_goals", "score.halftime.home", "int"),
    ("ht_away_goals", "score.halftime.away", "int"),
]

TRIMMED = ["league_name", "home_team_name", "away_team_name", "venue_name"]
DEFAULT_TIE_BREAKERS = ("_source_file", "_record_hash")
RECORD_HASH = "_record_hash"


def flatten(bronze: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Nested record -> 20 flat columns (+ ``carry``).

    Casts are ``try_cast``: a bad value becomes NULL instead of failing the
    run under ANSI mode. ``match_date`` is the calendar date as written in
    the ISO string (an offset does not move it), ``match_datetime`` the
    instant.
    """
    cols = []
    for name, path, typ in FLATTEN_SPEC:
        c = F.col(path)
        if callable(typ):
            c = typ(c)
        elif typ:
            c = c.try_cast(typ)
        cols.append(c.alias(name))
    passthrough = ["_ingest_timestamp", "_source_file",
                   *[F.col(c).alias(carried_name(c)) for c in carry
                     if c not in ("_ingest_timestamp", "_source_file")]]
    return bronze.select(*cols, *passthrough)


def carried_name(column: str) -> str:
    """Flat name of a carried column (``fixture.timestamp`` -> ``fixture_timestamp``)."""
    return column.replace(".", "_")


def cleanse(flat: DataFrame) -> DataFrame:
    """Trim names, standardise status, default goals to 0, derive result and total."""
    trimmed = {c: F.trim(F.col(c)) for c in TRIMMED}
    out = flat.withColumns({
        **trimmed,
        "match_status": standard_status(F.col("match_status")),
        "home_goals": F.coalesce(F.col("home_goals"), F.lit(0)),
        "away_goals": F.coalesce(F.col("away_goals"), F.lit(0)),
    })
    return out.withColumns({
        "match_result": match_result(F.col("home_goals"), F.col("away_goals")),
        "total_goals": F.col("home_goals") + F.col("away_goals"),
    })


def finished_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("match_status") == FINISHED)


def with_record_hash(flat: DataFrame) -> DataFrame:
    """Hash of the flattened values: the last tie-breaker of the dedup.

    Two versions that agree on every flattened value give identical silver
    rows, so hashing these (not the raw record) keeps the survivor's content
    deterministic while the scan still reads only the nested fields used.
    """
    return flat.withColumn(RECORD_HASH, F.xxhash64(*[name for name, _, _ in FLATTEN_SPEC]))


def silver_matches(bronze: DataFrame, tie_breakers: Sequence[str] = DEFAULT_TIE_BREAKERS,
                   processed_at: bool = True) -> DataFrame:
    """Bronze fixture records -> silver rows (one per finished match).

    Order matters: dedup runs before the FINISHED filter, so a match whose
    newest version is not finished is left out of this batch. Tie-breakers may be
    nested fields of the record.
    """
    hashed = RECORD_HASH in tie_breakers and RECORD_HASH not in bronze.columns
    flat = flatten(bronze, carry=[t for t in tie_breakers if not (hashed and t == RECORD_HASH)])
    if hashed:
        flat = with_record_hash(flat)
    latest = latest_per_key(cleanse(flat), SILVER_KEYS,
                            ["_ingest_timestamp", *map(carried_name, tie_breakers)])
    out = finished_only(latest)
    if processed_at:
        out = out.withColumn("_silver_processed_at", F.current_timestamp())
        return out.select(*SILVER_COLUMNS)
    return out.select(*SILVER_COLUMNS[:-1])
