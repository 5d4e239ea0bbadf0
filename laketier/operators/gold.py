"""Gold layer: match fact, team and date dimensions, league-season summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketier.functions.dates import date_attributes
from laketier.functions.match import AWAY_WIN, HOME_WIN, goal_difference, team_points
from laketier.operators.dedup import latest_per_key
from laketier.schemas import DIM_DATE_COLUMNS, DIM_TEAM_COLUMNS, DIM_TEAM_KEYS, FACT_COLUMNS


def fact_match_stats(silver: DataFrame) -> DataFrame:
    """One row per match with points and goal difference (no shuffle)."""
    derived = {
        "home_team_points": team_points(F.col("match_result"), HOME_WIN),
        "away_team_points": team_points(F.col("match_result"), AWAY_WIN),
        "goal_difference": goal_difference(F.col("home_goals"), F.col("away_goals")),
    }
    return silver.withColumns(derived).select(*FACT_COLUMNS)


def _team_roles(silver: DataFrame, *extra: str) -> DataFrame:
    """Home and away sides as (team_id, team_name, league_id, league_name, season),
    both made from one read of a match."""
    def side(role: str):
        return F.struct(F.col(f"{role}_team_id").alias("team_id"),
                        F.col(f"{role}_team_name").alias("team_name"),
                        *[F.col(c) for c in ("league_id", "league_name", "season", *extra)])
    return silver.select(F.inline(F.array(side("home"), side("away"))))


def team_appearances(silver: DataFrame) -> DataFrame:
    """UNION ALL of both roles, one row per (match, side)."""
    return _team_roles(silver)


def dim_team_distinct(silver: DataFrame) -> DataFrame:
    """Distinct teams at the 5-column grain (partial + final aggregate)."""
    return _team_roles(silver).distinct()


def dim_team(silver: DataFrame) -> DataFrame:
    """One row per (team_id, season), the dimension's key.

    A team seen in two leagues in a season has two distinct rows at the
    5-column grain; the key keeps the one from its latest match (then the
    higher match id, then the higher league id), so an upsert on the key
    never meets two source rows.
    """
    roles = _team_roles(silver, "match_date", "match_id")
    latest = latest_per_key(roles, DIM_TEAM_KEYS, ["match_date", "match_id", "league_id"])
    return latest.select(*DIM_TEAM_COLUMNS)


def dim_date(silver: DataFrame) -> DataFrame:
    """Distinct match dates with calendar attributes (bounded by the calendar)."""
    dates = silver.select(F.col("match_date").alias("date")).distinct()
    return dates.withColumns(date_attributes(F.col("date"))).select(*DIM_DATE_COLUMNS)


def league_season_summary(fact: DataFrame) -> DataFrame:
    """Matches, goals and average goals per (league, season), ordered."""
    return (fact.groupBy("league_id", "season")
            .agg(F.count("match_id").alias("total_matches"),
                 F.sum("total_goals").alias("total_goals"),
                 F.avg("total_goals").alias("avg_goals_per_match"))
            .orderBy("league_id", "season"))


def summary_parts(fact: DataFrame) -> DataFrame:
    """Matches and goals per (league, season): parts that add up, to be kept and merged."""
    return fact.groupBy("league_id", "season").agg(
        F.count("match_id").alias("matches"), F.count("total_goals").alias("scored"),
        F.sum("total_goals").alias("goals"))


def merged_summary(parts: DataFrame, by: Sequence[str] = ("league_id", "season")) -> DataFrame:
    """Kept parts as a summary at the grain ``by`` (the league-season summary, or coarser)."""
    return parts.groupBy(*by).agg(
        F.sum("matches").alias("total_matches"), F.sum("goals").alias("total_goals"),
        (F.sum("goals") / F.nullif(F.sum("scored"), F.lit(0))).alias("avg_goals_per_match")
    ).orderBy(*by)
