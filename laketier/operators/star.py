"""Star-schema joins over the gold tables.

Reports aggregate the fact to the dimension's key *before* joining: the
partial aggregate collapses a hot key map-side, and what meets the
dimension is one row per key, so the join is small whatever the fact size.
Nothing is hinted: Spark broadcasts a dimension whose size it knows to be
within its threshold, when planning (written tables) or at run time (AQE).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_dates(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """fact LEFT JOIN dim_date ON match_date = date (row level)."""
    return fact.join(dim_date, fact["match_date"] == dim_date["date"], "left").drop("date")


def with_team_names(fact: DataFrame, dim_team: DataFrame) -> DataFrame:
    """Role-playing joins: the team dimension once as home, once as away."""
    t = dim_team.select("team_id", "season", "team_name")
    home = t.select(F.col("team_id").alias("home_team_id"), "season",
                    F.col("team_name").alias("home_team_name"))
    away = t.select(F.col("team_id").alias("away_team_id"), "season",
                    F.col("team_name").alias("away_team_name"))
    return (fact.join(home, ["home_team_id", "season"], "left")
            .join(away, ["away_team_id", "season"], "left"))


def goals_by_weekday(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Matches and goals per ``day_name`` (NULL for dates absent from the dimension)."""
    per_date = fact.groupBy("match_date").agg(
        F.count(F.lit(1)).alias("matches"), F.sum("total_goals").alias("goals"))
    joined = per_date.join(dim_date, per_date["match_date"] == dim_date["date"], "left")
    return joined.groupBy("day_name").agg(
        F.sum("matches").alias("matches"), F.sum("goals").alias("total_goals"))


def team_table(fact: DataFrame, dim_team: DataFrame) -> DataFrame:
    """League table by team name: matches, points, goals for and against,
    counting home and away appearances (role-playing dimension). One pass over
    the fact, one aggregate, one join."""
    def role(side: str, other: str):
        return F.struct(F.col(f"{side}_team_id").alias("team_id"), F.col("season"),
                        F.col(f"{side}_team_points").alias("points"),
                        F.col(f"{side}_goals").alias("goals_for"),
                        F.col(f"{other}_goals").alias("goals_against"))

    sums = ("matches", "points", "goals_for", "goals_against")
    both = fact.select(F.inline(F.array(role("home", "away"), role("away", "home"))))
    per_key = both.groupBy("team_id", "season").agg(
        F.count(F.lit(1)).alias("matches"), *[F.sum(c).alias(c) for c in sums[1:]])
    named = per_key.join(dim_team.select("team_id", "season", "team_name"), ["team_id", "season"],
                         "left")
    return named.groupBy("team_name").agg(*[F.sum(c).alias(c) for c in sums])


def orphans(fact: DataFrame, dim_team: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Fact rows whose dimension key is missing: ``(match_id, missing)`` with
    ``missing`` in home_team / away_team / date. Empty when the star is whole.

    What is missing is found among the *distinct* keys of the fact (a hot key is
    one row after the partial aggregate, both team roles are read in one pass) and
    joined back to the fact: few rows, none in a whole star. NULL keys never match
    a dimension row and count as missing.
    """
    def role(side: str):
        return F.struct(F.col(f"{side}_team_id").alias("team_id"), F.col("season"))

    teams = (fact.select(F.inline(F.array(role("home"), role("away")))).distinct()
             .join(dim_team.select("team_id", "season"), ["team_id", "season"], "left_anti"))
    dates = (fact.select("match_date").distinct()
             .join(dim_date.select(F.col("date").alias("match_date")), "match_date", "left_anti"))
    out, flags = fact, []
    for label, missing, keys in (("home_team", teams, ("home_team_id", "season")),
                                 ("away_team", teams, ("away_team_id", "season")),
                                 ("date", dates, ("match_date",))):
        own = [f"_{label}_{i}" for i in range(len(keys))]
        gone = missing.select(*[F.col(c).alias(o) for c, o in zip(missing.columns, own)],
                              F.lit(label).alias(f"_{label}"))
        same = [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, own)]
        out = out.join(gone, same, "left")
        flags.append(F.col(f"_{label}"))
    return out.select("match_id", F.explode(F.array_compact(F.array(*flags))).alias("missing"))
