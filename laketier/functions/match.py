"""Match-level scalar rules: status names, result, points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Short status codes of the source API and the names silver
# stores for them. Any other code passes through unchanged.
STATUS_NAMES = {"FT": "FINISHED", "NS": "NOT_STARTED", "LIVE": "LIVE"}
FINISHED = "FINISHED"

# Match outcomes and league points.
HOME_WIN, AWAY_WIN, DRAW, UNKNOWN = "HOME_WIN", "AWAY_WIN", "DRAW", "UNKNOWN"
WIN_POINTS, DRAW_POINTS, LOSS_POINTS = 3, 1, 0


def standard_status(code: Column) -> Column:
    expr = None
    for short, name in STATUS_NAMES.items():
        expr = (F.when(code == short, F.lit(name)) if expr is None
                else expr.when(code == short, F.lit(name)))
    return expr.otherwise(code)


def match_result(home_goals: Column, away_goals: Column) -> Column:
    """Outcome from full-time goals; UNKNOWN only when a side is NULL."""
    return (F.when(home_goals > away_goals, F.lit(HOME_WIN))
            .when(home_goals < away_goals, F.lit(AWAY_WIN))
            .when(home_goals == away_goals, F.lit(DRAW))
            .otherwise(F.lit(UNKNOWN)))


def team_points(result: Column, win_label: str) -> Column:
    """League points for the side whose win is ``win_label``."""
    return (F.when(result == win_label, F.lit(WIN_POINTS))
            .when(result == DRAW, F.lit(DRAW_POINTS))
            .otherwise(F.lit(LOSS_POINTS)))


def goal_difference(home_goals: Column, away_goals: Column) -> Column:
    return home_goals - away_goals
