"""Column expressions: every function takes and returns ``Column``s and stays
inside whole-stage codegen (no Python UDFs)."""

from laketier.functions.audit import audit_columns, layer_processed_at
from laketier.functions.dates import date_attributes
from laketier.functions.match import (
    goal_difference,
    match_result,
    standard_status,
    team_points,
)

__all__ = [
    "audit_columns", "layer_processed_at", "date_attributes", "goal_difference",
    "match_result", "standard_status", "team_points",
]
