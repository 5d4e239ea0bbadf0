"""Latest row per key.

Expressed as ``row_number() = 1`` over a key window. Spark plans this as a
*partial* WindowGroupLimit before the shuffle and a final one after it, so
each map task forwards at most one row per key: a key holding a third of all
rows is cut down map-side and never lands whole in one reduce task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def _ordering(order: Sequence[str | Column]) -> list[Column]:
    """Strings mean "newest first" (descending, NULLs last)."""
    return [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep one row per ``keys``: the first under ``order``.

    ``order`` must be a total order within a key (add tie-breakers), otherwise
    the survivor may differ between runs and between a task and its retry.
    NULL keys form one group, so at most one NULL-key row survives.
    """
    if not order:
        raise ValueError("latest_per_key needs an ordering")
    w = Window.partitionBy(*keys).orderBy(*_ordering(order))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)
