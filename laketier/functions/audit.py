"""Audit columns stamped by each layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: version tag written by the generic audit helper.
PIPELINE_VERSION = "1.0.0"


def layer_processed_at(layer: str) -> tuple[str, Column]:
    """``_<layer>_processed_at``; one value per query, not per row."""
    return f"_{layer}_processed_at", F.current_timestamp()


def audit_columns(df: DataFrame, layer: str, version: str = PIPELINE_VERSION) -> DataFrame:
    name, stamp = layer_processed_at(layer)
    return df.withColumns({name: stamp, "_pipeline_version": F.lit(version)})
