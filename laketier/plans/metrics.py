"""Stage metrics: row counts and schemas per pipeline stage.

``observe`` attaches a count to a DataFrame that is computed by the action
that writes it, so a run learns its stage sizes without extra jobs.
``stage_report`` is the table of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


def observe_rows(df: DataFrame, stage: str, where: Column | None = None
                 ) -> tuple[DataFrame, Observation]:
    """Count rows of ``df``, all or those ``where`` holds, as a side effect of the next
    action on it."""
    obs = Observation(stage)
    counted = F.count(F.lit(1)) if where is None else F.count_if(where)
    return df.observe(obs, counted.alias("rows")), obs


def observed_rows(obs: Observation) -> int:
    """Row count of an observed write. When the input was empty, AQE may
    prune the plan to an empty relation together with the metrics node; the
    observation then has no row, and the count is 0."""
    from py4j.protocol import Py4JJavaError

    try:
        return int(obs.get.get("rows", 0))
    except Py4JJavaError as e:
        if "AssertionError" in str(e.java_exception.getClass()):
            return 0
        raise


def stage_report(spark: SparkSession, stages: list[tuple[str, Observation, DataFrame]]
                 ) -> DataFrame:
    """``(stage, rows, columns)`` of observed stages, after the write that fills them."""
    return spark.createDataFrame([(name, observed_rows(obs), len(df.columns))
                                  for name, obs, df in stages],
                                 "stage string, rows bigint, columns int")


SCHEMA_ROWS = "stage string, position int, column string, type string"


def schema_rows(spark: SparkSession, stages: dict[str, DataFrame]) -> DataFrame:
    """One row per column of every stage."""
    return spark.createDataFrame(
        [(stage, i, name, kind) for stage, df in stages.items()
         for i, (name, kind) in enumerate(df.dtypes)], SCHEMA_ROWS)


def schema_drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns that are not as they were: (stage, column, change, type_before, type_after),
    ``change`` being added, removed, retyped or moved (its place among the columns that
    both have). A stage that only one side knows has no drift."""
    both = before.select("stage").distinct().join(after.select("stage").distinct(), "stage")
    key = ["stage", "column"]

    def side(rows, name, other):
        order = Window.partitionBy("stage").orderBy("position")
        shared = rows.join(other.select(*key), key, "left_semi").select(
            *key, F.row_number().over(order).alias(f"place_{name}"))
        return (rows.join(both, "stage", "left_semi").select(*key, F.col("type").alias(f"type_{name}"))
                .join(shared, key, "left"))
    joined = side(before, "before", after).join(side(after, "after", before), key, "full_outer")
    change = (F.when(F.col("type_before").isNull(), "added")
              .when(F.col("type_after").isNull(), "removed")
              .when(F.col("type_before") != F.col("type_after"), "retyped")
              .when(F.col("place_before") != F.col("place_after"), "moved"))
    return (joined.withColumn("change", change).where("change IS NOT NULL")
            .select(*key, "change", "type_before", "type_after"))
