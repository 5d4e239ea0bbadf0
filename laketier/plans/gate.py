"""The quality gate in proportion to what a run changed.

Counts of the value rules add up over partitions, so they are kept for each silver
partition in a small append-only table (one row for each partition and evaluation that
found it written since); a run counts those partitions, and sums the latest counts. The uniqueness rule asks the table's key index (``sinks/key_index.py``),
which reads those partitions alone. Other rules start a table of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from laketier.operators import quality as Q
from laketier.session import together
from laketier.sinks import key_index, tables


def evaluate_changed(spark: SparkSession, table: str, state: str,
                     rules: Sequence[Q.Rule] = Q.SILVER_SUITE) -> list[dict]:
    """Result rows of ``rules`` on the partitioned table at ``table``, by rule id; equal to
    ``quality.evaluate`` on all of it. ``state`` is the folder of the kept counts."""
    whole = tables.read_table(spark, table)
    total, unique = together(spark, lambda: _totals(spark, table, state, rules),
                             lambda: _uniqueness(spark, table, rules))
    out = []
    for r in sorted(rules, key=lambda r: r.rule_id):
        ev = un = None
        if r.expectation_type == Q.UNIQUE and r.column in whole.columns:
            ev, un = unique[r.rule_id]
        elif r.expectation_type in Q.ADDITIVE and (not r.column or r.column in whole.columns):
            ev, un = total.get(f"e{r.rule_id}", 0), total.get(f"u{r.rule_id}", 0)
        out.append(Q.result(r, whole.columns, ev, un))
    return out


def _totals(spark: SparkSession, table: str, state: str, rules: Sequence[Q.Rule]) -> dict:
    """Counts of the value rules over all partitions, by field of ``counts_by``."""
    kept = f"{state.rstrip('/')}/{hashlib.sha256(repr(list(rules)).encode()).hexdigest()[:16]}"
    parts = tables.table_schema(spark, table)[1]
    known = spark.read.parquet(kept) if tables.exists(spark, kept) else None
    since = known.agg(F.max("version")).first()[0] if known is not None else 0
    changed, version = tables.changes(spark, table, since)
    counted = Q.counts_by(tables.read_partitions(spark, table, changed), rules,
                          [tables.partition_key(parts).alias("partition")])
    fields = [c for c in counted.columns if c != "partition"]
    if changed or known is None:
        (tables.partition_rows(spark, changed).join(counted, "partition", "left")
         .fillna(0, fields).withColumn("version", F.lit(version).cast("bigint"))  # emptied: 0
         .write.mode("append").parquet(kept))
    latest = spark.read.parquet(kept).groupBy("partition").agg(
        *[F.max_by(f, "version").alias(f) for f in fields])
    return latest.agg(*[F.coalesce(F.sum(f), F.lit(0)).alias(f) for f in fields]
                      ).first().asDict() if fields else {}


def _uniqueness(spark: SparkSession, table: str, rules: Sequence[Q.Rule]) -> dict:
    """Evaluated and unexpected rows of each uniqueness rule, by rule id."""
    whole, parts, out = tables.read_table(spark, table), tables.table_schema(spark, table)[1], {}
    for r in rules:
        if r.expectation_type == Q.UNIQUE and r.column in whole.columns:
            if key_index.indexable(whole.schema, parts, [r.column]):
                out[r.rule_id] = key_index.copies(spark, table, r.column)
            else:
                row = Q.evaluate(whole, [r]).first()
                out[r.rule_id] = row["evaluated"], row["unexpected"]
    return out
