"""Declarative data-quality rules evaluated as Spark aggregates.

All column-value rules and the row count of one table are computed in a
single aggregation (partial aggregates per task, one tiny final merge). A
uniqueness rule needs its own group-by on the column, with map-side partial
counts so a hot value is collapsed before the shuffle. The result is one row
per rule; the gate collects those rows (bounded by the rule count, never by
the data) and stops the run on a failed CRITICAL rule.

Semantics of the rule types (those of the expectation library the suite was
written for): NULLs are neither evaluated nor unexpected, except for the
not-null rule which evaluates every row; a rule passes when
``(evaluated - unexpected) / evaluated >= mostly`` (default 1.0) or nothing
was evaluated; every copy of a duplicated value is unexpected; a missing
column fails its rules.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

CRITICAL, WARNING = "CRITICAL", "WARNING"

EXISTS = "expect_column_to_exist"
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"
ROW_COUNT = "expect_table_row_count_to_be_between"
REGEX = "expect_column_values_to_match_regex"
RULE_TYPES = (EXISTS, NOT_NULL, UNIQUE, BETWEEN, IN_SET, ROW_COUNT, REGEX)

RESULT_SCHEMA = ("rule_id INT, expectation_type STRING, column STRING, severity STRING, "
                 "evaluated BIGINT, unexpected BIGINT, success BOOLEAN")


@dataclass(frozen=True)
class Rule:
    rule_id: int
    expectation_type: str
    column: str | None = None
    severity: str = WARNING
    mostly: float = 1.0
    min_value: float | None = None
    max_value: float | None = None
    value_set: tuple = field(default_factory=tuple)
    regex: str | None = None

    def __post_init__(self):
        if self.expectation_type not in RULE_TYPES:
            raise ValueError(f"unsupported rule type {self.expectation_type}")


# The silver table's suite, in its original order
# (rule type, column, arguments, severity).
SILVER_SUITE: list[Rule] = [
    Rule(1, EXISTS, "match_id", CRITICAL),
    Rule(2, NOT_NULL, "match_id", CRITICAL, mostly=1.0),
    Rule(3, UNIQUE, "match_id", CRITICAL),
    Rule(4, EXISTS, "match_date", CRITICAL),
    Rule(5, NOT_NULL, "match_date", CRITICAL, mostly=1.0),
    Rule(6, BETWEEN, "home_goals", WARNING, mostly=0.999, min_value=0, max_value=20),
    Rule(7, BETWEEN, "away_goals", WARNING, mostly=0.999, min_value=0, max_value=20),
    Rule(8, NOT_NULL, "home_team_id", CRITICAL, mostly=1.0),
    Rule(9, NOT_NULL, "away_team_id", CRITICAL, mostly=1.0),
    Rule(10, IN_SET, "match_result", CRITICAL,
         value_set=("HOME_WIN", "AWAY_WIN", "DRAW", "UNKNOWN")),
    Rule(11, IN_SET, "match_status", WARNING,
         value_set=("FINISHED", "NOT_STARTED", "LIVE", "POSTPONED", "CANCELLED")),
    Rule(12, NOT_NULL, "league_id", CRITICAL, mostly=1.0),
    Rule(13, BETWEEN, "season", WARNING, min_value=2020, max_value=2030),
    Rule(14, ROW_COUNT, None, WARNING, min_value=1, max_value=100000),
    Rule(15, REGEX, "match_date", CRITICAL, mostly=1.0, regex=r"^\d{4}-\d{2}-\d{2}$"),
]


def load_suite(spark: SparkSession, path: str) -> list[Rule]:
    """Read a suite file, wherever Spark reads from: ``{"expectations":
    [{expectation_type, kwargs, meta}]}``."""
    doc = json.loads(spark.read.text(path, wholetext=True).first()[0])
    rules = []
    for i, exp in enumerate(doc["expectations"], start=1):
        kw = exp.get("kwargs", {})
        rules.append(Rule(
            rule_id=i,
            expectation_type=exp["expectation_type"],
            column=kw.get("column"),
            severity=exp.get("meta", {}).get("severity", WARNING),
            mostly=float(kw.get("mostly", 1.0)),
            min_value=kw.get("min_value"),
            max_value=kw.get("max_value"),
            value_set=tuple(kw.get("value_set", ())),
            regex=kw.get("regex"),
        ))
    return rules


def _range_violation(c: Column, lo, hi) -> Column:
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (c < F.lit(lo))
    if hi is not None:
        cond = cond | (c > F.lit(hi))
    return cond


def _unexpected(rule: Rule, c: Column) -> Column:
    """Predicate that marks a non-NULL value as unexpected (NULL stays NULL)."""
    if rule.expectation_type == BETWEEN:
        return _range_violation(c, rule.min_value, rule.max_value)
    if rule.expectation_type == IN_SET:
        return ~c.isin(list(rule.value_set))
    if rule.expectation_type == REGEX:
        return ~c.cast("string").rlike(rule.regex)
    raise AssertionError(rule.expectation_type)


def _passes(rule: Rule, evaluated: Column, unexpected: Column) -> Column:
    return (evaluated == 0) | (
        (evaluated - unexpected) / evaluated >= F.lit(float(rule.mostly)))


def _row(rule: Rule, evaluated: Column, unexpected: Column, success: Column) -> Column:
    return F.struct(
        F.lit(rule.rule_id).cast("int").alias("rule_id"),
        F.lit(rule.expectation_type).alias("expectation_type"),
        F.lit(rule.column).cast("string").alias("column"),
        F.lit(rule.severity).alias("severity"),
        evaluated.cast("bigint").alias("evaluated"),
        unexpected.cast("bigint").alias("unexpected"),
        success.alias("success"),
    )


def _null_bigint() -> Column:
    return F.lit(None).cast("bigint")


def evaluate(df: DataFrame, rules: Sequence[Rule] = SILVER_SUITE) -> DataFrame:
    """One result row per rule (schema ``RESULT_SCHEMA``), ordered by rule id."""
    spark = df.sparkSession
    present = set(df.columns)
    aggs: list[Column] = []
    rows: list[Column] = []          # rows computed from the single aggregate
    constant_rows: list[Column] = []  # rows known without reading data
    unique_parts: list[DataFrame] = []

    for r in rules:
        i = r.rule_id
        if r.expectation_type == EXISTS:
            constant_rows.append(_row(r, _null_bigint(), _null_bigint(),
                                      F.lit(r.column in present)))
            continue
        if r.expectation_type == ROW_COUNT:
            aggs.append(F.count(F.lit(1)).alias(f"e{i}"))
            n = F.col(f"e{i}")
            ok = F.lit(True)
            if r.min_value is not None:
                ok = ok & (n >= F.lit(r.min_value))
            if r.max_value is not None:
                ok = ok & (n <= F.lit(r.max_value))
            rows.append(_row(r, n, _null_bigint(), ok))
            continue
        if r.column not in present:
            constant_rows.append(_row(r, _null_bigint(), _null_bigint(), F.lit(False)))
            continue
        c = F.col(r.column)
        if r.expectation_type == UNIQUE:
            n = F.col("__copies")
            counts = df.where(c.isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("__copies"))
            part = counts.agg(
                F.coalesce(F.sum(n), F.lit(0)).alias("ev"),
                F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).alias("un"))
            unique_parts.append(part.select(
                _row(r, F.col("ev"), F.col("un"), _passes(r, F.col("ev"), F.col("un")))
                .alias("r")).select("r.*"))
            continue
        if r.expectation_type == NOT_NULL:
            aggs += [F.count(F.lit(1)).alias(f"e{i}"), F.count_if(c.isNull()).alias(f"u{i}")]
        else:
            aggs += [F.count(c).alias(f"e{i}"), F.count_if(_unexpected(r, c)).alias(f"u{i}")]
        ev, un = F.col(f"e{i}"), F.col(f"u{i}")
        rows.append(_row(r, ev, un, _passes(r, ev, un)))

    parts: list[DataFrame] = []
    if rows:
        parts.append(df.agg(*aggs).select(F.inline(F.array(*rows))))
    if constant_rows:
        parts.append(spark.range(1).select(F.inline(F.array(*constant_rows))))
    parts += unique_parts
    if not parts:
        return spark.createDataFrame([], RESULT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("rule_id")


ADDITIVE = (NOT_NULL, BETWEEN, IN_SET, REGEX, ROW_COUNT)


def counts_by(df: DataFrame, rules: Sequence[Rule], by: Sequence[Column]) -> DataFrame:
    """Evaluated (``e<id>``) and unexpected (``u<id>``) rows of every additive rule on
    a present column, per group: counts of parts add up to those of the whole."""
    aggs = []
    for r in rules:
        if r.expectation_type not in ADDITIVE or (r.column and r.column not in df.columns):
            continue
        c = F.col(r.column) if r.column else None
        if r.expectation_type == ROW_COUNT:
            pair = F.count(F.lit(1)), F.lit(0)
        elif r.expectation_type == NOT_NULL:
            pair = F.count(F.lit(1)), F.count_if(c.isNull())
        else:
            pair = F.count(c), F.count_if(_unexpected(r, c))
        aggs += [x.cast("bigint").alias(f"{n}{r.rule_id}") for n, x in zip("eu", pair)]
    return df.groupBy(*by).agg(*aggs)


def result(rule: Rule, columns: Sequence[str], evaluated: int | None, unexpected: int | None
           ) -> dict:
    """The result row of one rule from its counts."""
    out = {"rule_id": rule.rule_id, "expectation_type": rule.expectation_type,
           "column": rule.column, "severity": rule.severity, "evaluated": None, "unexpected": None}
    if rule.expectation_type == EXISTS or (rule.column and rule.column not in columns):
        return {**out, "success": rule.expectation_type == EXISTS and rule.column in columns}
    if rule.expectation_type == ROW_COUNT:
        ok = ((rule.min_value is None or evaluated >= rule.min_value)
              and (rule.max_value is None or evaluated <= rule.max_value))
        return {**out, "evaluated": evaluated, "success": ok}
    ok = evaluated == 0 or (evaluated - unexpected) / evaluated >= rule.mostly
    return {**out, "evaluated": evaluated, "unexpected": unexpected, "success": ok}


def gate_actions(results: DataFrame, fail_on: Sequence[str] = (CRITICAL,)) -> DataFrame:
    """Result rows with the gate's decision: ``stop`` (failed, blocking),
    ``warn`` (failed, logged) or ``pass``."""
    return results.withColumn(
        "action", F.when(F.col("success"), F.lit("pass"))
        .when(F.col("severity").isin(list(fail_on)), F.lit("stop")).otherwise(F.lit("warn")))


class QualityGateError(RuntimeError):
    def __init__(self, failed: list[dict]):
        self.failed = failed
        names = ", ".join(f"#{f['rule_id']} {f['expectation_type']}({f['column']})" for f in failed)
        super().__init__(f"critical data-quality rules failed: {names}")


def gate(results: DataFrame | Iterable, fail_on: Sequence[str] = (CRITICAL,)) -> list[dict]:
    """Stop the run when a rule of a ``fail_on`` severity failed; log the rest.

    Collects the result rows, whose number is the number of rules.
    """
    rows = [r.asDict() for r in (results.collect() if isinstance(results, DataFrame) else results)]
    failed = [r for r in rows if not r["success"] and r["severity"] in fail_on]
    for r in rows:
        if not r["success"] and r["severity"] not in fail_on:
            log.warning("data-quality %s failed: %s(%s) %s/%s unexpected", r["severity"],
                        r["expectation_type"], r["column"], r["unexpected"], r["evaluated"])
    if failed:
        raise QualityGateError(failed)
    return rows
