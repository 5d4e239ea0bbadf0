"""The layer jobs and the daily run: bronze -> silver -> quality gate -> gold.

Each job reads tables, builds one lazy plan per output and writes it; the
written tables are the lineage cuts between jobs. Stage row counts ride on
the writes (``observe``) instead of separate ``count()`` jobs.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from laketier import schemas as S
from laketier.operators import gold, quality, silver
from laketier.operators.reconcile import request_report
from laketier.plans.gate import evaluate_changed
from laketier.plans.metrics import SCHEMA_ROWS, observe_rows, observed_rows, schema_drift, schema_rows
from laketier.session import together
from laketier.sinks import layout, tables
from laketier.sources import landing

log = logging.getLogger(__name__)
LOGGED = 100  # incomplete requests that are logged one by one


@dataclass(frozen=True)
class Lake:
    """Table locations under one base folder."""
    base: str
    sport: str = "football"

    def _p(self, *parts: str) -> str:
        return "/".join([self.base.rstrip("/"), *parts])

    @property
    def bronze(self) -> str:
        return self._p("bronze", self.sport)

    @property
    def quarantine(self) -> str:
        return self._p("bronze", f"_quarantine_{self.sport}")

    @property
    def silver(self) -> str:
        return self._p("silver", self.sport, "matches")

    def gold(self, table: str) -> str:
        return self._p("gold", table)

    @property
    def schemas(self) -> str:
        return self._p("_schemas", self.sport)

    @property
    def gate(self) -> str:
        return self._p("_gate", self.sport)

    @property
    def run_log(self) -> str:
        return self._p("_run_log")


def _stamp(df: DataFrame, layer: str) -> DataFrame:
    return df.withColumn(f"_{layer}_processed_at", F.current_timestamp())


def ingest_bronze(spark: SparkSession, landing_base: str, lake: Lake, ingest_date: str,
                  shape: str = landing.ENVELOPE_SHAPE) -> dict:
    """Landed JSON of one ingest date -> appended bronze rows (+ quarantine).

    Each output reads the landing folder itself: the second read is cheaper than a
    copy of all that has landed, and the quarantine keeps next to nothing of it.
    """
    raw = landing.read_landed(spark, landing.landing_path(landing_base, lake.sport, ingest_date),
                              shape)
    found = landing.fixture_rows(raw, shape)
    rows = landing.with_bronze_audit(found.where(landing.identified()), ingest_date, lake.sport)
    rows, obs = observe_rows(rows, "bronze")
    bad = (landing.unusable_records(raw) if shape == landing.RECORDS_SHAPE else
           landing.corrupt_rows(raw, shape).unionByName(landing.unidentified_rows(found)))
    bad = bad.withColumns({"_ingest_date": F.lit(ingest_date), "_ingest_timestamp": F.current_timestamp()})
    bad, bad_obs = observe_rows(bad, "quarantine")
    # a run's rows are of one partition, and the scan packs small files: no shuffle
    steps = [lambda: tables.append(rows, lake.bronze, S.BRONZE_PARTITIONS, balance=False),
             lambda: tables.append(bad, lake.quarantine, ["_ingest_date"])]
    if shape == landing.ENVELOPE_SHAPE:
        steps.append(lambda: incomplete_requests(raw))
    incomplete = together(spark, *steps)[2:]
    return {"bronze": observed_rows(obs), "quarantined": observed_rows(bad_obs),
            **({"incomplete_requests": incomplete[0]} if incomplete else {})}


def incomplete_requests(raw: DataFrame) -> int:
    """How many API requests did not arrive whole; each is logged."""
    found = request_report(raw).where("NOT complete").limit(LOGGED + 1).collect()
    for r in found[:LOGGED]:
        log.warning("incomplete request %s", r.asDict())
    return len(found) if len(found) <= LOGGED else request_report(raw).where("NOT complete").count()


def read_bronze(spark: SparkSession, lake: Lake, ingest_date: str | None = None) -> DataFrame:
    """Bronze rows; with a date, only that date's folder is listed and only
    its file footers are merged into the schema (not the whole history)."""
    if ingest_date is None:
        return tables.read_appended(spark, lake.bronze, string_partitions=["_ingest_date"])
    return tables.read_appended(spark, lake.bronze, string_partitions=["_ingest_date"],
                                partition={"_ingest_date": ingest_date})


def build_silver(spark: SparkSession, lake: Lake, ingest_date: str,
                 tie_breakers: Sequence[str] = silver.DEFAULT_TIE_BREAKERS) -> dict:
    """Today's bronze partition -> latest finished version per match -> upsert."""
    ready = silver.silver_matches(read_bronze(spark, lake, ingest_date), tie_breakers)
    ready, obs = observe_rows(ready, "silver_batch")
    version = tables.upsert_table(ready, lake.silver, S.SILVER_KEYS, S.SILVER_PARTITIONS)
    return {"silver_batch": observed_rows(obs), "silver_version": version}


def check_silver(spark: SparkSession, lake: Lake,
                 rules: Sequence[quality.Rule] = quality.SILVER_SUITE) -> list[dict]:
    """Quality gate on the merged silver table; raises on a failed CRITICAL rule. Only
    the partitions written since the last gate are evaluated."""
    results = evaluate_changed(spark, lake.silver, lake.gate, rules)
    return quality.gate([Row(**r) for r in results])


def build_gold(spark: SparkSession, lake: Lake) -> dict:
    """Silver -> dim_team, dim_date (upserted), fact_match_stats (refreshed),
    each from the silver partitions written since it was last built.

    The fact is a row-wise projection of silver partitioned the same way, and
    silver never loses a match, so rebuilding exactly the fact partitions
    whose silver partition changed keeps it equal to ``fact(silver)``.
    ``dim_date`` needs the dates of the changed partitions; ``dim_team``
    (latest match per team and season) needs every match of the seasons those
    partitions cover, NULL being a season like others. Neither dimension ever
    drops a key, so upserting the recomputed keys equals recomputing from all of
    silver. Each day's gold work is proportional to what that day touched.
    """
    made = together(spark, lambda: refresh_dim_date(spark, lake),
                    lambda: refresh_dim_team(spark, lake),
                    lambda: {**refresh_fact(spark, lake), **refresh_summary(spark, lake)})
    return {name: value for part in made for name, value in part.items()}


def refresh_dim_date(spark: SparkSession, lake: Lake) -> dict:
    path = lake.gold("dim_date")
    changed, last = tables.changes(spark, lake.silver, tables.seen(spark, path))
    if not changed:
        return {}
    rows = gold.dim_date(tables.read_partitions(spark, lake.silver, changed))
    version = tables.upsert_table(_stamp(rows, "gold"), path, S.DIM_DATE_KEYS, null_safe=True)
    tables.note_seen(spark, path, last)
    return {"dim_date_version": version}


def refresh_dim_team(spark: SparkSession, lake: Lake) -> dict:
    path = lake.gold("dim_team")
    changed, last = tables.changes(spark, lake.silver, tables.seen(spark, path))
    if not changed:
        return {}
    seasons = {json.dumps({k: v for k, v in json.loads(key).items() if k == "season"},
                          separators=(",", ":")) for key in changed}
    rows = gold.dim_team(tables.read_partitions(spark, lake.silver, seasons, by=["season"]))
    version = tables.upsert_table(_stamp(rows, "gold"), path, S.DIM_TEAM_KEYS, null_safe=True)
    tables.note_seen(spark, path, last)
    return {"dim_team_version": version}


def refresh_fact(spark: SparkSession, lake: Lake) -> dict:
    path = lake.gold("fact_match_stats")
    changed, last = tables.changes(spark, lake.silver, tables.seen(spark, path))
    if not changed:
        return {"fact_partitions_rebuilt": 0}
    rows = _stamp(gold.fact_match_stats(tables.read_partitions(spark, lake.silver, changed)),
                  "gold")
    # both are partitioned by the same columns, so a partition has the same key in both
    version = tables.replace_partitions(rows, path, S.FACT_PARTITIONS, changed)
    tables.note_seen(spark, path, last)
    return {"fact_version": version, "fact_partitions_rebuilt": len(changed)}


def refresh_summary(spark: SparkSession, lake: Lake) -> dict:
    """Kept parts of the league-season summary, counted anew for the fact partitions
    written since; the summary's grain is the fact's partitioning."""
    fact, path = lake.gold("fact_match_stats"), lake.gold("summary_parts")
    changed, last = tables.changes(spark, fact, tables.seen(spark, path))
    if not changed:
        return {}
    parts = gold.summary_parts(tables.read_partitions(spark, fact, changed))
    version = tables.replace_partitions(parts, path, S.FACT_PARTITIONS, changed)
    tables.note_seen(spark, path, last)
    return {"summary_version": version}


def league_summary(spark: SparkSession, lake: Lake,
                   by: Sequence[str] = ("league_id", "season")) -> DataFrame:
    """The summary from its kept parts, without a look at the fact."""
    return gold.merged_summary(tables.read_table(spark, lake.gold("summary_parts")), by)


def note_schemas(spark: SparkSession, lake: Lake, run_id: str,
                 ingest_date: str | None = None) -> list[dict]:
    """Keep the schemas of this run's tables; return and log what changed since the run
    before (one row a column). With a date, bronze is that date's rows, so that columns
    that no longer arrive are seen too, and the history's footers are not read."""
    stages = {"bronze": read_bronze(spark, lake, ingest_date), "silver": tables.read_table(spark, lake.silver),
              "fact_match_stats": tables.read_table(spark, lake.gold("fact_match_stats"))}
    now, drift = schema_rows(spark, stages), []
    if tables.exists(spark, lake.schemas):
        kept = spark.read.schema(f"{SCHEMA_ROWS}, run_id string, noted_at timestamp").parquet(lake.schemas)
        last = kept.groupBy().agg(F.max_by("run_id", "noted_at").alias("run_id"))
        drift = [r.asDict() for r in schema_drift(kept.join(last, "run_id"), now).collect()]
    for row in drift:
        log.warning("schema drift %s", row)
    (now.withColumns({"run_id": F.lit(run_id), "noted_at": F.current_timestamp()}).coalesce(1)
     .write.mode("append").parquet(lake.schemas))
    return drift


def register_all(spark: SparkSession, lake: Lake, prefix: str = "analytics") -> list[str]:
    """Catalog entries ``<prefix>_<layer>.<table>`` for bronze, silver and gold."""
    names = [layout.register_table(spark, f"{prefix}_bronze", f"{lake.sport}_raw",
                                   lake.bronze, S.BRONZE_PARTITIONS),
             layout.register_table(spark, f"{prefix}_silver", f"{lake.sport}_matches",
                                   lake.silver)]
    for t in ("dim_team", "dim_date", "fact_match_stats"):
        names.append(layout.register_table(spark, f"{prefix}_gold", t, lake.gold(t)))
    return names


def maintain_layout(spark: SparkSession, lake: Lake) -> dict:
    """Periodic compaction + clustering (not part of every run)."""
    return {
        "silver_partitions_laid_out": layout.rewrite_layout(
            spark, lake.silver, ["match_date", "home_team_id"]),
        "fact_partitions_laid_out": layout.rewrite_layout(
            spark, lake.gold("fact_match_stats"), ["match_date", "home_team_id"]),
    }


RUN_LOG_SCHEMA = ("pipeline_name STRING, run_id STRING, execution_date STRING, status STRING, "
                  "stage STRING, rows BIGINT, logged_at TIMESTAMP")


def log_run(spark: SparkSession, lake: Lake, pipeline_name: str, run_id: str,
            execution_date: str, status: str, stages: dict) -> None:
    """Append one run-log row per stage count (a handful of rows per run; table
    versions are no counts and stay out)."""
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    rows = [(pipeline_name, run_id, execution_date, status, k, int(v), now)
            for k, v in (stages or {"-": 0}).items()
            if isinstance(v, int) and not k.endswith("_version")]
    tables.append(spark.createDataFrame(rows, RUN_LOG_SCHEMA), lake.run_log)


def run_daily(spark: SparkSession, landing_base: str, lake_base: str, execution_date: str,
              sport: str = "football", shape: str = landing.ENVELOPE_SHAPE,
              rules: Sequence[quality.Rule] = quality.SILVER_SUITE,
              pipeline_name: str = "medallion_daily",
              tie_breakers: Sequence[str] = silver.DEFAULT_TIE_BREAKERS) -> dict:
    """bronze -> silver -> gate -> gold for one execution date, logged."""
    lake = Lake(lake_base, sport)
    run_id = uuid.uuid4().hex
    stages: dict = {}
    try:
        stages.update(ingest_bronze(spark, landing_base, lake, execution_date, shape))
        stages.update(build_silver(spark, lake, execution_date, tie_breakers))
        stages["rules_checked"] = len(check_silver(spark, lake, rules))
        stages.update(build_gold(spark, lake))
        drift = note_schemas(spark, lake, run_id, execution_date)
    except Exception:
        log_run(spark, lake, pipeline_name, run_id, execution_date, "FAILED", stages)
        raise
    log_run(spark, lake, pipeline_name, run_id, execution_date, "SUCCESS", stages)
    return {"run_id": run_id, "schema_drift": drift, **stages}
