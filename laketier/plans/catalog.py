"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the driver's tables (or over tables Spark derives from them). Timestamps
leave as ``timestamp_ntz`` so both engines agree on the type, and the
per-run audit stamps are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laketier.operators import gold, silver
from laketier.plans import oracle as O
from laketier.session import staged
from laketier.sources import driver_tables as dt

QueryFn = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        CATALOG[name] = (fn, sql)
        return fn
    return deco


def ntz(df: DataFrame, *cols: str) -> DataFrame:
    """Session-zone timestamps -> wall-clock ``timestamp_ntz`` (zone is UTC)."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


SILVER_OUT = [c.strip() for c in O.SILVER_OUT.split(",")]
FACT_OUT = [c.strip() for c in O.FACT_OUT.split(",")]


# --- building blocks shared by the queries ---------------------------------

def bronze_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dt.fixture_records(spark, sf_dir)


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_matches(bronze_records(spark, sf_dir), tie_breakers=dt.TIE_BREAKERS,
                                 processed_at=False)


def fact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_match_stats(silver_rows(spark, sf_dir))


# --- silver ----------------------------------------------------------------

@register("silver_flatten", O.with_views(
    "SELECT * EXCLUDE (_t1, _t2, _t3) FROM bronze_v", chain=[O.BRONZE_V]))
def q_silver_flatten(spark, sf_dir):
    flat = silver.flatten(bronze_records(spark, sf_dir))
    return ntz(flat.drop("_source_file"), "match_datetime")


@register("silver_cleanse", O.with_views(
    "SELECT * EXCLUDE (_t1, _t2, _t3) FROM clean_result_v",
    chain=[O.BRONZE_V, O.CLEAN_V, O.CLEAN_RESULT_V]))
def q_silver_cleanse(spark, sf_dir):
    clean = silver.cleanse(silver.flatten(bronze_records(spark, sf_dir)))
    return ntz(clean.drop("_source_file"), "match_datetime")


@register("silver_dedup_latest", O.with_views(
    f"SELECT {O.SILVER_OUT} FROM latest_v",
    chain=[O.BRONZE_V, O.CLEAN_V, O.CLEAN_RESULT_V, O.LATEST_V]))
def q_silver_dedup_latest(spark, sf_dir):
    flat = silver.flatten(bronze_records(spark, sf_dir), carry=dt.TIE_BREAKERS)
    from laketier.operators.dedup import latest_per_key
    latest = latest_per_key(silver.cleanse(flat), ["match_id"],
                            ["_ingest_timestamp", *dt.TIE_BREAKERS])
    return ntz(latest.select(*SILVER_OUT), "match_datetime")


@register("silver_finished_only", O.with_views(f"SELECT {O.SILVER_OUT} FROM silver_v"))
def q_silver_finished_only(spark, sf_dir):
    return ntz(silver_rows(spark, sf_dir).select(*SILVER_OUT), "match_datetime")


@register("silver_match_result", O.with_views(
    "SELECT match_result, count(*) AS matches, CAST(sum(total_goals) AS BIGINT) AS goals "
    "FROM silver_v GROUP BY match_result"))
def q_silver_match_result(spark, sf_dir):
    return (silver_rows(spark, sf_dir).groupBy("match_result")
            .agg(F.count(F.lit(1)).alias("matches"), F.sum("total_goals").alias("goals")))


# --- gold ------------------------------------------------------------------

@register("gold_fact_match_stats", O.with_views(f"SELECT {O.FACT_OUT} FROM fact_v", O.FACT_V))
def q_gold_fact(spark, sf_dir):
    return ntz(fact_rows(spark, sf_dir), "match_datetime")


@register("gold_dim_team_union_all", O.with_views(
    "SELECT team_id, team_name, league_id, league_name, season FROM roles_v", O.ROLES_V))
def q_dim_team_union_all(spark, sf_dir):
    return gold.team_appearances(silver_rows(spark, sf_dir))


@register("gold_dim_team_distinct", O.with_views(
    "SELECT DISTINCT team_id, team_name, league_id, league_name, season FROM roles_v", O.ROLES_V))
def q_dim_team_distinct(spark, sf_dir):
    return gold.dim_team_distinct(silver_rows(spark, sf_dir))


@register("gold_dim_team", O.with_views("SELECT * FROM dim_team_v", O.ROLES_V, O.DIM_TEAM_V))
def q_dim_team(spark, sf_dir):
    return gold.dim_team(silver_rows(spark, sf_dir))


@register("gold_dim_date", O.with_views("SELECT * FROM dim_date_v", O.DIM_DATE_V))
def q_dim_date(spark, sf_dir):
    return gold.dim_date(silver_rows(spark, sf_dir))


@register("agg_league_season_summary", O.with_views(
    "SELECT league_id, season, count(match_id) AS total_matches, "
    "CAST(sum(total_goals) AS BIGINT) AS total_goals, avg(total_goals) AS avg_goals_per_match "
    "FROM fact_v GROUP BY league_id, season ORDER BY league_id, season", O.FACT_V))
def q_league_summary(spark, sf_dir):
    return gold.league_season_summary(fact_rows(spark, sf_dir))


# --- star joins --------------------------------------------------------------

# Dimensions "as of" an earlier run: built from matches before this date,
# while the fact covers every match (late-arriving dimension rows).
STALE_DIM_BEFORE = "1996-07-01"


@register("star_join_date", O.with_views(
    "SELECT d.day_name, count(*) AS matches, CAST(sum(f.total_goals) AS BIGINT) AS total_goals "
    "FROM fact_v f LEFT JOIN dim_date_v d ON f.match_date = d.date GROUP BY d.day_name",
    O.FACT_V, O.DIM_DATE_V))
def q_star_join_date(spark, sf_dir):
    from laketier.operators import star
    s = silver_rows(spark, sf_dir)
    return star.goals_by_weekday(gold.fact_match_stats(s), gold.dim_date(s))


@register("star_join_teams", O.with_views(
    "SELECT team_name, count(*) AS matches, CAST(sum(points) AS BIGINT) AS points, "
    "CAST(sum(gf) AS BIGINT) AS goals_for, CAST(sum(ga) AS BIGINT) AS goals_against FROM ("
    " SELECT h.team_name, f.home_team_points AS points, f.home_goals AS gf, f.away_goals AS ga"
    " FROM fact_v f LEFT JOIN dim_team_v h ON f.home_team_id = h.team_id AND f.season = h.season"
    " UNION ALL"
    " SELECT a.team_name, f.away_team_points, f.away_goals, f.home_goals"
    " FROM fact_v f LEFT JOIN dim_team_v a ON f.away_team_id = a.team_id AND f.season = a.season"
    ") GROUP BY team_name", O.FACT_V, O.ROLES_V, O.DIM_TEAM_V))
def q_star_join_teams(spark, sf_dir):
    from laketier.operators import star
    s = silver_rows(spark, sf_dir)
    return star.team_table(gold.fact_match_stats(s), gold.dim_team(s))


@register("star_orphans", O.with_views(
    "SELECT f.match_id, 'home_team' AS missing FROM fact_v f WHERE NOT EXISTS ("
    " SELECT 1 FROM old_team t WHERE t.team_id = f.home_team_id AND t.season = f.season)"
    " UNION ALL SELECT f.match_id, 'away_team' FROM fact_v f WHERE NOT EXISTS ("
    " SELECT 1 FROM old_team t WHERE t.team_id = f.away_team_id AND t.season = f.season)"
    " UNION ALL SELECT f.match_id, 'date' FROM fact_v f WHERE NOT EXISTS ("
    f" SELECT 1 FROM silver_v s WHERE s.match_date < DATE '{STALE_DIM_BEFORE}'"
    "  AND s.match_date = f.match_date)",
    O.FACT_V, O.ROLES_V,
    "old_team AS (SELECT DISTINCT team_id, season FROM roles_v "
    f"WHERE match_date < DATE '{STALE_DIM_BEFORE}')"))
def q_star_orphans(spark, sf_dir):
    from laketier.operators import star
    s = silver_rows(spark, sf_dir)
    old = s.where(F.col("match_date") < F.lit(STALE_DIM_BEFORE).cast("date"))
    return star.orphans(gold.fact_match_stats(s), gold.dim_team(old), gold.dim_date(old))


# --- upserts -----------------------------------------------------------------

# Yesterday's silver holds every version ingested before this instant; the
# incoming batch holds every later version (updates to known matches + new ones).
SPLIT_AT = "1996-06-01 00:00:00"


def _merge_sql(target_cte: str, source_cte: str, keys: list[str], cols: str) -> str:
    on = " AND ".join(f"s.{k} = t.{k}" for k in keys)
    return (f"SELECT {cols} FROM {target_cte} t WHERE NOT EXISTS "
            f"(SELECT 1 FROM {source_cte} s WHERE {on}) "
            f"UNION ALL SELECT {cols} FROM {source_cte}")


@register("merge_upsert_matches", O.with_views(
    _merge_sql("t_silver_v", "s_silver_v", ["match_id"], O.SILVER_OUT),
    chain=[O.BRONZE_V,
           *O.silver_ctes("t_", f"_ingest_timestamp < TIMESTAMP '{SPLIT_AT}'"),
           *O.silver_ctes("s_", f"_ingest_timestamp >= TIMESTAMP '{SPLIT_AT}'")]))
def q_merge_matches(spark, sf_dir):
    from laketier.operators.upsert import upsert
    b = bronze_records(spark, sf_dir)
    ts = F.col("_ingest_timestamp")
    split = F.lit(SPLIT_AT).cast("timestamp_ntz")

    def batch(cond):
        return silver.silver_matches(b.where(cond), tie_breakers=dt.TIE_BREAKERS,
                                     processed_at=False)
    incoming = staged(batch(ts >= split), "incoming")  # keys and rows from one narrow copy
    merged = upsert(batch(ts < split), incoming, ["match_id"])
    return ntz(merged.select(*SILVER_OUT), "match_datetime")


def _dim_team_sql(name: str, where: str, upper: bool) -> list[str]:
    tn = "upper(team_name)" if upper else "team_name"
    return [f"""{name}_roles AS (SELECT * FROM roles_v WHERE {where})""",
            f"""{name} AS (SELECT team_id, {tn} AS team_name, league_id, league_name, season
 FROM (SELECT *, row_number() OVER (PARTITION BY team_id, season
   ORDER BY match_date DESC, match_id DESC, league_id DESC) AS rn FROM {name}_roles)
 WHERE rn = 1)"""]


@register("merge_upsert_composite_key", O.with_views(
    _merge_sql("t_team", "s_team", ["team_id", "season"], "*"),
    O.ROLES_V, *_dim_team_sql("t_team", "season <= 1998", False),
    *_dim_team_sql("s_team", "season >= 1997", True)))
def q_merge_composite(spark, sf_dir):
    from laketier.operators.upsert import upsert
    s = silver_rows(spark, sf_dir)
    target = gold.dim_team(s.where(F.col("season") <= 1998))
    source = gold.dim_team(s.where(F.col("season") >= 1997)) \
        .withColumn("team_name", F.upper("team_name"))
    return upsert(target, staged(source, "incoming"), ["team_id", "season"])


@register("merge_upsert_date_key", O.with_views(
    _merge_sql("t_date", "s_date", ["date"], "*"), O.DIM_DATE_V,
    "t_date AS (SELECT * FROM dim_date_v WHERE year <= 1998)",
    "s_date AS (SELECT * REPLACE (upper(day_name) AS day_name) FROM dim_date_v "
    "WHERE year >= 1997)"))
def q_merge_date(spark, sf_dir):
    from laketier.operators.upsert import upsert
    d = gold.dim_date(silver_rows(spark, sf_dir))
    source = d.where(F.col("year") >= 1997).withColumn("day_name", F.upper("day_name"))
    return upsert(d.where(F.col("year") <= 1998), staged(source, "incoming"), ["date"])


# --- events --------------------------------------------------------------------

@register("dedup_latest_event_per_user", O.with_views(
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id "
    "ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1", chain=[]))
def q_latest_event(spark, sf_dir):
    from laketier.operators.dedup import latest_per_key
    return latest_per_key(dt.table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])


@register("json_props_extract", O.with_views(
    "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    chain=[]))
def q_json_props(spark, sf_dir):
    from laketier.functions.parse import json_field
    ev = dt.table(spark, sf_dir, "events")
    return ev.select("event_id", json_field(F.col("props"), "k INT", "k").alias("k"))


# --- projections -------------------------------------------------------------

def _iso_strings(spark, sf_dir):
    """Order dates written as ISO strings two hours west of UTC."""
    o = dt.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.concat(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-02:00")).alias("s"))


@register("prj_cast_timestamp", O.with_views(
    "SELECT o_orderkey, o_orderdate + INTERVAL 2 HOUR AS match_datetime FROM orders", chain=[]))
def q_cast_timestamp(spark, sf_dir):
    from laketier.functions.parse import iso_instant
    return ntz(_iso_strings(spark, sf_dir).select(
        "o_orderkey", iso_instant(F.col("s")).alias("match_datetime")), "match_datetime")


@register("prj_to_date", O.with_views(
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS match_date FROM orders", chain=[]))
def q_to_date(spark, sf_dir):
    from laketier.functions.parse import iso_calendar_date
    return _iso_strings(spark, sf_dir).select(
        "o_orderkey", iso_calendar_date(F.col("s")).alias("match_date"))


@register("util_audit_columns", O.with_views(
    "SELECT match_id, '1.0.0' AS _pipeline_version FROM fact_v", O.FACT_V))
def q_util_audit(spark, sf_dir):
    from laketier.functions.audit import audit_columns
    out = audit_columns(fact_rows(spark, sf_dir), "gold")
    return out.select("match_id", "_pipeline_version")


BRONZE_DATE = "2024-11-01"


@register("bronze_audit_columns", O.with_views(
    f"SELECT match_id, '{BRONZE_DATE}' AS _ingest_date, 'football' AS _sport_type, "
    "'lineitem.parquet' AS source_name FROM bronze_v", chain=[O.BRONZE_V]))
def q_bronze_audit(spark, sf_dir):
    from laketier.sources.landing import with_bronze_audit
    rec = dt.fixture_records(spark, sf_dir)
    out = with_bronze_audit(rec, BRONZE_DATE, "football")
    return out.select(F.col("fixture.id").try_cast("int").alias("match_id"), "_ingest_date",
                      "_sport_type",
                      F.regexp_extract("_source_file", r"([^/]+)$", 1).alias("source_name"))


# --- stage metrics -------------------------------------------------------------

@register("stage_row_counts", O.with_views(
    "SELECT 'bronze' AS stage, count(*) AS rows, CAST(10 AS INTEGER) AS columns FROM bronze_v "
    "UNION ALL SELECT 'deduplicated', count(*), 25 FROM latest_v "
    "UNION ALL SELECT 'silver', count(*), 21 FROM silver_v"))
def q_stage_counts(spark, sf_dir):
    """Rows and columns of each stage, counted while silver is written once."""
    from laketier.operators.dedup import latest_per_key
    from laketier.plans.metrics import observe_rows, stage_report
    b, bronze = observe_rows(bronze_records(spark, sf_dir), "bronze")
    latest, deduplicated = observe_rows(latest_per_key(
        silver.cleanse(silver.flatten(b, carry=dt.TIE_BREAKERS)),
        ["match_id"], ["_ingest_timestamp", *dt.TIE_BREAKERS]), "deduplicated")
    done, finished = observe_rows(silver.finished_only(latest).select(*SILVER_OUT), "silver")
    staged(done, "silver")
    return stage_report(spark, [("bronze", bronze, b), ("deduplicated", deduplicated, latest),
                                ("silver", finished, done)])


# --- data quality -------------------------------------------------------------

def _dq_query(name: str, rules, on: str):
    """Register a rule-suite query on silver rows or on every cleansed version."""
    from laketier.operators import quality as Q

    cte = "silver_v" if on == "silver" else "clean_result_v"
    cols = SILVER_OUT

    def fn(spark, sf_dir):
        if on == "silver":
            df = silver_rows(spark, sf_dir).select(*SILVER_OUT)
        else:
            df = silver.cleanse(silver.flatten(bronze_records(spark, sf_dir))).select(*SILVER_OUT)
        return Q.evaluate(df, rules)

    CATALOG[name] = (fn, O.with_views(O.dq_sql(rules, cte, cols)))


def _register_dq():
    from laketier.operators import quality as Q
    suite = Q.SILVER_SUITE
    _dq_query("dq_suite_results", suite, "silver")
    by_type = {t: [r for r in suite if r.expectation_type == t] for t in Q.RULE_TYPES}
    _dq_query("dq_not_null", by_type[Q.NOT_NULL] + [
        Q.Rule(16, Q.NOT_NULL, "ht_home_goals", Q.WARNING, mostly=0.9),
        Q.Rule(17, Q.NOT_NULL, "ht_away_goals", Q.CRITICAL, mostly=1.0)], "versions")
    _dq_query("dq_unique", by_type[Q.UNIQUE], "versions")
    _dq_query("dq_between", by_type[Q.BETWEEN] + [
        Q.Rule(16, Q.BETWEEN, "home_goals", Q.CRITICAL, mostly=0.5, min_value=1),
        Q.Rule(17, Q.BETWEEN, "ht_home_goals", Q.WARNING, max_value=1)], "versions")
    _dq_query("dq_in_set", by_type[Q.IN_SET], "versions")
    _dq_query("dq_row_count", by_type[Q.ROW_COUNT] + [
        Q.Rule(16, Q.ROW_COUNT, None, Q.WARNING, min_value=1, max_value=1000)], "versions")
    _dq_query("dq_regex", by_type[Q.REGEX] + [
        Q.Rule(16, Q.REGEX, "round", Q.WARNING, mostly=0.9, regex=r"- [1-9]$")], "versions")


_register_dq()


# --- tables: written by Spark from the driver's tables, then read back --------

def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    import uuid

    from laketier.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/laketier-scratch/{name}-{uuid.uuid4().hex[:12]}"


def _silver_full(spark, sf_dir) -> DataFrame:
    """Silver rows with every stored column (audit stamp included)."""
    return silver.silver_matches(bronze_records(spark, sf_dir), tie_breakers=dt.TIE_BREAKERS)


@register("src_table_scan", O.with_views(f"SELECT {O.FACT_OUT} FROM fact_v", O.FACT_V))
def q_src_table_scan(spark, sf_dir):
    from laketier.schemas import FACT_PARTITIONS
    from laketier.sinks import tables
    path = scratch(spark, "fact")
    tables.write_table(fact_rows(spark, sf_dir), path, FACT_PARTITIONS)
    return ntz(tables.read_table(spark, path), "match_datetime")


@register("snk_overwrite_partitioned", O.with_views(f"SELECT {O.SILVER_OUT} FROM silver_v"))
def q_snk_overwrite_partitioned(spark, sf_dir):
    from laketier.schemas import SILVER_PARTITIONS
    from laketier.sinks import tables
    path = scratch(spark, "silver")
    tables.write_table(_silver_full(spark, sf_dir), path, SILVER_PARTITIONS)
    return ntz(tables.read_table(spark, path).select(*SILVER_OUT), "match_datetime")


SCAN_PREDICATE = "season >= 1997 AND match_result = 'HOME_WIN'"


@register("src_scan_with_predicate", O.with_views(
    f"SELECT {O.SILVER_OUT} FROM silver_v WHERE {SCAN_PREDICATE}"))
def q_src_scan_with_predicate(spark, sf_dir):
    from laketier.schemas import SILVER_PARTITIONS
    from laketier.sinks import tables
    path = scratch(spark, "silver")
    tables.write_table(_silver_full(spark, sf_dir), path, SILVER_PARTITIONS)
    return ntz(tables.read_table(spark, path, where=SCAN_PREDICATE).select(*SILVER_OUT),
               "match_datetime")


INGEST_DAY = "1996-03-13"


def _bronze_table(spark, sf_dir) -> str:
    """Every adapter record appended to a bronze table partitioned by ingest day."""
    from laketier.schemas import BRONZE_PARTITIONS
    from laketier.sinks import tables
    path = scratch(spark, "bronze")
    rec = bronze_records(spark, sf_dir).withColumns({
        "_ingest_date": F.date_format("_ingest_timestamp", "yyyy-MM-dd"),
        "_sport_type": F.lit("football")})
    tables.append(rec, path, BRONZE_PARTITIONS)
    return path


@register("src_incremental_partition", O.with_views(
    f"SELECT {O.SILVER_OUT} FROM d_silver_v", chain=[O.BRONZE_V, *O.silver_ctes(
        "d_", f"CAST(_ingest_timestamp AS DATE) = DATE '{INGEST_DAY}'")]))
def q_src_incremental_partition(spark, sf_dir):
    bronze = read_bronze_at(spark, _bronze_table(spark, sf_dir), INGEST_DAY)
    out = silver.silver_matches(bronze, tie_breakers=dt.TIE_BREAKERS, processed_at=False)
    return ntz(out.select(*SILVER_OUT), "match_datetime")


def read_bronze_at(spark, path: str, day: str) -> DataFrame:
    from laketier.sinks import tables
    return tables.read_appended(spark, path, string_partitions=["_ingest_date"],
                                partition={"_ingest_date": day})


@register("merge_first_run", O.with_views(f"SELECT {O.SILVER_OUT} FROM silver_v"))
def q_merge_first_run(spark, sf_dir):
    from laketier.schemas import SILVER_KEYS, SILVER_PARTITIONS
    from laketier.sinks import tables
    path = scratch(spark, "silver")
    tables.upsert_table(_silver_full(spark, sf_dir), path, SILVER_KEYS, SILVER_PARTITIONS)
    return ntz(tables.read_table(spark, path).select(*SILVER_OUT), "match_datetime")


@register("merge_upsert_table", O.with_views(
    _merge_sql("t_silver_v", "s_silver_v", ["match_id"], O.SILVER_OUT),
    chain=[O.BRONZE_V,
           *O.silver_ctes("t_", f"_ingest_timestamp < TIMESTAMP '{SPLIT_AT}'"),
           *O.silver_ctes("s_", f"_ingest_timestamp >= TIMESTAMP '{SPLIT_AT}'")]))
def q_merge_upsert_table(spark, sf_dir):
    """Two runs into one silver table: first run creates it, second merges."""
    from laketier.schemas import SILVER_KEYS, SILVER_PARTITIONS
    from laketier.sinks import tables
    b = bronze_records(spark, sf_dir)
    ts, split = F.col("_ingest_timestamp"), F.lit(SPLIT_AT).cast("timestamp_ntz")
    path = scratch(spark, "silver")
    for cond in (ts < split, ts >= split):
        batch = silver.silver_matches(b.where(cond), tie_breakers=dt.TIE_BREAKERS)
        tables.upsert_table(batch, path, SILVER_KEYS, SILVER_PARTITIONS)
    return ntz(tables.read_table(spark, path).select(*SILVER_OUT), "match_datetime")


@register("merge_bucketed_table", O.with_views(
    _merge_sql("t_silver_v", "s_silver_v", ["match_id"], O.SILVER_OUT),
    chain=[O.BRONZE_V,
           *O.silver_ctes("t_", f"_ingest_timestamp < TIMESTAMP '{SPLIT_AT}'"),
           *O.silver_ctes("s_", f"_ingest_timestamp >= TIMESTAMP '{SPLIT_AT}'")]))
def q_merge_bucketed_table(spark, sf_dir):
    """The same two runs into a table bucketed by match: the target is not shuffled."""
    from laketier.schemas import SILVER_PARTITIONS
    from laketier.sinks import bucketed
    b = bronze_records(spark, sf_dir)
    ts, split = F.col("_ingest_timestamp"), F.lit(SPLIT_AT).cast("timestamp_ntz")

    def batch(cond):
        return silver.silver_matches(b.where(cond), tie_breakers=dt.TIE_BREAKERS)
    path = scratch(spark, "bucketed")
    name = f"laketier_check.bucketed_{path[-12:]}"
    spark.sql("CREATE DATABASE IF NOT EXISTS laketier_check")
    bucketed.create(batch(ts < split), name, path, "match_id", SILVER_PARTITIONS)
    bucketed.merge(batch(ts >= split), name)
    return ntz(spark.table(name).select(*SILVER_OUT), "match_datetime")


@register("layout_rewrite", O.with_views(f"SELECT {O.SILVER_OUT} FROM silver_v"))
def q_layout_rewrite(spark, sf_dir):
    from laketier.schemas import SILVER_PARTITIONS
    from laketier.sinks import layout, tables
    path = scratch(spark, "silver")
    tables.write_table(_silver_full(spark, sf_dir), path, SILVER_PARTITIONS)
    layout.rewrite_layout(spark, path, ["match_date", "home_team_id"], target_file_bytes=1 << 20)
    return ntz(tables.read_table(spark, path).select(*SILVER_OUT), "match_datetime")


@register("snk_register_table", O.with_views(f"SELECT {O.SILVER_OUT} FROM silver_v"))
def q_snk_register_table(spark, sf_dir):
    from laketier.schemas import SILVER_PARTITIONS
    from laketier.sinks import layout, tables
    path = scratch(spark, "silver")
    tables.write_table(_silver_full(spark, sf_dir), path, SILVER_PARTITIONS)
    name = layout.register_table(spark, "laketier_check", "matches_" + path[-12:], path)
    return ntz(spark.table(name).select(*SILVER_OUT), "match_datetime")


@register("snk_append_evolve", O.with_views(
    "SELECT * EXCLUDE (_t1, _t2, _t3), CASE WHEN _ingest_timestamp >= "
    f"TIMESTAMP '{SPLIT_AT}' THEN concat('ref-', CAST(home_team_id AS VARCHAR)) END AS referee "
    "FROM bronze_v", chain=[O.BRONZE_V]))
def q_snk_append_evolve(spark, sf_dir):
    """Two appends, the second with a new column; read back with merged schemas."""
    from laketier.sinks import tables
    flat = silver.flatten(bronze_records(spark, sf_dir)).drop("_source_file")
    ts, split = F.col("_ingest_timestamp"), F.lit(SPLIT_AT).cast("timestamp_ntz")
    path = scratch(spark, "append")
    tables.append(flat.where(ts < split), path)
    tables.append(flat.where(ts >= split).withColumn(
        "referee", F.concat(F.lit("ref-"), F.col("home_team_id").cast("string"))), path)
    return ntz(tables.read_appended(spark, path), "match_datetime")


# --- landed JSON derived from the driver's tables -------------------------------

FLAT_RAW = [c for c in SILVER_OUT if c not in ("_ingest_timestamp", "match_result",
                                              "total_goals")]
FLAT_RAW_SQL = ", ".join(FLAT_RAW)


def _land_records(spark, sf_dir) -> str:
    """Adapter records landed as gzipped JSON Lines, one folder per ingest month and league.
    A task writes a file of its own in each folder, so no file is too large to be read whole."""
    base = scratch(spark, "landing")
    rec = bronze_records(spark, sf_dir).select(
        "fixture", "league", "teams", "goals", "score",
        F.date_format("_ingest_timestamp", "yyyy-MM").alias("ingest_month"),
        F.col("league.id").alias("league_no"))
    rec.write.partitionBy("ingest_month", "league_no").json(f"{base}/football/raw", compression="gzip")
    return base


@register("src_json_scan", O.with_views(f"SELECT {FLAT_RAW_SQL} FROM bronze_v",
                                        chain=[O.BRONZE_V]))
def q_src_json_scan(spark, sf_dir):
    from laketier.sources import landing
    base = _land_records(spark, sf_dir)
    raw = landing.read_landed(spark, f"{base}/football/raw", landing.RECORDS_SHAPE)
    rows = landing.fixture_rows(raw, landing.RECORDS_SHAPE).withColumn(
        "_ingest_timestamp", F.lit(None).cast("timestamp"))
    return ntz(silver.flatten(rows).select(*FLAT_RAW), "match_datetime")


@register("src_file_lineage", O.with_views(
    "SELECT strftime(_ingest_timestamp, '%Y-%m') AS ingest_month, league_id, "
    "count(*) AS rows FROM bronze_v GROUP BY 1, 2", chain=[O.BRONZE_V]))
def q_src_file_lineage(spark, sf_dir):
    """Rows per landed file folder, read back from the file path of each row."""
    from laketier.sources import landing
    base = _land_records(spark, sf_dir)
    raw = landing.read_landed(spark, f"{base}/football/raw", landing.RECORDS_SHAPE)
    path = F.col(landing.SOURCE_FILE)
    return (raw.select(F.regexp_extract(path, r"ingest_month=([^/]+)", 1).alias("ingest_month"),
                       F.regexp_extract(path, r"league_no=(\d+)", 1).cast("int").alias("league_id"))
            .groupBy("ingest_month", "league_id").agg(F.count(F.lit(1)).alias("rows")))


# Records per envelope stay bounded at any scale: one page per league, ingest
# day and block of at most PAGE_IDS records.
PAGE_IDS = 1000


@register("src_explode_envelope", O.with_views(f"SELECT {FLAT_RAW_SQL} FROM bronze_v",
                                               chain=[O.BRONZE_V]))
def q_src_explode_envelope(spark, sf_dir):
    """API documents (paged envelopes) built from the records, then exploded."""
    from laketier.schemas import CORRUPT_COLUMN
    from laketier.sources import landing
    rec = bronze_records(spark, sf_dir)
    # a page is a block of consecutive rows of one task (ids are increasing
    # within a partition), so no page exceeds PAGE_IDS records even when one
    # match or day holds a third of all rows
    docs = rec.groupBy(
        F.col("league.id").alias("league"),
        F.date_format("_ingest_timestamp", "yyyy-MM-dd").alias("day"),
        F.floor(F.monotonically_increasing_id() / PAGE_IDS).alias("page"),
    ).agg(F.collect_list(F.struct("fixture", "league", "teams", "goals", "score"))
          .alias("response"))
    raw = docs.select(
        F.lit("fixtures").alias("get"), "response",
        F.lit(None).cast("string").alias(CORRUPT_COLUMN),
        F.concat_ws("/", F.lit("raw"), "day", F.concat(F.lit("league_"), "league"))
        .alias(landing.SOURCE_FILE))
    rows = landing.fixture_rows(raw, landing.ENVELOPE_SHAPE).withColumn(
        "_ingest_timestamp", F.lit(None).cast("timestamp"))
    return ntz(silver.flatten(rows).select(*FLAT_RAW), "match_datetime")


# --- quality gate ----------------------------------------------------------------

def _exists_rules():
    from laketier.operators import quality as Q
    return [Q.Rule(1, Q.EXISTS, "match_id", Q.CRITICAL),
            Q.Rule(2, Q.EXISTS, "match_date", Q.CRITICAL),
            Q.Rule(3, Q.EXISTS, "referee", Q.WARNING),
            Q.Rule(4, Q.NOT_NULL, "referee", Q.WARNING),
            Q.Rule(5, Q.IN_SET, "venue_name", Q.WARNING, value_set=("BUILDING", "MACHINERY"))]


@register("dq_column_exists", O.with_views(O.dq_sql(_exists_rules(), "silver_v", SILVER_OUT)))
def q_dq_column_exists(spark, sf_dir):
    from laketier.operators import quality as Q
    return Q.evaluate(silver_rows(spark, sf_dir).select(*SILVER_OUT), _exists_rules())


@register("dq_gate", O.with_views(
    "SELECT *, CASE WHEN success THEN 'pass' WHEN severity = 'CRITICAL' THEN 'stop' "
    "ELSE 'warn' END AS action FROM (" + O.dq_sql(
        __import__("laketier.operators.quality", fromlist=["x"]).SILVER_SUITE,
        "clean_result_v", SILVER_OUT) + ")"))
def q_dq_gate(spark, sf_dir):
    """The gate's decision per rule on every cleansed version (before dedup:
    the uniqueness rule fails CRITICAL there, so the run would stop)."""
    from laketier.operators import quality as Q
    df = silver.cleanse(silver.flatten(bronze_records(spark, sf_dir))).select(*SILVER_OUT)
    return Q.gate_actions(Q.evaluate(df, Q.SILVER_SUITE))


@register("dq_incremental", O.with_views(
    O.dq_sql(__import__("laketier.operators.quality", fromlist=["x"]).SILVER_SUITE,
             "merged_v", SILVER_OUT),
    "merged_v AS (" + _merge_sql("t_silver_v", "s_silver_v", ["match_id"], O.SILVER_OUT) + ")",
    chain=[O.BRONZE_V,
           *O.silver_ctes("t_", f"_ingest_timestamp < TIMESTAMP '{SPLIT_AT}'"),
           *O.silver_ctes("s_", f"_ingest_timestamp >= TIMESTAMP '{SPLIT_AT}'")]))
def q_dq_incremental(spark, sf_dir):
    """Silver merged twice; the gate evaluates each time what has changed."""
    from laketier.operators.quality import RESULT_SCHEMA
    from laketier.plans.gate import evaluate_changed
    from laketier.schemas import SILVER_KEYS, SILVER_PARTITIONS
    from laketier.sinks import tables
    b, path, state = bronze_records(spark, sf_dir), scratch(spark, "silver"), scratch(spark, "gate")
    ts, split = F.col("_ingest_timestamp"), F.lit(SPLIT_AT).cast("timestamp_ntz")
    for cond in (ts < split, ts >= split):
        tables.upsert_table(silver.silver_matches(b.where(cond), tie_breakers=dt.TIE_BREAKERS),
                            path, SILVER_KEYS, SILVER_PARTITIONS)
        rows = evaluate_changed(spark, path, state)
    return spark.createDataFrame([tuple(r.values()) for r in rows], RESULT_SCHEMA)


# --- daily runs over landed data --------------------------------------------------

BATCH_DATES = ("1996-05-31", "1996-06-01")


def _land_batch(spark, sf_dir, base: str, i: int) -> None:
    """Adapter records of ingest batch ``i`` (split at SPLIT_AT) landed as JSON
    Lines under ``<base>/football/raw/<date>/league_no=<id>/``."""
    rec = _ranked(bronze_records(spark, sf_dir))
    ts, split = F.col("_ingest_timestamp"), F.lit(SPLIT_AT).cast("timestamp_ntz")
    cond = (ts < split, ts >= split)[i]
    (rec.where(cond).select("fixture", "league", "teams", "goals", "score",
                            F.col("league.id").alias("league_no"))
     .write.partitionBy("league_no").json(f"{base}/football/raw/{BATCH_DATES[i]}", compression="gzip"))


def _land_two_batches(spark, sf_dir) -> str:
    """All adapter records landed as two ingest dates, JSON Lines, one
    sub-folder per league."""
    base = scratch(spark, "landing")
    for i in range(len(BATCH_DATES)):
        _land_batch(spark, sf_dir, base, i)
    return base


# The version of a record, in the record itself: later ingests are higher; line, part
# and supplier tell the versions of one instant apart.
VERSION_RANK = ["fixture.timestamp", "fixture.periods.first", "fixture.periods.second"]


def _ranked(rec: DataFrame) -> DataFrame:
    rank = F.unix_timestamp(F.col("_ingest_timestamp").cast("timestamp")) * 10 + F.col("_t1")
    ties = F.struct(F.col("_t2").alias("first"), F.col("_t3").alias("second"))
    return rec.withColumn("fixture", F.col("fixture").withField("timestamp", rank)
                          .withField("periods", ties))


_BATCHES = [O.BRONZE_V,
            *O.silver_ctes("t_", f"_ingest_timestamp < TIMESTAMP '{SPLIT_AT}'"),
            *O.silver_ctes("s_", f"_ingest_timestamp >= TIMESTAMP '{SPLIT_AT}'")]


def _run_log_sql() -> str:
    parts = []
    for date, p, op in zip(BATCH_DATES, "ts", ("<", ">=")):
        for stage, sql in (
                ("bronze", f"(SELECT count(*) FROM bronze_v WHERE _ingest_timestamp {op} "
                           f"TIMESTAMP '{SPLIT_AT}')"),
                ("quarantined", "0"),
                ("silver_batch", f"(SELECT count(*) FROM {p}_silver_v)"),
                ("rules_checked", "15"),
                ("fact_partitions_rebuilt", "(SELECT count(*) FROM (SELECT DISTINCT league_id, "
                                            f"season FROM {p}_silver_v))")):
            parts.append(f"SELECT 'medallion_daily' AS pipeline_name, '{date}' AS execution_date, "
                         f"'SUCCESS' AS status, '{stage}' AS stage, CAST({sql} AS BIGINT) AS rows")
    return " UNION ALL ".join(parts)


@register("run_log_append", O.with_views(_run_log_sql(), chain=_BATCHES))
def q_run_log_append(spark, sf_dir):
    """Two daily runs (bronze, silver merge, gate, gold) and their run log."""
    from laketier.plans import jobs
    from laketier.sources.landing import RECORDS_SHAPE
    landing_base, lake_base = _land_two_batches(spark, sf_dir), scratch(spark, "lake")
    for date in BATCH_DATES:
        jobs.run_daily(spark, landing_base, lake_base, date, shape=RECORDS_SHAPE,
                       tie_breakers=VERSION_RANK)
    return (spark.read.parquet(jobs.Lake(lake_base).run_log)
            .select("pipeline_name", "execution_date", "status", "stage", "rows"))


STREAM_OUT = [c for c in SILVER_OUT if c != "_ingest_timestamp"]


@register("stream_upsert", O.with_views(
    _merge_sql("t_silver_v", "s_silver_v", ["match_id"], ", ".join(STREAM_OUT)), chain=_BATCHES))
def q_stream_upsert(spark, sf_dir):
    """Structured Streaming: each landed batch drained into the silver table
    (one micro-batch per landing, merged by key)."""
    from laketier.sinks import tables
    from laketier.streaming.silver_stream import start_silver_stream
    base, path = scratch(spark, "landing"), scratch(spark, "silver")
    for i in range(len(BATCH_DATES)):
        _land_batch(spark, sf_dir, base, i)
        start_silver_stream(spark, f"{base}/football/raw", path, name="silver_" + path[-12:],
                            quarantine_path=scratch(spark, "quarantine"),
                            tie_breakers=VERSION_RANK).awaitTermination()
    return ntz(tables.read_table(spark, path).select(*STREAM_OUT), "match_datetime")


# Landings of the stateful stream: by ingest time, but each version up to 60 days late, and
# a tenth of them again with the next landing.
STREAM_ENDS = ("1995-01-01", "1997-01-01")
LATE_DAYS = 60


def _land_out_of_order(spark, sf_dir, base: str, i: int) -> None:
    rec = _ranked(bronze_records(spark, sf_dir))
    some = F.xxhash64("_t2", "_t3", "_t1", "fixture.id")
    arrival = F.col("_ingest_timestamp").cast("timestamp") + F.make_dt_interval(
        F.pmod(some, F.lit(LATE_DAYS)).cast("int"))
    landing = F.lit(0)
    for end in STREAM_ENDS:
        landing = landing + (arrival >= F.lit(end).cast("timestamp")).cast("int")
    again = (landing == i - 1) & (F.pmod(some, F.lit(10)) == 0)
    (rec.where((landing == i) | again).select("fixture", "league", "teams", "goals", "score")
     .write.json(f"{base}/football/raw/landing_{i}", compression="gzip"))


@register("stream_latest_versions", O.with_views(
    f"SELECT {', '.join(STREAM_OUT)} FROM latest_v",
    chain=[O.BRONZE_V, O.CLEAN_V, O.CLEAN_RESULT_V, O.LATEST_V]))
def q_stream_latest_versions(spark, sf_dir):
    """Versions that land late, twice and out of order; Spark's state keeps the newest."""
    from laketier.sinks import tables
    from laketier.streaming.silver_stream import start_latest_stream
    base, path = scratch(spark, "landing"), scratch(spark, "versions")
    instant = F.timestamp_seconds(F.floor(F.col("fixture.timestamp") / 10))
    for i in range(len(STREAM_ENDS) + 1):
        _land_out_of_order(spark, sf_dir, base, i)
        start_latest_stream(spark, f"{base}/football/raw", path, "latest_" + path[-12:],
                            scratch(spark, "quarantine"), instant, VERSION_RANK,
                            f"{LATE_DAYS + 30} days").awaitTermination()
    return ntz(tables.read_table(spark, path).select(*STREAM_OUT), "match_datetime")


# --- gold tables refreshed from what changed in silver -------------------------------

# The second run corrects matches and moves some: to another league, or to no season.
_MOVED_V = """m_silver_v AS (
 SELECT * REPLACE (
  CASE WHEN match_id % 7 = 0 THEN (league_id + 1) % 5 ELSE league_id END AS league_id,
  CASE WHEN match_id % 50 = 0 THEN NULL ELSE season END AS season,
  upper(home_team_name) AS home_team_name) FROM s_silver_v)"""
_MERGED_V = ("silver_v AS (SELECT * FROM m_silver_v UNION ALL SELECT * FROM t_silver_v t "
             "WHERE NOT EXISTS (SELECT 1 FROM m_silver_v m WHERE m.match_id = t.match_id))")


def _views_of(prefix: str, *views: str) -> list[str]:
    """The same views over another silver."""
    out = []
    for v in views:
        for name in ("silver_v", "roles_v", "dim_team_v", "dim_date_v"):
            v = v.replace(name, prefix + name)
        out.append(v)
    return out


_REFRESH = [*_BATCHES, _MOVED_V, _MERGED_V]


def _gold_after_two_runs(spark, sf_dir, refresh, name):
    """Silver merged and gold refreshed twice."""
    from laketier.plans import jobs
    from laketier.schemas import SILVER_KEYS, SILVER_PARTITIONS
    from laketier.sinks import tables
    lake = jobs.Lake(scratch(spark, "lake"))
    b = bronze_records(spark, sf_dir)
    ts, split = F.col("_ingest_timestamp"), F.lit(SPLIT_AT).cast("timestamp_ntz")
    for cond, moved in ((ts < split, False), (ts >= split, True)):
        batch = silver.silver_matches(b.where(cond), tie_breakers=dt.TIE_BREAKERS)
        if moved:
            batch = batch.withColumns({
                "league_id": F.when(F.col("match_id") % 7 == 0, (F.col("league_id") + 1) % 5)
                .otherwise(F.col("league_id")),
                "season": F.when(F.col("match_id") % 50 != 0, F.col("season")),
                "home_team_name": F.upper("home_team_name")})
        tables.upsert_table(batch, lake.silver, SILVER_KEYS, SILVER_PARTITIONS)
        refresh(spark, lake)
    return tables.read_table(spark, lake.gold(name)).drop("_gold_processed_at")


@register("gold_refresh_fact", O.with_views(f"SELECT {O.FACT_OUT} FROM fact_v", O.FACT_V,
                                            chain=_REFRESH))
def q_gold_refresh_fact(spark, sf_dir):
    from laketier.plans import jobs
    return ntz(_gold_after_two_runs(spark, sf_dir, jobs.refresh_fact, "fact_match_stats"),
               "match_datetime")


@register("gold_refresh_dim_team", O.with_views(
    "SELECT * FROM dim_team_v UNION ALL SELECT * FROM t_dim_team_v t WHERE NOT EXISTS ("
    "SELECT 1 FROM dim_team_v d WHERE d.team_id = t.team_id "
    "AND d.season IS NOT DISTINCT FROM t.season)",
    O.ROLES_V, O.DIM_TEAM_V, *_views_of("t_", O.ROLES_V, O.DIM_TEAM_V), chain=_REFRESH))
def q_gold_refresh_dim_team(spark, sf_dir):
    from laketier.plans import jobs
    return _gold_after_two_runs(spark, sf_dir, jobs.refresh_dim_team, "dim_team")


@register("gold_refresh_dim_date", O.with_views(
    "SELECT * FROM dim_date_v UNION SELECT * FROM t_dim_date_v",
    O.DIM_DATE_V, *_views_of("t_", O.DIM_DATE_V), chain=_REFRESH))
def q_gold_refresh_dim_date(spark, sf_dir):
    from laketier.plans import jobs
    return _gold_after_two_runs(spark, sf_dir, jobs.refresh_dim_date, "dim_date")


@register("merge_upsert_dimension", O.with_views(
    _merge_sql("t_team", "s_team", ["team_id", "season"], "*"),
    O.ROLES_V, *_dim_team_sql("t_team", "season <= 1998", False),
    *_dim_team_sql("s_team", "season >= 1997", True)))
def q_merge_dimension(spark, sf_dir):
    """Two runs into an unpartitioned dimension table."""
    from laketier.sinks import tables
    s, path = silver_rows(spark, sf_dir), scratch(spark, "dim_team")
    tables.upsert_table(gold.dim_team(s.where("season <= 1998")), path, ["team_id", "season"])
    tables.upsert_table(gold.dim_team(s.where("season >= 1997"))
                        .withColumn("team_name", F.upper("team_name")), path, ["team_id", "season"])
    return tables.read_table(spark, path)


# --- row-level star joins --------------------------------------------------------

@register("star_rows_dates", O.with_views(
    "SELECT f.match_id, d.* EXCLUDE (date) FROM fact_v f LEFT JOIN dim_date_v d "
    "ON f.match_date = d.date", O.FACT_V, O.DIM_DATE_V))
def q_star_rows_dates(spark, sf_dir):
    from laketier.operators import star
    s = silver_rows(spark, sf_dir)
    fact = gold.fact_match_stats(s).select("match_id", "match_date")
    return star.with_dates(fact, gold.dim_date(s)).drop("match_date")


@register("star_rows_teams", O.with_views(
    "SELECT f.match_id, h.team_name AS home_team_name, a.team_name AS away_team_name FROM fact_v f "
    "LEFT JOIN dim_team_v h ON f.home_team_id = h.team_id AND f.season = h.season "
    "LEFT JOIN dim_team_v a ON f.away_team_id = a.team_id AND f.season = a.season",
    O.FACT_V, O.ROLES_V, O.DIM_TEAM_V))
def q_star_rows_teams(spark, sf_dir):
    from laketier.operators import star
    s = silver_rows(spark, sf_dir)
    return star.with_team_names(gold.fact_match_stats(s), gold.dim_team(s)).select(
        "match_id", "home_team_name", "away_team_name")


# --- API documents as files ----------------------------------------------------------

ENVELOPE_DATE = "2024-11-01"


def _documents(lines: DataFrame) -> DataFrame:
    """API documents (value) of up to PAGE_IDS of the records (line, as JSON) of one task,
    which are not shuffled, a record a line."""
    page = PAGE_IDS

    def document(records):
        return ('{"get": "fixtures",\n "results": %d,\n "response": [\n%s]}' % (
            len(records), ",\n".join(records)))

    def pages(batches):
        import pyarrow as pa
        held = []
        for batch in batches:
            held += batch.column(0).to_pylist()
            while len(held) >= page:
                yield pa.RecordBatch.from_pydict({"value": [document(held[:page])]})
                held = held[page:]
        if held:
            yield pa.RecordBatch.from_pydict({"value": [document(held)]})
    return lines.mapInArrow(pages, "value string")


def _land_envelopes(spark, sf_dir) -> str:
    """API documents as gzipped multi-line JSON files, one page a file, below
    ``<base>/football/raw/<date>/league_<id>/``; a truncated document and an error
    document lie among them."""
    base = scratch(spark, "landing")
    # small rows are staged, not documents: Spark reads Parquet by thousands of rows at once
    records = staged(bronze_records(spark, sf_dir).select(
        F.col("league.id").alias("league_no"),
        F.struct("fixture", "league", "teams", "goals", "score").alias("r")), "envelopes")
    folder = f"{base}/football/raw/{ENVELOPE_DATE}"
    bad = {0: '{"get": "fixtures",\n "response": [{"fixture": {"id": 1, "da',
           1: '{"get": "fixtures",\n "results": 0}'}
    leagues = {r[0] for r in records.select("league_no").distinct().collect()}
    for league in leagues | set(bad):  # a folder for each league
        docs = _documents(records.where(F.col("league_no").eqNullSafe(F.lit(league)))
                          .select(F.to_json("r").alias("line")))
        if league in bad:
            docs = docs.unionByName(spark.createDataFrame([(bad[league],)], "value string"))
        docs.write.option("maxRecordsPerFile", 1).text(f"{folder}/league_{league}", compression="gzip")
    return base


@register("src_envelope_files", O.with_views(
    f"SELECT {FLAT_RAW_SQL} FROM bronze_v", chain=[O.BRONZE_V]))
def q_src_envelope_files(spark, sf_dir):
    """Multi-line documents from the landing layout; two of them are unreadable."""
    from laketier.sources import landing
    raw = landing.read_landed(spark, landing.landing_path(
        _land_envelopes(spark, sf_dir), "football", ENVELOPE_DATE))
    rows = landing.fixture_rows(raw).withColumn("_ingest_timestamp", F.lit(None).cast("timestamp"))
    return ntz(silver.flatten(rows).select(*FLAT_RAW), "match_datetime")


@register("src_envelope_quarantine", O.with_views(
    "SELECT 'league_0' AS folder, CAST(1 AS BIGINT) AS documents WHERE EXISTS (SELECT 1 FROM bronze_v) "
    "UNION ALL SELECT 'league_1', 1 WHERE EXISTS (SELECT 1 FROM bronze_v)", chain=[O.BRONZE_V]))
def q_src_envelope_quarantine(spark, sf_dir):
    """The documents that gave no rows, by landing folder."""
    from laketier.sources import landing
    raw = landing.read_landed(spark, landing.landing_path(
        _land_envelopes(spark, sf_dir), "football", ENVELOPE_DATE))
    folder = F.regexp_extract(landing.SOURCE_FILE, r"/(league_\d+)/", 1)
    return (landing.corrupt_rows(raw).groupBy(folder.alias("folder"))
            .agg(F.count("*").alias("documents")))


# --- reconciled envelopes ------------------------------------------------------------

PAGE_MATCHES = 1000
STRETCH = 1000  # blocks
# What goes wrong on the way: records cut from pages, pages that never land, errors.
CUT, LOST, FAILED = "match_id % 97 = 0", "block % 11 = 3", "block % 13 = 5"


@register("src_envelope_reconcile", O.with_views(f"""
    SELECT CAST(league_id AS VARCHAR) AS league, CAST(count(*) AS HUGEINT)::BIGINT AS documents,
     pages AS pages_expected, count(*) AS pages_seen, CAST(sum(results) AS BIGINT) AS results,
     CAST(sum(arrived) AS BIGINT) AS rows, count(*) FILTER (results <> arrived) AS short_documents,
     count(*) FILTER ({FAILED}) AS error_documents,
     count(*) >= pages AND count(*) FILTER (results <> arrived) = 0
      AND count(*) FILTER ({FAILED}) = 0 AS complete
    FROM (SELECT *, count(*) OVER (PARTITION BY league_id) AS pages FROM (
     SELECT league_id, match_id // {PAGE_MATCHES} AS block, count(*) AS results,
      count(*) FILTER (NOT ({CUT})) AS arrived FROM bronze_v GROUP BY 1, 2))
    WHERE NOT ({LOST}) GROUP BY league_id, pages""", chain=[O.BRONZE_V]))
def q_src_envelope_reconcile(spark, sf_dir):
    """Paged API documents, some cut short, lost or with errors, reconciled by league."""
    from laketier.operators.reconcile import request_report
    from laketier.sources import landing
    base = scratch(spark, "landing")
    # a page holds a fixed range of matches, so it does not grow with the data
    records = staged(bronze_records(spark, sf_dir).select(
        F.struct("fixture", "league", "teams", "goals", "score").alias("r"),
        F.col("fixture.id").alias("match_id"), F.col("league.id").alias("league_id"),
        F.floor(F.col("fixture.id") / PAGE_MATCHES).alias("block")), "records")
    # pages are numbered by their keys alone: by stretches of blocks, then inside each
    blocks = records.groupBy("league_id", "block").agg(F.count("*").alias("results")).withColumn(
        "stretch", F.floor(F.col("block") / STRETCH))
    before = Window.partitionBy("league_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = blocks.groupBy("league_id", "stretch").agg(F.count("*").alias("n")).select(
        "league_id", "stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"),
        F.sum("n").over(Window.partitionBy("league_id")).alias("total"))
    order = Window.partitionBy("league_id", "stretch").orderBy("block")
    numbered = staged(blocks.withColumn("place", F.row_number().over(order))
                      .join(stretches, ["league_id", "stretch"]).where(f"NOT ({LOST})")
                      .select("league_id", "block", "results", "total",
                              (F.col("earlier") + F.col("place")).alias("current")), "pages")
    # the numbers go to the records, which are small and many, not to whole pages
    page = ["league_id", "block", "results", "total", "current"]
    pages = records.join(numbered, ["league_id", "block"]).groupBy(*page).agg(
        F.collect_list(F.when(~F.expr(CUT), F.col("r"))).alias("response"))
    documents = pages.select(F.to_json(F.struct(
        F.lit("fixtures").alias("get"),
        F.struct(F.col("league_id").cast("string").alias("league")).alias("parameters"),
        F.when(F.expr(FAILED), F.array(F.lit("rate limit"))).otherwise(F.array()).alias("errors"),
        "results", F.struct("current", "total").alias("paging"), "response")).alias("value"))
    documents.write.option("maxRecordsPerFile", 1).text(f"{base}/football/raw/{ENVELOPE_DATE}", compression="gzip")
    raw = landing.read_landed(spark, landing.landing_path(base, "football", ENVELOPE_DATE))
    return request_report(raw, by=["league"])


# --- schemas of two runs ---------------------------------------------------------------

def _drift_sql() -> str:
    changes = [("referee", "added", None, "string"), ("venue_city", "removed", "string", None),
               ("home_goals", "retyped", "int", "bigint"), ("match_id", "moved", "int", "int"),
               ("match_datetime", "moved", "timestamp", "timestamp")]

    def text(v):
        return "CAST(NULL AS VARCHAR)" if v is None else f"'{v}'"
    filled = {"referee": f"count(*) FILTER (_ingest_timestamp >= TIMESTAMP '{SPLIT_AT}')",
              "venue_city": "0 * count(*)"}
    return " UNION ALL ".join(
        f"SELECT 'bronze' AS stage, '{c}' AS column, '{change}' AS change, {text(a)} AS type_before, "
        f"{text(b)} AS type_after, CAST({filled.get(c, f'count({c})')} AS BIGINT) AS filled FROM bronze_v"
        for c, change, a, b in changes)


@register("obs_schema_drift", O.with_views(_drift_sql(), chain=[O.BRONZE_V]))
def q_obs_schema_drift(spark, sf_dir):
    """A stage written by two runs: what became of its columns, and how many rows of the
    later run have a value there."""
    from laketier.plans.metrics import schema_drift, schema_rows
    flat = silver.flatten(bronze_records(spark, sf_dir)).drop("_source_file")
    before = staged(flat, "run-1")
    split = F.lit(SPLIT_AT).cast("timestamp_ntz")
    cols = ["match_datetime", "match_id", *[c for c in before.columns if c not in (
        "match_datetime", "match_id", "venue_city")]]
    after = staged(before.select(*cols).withColumns({
        "home_goals": F.col("home_goals").cast("bigint"),
        "referee": F.when(F.col("_ingest_timestamp") >= split, F.lit("R. Eferee"))}), "run-2")
    drift = schema_drift(schema_rows(spark, {"bronze": before}), schema_rows(spark, {"bronze": after}))
    counts = after.agg(*[F.count(c).alias(c) for c in after.columns])
    filled = counts.select(F.explode(F.create_map(*[x for c in after.columns
                                                    for x in (F.lit(c), F.col(c))])).alias("column", "filled"))
    return drift.join(filled, "column", "left").select(
        "stage", "column", "change", "type_before", "type_after",
        F.coalesce("filled", F.lit(0)).cast("bigint").alias("filled"))


# --- a summary kept in parts --------------------------------------------------------------

@register("gold_refresh_summary", O.with_views(
    "SELECT season, count(match_id) AS total_matches, CAST(sum(total_goals) AS BIGINT) AS total_goals, "
    "avg(total_goals) AS avg_goals_per_match FROM fact_v GROUP BY season", O.FACT_V, chain=_REFRESH))
def q_gold_refresh_summary(spark, sf_dir):
    """Parts kept per league and season over two runs, added up by season."""
    from laketier.plans import jobs

    def refresh(spark, lake):
        jobs.refresh_fact(spark, lake)
        jobs.refresh_summary(spark, lake)
    parts = _gold_after_two_runs(spark, sf_dir, refresh, "summary_parts")
    return gold.merged_summary(parts, ["season"])
