"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each query is ``WITH <views> SELECT ...`` over the driver's tables. The
views mirror ``laketier.sources.driver_tables`` (bronze) and the silver
operators; they are written independently in SQL, so agreement checks the
DataFrame code rather than restating it.
"""

from __future__ import annotations

BRONZE_V = """bronze_v AS (
 SELECT TRY_CAST(o.o_orderkey AS INTEGER) AS match_id,
  o.o_orderdate AS match_datetime,
  CAST(o.o_orderdate AS DATE) AS match_date,
  CASE WHEN l.l_returnflag = 'N' THEN 'FT'
       WHEN l.l_returnflag = 'A' AND l.l_linestatus = 'O' THEN 'NS'
       WHEN l.l_returnflag = 'A' THEN 'LIVE' ELSE 'PST' END AS match_status,
  concat('  ', c.c_mktsegment, ' ') AS venue_name, o.o_orderpriority AS venue_city,
  r.r_regionkey AS league_id, concat(' ', r.r_name) AS league_name,
  CAST(year(o.o_orderdate) AS INTEGER) AS season,
  concat('Regular Season - ', CAST(month(o.o_orderdate) AS VARCHAR)) AS round,
  c.c_nationkey AS home_team_id, concat(h.n_name, ' ') AS home_team_name,
  CAST(a.n_nationkey AS INTEGER) AS away_team_id, a.n_name AS away_team_name,
  CASE WHEN l.l_linenumber = 7 THEN NULL ELSE CAST(l.l_quantity AS INTEGER) % 5 END AS home_goals,
  CASE WHEN l.l_linenumber = 7 THEN NULL ELSE CAST(l.l_suppkey % 4 AS INTEGER) END AS away_goals,
  CASE WHEN l.l_linenumber = 7 THEN NULL
       ELSE CAST(floor((CAST(l.l_quantity AS INTEGER) % 5) / 2.0) AS INTEGER) END AS ht_home_goals,
  CASE WHEN l.l_linenumber = 7 THEN NULL
       ELSE CAST(floor((l.l_suppkey % 4) / 2.0) AS INTEGER) END AS ht_away_goals,
  l.l_shipdate AS _ingest_timestamp,
  l.l_linenumber AS _t1, l.l_partkey AS _t2, l.l_suppkey AS _t3
 FROM lineitem l
 JOIN orders o ON l.l_orderkey = o.o_orderkey
 JOIN customer c ON o.o_custkey = c.c_custkey
 JOIN nation h ON c.c_nationkey = h.n_nationkey
 JOIN region r ON h.n_regionkey = r.r_regionkey
 JOIN nation a ON a.n_nationkey = (c.c_nationkey + 1 + o.o_orderkey % 24) % 25)"""

_CLEAN_T = """{p}clean_v AS (
 SELECT match_id, match_datetime, match_date,
  CASE match_status WHEN 'FT' THEN 'FINISHED' WHEN 'NS' THEN 'NOT_STARTED'
       WHEN 'LIVE' THEN 'LIVE' ELSE match_status END AS match_status,
  trim(venue_name) AS venue_name, venue_city, league_id, trim(league_name) AS league_name,
  season, round, home_team_id, trim(home_team_name) AS home_team_name,
  away_team_id, trim(away_team_name) AS away_team_name,
  coalesce(home_goals, 0) AS home_goals, coalesce(away_goals, 0) AS away_goals,
  ht_home_goals, ht_away_goals, _ingest_timestamp, _t1, _t2, _t3
 FROM {src})"""

_RESULT_T = """{p}clean_result_v AS (
 SELECT *, CASE WHEN home_goals > away_goals THEN 'HOME_WIN'
                WHEN home_goals < away_goals THEN 'AWAY_WIN'
                WHEN home_goals = away_goals THEN 'DRAW' ELSE 'UNKNOWN' END AS match_result,
        home_goals + away_goals AS total_goals
 FROM {p}clean_v)"""

_LATEST_T = """{p}latest_v AS (
 SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY match_id
     ORDER BY _ingest_timestamp DESC, _t1 DESC, _t2 DESC, _t3 DESC) AS rn
  FROM {p}clean_result_v) WHERE rn = 1)"""

_SILVER_T = """{p}silver_v AS (SELECT * FROM {p}latest_v WHERE match_status = 'FINISHED')"""


def silver_ctes(prefix: str = "", bronze_where: str | None = None) -> list[str]:
    """CTEs ``<prefix>clean_v .. <prefix>silver_v`` over ``bronze_v [WHERE ...]``."""
    src = "bronze_v" if not bronze_where else f"(SELECT * FROM bronze_v WHERE {bronze_where})"
    return [t.format(p=prefix, src=src) for t in (_CLEAN_T, _RESULT_T, _LATEST_T, _SILVER_T)]


CLEAN_V, CLEAN_RESULT_V, LATEST_V, SILVER_V = silver_ctes()

FACT_V = """fact_v AS (
 SELECT match_id, match_date, match_datetime, league_id, season, round,
  home_team_id, away_team_id, home_goals, away_goals, ht_home_goals, ht_away_goals,
  total_goals, match_result, venue_name, venue_city,
  CASE match_result WHEN 'HOME_WIN' THEN 3 WHEN 'DRAW' THEN 1 ELSE 0 END AS home_team_points,
  CASE match_result WHEN 'AWAY_WIN' THEN 3 WHEN 'DRAW' THEN 1 ELSE 0 END AS away_team_points,
  home_goals - away_goals AS goal_difference
 FROM silver_v)"""

ROLES_V = """roles_v AS (
 SELECT home_team_id AS team_id, home_team_name AS team_name, league_id, league_name, season,
        match_date, match_id FROM silver_v
 UNION ALL
 SELECT away_team_id, away_team_name, league_id, league_name, season, match_date, match_id
 FROM silver_v)"""

DIM_TEAM_V = """dim_team_v AS (
 SELECT team_id, team_name, league_id, league_name, season FROM (
  SELECT *, row_number() OVER (PARTITION BY team_id, season
     ORDER BY match_date DESC, match_id DESC, league_id DESC) AS rn FROM roles_v)
 WHERE rn = 1)"""

DIM_DATE_V = """dim_date_v AS (
 SELECT d AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
  CAST(day(d) AS INTEGER) AS day, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
  monthname(d) AS month_name, dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
 FROM (SELECT DISTINCT match_date AS d FROM silver_v))"""

_SILVER_CHAIN = [BRONZE_V, CLEAN_V, CLEAN_RESULT_V, LATEST_V, SILVER_V]


def with_views(body: str, *extra: str, chain: list[str] | None = None) -> str:
    views = list(chain if chain is not None else _SILVER_CHAIN) + list(extra)
    return ("WITH " + ",\n".join(views) + "\n" + body) if views else body


# Column list of the silver rows as the registered queries return them
# (audit stamp and lineage path left out: they differ per run).
SILVER_OUT = """match_id, match_datetime, match_date, match_status, venue_name, venue_city,
 league_id, league_name, season, round, home_team_id, home_team_name, away_team_id,
 away_team_name, home_goals, away_goals, ht_home_goals, ht_away_goals, _ingest_timestamp,
 match_result, total_goals"""

FACT_OUT = """match_id, match_date, match_datetime, league_id, season, round, home_team_id,
 away_team_id, home_goals, away_goals, ht_home_goals, ht_away_goals, total_goals, match_result,
 venue_name, venue_city, home_team_points, away_team_points, goal_difference"""


def _sql_lit(v) -> str:
    return "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else repr(v)


def dq_sql(rules, table: str, columns: list[str]) -> str:
    """One SELECT per rule over ``table`` (a CTE name), UNION ALL, by rule id."""
    parts = []
    for r in rules:
        head = (f"SELECT CAST({r.rule_id} AS INTEGER) AS rule_id, "
                f"'{r.expectation_type}' AS expectation_type, "
                f"CAST({_sql_lit(r.column) if r.column else 'NULL'} AS VARCHAR) AS column, "
                f"'{r.severity}' AS severity, ")
        t = r.expectation_type
        ok = f"(ev = 0 OR (ev - un) / ev >= {float(r.mostly)!r})"
        if t == "expect_column_to_exist":
            parts.append(head + "CAST(NULL AS BIGINT) AS evaluated, CAST(NULL AS BIGINT) AS "
                         f"unexpected, {str(r.column in columns).upper()} AS success")
            continue
        if t == "expect_table_row_count_to_be_between":
            conds = ["TRUE"]
            if r.min_value is not None:
                conds.append(f"ev >= {r.min_value}")
            if r.max_value is not None:
                conds.append(f"ev <= {r.max_value}")
            parts.append(head + f"ev AS evaluated, CAST(NULL AS BIGINT) AS unexpected, "
                         f"({' AND '.join(conds)}) AS success "
                         f"FROM (SELECT count(*) AS ev FROM {table})")
            continue
        if r.column not in columns:
            parts.append(head + "CAST(NULL AS BIGINT) AS evaluated, CAST(NULL AS BIGINT) AS "
                         "unexpected, FALSE AS success")
            continue
        c = r.column
        if t == "expect_column_values_to_be_unique":
            inner = (f"SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS ev, "
                     f"CAST(coalesce(sum(CASE WHEN n > 1 THEN n ELSE 0 END), 0) AS BIGINT) AS un "
                     f"FROM (SELECT {c}, count(*) AS n FROM {table} WHERE {c} IS NOT NULL "
                     f"GROUP BY {c})")
        else:
            if t == "expect_column_values_to_not_be_null":
                ev, bad = "count(*)", f"{c} IS NULL"
            elif t == "expect_column_values_to_be_between":
                conds = []
                if r.min_value is not None:
                    conds.append(f"{c} < {r.min_value}")
                if r.max_value is not None:
                    conds.append(f"{c} > {r.max_value}")
                ev, bad = f"count({c})", " OR ".join(conds) or "FALSE"
            elif t == "expect_column_values_to_be_in_set":
                ev, bad = f"count({c})", f"{c} NOT IN ({', '.join(map(_sql_lit, r.value_set))})"
            elif t == "expect_column_values_to_match_regex":
                ev, bad = f"count({c})", f"NOT regexp_matches(CAST({c} AS VARCHAR), {_sql_lit(r.regex)})"
            else:
                raise ValueError(t)
            inner = (f"SELECT count(*) FILTER (WHERE {bad}) AS un, {ev} AS ev FROM {table}")
        parts.append(head + f"ev AS evaluated, un AS unexpected, {ok} AS success FROM ({inner})")
    return "\nUNION ALL\n".join(parts) + "\nORDER BY rule_id"
