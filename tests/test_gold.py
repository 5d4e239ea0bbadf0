"""Gold grain and star properties (row 12, SURVEY §5 properties)."""

import json

from pyspark.sql import functions as F

import fixtures as fx
from laketier.operators import gold, silver, star
from laketier.schemas import FIXTURE_RECORD
from laketier.sources import driver_tables as dt

SF = "/root/testdata/sf0.001"


def bronze(spark, records):
    df = spark.createDataFrame([(json.dumps(r),) for r in records], "j string")
    return df.select(F.from_json("j", FIXTURE_RECORD).alias("r")).select("r.*").withColumns({
        "_ingest_timestamp": F.lit("2024-11-02 06:00:00").cast("timestamp"),
        "_source_file": F.lit("f")})


def test_sample_dims_and_summary(spark):
    s = silver.silver_matches(bronze(spark, fx.SAMPLE))
    assert gold.dim_team(s).count() == 4
    d = gold.dim_date(s).collect()
    assert len(d) == 1
    r = d[0]
    assert (r.quarter, r.week_of_year, r.day_name, r.day_of_week, r.is_weekend) == \
        (4, 44, "Friday", 6, False)
    summ = gold.league_season_summary(gold.fact_match_stats(s)).collect()
    assert [tuple(x) for x in summ] == [(39, 2024, 2, 5, 2.5)]


def test_team_in_two_leagues_one_row_per_key(spark):
    recs = [fx.fixture(1, "2024-09-01T15:00:00+00:00", "FT", (5, "Club"), (6, "Other"), (1, 0),
                       league=(39, "League A")),
            fx.fixture(2, "2024-10-01T15:00:00+00:00", "FT", (7, "Third"), (5, "Club"), (0, 2),
                       league=(45, "Cup B"))]
    s = silver.silver_matches(bronze(spark, recs))
    assert gold.dim_team_distinct(s).where("team_id = 5").count() == 2
    rows = gold.dim_team(s).where("team_id = 5").collect()
    assert len(rows) == 1 and rows[0].league_id == 45  # its latest match


def test_points_sum(spark):
    fact = gold.fact_match_stats(silver.silver_matches(
        dt.fixture_records(spark, SF), tie_breakers=dt.TIE_BREAKERS))
    bad = fact.where(
        ((F.col("match_result") == "DRAW") & (F.col("home_team_points") + F.col("away_team_points") != 2))
        | ((F.col("match_result") != "DRAW") & (F.col("home_team_points") + F.col("away_team_points") != 3)))
    assert bad.count() == 0


def test_star_is_whole(spark):
    s = silver.silver_matches(dt.fixture_records(spark, SF), tie_breakers=dt.TIE_BREAKERS)
    assert star.orphans(gold.fact_match_stats(s), gold.dim_team(s), gold.dim_date(s)).count() == 0
    assert s.groupBy("match_id").count().where("count > 1").count() == 0


def test_row_level_star_joins(spark):
    s = silver.silver_matches(dt.fixture_records(spark, SF), tie_breakers=dt.TIE_BREAKERS)
    fact = gold.fact_match_stats(s)
    joined = star.with_team_names(star.with_dates(fact, gold.dim_date(s)), gold.dim_team(s))
    assert joined.count() == fact.count()
    assert joined.where("day_name IS NULL OR home_team_name IS NULL "
                        "OR away_team_name IS NULL").count() == 0
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
