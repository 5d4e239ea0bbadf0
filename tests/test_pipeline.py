"""Daily run end to end on hand-written landed files, reruns, the gate, streaming."""

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from laketier.operators import quality as Q
from laketier.plans import jobs
from laketier.sinks import tables
from laketier.streaming.silver_stream import start_latest_stream, start_silver_stream


def test_daily_run_sample(spark, workdir):
    landing, lake_base = f"{workdir}/landing", f"{workdir}/lake"
    fx.land(landing, "football", "2024-11-01", 39, fx.envelope(fx.SAMPLE))
    out = jobs.run_daily(spark, landing, lake_base, "2024-11-01")
    assert (out["bronze"], out["quarantined"], out["silver_batch"]) == (2, 0, 2)
    lake = jobs.Lake(lake_base)
    assert [tuple(r) for r in jobs.league_summary(spark, lake).collect()] == [(39, 2024, 2, 5, 2.5)]
    log = spark.read.parquet(lake.run_log)
    assert log.where("status = 'SUCCESS'").select("run_id").distinct().count() == 1

    # a score correction lands the next day: silver and the fact are updated
    fixed = [fx.fixture(700002, "2024-11-01T17:30:00+00:00", "FT", (503, "Vale Rovers"),
                        (504, "Eastmoor"), (2, 1), (0, 1))]
    fx.land(landing, "football", "2024-11-02", 39, fx.envelope(fixed, date="2024-11-02"))
    jobs.run_daily(spark, landing, lake_base, "2024-11-02")
    fact = {r.match_id: r for r in tables.read_table(spark, lake.gold("fact_match_stats")).collect()}
    assert len(fact) == 2 and fact[700002].match_result == "HOME_WIN"
    assert tables.read_table(spark, lake.silver).count() == 2

    # re-running a date appends bronze again, yet silver stays one row per match
    jobs.run_daily(spark, landing, lake_base, "2024-11-02")
    assert jobs.read_bronze(spark, lake, "2024-11-02").count() == 2
    s = tables.read_table(spark, lake.silver)
    assert s.count() == 2 and s.where("match_id = 700002").first().home_goals == 2

    # only the requested ingest date's folder is listed and read
    day = jobs.read_bronze(spark, lake, "2024-11-01")
    files = day.inputFiles()
    assert files and all("_ingest_date=2024-11-01" in f for f in files)
    assert day.count() == 2

    names = jobs.register_all(spark, lake, prefix="pipeline_test")
    assert spark.table(names[-1]).count() == 2
    assert spark.table(names[0]).count() == 4  # bronze: every landed version
    jobs.maintain_layout(spark, lake)
    assert jobs.refresh_fact(spark, lake)["fact_partitions_rebuilt"] == 0
    assert tables.read_table(spark, lake.silver).count() == 2


def test_gold_with_no_season(spark, workdir):
    landing, lake_base = f"{workdir}/landing", f"{workdir}/lake"
    lake = jobs.Lake(lake_base)
    for day, goals in (("2024-11-01", (1, 0)), ("2024-11-02", (2, 2)), ("2024-11-03", (0, 3))):
        recs = [fx.fixture(1, "2024-11-01T20:00:00+00:00", "FT", (1, "A"), (2, "B"), goals),
                fx.fixture(2, "2024-11-01T20:00:00+00:00", "FT", (3, "C"), (4, "D"), goals,
                           season=None)]
        fx.land(landing, "football", day, 39, fx.envelope(recs, date=day))
        jobs.run_daily(spark, landing, lake_base, day)
    teams = tables.read_table(spark, lake.gold("dim_team")).collect()
    assert sorted((r.team_id, r.season or 0) for r in teams) == [(1, 2024), (2, 2024), (3, 0), (4, 0)]
    fact = tables.read_table(spark, lake.gold("fact_match_stats")).collect()
    assert sorted((r.match_id, r.total_goals) for r in fact) == [(1, 3), (2, 3)]


def test_critical_failure_stops_before_gold(spark, workdir):
    landing, lake_base = f"{workdir}/landing", f"{workdir}/lake"
    no_team = fx.fixture(5, "2024-11-01T20:00:00+00:00", "FT", (None, "Ghost"), (2, "B"), (1, 0))
    fx.land(landing, "football", "2024-11-01", 39, fx.envelope([no_team]))
    with pytest.raises(Q.QualityGateError):
        jobs.run_daily(spark, landing, lake_base, "2024-11-01")
    lake = jobs.Lake(lake_base)
    assert not tables.table_exists(spark, lake.gold("fact_match_stats"))
    assert spark.read.parquet(lake.run_log).where("status = 'FAILED'").count() >= 1


def test_stream_merges_each_batch(spark, workdir):
    root = f"{workdir}/landing/football/raw"
    recs = [fx.fixture(i, "2024-11-01T20:00:00+00:00", "FT", (1, "A"), (2, "B"), (i % 3, 1))
            for i in range(1, 6)]
    fx.land_records(f"{workdir}/landing", "football", "2024-11-01", 39, recs)
    silver_path = f"{workdir}/silver"
    q = start_silver_stream(spark, root, silver_path, name="t_stream_a",
                            quarantine_path=f"{workdir}/bad")
    q.awaitTermination()
    assert tables.read_table(spark, silver_path).count() == 5
    # a later file updates one match and adds one
    more = [fx.fixture(3, "2024-11-01T20:00:00+00:00", "FT", (1, "A"), (2, "B"), (9, 0)),
            fx.fixture(6, "2024-11-01T20:00:00+00:00", "FT", (1, "A"), (2, "B"), (0, 0))]
    fx.land_records(f"{workdir}/landing", "football", "2024-11-02", 39, more)
    fx.land(f"{workdir}/landing", "football", "2024-11-02", 40, text='{"fixture": {"id": 7, "da\n')
    q = start_silver_stream(spark, root, silver_path, name="t_stream_a",
                            quarantine_path=f"{workdir}/bad")
    q.awaitTermination()
    s = tables.read_table(spark, silver_path)
    assert s.count() == 6 and s.where("match_id = 3").first().home_goals == 9
    assert s.where(F.col("match_id") == 3).first().match_result == "HOME_WIN"
    bad = spark.read.parquet(f"{workdir}/bad").collect()  # the truncated line is kept aside
    assert len(bad) == 1 and "league_40" in bad[0]["_source_file"]


def test_a_replayed_batch_leaves_the_same_quarantine(spark, workdir, monkeypatch):
    root, bad, silver_path = f"{workdir}/landing/football/raw", f"{workdir}/bad", f"{workdir}/silver"
    good = fx.fixture(1, "2024-11-01T20:00:00+00:00", "FT", (1, "A"), (2, "B"), (1, 0))
    fx.land_records(f"{workdir}/landing", "football", "2024-11-01", 39, [good])
    fx.land(f"{workdir}/landing", "football", "2024-11-01", 40, text='{"fixture": {"id": 7, "da\n')

    def run():
        start_silver_stream(spark, root, silver_path, name="t_stream_replay",
                            quarantine_path=bad).awaitTermination()

    def lost(*args, **kwargs):
        raise OSError("lost after the quarantine was written")
    with monkeypatch.context() as m:
        m.setattr(tables, "upsert_table", lost)
        with pytest.raises(Exception):
            run()
    first = spark.read.parquet(bad).drop("_ingest_timestamp").collect()
    run()  # the same epoch again
    assert len(first) == 1 and first[0]["epoch"] == 0 and first[0]["stream"] == "t_stream_replay"
    assert spark.read.parquet(bad).drop("_ingest_timestamp").collect() == first
    assert tables.read_table(spark, silver_path).count() == 1


def test_stream_keeps_the_newest_version_of_late_and_repeated_ones(spark, workdir):
    root, path = f"{workdir}/landing/football/raw", f"{workdir}/versions"

    def version(match, at, goals, tie=0):
        rec = fx.fixture(match, "2024-11-01T20:00:00+00:00", "FT", (1, "A"), (2, "B"), (goals, 0))
        rec["fixture"]["timestamp"] = at
        rec["fixture"]["periods"] = {"first": tie, "second": None}
        return rec

    def landed(day, *recs):
        fx.land_records(f"{workdir}/landing", "football", day, 39, list(recs))
        start_latest_stream(spark, root, path, "t_latest", f"{workdir}/bad",
                            F.timestamp_seconds("fixture.timestamp"),
                            ["fixture.timestamp", "fixture.periods.first"], "1 hour").awaitTermination()
        return {r.match_id: r.home_goals for r in tables.read_table(spark, path).collect()}
    assert landed("2024-11-01", version(1, 50_000, 1), version(1, 50_100, 2), version(2, 50_000, 1)
                  ) == {1: 2, 2: 1}
    # out of order, twice, a tie told by its second rank; match 3 is new though older
    assert landed("2024-11-02", version(1, 50_050, 8), version(1, 50_100, 2), version(2, 50_000, 5, 1),
                  version(3, 49_000, 3)) == {1: 2, 2: 5, 3: 3}
    # the watermark moves far ahead; what is older than it is dropped from then on
    assert landed("2024-11-03", version(4, 900_000, 4)) == {1: 2, 2: 5, 3: 3, 4: 4}
    assert landed("2024-11-04", version(1, 60_000, 9), version(2, 899_000, 6)) == {
        1: 2, 2: 6, 3: 3, 4: 4}


def test_fact_refresh_rebuilds_only_changed_partitions(spark, workdir):
    landing, lake_base = f"{workdir}/landing", f"{workdir}/lake"
    day1 = [fx.fixture(i, "2024-11-01T20:00:00+00:00", "FT", (1, "A"), (2, "B"), (1, 0),
                       league=(lg, f"L{lg}")) for i, lg in ((1, 39), (2, 39), (3, 61), (4, 78))]
    fx.land(landing, "football", "2024-11-01", 39, fx.envelope(day1))
    out = jobs.run_daily(spark, landing, lake_base, "2024-11-01")
    assert out["fact_partitions_rebuilt"] == 3
    # day 2 corrects match 3 (league 61) and moves match 2 from league 39 to 61
    day2 = [fx.fixture(3, "2024-11-01T20:00:00+00:00", "FT", (1, "A"), (2, "B"), (4, 4),
                       league=(61, "L61")),
            fx.fixture(2, "2024-11-01T20:00:00+00:00", "FT", (1, "A"), (2, "B"), (0, 2),
                       league=(61, "L61"))]
    fx.land(landing, "football", "2024-11-02", 61, fx.envelope(day2, date="2024-11-02"))
    out = jobs.run_daily(spark, landing, lake_base, "2024-11-02")
    assert out["fact_partitions_rebuilt"] == 2  # leagues 39 and 61; 78 carried forward
    lake = jobs.Lake(lake_base)
    fact = {r.match_id: r for r in tables.read_table(
        spark, lake.gold("fact_match_stats")).collect()}
    assert sorted(fact) == [1, 2, 3, 4]
    assert (fact[2].league_id, fact[2].match_result) == (61, "AWAY_WIN")
    assert fact[3].total_goals == 8
    # the fact equals the projection of the whole silver table
    from laketier.operators import gold
    want = gold.fact_match_stats(tables.read_table(spark, lake.silver))
    got = tables.read_table(spark, lake.gold("fact_match_stats")).drop("_gold_processed_at")
    assert sorted(map(tuple, got.select(*want.columns).collect())) == \
        sorted(map(tuple, want.collect()))
    # nothing changed in silver: nothing is rebuilt
    assert jobs.refresh_fact(spark, lake)["fact_partitions_rebuilt"] == 0
    # the incrementally kept dimensions equal a rebuild from all of silver
    s_all = tables.read_table(spark, lake.silver)
    for name, build in (("dim_team", gold.dim_team), ("dim_date", gold.dim_date)):
        kept = tables.read_table(spark, lake.gold(name)).drop("_gold_processed_at")
        assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, build(s_all).collect()))


def test_silver_reads_only_used_nested_fields(spark, workdir):
    landing, lake_base = f"{workdir}/landing", f"{workdir}/lake"
    fx.land(landing, "football", "2024-11-01", 39, fx.envelope(fx.SAMPLE))
    lake = jobs.Lake(lake_base)
    jobs.ingest_bronze(spark, landing, lake, "2024-11-01")
    from laketier.operators import silver
    df = silver.silver_matches(jobs.read_bronze(spark, lake, "2024-11-01"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    read = [ln for ln in plan.splitlines() if "ReadSchema" in ln][0]
    for used in ("venue:struct<name", "status:struct<short", "halftime:struct<home"):
        assert used in read
    for unused in ("referee", "logo", "extratime", "penalty", "periods"):
        assert unused not in read


def test_ids_that_are_no_int_are_quarantined(spark, workdir):
    landing, lake = f"{workdir}/landing", jobs.Lake(f"{workdir}/lake")
    recs = [fx.fixture(i, "2024-11-01T20:00:00+00:00", "FT", (1, "A"), (2, "B"), (1, 0))
            for i in (1, 2, 2**31, 2**40, None)]
    fx.land(landing, "football", "2024-11-01", 39, fx.envelope(recs))
    out = jobs.run_daily(spark, landing, lake.base, "2024-11-01")
    assert (out["bronze"], out["quarantined"], out["silver_batch"]) == (2, 3, 2)
    kept = [r["_corrupt_record"] for r in spark.read.parquet(lake.quarantine).collect()]
    assert sum(str(2**40) in k for k in kept) == 1
