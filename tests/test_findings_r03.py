"""Findings of round 3: landings, streams and merges that stay small as the tables grow."""

import os

import fixtures as fx
from pyspark.sql import functions as F

from laketier.plans import catalog
from laketier.sinks import bucketed, tables
from laketier.sources import landing
from laketier.streaming import silver_stream

SF = "/root/testdata/sf0.001"
DAY = "2024-11-01"


def records(n):
    return [fx.fixture(i, f"{DAY}T20:00:00+00:00", "FT", (1, "A"), (2, "B"), (1, 0)) for i in range(n)]


def files_below(path):
    return [os.path.join(at, n) for at, _, names in os.walk(path) for n in names if n.startswith("part-")]


def staged_types(monkeypatch):
    """What the catalog stages from now on: (column, type) of each table."""
    seen, staged = [], catalog.staged
    monkeypatch.setattr(catalog, "staged", lambda df, name: (seen.extend(df.dtypes), staged(df, name))[1])
    return seen


def test_envelopes_are_landed_without_staged_documents(spark, monkeypatch):
    """Parquet is read by thousands of rows, so whole documents are not staged."""
    seen = staged_types(monkeypatch)
    base = catalog._land_envelopes(spark, SF)
    assert seen and not [c for c, t in seen if t.startswith("array") or c in ("value", "response")]
    raw = landing.read_landed(spark, landing.landing_path(base, "football", catalog.ENVELOPE_DATE))
    sizes = [r[0] for r in landing.fixture_rows(raw).groupBy(landing.SOURCE_FILE).count().select("count").collect()]
    assert sum(sizes) == catalog.bronze_records(spark, SF).count() and max(sizes) <= catalog.PAGE_IDS


def test_matches_share_state_rows(spark, workdir, monkeypatch):
    """the stream's calls and state rows follow the buckets, not the matches."""
    monkeypatch.setattr(silver_stream, "STATE_BUCKETS", 3)
    versions = [{**r, "fixture": {**r["fixture"], "timestamp": 50_000}} for r in records(40)]
    fx.land_records(f"{workdir}/landing", "football", DAY, 39, versions)
    query = silver_stream.start_latest_stream(
        spark, f"{workdir}/landing", f"{workdir}/versions", "t_shared_state", f"{workdir}/bad",
        F.timestamp_seconds("fixture.timestamp"), ["fixture.timestamp"], "1 hour")
    query.awaitTermination()
    assert tables.read_table(spark, f"{workdir}/versions").count() == 40
    held = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert held and max(held) <= 3


def test_landed_lines_are_compressed(spark):
    """F8, F9: JSON Lines repeat their field names; landed plain they outweigh all else."""
    landed = files_below(catalog._land_records(spark, SF))
    assert landed and all(f.endswith(".json.gz") for f in landed)


def test_pages_are_numbered_without_their_records(spark, monkeypatch):
    """the window that numbers a league's pages saw all its records in one task."""
    seen = staged_types(monkeypatch)
    monkeypatch.setattr(catalog, "STRETCH", 1)  # every block a stretch of its own
    (asia, *_) = rows = catalog.q_src_envelope_reconcile(spark, SF).collect()
    assert seen and not [c for c, t in seen if t.startswith("array")]
    assert asia.pages_seen <= asia.pages_expected and len(rows) == 5


def test_buckets_follow_the_rows_of_the_whole_table(spark, workdir, monkeypatch):
    """a bucket of all partitions goes through one task, however well it compresses."""
    monkeypatch.setattr(bucketed, "BUCKET_ROWS", 100, raising=False)
    spark.range(1000).select("id", (F.col("id") % 50).alias("season")).write.parquet(f"{workdir}/r")
    assert bucketed.buckets_for(spark.read.parquet(f"{workdir}/r"), ["season"]) == 10


def test_a_clean_batch_is_not_read_for_its_quarantine(spark, workdir, monkeypatch):
    """the pass that makes the silver rows counts what is unusable."""
    looked, unusable = [], silver_stream._unusable
    monkeypatch.setattr(silver_stream, "_unusable", lambda *a: (looked.append(1), unusable(*a))[1])

    def run():
        silver_stream.start_silver_stream(spark, f"{workdir}/landing", f"{workdir}/silver", "t_one_pass",
                                          f"{workdir}/bad").awaitTermination()
    fx.land_records(f"{workdir}/landing", "football", DAY, 39, records(5))
    run()
    assert not looked and tables.read_table(spark, f"{workdir}/silver").count() == 5
    fx.land_records(f"{workdir}/landing", "football", "2024-11-02", 39, records(1) + [
        {**records(1)[0], "fixture": {"id": 2 ** 40}}])
    fx.land(f"{workdir}/landing", "football", "2024-11-02", 40, text='{"fixture": {"id": 7, "da\n')
    run()
    kept = [r["_corrupt_record"] for r in spark.read.parquet(f"{workdir}/bad").collect()]
    assert looked and len(kept) == 2 and sum(str(2 ** 40) in k for k in kept) == 1


def test_bronze_is_written_where_it_is_read(spark, workdir, monkeypatch):
    """a run's bronze rows are of one partition and are not shuffled to be written."""
    from laketier.plans import jobs
    plans, balanced = [], tables._balanced
    monkeypatch.setattr(tables, "_balanced", lambda df, parts: (plans.append(df.columns), balanced(df, parts))[1])
    for league in (39, 61):
        fx.land_records(f"{workdir}/landing", "football", DAY, league, records(4))
    lake = jobs.Lake(f"{workdir}/lake")
    out = jobs.ingest_bronze(spark, f"{workdir}/landing", lake, DAY, landing.RECORDS_SHAPE)
    assert out == {"bronze": 8, "quarantined": 0} and jobs.read_bronze(spark, lake, DAY).count() == 8
    assert not [c for c in plans if "fixture" in c]


def test_unusable_lines_are_found_in_one_scan(spark, workdir):
    """the same rows as the two scans found."""
    fx.land_records(workdir, "football", DAY, 39, [*records(2), {**records(1)[0], "fixture": {"id": None}}])
    fx.land(workdir, "football", DAY, 40, text='{"fixture": {"id": 7, "da\n{"get": 1}\n')
    raw = landing.read_landed(spark, workdir, landing.RECORDS_SHAPE)
    one = landing.unusable_records(raw)
    two = landing.corrupt_rows(raw, landing.RECORDS_SHAPE).unionByName(
        landing.unidentified_rows(landing.fixture_rows(raw, landing.RECORDS_SHAPE)))
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect())) and one.count() == 3
    assert one._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
