"""Envelope reconciliation, schema drift and the kept summary."""

import json

import fixtures as fx
import pytest
from laketier.operators import gold
from laketier.operators.reconcile import request_report
from laketier.plans import jobs
from laketier.plans.metrics import schema_drift, schema_rows
from laketier.session import together
from laketier.sinks import tables
from laketier.sources import landing


def page(records, current, total, results=None, errors=(), date="2024-11-01"):
    doc = fx.envelope(records, date=date)
    doc["paging"], doc["errors"] = {"current": current, "total": total}, list(errors)
    if results is not None:
        doc["results"] = results
    return doc


def report(spark, folder, docs):
    for i, doc in enumerate(docs):
        fx.land(folder, "football", "2024-11-01", 39, text=json.dumps(doc, indent=1), name=f"{i}.json")
    raw = landing.read_landed(spark, landing.landing_path(folder, "football", "2024-11-01"))
    return {r["date"]: r.asDict() for r in request_report(raw).collect()}


def test_requests_are_reconciled(spark, workdir):
    one, two = fx.SAMPLE
    got = report(spark, f"{workdir}/landing", [
        page([one], 1, 2, date="whole"), page([two], 2, 2, date="whole"),
        page([one], 1, 2, date="page lost"),
        page([one], 1, 1, results=2, date="cut short"),
        page([one], 1, 1, errors=["rate limit"], date="error"),
        page([one], 1, 2, date="twice"), page([one], 1, 2, date="twice"),
        page([one], 3, 2, date="odd page"), page([one], 1, 2, date="odd page"),
        {"get": "fixtures", "parameters": {"date": "bare"}, "response": [one, two]},
        {"get": "fixtures", "parameters": {"date": "nothing"}, "results": 5}])
    assert {d for d, r in got.items() if r["complete"]} == {"whole", "bare"}
    assert (got["whole"]["documents"], got["whole"]["pages_seen"], got["whole"]["rows"]) == (2, 2, 2)
    assert (got["page lost"]["pages_expected"], got["page lost"]["pages_seen"]) == (2, 1)
    assert (got["cut short"]["results"], got["cut short"]["rows"], got["cut short"]["short_documents"]
            ) == (2, 1, 1)
    assert got["error"]["error_documents"] == 1
    assert (got["twice"]["documents"], got["twice"]["pages_seen"]) == (2, 1)
    assert got["odd page"]["pages_seen"] == 1
    assert (got["nothing"]["rows"], got["nothing"]["short_documents"]) == (0, 1)


def test_drift_between_two_schemas(spark):
    a = spark.createDataFrame([], "a int, b string, c int, d int")
    b = spark.createDataFrame([], "b string, a int, c bigint, e int")
    other = spark.createDataFrame([], "x int")
    before = schema_rows(spark, {"s": a, "gone": other, "same": other})
    after = schema_rows(spark, {"s": b, "new": other, "same": other})
    got = sorted(tuple(r) for r in schema_drift(before, after).fillna("").collect())
    assert got == [("s", "a", "moved", "int", "int"), ("s", "b", "moved", "string", "string"),
                   ("s", "c", "retyped", "int", "bigint"), ("s", "d", "removed", "int", ""),
                   ("s", "e", "added", "", "int")]
    assert schema_drift(before, before).count() == 0


def test_runs_report_incomplete_requests_and_drift(spark, workdir):
    base, lake = f"{workdir}/landing", jobs.Lake(f"{workdir}/lake")
    fx.land(base, "football", "2024-11-01", 39, page(fx.SAMPLE, 1, 2))
    out = jobs.run_daily(spark, base, lake.base, "2024-11-01")
    assert out["incomplete_requests"] == 1 and out["schema_drift"] == []
    log = spark.read.parquet(lake.run_log).where("stage = 'incomplete_requests'").collect()
    assert [r["rows"] for r in log] == [1]
    # the summary is kept in parts, and follows the fact
    assert [tuple(r) for r in jobs.league_summary(spark, lake).collect()] == [(39, 2024, 2, 5, 2.5)]
    assert [tuple(r) for r in jobs.league_summary(spark, lake, ["season"]).collect()] == [
        (2024, 2, 5, 2.5)]
    assert jobs.refresh_summary(spark, lake) == {}
    # a bronze column appears between two runs
    evolved = jobs.read_bronze(spark, lake).drop("_ingest_date", "_sport_type")
    evolved.selectExpr("*", "'x' AS feed").write.parquet(
        f"{lake.bronze}/_ingest_date=2024-11-02/_sport_type=football")
    drift = jobs.note_schemas(spark, lake, "later")
    assert [(d["stage"], d["column"], d["change"]) for d in drift
            if d["change"] == "added"] == [("bronze", "feed", "added")]


def test_summary_parts_add_up(spark, workdir):
    fact = spark.createDataFrame(
        [(1, 39, 2024, 3), (2, 39, 2024, None), (3, 39, 2025, 1), (4, None, 2025, 2), (5, 61, None, 4)],
        "match_id int, league_id int, season int, total_goals int")
    path = f"{workdir}/parts"
    tables.replace_partitions(gold.summary_parts(fact), path, ["season", "league_id"],
                              tables.partitions_of(fact, ["season", "league_id"]))
    kept = tables.read_table(spark, path)
    whole = gold.league_season_summary(fact)
    assert gold.merged_summary(kept).collect() == whole.collect()
    by_season = {r["season"]: tuple(r)[1:] for r in gold.merged_summary(kept, ["season"]).collect()}
    assert by_season == {2024: (2, 3, 3.0), 2025: (2, 3, 1.5), None: (1, 4, 4.0)}


def test_together_ends_all_steps_and_keeps_their_order(spark):
    ended = []

    def step(n, fails=False):
        def run():
            rows = spark.range(n * 1000).selectExpr("sum(id) AS s").first()[0]
            ended.append(n)
            if fails:
                raise ValueError(f"step {n}")
            return rows
        return run
    assert together(spark, step(3), step(1), step(2)) == [4498500, 499500, 1999000]
    ended.clear()
    with pytest.raises(ValueError, match="step 2"):
        together(spark, step(1), step(2, True), step(3, True), step(4))
    assert sorted(ended) == [1, 2, 3, 4]


def test_columns_that_no_longer_arrive_are_drift(spark, workdir):
    base, lake = f"{workdir}/landing", jobs.Lake(f"{workdir}/lake")
    for day in ("2024-11-01", "2024-11-02"):
        fx.land(base, "football", day, 39, fx.envelope(fx.SAMPLE, date=day))
    jobs.run_daily(spark, base, lake.base, "2024-11-01")
    # the day before had a column more
    older = jobs.read_bronze(spark, lake).drop("_ingest_date", "_sport_type")
    older.selectExpr("*", "'x' AS feed").write.parquet(
        f"{lake.bronze}/_ingest_date=2024-10-31/_sport_type=football")
    jobs.note_schemas(spark, lake, "before", "2024-10-31")
    drift = jobs.run_daily(spark, base, lake.base, "2024-11-02")["schema_drift"]
    assert [(d["stage"], d["column"]) for d in drift if d["change"] == "removed"] == [("bronze", "feed")]
