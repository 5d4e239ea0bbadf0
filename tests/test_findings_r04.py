"""Findings of round 4: landings that stay small as the tables grow."""

import os

from pyspark.sql import functions as F

from laketier.plans import catalog
from laketier.sources import landing

SF = "/root/testdata/sf0.001"


def files_below(path):
    return [os.path.join(at, n) for at, _, names in os.walk(path) for n in names if n.startswith("part-")]


def test_envelopes_are_landed_compressed_and_full(spark, monkeypatch):
    """a page is filled with the records of a task and league, not cut by all leagues."""
    monkeypatch.setattr(catalog, "PAGE_IDS", 50)
    base = catalog._land_envelopes(spark, SF)
    assert all(f.endswith(".gz") for f in files_below(base))
    raw = landing.read_landed(spark, landing.landing_path(base, "football", catalog.ENVELOPE_DATE))
    assert landing.corrupt_rows(raw).count() == 2
    good = raw.where(landing.usable(landing.ENVELOPE_SHAPE))
    pages = good.select("results", F.size("response").alias("n")).collect()
    assert all(p.results == p.n <= 50 for p in pages) and sum(p.n == 50 for p in pages) > len(pages) / 2
    assert sum(p.n for p in pages) == catalog.bronze_records(spark, SF).count()


def test_records_of_a_task_are_not_shuffled_into_documents(spark):
    """documents quote and keep what their records hold, in order."""
    lines = [F.to_json(F.struct(F.concat(F.lit('"\\\n, é'), F.col("id")).alias("a"))).alias("line")]
    docs = catalog._documents(spark.range(0, 2500, 1, 1).select(*lines))
    assert "Exchange" not in docs._jdf.queryExecution().executedPlan().toString()
    found = docs.select(F.from_json("value", "results int, response array<struct<a string>>").alias("d")).collect()
    assert [r.d.results for r in found] == [1000, 1000, 500]
    assert [x.a for r in found for x in r.d.response] == [f'"\\\n, é{i}' for i in range(2500)]


def test_reconciled_documents_are_landed_compressed(spark, monkeypatch):
    """plain documents outweigh all else that the query writes."""
    made, scratch = [], catalog.scratch
    monkeypatch.setattr(catalog, "scratch", lambda *a: (made.append(scratch(*a)), made[-1])[1])
    catalog.q_src_envelope_reconcile(spark, SF)
    landed = [f for path in made for f in files_below(path.removeprefix("file:"))]
    assert landed and all(f.endswith(".gz") for f in landed)
