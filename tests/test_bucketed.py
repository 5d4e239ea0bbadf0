"""Merges into bucketed tables: results, moved keys, failures, and a target that stays put."""

import json
import os
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from laketier.operators.upsert import UpsertError, upsert
from laketier.sinks import bucketed

SCHEMA = "id int, goals int, league string, season int"
ROWS = [(1, 0, "a", 2023), (2, 1, "a", 2023), (3, 2, "b", 2023), (4, 3, "it's", 2024),
        (5, 4, None, 2024), (6, 5, "c", 2024)]


@pytest.fixture()
def table(spark, workdir):
    """A bucketed table of ROWS, and merges that are not broadcast."""
    name = f"laketier_test.b_{uuid.uuid4().hex[:12]}"
    spark.sql("CREATE DATABASE IF NOT EXISTS laketier_test")
    bucketed.create(spark.createDataFrame(ROWS, SCHEMA), name, f"{workdir}/t", "id",
                    ["league", "season"], buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield name
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows_of(df):
    return sorted((tuple(r) for r in df.select("id", "goals", "league", "season").collect()), key=str)


def key(league, season):
    return json.dumps({"league": league, "season": str(season)}, separators=(",", ":"))


def folders(workdir):
    return {f"{a}/{b}" for a in os.listdir(f"{workdir}/t") if "=" in a
            for b in os.listdir(f"{workdir}/t/{a}")}


def test_merge_equals_upsert(spark, table):
    before = spark.createDataFrame(ROWS, SCHEMA)
    day = spark.createDataFrame([(2, 9, "a", 2023), (7, 1, "b", 2023), (8, 1, "new", 2025)], SCHEMA)
    want = rows_of(upsert(before, day, ["id"]))
    assert bucketed.merge(day, table) == {key("a", 2023), key("b", 2023), key("new", 2025)}
    assert rows_of(spark.table(table)) == want
    bucketed.merge(day, table)  # the same day again
    assert rows_of(spark.table(table)) == want
    assert bucketed.merge(day.where("false"), table) == set()
    assert rows_of(spark.table(table)) == want


def test_keys_that_move_leave_their_partitions(spark, table, workdir):
    moved = [(i, 7, "a", 2023) for i in (3, 4, 5)]  # the only rows of b, it's and NULL
    bucketed.merge(spark.createDataFrame(moved, SCHEMA), table)
    want = [r for r in ROWS if r[0] not in (3, 4, 5)] + moved
    assert rows_of(spark.table(table)) == sorted(want, key=str)
    assert folders(workdir) == {"league=a/season=2023", "league=c/season=2024"}
    back = spark.createDataFrame([(5, 8, None, 2024)], SCHEMA)
    bucketed.merge(back, table)
    assert rows_of(spark.table(table)) == sorted(
        [r for r in want if r[0] != 5] + [(5, 8, None, 2024)], key=str)


def test_untouched_partitions_keep_their_files(spark, table, workdir):
    def files(part):
        return sorted(os.listdir(f"{workdir}/t/{part}"))
    before = files("league=c/season=2024"), files("league=a/season=2023")
    bucketed.merge(spark.createDataFrame([(1, 5, "a", 2023)], SCHEMA), table)
    assert files("league=c/season=2024") == before[0]
    assert files("league=a/season=2023") != before[1]


def test_failed_merges_leave_the_table(spark, table, workdir):
    for bad, why in (([(1, 5, "a", 2023), (1, 6, "a", 2023)], "duplicate key"),
                     ([(None, 5, "a", 2023)], "NULL in the bucket key")):
        with pytest.raises(PySparkException, match=why):
            bucketed.merge(spark.createDataFrame(bad, SCHEMA), table)
        spark.catalog.refreshTable(table)
        assert rows_of(spark.table(table)) == sorted(ROWS, key=str)
        with pytest.raises(PySparkException, match=why):
            bucketed.create(spark.createDataFrame(bad, SCHEMA), table + "_x", f"{workdir}/x", "id",
                            ["season"], buckets=2)
    with pytest.raises(UpsertError):
        bucketed.merge(spark.createDataFrame(ROWS, SCHEMA).drop("goals"), table)
    with pytest.raises(UpsertError):
        bucketed.create(spark.createDataFrame(ROWS, SCHEMA), table + "_y", f"{workdir}/y", "id", [])


def test_a_merge_cut_off_before_dropping_is_mended_by_the_next(spark, table, monkeypatch):
    day = spark.createDataFrame([(3, 7, "a", 2023)], SCHEMA)

    def lost(*_):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(bucketed, "_drop", lost)
        with pytest.raises(RuntimeError):
            bucketed.merge(day, table)
    assert spark.table(table).where("id = 3").count() == 2
    bucketed.merge(day, table)
    assert rows_of(spark.table(table)) == sorted(
        [r for r in ROWS if r[0] != 3] + [(3, 7, "a", 2023)], key=str)


def test_the_target_is_not_shuffled(spark, table):
    day = spark.createDataFrame([(2, 9, "a", 2023)], SCHEMA)
    merged = bucketed.merged_rows(day, table, {key("a", 2023)})
    plan = merged._jdf.queryExecution().executedPlan().toString()
    above = []  # (depth, line) of the nodes over each scan, read from the tree
    scans = 0
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        above = [x for x in above if x[0] < depth] + [(depth, line)]
        if "FileScan" in line and table.split(".")[1] in line:
            scans += 1
            assert "Bucketed: true" in line and "PartitionFilters: [" in line
            assert not [x for _, x in above if "Exchange" in x]
    assert scans == 1


def test_buckets_follow_the_largest_partition(spark, workdir):
    rows = spark.range(20_000).select(
        F.col("id").cast("int"), F.rand(1).alias("v"),
        F.when(F.col("id") % 4 == 0, 1).otherwise(2).alias("season"))
    rows.write.parquet(f"{workdir}/r")
    kept = spark.read.parquet(f"{workdir}/r")
    few, many = (bucketed.buckets_for(kept, ["season"], n) for n in (1 << 30, 1 << 14))
    assert few == 1 and many > 5
    assert bucketed.buckets_for(kept.where("false"), ["season"]) == 1
