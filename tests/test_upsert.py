"""Upsert rules 1-5, the tables behind them, their key index and layout."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from laketier.operators.upsert import UpsertError, upsert
from laketier.session import staged
from laketier.sinks import key_index, layout, tables

SCHEMA = "id int, league int, season int, goals int"


def df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def as_set(d):
    return sorted(tuple(r) for r in d.collect())


def test_update_insert_keep(spark):
    target = df(spark, [(1, 10, 2024, 0), (2, 10, 2024, 1), (3, 20, 2024, 2)])
    source = df(spark, [(2, 10, 2024, 5), (4, 20, 2024, 1)])
    for limit in ("10485760", "-1"):  # by broadcast and by shuffle
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            out = as_set(upsert(target, source, ["id"]))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert out == [(1, 10, 2024, 0), (2, 10, 2024, 5), (3, 20, 2024, 2), (4, 20, 2024, 1)]


def test_null_keys_never_match(spark):
    target = df(spark, [(None, 10, 2024, 0), (1, 10, 2024, 0)])
    source = df(spark, [(None, 10, 2024, 9)])
    once = upsert(target, source, ["id"])
    assert once.where(F.col("id").isNull()).count() == 2
    twice = upsert(once, source, ["id"])
    assert twice.where(F.col("id").isNull()).count() == 3


def test_duplicate_source_key_fails(spark):
    target = df(spark, [(1, 10, 2024, 0)])
    source = df(spark, [(1, 10, 2024, 1), (1, 10, 2024, 2)])
    with pytest.raises(PySparkException, match="duplicate key"):
        upsert(target, source, ["id"]).collect()


def test_missing_column_fails(spark):
    target = df(spark, [(1, 10, 2024, 0)])
    with pytest.raises(UpsertError):
        upsert(target, target.drop("goals"), ["id"])


def test_composite_key(spark):
    target = df(spark, [(1, 10, 2023, 0), (1, 10, 2024, 0)])
    source = df(spark, [(1, 11, 2024, 7)])
    assert as_set(upsert(target, source, ["id", "season"])) == [(1, 10, 2023, 0), (1, 11, 2024, 7)]


def test_idempotent(spark):
    target = df(spark, [(1, 10, 2024, 0), (2, 10, 2024, 1)])
    source = df(spark, [(2, 10, 2024, 5), (3, 10, 2024, 1)])
    once = upsert(target, source, ["id"])
    assert as_set(upsert(once, source, ["id"])) == as_set(once)


def test_null_safe_keys_match_each_other(spark):
    target = df(spark, [(None, 10, 2024, 0), (1, 10, None, 0)])
    source = df(spark, [(None, 11, 2024, 9), (2, 10, None, 1)])
    assert as_set(upsert(target, source, ["id", "season"], null_safe=True).fillna(-1)) == [
        (-1, 11, 2024, 9), (1, 10, -1, 0), (2, 10, -1, 1)]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_spark_picks_the_join_by_the_size_of_the_written_source(spark):
    from laketier.session import staged
    target = df(spark, [(i, 10, 2024, 0) for i in range(50)])
    source = staged(df(spark, [(1, 10, 2024, 5)]), "test")
    assert "BroadcastHashJoin" in plan_of(upsert(target, source, ["id"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        plan = plan_of(upsert(target, source, ["id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in plan and "LeftAnti" in plan
    assert "SinglePartition" not in plan and "Limit" not in plan


def test_table_first_run_then_merge_with_partition_move(spark, workdir):
    path = f"{workdir}/silver"
    v1 = tables.upsert_table(df(spark, [(1, 10, 2024, 0), (2, 10, 2024, 1), (3, 20, 2024, 2)]),
                             path, ["id"], ["league", "season"])
    # key 3 moves from league 20 to 10: it must leave its old partition
    v2 = tables.upsert_table(df(spark, [(3, 10, 2024, 9), (4, 20, 2024, 1)]),
                             path, ["id"], ["league", "season"])
    assert (v1, v2) == (1, 2)
    cur = tables.read_table(spark, path)
    assert cur.columns == ["id", "league", "season", "goals"]
    assert as_set(cur) == [(1, 10, 2024, 0), (2, 10, 2024, 1), (3, 10, 2024, 9), (4, 20, 2024, 1)]


def test_first_run_rejects_duplicates(spark, workdir):
    with pytest.raises(PySparkException, match="duplicate key"):
        tables.upsert_table(df(spark, [(1, 10, 2024, 0), (1, 10, 2024, 1)]), f"{workdir}/t",
                            ["id"])
    assert not tables.table_exists(spark, f"{workdir}/t")


def failing(rows):
    """The same rows, but their computation fails in a task."""
    return rows.withColumn("goals", F.when(F.col("goals") >= 0, F.raise_error(F.lit("lost")))
                           .cast("int"))


@pytest.mark.parametrize("parts", [["league", "season"], []])
def test_failed_write_leaves_the_table_as_it_was(spark, workdir, parts):
    path = f"{workdir}/t"
    tables.upsert_table(df(spark, [(1, 10, 2024, 0), (2, 11, 2024, 0)]), path, ["id"], parts)
    with pytest.raises(PySparkException, match="lost"):
        tables.replace_partitions(failing(df(spark, [(1, 10, 2024, 7), (3, 10, 2024, 7)])), path,
                                  parts, {K(10, 2024)} if parts else {tables.ALL_KEY})
    assert as_set(tables.read_table(spark, path)) == [(1, 10, 2024, 0), (2, 11, 2024, 0)]
    # what the failed write would have touched is rebuilt by those who follow the table
    assert tables.changes(spark, path, 1)[0] == ({K(10, 2024)} if parts else {tables.ALL_KEY})
    tables.upsert_table(df(spark, [(1, 11, 2024, 9)]), path, ["id"], parts)
    assert as_set(tables.read_table(spark, path)) == [(1, 11, 2024, 9), (2, 11, 2024, 0)]


def K(league, season=None):
    import json
    return json.dumps({k: str(v) for k, v in (("league", league), ("season", season))
                       if v is not None}, separators=(",", ":"))


def test_keys_move_between_partitions_with_odd_values(spark, workdir):
    path = f"{workdir}/t"
    values = ["a b", "x:y", "a%b", "50%25", "é/ü", "q?*", "[x]{y}^", "1=2", "it's", None, "plain",
              'quo"te', "back\\slash"]

    def frame(rows):
        return spark.createDataFrame(rows, "id int, p string, n int")
    tables.upsert_table(frame([(i, v, 0) for i, v in enumerate(values)]), path, ["id"], ["p"])
    # every row moves to the next value's partition, every value is left once
    moved = values[1:] + values[:1]
    tables.upsert_table(frame([(i, v, 1) for i, v in enumerate(moved)]), path, ["id"], ["p"])
    got = {r.id: (r.p, r.n) for r in tables.read_table(spark, path).collect()}
    assert tables.read_table(spark, path).count() == len(values)
    assert got == {i: (v, 1) for i, v in enumerate(moved)}
    # all move to one partition: the others have no rows left
    tables.upsert_table(frame([(i, "plain", 2) for i in range(len(values))]), path, ["id"], ["p"])
    assert tables.read_table(spark, path).count() == len(values)
    assert tables.read_table(spark, path).where("p = 'plain' AND n = 2").count() == len(values)
    # and one may return
    tables.upsert_table(frame([(4, "é/ü", 3)]), path, ["id"], ["p"])
    assert [(r.id, r.n) for r in tables.read_table(spark, path, "p = 'é/ü'").collect()] == [(4, 3)]


def test_merge_touching_thousands_of_partitions(spark, workdir):
    path, n = f"{workdir}/t", 1500
    rows = spark.range(n).select(F.col("id").cast("int").alias("id"),
                                 F.col("id").cast("int").alias("p"), F.lit(0).alias("v"))
    tables.upsert_table(rows.coalesce(4), path, ["id"], ["p"])
    tables.upsert_table(rows.withColumn("v", F.lit(1)).coalesce(4), path, ["id"], ["p"])
    got = tables.read_table(spark, path)
    assert got.count() == n and got.where("v = 1").count() == n


def files(spark, path):
    return set(tables.read_table(spark, path).inputFiles())


def test_merge_rewrites_only_affected_partitions(spark, workdir):
    path = f"{workdir}/t"
    rows = [(i, i % 4, 2024, 0) for i in range(40)]
    v1 = tables.upsert_table(df(spark, rows), path, ["id"], ["league"])
    assert tables.changes(spark, path) == ({K(i) for i in range(4)}, v1)
    before = files(spark, path)
    # key 5 lives in league 1 and moves to league 2; key 100 is new in league 2
    v2 = tables.upsert_table(df(spark, [(5, 2, 2024, 9), (100, 2, 2024, 1)]), path, ["id"],
                             ["league"])
    assert tables.changes(spark, path, v1) == ({K(1), K(2)}, v2)
    after = files(spark, path)
    assert {f.split("league=")[1][0] for f in before - after} == {"1", "2"}
    assert {f.split("league=")[1][0] for f in before & after} == {"0", "3"}
    got = dict((r.id, (r.league, r.goals)) for r in tables.read_table(spark, path).collect())
    assert len(got) == 41 and got[5] == (2, 9) and got[100] == (2, 1)
    # an emptied partition has no rows
    tables.upsert_table(df(spark, [(i, 0, 2024, 0) for i in range(3, 40, 4)]), path, ["id"],
                        ["league"])
    assert tables.read_table(spark, path).where("league = 3").count() == 0
    assert tables.read_table(spark, path).count() == 41
    assert tables.changes(spark, path, 3) == (set(), 3)


def test_a_new_content_replaces_the_old(spark, workdir):
    for parts in (["league"], []):
        path = f"{workdir}/t{len(parts)}"
        tables.write_table(df(spark, [(i, i % 3, 2024, 0) for i in range(9)]), path, parts)
        old = tables.read_table(spark, path)
        tables.write_table(old.where("league = 1").withColumn("goals", F.lit(5)), path, parts)
        assert as_set(tables.read_table(spark, path)) == [(i, 1, 2024, 5) for i in (1, 4, 7)]
        tables.write_table(old.limit(0), path, parts)
        assert as_set(tables.read_table(spark, path)) == []
        tables.upsert_table(df(spark, [(1, 1, 2024, 1)]), path, ["id"], parts)
        assert as_set(tables.read_table(spark, path)) == [(1, 1, 2024, 1)]


# --- key index ---------------------------------------------------------------------

def test_matched_keys_are_found_without_reading_the_table(spark, workdir, monkeypatch):
    path = f"{workdir}/t"
    rows = [(i * 7919 - 50_000, i % 5, 2024, 0) for i in range(100)] + [(None, 4, 2024, 0)]
    tables.upsert_table(df(spark, rows), path, ["id"], ["league"])
    # scattered keys, one in each of leagues 0 and 3: a range over them covers everything
    source = staged(df(spark, [(rows[0][0], 1, 2024, 5), (rows[98][0], 1, 2024, 6),
                               (12, 1, 2024, 7), (None, 1, 2024, 8)]), "test")
    key_index.synced(spark, path, "id")
    read = []
    for name in ("read_table", "read_partitions"):
        def told(spark, at, *a, own=getattr(tables, name), **k):
            read.append(at)
            return own(spark, at, *a, **k)
        monkeypatch.setattr(tables, name, told)
    assert key_index.holding(spark, path, source, ["id"]) == {K(0), K(3)}
    assert read == [f"{path}/_keys"]
    read.clear()
    tables.upsert_table(source, path, ["id"], ["league"])
    got = {r.id: (r.league, r.goals) for r in tables.read_table(spark, path).where(
        "id IS NOT NULL").collect()}
    assert len(got) == 101 and got[rows[0][0]] == (1, 5) and got[12] == (1, 7)
    # the index reads the partitions that were written since, and no others
    read.clear()
    seen = tables.seen(spark, f"{path}/_keys")
    assert tables.changes(spark, path, seen)[0] == {K(0), K(1), K(3)}
    assert key_index.copies(spark, path, "id") == (101, 0)
    assert tables.changes(spark, path, tables.seen(spark, f"{path}/_keys"))[0] == set()


def test_copies_of_keys_are_counted(spark, workdir):
    path = f"{workdir}/t"
    keys = [1, 1, 2, -3, -3, -3, 70_000, 70_001, 32_768, 32_768, None, None]
    tables.write_table(df(spark, [(k, i % 3, 2024, 0) for i, k in enumerate(keys)]), path, ["league"])
    assert key_index.copies(spark, path, "id") == (10, 7)
    tables.write_table(df(spark, []), path, ["league"])
    assert key_index.copies(spark, path, "id") == (0, 0)


def test_a_failed_write_does_not_mislead_the_index(spark, workdir):
    path = f"{workdir}/t"
    tables.upsert_table(df(spark, [(1, 10, 2024, 0), (2, 11, 2024, 0)]), path, ["id"], ["league"])
    key_index.synced(spark, path, "id")
    with pytest.raises(PySparkException, match="lost"):
        tables.replace_partitions(failing(df(spark, [(2, 10, 2024, 7)])), path, ["league"],
                                  {K(10), K(11)})
    assert key_index.holding(spark, path, staged(df(spark, [(2, 1, 1, 1)]), "t"), ["id"]) == {K(11)}


def test_other_keys_have_no_index(spark, workdir):
    path = f"{workdir}/t"
    frame = lambda rows: spark.createDataFrame(rows, "a string, b int, p int, n int")
    tables.upsert_table(frame([("x", 1, 1, 0), ("y", 1, 2, 0)]), path, ["a", "b"], ["p"])
    tables.upsert_table(frame([("x", 1, 2, 5)]), path, ["a", "b"], ["p"])
    assert as_set(tables.read_table(spark, path)) == [("x", 1, 2, 5), ("y", 1, 2, 0)]


# --- layout -------------------------------------------------------------------------

def test_layout_rewrite_keeps_rows(spark, workdir):
    path = f"{workdir}/t"
    rows = [(i, i % 3, 2024, i % 5) for i in range(200)]
    v = tables.write_table(df(spark, rows).repartition(7), path, ["league"])
    assert layout.rewrite_layout(spark, path, ["id"], target_file_bytes=1024) == 3
    assert as_set(tables.read_table(spark, path)) == sorted(rows)
    # rows did not change, and what is laid out is not laid out again
    assert tables.changes(spark, path, v) == (set(), v)
    assert layout.rewrite_layout(spark, path, ["id"]) == 0
    tables.upsert_table(df(spark, [(0, 0, 2024, 99)]), path, ["id"], ["league"])
    assert layout.rewrite_layout(spark, path, ["id", "goals"]) == 1
    assert tables.read_table(spark, path).count() == 200
    flat = f"{workdir}/flat"
    tables.write_table(df(spark, rows), flat)
    assert layout.rewrite_layout(spark, flat, ["id", "goals"]) == 1
    assert as_set(tables.read_table(spark, flat)) == sorted(rows)


def test_interleaving_narrows_files_on_both_columns(spark, workdir):
    """How many of a table's files a point may lie in, by their least and greatest values."""
    rows = spark.range(20_000).select(
        F.col("id").cast("int").alias("id"), F.lit(1).alias("league"),
        F.date_add(F.lit("2020-01-01"), (F.col("id") * 7919 % 1000).cast("int")).alias("day"),
        (F.col("id") * 104_729 % 500).cast("int").alias("team"))

    def overlap(order):
        path = f"{workdir}/{'-'.join(order)}"
        tables.write_table(rows, path, ["league"])
        layout.rewrite_layout(spark, path, order, target_file_bytes=8 << 10)
        ends = (tables.read_table(spark, path).groupBy(F.input_file_name())
                .agg(*[f(c).alias(f"{n}_{c}") for c in ("day", "team")
                       for n, f in (("lo", F.min), ("hi", F.max))]).collect())
        assert len(ends) >= 8
        out = {}
        for c, points in (("day", [r.lo_day for r in ends]), ("team", range(0, 500, 50))):
            out[c] = sum(e[f"lo_{c}"] <= p <= e[f"hi_{c}"] for p in points for e in ends) \
                / len(points) / len(ends)
        return out
    one, both = overlap(["day"]), overlap(["day", "team"])
    assert one["team"] > 0.9  # sorted by day alone, every file has every team
    assert both["team"] < 0.6 and both["day"] < 0.6


def test_interleaved_keys(spark):
    d = spark.createDataFrame([(0, 0), (3, 0), (0, 3), (3, 3), (None, 1)], "a int, b int")
    got = [r[0] for r in d.select(layout.interleaved(d, ["a", "b"], bits=2)).collect()]
    assert got == [0b0000, 0b0101, 0b1010, 0b1111, 0b0010]
    with pytest.raises(ValueError):
        layout.interleaved(spark.createDataFrame([("x",)], "a string"), ["a"])


def test_partition_filter_is_pruned(spark, workdir):
    path = f"{workdir}/t"
    tables.write_table(df(spark, [(i, i % 3, 2024, i) for i in range(30)]), path, ["league"])
    q = tables.read_table(spark, path, where="league = 1 AND goals > 3")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(league" in plan and "PushedFilters: [IsNotNull(goals)" \
        in plan
    assert q.count() == 9
    # partitions by key are a filter on folders too
    some = tables.read_partitions(spark, path, {K(1)})
    assert "DataFilters: []" in some._jdf.queryExecution().executedPlan().toString()
    assert some.count() == 10


def test_register_table(spark, workdir):
    path = f"{workdir}/t"
    tables.write_table(df(spark, [(1, 10, 2024, 0), (2, 20, 2024, 1)]), path, ["league"])
    name = layout.register_table(spark, "laketier_test", "t1", path)
    assert spark.table(name).count() == 2
    # the name stays; what was written since is found
    tables.upsert_table(df(spark, [(3, 30, 2024, 1), (2, 10, 2024, 7)]), path, ["id"], ["league"])
    assert layout.register_table(spark, "laketier_test", "t1", path) == name
    assert sorted(tuple(r) for r in spark.table(name).select("id", "league", "goals").collect()) == [
        (1, 10, 0), (2, 10, 7), (3, 30, 1)]


def test_register_empty_and_null_partitions(spark, workdir):
    tables.write_table(df(spark, []), f"{workdir}/empty")
    name = layout.register_table(spark, "laketier_test", "t2", f"{workdir}/empty")
    assert spark.table(name).count() == 0
    tables.write_table(df(spark, [(1, None, 2024, 0), (2, 20, 2024, 1)]), f"{workdir}/nulls",
                       ["league"])
    name = layout.register_table(spark, "laketier_test", "t3", f"{workdir}/nulls")
    assert as_set(spark.table(name).select("id").where("league IS NULL")) == [(1,)]
    assert spark.table(name).count() == 2
