"""One key holding a third of all rows: results stay whole and exact."""

from pyspark.sql import functions as F

from laketier.operators.dedup import latest_per_key
from laketier.operators.upsert import upsert

N = 30_000


def skewed(spark):
    # key 0 holds a third of the rows; the rest are spread over 1,000 keys
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
        F.col("id").alias("ts"), (F.col("id") * 7 % 13).alias("payload"))


def test_latest_per_key_hot_key(spark):
    df = skewed(spark)
    out = {r.k: r.ts for r in latest_per_key(df, ["k"], ["ts"]).collect()}
    want = {r.k: r.m for r in df.groupBy("k").agg(F.max("ts").alias("m")).collect()}
    assert out == want and out[0] == N - 3
    plan = latest_per_key(df, ["k"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    limits = [i for i, ln in enumerate(lines) if "WindowGroupLimit" in ln]
    shuffle = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln]
    # the tree prints top-down: a limit *below* the exchange runs map-side
    assert limits and shuffle and max(limits) > min(shuffle)


def test_upsert_shuffle_path_with_many_null_keys(spark):
    target = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).cast("long").alias("k"),
        F.lit(0).alias("v"))
    source = spark.range(0, N, 2).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    out = upsert(target, source, ["k"])
    assert out.where(F.col("k").isNull()).count() == N // 3
    got = out.where(F.col("k").isNotNull()).groupBy("v").count().collect()
    updated_or_new = N // 2
    kept = len([i for i in range(N) if i % 3 != 0 and i % 2 == 1])
    assert {r.v: r["count"] for r in got} == {1: updated_or_new, 0: kept}


def test_orphans_hot_team(spark):
    from laketier.operators import star
    fact = spark.range(N).select(
        F.col("id").cast("int").alias("match_id"),
        F.when(F.col("id") % 3 == 0, F.lit(999)).otherwise(F.col("id") % 10).cast("int")
        .alias("home_team_id"),
        F.lit(1).cast("int").alias("away_team_id"), F.lit(2024).alias("season"),
        F.lit("2024-11-01").cast("date").alias("match_date"))
    dim_team = spark.range(10).select(F.col("id").cast("int").alias("team_id"),
                                      F.lit(2024).alias("season"))
    dim_date = spark.createDataFrame([("2024-11-01",)], "d string").select(
        F.col("d").cast("date").alias("date"))
    out = star.orphans(fact, dim_team, dim_date)
    assert out.count() == N // 3  # every match of the hot, unknown team 999
    assert out.where("missing != 'home_team'").count() == 0
