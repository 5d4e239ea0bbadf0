"""Fixture records derived from the driver's TPC-H-style tables.

There is no football data among the given tables, so each ``lineitem`` row
is read as one ingested *version* of match ``l_orderkey``: the order gives
date, venue city and season, the customer's nation the home team and its
region the league, a second nation the away team, and the line item the
score, status and ingest time. The result has the raw record's nested shape,
so every silver and gold operator runs unchanged on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Tie-breakers that make the dedup order total on this data: several line
# items of one order share a ship date.
TIE_BREAKERS = ("_t1", "_t2", "_t3")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _status(flag, status):
    return (F.when(flag == "N", F.lit("FT"))
            .when((flag == "A") & (status == "O"), F.lit("NS"))
            .when(flag == "A", F.lit("LIVE"))
            .otherwise(F.lit("PST")))


def order_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders ⋈ customer ⋈ nation ⋈ region ⋈ nation, one row per order.

    Joined before ``lineitem`` so that the largest table is shuffled once
    (on the order key); nation and region are files of a few kilobytes, which
    Spark broadcasts by their size.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                              "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = spark.read.parquet(f"{sf_dir.rstrip('/')}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir.rstrip('/')}/region.parquet")
    home = nation.select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("home_name"),
        "n_regionkey")
    region = region.select(
        F.col("r_regionkey").alias("n_regionkey"), "r_regionkey", "r_name")
    away = nation.select(
        F.col("n_nationkey").cast("bigint").alias("away_key"), F.col("n_name").alias("away_name"))
    return (o.join(c, o.o_custkey == c.c_custkey)
            .join(home, "c_nationkey")
            .join(region, "n_regionkey")
            .withColumn("away_key", (F.col("c_nationkey") + 1 + F.col("o_orderkey") % 24) % 25)
            .join(away, "away_key"))


def fixture_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped rows: ``fixture, league, teams, goals, score`` plus
    ``_ingest_timestamp, _source_file`` and the tie-breakers ``_t1.._t3``."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate",
        F.col("_metadata.file_path").alias("_file"))
    # Two fact-sized inputs: a sort-merge join on the order key at every
    # scale (a broadcast of line items would grow with the data).
    rows = li.hint("merge").join(order_context(spark, sf_dir),
                                 li.l_orderkey == F.col("o_orderkey"))

    played = F.col("l_linenumber") != 7
    qty5 = F.col("l_quantity").cast("int") % 5
    sup4 = F.col("l_suppkey") % 4

    def score(v):
        return F.when(played, v.cast("bigint"))

    return rows.select(
        F.struct(
            F.col("o_orderkey").alias("id"),
            F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"),
                     F.lit("+00:00")).alias("date"),
            F.struct(_status(F.col("l_returnflag"), F.col("l_linestatus")).alias("short"))
            .alias("status"),
            F.struct(F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" ")).alias("name"),
                     F.col("o_orderpriority").alias("city")).alias("venue"),
        ).alias("fixture"),
        F.struct(
            F.col("r_regionkey").cast("bigint").alias("id"),
            F.concat(F.lit(" "), F.col("r_name")).alias("name"),
            F.year("o_orderdate").cast("bigint").alias("season"),
            F.concat(F.lit("Regular Season - "), F.month("o_orderdate").cast("string"))
            .alias("round"),
        ).alias("league"),
        F.struct(
            F.struct(F.col("c_nationkey").cast("bigint").alias("id"),
                     F.concat(F.col("home_name"), F.lit(" ")).alias("name")).alias("home"),
            F.struct(F.col("away_key").alias("id"), F.col("away_name").alias("name"))
            .alias("away"),
        ).alias("teams"),
        F.struct(score(qty5).alias("home"), score(sup4).alias("away")).alias("goals"),
        F.struct(F.struct(score(F.floor(qty5 / 2.0)).alias("home"),
                          score(F.floor(sup4 / 2.0)).alias("away")).alias("halftime"))
        .alias("score"),
        F.col("l_shipdate").alias("_ingest_timestamp"),
        F.col("_file").alias("_source_file"),
        F.col("l_linenumber").alias("_t1"),
        F.col("l_partkey").alias("_t2"),
        F.col("l_suppkey").alias("_t3"),
    )
