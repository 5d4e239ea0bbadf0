"""Envelopes reconciled: what an API document promises against what arrived.

A document states how many records it holds (``results``), which page of how many it is
(``paging``) and what went wrong (``errors``). A page that was cut short, a page that
never landed or an error beside records would otherwise pass as fewer rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REQUEST = ("league", "season", "date")


def request_report(raw: DataFrame, by: Sequence[str] = REQUEST) -> DataFrame:
    """One row per request (fields of ``parameters``) over parsed envelopes: documents,
    pages_expected, pages_seen, results (promised), rows (arrived), short_documents,
    error_documents, complete. Documents that did not parse are the quarantine's.

    A document without ``paging`` is page 1 of 1; one without ``results`` promises what
    it has. A page that landed twice is one page, and its rows count twice on both sides.
    """
    rows = F.coalesce(F.size("response"), F.lit(0)).cast("bigint")
    pages = raw.where(F.col("get").isNotNull()).select(
        *[F.col(f"parameters.{c}").alias(c) for c in by],
        F.coalesce("paging.current", F.lit(1)).alias("current"),
        F.coalesce("paging.total", F.lit(1)).alias("total"),
        rows.alias("rows"), F.coalesce("results", rows).alias("results"),
        (F.coalesce(F.size("errors"), F.lit(0)) > 0).alias("failed"))
    # a page first: what reaches a request's one row is a row for each page of it
    seen = pages.groupBy(*by, "current").agg(
        F.count("*").alias("documents"), F.max("total").alias("total"), F.sum("rows").alias("rows"),
        F.sum("results").alias("results"),
        F.count_if(F.col("rows") != F.col("results")).alias("short"),
        F.count_if("failed").alias("failed"))
    report = seen.groupBy(*by).agg(
        F.sum("documents").alias("documents"), F.max("total").alias("pages_expected"),
        F.count_if(F.col("current").between(1, F.col("total"))).alias("pages_seen"),
        F.sum("results").alias("results"), F.sum("rows").alias("rows"),
        F.sum("short").alias("short_documents"), F.sum("failed").alias("error_documents"))
    return report.withColumn("complete", (F.col("pages_seen") >= F.col("pages_expected"))
                             & (F.col("short_documents") == 0) & (F.col("error_documents") == 0))
