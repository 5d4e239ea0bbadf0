"""Bucketed tables: merges by one key that never shuffle the target.

A table of the catalog, partitioned by columns, bucketed and sorted by its key
(``bucketBy``). Spark knows that equal keys lie in buckets of the same number, so a merge
deals only its source, into as many parts as there are buckets, and joins each with the
bucket it belongs to where that is read. For targets whose touched partitions are large
next to the day's rows: a plain table (``tables.py``) shuffles them where the source's
keys are too many to be broadcast. A task deals, joins and sorts one bucket of all touched
partitions, so the number of buckets follows the whole table. A partition has a file a
bucket: many small partitions are better off in a plain table.

The table carries the option ``partitionOverwriteMode=dynamic``, so each merge replaces
just the partitions it touched when its job commits, and one that fails before leaves the
table as it was. Partitions left without rows are dropped last: should that fail, keys
that moved are there twice until the day is merged again, which finds them in their old
partitions too. One writer at a time.

Keys are not NULL (a row with a NULL key fails the write: no merge could reach it, and all
such rows would share a bucket), and a source that repeats a key fails.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laketier.operators.upsert import UpsertError, check_columns, source_keys
from laketier.session import staged
from laketier.sinks.tables import partition_key, partitions_of

DYNAMIC = ("partitionOverwriteMode", "dynamic")
BUCKET_BYTES = 32 * 1024 * 1024
BUCKET_ROWS = 250_000


def key_and_buckets(spark: SparkSession, table: str) -> tuple[str, int]:
    found = {r["col_name"]: r["data_type"]
             for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if "Num Buckets" not in found or "," in found["Bucket Columns"]:
        raise UpsertError(f"{table} is not bucketed by one column")
    return found["Bucket Columns"].strip("[]`"), int(found["Num Buckets"])


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _dealt(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    """The rows of bucket i in task i."""
    known = F.when(F.col(key).isNull(), F.raise_error(F.lit(f"NULL in the bucket key {key}")))
    return rows.where(known.otherwise(F.lit(True))).repartition(buckets, key)


def buckets_for(rows: DataFrame, partition_cols: Sequence[str],
                bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets of about ``bucket_bytes`` and ``BUCKET_ROWS`` at most over all partitions of
    the staged ``rows``, and no more than rows: a task of a merge sorts a whole bucket, and
    how many rows a byte holds depends on how they compress."""
    size = (rows.select("_metadata.file_path", "_metadata.file_size").distinct()
            .agg(F.sum("file_size")).first()[0] or 0)
    n = rows.count()
    return max(1, min(n, max(math.ceil(size / bucket_bytes), math.ceil(n / BUCKET_ROWS))))


def create(df: DataFrame, table: str, path: str, key: str, partition_cols: Sequence[str],
           buckets: int | None = None) -> None:
    """Write ``df`` as the new ``table`` below ``path``, with ``buckets`` or as many as its
    size asks for. An existing table and a repeated key fail."""
    if not partition_cols or key in partition_cols:
        raise UpsertError("a bucketed table has partition columns, its key not among them")
    rows = staged(df, "bucketed")
    buckets = buckets or buckets_for(rows, partition_cols)
    dealt = _dealt(rows, key, buckets)
    source_keys(dealt, [key]).count()  # raises on a repeated key
    (dealt.sortWithinPartitions(*partition_cols, key)
     .write.format("parquet").option(*DYNAMIC).option("path", path).partitionBy(*partition_cols)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))


def holding(source: DataFrame, table: str, among: set[str] | None = None) -> set[str]:
    """Keys of the partitions (``among`` these) that hold a key of ``source``: the target's
    key column is read bucket by bucket and meets the source's there."""
    spark = source.sparkSession
    key, buckets = key_and_buckets(spark, table)
    parts = partition_columns(spark, table)
    target = spark.table(table).select(key, *parts)
    if among is not None:
        target = target.where(partition_key(parts).isin(sorted(among)))
    own = source.select(key).repartition(buckets, key)
    return partitions_of(target.join(own, key, "left_semi"), parts)


def merged_rows(source: DataFrame, table: str, touched: set[str]) -> DataFrame:
    """What the partitions ``touched`` hold after the merge of ``source``, which has the
    table's columns."""
    spark = source.sparkSession
    key, buckets = key_and_buckets(spark, table)
    target = spark.table(table).where(
        partition_key(partition_columns(spark, table)).isin(sorted(touched)))
    dealt = _dealt(source, key, buckets)
    kept = target.join(source_keys(dealt, [key]), key, "left_anti")
    return kept.select(*target.columns).unionByName(dealt)


def merge(source: DataFrame, table: str) -> set[str]:
    """Update or insert the rows of ``source`` by the table's key; returns the keys of the
    partitions touched: those of its rows, and those a matched key was in."""
    spark = source.sparkSession
    target = spark.table(table)
    check_columns(target.columns, source)
    parts = partition_columns(spark, table)
    src = staged(source.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                                 for f in target.schema]), "merge-source")
    own = partitions_of(src, parts)
    left = holding(src, table) - own
    if not own:
        return own
    merged_rows(src, table, own | left).write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)
    # a partition that was rewritten holds no key of the source any more, unless its own
    if left and (emptied := holding(src, table, left)):
        _drop(spark, table, parts, emptied)
    return own | left


def _drop(spark: SparkSession, table: str, parts: Sequence[str], keys: set[str]) -> None:
    """Take partitions out of the catalog, then their folders away."""
    folder = F.regexp_extract("_metadata.file_path", r"^(.*)/[^/]+$", 1)
    found = spark.table(table).where(partition_key(parts).isin(sorted(keys)))
    folders = [r[0] for r in found.select(folder).distinct().collect()]  # one a partition
    for values in map(json.loads, sorted(keys)):
        spec = ", ".join(f"`{p}` = " + ("'" + values[p].replace("\\", "\\\\").replace("'", "\\'") + "'"
                                        if p in values else "NULL") for p in parts)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    for at in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(at))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    spark.catalog.refreshTable(table)
