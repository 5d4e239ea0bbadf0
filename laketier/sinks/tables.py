"""Parquet tables kept by Spark's own means: partitioned folders, dynamic partition
overwrite, and a log of the partitions that each write touched.

    <path>/league_id=1/season=1995/part-*.parquet
    <path>/_schema/    column order and types (no rows)
    <path>/_changes/   a row for each write and partition it touched, appended

A write replaces whole partitions. Spark writes their new rows aside and moves them in
place when the job commits (``partitionOverwriteMode=dynamic``), so a write that fails
leaves the table as it was, and one that read the table it writes is safe. A partition
that lost all its rows gets a file without rows. A table without partition columns is
one partition (``_all=0``).

The touched partitions are logged before they are written: whoever derives something
from a table (a fact, the gate's counts, the key index) notes the last write it has seen
(``seen``) and rebuilds what later writes touched, once too often after a failed write,
never too seldom. A table has one writer at a time (the daily run).

Append-only tables (bronze, run log) are plain partitioned Parquet folders.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laketier.operators.upsert import check_columns, source_keys, upsert
from laketier.session import staged

ALL, ALL_KEY = "_all", '{"_all":"0"}'
EVERY = "*"  # in the log: all partitions
VERSION = "_version"
LOG = f"partition string, {VERSION} bigint"
PARTITION = "partition:"  # marks a partition column in the noted schema


def partition_key(cols: Sequence[str]) -> Column:
    """A partition's values as JSON, by column name; NULL is left out. Of partition
    columns alone, so a filter on it prunes folders."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in sorted(cols)]))


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _found(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else None


# --- read ------------------------------------------------------------------------

def table_schema(spark: SparkSession, path: str) -> tuple[T.StructType, list[str]]:
    """Columns in order, and which of them partition the table."""
    noted = spark.read.parquet(f"{path.rstrip('/')}/_schema").schema
    parts = [f.name for f in noted if f.name.startswith(PARTITION)]
    return (T.StructType([f for f in noted if f.name not in parts]),
            [p.removeprefix(PARTITION) for p in parts])


def table_exists(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path.rstrip('/')}/_schema")


def _stored(spark: SparkSession, path: str) -> tuple[DataFrame, list[str], list[str]]:
    """Rows with all stored columns, the table's own columns, and those of its folders."""
    schema, parts = table_schema(spark, path)
    full = T.StructType([*schema.fields, *([] if parts else [T.StructField(ALL, T.IntegerType())])])
    return spark.read.schema(full).parquet(path), schema.names, parts or [ALL]


def read_table(spark: SparkSession, path: str, where: str | Column | None = None) -> DataFrame:
    """The table, with the schema it was written with; a filter on partition columns
    prunes folders, others reach the Parquet reader."""
    df, names, _ = _stored(spark, path)
    df = df.select(*names)
    return df.filter(where) if where is not None else df


def read_partitions(spark: SparkSession, path: str, keys: Iterable[str],
                    by: Sequence[str] | None = None) -> DataFrame:
    """Rows of the partitions with the given keys, of all partition columns or of those in
    ``by``; other folders are not read."""
    df, names, parts = _stored(spark, path)
    return df.where(partition_key(by or parts).isin(sorted(keys))).select(*names)


# --- what writes touched -----------------------------------------------------------

def changes(spark: SparkSession, path: str, since: int = 0) -> tuple[set[str], int]:
    """Keys of the partitions that writes after ``since`` touched, and the last write."""
    log = _found(spark, f"{path.rstrip('/')}/_changes", LOG)
    if log is None:
        return set(), since
    rows = (log.where(F.col(VERSION) > since).groupBy("partition")
            .agg(F.max(VERSION).alias("last")).collect())
    keys = {r["partition"] for r in rows} - {None}
    if EVERY in keys:
        stored, _, parts = _stored(spark, path)
        keys = keys - {EVERY} | partitions_of(stored, parts)
    return keys, max([since, *(r["last"] for r in rows)])


def last_write(spark: SparkSession, path: str) -> int:
    log = _found(spark, f"{path.rstrip('/')}/_changes", LOG)
    return log.agg(F.max(VERSION)).first()[0] or 0 if log is not None else 0


def seen(spark: SparkSession, path: str) -> int:
    """The last write of its source that what lies at ``path`` was built from."""
    noted = _found(spark, f"{path.rstrip('/')}/_seen", f"{VERSION} bigint")
    return noted.agg(F.max(VERSION)).first()[0] or 0 if noted is not None else 0


def note_seen(spark: SparkSession, path: str, version: int) -> None:
    (spark.range(1, numPartitions=1).select(F.lit(version).cast("bigint").alias(VERSION))
     .write.mode("append").parquet(f"{path.rstrip('/')}/_seen"))


# --- write -------------------------------------------------------------------------

def partitions_of(df: DataFrame, parts: Sequence[str]) -> set[str]:
    """Keys of the partitions that ``df`` has rows in (one row for each)."""
    if ALL in parts:
        return set() if df.isEmpty() else {ALL_KEY}
    return {r[0] for r in df.select(*parts).distinct().select(partition_key(parts)).collect()}


def _balanced(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """AQE splits a hot partition over several writer tasks and packs small ones."""
    return df.hint("rebalance", *parts) if parts else df


def replace_partitions(df: DataFrame, path: str, partition_cols: Sequence[str],
                       touched: Iterable[str], log: bool = True, balance: bool = True) -> int:
    """The partitions ``touched`` (keys) hold exactly the rows of ``df``, which has none
    for others; the rest stays as it is. Returns the write's number."""
    spark, path, touched = df.sparkSession, path.rstrip("/"), set(touched)
    _note_schema(df, path, partition_cols)
    version = _log(spark, path, touched) if log else last_write(spark, path)
    emptied = touched - partitions_of(df, list(partition_cols) or [ALL])
    _put(_balanced(df, partition_cols) if balance else df, path, partition_cols)
    if emptied:
        _without_rows(spark, path, emptied)
    return version


def _note_schema(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    spark = df.sparkSession
    if table_exists(spark, path) and table_schema(spark, path) == (
            _nullable(df.schema), list(partition_cols)):
        return
    noted = spark.createDataFrame([], T.StructType([*df.schema.fields, *(
        T.StructField(f"{PARTITION}{c}", T.BooleanType()) for c in partition_cols)]))
    noted.coalesce(1).write.mode("overwrite").parquet(f"{path}/_schema")


def partition_rows(spark: SparkSession, keys: Iterable[str]) -> DataFrame:
    """Keys of partitions as rows of a column ``partition`` (a NULL row for none)."""
    listed = F.from_json(F.lit(json.dumps(sorted(keys))), "array<string>")
    return spark.range(1, numPartitions=1).select(F.explode_outer(listed).alias("partition"))


def _nullable(schema: T.StructType) -> T.StructType:
    """As Parquet gives a schema back."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def _log(spark: SparkSession, path: str, touched: set[str]) -> int:
    version = last_write(spark, path) + 1
    (partition_rows(spark, touched).withColumn(VERSION, F.lit(version).cast("bigint"))
     .write.mode("append").parquet(f"{path}/_changes"))
    return version


def _put(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    if not partition_cols:
        df = df.withColumn(ALL, F.lit(0))
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*(partition_cols or [ALL])).parquet(path))


def _without_rows(spark: SparkSession, path: str, keys: set[str]) -> None:
    """Overwrite the folders of these partitions with a file that has no rows."""
    df, names, parts = _stored(spark, path)
    folder = F.regexp_extract("_metadata.file_path", r"^(.*)/[^/]+$", 1)
    nothing = spark.createDataFrame([], T.StructType([f for f in df.schema if f.name not in parts]))
    found = df.where(partition_key(parts).isin(sorted(keys))).select(folder).distinct()
    for (at,) in found.collect():  # one row for each emptied partition
        nothing.coalesce(1).write.mode("overwrite").parquet(unquote(at))


def write_table(df: DataFrame, path: str, partition_cols: Sequence[str] = ()) -> int:
    """Replace the table's content with ``df``; return the write's number."""
    spark, path = df.sparkSession, path.rstrip("/")
    if table_exists(spark, path):
        stored, _, parts = _stored(spark, path)
        df, before = staged(df, "table"), partitions_of(stored, parts)
        return replace_partitions(df, path, partition_cols, before | partitions_of(
            df, list(partition_cols) or [ALL]))
    _note_schema(df, path, partition_cols)
    version = _log(spark, path, {EVERY})
    _put(_balanced(df, partition_cols), path, partition_cols)
    return version


def upsert_table(source: DataFrame, path: str, keys: Sequence[str],
                 partition_cols: Sequence[str] = (), *, null_safe: bool = False) -> int:
    """Create the table from ``source`` on the first run, else merge the source into it
    by ``keys`` (update whole row / insert); return the write's number. A duplicated
    non-NULL source key fails the run either way.

    The source is computed once, into the shared folder. Only the partitions of its rows
    and those holding a matched key are read and rewritten (so a key that moves leaves
    its old partition). The latter come from the table's key index, if it has one
    (``key_index.py``), else from a scan of its key and partition columns.
    """
    from laketier.sinks import key_index

    spark = source.sparkSession
    src = staged(source, "merge-source")
    if not table_exists(spark, path):
        source_keys(src, keys, null_safe).count()  # raises on a duplicated key
        return write_table(src, path, partition_cols)
    stored, names, parts = _stored(spark, path)
    check_columns(names, src)
    if not partition_cols:
        merged = upsert(stored.select(*names), src, keys, null_safe)
        return replace_partitions(merged, path, (), {ALL_KEY})
    if null_safe:
        raise ValueError("NULL keys match on unpartitioned tables only")
    touched = partitions_of(src, parts) | key_index.holding(spark, path, src, keys)
    merged = upsert(read_partitions(spark, path, touched), src, keys)
    return replace_partitions(merged, path, parts, touched)


# --- append-only tables ----------------------------------------------------------

def append(df: DataFrame, path: str, partition_cols: Sequence[str] = (), balance: bool = True) -> None:
    """Append rows; new columns are accepted and merged when reading. Without ``balance``
    each task writes its rows where they are, for rows of one partition of each."""
    (_balanced(df, partition_cols) if balance else df).write.mode("append").partitionBy(*partition_cols).parquet(path)


def read_appended(spark: SparkSession, path: str, string_partitions: Sequence[str] = (),
                  where: str | None = None, partition: dict | None = None) -> DataFrame:
    """Read an append-only table, merging the schemas of its files.

    ``partition`` (leading partition columns -> value) restricts listing and
    schema merging to that sub-folder; where it does not exist, the rows are
    none and the schema is that of one file. Partition values of
    ``string_partitions`` are kept as written (a date folder name must not
    turn into a DATE).
    """
    reader = spark.read.option("mergeSchema", True)
    if partition:
        folder = "/".join([path.rstrip("/"), *(f"{k}={v}" for k, v in partition.items())])
        if exists(spark, folder):
            df = reader.option("basePath", path.rstrip("/")).parquet(folder)
        else:
            df = spark.read.parquet(path).where(F.lit(False))
    else:
        df = reader.parquet(path)
    df = df.withColumns({c: F.col(c).cast("string") for c in string_partitions
                         if c in df.columns})
    return df.filter(where) if where else df
