"""Layout of written tables: compaction, clustering, and their names in the catalog."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laketier.sinks import tables

DEFAULT_FILE_BYTES = 256 * 1024 * 1024
BITS = 16


def _number(c: str, kind: T.DataType) -> Column:
    """A column's values as doubles in the same order."""
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
    if isinstance(kind, T.NumericType):
        return F.col(c).cast("double")
    raise ValueError(f"{c}: only numbers, dates and timestamps interleave")


def interleaved(df: DataFrame, cols: Sequence[str], bits: int = BITS) -> Column:
    """The bits of several columns' ranks in turn, as one sort key: rows near in it are
    near in every column (Z-order). A rank is the value's place among ``2**bits`` equal
    parts of the column's range, which one aggregate finds; NULL ranks first."""
    if bits * len(cols) > 63:
        raise ValueError("more than 63 bits to interleave")
    values = [_number(c, df.schema[c].dataType) for c in cols]
    bounds = df.agg(*[f(v) for v in values for f in (F.min, F.max)]).first()
    key = F.lit(0).cast("bigint")
    for i, value in enumerate(values):
        low, high = bounds[2 * i] or 0.0, bounds[2 * i + 1] or 0.0
        part = ((high - low) or 1.0) / (2 ** bits - 1)
        rank = F.coalesce(F.floor((value - F.lit(low)) / F.lit(part)), F.lit(0)).cast("bigint")
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(bit, b * len(cols) + i))
    return key


def rewrite_layout(spark: SparkSession, path: str, sort_cols: Sequence[str],
                   target_file_bytes: int = DEFAULT_FILE_BYTES,
                   only: Iterable[str] | None = None) -> int:
    """Compact and cluster the partitions written since the last rewrite (or ``only``
    those): rows range-partitioned and sorted on the partition columns and ``sort_cols``
    into files of about ``target_file_bytes``, so that Parquet's min/max statistics skip
    files. Several sort columns are interleaved. Rows stay the same, so the rewrite is in
    no log of changes. Returns the number of partitions rewritten."""
    noted = f"{path.rstrip('/')}/_layout"
    changed, version = tables.changes(spark, path, tables.seen(spark, noted))
    todo = changed if only is None else set(only)
    if not todo:
        return 0
    parts = tables.table_schema(spark, path)[1]
    rows = tables.read_partitions(spark, path, todo)
    size = (rows.select("_metadata.file_path", "_metadata.file_size").distinct()
            .agg(F.sum("file_size")).first()[0] or 1)
    cols = [c for c in sort_cols if c not in parts]
    order = [F.col(p) for p in parts]
    order += [interleaved(rows, cols)] if len(cols) > 1 else [F.col(c) for c in cols]
    laid = (rows.repartitionByRange(max(1, math.ceil(size / target_file_bytes)), *order)
            .sortWithinPartitions(*order))
    tables.replace_partitions(laid, path, parts, todo, log=False, balance=False)
    if only is None:
        tables.note_seen(spark, noted, version)
    return len(todo)


def register_table(spark: SparkSession, database: str, name: str, path: str,
                   partition_cols: Sequence[str] | None = None) -> str:
    """Expose the table as ``database.name``, an external table over its folder: created
    once, under a name that stays; later calls let the catalog find new partitions and
    forget cached files. ``partition_cols`` for append-only tables."""
    full = f"`{database}`.`{name}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    if partition_cols is None:
        schema, parts = tables.table_schema(spark, path)
    else:
        schema = tables.read_appended(spark, path, partition_cols).schema
        parts = list(partition_cols)
    if not spark.catalog.tableExists(f"{database}.{name}"):
        fields = [*(f for f in schema.fields if f.name not in parts), *(schema[p] for p in parts)]
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        if not parts:
            parts = [tables.ALL]
            cols += f", `{tables.ALL}` int"
        at = path.rstrip("/").replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE {full} ({cols}) USING parquet PARTITIONED BY "
                  f"({', '.join(f'`{p}`' for p in parts)}) LOCATION '{at}'")
    spark.catalog.recoverPartitions(f"{database}.{name}")
    spark.catalog.refreshTable(f"{database}.{name}")
    return f"{database}.{name}"
