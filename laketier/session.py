"""Session helpers.

Library code never configures the session it is handed: on a cluster the
deployment owns partitions, memory and the shared checkpoint folder. The
builder below is for tests and ``bench.py`` only, and it sets a checkpoint
folder only when the session has none.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "laketier") -> SparkSession:
    """A local session tuned like a small cluster (AQE on, UTC, no UI)."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LAKETIER_DRIVER_MEMORY", "16g"))
        .config("spark.sql.sources.partitionOverwriteMode", "static")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder, creating a local one
    only when the session names none (tests, laptops)."""
    current = spark.conf.get(CHECKPOINT_CONF, None)
    if not current:
        current = tempfile.mkdtemp(prefix="laketier-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: computed once,
    safe from lost executors, columnar, and of a size that Spark knows."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/laketier-stage/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """Results of independent steps whose Spark jobs run at the same time: a day's small
    jobs leave most of a cluster idle one by one. All steps end before the first failure,
    in their order, is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [r.result() for r in running]


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    current = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not current:
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set; point it at a folder every executor can reach")
    return current
