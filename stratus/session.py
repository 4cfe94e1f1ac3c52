"""Session construction and cluster-facing settings."""

from __future__ import annotations

import os
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings every job of this library relies on. They are applied to sessions we build; jobs that
# receive a foreign session only depend on the NTZ-typed columns, so they do not need them.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "stratus", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (local tests) a folder is chosen here and written
    back to the session so every later call agrees.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext._conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        path = tempfile.mkdtemp(prefix="stratus-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A location under the shared checkpoint folder for written intermediate tables."""
    return os.path.join(checkpoint_dir(spark), *parts)


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Cut lineage by writing ``df`` as a parquet table under the shared checkpoint folder and reading it
    back. One job (an RDD ``checkpoint()`` computes the plan twice unless cached), and later reads get
    column pruning and filter pushdown. Each call writes a fresh folder, so a retried caller never sees
    a partial table."""
    import uuid

    path = scratch_path(df.sparkSession, "stratus", "materialized", f"{name}_{uuid.uuid4().hex[:12]}")
    df.write.mode("errorifexists").parquet(path)
    # the schema is known: no footer-reading job on the way back
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, *steps: Callable) -> list:
    """Results of steps that do not need each other, their jobs submitted at once: the small jobs of one fill the gaps
    of the other. Every step ends before the first error is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [r.result() for r in running]
