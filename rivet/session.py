"""Spark session helpers.

Everything in ``rivet`` takes an existing ``SparkSession``; this module only
builds one for tests, the bench and local runs, and resolves the shared
checkpoint folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings the library relies on: UTC for timestamp arithmetic,
# AQE for runtime re-planning (coalescing, skew-join splitting), ANSI on.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "rivet",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    On a cluster the master comes from spark-submit; ``master`` is only for
    local runs and tests.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("RIVET_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    A cluster names it in ``spark.checkpoint.dir`` and we use that as is.
    Where it is unset, only a single-machine session (tests, the bench) gets
    a scratch folder; on a cluster that would be a folder per machine, so it
    is an error there.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if conf_dir:
        if current is None:
            sc.setCheckpointDir(conf_dir)
        return conf_dir
    if current is not None:
        return current
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="rivet-ckpt-", dir=os.environ.get("RIVET_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` under the shared checkpoint folder and
    read it back. Survives lost executors; its size is known to the planner."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rivet/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context, so
    that functions defined in it load on executors started elsewhere."""
    sc = spark.sparkContext
    if getattr(sc, "_rivet_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="rivet-zip-")
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "rivet_package"), "zip",
                                     os.path.dirname(root), os.path.basename(root)))
    sc._rivet_shipped = True
