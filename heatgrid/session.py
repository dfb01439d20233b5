"""Spark session defaults and shared-storage helpers.

Most operators are lazy; those that write stages (refreshes, snapshots, numbered
tables, the numbered operators) run jobs when they are called. The session
settings here decide how the plans run.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for the plans in this package, at any scale.
#  * AQE re-plans joins from runtime sizes (broadcast only what it measured as
#    small), coalesces the tiny post-aggregation partitions and splits skewed
#    sort-merge-join partitions (one city may hold a third of all rows).
#  * ANSI mode stays on: every cast/divide in the package is a try_/guarded one.
#  * UTC keeps timestamp -> date truncation independent of the executor clock.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of snapshots are removed once their DataFrame is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app_name: str = "heatgrid",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster, ``master`` stays None so spark-submit decides; locally a
    ``local[N]`` master is passed by tests and the benchmark.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("WARN")
    except Exception:  # Spark Connect
        pass
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names shared storage and is used as is. Only
    when it is unset (local tests) a scratch folder is created for it.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="heatgrid-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
