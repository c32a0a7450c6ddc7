"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  Timestamps are interpreted in UTC so that
# window boundaries are the same in Spark and in the SQL oracle.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "rillet", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_session_conf(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Set the SQL settings on an existing session (the driver builds its own)."""
    for k, v in BASE_CONF.items():
        if spark.conf.isModifiable(k) and k != "spark.sql.streaming.stateStore.providerClass":
            spark.conf.set(k, v)
    show_package_to_workers(spark)


def show_package_to_workers(spark: SparkSession) -> None:
    """Put this checkout on the Python workers' path.

    Enough where executors see the same disk; a cluster ships the package
    with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    path = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in path:
        env["PYTHONPATH"] = os.pathsep.join([*path, root])


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and must be visible to every
    executor; without it a job that writes intermediate tables is refused.
    Only a local master (unit tests, trial runs) gets a private folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master or "").startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="rillet-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def scratch_root(spark: SparkSession) -> str:
    """The folder of all tables that this application writes on the way to its results."""
    return os.path.join(checkpoint_root(spark), "scratch", spark.sparkContext.applicationId)


def drop_scratch(spark: SparkSession) -> None:
    """Remove all tables that this application has written on the way, once no result
    that reads them is needed any more."""
    delete_path(spark, scratch_root(spark))


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check on the cluster file system (HDFS, object stores, local)."""
    fs, p = _hadoop_fs(spark, path)
    return bool(fs.exists(p))


def list_subdirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def rename_path(spark: SparkSession, path: str, to: str) -> None:
    """Give a written folder its final name, in one step where the file system has one."""
    fs, p = _hadoop_fs(spark, path)
    if not fs.rename(p, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"cannot rename {path} to {to}")


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a written table that nothing reads any more."""
    fs, p = _hadoop_fs(spark, path)
    fs.delete(p, True)
