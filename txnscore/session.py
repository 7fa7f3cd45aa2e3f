"""Session construction and the shared folder used for checkpoints and written tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "txnscore", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC time, AQE on and the UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and points at shared storage. Only when it is unset
    (local tests) do we create a private temporary folder and register it.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not (conf.get("spark.master", "local") or "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = os.environ.get("TXNSCORE_LOCAL_ROOT") or _local_root()
    return root.rstrip("/")


_LOCAL_ROOT: str | None = None


def _local_root() -> str:
    global _LOCAL_ROOT
    if _LOCAL_ROOT is None:
        _LOCAL_ROOT = tempfile.mkdtemp(prefix="txnscore-")
    return _LOCAL_ROOT


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint()`` has a reliable directory; return the shared root."""
    root = shared_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{root}/checkpoints")
    return root


def scratch_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A fresh path under the shared root for a written table, model or stream checkpoint."""
    if set(name) & set("[]{}*?,\\^ "):
        raise ValueError(f"readers take these characters of a path for a pattern: {name}")
    root = ensure_checkpoint_dir(spark)
    suffix = f"-{uuid.uuid4().hex[:12]}" if unique else ""
    return f"{root}/tables/{name}{suffix}"


def let_workers_import(spark: SparkSession) -> None:
    """Put this package's parent folder on the Python workers' path, whatever folder the driver was
    started in (on a cluster the package is installed or shipped, and the entry is harmless)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
