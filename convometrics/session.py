"""Session settings the library relies on, and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# SQL confs the operators depend on.  Runtime-settable; applied by ``configure``.
REQUIRED_CONF = {
    # duplicate JSON keys: last one wins, as in Python's json module
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Defaults for sessions this package builds itself (tests, bench).  A cluster
# session keeps whatever its operator configured.
LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
}


def ship_package(spark: SparkSession) -> None:
    """Make this package's functions usable on executors without installing it there.

    Python tasks (``mapInPandas`` model calls) carry functions and model
    factories defined in this package; cloudpickle sends them by value instead
    of by module name, so workers need no import path to the package.
    """
    from pyspark import cloudpickle

    import convometrics

    cloudpickle.register_pickle_by_value(convometrics)


def configure(spark: SparkSession) -> SparkSession:
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    ship_package(spark)
    return spark


def local_session(master: str = "local[8]", app: str = "convometrics", **extra: str) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    for k, v in {**LOCAL_DEFAULTS, **REQUIRED_CONF, **extra}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediates.

    Taken from ``spark.checkpoint.dir`` (the cluster names a shared path there).
    Only when it is unset in a session on one machine -- a test -- a fresh
    temporary folder is created and registered; a cluster without the setting
    is refused, since its nodes would each see a different disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        root = tempfile.mkdtemp(prefix="convometrics-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique directory path under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/scratch/{name}-{uuid.uuid4().hex[:12]}"
