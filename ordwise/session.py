"""Session helpers: a tuned builder for tests/bench and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "ordwise",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, the submitter's own config wins."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("ORDWISE_DRIVER_MEMORY", "16g"),
        "spark.sql.shuffle.partitions": str(shuffle_partitions or 8),
        # drop checkpoint files once their DataFrame is garbage collected
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the session. Only in local mode with nothing configured (tests)
    a private folder is created and registered; on a cluster a missing
    setting is an error, never a machine-local fallback.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage "
                               "(checkpoints and intermediate tables are written there)")
        conf_dir = tempfile.mkdtemp(prefix="ordwise-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder.

    All paths of an application are in one folder, which Hadoop's file system
    deletes when the application ends.
    """
    sc = spark.sparkContext
    root = f"{checkpoint_root(spark).rstrip('/')}/ordwise-{sc.applicationId}"
    path = sc._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return f"{root}/{name}-{uuid.uuid4().hex}"


_SHIPPED: list = []      # the SparkContext that has the package already


def ship_package(spark: SparkSession) -> None:
    """Make ``ordwise`` importable in Python workers (once per SparkContext).

    The equivalent of ``spark-submit --py-files ordwise.zip``: the package is
    zipped on the driver and served to executors by ``addPyFile``.
    """
    import zipfile
    sc = spark.sparkContext
    if _SHIPPED and _SHIPPED[0] is sc:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="ordwise-pyfiles-"), "ordwise.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(out)
    _SHIPPED[:] = [sc]
