"""Session helpers: a local session for tests and benches, and the shared
checkpoint folder every lineage cut goes to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # tasks and their Python workers talk without TCP's delayed acknowledgements
    "spark.python.unix.domain.socket.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "centrix",
              shuffle_partitions: int | None = None,
              driver_memory: str = "8g") -> SparkSession:
    """Local session used by tests, bench and the entry point.

    On a cluster, build the session with spark-submit instead; every library
    function only takes the session it is given.
    """
    master = master or os.environ.get("CENTRIX_MASTER", "local[8]")
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only a local-mode session without the setting gets
    a fresh folder of its own (tests).  A cluster session without it is an
    error: a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    path = tempfile.mkdtemp(prefix="centrix-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``centrix`` importable in Python workers (kernels run inside
    ``mapInArrow`` tasks).  Zips the package once per SparkContext and adds it
    with ``addPyFile``, the same as ``--py-files`` on spark-submit."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="centrix-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    _SHIPPED.add(key)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/centrix-scratch/{name}-{uuid.uuid4().hex}"
