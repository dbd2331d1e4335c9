"""Spark session and cluster-setting helpers.

The library never hard-codes a storage location: shared folders (the
checkpoint directory) are read from the session.  Only when the session
has none (local tests) do we fall back to a fresh scratch folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "tessera",
                shuffle_partitions: int | None = None) -> SparkSession:
    """The running session as it is, or a new one.

    A session that exists keeps all its settings.  A new one gets the
    settings below, unless ``spark-submit`` or the Spark configuration
    has set them already; ``shuffle_partitions`` is set only if given
    (here or in TESSERA_SHUFFLE_PARTITIONS).
    """
    running = SparkSession.getActiveSession()
    if running is not None:
        ensure_checkpoint_dir(running)
        return running
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # AQE broadcasts a join side only after measuring it; vocabulary-,
        # IDF- and weight-sized tables stay under this bound, data tables do not
        "spark.sql.adaptive.autoBroadcastJoinThreshold": os.environ.get("TESSERA_BROADCAST_BYTES", "128MB"),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("TESSERA_DRIVER_MEMORY", "16g"),
    }
    parts = shuffle_partitions or os.environ.get("TESSERA_SHUFFLE_PARTITIONS")
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    submitted = SparkConf()
    for key, value in defaults.items():
        if not submitted.contains(key):
            builder = builder.config(key, value)
    if parts:
        builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable in Python workers (Arrow UDFs).

    Clusters ship the package with ``--py-files``; in local mode (tests,
    notebooks) the package folder is zipped once and added here.
    """
    sc = spark.sparkContext
    if id(sc) in _SHIPPED or not sc.master.startswith("local"):
        return
    import shutil
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="tessera-pkg-", dir="/tmp")
    zpath = shutil.make_archive(os.path.join(out, "tessera"), "zip", os.path.dirname(pkg), "tessera")
    sc.addPyFile(zpath)
    _SHIPPED.add(id(sc))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster sets it to a shared folder.  Only a single-machine session
    (``local`` master) that has none gets a scratch folder; elsewhere a
    folder of one machine would be lost to the others, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
