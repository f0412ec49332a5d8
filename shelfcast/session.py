"""SparkSession helpers.

Design notes
  * AQE on: runtime coalescing of shuffle partitions, skew-join splitting and
    SMJ -> BHJ conversion once a side's real size is known.
  * The UI is off (no server is started by this library).
  * ``ensure_checkpoint_dir`` honours ``spark.checkpoint.dir`` from the session;
    it only creates a local directory when nothing is configured (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(app: str = "shelfcast", cores: int | str | None = None,
              shuffle_partitions: int | None = None,
              driver_memory: str = "16g", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session tuned for the panel workloads."""
    # under spark-submit the gateway is already there, and with it master and partitions
    submitted = "PYSPARK_GATEWAY_PORT" in os.environ
    builder = SparkSession.builder
    if not submitted:
        builder = builder.master(f"local[{cores or os.environ.get('SHELFCAST_CORES', '*')}]")
    parts = shuffle_partitions or os.environ.get("SHELFCAST_SHUFFLE_PARTITIONS") or (None if submitted else 8)
    if parts:
        builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    builder = (
        builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # joins on (id, date) may reuse a hash partitioning on id alone, so the panel,
        # its joins and its per-series windows share one exchange
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.parquet.datetimeRebaseModeInRead", "CORRECTED")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only if none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...), and
    it is used as is.  Only when it is unset (unit tests, local runs) a scratch
    folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a shared "
                           "folder (HDFS, S3, ...); a machine-local folder would not survive an "
                           "executor loss")
    local = tempfile.mkdtemp(prefix="shelfcast-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``shelfcast`` importable on the executors' Python workers (grouped pandas
    functions are pickled by reference to this package): zip the package once per
    application and ``addPyFile`` it, as ``spark-submit --py-files`` would."""
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    zpath = os.path.join(tempfile.mkdtemp(prefix="shelfcast-pyfiles-"), "shelfcast.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)
