"""Session helpers.

The library never owns the cluster configuration: on a cluster the session is
built by the platform and we only *read* settings from it.  ``local_session``
exists for tests, benches and the smoke entry point.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this library relies on for correct results.
# * UTC: window labels, dates and NTZ->timestamp casts must not depend on the
#   machine zone.
# * AQE: coalesces small shuffle partitions, splits skewed join partitions and
#   turns sort-merge joins into broadcast joins when a side proves small at
#   runtime (a *measured* size check, not a guess).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

RECOMMENDED_CONF = {
    # keyed streaming state off-heap (large state does not load the JVM heap)
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "citylens", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benches (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CITYLENS_DRIVER_MEMORY", "8g"))
    )
    for k, v in {**REQUIRED_CONF, **RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session we were handed."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from ``spark.checkpoint.dir`` (or the context's current checkpoint
    dir).  Where neither is set, a local master (tests) gets a scratch folder;
    on a cluster a machine-local folder would be lost to the other machines,
    so that is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote (Connect) session: the server owns the folder
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
        conf_dir = tempfile.mkdtemp(prefix="citylens-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def parallelism(spark: SparkSession, default: int = 8) -> int:
    """Task slots of the cluster (``defaultParallelism``)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001
        return default


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir (for streaming
    checkpoints and materialised intermediate tables)."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/citylens/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> str:
    """Make this package importable on the executors: a zip of it under the
    shared checkpoint folder, added with ``addPyFile``.  Job starts call it;
    with ``--py-files`` or an installed package it is not needed."""
    import io
    import zipfile

    root = os.path.dirname(os.path.abspath(__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    path = scratch_path(spark, "package") + "/citylens.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        out.write(bytearray(data.getvalue()))
    finally:
        out.close()
    spark.sparkContext.addPyFile(path)
    return path
