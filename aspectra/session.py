"""Session helpers: builder for local runs, shared folder for durable output."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "aspectra", partitions: int = 8,
                  driver_memory: str = "16g") -> SparkSession:
    """Session with the settings every job here assumes (AQE on, UTC, no UI).
    In local mode the driver JVM is the only executor, so its heap is sized
    here (it only applies when this call starts the JVM)."""
    builder = SparkSession.builder.appName(app).config("spark.driver.memory", driver_memory)
    if master:
        builder = builder.master(master)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``aspectra`` importable in every Python worker (UDFs refer to its
    functions by module): the package is zipped once per application and added
    with ``addPyFile``, Spark's own way to distribute Python code (--py-files)."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, zpath = tempfile.mkstemp(prefix="aspectra-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)


def pin_utc(spark: SparkSession) -> None:
    """All event times are UTC wall clock; NTZ <-> LTZ casts must be identities."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Read from the session; only when nothing is configured (local tests) is a
    folder of our own chosen and registered as the checkpoint directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="aspectra-ckpt-")
    sc.setCheckpointDir(conf)
    return (sc.getCheckpointDir() or conf).rstrip("/")


def fresh_path(spark: SparkSession, *parts: str) -> str:
    """A new, unique location under the shared folder for one run's output."""
    base = shared_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "aspectra", *parts, uuid.uuid4().hex)


def spread(df, min_partitions: int | None = None):
    """Round-robin the rows over the cluster when a scan yields fewer partitions
    than there are task slots (a single-row-group file, a one-partition topic),
    before CPU-heavy per-row work. Large inputs already have more partitions
    than slots, so at scale this adds no shuffle."""
    if df.isStreaming:
        return df
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()  # planning only, no job
    except Exception:  # sessions without RDD access: leave the plan as it is  # noqa: BLE001
        return df
    return df.repartition(target) if current < target else df
