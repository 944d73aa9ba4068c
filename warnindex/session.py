"""Spark session settings the library relies on, and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job assumes: UTC wall clock for NTZ columns, AQE on.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "warnindex",
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench; on a cluster use the cluster's session."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


MiB = 1 << 20


def suggested_conf(shuffle_bytes: int, cores: int, target_bytes: int = 128 * MiB) -> dict:
    """Partition sizing for a cluster run: enough initial shuffle partitions
    that each holds about ``target_bytes`` (AQE then coalesces small ones),
    never fewer than two per core, and scan splits of the same size.

    ``shuffle_bytes`` is the volume of the widest shuffle -- for the flagship,
    the projected message rows (area, time, text, level, id: ~60 B/row).
    """
    parts = max(2 * cores, -(-int(shuffle_bytes) // int(target_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(int(target_bytes)),
        "spark.sql.files.maxPartitionBytes": str(int(target_bytes)),
    }


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the library relies on to an existing session, and ship the package
    to its workers."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Once per application: the package as a zip for the Python workers, so jobs run from any
    folder and on any machine without an install."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="warnindex-"), "warnindex.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.join("warnindex", os.path.relpath(path, root)))
    sc.addPyFile(target)  # the driver's own copy; Spark hands it to the executors
    _SHIPPED.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Read from the session; a folder of our own is set only where the session
    has none (tests and local runs).  On a cluster the configured shared
    folder is always used.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc._conf.get("spark.checkpoint.dir", None)
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name the cluster's shared folder")
        d = tempfile.mkdtemp(prefix="warnindex-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for an intermediate table.

    All of an application's are in one folder, which the file system removes when
    the application ends (a lazy result may be read until then)."""
    sc = spark.sparkContext
    root = os.path.join(shared_dir(spark), f"warnindex-{sc.applicationId}")
    if root not in _SCRATCH:
        p = sc._jvm.org.apache.hadoop.fs.Path(root)
        fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(p)
        fs.deleteOnExit(p)
        _SCRATCH.add(root)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")


_SCRATCH: set[str] = set()


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    Reads at most ``max_rows + 1`` rows, so the check itself is bounded.
    """
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Broadcast hint only behind a checked row bound; else leave the join
    to Spark (sort-merge, or AQE's runtime broadcast on measured size)."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if fits(df, max_rows) else df
