"""Spark session defaults and the shared checkpoint folder.

On a cluster the session is created by the platform; ``get_spark`` only
fills in settings that are unset, so cluster-provided values
(``spark.checkpoint.dir``, shuffle partitions, memory) always win.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings applied only when the session does not already define them.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def _submitted(key: str) -> bool:
    """Whether the submit command, its defaults file or the environment set
    ``key`` before Python started."""
    flags = {"spark.master": "--master", "spark.driver.memory": "--driver-memory"}
    args = os.environ.get("PYSPARK_SUBMIT_ARGS", "")
    if key in args or flags.get(key, key) in args:
        return True
    if "PYSPARK_GATEWAY_PORT" not in os.environ:      # not started by spark-submit
        return False
    if key == "spark.master":
        return True
    from pyspark import SparkConf, SparkContext
    SparkContext._ensure_initialized()
    return SparkConf().contains(key)


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "reviewlake", extra_conf: dict | None = None) -> SparkSession:
    """The active session, or a new one.

    A submitted master, memory or shuffle count always wins; a local
    session gets defaults for those that nobody set."""
    active = SparkSession.getActiveSession()
    if active is not None:
        _fill_unset(active)
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = dict(_DEFAULTS)
    if not _submitted("spark.master"):
        wanted |= {"spark.master": master or f"local[{cpus}]",
                   "spark.driver.memory": os.environ.get("SPARK_DRIVER_MEMORY", "16g"),
                   "spark.sql.shuffle.partitions": str(shuffle_partitions or cpus)}
    builder = SparkSession.builder.appName(app_name)
    for k, v in {**wanted, **(extra_conf or {})}.items():
        if not _submitted(k):
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    _fill_unset(spark)
    return spark


def _fill_unset(spark: SparkSession) -> None:
    for k, v in _DEFAULTS.items():
        if k.startswith("spark.ui."):
            continue  # static conf; only settable at build time
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session (the cluster names a
    shared, fault-tolerant folder there).  Where it is unset, a ``local``
    master (tests, bench) gets a scratch folder; any other master is an
    error, as its executors would each write to a disk of their own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 — remote session: only the conf is visible
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on master {master!r}")
        d = tempfile.mkdtemp(prefix="reviewlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_path`` named, once nothing reads it any
    more (on a remote session it stays)."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 — remote session: the platform clears the folder
        return
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files of a folder (0 on a remote session, which cannot see them)."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 — remote session: only the platform sees the folder
        return 0
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go when each write ends, not when
    the driver happens to collect its garbage (Spark 4.1; no effect before)."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, was)


_SHIPPED_KEY = "reviewlake.pyfile.shipped"


def ship_package(spark: SparkSession) -> None:
    """Make ``reviewlake`` importable on every Python worker.

    Stages that run Python (``mapInPandas``) unpickle functions that live in
    this package; workers import it by name.  The package is zipped once per
    application and distributed with ``addPyFile`` (the same mechanism as
    ``spark-submit --py-files``); a no-op when already shipped.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 — no SparkContext (remote session): the deployment ships code
        return
    if sc.getConf().get(_SHIPPED_KEY, None) == "1" or getattr(sc, "_reviewlake_shipped", False):
        return
    import reviewlake
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(reviewlake.__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="reviewlake-pkg-"), "reviewlake.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    sc._reviewlake_shipped = True
