"""SparkSession construction and shared-storage helpers.

The session is configured for the engine's semantics rather than for one
machine: UTC session time zone (month grain is event time), ANSI mode on
(every cleaning expression uses ``try_*`` functions), AQE with skew-join and
partition coalescing on, and the Spark UI off.

Shared storage (versioned tables, checkpoints) always lives under the folder
the cluster names in ``spark.checkpoint.dir``.  We only pick a folder of our
own when that setting is absent, which is the local/test case.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import zipfile

from pyspark.sql import SparkSession

_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "tradelens",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's required settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_semantics(spark)
    ship_package(spark)
    return spark


def apply_semantics(spark: SparkSession) -> None:
    """Settings the engine's results depend on (safe to call on any session)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")


_LOCAL_FALLBACK: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints and written tables.

    Reads ``spark.checkpoint.dir`` from the session; only when it is unset
    (local runs and tests) a scratch folder is created once per application.
    The RDD checkpoint directory is pointed at the same folder if the
    context has none yet (Spark adds its own sub-folder for RDD checkpoints,
    so the *configured* base is returned, never the derived one).
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder "
                               "that the driver and all executors share")
        app = sc.applicationId
        base = _LOCAL_FALLBACK.get(app)
        if base is None:
            base = tempfile.mkdtemp(prefix="tradelens-ckpt-")
            _LOCAL_FALLBACK[app] = base
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path inside the shared folder, e.g. for a versioned table."""
    return "/".join([shared_dir(spark), "tradelens", *parts])


#: More partitions than this cost the driver more than they save a task.
MOST_PARTITIONS = 20_000


@contextlib.contextmanager
def fine_shuffles(spark: SparkSession, input_bytes: int, part_bytes: int = 16 << 20):
    """Within the block, adaptive shuffles deal out a number of partitions that grows with the
    input and are coalesced to ``part_bytes`` (or less, if the session says so), so the memory
    of a task that sorts its partition does not grow with the input.  Skewed partitions
    are still split by Spark.  The session's own settings are back afterwards."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    number = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    was = {k: spark.conf.get(k, None) for k in (size, number)}
    known = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    least = int(was[number] or spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        spark.conf.set(size, str(min(part_bytes, known(spark.conf.get(size)))))
        spark.conf.set(number, str(max(least, min(input_bytes // (part_bytes // 4), MOST_PARTITIONS))))
        yield
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem so it works on any store."""
    jvm = spark.sparkContext._jvm
    jsc = spark.sparkContext._jsc
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def list_files(spark: SparkSession, path: str) -> list[str]:
    """File names (not full paths) directly under ``path``."""
    jvm = spark.sparkContext._jvm
    jsc = spark.sparkContext._jsc
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(hpath))


def make_folder(spark: SparkSession, path: str) -> None:
    """Create ``path`` through the Hadoop FileSystem (an existing one stays)."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hpath)


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``tradelens`` importable in the Python workers of any executor.

    Grouped pandas functions are pickled by reference to their module, so
    workers must import the package.  The package is zipped once per driver
    process and added with ``addPyFile`` (what ``--py-files`` does on a
    cluster); a no-op when already shipped to this application.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    with _SHIP_LOCK:
        if app in _SHIPPED:
            return
        pkg_dir = os.path.dirname(os.path.abspath(__file__))
        root = os.path.dirname(pkg_dir)
        out = os.path.join(tempfile.mkdtemp(prefix="tradelens-pyfiles-"), "tradelens.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
            for dirpath, _, files in os.walk(pkg_dir):
                if "__pycache__" in dirpath:
                    continue
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(dirpath, f)
                        zf.write(full, os.path.relpath(full, root))
        sc.addPyFile(out)
        _SHIPPED.add(app)
