"""Spark session defaults and the shared checkpoint folder.

The defaults are chosen for a large cluster: AQE re-plans joins and partition
counts at runtime (including skew-join splitting), :func:`shuffle_partitions_for` sizes
shuffle partitions from the bytes of the input, and the session time zone is UTC so that every epoch-millisecond
conversion is repeatable.  Nothing here is needed for correctness: every query
in :mod:`tidemill.plans` is written to be time-zone independent.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Fixed defaults (tuned for 100+ TB inputs; AQE coalesces them down on small data).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Broadcast only what the optimizer measured small; everything else sort-merges.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(master: str | None = None, app: str = "tidemill",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf.setdefault("spark.driver.memory", "16g")
        conf.setdefault("spark.ui.enabled", "false")
        conf.setdefault("spark.ui.showConsoleProgress", "false")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment (a shared file system every
    executor can reach).  Only when it is unset on a local master (tests) a fresh
    local folder is created and registered; elsewhere that is an error, since
    executors could not read each other's files.
    """
    cur = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions have no SparkContext
        sc = None
    if not cur and sc is not None:
        cur = sc.getCheckpointDir()
    if not cur:
        master = sc.master if sc is not None else ""
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        cur = tempfile.mkdtemp(prefix="tidemill-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cur)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(cur)
    return cur


#: Removes the shuffle files of a write or micro-batch at its end, not when the driver's JVM happens to
#: collect the objects that stand for them; for jobs whose shuffles nothing reads again.
SHUFFLES_ONCE = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session that hold within the block."""
    held = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in held.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffle_partitions_for(spark: SparkSession, path: str, mb: int = 128, least: int = 8) -> int:
    """Shuffle partitions for an input folder: its bytes over ``mb`` each (AQE coalesces from there)."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return max(least, -(-fs.getContentSummary(jpath).getLength() // (mb << 20)))


def state_dir(spark: SparkSession, name: str) -> str:
    """A per-query streaming checkpoint location under the shared folder."""
    return os.path.join(checkpoint_dir(spark), "streams", name)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in executor Python workers (what
    ``--py-files`` does at submit time): zip it once per application and add it
    with ``addPyFile``; Spark distributes the file to every executor.  Needed by
    the operators that run Python on executors (stateful processors, the SQL
    keyword table function)."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions ship code their own way
        return
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    zpath = os.path.join(tempfile.mkdtemp(prefix="tidemill-pyfiles-"), "tidemill.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)
