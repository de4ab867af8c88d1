"""Session settings and the shared storage root.

The warehouse writes its tables, stream checkpoints and lineage cuts under the
shared folder the cluster names in ``spark.checkpoint.dir``. That setting is read
from the session; a private folder is only created when it is unset (tests,
a laptop), never on a cluster.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the warehouse relies on. All of them can be changed on a
# live session, so they are applied to whatever session a caller hands us.
RUNTIME_CONF = {
    # Raw strings carry wall-clock times; pin the zone so dates do not shift.
    "spark.sql.session.timeZone": "UTC",
    # Let AQE re-plan at runtime: coalesce small shuffle partitions, split skewed
    # join partitions and turn joins whose measured side is small into broadcasts.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A value that does not fit a contract must fail the write, not become NULL.
    "spark.sql.ansi.enabled": "true",
    # A rerun of one day replaces that day only (never the whole table).
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, app_name: str = "laminar",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for scripts and tests; on a cluster the submitter sets master."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def storage_root(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``.

    When it is unset, a private folder is made only for a local-mode session (tests,
    a laptop). On a cluster a machine-local folder would be invisible to the other
    executors and lost with its machine, so an unset root is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster "
                             "(tables, stream checkpoints and lineage cuts are written there)")
        root = tempfile.mkdtemp(prefix="laminar-")
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def new_area(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the storage root for one run of a job."""
    return f"{storage_root(spark)}/laminar/{label}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so local folders can be inspected in tests."""
    return path[len("file:"):] if path.startswith("file:") else path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of the Hadoop file system that serves it.

    A metadata call on the driver; unlike a failed read, it leaves no analysis
    error behind for query listeners to report.
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def is_directory(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder, asked of the file system that serves it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p) and fs.getFileStatus(p).isDirectory())
