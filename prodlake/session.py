"""Session helpers: one place for the settings every job relies on.

Nothing here tunes the engine for a particular data size; shuffle width and
file split size come from the cluster's own configuration unless a caller
passes them (tests pass small numbers for ``local[*]``).
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession


def build_session(
    master: str | None = None,
    app_name: str = "prodlake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with AQE on, the UI off and UTC time."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # a local run keeps the catalog's default folder out of the working
        # directory; a cluster names its own warehouse
        conf["spark.sql.warehouse.dir"] = tempfile.mkdtemp(prefix="prodlake-warehouse-")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


MiB = 1 << 20


def scale_settings(input_bytes: int, total_cores: int, partition_mib: int = 256) -> dict[str, str]:
    """Settings for a run over ``input_bytes`` of Parquet on ``total_cores``
    executor cores, to pass as ``build_session(extra=...)`` or
    ``spark-submit --conf``.

    * Scan tasks of ``partition_mib`` (``maxPartitionBytes``): 100 TB is about
      400 000 tasks of 256 MiB, each well inside one core's memory share.
    * The first shuffle width assumes the shuffle may be as large as the
      input (a table rewrite by key is); AQE then coalesces partitions up to
      the same advisory size, judged by size rather than by core count.
    * Skewed join partitions (five times the median and over the advisory
      size) are split by AQE; broadcast stays at Spark's checked runtime
      threshold.
    """
    target = partition_mib * MiB
    width = max(2 * total_cores, -(-input_bytes // target))
    return {
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target),
    }


def _is_local(spark: SparkSession) -> bool:
    # "local-cluster" has executors of their own and counts as a cluster
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Reads the setting from the session. Only a local session (tests, the
    bench) without the setting gets a fresh folder of its own; on a cluster
    a missing setting is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; give the cluster's shared folder"
        )
    local = tempfile.mkdtemp(prefix="prodlake-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never reused path below the shared folder (no overwrite races)."""
    base = shared_dir(spark)
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append((spark, path))
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to a new folder below the shared folder and read
    back: later uses read files, and what made them doesn't run again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per context, so that its
    functions run wherever the driver was started from."""
    sc = spark.sparkContext
    if _SHIPPED.get("context") == sc.applicationId:
        return
    root = Path(__file__).resolve().parent
    into = Path(tempfile.mkdtemp(prefix="prodlake-package-")) / f"{root.name}.zip"
    with zipfile.ZipFile(into, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(into))
    _SHIPPED["context"] = sc.applicationId


_SHIPPED: dict[str, str] = {}
_SCRATCH: list[tuple[SparkSession, str]] = []


def drop_scratch() -> None:
    """Remove every scratch path this driver made. Runs when the driver
    ends; a long-running driver may call it once its results are committed
    (frames that still read scratch copies can't be used after it)."""
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        try:
            delete_path(spark, path)
        except (Py4JError, OSError, AttributeError):  # the JVM is gone
            return


atexit.register(drop_scratch)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, asked of the Hadoop file system."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(hconf).exists(jpath)



def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder (recursively) through the Hadoop file system."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(hconf).delete(jpath, True)
