"""Session construction for local runs, and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "basketlens",
                  **conf: str) -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Not needed where the package is installed on the executors or passed with ``--py-files``.
    """
    context = spark.sparkContext
    if getattr(context, "_basketlens_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='basketlens-')}/basketlens", "zip",
                                  package.parent, package.name)
    context.addPyFile(archive)
    context._basketlens_shipped = True


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back to a
    temporary folder: on a cluster that folder would exist on one machine alone.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if root:
        return root
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="basketlens-"))
    return context.getCheckpointDir()


_made: list[str] = []


@atexit.register
def _clear_at_exit() -> None:
    """What this process has left in the shared folder goes with it, if its session still answers."""
    spark = SparkSession.getActiveSession()
    if _made and spark is not None and spark.sparkContext._jsc is not None:
        clear_scratch(spark)


def made() -> int:
    """Intermediate tables made so far and not cleared."""
    return len(_made)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, remembered until ``clear_scratch``; none is left when the process ends."""
    path = f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear_scratch(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Delete the intermediate tables made in this process after the first ``since`` ones, but for the last ``keep``.

    For the end of a job or a stage, when its results are written: frames that read these tables end with it.
    """
    end = max(since, len(_made) - keep)
    for path in _made[since:end]:
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
    del _made[since:end]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are deleted at the end, also after a failure."""
    since = len(_made)
    try:
        yield
    finally:
        clear_scratch(spark, since)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and return a scan of it.

    Used before iterative work (k-means, Newton steps): each pass then reads a few narrow columns
    instead of repeating joins, and a lost executor costs a re-read rather than a re-run. Unlike
    ``checkpoint()`` the plan runs only once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
