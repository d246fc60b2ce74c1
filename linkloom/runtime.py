"""Session helpers: a local session for tests, and the folder for written tables."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, tempfile.TemporaryDirectory] = {}
_used: set[str] = set()
_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def local_session(cores: str = "8", app: str = "linkloom", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def workspace(spark: SparkSession) -> str:
    """Folder shared by all executors in which intermediate tables are written.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one process, may fall back to a temporary folder.
    """
    app = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/linkloom-{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _local_folders:
        _local_folders[app] = tempfile.TemporaryDirectory(prefix="linkloom-")
    return _local_folders[app].name


def new_path(spark: SparkSession, label: str) -> str:
    _used.add(spark.sparkContext.applicationId)
    return f"{workspace(spark)}/{label}-{uuid.uuid4().hex}"


def clear_workspace(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, if it has made any."""
    if spark.sparkContext.applicationId not in _used:
        return
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(workspace(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def delete_path(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and go on from the stored copy.

    Cuts the lineage, keeps values that depend on row placement stable over
    retries, and gives the optimizer the true size of the data.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, wherever they run."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    # Executors fetch the archive from the driver when they run their first task.
    _shipped[app] = tempfile.TemporaryDirectory(prefix="linkloom-package-")
    archive = shutil.make_archive(f"{_shipped[app].name}/{package.name}", "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)
