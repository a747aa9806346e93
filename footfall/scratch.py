"""Folders for intermediate tables, in the storage all executors share."""

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session in one process, without that setting, gets a temporary folder of its own,
    removed at exit.  Executors in processes of their own may not see it, so there (on
    ``local-cluster`` too) the setting is required.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root and (context.master == "local" or context.master.startswith("local[")):
        folder = tempfile.mkdtemp(prefix="footfall-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
        root = context.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return root.rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh, not yet existing folder below :func:`shared_root`.

    All of them lie in one folder per application, which is removed when it ends.
    """
    root = f"{shared_root(spark)}/footfall-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    storage = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if storage.mkdirs(path):
        storage.deleteOnExit(path)
    return f"{root}/{purpose}-{uuid.uuid4().hex}"


def new_database(spark: SparkSession, purpose: str) -> str:
    """Create a database whose managed tables live below :func:`shared_root`.

    It is dropped when this process ends, or before by :func:`drop_database`.
    """
    name = f"{purpose}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_folder(spark, purpose)}'")
    _databases.append((spark, name))
    return name


def drop_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


_databases: list[tuple[SparkSession, str]] = []


def _drop_databases() -> None:
    for spark, name in _databases:
        if spark.sparkContext._jsc is not None:
            with contextlib.suppress(Exception):  # the application may be going down already
                drop_database(spark, name)


atexit.register(_drop_databases)


def write_aside(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to a fresh folder and read it back: computed once, with short lineage."""
    folder = new_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)
