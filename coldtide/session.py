"""Session plumbing: code shipping and the shared working folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parent
_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    Planning a Python data source and running a pandas function both import
    the package by name in a separate process, which need not share the
    driver's ``sys.path``.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    folder = tempfile.mkdtemp(prefix="coldtide-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, f"{_PACKAGE.name}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(_PACKAGE.rglob("*.py")):
            out.write(path, path.relative_to(_PACKAGE.parent).as_posix())
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster shares (``spark.checkpoint.dir``).

    Only where the setting is absent and the master is local, as in tests, a
    temporary folder takes its place.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        folder = tempfile.mkdtemp(prefix="coldtide-shared-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        folder = Path(folder).as_uri()
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, deleted when the application ends."""
    path = f"{shared_folder(spark)}/coldtide-{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that no later plan reads."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read again.

    This cuts lineage and survives lost executors, and several consumers of
    the result do not recompute it. ``drop`` deletes it before the application
    ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def drop(df: DataFrame) -> None:
    """Delete the files of a staged table that no later plan reads."""
    drop_path(df.sparkSession, df._staged_at)
