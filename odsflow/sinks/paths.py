"""Folders: shared scratch space and versioned outputs."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``. Without that setting a local session
    gets a temporary one; a cluster must name a folder that all its machines share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="odsflow-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def numbered(spark: SparkSession, path: str, label: str, complete: bool = True) -> list[int]:
    """Numbers ``n`` of the folders ``label=n`` below ``path``, in order.

    A folder is complete once Spark has committed the job that wrote it.
    """
    fs, target = _fs(spark, f"{path}/{label}=*" + ("/_SUCCESS" if complete else ""))
    found = []
    for status in fs.globStatus(target) or []:
        folder = status.getPath().getParent() if complete else status.getPath()
        found.append(int(folder.getName().split("=", 1)[1]))
    return sorted(found)


def numbered_dates(spark: SparkSession, path: str, label: str) -> list[dt.date]:
    """Days of the folders ``label=yyyy-mm-dd`` below ``path``, in order."""
    fs, target = _fs(spark, f"{path}/{label}=*")
    names = [status.getPath().getName().split("=", 1)[1] for status in fs.globStatus(target) or []]
    return sorted(dt.date.fromisoformat(name) for name in names if name[:1].isdigit())
