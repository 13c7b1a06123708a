"""Folders for tables and files that are written and read again; what stands in them goes when the application ends."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def base(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; where that is unset, a local master's own temporary folder.

    A cluster without a shared folder raises: its machines would write where nobody reads."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not known:
        if not re.match(r"local(\[[^-]*\])?$", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        known = tempfile.mkdtemp(prefix="quirework-")
        atexit.register(shutil.rmtree, known, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(known)
    return known.rstrip("/")


def until_exit(spark: SparkSession, path: str) -> str:
    """The path, which is there, marked so that its file system deletes it when the driver ends."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def folder(spark: SparkSession, name: str) -> str:
    """The path of a new folder that does not exist yet, in one that is deleted when the driver ends."""
    above = f"{base(spark)}/scratch-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(above)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(at)
    return f"{until_exit(spark, above)}/{name}"


def put(spark: SparkSession, path: str, content: bytes) -> None:
    """One small file through Hadoop's file systems, so that any store will do."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
