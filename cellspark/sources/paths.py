"""Places of files: a folder that driver and executors share, existence checks, versioned outputs."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, or the session's checkpoint folder; only a local session may do without one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = "file://" + tempfile.mkdtemp(prefix="cellspark-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _store(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    store, at = _store(spark, path)
    return bool(store.exists(at))


def remove(spark: SparkSession, path: str) -> None:
    store, at = _store(spark, path)
    store.delete(at, True)


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it, for tasks."""
    return fs.FileSystem.from_uri(path if "://" in path else "file:///" + path.removeprefix("file:").lstrip("/"))


def file_name(value: Column) -> Column:
    """A value as a part of a path, as partitioned writes spell it: what paths keep for themselves is escaped."""
    text = F.when(value.cast("string") == "", None).otherwise(value.cast("string"))
    letters = F.transform(F.split(text, ""), lambda c: F.when(c.rlike("[\\x01-\\x1f\"#%'*/:=?\\\\\\x7f{\\[\\]^]"), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c))
    return F.when(text.isNull(), "__HIVE_DEFAULT_PARTITION__").otherwise(F.concat_ws("", letters))


def require(spark: SparkSession, *paths: str) -> None:
    """Raise for the first path that is not there."""
    for p in paths:
        if not exists(spark, p):
            raise FileNotFoundError(p)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the outputs v1, v2, ... below root, ascending."""
    store, at = _store(spark, root)
    if not store.exists(at):
        return []
    names = [f.getPath().getName() for f in store.listStatus(at)]
    return sorted(int(n[1:]) for n in names if re.fullmatch(r"v\d+", n))


def write_versioned(df: DataFrame, root: str, **options) -> str:
    """Write df as Parquet below root beside what earlier runs left there; gives the new path.  Nothing is replaced."""
    path = f"{root.rstrip('/')}/v{max(versions(df.sparkSession, root), default=0) + 1}"
    df.write.options(**options).parquet(path)
    return path


def latest(spark: SparkSession, root: str) -> DataFrame:
    known = versions(spark, root)
    if not known:
        raise FileNotFoundError(root)
    return spark.read.parquet(f"{root.rstrip('/')}/v{known[-1]}")
