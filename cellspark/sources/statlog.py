"""The log of a run as an append-only table: steps add counts, retries and reruns are ordered by number.

<path>/data/<name> holds one step's rows; <path>/commits/<number>.json names them.  A commit is a file that only one writer
can create, so its number orders it among all others; rows without a commit are not part of the log.  An append that is
tried again with the same token finds its commit and adds nothing.  The file system must refuse to create a file twice,
as HDFS and local disks do.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .paths import _store

ROWS = "prefix string, metric string, value long"


def commits(spark: SparkSession, path: str) -> list[dict]:
    """The log's commits in order: number, step, token, data."""
    store, at = _store(spark, f"{path.rstrip('/')}/commits")
    if not store.exists(at):
        return []
    names = sorted(f.getPath().getName() for f in store.listStatus(at) if f.getPath().getName().endswith(".json"))
    if not names:
        return []
    rows = spark.read.option("wholetext", True).text([f"{path.rstrip('/')}/commits/{n}" for n in names]).select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("name"), "value").collect()
    return [{"number": int(r["name"].removesuffix(".json")), **json.loads(r["value"])} for r in sorted(rows, key=lambda r: r["name"])]


def append(log: DataFrame, path: str, step: str, token: str | None = None) -> int:
    """Add prefix, metric, value rows of one step; gives the commit's number.  A prefix shows each metric once in an append."""
    spark, root = log.sparkSession, path.rstrip("/")
    known = commits(spark, path)
    if token is not None:
        for c in known:
            if c["token"] == token:
                return c["number"]
    name = uuid.uuid4().hex
    log.select(F.col("prefix").cast("string"), F.col("metric").cast("string"), F.col("value").cast("long")).write.parquet(f"{root}/data/{name}")
    twice = spark.read.schema(ROWS).parquet(f"{root}/data/{name}").groupBy("prefix", "metric").count().where("count > 1").first()
    if twice:
        raise ValueError(f"{twice['prefix']} has more than one value of {twice['metric']}")
    body = json.dumps({"step": step, "token": token, "data": name}).encode()
    number = max((c["number"] for c in known), default=0) + 1
    while not _create(spark, f"{root}/commits/{number:012d}.json", body):
        if token is not None:  # another try of this append may have come first
            for c in commits(spark, path):
                if c["token"] == token:
                    return c["number"]
        number += 1
    return number


def _create(spark: SparkSession, path: str, body: bytes) -> bool:
    """Whether this call created the file."""
    store, at = _store(spark, path)
    store.mkdirs(at.getParent())
    if store.exists(at):
        return False
    try:
        out = store.create(at, False)
    except Exception as e:
        if "already exists" in str(e) or "FileAlreadyExists" in str(e):
            return False
        raise
    out.write(bytearray(body))
    out.close()
    return True


def read(spark: SparkSession, path: str) -> DataFrame:
    """prefix, metric, value, step, commit of all committed rows."""
    known = commits(spark, path)
    if not known:
        return spark.createDataFrame([], f"{ROWS}, step string, commit long")
    root = path.rstrip("/")
    rows = spark.read.schema(ROWS).parquet(*[f"{root}/data/{c['data']}" for c in known])
    names = spark.createDataFrame([(c["data"], c["step"], c["number"]) for c in known], "data string, step string, commit long")
    return rows.withColumn("data", F.element_at(F.split("_metadata.file_path", "/"), -2)).join(F.broadcast(names), "data").select("prefix", "metric", "value", "step", "commit")  # a row an append


def last_values(spark: SparkSession, path: str) -> DataFrame:
    """prefix, metric, value: of repeated metrics the one of the latest commit."""
    return read(spark, path).groupBy("prefix", "metric").agg(F.max_by("value", "commit").alias("value"))
