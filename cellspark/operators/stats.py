"""Run statistics and input checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .alignments import alignment_counts
from .ranks import ranked
from .reads import read_counts

METRICS = ["reads_total", "reads_barcode_passed", "reads_length_passed", "reads_trimmed", "reads_mapped", "alignments", "alignments_qc_filtered", "alignments_dedup"]


def last_values(log: DataFrame, order: str) -> DataFrame:
    """prefix, metric, value: of repeated metrics the last."""
    return log.groupBy("prefix", "metric").agg(F.max_by("value", order).alias("value"))


def run_counts(tagged: DataFrame | None = None, trimmed: DataFrame | None = None, alignments: DataFrame | None = None, deduped: DataFrame | None = None) -> DataFrame:
    """prefix, metric, value: as many of METRICS as the given steps tell, one pass over each.

    tagged: fragments with ligation and rt (null for misses) and long_enough; trimmed: fragments that adapter trimming
    left; alignments: records with flag and mapq; deduped: pairs that duplicate removal left.
    """
    parts = []
    if tagged is not None:
        parts.append(read_counts(tagged))
    if trimmed is not None:
        parts.append(trimmed.groupBy("prefix").agg(F.count("*").alias("value")).select("prefix", F.lit("reads_trimmed").alias("metric"), "value"))
    if alignments is not None:
        parts.append(alignment_counts(alignments).unpivot("prefix", ["reads_mapped", "alignments", "alignments_qc_filtered"], "metric", "value"))
    if deduped is not None:
        parts.append(deduped.groupBy("prefix").agg(F.count("*").alias("value")).select("prefix", F.lit("alignments_dedup").alias("metric"), "value"))
    if not parts:
        raise ValueError("no step is given")
    return reduce(DataFrame.unionByName, parts)


def pivot(log: DataFrame, metrics: list[str] = METRICS, missing: int = -1) -> DataFrame:
    """One row a prefix, one column a metric."""
    return log.groupBy("prefix").pivot("metric", metrics).agg(F.first("value")).na.fill(missing)


def frequent_prefixes(records: DataFrame, least: int, column: str = "prefix") -> DataFrame:
    return records.groupBy(column).count().where(F.col("count") >= least)


def missing_files(expected: DataFrame, present: DataFrame, on: list[str]) -> DataFrame:
    return expected.join(present, on, "left_anti")


def complete_prefixes(files: DataFrame, kinds: list[str]) -> DataFrame:
    """Prefixes of file names <prefix>_<n>_<kind>.fastq.gz for which every kind is there."""
    found = files.select(F.regexp_extract("name", r"^([^_]+_[0-9]+)_(R[123]|I1)\.fastq\.gz$", 1).alias("prefix"), F.regexp_extract("name", r"^([^_]+_[0-9]+)_(R[123]|I1)\.fastq\.gz$", 2).alias("kind")).where("prefix <> ''")
    return found.where(F.col("kind").isin(kinds)).groupBy("prefix").agg(F.countDistinct("kind").alias("n")).where(F.col("n") == len(kinds)).select("prefix")


def renamed(name):
    """Fields 1, 3 and 5 of a file name between underscores."""
    p = F.split(name, "_")
    return F.concat_ws("_", F.get(p, 0), F.get(p, 2), F.get(p, 4))


def indexed(df: DataFrame, order: str, index: str) -> DataFrame:
    """A dense index from 0 in the given order."""
    return ranked(df, order, index)
