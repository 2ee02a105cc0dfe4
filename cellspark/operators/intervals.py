"""Interval joins, unions and coverage without a nested loop.

Both sides are cut into bins; the join is an equality on (group, bin), and a pair is kept only in the bin that holds the
larger start, so it arises once and no distinct is needed.  Choose the width near the longer side's usual length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bins(df: DataFrame, start: str, end: str, width: int, name: str = "bin") -> DataFrame:
    return df.withColumn(name, F.explode(F.sequence(F.floor(F.col(start) / width), F.floor((F.greatest(F.col(end), F.col(start) + 1) - 1) / width))))


def _by_bin(l: DataFrame, r: DataFrame, on: list[str], meets, how: str) -> DataFrame:
    """An equality join on the group and the bin, with the exact test as part of its condition, so that no row stands for a
    candidate that fails it; on="left" gives a row of nulls where none meets."""
    keys = [*on, "bin"]
    r = r.withColumnsRenamed({c: f"__r_{c}" for c in keys})
    test = meets
    for c in keys:
        test = test & (F.col(c) == F.col(f"__r_{c}"))
    return l.join(r, test, how).drop("bin", *[f"__r_{c}" for c in keys])


def overlap_join(left: DataFrame, right: DataFrame, on: list[str], width: int = 1 << 14, prefix: str = "f_", how: str = "inner") -> DataFrame:
    """left(on, start, end, ...) x right(on, start, end, ...) where they overlap; right's start and end get the prefix.

    Adds `overlap`, the shared length.  Empty intervals match nothing.  how="left" keeps a row of left in each of its bins
    that has no match, with nulls on the right.
    """
    r = right.withColumnRenamed("start", f"{prefix}start").withColumnRenamed("end", f"{prefix}end")
    l, r = bins(left, "start", "end", width), bins(r, f"{prefix}start", f"{prefix}end", width)
    first = F.greatest("start", f"{prefix}start")
    last = F.least("end", f"{prefix}end")
    both = _by_bin(l, r, on, (first < last) & (F.col("bin") == F.floor(first / width)), how)
    return both.withColumn("overlap", F.when(F.col(f"{prefix}start").isNotNull(), last - first))


def containment_join(left: DataFrame, right: DataFrame, on: list[str], width: int = 1 << 14, prefix: str = "f_", how: str = "inner") -> DataFrame:
    """Pairs where right contains left: only left's first bin is looked up.  how="left" keeps left's rows without a match."""
    r = bins(right.withColumnRenamed("start", f"{prefix}start").withColumnRenamed("end", f"{prefix}end"), f"{prefix}start", f"{prefix}end", width)
    l = left.withColumn("bin", F.floor(F.col("start") / width))
    return _by_bin(l, r, on, (F.col(f"{prefix}start") <= F.col("start")) & (F.col(f"{prefix}end") >= F.col("end")), how)


def merge(df: DataFrame, by: list[str]) -> DataFrame:
    """Unions of overlapping or touching intervals of each group: gaps and islands."""
    w = Window.partitionBy(*by).orderBy("start", "end")
    seen = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("__seen").isNull() | (F.col("start") > F.col("__seen")), 1).otherwise(0)
    islands = df.withColumn("__seen", seen).withColumn("__island", F.sum(begins).over(w))
    return islands.groupBy(*by, "__island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("__island")
