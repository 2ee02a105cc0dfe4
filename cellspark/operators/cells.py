"""The final tables of an experiment: cells with their counts, rates, wells and samples, and the matrix over them.

Counts are long tables: pcr_batch, ligation_barcodes, rt_barcodes, a feature and count; cells have the same keys and
unmatched_rate; primers is the RT table with rt, shortdt, is_randomn and sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .counts import cell_totals, merge_primer_counts, merge_primers

UNIT = ["pcr_batch", "ligation_barcodes"]
CELL = [*UNIT, "rt_barcodes"]


def cell_name(*parts: str) -> Column:
    return F.concat_ws(".", *parts)


def merged_counts(counts: DataFrame, primers: DataFrame, feature: str = "gene_id") -> DataFrame:
    """cell_id (<pcr>.<ligation>.<short-dT>), feature, count: the counts of both primers of a well added up, without zeros."""
    one = merge_primer_counts(counts.withColumnRenamed("rt_barcodes", "rt"), primers, UNIT, feature)
    return one.where(F.col("count") > 0).select(cell_name(*UNIT, "shortdt").alias("cell_id"), feature, "count")


def cell_annotation(counts: DataFrame, cells: DataFrame, primers: DataFrame, feature: str = "gene_id", number: str = "gene_count") -> DataFrame:
    """One row a cell of the merged matrix, with the ten columns of the final table.

    A cell without counts goes; one whose RT barcode is unknown goes.  The rate of two primers is weighted by their reads,
    umi_count / (1 - rate), and features are counted anew on the merged counts: a feature seen through both counts once.
    """
    totals = cell_totals(counts, CELL, number).drop(number)
    known = totals.join(cells.select(*CELL, "unmatched_rate"), CELL).withColumnRenamed("rt_barcodes", "rt")
    merged = merge_primers(known, primers, UNIT)
    again = merged_counts(counts, primers, feature).groupBy("cell_id").agg(F.count("*").alias(number))
    named = merged.withColumn("cell_id", cell_name(*UNIT, "shortdt")).join(again, "cell_id")
    return named.select(
        "cell_id", "unmatched_rate", "umi_count", number, *UNIT, F.col("shortdt_umi_count").cast("double").alias("shortdt_umi_count"), F.col("randomn_umi_count").cast("double").alias("randomn_umi_count"),
        F.col("shortdt").alias("rt_barcodes_shortdt"), "sample",
    )


def with_samples(cells: DataFrame, samples: DataFrame, on: str) -> DataFrame:
    """Cells with the columns of a metadata table, where it has them."""
    return cells.join(samples, on, "left")
