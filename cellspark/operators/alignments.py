"""Mates, filters and duplicate removal on alignments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cigar import cigar_blocks, natural_key, passes_sam_filter, reference_end


def sam_filter(alignments: DataFrame, **limits) -> DataFrame:
    return alignments.where(passes_sam_filter(F.col("flag"), F.col("mapq"), **limits))


def pair_mates(alignments: DataFrame, by: list[str]) -> DataFrame:
    """One row a read name that has exactly one first (flag 64) and one second mate (flag 128): by, mate1, mate2 structs."""
    rest = [c for c in alignments.columns if c not in by]
    is1, is2 = F.col("flag").bitwiseAND(64) == 64, F.col("flag").bitwiseAND(128) == 128
    row = F.struct(*rest)
    out = alignments.groupBy(*by).agg(F.count_if(is1).alias("__n1"), F.count_if(is2).alias("__n2"), F.first(F.when(is1, row), ignorenulls=True).alias("mate1"), F.first(F.when(is2, row), ignorenulls=True).alias("mate2"))
    return out.where("__n1 = 1 AND __n2 = 1").drop("__n1", "__n2")


def dedup(pairs: DataFrame, key: list[str], name: str) -> DataFrame:
    """The first pair in natural name order of each key (cell, UMI and both mates' places).

    The minimum is an aggregation with map-side combine, so a hot molecule costs one row a task.
    """
    rest = [c for c in pairs.columns if c not in key]
    first = F.min_by(F.struct(*rest), F.struct(natural_key(F.col(name)), F.col(name)))
    return pairs.groupBy(*key).agg(first.alias("__r")).select(*key, *[F.col("__r").getField(c).alias(c) for c in rest])


def sort_by_place(alignments: DataFrame, chroms: list[str]) -> DataFrame:
    """In order of chromosome (as listed, others by name behind them), position and name, in ranges; unmapped ones last."""
    place = F.array_position(F.array(*[F.lit(c) for c in chroms]), F.col("chrom"))
    return alignments.sort(F.col("chrom").isNull(), F.when(place > 0, place).otherwise(F.lit(len(chroms) + 1)), "chrom", "pos", "name")


def with_blocks(alignments: DataFrame) -> DataFrame:
    """Adds blocks (M runs) and end from pos and cigar."""
    return alignments.withColumn("blocks", cigar_blocks(F.col("cigar"), F.col("pos"))).withColumn("end", reference_end(F.col("cigar"), F.col("pos")))


def alignment_counts(alignments: DataFrame) -> DataFrame:
    """prefix, reads_mapped (primary mapped first mates), alignments (mapped first mates), alignments_qc_filtered."""
    first = F.col("flag").bitwiseAND(64) == 64
    return alignments.groupBy("prefix").agg(F.count_if(first & (F.col("flag").bitwiseAND(260) == 0)).alias("reads_mapped"), F.count_if(first & (F.col("flag").bitwiseAND(4) == 0)).alias("alignments"), F.count_if(passes_sam_filter(F.col("flag"), F.col("mapq"))).alias("alignments_qc_filtered"))


def cell_tags(alignments: DataFrame, primers: DataFrame) -> DataFrame:
    """CB (<i7>.<ligation>.<short-dT>) and UB; rows with an unknown RT barcode go."""
    side = primers.select("rt", "shortdt").distinct()
    known = alignments.join(F.broadcast(side) if side.limit(100_001).count() <= 100_000 else side, "rt")
    return known.withColumn("CB", F.concat_ws(".", "i7", "ligation", "shortdt")).withColumn("UB", F.col("umi"))
