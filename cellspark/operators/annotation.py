"""Annotation tables from GTF features: chrom, feature, start, end (0-based, half open), strand, attributes, line."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cigar import directional_end
from .intervals import merge
from .ranks import ranked


def distinct_exons(exons: DataFrame) -> DataFrame:
    """First of each (gene_id, exon_id), then of those the first of each (gene_id, start, end), in file order (line).

    An exon that the second test drops never blocks a later one, as the first test compares ids only.
    """
    by_id = Window.partitionBy("gene_id", "exon_id").orderBy("line")
    once = exons.withColumn("__n", F.row_number().over(by_id)).where("__n = 1")
    by_place = Window.partitionBy("gene_id", "start", "end").orderBy("line")
    return once.withColumn("__n", F.row_number().over(by_place)).where("__n = 1").drop("__n")


def gene_parts(exons: DataFrame) -> DataFrame:
    """Merged exon intervals a gene."""
    return merge(exons.select("chrom", "strand", "gene_id", "start", "end"), ["chrom", "strand", "gene_id"])


def transcript_ends(transcripts: DataFrame) -> DataFrame:
    """gene_id, end_d: the distinct directional ends."""
    return transcripts.select("gene_id", directional_end(F.col("start"), F.col("end"), F.col("strand")).alias("end_d")).distinct()


def gene_dictionary(genes: DataFrame) -> DataFrame:
    """Two rows a gene: exon at index 2k, intron at 2k + 1, k in file order."""
    return ranked(genes, "line", "__k").select(F.explode(F.array(F.struct((2 * F.col("__k")).alias("gene_index"), F.lit("exon").alias("feature")), F.struct((2 * F.col("__k") + 1).alias("gene_index"), F.lit("intron").alias("feature")))).alias("__f"), "gene_id", "gene_type", "gene_name").select("__f.gene_index", "gene_id", "gene_type", "gene_name", "__f.feature")


def exon_dictionary(exons: DataFrame) -> DataFrame:
    kept = ranked(distinct_exons(exons), "line", "exon_index")
    return kept.select("exon_index", F.concat_ws("-", "gene_id", "exon_id").alias("gene_exon_id"), "gene_type", "gene_name", "chrom", "strand", (F.col("start") + 1).alias("start"), "end", (F.col("end") - F.col("start")).alias("length"))


def require_columns(gtf: DataFrame) -> DataFrame:
    """gene_type falls back to gene_biotype where a file has only that."""
    if "gene_biotype" in gtf.columns:
        return gtf.withColumn("gene_type", F.coalesce("gene_type", "gene_biotype")) if "gene_type" in gtf.columns else gtf.withColumnRenamed("gene_biotype", "gene_type")
    return gtf
