"""Per-cell counts, quality and merging of primers, as long tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .intervals import containment_join
from .steps import steps


PART = 500_000


def dealt(df: DataFrame, *by: str, rows: int = PART, of: int | None = None) -> DataFrame:
    """df in parts of about `rows` rows by key, however large it is.  Sums whose keys hold `by` need no further exchange, and a
    task that makes them holds a part's keys: Spark joins small parts into larger ones by their bytes, but not these.  of: the
    number of rows, where it is known."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(parts, (df.count() if of is None else of) // rows + 1), *by)


def feature_counts(assigned: DataFrame, by: list[str], weight: str | None = None) -> DataFrame:
    """Summed weight (or number of rows) a cell and feature; partial sums are made before the shuffle."""
    return assigned.groupBy(*by).agg((F.sum(weight) if weight else F.count("*")).alias("count"))


def unmatched_rate(assigned: DataFrame, by: list[str], weight: str | None = None) -> DataFrame:
    """no_feature / (no_feature + counted + ambiguous) a cell; ambiguous holds every other status."""
    w = F.col(weight) if weight else F.lit(1.0)
    return assigned.groupBy(*by).agg(F.try_divide(F.sum(F.when(F.col("status") == "no_feature", w).otherwise(0.0)), F.sum(w)).alias("unmatched_rate"))


def add_regions(counts: DataFrame, by: list[str]) -> DataFrame:
    """Exon and intron rows of a gene added up."""
    return counts.groupBy(*by).agg(F.sum("count").alias("count"))


def cell_totals(counts: DataFrame, by: list[str], feature_name: str = "gene_count") -> DataFrame:
    """umi_count and the number of features above zero; cells without counts go."""
    return counts.groupBy(*by).agg(F.sum("count").alias("umi_count"), F.count_if(F.col("count") > 0).alias(feature_name)).where("umi_count > 0")


def detected_cells(counts: DataFrame, least: int, cell: str = "cell", feature: str = "gene_id") -> DataFrame:
    return counts.where("count > 0").groupBy(cell).agg(F.countDistinct(feature).alias("n_features")).where(F.col("n_features") >= least)


def ordinals(df: DataFrame, cell: str, within: str) -> DataFrame:
    """cell_index from 0 in each prefix."""
    return df.select(within, cell).distinct().withColumn("cell_index", (F.dense_rank().over(Window.partitionBy(within).orderBy(cell)) - 1).cast("long"))


def merge_primers(cells: DataFrame, primers: DataFrame, unit: list[str]) -> DataFrame:
    """Cells of the two primers of a well as one.

    cells: unit columns, rt, umi_count, unmatched_rate; primers: rt, shortdt, is_randomn, sample.  A logical cell is
    (unit, shortdt).  Its rate is weighted by reads, umi_count / (1 - rate); a single primer keeps its own.  The sample is the
    short-dT primer's.  Unknown RT barcodes go.
    """
    side = F.broadcast(primers) if primers.limit(100_001).count() <= 100_000 else primers
    known = cells.join(side, "rt")
    return known.groupBy(*unit, "shortdt").agg(
        F.sum("umi_count").alias("umi_count"),
        F.when(F.count("*") == 1, F.first("unmatched_rate")).otherwise(F.try_divide(F.sum(F.try_divide(F.col("unmatched_rate") * F.col("umi_count"), 1 - F.col("unmatched_rate"))), F.sum(F.try_divide(F.col("umi_count"), 1 - F.col("unmatched_rate"))))).alias("unmatched_rate"),
        F.sum(F.when(F.col("is_randomn"), F.col("umi_count")).otherwise(0)).alias("randomn_umi_count"),
        F.sum(F.when(~F.col("is_randomn"), F.col("umi_count")).otherwise(0)).alias("shortdt_umi_count"),
        F.count("*").alias("n_primers"),
        F.coalesce(F.min(F.when(~F.col("is_randomn"), F.col("sample"))), F.min("sample")).alias("sample"),
    )


def merge_primer_counts(counts: DataFrame, primers: DataFrame, unit: list[str], feature: str) -> DataFrame:
    """Triplets of logical cells: unit, shortdt, feature, count."""
    side = primers.select("rt", "shortdt")
    side = F.broadcast(side) if side.limit(100_001).count() <= 100_000 else side
    return counts.join(side, "rt").groupBy(*unit, "shortdt", feature).agg(F.sum("count").alias("count"))


def union_matrices(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def percent_of(counts: DataFrame, pattern: str, cell: str = "cell", name: str = "gene_name") -> DataFrame:
    """percent: 100 * counts of features whose name matches / all counts, a cell."""
    hit = F.sum(F.when(F.regexp_like(F.col(name), F.lit(pattern)), F.col("count")).otherwise(0))
    return counts.groupBy(cell).agg(F.try_divide(100.0 * hit, F.sum("count")).alias("percent"))


def species_of(genes: DataFrame, order: str = "line") -> DataFrame:
    """species: human or mouse by the first gene id of the dictionary, else null."""
    first = genes.agg(F.min_by("gene_id", order).alias("g"))
    return first.select(F.when(F.col("g").rlike("^ENSG"), "human").when(F.col("g").rlike("^ENSMUSG"), "mouse").alias("species"))


def common_cells(a: DataFrame, b: DataFrame, cell: str = "cell") -> tuple[DataFrame, DataFrame]:
    """Both tables restricted to the cells that the other has too."""
    return a.join(b.select(cell).distinct(), cell, "left_semi"), b.join(a.select(cell).distinct(), cell, "left_semi")


def layer_counts(assigned: DataFrame, cell: str = "cell", umi: str = "umi", spanning: bool = False) -> DataFrame:
    """cell, gene_id, layer, count: molecules by splicing state.

    A molecule (cell, UMI, gene) is spliced where all its pairs count for exons, unspliced where all reach into an
    intron, else ambiguous; pairs without a single gene are left out.  spanning: a pair that an exon finds but does not
    hold as a whole (`whole`) reaches into the intron too.
    """
    intron = F.col("region") == "intron"
    if spanning:
        intron |= ~F.col("whole")
    one = assigned.where("status = 'counted'").groupBy(cell, umi, "gene_id").agg(F.bool_and(intron).alias("all"), F.bool_or(intron).alias("any"))
    layer = F.when(F.col("all"), "unspliced").when(F.col("any"), "ambiguous").otherwise("spliced")
    return one.groupBy(cell, "gene_id", layer.alias("layer")).agg(F.count("*").alias("count"))


def mask_repeats(assigned: DataFrame, pairs: DataFrame | None, repeats: DataFrame, ids: list[str], width: int = 1 << 14) -> DataFrame:
    """assigned without those intronic pairs of which a mate lies in a repeat (chrom, start, end) as a whole.

    pairs: ids, chrom, start1, end1, start2, end2, or None where assigned has these columns: then mates are looked up where
    the pairs are, with no join, as long as the repeats may be sent to every task (see steps).
    """
    if pairs is None:
        mate = lambda i: F.struct(F.col(f"start{i}").alias("start"), F.col(f"end{i}").alias("end"), F.lit(0).alias("tag"))
        if found := steps(repeats.select("chrom", "start", "end", F.lit(1).alias("one")), "chrom", ["one"], width=width):
            marked = found.meet(assigned, F.col("chrom"), F.when(F.col("region") == "intron", F.array(mate(1), mate(2))), "__masked", whole=True)
            return marked.where(F.size("__masked") == 0).drop("__masked")
        pairs = assigned
    mates = pairs.select(*ids, "chrom", F.explode(F.array(F.struct(F.col("start1").alias("start"), F.col("end1").alias("end")), F.struct(F.col("start2").alias("start"), F.col("end2").alias("end")))).alias("m"))
    inside = containment_join(mates.select(*ids, "chrom", "m.start", "m.end"), repeats.select("chrom", "start", "end"), ["chrom"], width).select(*ids).distinct()
    marked = assigned.join(inside.withColumn("__masked", F.lit(True)), ids, "left")
    return marked.where(F.col("__masked").isNull() | ~F.coalesce(F.col("region") == "intron", F.lit(False))).drop("__masked")


def combine_layers(*parts: DataFrame) -> DataFrame:
    """Layer tables of several prefixes as one; cells named <prefix>:<cell> keep the part behind the colon."""
    out = union_matrices(*parts)
    name = F.col("cell").cast("string")
    return out.withColumn("cell", F.when(F.contains(name, F.lit(":")), F.split_part(name, F.lit(":"), F.lit(2))).otherwise(name))
