"""Readers and writers of line files: SAM, GTF, RT tables, prefix lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .lines import numbered_lines

SAM = "name string, flag int, chrom string, pos long, mapq int, cigar string, tags map<string,string>"
FRAGMENTS = "prefix string, read_no long, name string, r1_seq string, r1_qual string, i5_seq string, i5_qual string, r2_seq string, r2_qual string"


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """SAM text: positions become 0-based; optional fields a map of tag to value."""
    cols = F.split("value", "\t")
    tags = F.map_from_entries(F.transform(F.slice(cols, 12, 10_000), lambda t: F.struct(F.split_part(t, F.lit(":"), F.lit(1)), F.regexp_replace(t, r"^[^:]*:[^:]*:", ""))))
    lines = spark.read.text(path).where(~F.startswith(F.col("value"), F.lit("@")))
    return lines.select(cols[0].alias("name"), cols[1].cast("int").alias("flag"), cols[2].alias("chrom"), (cols[3].cast("long") - 1).alias("pos"), cols[4].cast("int").alias("mapq"), cols[5].alias("cigar"), tags.alias("tags"))


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """GTF: 0-based half-open start and end, attrs as a map and the usual ones as columns, line as file order over all parts."""
    raw = numbered_lines(spark, path).where(~F.startswith(F.col("value"), F.lit("#")) & (F.length("value") > 0))
    c = F.split("value", "\t")
    pairs = F.transform(F.regexp_extract_all(c[8], F.lit(r'(\w+) "?[^";]*"?;?'), 0), lambda x: F.struct(F.regexp_extract(x, r"^(\w+)", 1), F.regexp_extract(x, r'^\w+ "?([^";]*)"?;?', 1)))
    attrs = F.map_from_entries(F.filter(pairs, lambda p: ~p.getField("col1").isin("tag", "ont")))
    out = raw.select("line", c[0].alias("chrom"), c[1].alias("source"), c[2].alias("feature"), (c[3].cast("long") - 1).alias("start"), c[4].cast("long").alias("end"), c[6].alias("strand"), attrs.alias("attrs"))
    get = lambda *k: F.coalesce(*[F.try_element_at("attrs", F.lit(x)) for x in k])
    return out.select("*", get("gene_id").alias("gene_id"), get("transcript_id").alias("transcript_id"), get("exon_id").alias("exon_id"), get("gene_type", "gene_biotype").alias("gene_type"), get("gene_name").alias("gene_name"))


def read_fasta(spark: SparkSession, path: str, bin_lines: int = 4096) -> DataFrame:
    """contig (a head's first word), start (from 0), seq: the sequence lines of FASTA files, as mapping.build takes them.

    As in files that can be indexed, all lines of a contig but its last have one length, so a line's place follows from its
    number; other files raise.  Lines meet their contig by bins of lines, and no file goes through one task; what does is a row a contig.
    """
    lines = numbered_lines(spark, path, blank=False)
    is_head = F.startswith(F.col("value"), F.lit(">"))
    ends = lines.groupBy("file").agg((F.max("line") + 1).alias("end"))
    behind = F.lead("line").over(Window.partitionBy("file").orderBy("line"))
    heads = lines.where(is_head).select("file", F.col("line").alias("head"), F.regexp_extract("value", r"^>\s*(\S*)", 1).alias("contig"), behind.alias("next")).join(ends, "file").withColumn("next", F.coalesce("next", "end"))
    first = lines.where(~is_head).select((F.col("line") - 1).alias("head"), F.length("value").cast("long").alias("width"))
    known = heads.join(first, "head").select("head", "contig", "next", "width", F.explode(F.sequence(F.floor(F.col("head") / bin_lines), F.floor((F.col("next") - 1) / bin_lines))).alias("bin"))
    rows = lines.where(~is_head).select("line", "value", F.floor(F.col("line") / bin_lines).alias("bin"))
    met = rows.join(known, (rows["bin"] == known["bin"]) & (rows["line"] > known["head"]) & (rows["line"] < known["next"]))
    size = F.length("value")
    good = (size == F.col("width")) | ((F.col("line") == F.col("next") - 1) & (size < F.col("width")))
    seq = F.when(good, F.col("value")).otherwise(F.raise_error(F.concat(F.lit("lines of unequal length in "), F.col("contig"))).cast("string"))
    return met.select("contig", ((F.col("line") - F.col("head") - 1) * F.col("width")).alias("start"), seq.alias("seq"))


def read_rt_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema="sample string, shortdt string, randomn string", mode="FAILFAST")


def read_prefixes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(F.length(F.trim("value")) > 0).select(F.col("value").alias("prefix"))


def write_sam(alignments: DataFrame, path: str, references: list[tuple[str, int]] = (), gzip: bool = False) -> None:
    """Alignments (0-based pos, tags a map, other columns as in BAM files where there are any) as SAM text; parts make one file."""
    have = set(alignments.columns)
    col = lambda c, other: F.coalesce(F.col(c).cast("string"), F.lit(other)) if c in have else F.lit(other)
    place = lambda c: F.coalesce((F.col(c) + 1).cast("string"), F.lit("0")) if c in have else F.lit("0")
    fields = [col("name", "*"), col("flag", "0"), col("chrom", "*"), place("pos"), col("mapq", "0"), col("cigar", "*"), col("mate_chrom", "*"), place("mate_pos"), col("length", "0"), col("seq", "*"), col("qual", "*")]
    tags = F.transform(F.array_sort(F.map_entries("tags")), lambda t: F.concat(t["key"], F.lit(":Z:"), t["value"])) if "tags" in have else F.array().cast("array<string>")
    line = F.array_join(F.concat(F.array(*fields), F.coalesce(tags, F.array().cast("array<string>"))), "\t")
    head = ["@HD\tVN:1.6", *[f"@SQ\tSN:{c}\tLN:{n}" for c, n in references]]
    first = alignments.sparkSession.createDataFrame([("\n".join(head),)], "line string").coalesce(1)
    first.unionByName(alignments.select(line.alias("line"))).write.text(path, compression="gzip" if gzip else "none")
