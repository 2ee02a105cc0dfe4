"""Sequencing-like views over the star-schema test tables, and their SQL text.

The SQL is written once, in the dialect of the checks; `//` is integer division there and `div` in Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXON = """SELECT 'chr' || CAST((p_partkey // 5) % 3 + 1 AS VARCHAR) AS chrom, CASE WHEN (p_partkey // 5) % 2 = 0 THEN '+' ELSE '-' END AS strand,
  CAST((p_partkey // 15) * 100 + (p_partkey % 5) * 60 + p_size % 7 AS BIGINT) AS s, CAST((p_partkey // 15) * 100 + (p_partkey % 5) * 60 + p_size % 7 + 20 + p_size AS BIGINT) AS e,
  'g' || CAST(p_partkey // 5 AS VARCHAR) AS gene_id, 'e' || CAST(p_partkey AS VARCHAR) AS exon_id, CAST(p_partkey AS BIGINT) AS line FROM part"""
GENE = "SELECT chrom, strand, gene_id, min(s) AS s, max(e) AS e, min(line) AS line FROM exon GROUP BY chrom, strand, gene_id"
PAIR = """SELECT pid, cell, umi, chrom, CASE WHEN sense = '+' THEN '-' ELSE '+' END AS strand1, sense AS strand2, is_randomn, cut,
  s1, s1 + 15 AS e1, s1 + q AS s2, s1 + q + CASE WHEN cut THEN 55 ELSE 15 END AS e2
FROM (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || l_returnflag || l_linestatus AS pid,
  CAST(l_suppkey AS BIGINT) AS cell, CAST(l_partkey % 16 AS BIGINT) AS umi, 'chr' || CAST(l_orderkey % 3 + 1 AS VARCHAR) AS chrom, CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS sense,
  l_suppkey % 2 = 1 AS is_randomn, l_returnflag = 'R' AS cut, CAST((l_partkey * 37 + l_linenumber * 101) % (SELECT max(e) FROM exon) AS BIGINT) AS s1, CAST(l_quantity AS BIGINT) AS q FROM lineitem) t"""


def spark_sql(text: str) -> str:
    return text.replace("//", "div").replace("VARCHAR", "STRING")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exon_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = spark.sql(spark_sql(EXON).replace("FROM part", "FROM {part}"), part=read(spark, sf_dir, "part"))
    return out.withColumnsRenamed({"s": "start", "e": "end"})


def gene_view(exons: DataFrame) -> DataFrame:
    return exons.groupBy("chrom", "strand", "gene_id").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("line").alias("line"))


def ends_view(exons: DataFrame) -> DataFrame:
    """Every exon's directional end stands for a transcript's."""
    from ..operators.annotation import transcript_ends

    return transcript_ends(exons)


def pair_view(spark: SparkSession, sf_dir: str, spliced: bool = False, repeated: bool = False) -> DataFrame:
    """Pairs in the shape that the assignment operators take.  repeated: a pair may come several times, which saves the exchange
    that makes them distinct."""
    exons = exon_view(spark, sf_dir).withColumnsRenamed({"start": "s", "end": "e"})
    text = spark_sql(PAIR).replace("SELECT DISTINCT", "SELECT") if repeated else spark_sql(PAIR)
    p = spark.sql(text.replace("FROM exon", "FROM {exon}").replace("FROM lineitem", "FROM {lineitem}"), exon=exons, lineitem=read(spark, sf_dir, "lineitem"))
    block = lambda a, b, part=0: F.struct(F.col(a).alias("start") if isinstance(a, str) else a.alias("start"), F.col(b).alias("end") if isinstance(b, str) else b.alias("end"), F.lit(part).alias("part"))
    s2 = F.col("s2")
    whole = F.array(block(s2, s2 + 15))
    two = F.when(F.col("cut"), F.array(block(s2, s2 + 8), block(s2 + 48, s2 + 55, 1))).otherwise(whole) if spliced else whole
    return p.select("pid", "cell", "umi", "chrom", "strand1", "strand2", "is_randomn", F.col("s1").alias("start1"), F.col("e1").alias("end1"), s2.alias("start2"), (F.col("e2") if spliced else s2 + 15).alias("end2"), F.array(block("s1", "e1")).alias("blocks1"), two.alias("blocks2"))


def codes(key: str) -> str:
    """A 15-mer of five base-4 digits, each tripled (SQL)."""
    letters = "substr('ACGT', CAST({0} % 4 AS INT) + 1, 1)"
    return " || ".join(f"repeat({letters.format(f'({key} // {4**i})')}, 3)" for i in range(5))
