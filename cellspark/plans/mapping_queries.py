"""Mapping of reads: the reference is a sequence a nation, reads are cut from it by supplier, some of them mirrored, changed or spliced."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import mapping
from .views import read, spark_sql

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: Reference and reads, once for both dialects: 192 bases a nation, six reads of 48 bases a supplier.
_BASES = "translate(md5(CAST(n_nationkey AS VARCHAR) || '-{}'), '0123456789abcdef', 'ACGTTGCAGATCCTAG')"
REFERENCE = f"SELECT 'n' || CAST(n_nationkey AS VARCHAR) AS contig, n_nationkey AS key, {' || '.join(_BASES.format(i) for i in range(6))} AS seq FROM nation"
READS = """SELECT CAST(s_suppkey AS VARCHAR) || '-' || CAST(i AS VARCHAR) AS read_id, CASE WHEN i % 2 = 1 THEN reverse(translate(s, 'ACGT', 'TGCA')) ELSE s END AS seq FROM (
  SELECT s_suppkey, i, CASE WHEN i < 2 THEN substring(seq, a, 48) WHEN i < 4 THEN substring(seq, a, 20 + s_suppkey % 9) || substring(seq, a + 20 + s_suppkey % 9 + 40 + s_suppkey % 13, 28 - s_suppkey % 9)
    ELSE substring(seq, a, 11) || 'A' || substring(seq, a + 12, 36) END AS s
  FROM (SELECT s_suppkey, i, seq, CAST(s_suppkey * 7 + i * 11 AS INT) % 90 + 1 AS a FROM (SELECT s_suppkey, s_nationkey, {explode} AS i FROM supplier) JOIN reference ON key = s_nationkey))"""

#: Every place, strand and intron that the terms allow, by the Hamming distance.
MAPPED_SQL = f"""WITH reference AS ({REFERENCE}), reads AS ({READS.format(explode="unnest(range(6))")}),
strands AS (SELECT read_id, '+' AS strand, seq AS s FROM reads UNION ALL SELECT read_id, '-', reverse(translate(seq, 'ACGT', 'TGCA')) FROM reads),
places AS (SELECT contig, seq AS ref, unnest(range(length(seq) - 47)) AS p FROM reference),
whole AS (SELECT read_id, contig, strand, p AS pos, '48M' AS cigar, hamming(substr(ref, p + 1, 48), s) AS wrong, 0 AS introns FROM strands, places WHERE hamming(substr(ref, p + 1, 48), s) <= 1),
cuts AS (SELECT unnest(range(17, 32)) AS c),
heads AS (SELECT read_id, contig, strand, ref, p, c, hamming(substr(ref, p + 1, c), substr(s, 1, c)) AS wrong FROM (SELECT * FROM strands, places WHERE hamming(substr(ref, p + 1, 17), substr(s, 1, 17)) <= 1), cuts),
tails AS (SELECT read_id, contig, strand, p AS d, c, hamming(substr(ref, p + c + 1, 48 - c), substr(s, c + 1)) AS wrong FROM (SELECT * FROM strands, places WHERE hamming(substr(ref, p + 32, 17), substr(s, 32)) <= 1), cuts),
joined AS (SELECT h.read_id, h.contig, h.strand, p, d, h.c, h.wrong + t.wrong AS wrong, substr(ref, p + h.c + 1, 2) || substr(ref, d + h.c - 1, 2) AS ends
  FROM heads h JOIN tails t ON h.read_id = t.read_id AND h.contig = t.contig AND h.strand = t.strand AND h.c = t.c AND d - p BETWEEN 21 AND 120 WHERE h.wrong + t.wrong <= 1),
spliced AS (SELECT read_id, contig, strand, p AS pos, CAST(c AS VARCHAR) || 'M' || CAST(d - p AS VARCHAR) || 'N' || CAST(48 - c AS VARCHAR) || 'M' AS cigar, wrong, 1 AS introns
  FROM joined QUALIFY row_number() OVER (PARTITION BY read_id, contig, strand, p, d ORDER BY wrong, ends NOT IN ('GTAG', 'CTAC'), c) = 1),
every AS (SELECT *, wrong + 2 * introns AS cost FROM (SELECT * FROM whole UNION ALL SELECT * FROM spliced)),
best AS (SELECT * FROM every QUALIFY cost = min(cost) OVER (PARTITION BY read_id))
SELECT read_id, contig, strand, pos::BIGINT AS pos, cigar, wrong::INT AS mismatches, cost::INT AS cost, n_best::INT AS n_best FROM (
  SELECT *, count(*) OVER (PARTITION BY read_id) AS n_best, row_number() OVER (PARTITION BY read_id ORDER BY contig, strand, pos, cigar) AS place FROM best) WHERE place = 1"""


def mapped_reads(spark: SparkSession, sf: str) -> DataFrame:
    """Reads placed over an index of minimizers, equal to the search of all places."""
    reference = spark.sql(spark_sql(REFERENCE).replace("FROM nation", "FROM {nation}"), nation=read(spark, sf, "nation"))
    reads = spark.sql(spark_sql(READS.format(explode="explode(sequence(0, 5))")).replace("FROM supplier", "FROM {supplier}").replace("JOIN reference", "JOIN {reference}"), supplier=read(spark, sf, "supplier"), reference=reference)
    pieces = reference.select("contig", F.explode(F.sequence(F.lit(0), F.lit(191), F.lit(50))).alias("start"), "seq").select("contig", "start", F.expr("substring(seq, start + 1, 50)").alias("seq"))
    index = mapping.build(pieces, k=7, w=2, longest_read=48, tile=100, most=20)
    return mapping.map_reads(reads, index, max_mismatch=1 / 48, block=17, min_intron=21, max_intron=120).select("read_id", "contig", "strand", "pos", "cigar", "mismatches", "cost", "n_best")


QUERIES["mapped_reads"], ORACLES["mapped_reads"] = mapped_reads, MAPPED_SQL
