"""One query an operator, over the views, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import cigar, names, sequences
from ..operators import alignments, annotation, assign_exon, assign_gene, barcodes, cells, counts, intervals, reads, splicing, stats, steps
from . import views
from .views import EXON, GENE, PAIR, codes, exon_view, gene_view, pair_view, read, spark_sql

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
#: Bins as long as the views' exons are.
WIDTH = 64
PID = ["pid"]


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


V = f"WITH exon AS ({EXON}), gene AS ({GENE}), pair AS ({PAIR})"
VE = f"WITH exon AS ({EXON})"

# --- sequences and barcodes -----------------------------------------------------------------------------------------

SEQ = codes("s_suppkey")
SEQ_SPARK = SEQ.replace("//", "div")


def rc_sql(x: str) -> str:
    return f"reverse(translate({x}, 'ATCGN', 'TAGCN'))"


@query(f"SELECT s_suppkey, {SEQ} AS seq, {rc_sql(SEQ)} AS rc FROM supplier")
def revcomp(spark: SparkSession, sf: str) -> DataFrame:
    s = read(spark, sf, "supplier").select("s_suppkey", F.expr(SEQ_SPARK).alias("seq"))
    return s.withColumn("rc", sequences.reverse_complement(F.col("seq")))


WL = f"""b AS (SELECT DISTINCT {SEQ} AS barcode FROM supplier),
wl AS (SELECT barcode AS variant, barcode FROM b UNION ALL
  SELECT substr(barcode, 1, i - 1) || c || substr(barcode, i + 1), barcode FROM b, (SELECT unnest(range(1, 16)) AS i), (VALUES ('A'), ('T'), ('C'), ('G'), ('N')) t(c) WHERE substr(barcode, CAST(i AS INT), 1) <> c)"""


def _whitelist(spark: SparkSession, sf: str) -> DataFrame:
    return barcodes.whitelist(read(spark, sf, "supplier").select(F.expr(SEQ_SPARK).alias("barcode")))


@query(f"WITH {WL} SELECT variant, barcode FROM wl")
def whitelist_expand(spark: SparkSession, sf: str) -> DataFrame:
    return _whitelist(spark, sf)


@query(f"WITH {WL} SELECT count(DISTINCT barcode) AS n_barcodes, count(*) AS n_variants, count(DISTINCT variant) AS n_distinct, count(DISTINCT variant)::DOUBLE / count(DISTINCT barcode) AS ratio, count(*) = count(DISTINCT variant) AS is_clean FROM wl")
def whitelist_clean(spark: SparkSession, sf: str) -> DataFrame:
    return barcodes.whitelist_check(_whitelist(spark, sf))


READ = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag = 'R' THEN substr(seq, 1, l_linenumber - 1) || 'N' || substr(seq, l_linenumber + 1) WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'NN' || substr(seq, 3) ELSE seq END AS raw FROM lineitem JOIN (SELECT s_suppkey, {seq} AS seq FROM supplier) s ON l_suppkey = s_suppkey"


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    text = READ.replace("{seq}", SEQ_SPARK).replace("FROM lineitem", "FROM {lineitem}").replace("FROM supplier", "FROM {supplier}")
    return spark.sql(text, lineitem=read(spark, sf, "lineitem"), supplier=read(spark, sf, "supplier"))


@query(f"WITH {WL}, r AS ({READ.replace('{seq}', SEQ)}) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, raw, barcode FROM r JOIN wl ON raw = variant")
def barcode_correct(spark: SparkSession, sf: str) -> DataFrame:
    return barcodes.correct(_raw(spark, sf), _whitelist(spark, sf), "raw", "barcode").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "raw", "barcode")


@query(f"""WITH {WL}, r AS ({READ.replace('{seq}', SEQ)}), k AS (SELECT l_suppkey AS prefix, barcode IS NOT NULL AS known, l_linenumber > 2 AS lengthy FROM r LEFT JOIN wl ON raw = variant)
SELECT prefix, 'reads_total' AS metric, count(*) AS value FROM k GROUP BY 1 UNION ALL SELECT prefix, 'reads_barcode_passed', count(*) FILTER (known) FROM k GROUP BY 1 UNION ALL SELECT prefix, 'reads_length_passed', count(*) FILTER (known AND lengthy) FROM k GROUP BY 1""")
def barcode_stats(spark: SparkSession, sf: str) -> DataFrame:
    known = barcodes.correct(_raw(spark, sf), _whitelist(spark, sf), "raw", "barcode", "left")
    return reads.read_counts(known.select(F.col("l_suppkey").alias("prefix"), F.col("barcode").alias("ligation"), F.col("barcode").alias("rt"), (F.col("l_linenumber") > 2).alias("long_enough")))


R2 = f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, rt, is_randomn, 'ACGTACGT' || rt || repeat('T', 15) || repeat('GATC', 1 + l_linenumber) AS r1,
  CASE WHEN l_linenumber % 3 = 0 THEN repeat('CA', 12) || {{rc}} || 'GG' WHEN l_linenumber % 3 = 1 THEN repeat('CA', 12) || substr({{rc}}, 1, CAST(l_quantity AS INT) % 11) ELSE repeat('CAG', CAST(l_quantity AS INT) % 9) END AS r2
FROM (SELECT *, substr({{seq}}, 1, 10) AS rt, l_suppkey % 2 = 1 AS is_randomn FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) t"""


@query(
    f"""WITH q AS ({R2.replace('{seq}', SEQ).replace('{rc}', rc_sql('rt'))}),
c AS (SELECT *, instr(r2, {rc_sql('rt')}) AS site, coalesce((SELECT max(i) FROM (SELECT unnest(range(5, 10)) AS i) WHERE suffix(r2, substr({rc_sql('rt')}, 1, CAST(i AS INT)))), 0) AS tail FROM q),
t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, is_randomn, CASE WHEN is_randomn THEN substr(r1, 19) ELSE substr(r1, 34) END AS r1, CASE WHEN site > 0 THEN substr(r2, site) ELSE substr(r2, 1, length(r2) - tail) END AS r2 FROM c)
SELECT *, length(r1) >= 20 AND length(r2) >= 20 AS long_enough FROM t"""
)
def read_trim(spark: SparkSession, sf: str) -> DataFrame:
    text = R2.replace("{seq}", SEQ_SPARK).replace("{rc}", rc_sql("rt")).replace("FROM lineitem", "FROM {lineitem}").replace("JOIN supplier", "JOIN {supplier}")
    q = spark.sql(text, lineitem=read(spark, sf, "lineitem"), supplier=read(spark, sf, "supplier"))
    out = q.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "is_randomn", sequences.trim_mate1(F.col("r1"), F.col("is_randomn")).alias("r1"), sequences.trim_after_primer(F.col("r2"), F.col("rt")).alias("r2"))
    return out.withColumn("long_enough", reads.long_enough(F.col("r1"), F.col("r2")))


FRAGMENT = """SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS name, substr(code, 1, 9) AS ligation, substr(code, 4, 9) AS rt, (l_suppkey // 4) % 2 = 1 AS is_randomn, l_returnflag AS flag, l_linenumber AS line FROM (SELECT *, {seq} AS code FROM supplier) s JOIN lineitem ON l_suppkey = s_suppkey"""
MATES = "'ACGT' || CASE WHEN line % 2 = 0 THEN 'GGGG' ELSE 'TTTT' END || CASE WHEN flag = 'R' THEN substr(rt, 1, 4) || 'N' || substr(rt, 6) ELSE rt END || repeat('T', 15) || repeat('GATC', line) AS r1, repeat('CA', 12) || CASE WHEN line % 3 = 0 THEN substr({rc}, 1, 7) ELSE 'GG' END AS r2, CASE WHEN flag = 'A' AND line % 2 = 0 THEN 'NN' || substr(ligation, 3) ELSE ligation END AS i5"


def _fragments(spark: SparkSession, sf: str) -> DataFrame:
    inner = spark_sql(FRAGMENT).replace("{seq}", SEQ_SPARK).replace("FROM supplier", "FROM {supplier}").replace("JOIN lineitem", "JOIN {lineitem}")
    return spark.sql(f"SELECT *, {MATES.replace('{rc}', rc_sql('rt'))} FROM ({inner}) f", supplier=read(spark, sf, "supplier"), lineitem=read(spark, sf, "lineitem"))


@query(
    f"""WITH f AS (SELECT *, {MATES.replace('{rc}', rc_sql('rt'))} FROM ({FRAGMENT.replace('{seq}', SEQ)}) f),
t AS (SELECT name, ligation, rt, substr(r1, 1, 8) AS umi, CASE WHEN is_randomn THEN substr(r1, 18) ELSE substr(r1, 33) END AS r1_seq, CASE WHEN line % 3 = 0 THEN substr(r2, 1, 24) ELSE r2 END AS r2_seq FROM f WHERE NOT (flag = 'A' AND line % 2 = 0))
SELECT *, length(r1_seq) >= 20 AND length(r2_seq) >= 20 AS long_enough FROM t"""
)
def attach_barcodes(spark: SparkSession, sf: str) -> DataFrame:
    """Barcodes at fixed places, corrected by whitelists, and both mates trimmed."""
    f = _fragments(spark, sf)
    wl = lambda c: barcodes.whitelist(f.select(F.col(c).alias("barcode")))
    shaped = f.select("name", F.col("i5").alias("i5_seq"), F.col("r1").alias("r1_seq"), F.regexp_replace("r1", ".", "I").alias("r1_qual"), F.col("r2").alias("r2_seq"), F.regexp_replace("r2", ".", "I").alias("r2_qual"))
    out = reads.tag(shaped, wl("ligation"), wl("rt"), f.select("rt", "is_randomn"), reads.Layout(ligation=9, rt=9))
    return out.select("name", "ligation", "rt", "umi", "r1_seq", "r2_seq", "long_enough")


@query("SELECT s_nationkey AS prefix, s_suppkey AS read_no, s_name AS name, 'R1' || s_name AS r1_seq, CASE WHEN s_suppkey % 3 <> 0 THEN 'I5' || s_name END AS i5_seq, CASE WHEN s_suppkey % 5 <> 0 THEN 'R2' || s_name END AS r2_seq FROM supplier")
def zip_mates(spark: SparkSession, sf: str) -> DataFrame:
    s = read(spark, sf, "supplier").select(F.col("s_nationkey").alias("prefix"), F.col("s_suppkey").alias("read_no"), F.col("s_name").alias("name"))
    one = lambda kind, where="true": s.where(where).withColumn("seq", F.concat(F.lit(kind), "name")).withColumn("qual", F.lit("I"))
    return reads.zip_mates(one("R1"), one("I5", "read_no % 3 <> 0"), one("R2", "read_no % 5 <> 0")).select("prefix", "read_no", "name", "r1_seq", "i5_seq", "r2_seq")


ADAPTED = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, repeat('CAG', CAST(l_quantity AS INT) % 9) || repeat('A', l_linenumber + 2) || repeat('CG', l_partkey % 3) AS r2 FROM lineitem"


@query(f"WITH a AS ({ADAPTED}) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, regexp_replace(r2, '(AAAAAAAA.*|A{{3,7}})$', '') AS r2 FROM a")
def adapter_trim(spark: SparkSession, sf: str) -> DataFrame:
    return reads.trim_adapter(spark.sql(ADAPTED.replace("FROM lineitem", "FROM {lineitem}"), lineitem=read(spark, sf, "lineitem")), "r2", "AAAAAAAA")


GAPPED = """SELECT c_custkey, translate(substring(md5(c_name), 1, 20 + CAST(c_custkey % 7 AS INT)), '0123456789abcdef', 'ACGTTGCAGATCCTAG') ||
  CASE CAST(c_custkey % 6 AS INT) WHEN 0 THEN 'AGATCGGAAGAGCTT' WHEN 1 THEN 'AGATCGAAGAGCACG' WHEN 2 THEN 'AGATCGTGAAGAGC' WHEN 3 THEN substring('AGATCGGAAGAGC', 1, CAST(c_custkey % 13 AS INT)) WHEN 4 THEN 'AGATCCGAAGA' ELSE '' END AS seq FROM customer"""


@query(f"""WITH r AS ({GAPPED}), n AS (SELECT *, length(seq) AS n FROM r),
whole AS (SELECT c_custkey, e, min(levenshtein(substr(seq, e - len + 1, len), 'AGATCGGAAGAGC') * 1000 + e - len) AS best FROM (SELECT *, unnest(range(1, n + 1)) AS e FROM n), (SELECT unnest([12, 13, 14]) AS len) WHERE len <= e GROUP BY ALL),
ending AS (SELECT c_custkey, j, min(levenshtein(substr(seq, s + 1), substr('AGATCGGAAGAGC', 1, j)) * 1000 + s) AS best FROM n, (SELECT unnest(range(3, 13)) AS j), (SELECT unnest([-1, 0, 1]) AS d), LATERAL (SELECT n - j + d AS s) WHERE s BETWEEN 0 AND n - 1 GROUP BY ALL),
hit AS (SELECT c_custkey, best % 1000 AS place FROM whole WHERE best < 2000 UNION ALL SELECT c_custkey, best % 1000 FROM ending WHERE best < CASE WHEN j < 10 THEN 1000 ELSE 2000 END)
SELECT n.c_custkey, substr(seq, 1, coalesce(min(place), n)::BIGINT) AS seq FROM n LEFT JOIN hit USING (c_custkey) GROUP BY n.c_custkey, seq, n""")
def adapter_trim_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Adapters with a changed, lost or added base, whole or cut short by the read's end."""
    return reads.trim_adapter(spark.sql(GAPPED.replace("FROM customer", "FROM {customer}"), customer=read(spark, sf, "customer")), "seq", "AGATCGGAAGAGC", gaps=True)


WELL = "SELECT s_suppkey // 2 AS well, 'S_' || CAST(s_suppkey % 2 AS VARCHAR) || '_' || CAST((s_suppkey // 2) % 2 AS VARCHAR) || '_' || replace(s_name, '#', '_') AS sample, {seq} AS barcode, s_suppkey % 2 AS kind FROM supplier"


@query(
    f"""WITH w AS ({WELL.replace('{seq}', SEQ)}), j AS (SELECT a.well, a.sample AS s, b.barcode AS shortdt, a.barcode AS randomn FROM w a JOIN w b ON a.well = b.well WHERE a.kind = 1 AND b.kind = 0)
SELECT well, array_to_string(list_slice(string_split(s, '_'), 4, 1000), '_') AS sample, shortdt, randomn, string_split(s, '_')[2] = '1' AS human, string_split(s, '_')[3] = '1' AS mouse FROM j WHERE string_split(s, '_')[2] = '1'"""
)
def sample_decode(spark: SparkSession, sf: str) -> DataFrame:
    w = spark.sql(spark_sql(WELL).replace("{seq}", SEQ_SPARK).replace("FROM supplier", "FROM {supplier}"), supplier=read(spark, sf, "supplier"))
    return barcodes.rt_table(w.where("kind = 1"), w.where("kind = 0"), species="human")


@query(
    """SELECT '@' || CAST(l_orderkey % 8 AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) || ',' || CAST(l_linenumber AS VARCHAR) || ',r' || CAST(l_orderkey AS VARCHAR) AS name, CAST(l_orderkey % 8 AS VARCHAR) AS ligation, CAST(l_suppkey AS VARCHAR) AS rt,
  CAST(l_linenumber AS VARCHAR) AS umi, l_returnflag || '.' || CAST(l_orderkey % 8 AS VARCHAR) || '.' || CAST(l_suppkey - l_suppkey % 2 AS VARCHAR) AS "CB", CAST(l_linenumber AS VARCHAR) AS "UB" FROM lineitem WHERE l_suppkey % 7 <> 0"""
)
def cell_tag(spark: SparkSession, sf: str) -> DataFrame:
    """Names are written, taken apart, and give the tags; RT barcodes that the table lacks go."""
    s = lambda c: F.col(c).cast("string")
    l = read(spark, sf, "lineitem").select(F.col("l_returnflag").alias("i7"), names.read_name((F.col("l_orderkey") % 8).cast("string"), s("l_suppkey"), s("l_linenumber"), F.concat(F.lit("r"), s("l_orderkey"))).alias("name"))
    p = names.parse_read_name(F.substring(F.col("name"), F.lit(2), F.length("name")))
    known = read(spark, sf, "supplier").where("s_suppkey % 7 <> 0").select(s("s_suppkey").alias("rt"), (F.col("s_suppkey") - F.col("s_suppkey") % 2).cast("string").alias("shortdt"))
    return alignments.cell_tags(l.select("name", "i7", *[v.alias(k) for k, v in p.items()]), known).select("name", "ligation", "rt", "umi", "CB", "UB")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag AS pcr_batch, CAST(l_suppkey AS VARCHAR) AS ligation_barcodes, CAST(l_partkey AS VARCHAR) || '.x' AS rt_barcodes FROM lineitem")
def cell_split(spark: SparkSession, sf: str) -> DataFrame:
    l = read(spark, sf, "lineitem")
    cell = F.concat_ws(".", "l_returnflag", "l_suppkey", "l_partkey", F.lit("x"))
    return l.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[v.alias(k) for k, v in names.cell_parts(cell).items()])


# --- alignments -----------------------------------------------------------------------------------------------------

CIG = "CAST(CAST(l_quantity AS INT) AS VARCHAR) || 'M' || CASE WHEN l_returnflag = 'R' THEN CAST(l_linenumber AS VARCHAR) || 'N' || CAST(l_suppkey % 20 + 1 AS VARCHAR) || 'M' WHEN l_returnflag = 'A' THEN '2D3I' || CAST(l_linenumber AS VARCHAR) || 'M5S' ELSE '' END"


@query(
    f"""WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_partkey AS pos, {CIG} AS cigar FROM lineitem),
o AS (SELECT *, regexp_extract_all(cigar, '(\\d+)[MIDNSHP=X]', 1) AS ns, regexp_extract_all(cigar, '\\d+([MIDNSHP=X])', 1) AS ops FROM d),
x AS (SELECT *, unnest(range(1, len(ops) + 1)) AS i FROM o),
y AS (SELECT *, CAST(ns[i] AS BIGINT) AS n, ops[i] AS op FROM x),
z AS (SELECT *, pos + coalesce(list_sum(list_transform(list_filter(range(1, i), lambda k: ops[k] IN ('M', 'D', 'N', '=', 'X')), lambda k: CAST(ns[k] AS BIGINT))), 0) AS st, len(list_filter(range(1, i), lambda k: ops[k] = 'N')) AS part FROM y)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, cigar, CAST(part AS INT) AS part, CAST(st AS BIGINT) AS block_start, CAST(st + n AS BIGINT) AS block_end FROM z WHERE op = 'M'"""
)
def cigar_blocks(spark: SparkSession, sf: str) -> DataFrame:
    l = read(spark, sf, "lineitem").withColumn("cigar", F.expr(spark_sql(CIG)))
    x = l.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cigar", F.explode(cigar.cigar_blocks(F.col("cigar"), F.col("l_partkey"))).alias("b"))
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cigar", "b.part", F.col("b.start").alias("block_start"), F.col("b.end").alias("block_end"))


ALN = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(1 + 2 * (l_linenumber % 2) + CASE WHEN l_quantity > 48 THEN 4 ELSE 0 END + CASE WHEN l_linestatus = 'O' THEN 16 ELSE 0 END + CASE WHEN l_linenumber % 4 < 2 THEN 64 ELSE 128 END + CASE WHEN l_tax > 0.07 THEN 256 ELSE 0 END AS INT) AS flag, CAST(l_quantity AS INT) AS mapq FROM lineitem"


def _aln(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(ALN.replace("FROM lineitem", "FROM {lineitem}"), lineitem=read(spark, sf, "lineitem"))


@query(f"WITH a AS ({ALN}) SELECT * FROM a WHERE mapq >= 30 AND flag & 2 = 2 AND flag & 780 = 0")
def sam_filter(spark: SparkSession, sf: str) -> DataFrame:
    return alignments.sam_filter(_aln(spark, sf))


@query(f"WITH a AS ({ALN}) SELECT l_suppkey AS prefix, count(*) FILTER (flag & 64 = 64 AND flag & 260 = 0) AS reads_mapped, count(*) FILTER (flag & 64 = 64 AND flag & 4 = 0) AS alignments, count(*) FILTER (mapq >= 30 AND flag & 2 = 2 AND flag & 780 = 0) AS alignments_qc_filtered FROM a GROUP BY l_suppkey")
def alignment_stats(spark: SparkSession, sf: str) -> DataFrame:
    return alignments.alignment_counts(_aln(spark, sf).withColumnRenamed("l_suppkey", "prefix"))


@query(f"WITH a AS ({ALN}) SELECT l_orderkey, min(l_partkey) FILTER (flag & 64 = 64) AS part1, min(l_partkey) FILTER (flag & 128 = 128) AS part2 FROM a GROUP BY l_orderkey HAVING count(*) FILTER (flag & 64 = 64) = 1 AND count(*) FILTER (flag & 128 = 128) = 1")
def pair_mates(spark: SparkSession, sf: str) -> DataFrame:
    return alignments.pair_mates(_aln(spark, sf), ["l_orderkey"]).select("l_orderkey", F.col("mate1.l_partkey").alias("part1"), F.col("mate2.l_partkey").alias("part2"))


NATURAL = "array_to_string(list_transform(regexp_extract_all(pid, '(\\d+|\\D+)', 1), lambda x: CASE WHEN regexp_matches(x, '^\\d') THEN lpad(x, 20, '0') ELSE x END), '')"


@query(f"{V}, r AS (SELECT *, s1 // 200 AS place, row_number() OVER (PARTITION BY cell, umi, chrom, s1 // 200 ORDER BY {NATURAL}) AS n FROM pair) SELECT cell, umi, chrom, place, pid FROM r WHERE n = 1")
def umi_dedup(spark: SparkSession, sf: str) -> DataFrame:
    p = pair_view(spark, sf).withColumn("place", F.floor(F.col("start1") / 200)).select("cell", "umi", "chrom", "place", "pid")
    return alignments.dedup(p, ["cell", "umi", "chrom", "place"], "pid").select("cell", "umi", "chrom", "place", "pid")


@query(f"WITH a AS ({ALN}) SELECT l_suppkey AS prefix, metric, value FROM (SELECT l_suppkey, count(*) FILTER (flag & 64 = 64 AND flag & 260 = 0) AS reads_mapped, count(*) FILTER (flag & 64 = 64 AND flag & 4 = 0) AS alignments, count(*) FILTER (mapq >= 30 AND flag & 2 = 2 AND flag & 780 = 0) AS alignments_qc_filtered, count(*) FILTER (mapq > 40) AS alignments_dedup, count(*) FILTER (mapq > 20) AS reads_trimmed FROM a GROUP BY 1) UNPIVOT (value FOR metric IN (reads_mapped, alignments, alignments_qc_filtered, alignments_dedup, reads_trimmed))")
def run_counts(spark: SparkSession, sf: str) -> DataFrame:
    a = _aln(spark, sf).withColumnRenamed("l_suppkey", "prefix")
    return stats.run_counts(trimmed=a.where("mapq > 20"), alignments=a, deduped=a.where("mapq > 40"))


@query(
    """WITH n AS (SELECT l_suppkey, 'r' || CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) || ':' || CAST(l_partkey AS VARCHAR) AS name, l_orderkey, l_linenumber, l_partkey FROM lineitem),
m AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS k FROM n) SELECT l_suppkey, name FROM m WHERE k = 1"""
)
def natural_dedup(spark: SparkSession, sf: str) -> DataFrame:
    l = read(spark, sf, "lineitem").select("l_suppkey", F.concat(F.lit("r"), F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey")).alias("name"))
    return alignments.dedup(l, ["l_suppkey"], "name")


# --- annotation and intervals ---------------------------------------------------------------------------------------

DUP = "SELECT gene_id, 'x' || CAST(line % 4 AS VARCHAR) AS exon_id, s - s % 60 AS s, e - e % 60 AS e, line FROM exon"


@query(f"{VE}, d AS ({DUP}), a AS (SELECT *, row_number() OVER (PARTITION BY gene_id, exon_id ORDER BY line) AS n FROM d), b AS (SELECT *, row_number() OVER (PARTITION BY gene_id, s, e ORDER BY line) AS m FROM a WHERE n = 1) SELECT gene_id, exon_id, s, e, line FROM b WHERE m = 1")
def exon_dedup(spark: SparkSession, sf: str) -> DataFrame:
    x = exon_view(spark, sf)
    x = x.select("gene_id", F.concat(F.lit("x"), (F.col("line") % 4).cast("string")).alias("exon_id"), (F.col("start") - F.col("start") % 60).alias("start"), (F.col("end") - F.col("end") % 60).alias("end"), "line")
    return annotation.distinct_exons(x).withColumnsRenamed({"start": "s", "end": "e"})


MERGED = "mp AS (SELECT chrom, strand, gene_id, s, e, max(e) OVER (PARTITION BY chrom, strand, gene_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM exon), mi AS (SELECT *, sum(CASE WHEN seen IS NULL OR s > seen THEN 1 ELSE 0 END) OVER (PARTITION BY chrom, strand, gene_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS isl FROM mp), merged AS (SELECT chrom, strand, gene_id, min(s) AS s, max(e) AS e FROM mi GROUP BY chrom, strand, gene_id, isl)"


@query(f"{VE}, {MERGED} SELECT * FROM merged")
def interval_merge(spark: SparkSession, sf: str) -> DataFrame:
    return annotation.gene_parts(exon_view(spark, sf)).withColumnsRenamed({"start": "s", "end": "e"})


@query(f"{VE} SELECT DISTINCT gene_id, CASE WHEN strand = '+' THEN e ELSE s - 1 END AS end_d FROM exon")
def transcript_ends(spark: SparkSession, sf: str) -> DataFrame:
    return annotation.transcript_ends(exon_view(spark, sf))


@query(f"{VE}, gene AS ({GENE}), k AS (SELECT *, row_number() OVER (ORDER BY line) - 1 AS k FROM gene) SELECT CAST(2 * k + i AS BIGINT) AS gene_index, gene_id, CASE WHEN i = 0 THEN 'exon' ELSE 'intron' END AS feature FROM k, (VALUES (0), (1)) t(i)")
def feature_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    g = gene_view(exon_view(spark, sf)).withColumn("gene_type", F.lit("t")).withColumn("gene_name", F.col("gene_id"))
    return annotation.gene_dictionary(g).select(F.col("gene_index").cast("long").alias("gene_index"), "gene_id", "feature")


@query(f"{VE} SELECT CAST(row_number() OVER (ORDER BY line) - 1 AS BIGINT) AS exon_index, gene_id || '-' || exon_id AS gene_exon_id, s + 1 AS start1, e AS end1, e - s AS length FROM exon QUALIFY row_number() OVER (PARTITION BY gene_id, s, e ORDER BY line) = 1")
def exon_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    x = exon_view(spark, sf).withColumn("gene_type", F.lit("t")).withColumn("gene_name", F.col("gene_id"))
    return annotation.exon_dictionary(x).select(F.col("exon_index").cast("long").alias("exon_index"), "gene_exon_id", F.col("start").alias("start1"), F.col("end").alias("end1"), "length")


def _mate2(spark: SparkSession, sf: str) -> DataFrame:
    return pair_view(spark, sf).select("pid", "chrom", F.col("strand2").alias("strand"), F.col("start2").alias("start"), F.col("end2").alias("end"))


@query(f"{V} SELECT pid, gene_id, exon_id, least(e, s2 + 15) - greatest(s, s2) AS overlap FROM pair JOIN exon ON pair.chrom = exon.chrom AND strand2 = strand AND s < s2 + 15 AND s2 < e")
def exon_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.overlap_join(_mate2(spark, sf), exon_view(spark, sf).drop("line"), ["chrom", "strand"], WIDTH).select("pid", "gene_id", "exon_id", "overlap")


@query(f"{V} SELECT pid, gene_id, least(gene.e, s2 + 15) - greatest(gene.s, s2) AS overlap FROM pair JOIN gene ON pair.chrom = gene.chrom AND strand2 = strand AND gene.s < s2 + 15 AND s2 < gene.e")
def gene_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.overlap_join(_mate2(spark, sf), gene_view(exon_view(spark, sf)).drop("line"), ["chrom", "strand"], WIDTH).select("pid", "gene_id", "overlap")


@query(f"{V} SELECT pid, gene_id, exon_id FROM pair JOIN exon ON pair.chrom = exon.chrom AND strand2 = strand AND s <= s2 AND e >= s2 + 15")
def exon_containment(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.containment_join(_mate2(spark, sf), exon_view(spark, sf).drop("line"), ["chrom", "strand"], WIDTH).select("pid", "gene_id", "exon_id")


@query(
    f"""{VE}, cuts AS (SELECT chrom, s AS cut FROM exon UNION SELECT chrom, e FROM exon UNION SELECT chrom, k * {WIDTH} FROM (SELECT chrom, s, e, unnest(range(s // {WIDTH} + 1, (e - 1) // {WIDTH} + 1)) AS k FROM exon) t),
seg AS (SELECT chrom, cut, lead(cut) OVER (PARTITION BY chrom ORDER BY cut) AS stop FROM cuts)
SELECT seg.chrom, cut AS start, stop AS "end", string_agg(DISTINCT exon_id, ',' ORDER BY exon_id) AS exons FROM seg JOIN exon ON seg.chrom = exon.chrom AND s <= cut AND stop <= e GROUP BY ALL"""
)
def exon_steps(spark: SparkSession, sf: str) -> DataFrame:
    """The step function of sets of exons."""
    return steps.step_function(exon_view(spark, sf), "chrom", WIDTH, "exon_id").select("chrom", "start", "end", F.concat_ws(",", "ids").alias("exons"))


# --- genes of pairs -------------------------------------------------------------------------------------------------

ASSIGN = f"""{V}, {MERGED},
feat AS (SELECT chrom, strand, gene_id, s, e, 'exon' AS lv FROM merged UNION ALL SELECT chrom, strand, gene_id, s, e, 'gene' FROM gene),
sh AS (SELECT *, CASE WHEN strand2 = '+' THEN CASE WHEN s2 <= 1000 THEN -s2 ELSE -1000 END ELSE 1000 END AS d2 FROM pair),
sh2 AS (SELECT *, CASE WHEN d2 < 0 AND s1 <= -d2 THEN -s1 ELSE d2 END AS d1 FROM sh),
blk AS (SELECT pid, chrom, strand2 AS st, 'plain' AS kind, s1 AS bs, s1 + 15 AS be FROM pair UNION ALL SELECT pid, chrom, strand2, 'plain', s2, s2 + 15 FROM pair
  UNION ALL SELECT pid, chrom, strand2, 'flank', s1 + d1, s1 + 15 + d1 FROM sh2 UNION ALL SELECT pid, chrom, strand2, 'flank', s2 + d2, s2 + 15 + d2 FROM sh2),
ov AS (SELECT pid, CASE WHEN kind = 'plain' AND st = strand AND lv = 'exon' THEN 1 WHEN kind = 'plain' AND st = strand THEN 2 WHEN kind = 'flank' AND st = strand AND lv = 'gene' THEN 3 WHEN kind = 'plain' AND lv = 'exon' THEN 4 WHEN kind = 'plain' THEN 5 END AS stage, gene_id, sum(least(e, be) - greatest(s, bs)) AS cov
  FROM blk JOIN feat ON blk.chrom = feat.chrom AND bs < e AND s < be GROUP BY 1, 2, 3),
dec AS (SELECT pid, min(stage) AS stage FROM ov WHERE stage IS NOT NULL GROUP BY pid),
cand AS (SELECT ov.pid, ov.stage, gene_id, cov = 30 AS whole FROM ov JOIN dec ON ov.pid = dec.pid AND ov.stage = dec.stage),
anyw AS (SELECT pid, bool_or(whole) AS w FROM cand GROUP BY pid),
pick AS (SELECT cand.*, anyw.w, count(*) OVER (PARTITION BY cand.pid) AS n FROM cand JOIN anyw ON cand.pid = anyw.pid WHERE whole OR NOT w),
ends AS (SELECT DISTINCT gene_id, CASE WHEN strand = '+' THEN e ELSE s - 1 END AS end_d FROM exon),
far AS (SELECT pick.pid, pick.gene_id, min(abs(end_d - CASE WHEN (stage <= 3) = (strand1 = '-') THEN s1 + 15 ELSE s1 - 1 END)) AS d FROM pick JOIN pair ON pick.pid = pair.pid JOIN ends ON pick.gene_id = ends.gene_id WHERE n > 1 AND NOT is_randomn GROUP BY 1, 2),
near AS (SELECT pid, min(d) AS low, arg_min(gene_id, d) AS g FROM far GROUP BY pid),
sole AS (SELECT near.pid, g FROM near JOIN far ON near.pid = far.pid AND far.d < low + 100 GROUP BY near.pid, g HAVING count(*) = 1),
res AS (SELECT pair.pid, cell, d.stage, coalesce(p1.gene_id, sole.g) AS gene_id, CASE WHEN d.stage IS NULL THEN NULL WHEN d.stage = 1 OR d.stage = 4 AND anyw.w THEN 'exon' ELSE 'intron' END AS region,
  CASE WHEN d.stage IS NULL THEN 'no_feature' WHEN coalesce(p1.gene_id, sole.g) IS NULL THEN 'ambiguous' ELSE 'counted' END AS status
  FROM pair LEFT JOIN dec d ON pair.pid = d.pid LEFT JOIN anyw ON pair.pid = anyw.pid LEFT JOIN (SELECT pid, gene_id FROM pick WHERE n = 1) p1 ON pair.pid = p1.pid LEFT JOIN sole ON pair.pid = sole.pid)"""


def assigned_genes(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    x = exon_view(spark, sf)
    p = pair_view(spark, sf)
    return assign_gene.assign(p, PID, x, gene_view(x), views.ends_view(x), WIDTH, keep=("cell", "umi", *keep))


@query(f"{ASSIGN} SELECT pid, stage, gene_id, region, status FROM res")
def gene_assign(spark: SparkSession, sf: str) -> DataFrame:
    return assigned_genes(spark, sf).select("pid", "stage", "gene_id", "region", "status")


@query(f"{ASSIGN} SELECT sole.pid, g AS gene_id FROM sole")
def nearest_end(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs with several candidate genes that a nearest transcript end settles."""
    return assigned_genes(spark, sf).where("status = 'counted' AND n_candidates > 1").select("pid", "gene_id")


@query(f"{ASSIGN}, c AS (SELECT cell, gene_id, region, count(*) AS count FROM res WHERE status = 'counted' GROUP BY 1, 2, 3) SELECT cell, gene_id, sum(count)::BIGINT AS count FROM c GROUP BY 1, 2")
def cell_gene_counts(spark: SparkSession, sf: str) -> DataFrame:
    c = counts.feature_counts(assigned_genes(spark, sf).where("status = 'counted'"), ["cell", "gene_id", "region"])
    return counts.add_regions(c, ["cell", "gene_id"])


@query(f"{ASSIGN} SELECT cell, round(sum(CASE WHEN status = 'no_feature' THEN 1 ELSE 0 END)::DOUBLE / count(*), 6) AS unmatched_rate FROM res GROUP BY cell")
def cell_unmatched_rate(spark: SparkSession, sf: str) -> DataFrame:
    return counts.unmatched_rate(assigned_genes(spark, sf), ["cell"]).withColumn("unmatched_rate", F.round("unmatched_rate", 6))


LAYERS = f"""{ASSIGN}, mol AS (SELECT res.cell, umi, gene_id, bool_and(region = 'intron') AS al, bool_or(region = 'intron') AS an FROM res JOIN pair ON res.pid = pair.pid WHERE status = 'counted' GROUP BY 1, 2, 3)
SELECT cell, gene_id, CASE WHEN al THEN 'unspliced' WHEN an THEN 'ambiguous' ELSE 'spliced' END AS layer, count(*) AS count FROM mol GROUP BY 1, 2, 3"""


@query(LAYERS)
def velocity_layers(spark: SparkSession, sf: str) -> DataFrame:
    return counts.layer_counts(assigned_genes(spark, sf))


#: Two transcripts a gene: all its exons, and those of odd lines.
MODELS = """tx AS (SELECT gene_id, gene_id || '-' || CAST(k AS VARCHAR) AS transcript_id, chrom, s, e FROM exon, (SELECT unnest([1, 2]) AS k) WHERE k = 1 OR line % 2 = 1),
txa AS (SELECT *, max(e) OVER (PARTITION BY transcript_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM tx),
txb AS (SELECT *, sum(CASE WHEN seen IS NULL OR s > seen THEN 1 ELSE 0 END) OVER (PARTITION BY transcript_id ORDER BY s, e) AS island FROM txa),
txe AS (SELECT gene_id, transcript_id, chrom, min(s) AS s, max(e) AS e FROM txb GROUP BY gene_id, transcript_id, chrom, island),
parts AS (SELECT *, false AS intron FROM txe UNION ALL SELECT gene_id, transcript_id, chrom, e, nxt, true FROM (SELECT *, lead(s) OVER (PARTITION BY transcript_id ORDER BY s) AS nxt FROM txe) WHERE nxt IS NOT NULL),
counted AS (SELECT pair.pid, pair.cell, umi, pair.chrom, gene_id, s1, s2 FROM res JOIN pair ON res.pid = pair.pid WHERE status = 'counted'),
blocks AS (SELECT pid, cell, umi, chrom, gene_id, 0 AS block, s1 AS bs, s1 + 15 AS be FROM counted UNION ALL SELECT pid, cell, umi, chrom, gene_id, 1, s2, s2 + 15 FROM counted),
shown AS (SELECT b.*, transcript_id, s, e, intron, least(be, e) - greatest(bs, s) AS shared, least(be, e) - greatest(bs, s) >= 5 AS shows FROM blocks b JOIN parts p ON b.gene_id = p.gene_id AND b.chrom = p.chrom AND bs < e AND s < be),
edges AS (SELECT pid, block, transcript_id, bool_or(NOT intron) AS ex FROM shown WHERE shows GROUP BY ALL),
valid AS (SELECT DISTINCT gene_id, s, e FROM shown JOIN edges USING (pid, block, transcript_id) WHERE ex AND intron AND shows),
perblock AS (SELECT pid, cell, umi, shown.gene_id, transcript_id, block, sum(shared) AS shared, bool_or(NOT intron AND shows) AS ex, bool_or(intron AND shows) AS it, bool_or(intron AND shows AND valid.s IS NOT NULL) AS ok
  FROM shown LEFT JOIN valid ON shown.gene_id = valid.gene_id AND shown.s = valid.s AND shown.e = valid.e GROUP BY ALL),
perpair AS (SELECT pid, cell, umi, gene_id, transcript_id, bool_or(it) AS it, bool_or(ok OR (ex AND it)) AS ok FROM perblock GROUP BY ALL HAVING sum(shared) = 30),
permodel AS (SELECT cell, umi, gene_id, transcript_id, count(*) AS fit, bool_or(it) AS it, bool_or(ok) AS ok FROM perpair GROUP BY ALL),
sizes AS (SELECT cell, umi, gene_id, count(*) AS n FROM counted GROUP BY ALL),
states AS (SELECT cell, umi, gene_id, bool_and(it) AS al, bool_or(it) AS an, bool_or(it AND ok) AS ok FROM permodel JOIN sizes USING (cell, umi, gene_id) WHERE fit = n GROUP BY ALL)"""


@query(f"{ASSIGN}, {MODELS} SELECT cell, gene_id, CASE WHEN NOT an THEN 'spliced' WHEN al THEN 'unspliced' ELSE 'ambiguous' END AS layer, count(*) AS count FROM states WHERE NOT (al AND an AND NOT ok) GROUP BY ALL")
def transcript_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Splicing by transcript models; unspliced molecules need proof."""
    x = exon_view(spark, sf)
    two = x.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("k")).where("k = 1 OR line % 2 = 1").withColumn("transcript_id", F.concat_ws("-", "gene_id", F.col("k").cast("string")))
    p = pair_view(spark, sf, repeated=True).where("pid IS NOT NULL").drop("pid")
    return splicing.layers(p, x, gene_view(x), views.ends_view(x), two, WIDTH, permissive=False)


@query(f"{ASSIGN} SELECT res.pid, CASE WHEN chrom IN ('chr1', 'chr2') THEN status ELSE 'unmapped' END AS status FROM res JOIN pair ON res.pid = pair.pid")
def gene_assign_known(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs on chromosomes that the annotation does not name count as unmapped."""
    x = exon_view(spark, sf)
    known = spark.createDataFrame([("chr1",), ("chr2",)], "chrom string")
    return assign_gene.assign(pair_view(spark, sf), PID, x, gene_view(x), views.ends_view(x), WIDTH, chroms=known).select("pid", "status")


REPEAT = "SELECT chrom, s - s % 40 AS s, s - s % 40 + 40 AS e FROM exon WHERE line % 3 = 0"


@query(f"""{ASSIGN}, rep AS ({REPEAT}), inside AS (SELECT DISTINCT pair.pid FROM pair JOIN rep ON pair.chrom = rep.chrom AND (s1 >= rep.s AND s1 + 15 <= rep.e OR s2 >= rep.s AND s2 + 15 <= rep.e)),
mol AS (SELECT res.cell, umi, res.gene_id, bool_and(region = 'intron' OR NOT w) AS al, bool_or(region = 'intron' OR NOT w) AS an FROM res JOIN pair ON res.pid = pair.pid JOIN anyw ON res.pid = anyw.pid WHERE status = 'counted' AND NOT (region = 'intron' AND res.pid IN (SELECT pid FROM inside)) GROUP BY 1, 2, 3)
SELECT split_part('x:' || CAST(cell AS VARCHAR), ':', 2) AS cell, gene_id, CASE WHEN al THEN 'unspliced' WHEN an THEN 'ambiguous' ELSE 'spliced' END AS layer, count(*) AS count FROM mol GROUP BY 1, 2, 3""")
def masked_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Layers without intronic pairs in repeats; pairs that leave an exon count for the intron; cells lose their prefix."""
    x = exon_view(spark, sf)
    repeats = x.where("line % 3 = 0").select("chrom", (F.col("start") - F.col("start") % 40).alias("start"), (F.col("start") - F.col("start") % 40 + 40).alias("end"))
    a = counts.mask_repeats(assigned_genes(spark, sf, "chrom", "start1", "end1", "start2", "end2"), None, repeats, PID, WIDTH)
    one = counts.layer_counts(a.withColumn("cell", F.concat(F.lit("x:"), F.col("cell").cast("string"))), spanning=True)
    return counts.combine_layers(one.where("layer = 'spliced'"), one.where("layer <> 'spliced'"))


COUNTS = "SELECT l_suppkey AS cell, l_partkey AS gene, count(*) AS count FROM lineitem GROUP BY 1, 2"


def _counts(spark: SparkSession, sf: str) -> DataFrame:
    l = read(spark, sf, "lineitem").select(F.col("l_suppkey").alias("cell"), F.col("l_partkey").alias("gene"))
    return counts.feature_counts(counts.dealt(l, "cell", "gene"), ["cell", "gene"])


@query(f"WITH c AS ({COUNTS}) SELECT cell, sum(count)::BIGINT AS umi_count, count(*) FILTER (count > 0) AS gene_count FROM c GROUP BY cell HAVING sum(count) > 0")
def cell_meta(spark: SparkSession, sf: str) -> DataFrame:
    return counts.cell_totals(_counts(spark, sf), ["cell"])


@query(f"WITH c AS ({COUNTS}) SELECT cell, count(DISTINCT gene) AS n_features FROM c GROUP BY cell HAVING count(DISTINCT gene) >= 300")
def min_features(spark: SparkSession, sf: str) -> DataFrame:
    return counts.detected_cells(_counts(spark, sf), 300, "cell", "gene")


@query("WITH a AS (SELECT DISTINCT l_suppkey AS cell FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 49), b AS (SELECT DISTINCT l_suppkey AS cell FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 49) SELECT cell FROM a INTERSECT SELECT cell FROM b")
def common_cells(spark: SparkSession, sf: str) -> DataFrame:
    l = read(spark, sf, "lineitem").where("l_quantity > 49").select(F.col("l_suppkey").alias("cell"), "l_returnflag")
    a, _ = counts.common_cells(l.where("l_returnflag = 'R'"), l.where("l_returnflag = 'A'"))
    return a.select("cell").distinct()


@query(f"WITH c AS ({COUNTS}) SELECT cell, round(100.0 * sum(CASE WHEN regexp_matches(p_name, '^[a-c]') THEN count ELSE 0 END)::DOUBLE / sum(count), 6) AS percent FROM c JOIN part ON gene = p_partkey GROUP BY cell")
def pct_feature(spark: SparkSession, sf: str) -> DataFrame:
    c = _counts(spark, sf).join(read(spark, sf, "part").select(F.col("p_partkey").alias("gene"), F.col("p_name").alias("gene_name")), "gene")
    return counts.percent_of(c, "^[a-c]").withColumn("percent", F.round("percent", 6))


@query("SELECT l_returnflag AS i7, l_suppkey AS cell, CAST(dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_suppkey) - 1 AS BIGINT) AS cell_index FROM (SELECT DISTINCT l_returnflag, l_suppkey FROM lineitem)")
def cell_ordinal(spark: SparkSession, sf: str) -> DataFrame:
    return counts.ordinals(read(spark, sf, "lineitem").select(F.col("l_returnflag").alias("i7"), F.col("l_suppkey").alias("cell")), "cell", "i7")


@query("SELECT 'r' AS part, l_suppkey AS cell, l_partkey AS gene, count(*) AS count FROM lineitem WHERE l_returnflag = 'R' GROUP BY 2, 3 UNION ALL SELECT 'a', l_suppkey, l_partkey, count(*) FROM lineitem WHERE l_returnflag = 'A' GROUP BY 2, 3")
def matrix_union(spark: SparkSession, sf: str) -> DataFrame:
    l = read(spark, sf, "lineitem").select("l_returnflag", F.col("l_suppkey").alias("cell"), F.col("l_partkey").alias("gene"))
    one = lambda flag, name: counts.feature_counts(l.where(F.col("l_returnflag") == flag), ["cell", "gene"]).withColumn("part", F.lit(name))
    return counts.union_matrices(one("R", "r"), one("A", "a")).select("part", "cell", "gene", "count")


PRIM = "SELECT s_suppkey AS rt, s_suppkey - s_suppkey % 2 AS shortdt, s_suppkey % 2 = 1 AS is_randomn, n_name AS sample FROM supplier JOIN nation ON s_nationkey = n_nationkey"
CELLS = "SELECT l_returnflag AS i7, l_orderkey % 8 AS ligation, l_suppkey AS rt, count(*) AS umi_count, sum(CASE WHEN l_quantity < 10 THEN 1.0 ELSE 0.0 END)::DOUBLE / (count(*) + 1) AS unmatched_rate FROM lineitem GROUP BY 1, 2, 3"


@query(
    f"""WITH p AS ({PRIM}), c AS ({CELLS})
SELECT i7, ligation, shortdt, sum(umi_count)::BIGINT AS umi_count, round(CASE WHEN count(*) = 1 THEN min(unmatched_rate) ELSE sum(unmatched_rate * umi_count / (1 - unmatched_rate)) / sum(umi_count / (1 - unmatched_rate)) END, 6) AS unmatched_rate,
  coalesce(sum(umi_count) FILTER (is_randomn), 0)::BIGINT AS randomn_umi_count, coalesce(sum(umi_count) FILTER (NOT is_randomn), 0)::BIGINT AS shortdt_umi_count, count(*) AS n_primers FROM c JOIN p ON c.rt = p.rt GROUP BY 1, 2, 3"""
)
def merge_twins(spark: SparkSession, sf: str) -> DataFrame:
    p = spark.sql(PRIM.replace("FROM supplier JOIN nation", "FROM {supplier} JOIN {nation}"), supplier=read(spark, sf, "supplier"), nation=read(spark, sf, "nation"))
    c = spark.sql(CELLS.replace("::DOUBLE", "").replace("1.0", "1D").replace("0.0", "0D").replace("FROM lineitem", "FROM {lineitem}"), lineitem=read(spark, sf, "lineitem"))
    return counts.merge_primers(c, p, ["i7", "ligation"]).withColumn("unmatched_rate", F.round("unmatched_rate", 6)).drop("sample")


@query(f"WITH p AS ({PRIM}) SELECT l_returnflag AS i7, l_orderkey % 8 AS ligation, shortdt, l_partkey AS gene, count(*) AS count FROM lineitem JOIN p ON l_suppkey = rt GROUP BY 1, 2, 3, 4")
def merge_twin_counts(spark: SparkSession, sf: str) -> DataFrame:
    p = spark.sql(PRIM.replace("FROM supplier JOIN nation", "FROM {supplier} JOIN {nation}"), supplier=read(spark, sf, "supplier"), nation=read(spark, sf, "nation"))
    l = read(spark, sf, "lineitem").select(F.col("l_returnflag").alias("i7"), (F.col("l_orderkey") % 8).alias("ligation"), F.col("l_suppkey").alias("rt"), F.col("l_partkey").alias("gene"))
    return counts.merge_primer_counts(counts.feature_counts(l, ["i7", "ligation", "rt", "gene"]), p, ["i7", "ligation"], "gene")


@query(f"WITH c AS ({COUNTS}), m AS (SELECT cell, sum(count)::BIGINT AS umi_count FROM c GROUP BY cell) SELECT cell, umi_count, n_name AS sample FROM m LEFT JOIN supplier ON cell = s_suppkey AND s_acctbal > 0 LEFT JOIN nation ON s_nationkey = n_nationkey")
def meta_left_join(spark: SparkSession, sf: str) -> DataFrame:
    m = _counts(spark, sf).groupBy("cell").agg(F.sum("count").alias("umi_count"))
    s = read(spark, sf, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("cell"), "s_nationkey")
    n = read(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("sample"))
    return cells.with_samples(cells.with_samples(m, s, "cell"), n, "s_nationkey").select("cell", "umi_count", "sample")


# --- statistics -----------------------------------------------------------------------------------------------------

METRICS = ["click", "error", "purchase", "signup", "view"]


@query("SELECT user_id AS prefix, " + ", ".join(f"CASE WHEN count(*) FILTER (event_type = '{m}') = 0 THEN -1 ELSE count(*) FILTER (event_type = '{m}') END AS {m}" for m in METRICS) + " FROM events GROUP BY user_id")
def stats_pivot(spark: SparkSession, sf: str) -> DataFrame:
    log = read(spark, sf, "events").groupBy(F.col("user_id").alias("prefix"), F.col("event_type").alias("metric")).agg(F.count("*").alias("value"))
    return stats.pivot(log, METRICS)


@query("SELECT user_id AS prefix, event_type AS metric, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2")
def stats_last(spark: SparkSession, sf: str) -> DataFrame:
    log = read(spark, sf, "events").select(F.col("user_id").alias("prefix"), F.col("event_type").alias("metric"), "value", "event_id")
    return stats.last_values(log, "event_id")


@query("SELECT l_suppkey AS prefix, count(*) AS count FROM lineitem GROUP BY 1 HAVING count(*) >= 590")
def prefix_min_records(spark: SparkSession, sf: str) -> DataFrame:
    return stats.frequent_prefixes(read(spark, sf, "lineitem").select(F.col("l_suppkey").alias("prefix")), 590)


@query("SELECT s_suppkey, l_returnflag FROM supplier, (SELECT DISTINCT l_returnflag FROM lineitem) f WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_suppkey = s_suppkey AND l.l_returnflag = f.l_returnflag AND l_quantity > 49.5)")
def expected_missing(spark: SparkSession, sf: str) -> DataFrame:
    l = read(spark, sf, "lineitem")
    kinds = sorted(r[0] for r in l.select("l_returnflag").distinct().collect())  # three values
    expected = read(spark, sf, "supplier").select("s_suppkey", F.explode(F.array(*[F.lit(k) for k in kinds])).alias("l_returnflag"))
    return stats.missing_files(expected, l.where("l_quantity > 49.5").select(F.col("l_suppkey").alias("s_suppkey"), "l_returnflag"), ["s_suppkey", "l_returnflag"])


@query("SELECT s_suppkey, string_split(s_name || '_a_b_c_d', '_')[1] || '_' || string_split(s_name || '_a_b_c_d', '_')[3] || '_' || string_split(s_name || '_a_b_c_d', '_')[5] AS new_name FROM supplier")
def file_rename(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "supplier").select("s_suppkey", stats.renamed(F.concat("s_name", F.lit("_a_b_c_d"))).alias("new_name"))
