"""Queries that go through files: rows of the tables are written in a format and read back, into the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import alignments, annotation, cells, counts, stats
from ..sources import bam, fastq, layers, paths, statlog, tables, text
from .queries import CELLS, PRIM, SEQ, SEQ_SPARK
from .views import EXON, exon_view, read

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


LINE_NAME = "'r' || CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) || ':' || CAST(l_partkey AS VARCHAR) || ':' || CAST(l_suppkey AS VARCHAR)"


def line_name():
    return F.concat(F.lit("r"), F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))


def _codes(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.expr(SEQ_SPARK).alias("seq"))


@query(f"SELECT {LINE_NAME} AS name, seq, repeat('I', 15) AS qual FROM lineitem JOIN (SELECT s_suppkey, {SEQ} AS seq FROM supplier) s ON l_suppkey = s_suppkey")
def fastq_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Plain FASTQ, which is read in splits."""
    path = paths.scratch(spark, "fastq")
    rows = read(spark, sf, "lineitem").join(_codes(spark, sf), "l_suppkey").select(line_name().alias("name"), "seq", F.repeat(F.lit("I"), 15).alias("qual"))
    fastq.write_fastq(rows, path, compression="none")
    return fastq.read_fastq(spark, path).select("name", "seq", "qual")


SAM_ROWS = f"""SELECT {LINE_NAME} AS name, CAST(l_linenumber * 16 AS INT) AS flag, 'chr' || CAST(l_suppkey % 3 + 1 AS VARCHAR) AS chrom, CAST(l_partkey AS BIGINT) AS pos, CAST(l_quantity AS INT) AS mapq,
  CAST(CAST(l_quantity AS INT) AS VARCHAR) || 'M' || CAST(l_linenumber AS VARCHAR) || 'N5M' AS cigar, l_returnflag || ':' || l_linestatus AS cb FROM lineitem"""


def _alignments(spark: SparkSession, sf: str) -> DataFrame:
    l = read(spark, sf, "lineitem")
    cigar = F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("M"), F.col("l_linenumber").cast("string"), F.lit("N5M"))
    return l.select(
        line_name().alias("name"), (F.col("l_linenumber") * 16).cast("int").alias("flag"), F.concat(F.lit("chr"), (F.col("l_suppkey") % 3 + 1).cast("string")).alias("chrom"), F.col("l_partkey").cast("long").alias("pos"),
        F.col("l_quantity").cast("int").alias("mapq"), cigar.alias("cigar"), F.create_map(F.lit("CB"), F.concat_ws(":", "l_returnflag", "l_linestatus")).alias("tags"),
    )


def _with_cb(df: DataFrame) -> DataFrame:
    return df.select("name", "flag", "chrom", "pos", "mapq", "cigar", F.try_element_at("tags", F.lit("CB")).alias("cb"))


REFERENCES = [("chr1", 1 << 28), ("chr2", 1 << 28), ("chr3", 1 << 28)]


@query(SAM_ROWS)
def sam_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = paths.scratch(spark, "sam")
    text.write_sam(_alignments(spark, sf), path, REFERENCES)
    return _with_cb(text.read_sam(spark, path))


@query(SAM_ROWS)
def bam_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = paths.scratch(spark, "bam")
    spark.dataSource.register(bam.BamSource)
    rows = spark.createDataFrame([], bam.SCHEMA).unionByName(_alignments(spark, sf), allowMissingColumns=True)
    rows.write.format("bam").option("references", ",".join(f"{c}:{n}" for c, n in REFERENCES)).mode("append").save(path)
    return _with_cb(spark.read.format("bam").load(path))


@query(f"SELECT * FROM ({SAM_ROWS}) WHERE chrom = 'chr2' AND pos BETWEEN 100 AND 1099")
def bam_region(spark: SparkSession, sf: str) -> DataFrame:
    """One region of files in order of place, by their index."""
    path = paths.scratch(spark, "bam-sorted")
    spark.dataSource.register(bam.BamSource)
    rows = spark.createDataFrame([], bam.SCHEMA).unionByName(_alignments(spark, sf), allowMissingColumns=True)
    ordered = alignments.sort_by_place(rows, [c for c, _ in REFERENCES])
    ordered.write.format("bam").option("references", ",".join(f"{c}:{n}" for c, n in REFERENCES)).option("index", "true").mode("append").save(path)
    return _with_cb(spark.read.format("bam").option("region", "chr2:100-1100").load(path))


@query(f"WITH exon AS ({EXON}) SELECT chrom, 'exon' AS feature, s AS start, e AS \"end\", strand, gene_id, exon_id, 't' AS gene_type FROM exon")
def gtf_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = paths.scratch(spark, "gtf")
    x = exon_view(spark, sf)
    attrs = F.concat(F.lit('gene_id "'), "gene_id", F.lit('"; exon_id "'), "exon_id", F.lit('"; gene_type "t"; tag "a"; tag "b";'))
    x.select(F.concat_ws("\t", "chrom", F.lit("s"), F.lit("exon"), (F.col("start") + 1).cast("string"), F.col("end").cast("string"), F.lit("."), "strand", F.lit("."), attrs)).write.text(path)
    return text.read_gtf(spark, path).select("chrom", "feature", "start", "end", "strand", "gene_id", "exon_id", "gene_type")


TRIPLETS = "SELECT l_returnflag AS prefix, l_partkey AS gene, l_suppkey AS cell, count(*) AS count FROM lineitem GROUP BY 1, 2, 3"


def _triplets(spark: SparkSession, sf: str) -> DataFrame:
    l = read(spark, sf, "lineitem").select(F.col("l_returnflag").alias("prefix"), F.col("l_suppkey").alias("cell"), F.col("l_partkey").alias("gene"))
    return counts.feature_counts(l, ["prefix", "gene", "cell"])


@query(f"""WITH t AS ({TRIPLETS}), c AS (SELECT prefix, cell, dense_rank() OVER (PARTITION BY prefix ORDER BY cell) - 1 AS cell_index FROM (SELECT DISTINCT prefix, cell FROM t)),
g AS (SELECT gene, dense_rank() OVER (ORDER BY gene) - 1 AS gene_index FROM (SELECT DISTINCT gene FROM t))
SELECT prefix, gene_index, cell_index, count::DOUBLE AS count, prefix || '.' || CAST(cell AS VARCHAR) AS cell_id, cell_index / 2.0::DOUBLE AS unmatched_rate, 'g' || CAST(gene AS VARCHAR) AS gene_id FROM t JOIN c USING (prefix, cell) JOIN g USING (gene)""")
def count_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Triplets, cell ids and the dictionary of features by way of their files."""
    path = paths.scratch(spark, "counts")
    t = _triplets(spark, sf)
    genes = stats.indexed(t.select("gene").distinct(), "gene", "gene_index")
    index = counts.ordinals(t, "cell", "prefix")
    tables.write_triplets(t.join(genes, "gene").join(index, ["prefix", "cell"]), path)
    tables.write_cell_ids(index.select("prefix", "cell_index", F.concat_ws(".", "prefix", F.col("cell").cast("string")).alias("cell_id"), (F.col("cell_index") / 2.0).alias("unmatched_rate")), path)
    tables.write_features(genes.select("gene_index", F.concat(F.lit("g"), F.col("gene").cast("string")).alias("gene_id")), f"{path}/gene_ids.csv.gz", "gene_index")
    back = tables.read_triplets(spark, path).join(tables.read_cell_ids(spark, path), ["prefix", "cell_index"])
    return back.join(tables.read_features(spark, f"{path}/gene_ids.csv.gz", "gene_index long, gene_id string"), "gene_index").select("prefix", "gene_index", "cell_index", "count", "cell_id", "unmatched_rate", "gene_id")


def _matrix_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Triplets of all prefixes, summed in parts of a bounded number of lines and written once, as both annotations come of them too."""
    l = read(spark, sf, "lineitem").select(F.col("l_returnflag").alias("prefix"), F.col("l_suppkey").cast("string").alias("cell_id"), F.col("l_partkey").cast("string").alias("gene_id"))
    t = counts.feature_counts(counts.dealt(l, "cell_id", "gene_id"), ["prefix", "cell_id", "gene_id"])
    t = t.groupBy("cell_id", "gene_id").agg(F.sum("count").alias("count"))
    path = paths.scratch(spark, "matrix-triplets")
    t.write.parquet(path)
    return spark.read.schema(t.schema).parquet(path)


@query(f"WITH t AS ({TRIPLETS}) SELECT CAST(cell AS VARCHAR) AS cell_id, CAST(gene AS VARCHAR) AS gene_id, sum(count)::DOUBLE AS value FROM t GROUP BY 1, 2")
def matrix_bundle(spark: SparkSession, sf: str) -> DataFrame:
    """A MatrixMarket matrix with its annotations, written in parts and read back by name."""
    path = paths.scratch(spark, "matrix")
    t = _matrix_counts(spark, sf)
    tables.write_matrix_bundle(t, t.groupBy("cell_id").agg(F.sum("count").alias("umi_count")), t.select("gene_id").distinct(), path)
    return tables.read_matrix_bundle(spark, path)


@query("SELECT 'u' || CAST(user_id AS VARCHAR) AS prefix, event_type AS metric, count(*) AS value FROM events GROUP BY 1, 2")
def stat_logs(spark: SparkSession, sf: str) -> DataFrame:
    path = paths.scratch(spark, "logs")
    log = read(spark, sf, "events").groupBy(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("prefix"), F.col("event_type").alias("metric")).agg(F.count("*").alias("value"))
    tables.write_stat_logs(log, path)
    return stats.last_values(tables.read_stat_logs(spark, path), "place")


@query("""WITH a AS (SELECT l_returnflag AS prefix, 1 AS step, l_linestatus AS metric, count(*) AS value FROM lineitem GROUP BY ALL UNION ALL
  SELECT l_returnflag, 2, l_linestatus, sum(l_linenumber) FROM lineitem WHERE l_linestatus = 'O' GROUP BY ALL UNION ALL SELECT l_returnflag, 3, 'suppliers', count(DISTINCT l_suppkey) FROM lineitem GROUP BY ALL)
SELECT prefix, metric, arg_max(value, step)::BIGINT AS value FROM a GROUP BY prefix, metric""")
def appended_logs(spark: SparkSession, sf: str) -> DataFrame:
    """Three steps add to one log, the second counts a metric anew, and the first is tried again at the end."""
    path = paths.scratch(spark, "statlog")
    by = read(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("prefix"), F.col("l_linestatus").alias("metric"))
    first = by.agg(F.count("*").alias("value"))
    statlog.append(first, path, "count", token="count-1")
    statlog.append(by.agg(F.sum("l_linenumber").alias("value")).where("metric = 'O'"), path, "recount", token="recount-1")
    statlog.append(read(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("prefix")).agg(F.countDistinct("l_suppkey").alias("value")).withColumn("metric", F.lit("suppliers")), path, "suppliers")
    statlog.append(first, path, "count", token="count-1")
    return statlog.last_values(spark, path)


@query(f"WITH t AS ({TRIPLETS}) SELECT CAST(cell AS VARCHAR) AS cell_id, CAST(gene AS VARCHAR) AS gene_id, sum(count)::DOUBLE AS value FROM t GROUP BY 1, 2")
def matrix_in_file_order(spark: SparkSession, sf: str) -> DataFrame:
    """A matrix whose annotations stand in no order of their names, as other programs write them."""
    path = paths.scratch(spark, "foreign")
    t = _matrix_counts(spark, sf)
    by_hash = lambda c: t.select(c).distinct().withColumn("place", F.md5(c))
    tables.write_matrix_bundle(t, by_hash("cell_id"), by_hash("gene_id"), path, gzip=False, cells_by="place", features_by="place")
    return tables.read_matrix_bundle(spark, path)


@query("SELECT l_returnflag || '.' || CAST(l_suppkey AS VARCHAR) AS cell_id, 'g' || CAST(l_partkey AS VARCHAR) AS gene_id, l_linestatus AS layer, count(*)::DOUBLE AS count FROM lineitem GROUP BY ALL")
def layer_files(spark: SparkSession, sf: str) -> DataFrame:
    """Three matrices of two layers, each with its own order of features, merged and read back."""
    path = paths.scratch(spark, "layers")
    l = read(spark, sf, "lineitem").select("l_returnflag", F.concat(F.lit("x:"), F.col("l_returnflag"), F.lit("."), F.col("l_suppkey").cast("string")).alias("cell_id"), F.concat(F.lit("g"), F.col("l_partkey").cast("string")).alias("gene_id"), F.col("l_linestatus").alias("layer"))
    for flag in "ANR":
        one = l.where(F.col("l_returnflag") == flag).groupBy("cell_id", "gene_id", "layer").agg(F.count("*").alias("count"))
        layers.write_layers(one, f"{path}/{flag}", features=one.select("gene_id").distinct().withColumn("by", F.md5(F.concat(F.lit(flag), "gene_id"))), features_by="by")
    layers.merge_layers(spark, [f"{path}/{flag}" for flag in "ANR"], f"{path}/all", layers.behind_colon)
    return layers.read_layers(spark, f"{path}/all")


@query("SELECT s_name AS sample, CAST(s_suppkey AS VARCHAR) AS shortdt, CAST(s_nationkey AS VARCHAR) AS randomn FROM supplier WHERE s_suppkey % 2 = 1")
def rt_tables(spark: SparkSession, sf: str) -> DataFrame:
    path = paths.scratch(spark, "rt")
    rows = read(spark, sf, "supplier").select(F.col("s_name").alias("sample"), F.col("s_suppkey").cast("string").alias("shortdt"), F.col("s_nationkey").cast("string").alias("randomn"), "s_suppkey")
    tables.write_rt_tables({"human": rows.where("s_suppkey % 2 = 1"), "mouse": rows.limit(0)}, path)
    return text.read_rt_table(spark, f"{path}/human_rt_barcodes.tsv").unionByName(text.read_rt_table(spark, f"{path}/mouse_rt_barcodes.tsv"))


@query("SELECT s_suppkey, s_name FROM supplier")
def versioned_bundle(spark: SparkSession, sf: str) -> DataFrame:
    """A later version does not replace an earlier one, and a bundle gives its tables back."""
    root = paths.scratch(spark, "versions")
    s = read(spark, sf, "supplier").select("s_suppkey", "s_name")
    paths.write_versioned(s.limit(0), root)
    paths.write_versioned(s, root)
    tables.write_bundle(f"{root}/all.bundle", suppliers=paths.latest(spark, root))
    return tables.read_bundle(spark, f"{root}/all.bundle", "suppliers")["suppliers"]


FINAL = f"""WITH p AS ({PRIM}), c AS ({CELLS}), n AS (
  SELECT i7, ligation, shortdt, count(*) AS gene_count FROM (SELECT DISTINCT l_returnflag AS i7, l_orderkey % 8 AS ligation, shortdt, l_partkey FROM lineitem JOIN p ON l_suppkey = rt) GROUP BY 1, 2, 3)
SELECT i7 || '.' || CAST(ligation AS VARCHAR) || '.' || CAST(shortdt AS VARCHAR) AS cell_id, round(CASE WHEN count(*) = 1 THEN min(unmatched_rate) ELSE sum(unmatched_rate * umi_count / (1 - unmatched_rate)) / sum(umi_count / (1 - unmatched_rate)) END, 6) AS unmatched_rate,
  sum(umi_count)::BIGINT AS umi_count, min(gene_count)::BIGINT AS gene_count, i7 AS pcr_batch, CAST(ligation AS VARCHAR) AS ligation_barcodes, coalesce(sum(umi_count) FILTER (NOT is_randomn), 0)::DOUBLE AS shortdt_umi_count,
  coalesce(sum(umi_count) FILTER (is_randomn), 0)::DOUBLE AS randomn_umi_count, CAST(shortdt AS VARCHAR) AS rt_barcodes_shortdt, coalesce(min(sample) FILTER (NOT is_randomn), min(sample)) AS sample
FROM c JOIN p ON c.rt = p.rt JOIN n USING (i7, ligation, shortdt) GROUP BY i7, ligation, shortdt"""


def _final_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    s = lambda c: F.col(c).cast("string")
    p = spark.sql(PRIM.replace("FROM supplier JOIN nation", "FROM {supplier} JOIN {nation}"), supplier=read(spark, sf, "supplier"), nation=read(spark, sf, "nation"))
    p = p.select(s("rt").alias("rt"), s("shortdt").alias("shortdt"), "is_randomn", "sample")
    l = read(spark, sf, "lineitem").select(F.col("l_returnflag").alias("pcr_batch"), (F.col("l_orderkey") % 8).cast("string").alias("ligation_barcodes"), s("l_suppkey").alias("rt_barcodes"), F.col("l_partkey").alias("gene_id"), "l_quantity")
    c = l.groupBy(*cells.CELL).agg((F.sum(F.when(F.col("l_quantity") < 10, 1.0).otherwise(0.0)) / (F.count("*") + 1)).alias("unmatched_rate"))
    # both primers of a cell lie with their gene, so their counts are added up where they were made
    return counts.feature_counts(counts.dealt(l.select(*cells.CELL, "gene_id"), *cells.UNIT, "gene_id"), [*cells.CELL, "gene_id"]), c, p


@query(FINAL)
def cell_annotation(spark: SparkSession, sf: str) -> DataFrame:
    """The final cell table: merged primers, features counted anew, samples."""
    return cells.cell_annotation(*_final_inputs(spark, sf)).withColumn("unmatched_rate", F.round("unmatched_rate", 6))


@query(f"WITH p AS ({PRIM}) SELECT l_returnflag || '.' || CAST(l_orderkey % 8 AS VARCHAR) || '.' || CAST(shortdt AS VARCHAR) AS cell_id, l_partkey AS gene_id, count(*) AS count FROM lineitem JOIN p ON l_suppkey = rt GROUP BY 1, 2")
def merged_matrix(spark: SparkSession, sf: str) -> DataFrame:
    c, _, p = _final_inputs(spark, sf)
    return cells.merged_counts(c, p)


@query(f"WITH exon AS ({EXON}) SELECT CASE WHEN regexp_matches(arg_min(gene_id, line), '^g') THEN 'human' END AS species FROM exon")
def species_of(spark: SparkSession, sf: str) -> DataFrame:
    x = annotation.distinct_exons(exon_view(spark, sf)).withColumn("gene_id", F.regexp_replace("gene_id", "^g", "ENSG"))
    return counts.species_of(x)
