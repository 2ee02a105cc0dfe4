"""Count tables, dictionaries, stat logs, matrices and sheets: the files between the steps of a workflow.

Count tables of a prefix are <prefix>.count(.gz) with feature and cell indices, <prefix>_cell_ids.csv(.gz) with each
cell's rate, and one dictionary of features for all prefixes.  Writers make folders of part files below such names, and
readers take single files and folders alike.
"""

from __future__ import annotations

import re
import uuid
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.counts import PART, dealt
from ..operators.ranks import ranked
from .lines import csv_rows, numbered_lines
from .paths import exists, file_name, place, remove, scratch


def _named(path_col, pattern: str):
    """The part of a path that names the prefix: of the file, or of the folder that holds its parts."""
    return F.regexp_extract(path_col, pattern, 1)


def read_triplets(spark: SparkSession, path: str, feature: str = "gene_index") -> DataFrame:
    """prefix, feature, cell_index, count of all <prefix>.count and <prefix>.count.gz below path."""
    schema = f"{feature} long, cell_index long, count double"
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.{count,count.gz,csv,csv.gz}").csv(path, schema=schema, header=True, enforceSchema=True)
    name = _named(F.col("_metadata.file_path"), r"/([^/]+)\.count(?:\.gz)?(?:/[^/]*)?$")
    return raw.select(name.alias("prefix"), *raw.columns).where("prefix <> ''")


def read_cell_ids(spark: SparkSession, path: str) -> DataFrame:
    """prefix, cell_index, cell_id, unmatched_rate of all <prefix>_cell_ids.csv(.gz) below path."""
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.{csv,csv.gz}").csv(path, schema="cell_index long, cell_id string, unmatched_rate double", header=True, enforceSchema=True)
    name = _named(F.col("_metadata.file_path"), r"/([^/]+)_cell_ids\.csv(?:\.gz)?(?:/[^/]*)?$")
    return raw.select(name.alias("prefix"), *raw.columns).where("prefix <> ''")


def read_features(spark: SparkSession, path: str, schema: str = "gene_index long, gene_id string, gene_type string, gene_name string, feature string") -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=True)


def _each(df: DataFrame, path: str, ending: str, write) -> None:
    """A folder <prefix><ending> of part files a prefix: one job writes all below one folder, then they are moved.

    Where one of them is already there, an error is raised and nothing is moved.
    """
    spark = df.sparkSession
    at = f"{path.rstrip('/')}/_writing-{ending.strip('._')}-{uuid.uuid4().hex}"
    write(df.write.partitionBy("prefix"), at)
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(at)
    store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        moves = [(f.getPath(), jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{f.getPath().getName().removeprefix('prefix=')}{ending}")) for f in store.listStatus(root) if f.getPath().getName().startswith("prefix=")]  # one a prefix
        for _, to in moves:
            if store.exists(to):
                raise FileExistsError(to.toString())
        for old, to in moves:
            store.rename(old, to)
    finally:
        store.delete(root, True)


def _csv(gzip: bool):
    return lambda writer, at: writer.csv(at, header=True, compression="gzip" if gzip else "none")


def write_triplets(counts: DataFrame, path: str, feature: str = "gene_index", gzip: bool = True) -> None:
    """prefix, feature, cell_index, count -> <prefix>.count(.gz)."""
    _each(counts.select("prefix", feature, "cell_index", "count"), path, ".count.gz" if gzip else ".count", _csv(gzip))


def write_cell_ids(cells: DataFrame, path: str, gzip: bool = True) -> None:
    """prefix, cell_index, cell_id, unmatched_rate -> <prefix>_cell_ids.csv(.gz)."""
    _each(cells.select("prefix", "cell_index", "cell_id", "unmatched_rate"), path, "_cell_ids.csv.gz" if gzip else "_cell_ids.csv", _csv(gzip))


def write_features(features: DataFrame, path: str, order: str, gzip: bool = True) -> None:
    """A dictionary in index order, as part files with a header."""
    features.sort(order).write.csv(path, header=True, compression="gzip" if gzip else "none")


def write_rt_tables(tables: dict[str, DataFrame], path: str) -> None:
    """<species>_rt_barcodes.tsv a species: sample, shortdt, randomn; a species without wells gives a table without rows."""
    for species, df in tables.items():
        df.select("sample", "shortdt", "randomn").write.csv(f"{path.rstrip('/')}/{species}_rt_barcodes.tsv", sep="\t", header=True)


def write_stat_logs(log: DataFrame, path: str) -> None:
    """prefix, metric, value -> <prefix>.log with a value and a metric a line.  Steps that add to one log use statlog.append.

    A prefix's lines come to one task, which writes its file; tasks write below one folder of their own try, and the files are
    moved by tasks, so the driver handles no file.  Where a log is already there, an error is raised and nothing is moved.
    """
    spark, root = log.sparkSession, path.rstrip("/")
    at = f"{root}/_writing-log-{uuid.uuid4().hex}"
    line = F.concat_ws("\t", F.col("value").cast("long").cast("string"), "metric").alias("line")
    dealt = log.select("prefix", F.struct(F.monotonically_increasing_id().alias("at"), line).alias("l")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "prefix")
    # a log has a line a metric and step, in the order of the rows
    texts = dealt.groupBy("prefix").agg(F.concat_ws("\n", F.transform(F.sort_array(F.collect_list("l")), lambda x: x["line"])).alias("text"))
    texts = texts.select(file_name(F.col("prefix")).alias("prefix"), "text")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = place(at)
        own = f"{base}/{uuid.uuid4().hex}"
        store.create_dir(own)
        for batch in batches:
            for prefix, text in zip(*(c.to_pylist() for c in batch.columns)):
                with store.open_output_stream(f"{own}/{prefix}.log") as out:
                    out.write(f"{text}\n".encode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([own] * batch.num_rows)], names=["prefix", "own"])

    def there(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = place(root)
        for batch in batches:
            kinds = store.get_file_info([f"{base}/{p}.log" for p in batch.column(0).to_pylist()])
            yield batch.filter(pa.array([k.type != fs.FileType.NotFound for k in kinds], pa.bool_()))

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = place(root)
        for batch in batches:
            for prefix, own in zip(*(c.to_pylist() for c in batch.columns)):
                if store.get_file_info(f"{base}/{prefix}.log").type == fs.FileType.NotFound:  # a task tried again has moved some
                    store.move(f"{own}/{prefix}.log", f"{base}/{prefix}.log")
        yield from ()

    held = scratch(spark, "stat-logs")
    try:
        texts.mapInArrow(written, "prefix string, own string").write.parquet(held)
        names = spark.read.schema("prefix string, own string").parquet(held)
        if known := names.mapInArrow(there, "prefix string, own string").first():
            raise FileExistsError(f"{root}/{known['prefix']}.log")
        names.mapInArrow(moved, "prefix string, own string").count()
    finally:
        remove(spark, at)


def read_stat_logs(spark: SparkSession, path: str) -> DataFrame:
    """prefix (file or folder name up to .log), metric, value, place (file, split, line): rows of one log stand in order of place.

    Lines are numbered as they are read: a split is one task's, whose numbers ascend; no pass counts the lines before.
    """
    text = spark.read.option("recursiveFileLookup", True).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("line"), "value")
    row = F.from_csv("value", "value long, metric string", {"sep": "\t"})
    name = F.regexp_extract("file", r"/([^/.]+)\.log(?:/[^/]*)?$", 1)
    return text.where(F.trim("value") != "").select(name.alias("prefix"), row.alias("row"), F.struct("file", "split", "line").alias("place")).where("prefix <> ''").select("prefix", "row.metric", "row.value", "place")


def write_stats(stats: DataFrame, path: str) -> None:
    """One row a prefix, one column a metric, as a table with a header."""
    stats.sort("prefix").write.csv(path, header=True)


# --- matrices -------------------------------------------------------------------------------------------------------


def _matrix_market(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """read_matrix_market's rows, and how many entries the size line tells."""
    comment = F.startswith(F.col("value"), F.lit("%"))
    text = spark.read.text(path).where(F.trim("value") != "").select(F.col("_metadata.file_path").alias("file"), "value")
    banners = text.where(F.startswith(F.col("value"), F.lit("%%MatrixMarket"))).groupBy("file").agg(F.min("value").alias("banner")).sort("file").collect()  # a row a file that holds one
    if not banners:
        raise ValueError(f"no MatrixMarket banner in {path}")
    banner, headed = banners[0]["banner"].lower(), [r["file"] for r in banners]
    kind = banner.split()
    if len(kind) < 5 or kind[2] != "coordinate" or kind[3] not in ("integer", "real", "pattern", "double") or kind[4] not in ("general", "symmetric", "skew-symmetric"):
        raise ValueError(f"not a coordinate matrix of real numbers: {banner}")
    # lines of the files that hold banners are numbered, to leave their size lines out; those of all others are entries
    lines = numbered_lines(spark, path, blank=False, only=headed).where(~comment)
    sizes = lines.groupBy("file").agg(F.min("in_file").alias("in_file")).collect()
    told = spark.createDataFrame([tuple(r) for r in sizes], "file string, in_file long")
    first = lines.join(F.broadcast(told), ["file", "in_file"]).sort("file").select("value").head(1)
    body = lines.join(F.broadcast(told), ["file", "in_file"], "left_anti").select("value")
    body = body.unionByName(text.where(~F.col("file").isin(headed) & ~comment).select("value"))
    numbers = first[0][0].split() if first else []
    n = int(numbers[2]) if len(numbers) == 3 and numbers[2].isdecimal() else 0
    return _entries(body, kind), n


def read_matrix_market(spark: SparkSession, path: str) -> DataFrame:
    """row, col (from 0), value of a coordinate MatrixMarket file, or of a folder of parts that make one when laid end to end.

    The size line is the first that is neither empty nor a comment in the file that holds the banner.  Entries without
    values (pattern) are 1; of a symmetric or skew-symmetric matrix both halves are given.
    """
    return _matrix_market(spark, path)[0]


def _entries(body: DataFrame, kind: list[str]) -> DataFrame:
    c = F.split(F.trim("value"), r"\s+")
    value = F.lit(1.0) if kind[3] == "pattern" else c[2].cast("double")
    entries = body.select((c[0].cast("long") - 1).alias("row"), (c[1].cast("long") - 1).alias("col"), value.alias("value"))
    if kind[4] == "general":
        return entries
    sign = -1.0 if kind[4].startswith("skew") else 1.0
    other = F.struct(F.col("col").alias("row"), F.col("row").alias("col"), (F.col("value") * sign).alias("value"))
    both = F.array(F.struct("row", "col", "value"), other)
    return entries.select(F.explode(F.when(F.col("row") != F.col("col"), both).otherwise(F.slice(both, 1, 1))).alias("e")).select("e.*")


def write_matrix_market(triplets: DataFrame, path: str, n_rows: int, n_cols: int, field: str = "integer", gzip: bool = False) -> None:
    """row, col (from 0), value -> a folder of parts that make one coordinate file when laid end to end (gzip parts too).

    Entries are sorted by column, then row, in ranges; the head sorts before them, so the first part begins with it.
    """
    entry = F.concat_ws(" ", (F.col("row") + 1).cast("string"), (F.col("col") + 1).cast("string"), F.col("value").cast("long" if field == "integer" else "double").cast("string"))
    n = triplets.count()
    head = f"%%MatrixMarket matrix coordinate {field} general\n%\n{n_rows} {n_cols} {n}"
    first = triplets.sparkSession.createDataFrame([(-1, -1, head)], "col long, row long, line string")
    body = triplets.select(F.col("col").cast("long").alias("col"), F.col("row").cast("long").alias("row"), entry.alias("line"))
    parts = max(int(triplets.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // PART + 1)
    first.unionByName(body).repartitionByRange(parts, "col", "row").sortWithinPartitions("col", "row").select("line").write.text(path, compression="gzip" if gzip else "none")


def write_matrix_bundle(counts: DataFrame, cells: DataFrame, features: DataFrame, path: str, feature: str = "gene_id", gzip: bool = True, cells_by: str = "cell_id", features_by: str | None = None) -> None:
    """expression_matrix.mtx, cell_annotation.csv and feature_annotation.csv: rows are features and columns cells, in order of
    cells_by and features_by (the ids, unless other columns are named).  cells: cell_id and its columns; features: `feature`
    and its columns; counts: both and count.

    Indices are ranks, taken over ranges of keys, so no task sees all of them; both tables, the counts and the entries are
    written once in the shared folder, as every count, sort and join below would compute them anew.  Counts meet the features
    in parts of a bounded number of rows.
    """
    spark = counts.sparkSession

    def kept(df: DataFrame, name: str) -> DataFrame:
        at = scratch(spark, name)
        df.write.parquet(at)
        return spark.read.schema(df.schema).parquet(at)

    counts = kept(counts, "matrix-counts")
    c, f = kept(ranked(kept(cells, "matrix-cells"), cells_by, "__col"), "matrix-cells"), kept(ranked(kept(features, "matrix-features"), features_by or feature, "__row"), "matrix-features")
    n_cols, n_rows = c.count(), f.count()
    entries = dealt(counts.join(c.select("cell_id", "__col"), "cell_id"), feature, of=counts.count()).join(f.select(feature, "__row"), feature).select(F.col("__row").alias("row"), F.col("__col").alias("col"), F.col("count").alias("value"))
    end = ".gz" if gzip else ""
    write_matrix_market(kept(entries, "matrix-entries"), f"{path.rstrip('/')}/expression_matrix.mtx{end}", n_rows, n_cols, gzip=gzip)
    for df, order, name in ((c, "__col", "cell_annotation.csv"), (f, "__row", "feature_annotation.csv")):
        df.sort(order).drop(order).write.csv(f"{path.rstrip('/')}/{name}{end}", header=True, compression="gzip" if gzip else "none")


def read_matrix_bundle(spark: SparkSession, path: str, feature: str = "gene_id") -> DataFrame:
    """cell_id, feature, value: the matrix with its names; the n-th name of an annotation is that of column or row n, in file order."""
    end = ".gz" if exists(spark, f"{path.rstrip('/')}/expression_matrix.mtx.gz") else ""
    m, n = _matrix_market(spark, f"{path.rstrip('/')}/expression_matrix.mtx{end}")
    named = lambda name, key, index: csv_rows(spark, f"{path.rstrip('/')}/{name}{end}", index).select(index, key)
    met = m.join(named("cell_annotation.csv", "cell_id", "col"), "col")
    return dealt(met, "row", of=n).join(named("feature_annotation.csv", feature, "row"), "row").select("cell_id", feature, "value")


# --- bundles and sheets ---------------------------------------------------------------------------------------------


def write_bundle(path: str, **tables: DataFrame) -> None:
    """Named tables below one .bundle folder, each as Parquet; another ending is an error."""
    if not path.endswith(".bundle"):
        raise ValueError("a bundle's name ends in .bundle")
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}")


def read_bundle(spark: SparkSession, path: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{path}/{n}") for n in names}


_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships", "p": "http://schemas.openxmlformats.org/package/2006/relationships"}


def read_workbook(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Sheets of an .xlsx workbook as tables of strings, by the sheet's name; the first row names the columns.

    Barcode sheets are a few hundred rows that people fill in, so they are read on the driver.
    """
    import io

    data = spark.read.format("binaryFile").load(path).first()["content"]
    with zipfile.ZipFile(io.BytesIO(bytes(data))) as z:
        xml = lambda name: ElementTree.fromstring(z.read(name))
        texts = ["".join(t.text or "" for t in s.iter(f"{{{_NS['m']}}}t")) for s in xml("xl/sharedStrings.xml").findall("m:si", _NS)] if "xl/sharedStrings.xml" in z.namelist() else []
        target = {r.get("Id"): r.get("Target") for r in xml("xl/_rels/workbook.xml.rels")}
        out = {}
        for sheet in xml("xl/workbook.xml").find("m:sheets", _NS):
            file = target[sheet.get(f"{{{_NS['r']}}}id")].lstrip("/")
            rows = []
            for row in xml(file if file.startswith("xl/") else f"xl/{file}").iter(f"{{{_NS['m']}}}row"):
                cells = {}
                for c in row.findall("m:c", _NS):
                    column = 0
                    for letter in re.match("[A-Z]+", c.get("r"))[0]:
                        column = column * 26 + ord(letter) - 64
                    v = c.find("m:v", _NS)
                    cells[column - 1] = texts[int(v.text)] if c.get("t") == "s" else "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t")) if c.get("t") == "inlineStr" else v.text if v is not None else None
                rows.append(cells)
            if rows:
                names = [rows[0][i] for i in sorted(rows[0]) if rows[0][i]]
                at = [i for i in sorted(rows[0]) if rows[0][i]]
                body = [tuple(r.get(i) for i in at) for r in rows[1:] if any(v not in (None, "") for v in r.values())]
                out[sheet.get("name")] = spark.createDataFrame(body, ", ".join(f"`{n}` string" for n in names))
        return out
