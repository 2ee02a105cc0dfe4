"""Matrices of several layers over the same cells and features, in compressed blocks of cells.

<path>/features: gene_index and the features' columns; <path>/cells: block, slot and the cells' columns; <path>/blocks, a
folder a layer: block, pointers, indices, values.  A block holds `width` cells; the entries of its cell in slot i are
those from pointers[i] to pointers[i + 1].  Every layer has all blocks, so a cell without counts is a cell all the same.

Reads of some layers prune folders, reads of some cells prune row groups by block, as blocks are sorted.  Matrices are
merged block by block: the features' dictionaries are joined, and each block's indices are looked up in an array of its
matrix; no entry is taken out of its block or shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranks import ranked
from .paths import exists, scratch

WIDTH = 256
#: Features of a dictionary at most, as an array of places goes with every block.
MOST_FEATURES = 10_000_000


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_layers(counts: DataFrame, path: str, cells: DataFrame | None = None, features: DataFrame | None = None, width: int = WIDTH, cells_by: str = "cell_id", features_by: str = "gene_id") -> None:
    """counts: cell_id, gene_id, layer, count (each once) -> a matrix of layers below path.

    cells and features, with columns of their own, default to those of the counts; they stand in order of cells_by and
    features_by.
    """
    if exists(counts.sparkSession, path):
        raise FileExistsError(path)
    counts = _kept(counts.select("cell_id", "gene_id", "layer", F.col("count").cast("double").alias("count")), "layers-counts")
    cells = _kept(cells if cells is not None else counts.select("cell_id").distinct(), "layers-cells")
    features = _kept(features if features is not None else counts.select("gene_id").distinct(), "layers-features")
    c = ranked(cells, cells_by, "place").select("*", F.floor(F.col("place") / width).alias("block"), (F.col("place") % width).cast("int").alias("slot")).drop("place")
    f = ranked(features, features_by, "place").withColumn("gene_index", F.col("place").cast("int")).drop("place")
    c.sort("block", "slot").write.parquet(f"{path}/cells")
    f.sort("gene_index").write.parquet(f"{path}/features")
    spark = counts.sparkSession
    c, f = spark.read.parquet(f"{path}/cells").select("cell_id", "block", "slot"), spark.read.parquet(f"{path}/features").select("gene_id", "gene_index")
    entries = counts.join(f, "gene_id").join(c, "cell_id")
    pair = F.array_sort(F.collect_list(F.struct("gene_index", "count")))  # of one cell and layer
    filled = entries.groupBy("layer", "block", "slot").agg(pair.alias("pairs"))
    sizes = c.groupBy("block").agg((F.max("slot") + 1).alias("n"))
    layers = [r["layer"] for r in counts.select("layer").distinct().limit(1001).collect()]
    if len(layers) > 1000:
        raise ValueError("more than 1000 layers")
    empty = sizes.select(F.explode(F.array(*[F.lit(x) for x in sorted(layers)]) if layers else F.array().cast("array<string>")).alias("layer"), "block", "n")
    slots = filled.groupBy("layer", "block").agg(F.map_from_entries(F.collect_list(F.struct("slot", "pairs"))).alias("by_slot"))  # `width` cells
    none = F.array().cast("array<struct<gene_index:int,count:double>>")
    lists = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.coalesce(F.try_element_at("by_slot", i), none))
    blocks = empty.join(slots, ["layer", "block"], "left").select("layer", "block", lists.alias("lists"))
    before = F.transform(F.sequence(F.lit(0), F.size("lists")), lambda i: F.aggregate(F.slice("lists", F.lit(1), i), F.lit(0), lambda a, x: a + F.size(x)))
    flat = F.flatten("lists")
    out = blocks.select("layer", "block", before.alias("pointers"), F.transform(flat, lambda e: e["gene_index"]).alias("indices"), F.transform(flat, lambda e: e["count"]).alias("values"))
    _write_blocks(out, path)


def _write_blocks(blocks: DataFrame, path: str) -> None:
    blocks.repartitionByRange("layer", "block").sortWithinPartitions("layer", "block").write.option("parquet.block.size", 64 << 20).partitionBy("layer").parquet(f"{path}/blocks")


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/cells")


def read_blocks(spark: SparkSession, path: str, layers: list[str] | None = None, blocks: list[int] | None = None) -> DataFrame:
    df = spark.read.schema("block long, pointers array<int>, indices array<int>, `values` array<double>, layer string").parquet(f"{path}/blocks")
    if layers is not None:
        df = df.where(F.col("layer").isin(layers))
    return df if blocks is None else df.where(F.col("block").isin(blocks))


def read_layers(spark: SparkSession, path: str, layers: list[str] | None = None, cells: list[str] | None = None) -> DataFrame:
    """cell_id, gene_id, layer, count of some layers and cells, or of all."""
    names = read_cells(spark, path).select("cell_id", "block", "slot")
    at = None
    if cells is not None:
        names = names.where(F.col("cell_id").isin(cells))
        at = [r["block"] for r in names.select("block").distinct().collect()]  # at most one a cell that was asked for
    df = read_blocks(spark, path, layers, at)
    slots = F.transform(F.sequence(F.lit(0), F.size("pointers") - 2), lambda i: F.struct(i.alias("slot"), F.get("pointers", i).alias("a"), (F.get("pointers", i + 1) - F.get("pointers", i)).alias("n")))
    per_cell = df.where(F.size("pointers") > 1).select("layer", "block", "indices", "values", F.posexplode(slots).alias("slot", "s")).where("s.n > 0")
    named = per_cell.join(names, ["block", "slot"]).select("layer", "cell_id", F.arrays_zip(F.slice("indices", F.col("s.a") + 1, F.col("s.n")).alias("g"), F.slice("values", F.col("s.a") + 1, F.col("s.n")).alias("v")).alias("e"))
    long = named.select("layer", "cell_id", F.explode("e").alias("e")).select("layer", "cell_id", F.col("e.g").alias("gene_index"), F.col("e.v").alias("count"))
    return long.join(spark.read.parquet(f"{path}/features").select("gene_index", "gene_id"), "gene_index").select("cell_id", "gene_id", "layer", "count")


def merge_layers(spark: SparkSession, paths: list[str], path: str, cell_name=None) -> None:
    """The cells of all matrices, side by side, over all their features; of a feature that several know, the columns of the first.

    cell_name, if given, makes a cell's new name of its old one (a column of a column).
    """
    if exists(spark, path):
        raise FileExistsError(path)
    parts = [spark.read.parquet(f"{p}/features") for p in paths]
    columns = list(dict.fromkeys(c for p in parts for c in p.columns if c != "gene_index"))
    several = [p.withColumn("__file", F.lit(i)) for i, p in enumerate(parts)]
    every = several[0]
    for p in several[1:]:
        every = every.unionByName(p, allowMissingColumns=True)
    every = _kept(every, "layers-features")
    one = every.groupBy("gene_id").agg(*[F.min_by(c, "__file").alias(c) for c in columns if c != "gene_id"])
    ranked(_kept(one, "layers-features"), "gene_id", "place").select(*columns, F.col("place").cast("int").alias("gene_index")).sort("gene_index").write.parquet(f"{path}/features")
    new = spark.read.parquet(f"{path}/features").select("gene_id", F.col("gene_index").alias("new"))
    if new.count() > MOST_FEATURES:
        raise ValueError(f"more than {MOST_FEATURES} features")
    pair = F.array_sort(F.collect_list(F.struct("gene_index", "new")))
    places = every.select("gene_id", "gene_index", "__file").join(new, "gene_id").groupBy("__file").agg(F.transform(pair, lambda x: x["new"]).alias("places"))  # a row a matrix
    first, cells, blocks = 0, None, None
    for i, p in enumerate(paths):
        c, b = read_cells(spark, p), read_blocks(spark, p)
        c = c.withColumn("block", F.col("block") + first)
        b = b.select("layer", (F.col("block") + first).alias("block"), "pointers", "indices", "values", F.lit(i).alias("__file"))
        last = c.agg(F.max("block")).first()[0]
        first = first if last is None else last + 1
        cells = c if cells is None else cells.unionByName(c, allowMissingColumns=True)
        blocks = b if blocks is None else blocks.unionByName(b)
    if cell_name is not None:
        cells = cells.withColumn("cell_id", cell_name(F.col("cell_id")))
    cells.write.parquet(f"{path}/cells")
    looked_up = F.transform("indices", lambda g: F.get("places", g))
    _write_blocks(blocks.join(F.broadcast(places), "__file").select("layer", "block", "pointers", looked_up.alias("indices"), "values"), path)


def behind_colon(name):
    """The part of a cell's name behind the first colon, or the name."""
    return F.when(F.contains(name, F.lit(":")), F.split_part(name, F.lit(":"), F.lit(2))).otherwise(name)
