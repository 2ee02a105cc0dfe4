"""Lines of text files in the order in which they stand, whatever splits the files are read in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def numbered_lines(spark: SparkSession, path: str | list[str], blank: bool = True, only: list[str] | None = None, **options) -> DataFrame:
    """file, nth (the file's place from 1 among those with lines), in_file (the line's number from 0 in its file), line (its
    number from 0 with all files laid end to end in order of their names), value.  Without `blank`, lines of white space neither
    count nor come; with `only`, the files of these names are all there are.

    A first pass counts the lines of each split; running sums over a file's splits, then over the files, tell how many
    stand before a split.  In the second pass a line's number is that sum and its place in its split, so no line is sorted.
    The sums are a row a split, as many as the driver lists, and are broadcast: left to choose, Spark takes the lines for the
    smaller side where their files are packed, and sends all of them to every task.
    """
    text = spark.read.options(**options).text(path)
    if only is not None:
        text = text.where(F.col("_metadata.file_path").isin(only))
    raw = (text if blank else text.where(F.trim("value") != "")).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value", F.monotonically_increasing_id().alias("id"))
    splits = raw.groupBy("file", "at").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    of_file = Window.partitionBy("file")
    behind = of_file.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "at", "first", F.coalesce(F.sum("n").over(behind), F.lit(0)).alias("before"), F.sum("n").over(of_file).alias("all"))
    files = splits.select("file", "all").distinct().select("file", F.coalesce(F.sum("all").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("files_before"), F.row_number().over(Window.orderBy("file")).alias("nth"))  # a row a file
    known = splits.join(files, "file").select("file", "at", "first", "before", "files_before", "nth")
    in_file = F.col("before") + F.col("id") - F.col("first")
    return raw.join(F.broadcast(known), ["file", "at"]).select("file", "nth", in_file.alias("in_file"), (F.col("files_before") + in_file).alias("line"), "value")


def csv_rows(spark: SparkSession, path: str, index: str) -> DataFrame:
    """The columns (as strings) of a CSV file with a header, or of a folder of such parts, and the place of each row from 0 in
    `index`: rows of all parts in order of their names, then in file order.  A quoted field does not go over lines."""
    schema = spark.read.csv(path, header=True).schema
    lines = numbered_lines(spark, path, blank=False)
    parsed = F.from_csv("value", ", ".join(f"`{f.name}` string" for f in schema), {"mode": "FAILFAST"})
    rows = lines.where("in_file > 0")  # a file begins with its head
    return rows.select((F.col("line") - F.col("nth")).alias(index), *[parsed.getField(f.name).alias(f.name) for f in schema])
