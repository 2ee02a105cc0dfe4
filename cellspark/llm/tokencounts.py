"""Token counts of documents in flat, unindexed token files.

A flat file is nothing but ids, each document followed by the end-of-document id.  Files are cut in blocks of ids without
regard to documents; a block is searched for the end id in one vectorised comparison.  A prefix scan over a file's blocks
gives each block the place of the last end before it and the number of documents before it, which stitches documents that
span blocks, however many.  The scan goes by levels: groups of FAN neighbouring blocks are scanned apart from each other,
each gives one row of sums to the level above, and what that finds before a group is added to its blocks.  So no task holds
more than FAN blocks of one file in order, however large the file is.

Cases: a document may be empty (two ends in a row), span many blocks, or end exactly at a block's end; ids after the last
end are an unfinished document, reported with finished = false; an empty file has no documents; a trailing part of an id
is an error.  Writing: a null text is empty; repeated rows are repeated; other columns are not touched.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import filled, kept_in_worker, lean, scratch, slices, stored, table
from .tokenstore import ChunkEncoder, tokenizer_path

BLOCK_IDS = 1 << 19
MAX_FILE = 256 << 20
#: Neighbouring rows of a level that are scanned together.
FAN = 64
END = 49407


def write_flat(docs: DataFrame, path: str, tokenizer: str, end_id: int = END, dtype: str = "<u2", id_col: str = "doc_id", text_col: str = "text", max_file: int = MAX_FILE) -> DataFrame:
    """Write flat files below path (any store that Arrow opens by its address), one or more a partition.

    -> doc_id, file, ordinal of every document, as written.  A repeated task writes the same files again under the same
    names, each moved into place when whole.
    """
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    end = np.array([end_id], dtype).tobytes()

    def run(batches):
        store, root = open_store(path)
        store.create_dir(root, recursive=True)
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        enc = kept_in_worker(("plain", tokenizer, dtype), lambda: ChunkEncoder(tokenizer, dtype, plain=True))
        number, out, size, ordinal = 0, None, 0, 0

        def close():
            out.close()
            store.move(f"{root}/.{part}-{number}-{attempt}", f"{root}/{part:06d}-{number:04d}.bin")

        for batch in batches:
            texts = filled(batch, "text")
            for lo, hi in slices(texts):
                files, places = [], []
                for ids in enc.encode(texts.slice(lo, hi - lo)):
                    if out is not None and size >= max_file:
                        close()
                        number, out = number + 1, None
                    if out is None:
                        out, size, ordinal = store.open_output_stream(f"{root}/.{part}-{number}-{attempt}"), 0, 0
                    out.write(ids + end)
                    size += len(ids) + len(end)
                    files.append(f"{part:06d}-{number:04d}.bin")
                    places.append(ordinal)
                    ordinal += 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(files, pa.string()), pa.array(places, pa.int64())], names=["doc_id", "file", "ordinal"])
        if out is not None:
            close()

    return stored(narrow.mapInArrow(lean(run, keeps=True), f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, file string, ordinal long"), "flat-keys")


def open_store(path: str):
    """(the store that Arrow opens for the address, the path in it)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else re.sub("^(file:)?/*", "file:///", path))


def read_blocks(spark: SparkSession, path: str, width: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """file, block, ids (bytes) of the flat files below path, of any size: blocks are byte ranges, dealt over the tasks and
    read there; Spark only lists the files."""
    step = block_ids * width
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(path).select("path", "length").where("length > 0")
    blocks = files.select("path", "length", F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / step).cast("long"))).alias("block"))

    def read(batches):
        held, source = None, None
        for batch in batches:
            for name, length, block in zip(*[c.to_pylist() for c in batch.columns]):
                if name != held:
                    if source is not None:
                        source.close()
                    store, at = open_store(name)
                    held, source = name, store.open_input_file(at)
                ids = source.read_at(min(step, length - block * step), block * step)
                yield pa.RecordBatch.from_arrays([pa.array([name.rpartition("/")[2]]), pa.array([block], pa.int64()), pa.array([ids], pa.binary())], names=["file", "block", "ids"])
        if source is not None:
            source.close()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # neighbouring blocks of a file go to one task, so a file is opened once by it
    dealt = blocks.repartition(parts, "path", F.floor(F.col("block") / 8)).sortWithinPartitions("path", "block")
    return dealt.mapInArrow(lean(read), "file string, block long, ids binary")


def before(rows: DataFrame, top: int, fan: int = FAN, keep: tuple[str, ...] = ()) -> DataFrame:
    """A prefix scan by levels.  rows: file, at (from 0, no gaps, up to `top`), n (ids), docs, last (place of the last end in the
    row, or null) -> file, at, keep, base, docs and open (ids, documents and the last end's place before the row; -1 for none),
    closing (whether it is the file's last row)."""
    group = Window.partitionBy("file", "group").orderBy("at")
    earlier = group.rowsBetween(Window.unboundedPreceding, -1)
    summed = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    near = rows.withColumn("group", F.floor(F.col("at") / fan)).withColumns({"base": summed("n"), "seen": summed("docs"), "closing": F.lead("at").over(group).isNull()})
    near = near.withColumn("end", F.col("base") + F.col("last")).withColumn("open", F.max("end").over(earlier))
    if top < fan:
        return near.select("file", "at", *keep, "base", F.col("seen").alias("docs"), F.coalesce("open", F.lit(-1)).alias("open"), "closing")
    # ends are counted from their group's begin, which the rows before them in it give
    sums = near.select("file", "group", "n", "docs", "end").groupBy("file", "group").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.max("end").alias("last"))
    far = before(sums.withColumnRenamed("group", "at"), top // fan, fan).select("file", F.col("at").alias("group"), F.col("base").alias("far_base"), F.col("docs").alias("far_docs"), F.col("open").alias("far_open"), F.col("closing").alias("far_closing"))
    # the rows lie by file and group already, so the merge moves the groups' sums only
    both = near.join(far.hint("merge"), ["file", "group"])
    return both.select("file", "at", *keep, (F.col("far_base") + F.col("base")).alias("base"), (F.col("far_docs") + F.col("seen")).alias("docs"), F.coalesce(F.col("far_base") + F.col("open"), F.col("far_open")).alias("open"), (F.col("closing") & F.col("far_closing")).alias("closing"))


def count_tokens(blocks: DataFrame, end_id: int = END, dtype: str = "<u2", fan: int = FAN) -> DataFrame:
    """blocks: file, block (numbered from 0), ids -> file, ordinal, start (in ids of the file), n_tokens, finished."""

    def search(batches):
        for batch in batches:
            n, ends, last = [], [], []
            for x in batch.column(2):
                ids = np.frombuffer(x.as_buffer(), dtype)
                at = np.flatnonzero(ids == end_id).astype("<i4")
                n.append(len(ids))
                ends.append(at.tobytes())
                last.append(int(at[-1]) if len(at) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(ends, pa.binary()), pa.array(last, pa.int64())], names=["file", "block", "n", "ends", "last"])

    searched = blocks.select("file", F.col("block").cast("long").alias("block"), "ids").mapInArrow(lean(search), "file string, block long, n long, ends binary, last long")
    found = stored(searched.withColumnRenamed("block", "at").withColumn("docs", (F.length("ends") / 4).cast("long")), "flat-ends")
    top = found.agg(F.max("at")).first()[0] or 0
    placed = before(found, top, fan, ("ends", "n")).select("file", "ends", "n", "base", "open", "docs", "closing")

    def stitch(batches):
        for batch in batches:
            for file, ends, n, base, open_, docs, closing in zip(*[c.to_pylist() for c in batch.columns]):
                at = np.frombuffer(ends, "<i4").astype(np.int64) + base
                prev = np.concatenate([[open_], at])
                size = np.diff(prev) - 1
                starts, done = prev[:-1] + 1, np.ones(len(at), bool)
                if closing and base + n - 1 > prev[-1]:
                    size, starts, done = np.append(size, base + n - 1 - prev[-1]), np.append(starts, prev[-1] + 1), np.append(done, False)
                yield pa.RecordBatch.from_arrays([pa.array([file] * len(size), pa.string()), pa.array(docs + np.arange(len(size)), pa.int64()), pa.array(starts, pa.int64()), pa.array(size, pa.int64()), pa.array(done)], names=["file", "ordinal", "start", "n_tokens", "finished"])

    return placed.mapInArrow(lean(stitch), "file string, ordinal long, start long, n_tokens long, finished boolean")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "flat-tokens")
    keys = write_flat(table(spark, sf_dir, "documents"), path, tokenizer_path())
    counted = count_tokens(read_blocks(spark, path, 2))
    # both sides hold a row a document, so neither is small enough to be broadcast; their keys are unique
    return keys.join(counted.hint("merge"), ["file", "ordinal"]).select("doc_id", "n_tokens")
