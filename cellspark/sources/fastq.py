"""FASTQ files, gzip or plain, numbered by record, whatever bytes a split begins at."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FASTQ = "prefix string, read_no long, name string, seq string, qual string"
HEAD = 3


def _runs(batch: pa.RecordBatch):
    """(file, start of split, lines) of neighbouring rows of one split."""
    files = batch.column(0).dictionary_encode()
    code, at = files.indices.to_numpy(zero_copy_only=False), batch.column(1).to_numpy()
    begin = 0
    for end in [*(np.flatnonzero((code[1:] != code[:-1]) | (at[1:] != at[:-1])) + 1).tolist(), len(code)]:
        if end > begin:
            yield files.dictionary[int(code[begin])].as_py(), int(at[begin]), batch.column(2).slice(begin, end - begin)
        begin = end


def read_fastq(spark: SparkSession, path: str, suffix: str = r"_R[123]\.fastq(\.gz)?$") -> DataFrame:
    """prefix (file name without suffix), read_no (from 0 in each file), name, seq, qual.

    Plain files are cut anywhere, gzip files nowhere.  A first pass counts each split's lines and keeps its first three; the
    running sum over a file's splits tells each split which line its first one is.  In the second pass a split leaves out
    lines of a record that began before it and takes a last record's missing lines from the splits behind it, so nothing is
    shuffled.  What the driver holds is a number and three lines a split.  A file whose lines are not four a record raises.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")

    def heads(batches):
        now, n, first = None, 0, []
        for batch in batches:
            for file, at, values in _runs(batch):
                if (file, at) != now:
                    if now is not None:
                        yield pa.RecordBatch.from_pylist([{"file": now[0], "at": now[1], "n": n, "first": first}])
                    now, n, first = (file, at), 0, []
                n += len(values)
                first = first + values.slice(0, HEAD - len(first)).to_pylist() if len(first) < HEAD else first
        if now is not None:
            yield pa.RecordBatch.from_pylist([{"file": now[0], "at": now[1], "n": n, "first": first}])

    splits: dict[tuple[str, int], list] = {}  # (lines before, lines that the last record lacks)
    before, rows = {}, lines.mapInArrow(heads, "file string, at long, n long, first array<string>").orderBy("file", "at").collect()
    for i, r in enumerate(rows):
        base = before.get(r["file"], 0)
        before[r["file"]] = base + r["n"]
        lacks, missing, j = -(base + r["n"]) % 4, [], i + 1
        while lacks > len(missing) and j < len(rows) and rows[j]["file"] == r["file"]:
            missing += rows[j]["first"][: lacks - len(missing)]
            j += 1
        splits[r["file"], r["at"]] = [base, missing]
    for file, n in before.items():
        if n % 4:
            raise ValueError(f"{file} holds {n} lines, which are not four a record")
    known = spark.sparkContext.broadcast(splits)

    def records(batches):
        now, line, held = None, 0, None

        def made(values: pa.Array, first: int, file: str):
            """Whole records of lines, the first of which is the file's line `first`, a record's beginning."""
            n = len(values) // 4
            pick = lambda k: values.take(pa.array(np.arange(k, 4 * n, 4)))
            return pa.RecordBatch.from_arrays([pa.array([file] * n, pa.string()), pa.array(np.arange(first // 4, first // 4 + n)), pc.replace_substring_regex(pick(0), "^@", ""), pick(1), pick(3)], names=["file", "read_no", "name", "seq", "qual"])

        def last():
            more = known.value[now][1]
            values = pa.concat_arrays([held, pa.array(more, held.type)]) if len(held) else held
            return made(values, line - len(held), now[0])

        for batch in batches:
            for file, at, values in _runs(batch):
                if (file, at) != now:
                    if now is not None:
                        yield last()
                    now, line = (file, at), known.value[file, at][0]
                    skip = min(-line % 4, len(values))
                    missing = -line % 4 - skip
                    values, line, held = values.slice(skip), line + skip, values.slice(0, 0)
                elif missing:
                    skip = min(missing, len(values))
                    missing -= skip
                    values, line = values.slice(skip), line + skip
                both = pa.concat_arrays([held, values]) if len(held) else values
                whole = len(both) // 4 * 4
                if whole:
                    yield made(both.slice(0, whole), line - len(held), file)
                line += len(values)
                held = both.slice(whole)
        if now is not None:
            yield last()

    out = lines.mapInArrow(records, "file string, read_no long, name string, seq string, qual string")
    return out.select(F.regexp_replace(F.element_at(F.split("file", "/"), -1), suffix, "").alias("prefix"), "read_no", "name", "seq", "qual")


def write_fastq(records: DataFrame, path: str, name: str = "name", seq: str = "seq", qual: str = "qual", compression: str = "gzip") -> None:
    """Text, one directory a prefix where the records have one."""
    text = F.concat_ws("\n", F.concat(F.when(F.startswith(F.col(name), F.lit("@")), "").otherwise("@"), F.col(name)), F.col(seq), F.lit("+"), F.col(qual)).alias("value")
    if "prefix" in records.columns:
        records.select("prefix", text).write.partitionBy("prefix").option("compression", compression).text(path)
    else:
        records.select(text).write.option("compression", compression).text(path)
