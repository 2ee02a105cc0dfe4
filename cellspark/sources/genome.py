"""Genome files from a path or an address: annotation, repeats."""

from __future__ import annotations

import os
import shutil
import tempfile
import urllib.parse
import urllib.request

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .paths import exists, scratch
from .text import read_gtf

#: The table browser that gives repeats as GTF, and the organism of each assembly.
REPEATS_URL = "https://genome.ucsc.edu/cgi-bin/hgTables"
ORGANISM = {"hg38": "Human", "mm39": "Mouse", "mm10": "Mouse"}


def fetch(address: str, to: str, form: dict[str, str] | None = None, timeout: int = 120) -> str:
    """Copy what an address gives into a local file, piece by piece; a web page instead of a file is an error."""
    data = urllib.parse.urlencode(form).encode() if form else None
    with urllib.request.urlopen(address, data=data, timeout=timeout) as answer:
        if "text/html" in (answer.headers.get("Content-Type") or ""):
            raise ValueError(f"{address} gave a web page")
        with open(to, "wb") as f:
            shutil.copyfileobj(answer, f)
    return to


def resolve(spark: SparkSession, path: str) -> str:
    """A path that Spark can read, gzip or plain: the path itself where it is there, a copy in the shared folder of an address."""
    if not path.startswith(("http://", "https://", "ftp://")):
        if not exists(spark, path):
            raise FileNotFoundError(path)
        return path
    name = os.path.basename(urllib.parse.urlparse(path).path)
    return _shared(spark, lambda local: fetch(path, local), name)


def _shared(spark: SparkSession, make, name: str) -> str:
    folder = tempfile.mkdtemp()
    try:
        local = make(os.path.join(folder, name))
        target = f"{scratch(spark, 'genome')}/{name}"
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(target)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).copyFromLocalFile(jvm.org.apache.hadoop.fs.Path(f"file://{local}"), at)
        return target
    finally:
        shutil.rmtree(folder)


def repeats_form(genome: str) -> dict[str, str]:
    """What the table browser is asked for: all repeats of an assembly as GTF."""
    if genome not in ORGANISM:
        raise ValueError(f"genome must be one of {sorted(ORGANISM)}")
    return {
        "hgsid": "0", "clade": "mammal", "org": ORGANISM[genome], "db": genome, "hgta_group": "allTracks", "hgta_track": "rmsk", "hgta_table": "rmsk", "hgta_regionType": "genome",
        "hgta_outputType": "gff", "hgta_outFileName": f"{genome}_rmsk.gtf", "hgta_doTopSubmit": "get output",
    }


def download_repeats(spark: SparkSession, genome: str, address: str = REPEATS_URL) -> str:
    return _shared(spark, lambda local: fetch(address, local, repeats_form(genome)), f"{genome}_rmsk.gtf")


def read_repeats(spark: SparkSession, path: str) -> DataFrame:
    """chrom, start, end, strand, family of a repeat annotation."""
    return read_gtf(spark, path).select("chrom", "start", "end", "strand", F.col("gene_id").alias("family"))
