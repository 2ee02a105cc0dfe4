"""Column functions on CIGAR strings and alignment flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCKS = "array<struct<start:bigint,end:bigint,part:int>>"


def cigar_blocks(cigar: Column, start: Column) -> Column:
    """The M runs as reference intervals (0-based, half open), numbered by the N-free part they lie in.

    M, D, N, = and X advance on the reference; only M makes a block; each N begins a new part.
    """
    steps = F.arrays_zip(F.regexp_extract_all(cigar, F.lit(r"(\d+)[MIDNSHP=X]"), 1).alias("n"), F.regexp_extract_all(cigar, F.lit(r"\d+([MIDNSHP=X])"), 1).alias("op"))
    first = F.struct(start.cast("long").alias("at"), F.lit(0).alias("part"), F.array().cast(BLOCKS).alias("found"))

    def walk(acc: Column, s: Column) -> Column:
        n, op = s["n"].cast("long"), s["op"]
        end = acc["at"] + n
        return F.struct(
            F.when(op.isin("M", "D", "N", "=", "X"), end).otherwise(acc["at"]).alias("at"),
            F.when(op == "N", acc["part"] + 1).otherwise(acc["part"]).alias("part"),
            F.when(op == "M", F.concat(acc["found"], F.array(F.struct(acc["at"].alias("start"), end.alias("end"), acc["part"].alias("part"))))).otherwise(acc["found"]).alias("found"),
        )

    return F.aggregate(steps, first, walk, lambda acc: acc["found"])


def reference_end(cigar: Column, start: Column) -> Column:
    lengths = F.transform(F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), 1), lambda n: n.cast("long"))
    return start.cast("long") + F.aggregate(lengths, F.lit(0).cast("long"), lambda a, n: a + n)


def flipped(strand: Column) -> Column:
    return F.when(strand == "+", "-").otherwise("+")


def directional_end(start: Column, end: Column, strand: Column) -> Column:
    return F.when(strand == "+", end).otherwise(start - 1)


def passes_sam_filter(flag: Column, mapq: Column, least: int = 30, need: int = 2, none_of: int = 780) -> Column:
    return (mapq >= least) & (flag.bitwiseAND(need) == need) & (flag.bitwiseAND(none_of) == 0)


def natural_key(name: Column) -> Column:
    """A string whose plain order is the natural order of names: digit runs compare as numbers."""
    parts = F.regexp_extract_all(name, F.lit(r"(\d+|\D+)"), 1)
    return F.array_join(F.transform(parts, lambda p: F.when(F.regexp_like(p, F.lit(r"^\d")), F.lpad(p, 20, "0")).otherwise(p)), "")
