"""Column functions on nucleotide sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LETTERS = "ATCGN"


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ATCGN", "TAGCN"))


def one_mismatch(seq: Column, keep_original: bool = True) -> Column:
    """array<string>: every single substitution from LETTERS (none equal to seq), with seq itself in front if asked for."""
    letters = F.array(*[F.lit(c) for c in LETTERS])
    at = lambda i: F.filter(
        F.transform(letters, lambda c: F.concat(F.substring(seq, F.lit(1), i - 1), c, F.substring(seq, i + 1, F.length(seq)))), lambda v: v != seq
    )
    found = F.when(F.length(seq) > 0, F.flatten(F.transform(F.sequence(F.lit(1), F.length(seq)), at))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.array(seq), found) if keep_original else found


def trim_after_primer(r2: Column, rt: Column, shortest: int = 5, longest: int = 9, keep: str = "suffix") -> Column:
    """Mate 2 against the reverse complement of the RT barcode.

    Where it occurs whole, the mate is kept from that site on (keep="suffix") or up to it ("prefix"); else the longest
    beginning of it, of `longest` to `shortest` bases, that ends the mate is cut off.
    """
    rc = reverse_complement(rt)
    site = F.instr(r2, rc)
    whole = F.substring(r2, site, F.length(r2)) if keep == "suffix" else F.substring(r2, F.lit(1), site - 1)
    tail = F.coalesce(*[F.when(F.endswith(r2, F.substring(rc, 1, i)), F.lit(i)) for i in range(longest, shortest - 1, -1)], F.lit(0))
    return F.when(site > 0, whole).otherwise(F.substring(r2, F.lit(1), F.length(r2) - tail))


def trim_mate1(seq: Column, is_randomn: Column, umi: int = 8, rt: int = 10, poly_t: int = 15) -> Column:
    """Cut UMI and RT barcode, and the poly-T stretch of short-dT primers, from the left."""
    return F.when(is_randomn, F.substring(seq, F.lit(umi + rt + 1), F.length(seq))).otherwise(F.substring(seq, F.lit(umi + rt + poly_t + 1), F.length(seq)))
