"""Error-tolerant barcode whitelists and the lookup join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import decode_sample
from ..functions.sequences import one_mismatch, reverse_complement

#: A whitelist of a run has some ten thousand rows; beyond this it is joined by shuffle.
MAX_BROADCAST = 2_000_000


def whitelist(barcodes: DataFrame, column: str = "barcode", complement: bool = False) -> DataFrame:
    """variant, barcode: each barcode with all its single substitutions."""
    b = reverse_complement(F.col(column)) if complement else F.col(column)
    return barcodes.select(b.alias("barcode")).distinct().select(F.explode(one_mismatch(F.col("barcode"))).alias("variant"), "barcode")


def whitelist_check(wl: DataFrame) -> DataFrame:
    """n_barcodes, n_variants, n_distinct, ratio, is_clean: whether no two barcodes share a variant."""
    out = wl.agg(F.countDistinct("barcode").alias("n_barcodes"), F.count("*").alias("n_variants"), F.countDistinct("variant").alias("n_distinct"))
    return out.select("*", F.try_divide("n_distinct", "n_barcodes").alias("ratio"), (F.col("n_variants") == F.col("n_distinct")).alias("is_clean"))


def correct(reads: DataFrame, wl: DataFrame, column: str, to: str, how: str = "inner") -> DataFrame:
    """reads with `to`: the barcode that `column` is a variant of.  Misses go (inner) or stay with null (left)."""
    side = wl.select(F.col("variant").alias(column), F.col("barcode").alias(to))
    small = wl.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST
    return reads.join(F.broadcast(side) if small else side, column, how)


def primers(rt_table: DataFrame) -> DataFrame:
    """sample, rt, is_randomn, shortdt: one row a primer of each well."""
    kinds = F.array(F.struct(F.col("shortdt").alias("rt"), F.lit(False).alias("is_randomn")), F.struct(F.col("randomn").alias("rt"), F.lit(True).alias("is_randomn")))
    return rt_table.select("sample", "shortdt", F.explode(kinds).alias("p")).select("sample", "p.rt", "p.is_randomn", "shortdt")


def rt_table(randomn: DataFrame, dt: DataFrame, species: str | None = None, drop_null: bool = True) -> DataFrame:
    """well, sample, shortdt, randomn (and the species flags) from the two sheets, joined on well."""
    both = randomn.select("well", F.col("sample").alias("__s"), F.col("barcode").alias("randomn")).join(dt.select("well", F.col("barcode").alias("shortdt")), "well")
    if drop_null:
        both = both.na.drop()
    parts: dict[str, Column] = decode_sample(F.col("__s"))
    out = both.select("well", parts["sample"].alias("sample"), "shortdt", "randomn", parts["human"].alias("human"), parts["mouse"].alias("mouse"))
    return out.where(F.col(species)) if species else out
