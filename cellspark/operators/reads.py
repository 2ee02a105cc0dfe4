"""Attaching cell and molecule barcodes to read pairs."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import read_name
from ..functions.sequences import trim_after_primer, trim_mate1
from .barcodes import correct


@dataclass(frozen=True)
class Layout:
    """Lengths of the barcodes in a read."""

    ligation: int = 10
    umi: int = 8
    rt: int = 10
    poly_t: int = 15
    min_rt_trim: int = 5
    min_length: int = 20

    def __post_init__(self) -> None:
        if min(self.ligation, self.umi, self.rt, self.poly_t) <= 0 or not 0 < self.min_rt_trim <= self.rt:
            raise ValueError("barcode lengths must be positive and min_rt_trim at most rt")


def zip_mates(r1: DataFrame, i5: DataFrame, r2: DataFrame) -> DataFrame:
    """One row a fragment from three read tables with (prefix, read_no, name, seq, qual), by record number.  R1 leads; records that another file lacks hold nulls."""
    on = ["prefix", "read_no"]
    pick = lambda d, p: d.select(*on, F.col("seq").alias(f"{p}_seq"), F.col("qual").alias(f"{p}_qual"))
    return r1.select(*on, "name", F.col("seq").alias("r1_seq"), F.col("qual").alias("r1_qual")).join(pick(i5, "i5"), on, "left").join(pick(r2, "r2"), on, "left")


def tag(fragments: DataFrame, ligations: DataFrame, rts: DataFrame, primers: DataFrame, layout: Layout = Layout(), r2_trim: str = "suffix") -> DataFrame:
    """Fragments whose ligation and RT barcodes are known, trimmed; `long_enough` says whether both mates reach the least length."""
    cut = fragments.withColumn("__lig", F.substring("i5_seq", 1, layout.ligation)).withColumn("umi", F.substring("r1_seq", 1, layout.umi)).withColumn("__rt", F.substring("r1_seq", layout.umi + 1, layout.rt))
    known = correct(correct(cut, ligations, "__lig", "ligation"), rts, "__rt", "rt").drop("__lig", "__rt")
    kinds = primers.select("rt", "is_randomn").distinct()
    known = known.join(F.broadcast(kinds) if kinds.limit(100_001).count() <= 100_000 else kinds, "rt", "left").withColumn("is_randomn", F.coalesce("is_randomn", F.lit(False)))
    mate1 = lambda c: trim_mate1(F.col(c), F.col("is_randomn"), layout.umi, layout.rt, layout.poly_t)
    r2 = trim_after_primer(F.col("r2_seq"), F.col("rt"), layout.min_rt_trim, layout.rt - 1, r2_trim)
    out = known.withColumn("__r2", r2).withColumn("__q1", mate1("r1_qual")).withColumn("r1_seq", mate1("r1_seq")).withColumn("r1_qual", F.col("__q1"))
    ahead = F.length("r2_seq") - F.length("__r2")
    from_left = F.endswith(F.col("r2_seq"), F.col("__r2")) & (ahead > 0) if r2_trim == "suffix" else F.lit(False)
    out = out.withColumn("r2_qual", F.when(from_left & F.contains(F.col("r2_seq"), F.col("__r2")), F.substring(F.col("r2_qual"), ahead + 1, F.length("__r2"))).otherwise(F.substring(F.col("r2_qual"), F.lit(1), F.length("__r2"))))
    out = out.withColumn("r2_seq", F.col("__r2")).drop("__r2", "__q1")
    return out.withColumn("long_enough", long_enough(F.col("r1_seq"), F.col("r2_seq"), layout))


def named(tagged: DataFrame) -> DataFrame:
    """Records for a text sink: prefix, name, r1_seq, r1_qual, r2_seq, r2_qual of fragments that are long enough."""
    name = read_name(F.col("ligation"), F.col("rt"), F.col("umi"), F.col("name"))
    return tagged.where("long_enough").select("prefix", name.alias("name"), "r1_seq", "r1_qual", "r2_seq", "r2_qual")


def trim_quality(seq: Column, qual: Column, least: int = 20) -> Column:
    """Bases of seq that stay when its 3' end is cut by quality: at the place behind which the sum of (least - quality) is
    largest, looked for from the end until the sum falls below zero."""
    codes = F.reverse(F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33))
    first = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("top"), F.lit(0).alias("cut"), F.lit(0).alias("at"), F.lit(False).alias("over"))

    def step(acc: Column, q: Column) -> Column:
        total = acc["sum"] + least - q
        over = acc["over"] | (total < 0)
        better = ~over & (total > acc["top"])
        return F.struct(total.alias("sum"), F.when(better, total).otherwise(acc["top"]).alias("top"), F.when(better, acc["at"] + 1).otherwise(acc["cut"]).alias("cut"), (acc["at"] + 1).alias("at"), over.alias("over"))

    return F.length(seq) - F.aggregate(codes, first, step, lambda acc: acc["cut"])


def adapter_at(texts: list[str | None], adapter: str, least: int, error_rate: float) -> list[int | None]:
    """For each read the leftmost place from which it matches the adapter, whole or to the read's end, or its length.

    All reads are compared at once, a base of the adapter at a time; beyond a read's end nothing is compared.
    """
    size = np.array([len(t or "") for t in texts])
    width, k = int(size.max(initial=0)), len(adapter)
    if not width:
        return [None if t is None else 0 for t in texts]
    base = np.zeros((len(texts), width + k), np.uint8)
    inside = np.arange(width) < size[:, None]
    base[:, :width][inside] = np.frombuffer("".join(t or "" for t in texts).encode("latin-1", "replace"), np.uint8)
    wrong = np.zeros((len(texts), width), np.int16)
    for j, c in enumerate(adapter.encode()):
        wrong += (base[:, j : j + width] != c) & (np.arange(j, j + width) < size[:, None])
    there = np.minimum(size[:, None] - np.arange(width), k)  # bases compared from each place
    allowed = np.array([int(error_rate * n) for n in range(k + 1)])
    hit = (there >= least) & (wrong <= allowed[np.maximum(there, 0)])
    at = np.where(hit.any(1), hit.argmax(1), size)
    return [None if t is None else int(i) for t, i in zip(texts, at)]


def _bases(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(a row of bytes a read, sizes); 0 behind a read's end."""
    size = np.array([len(t or "") for t in texts], np.int64)
    base = np.zeros((len(texts), int(size.max(initial=0))), np.uint8)
    base[np.arange(base.shape[1]) < size[:, None]] = np.frombuffer("".join(t or "" for t in texts).encode("latin-1", "replace"), np.uint8)
    return base, size


def adapter_ends(base: np.ndarray, size: np.ndarray, adapter: str, least: int, error_rate: float) -> np.ndarray:
    """Which reads hold the adapter with gaps: bit-parallel edit distances of the adapter, in one machine word, against every
    stretch of a read; all reads go a base at a time."""
    k, n = len(adapter), len(size)
    one, high = np.uint64(1), np.uint64(1) << np.uint64(k - 1)
    where = np.zeros(256, np.uint64)
    for j, c in enumerate(adapter.encode()):
        where[c] |= one << np.uint64(j)
    up, down = np.full(n, (1 << k) - 1, np.uint64), np.zeros(n, np.uint64)  # steps of +1 and -1 down the column
    cost = np.full(n, k)
    hit = np.zeros(n, bool)
    with np.errstate(over="ignore"):
        for i in range(base.shape[1]):
            live = size > i
            eq = where[base[:, i]]
            zero = (((eq & up) + up) ^ up) | eq | down
            right_up, right_down = down | ~(zero | up), up & zero
            cost += np.where(live, ((right_up & high) != 0).astype(int) - ((right_down & high) != 0), 0)
            right_up, right_down = right_up << one, right_down << one  # a match may begin anywhere
            up = np.where(live, right_down | ~(zero | right_up), up)
            down = np.where(live, right_up & zero, down)
            hit |= live & (cost <= int(error_rate * k)) & (k >= least)
    total = np.zeros(n, np.int64)
    for j in range(1, k):  # the adapter's beginnings at the reads' ends
        bit = one << np.uint64(j - 1)
        total += ((up & bit) != 0).astype(np.int64) - ((down & bit) != 0)
        hit |= (j >= least) & (total <= int(error_rate * j)) & (size > 0)
    return hit


def adapter_with_gaps(texts: list[str | None], adapter: str, least: int, error_rate: float) -> list[int | None]:
    """For each read the leftmost beginning of an accepted match with the adapter, or its length.

    A match is a stretch of the read that is at most error_rate * m edits (changed, inserted, deleted bases) away from the
    whole adapter, or, at the read's end, from its first m bases, m >= least.  Of the stretches with one end the one of the
    fewest edits counts, then the longest.
    """
    k = len(adapter)
    if not 1 <= k <= 63:
        raise ValueError("an adapter has 1 to 63 bases")
    base, size = _bases(texts)
    at, some = size.copy(), np.flatnonzero(adapter_ends(base, size, adapter, least, error_rate))
    if len(some):
        base, size = base[some], size[some]
        step = np.arange(k + 1, dtype=np.int64)[:, None] << 32  # edits in the high half, the beginning in the low one
        letters = np.frombuffer(adapter.encode(), np.uint8)[:, None]
        col = np.broadcast_to(step, (k + 1, len(some))).copy()
        found = size.copy()
        begin = lambda v: v & 0xFFFFFFFF

        def end_of_read(now: np.ndarray) -> None:
            for j in range(least, k):
                ok = now & ((col[j] >> 32) <= int(error_rate * j))
                found[ok] = np.minimum(found[ok], begin(col[j])[ok])

        for i in range(base.shape[1]):
            new = np.empty_like(col)
            new[0] = i + 1
            new[1:] = np.minimum(col[:-1] + ((letters != base[:, i]).astype(np.int64) << 32), col[1:] + (1 << 32))
            col = np.minimum.accumulate(new - step, 0) + step  # deleted bases of the adapter
            whole = (size > i) & ((col[k] >> 32) <= int(error_rate * k)) & (k >= least)
            found[whole] = np.minimum(found[whole], begin(col[k])[whole])
            end_of_read(size == i + 1)
        at[some] = found
    return [None if t is None else int(i) for t, i in zip(texts, at)]


def trim_adapter(reads: DataFrame, column: str, adapter: str, least: int = 3, error_rate: float = 0.1, qual: str | None = None, gaps: bool = False) -> DataFrame:
    """Cut a 3' adapter from `column`: the leftmost place from which the read matches the adapter, whole or to the read's
    end, with at least `least` bases and at most error_rate mismatches, or with `gaps` that many edits (adapter_with_gaps);
    the qualities in `qual` are cut alike.  Places are found in Arrow batches, a whole batch at once."""
    find = adapter_with_gaps if gaps else adapter_at

    @F.pandas_udf("int")
    def place(seqs: pd.Series) -> pd.Series:
        return pd.Series(find(seqs.tolist(), adapter, least, error_rate), index=seqs.index, dtype="Int32")

    out = reads.withColumn("__at", place(column))
    cut = lambda c: F.substring(F.col(c), F.lit(1), F.col("__at"))
    return out.withColumns({c: cut(c) for c in (column, qual) if c}).drop("__at")


def trim_pairs(fragments: DataFrame, adapter1: str = "AGATCGGAAGAGC", adapter2: str = "AAAAAAAA", quality: int = 20, least: int = 3, shortest: int = 20, gaps: bool = False) -> DataFrame:
    """r1 and r2 cut by quality, then by adapter (with gaps, if asked for); pairs of which a mate is left shorter than `shortest` go."""
    for mate, adapter in (("r1", adapter1), ("r2", adapter2)):
        seq, qual = f"{mate}_seq", f"{mate}_qual"
        keep = fragments.withColumn("__keep", trim_quality(F.col(seq), F.col(qual), quality))
        short = lambda c: F.substring(F.col(c), F.lit(1), F.col("__keep"))
        fragments = trim_adapter(keep.withColumns({seq: short(seq), qual: short(qual)}).drop("__keep"), seq, adapter, least, qual=qual, gaps=gaps)
    return fragments.where((F.length("r1_seq") >= shortest) & (F.length("r2_seq") >= shortest))


def long_enough(r1: Column, r2: Column, layout: Layout = Layout()) -> Column:
    return (F.length(r1) >= layout.min_length) & (F.length(r2) >= layout.min_length)


def read_counts(tagged_left: DataFrame) -> DataFrame:
    """prefix, metric, value: reads_total, reads_barcode_passed, reads_length_passed from rows with ligation, rt (null for misses) and long_enough."""
    hit = F.col("ligation").isNotNull() & F.col("rt").isNotNull()
    wide = tagged_left.groupBy("prefix").agg(F.count("*").alias("reads_total"), F.count_if(hit).alias("reads_barcode_passed"), F.count_if(hit & F.col("long_enough")).alias("reads_length_passed"))
    return wide.unpivot("prefix", ["reads_total", "reads_barcode_passed", "reads_length_passed"], "metric", "value")
