"""Mapping of reads to reference sequences over a table of minimizers.

    index = mapping.build(reference, k=15, w=10)          # reference: contig, start, seq (pieces of any length)
    placed = mapping.map_reads(reads, index, max_mismatch=0.05)   # reads: read_id, seq

A minimizer is the smallest k-mer, by a hash of its canonical code, of w neighbouring ones; every exact match of w + k - 1
bases holds one.  Reads and reference meet by their minimizers' codes; a code that the reference shows more than MOST times
is cut into parts, each a join key of its own, and none is left out.  A seed names a diagonal (contig, strand, place of the
read's first base); each diagonal is compared once with the reference by all its bases.

A placement is end to end: one diagonal, or ascending diagonals with introns of min_intron to max_intron bases between
blocks of at least `block` bases.  Its cost is its mismatches plus intron_cost for each intron; it may hold
max_mismatch * length mismatches.  Of the places where an intron can stand between two diagonals the one with the fewest
mismatches is taken, then one with a GT-AG motif on either strand, then the first.

Every placement is found if mismatches cut each of its blocks into pieces of which one has w + k - 1 bases, that is if
(block - m) // (m + 1) >= w + k - 1 for m mismatches.  Insertions, deletions and clipped ends are not placed.

Cases: bases other than ACGT match nothing; reads without a seed have no row; null reads neither; equal read ids are one
read only if their sequences are equal (the caller's ids are unique); an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .counts import dealt

TILE = 1 << 16
MOST = 1000
#: Reads a task.
PART = 20_000
#: Rows up to which the table of frequent codes is broadcast.
SMALL = 1_000_000

_CODE = np.full(256, 4, np.uint8)
for _i, _b in enumerate("ACGT"):
    _CODE[ord(_b)] = _CODE[ord(_b.lower())] = _i


@dataclass
class Index:
    """Tables of a reference: seeds (code, part, contig, pos, back), frequent (code, parts), tiles (contig, tile, seq)."""

    k: int
    w: int
    overlap: int
    tile: int
    seeds: DataFrame
    frequent: DataFrame
    tiles: DataFrame


def read_index(spark: SparkSession, path: str) -> Index:
    terms = spark.read.parquet(f"{path}/terms").first()
    return Index(*terms, *[spark.read.parquet(f"{path}/{name}") for name in ("seeds", "frequent", "tiles")])


def _mixed(x: np.ndarray) -> np.ndarray:
    """Hash order of codes, so that runs of one base are no smaller than others."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _slide(x: np.ndarray, w: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each w neighbours, by doubling."""
    got = 1
    while got < w:
        step = min(got, w - got)
        x = pick(x[:-step], x[step:])
        got += step
    return x


def minimizers(seq: bytes, k: int, w: int, windows: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, place, whether the code is that of the reverse strand) of the minimizers of the first `windows` windows; of equal ones in a window all."""
    base = _CODE[np.frombuffer(seq, np.uint8)]
    n = len(base) - k + 1
    windows = max(0, n - w + 1) if windows is None else max(0, min(windows, n - w + 1))
    if not windows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    n = windows + w - 1
    fore, back, bad = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.zeros(n, bool)
    for i in range(k):
        b = base[i : i + n]
        bad |= b > 3
        fore = fore << np.uint64(2) | (b & 3)
        back |= (3 - (b & 3)).astype(np.uint64) << np.uint64(2 * i)
    reverse = back < fore
    code = np.where(reverse, back, fore)
    h = np.where(bad, np.uint64(2**64 - 1), _mixed(code))
    low = _slide(h, w, np.minimum)
    edge = np.zeros(w - 1, np.uint64)  # each place's windows
    chosen = _slide(np.concatenate([edge, low, edge]), w, np.maximum) == h
    at = np.flatnonzero(chosen & ~bad)
    return code[at].astype(np.int64), at, reverse[at]


def tiles(pieces: DataFrame, size: int, overlap: int) -> DataFrame:
    """contig, tile, seq: bases from tile * size on, size + overlap of them or as many as there are.  pieces: contig, start, seq, laid end to end."""
    end = F.col("start") + F.length("seq")
    some = pieces.where(F.length("seq") > 0).select("contig", "start", F.upper("seq").alias("seq"), F.explode(F.sequence(F.greatest(F.floor((F.col("start") - overlap + 1) / size), F.lit(0)), F.floor((end - 1) / size))).alias("tile"))
    lo = F.greatest(F.col("start"), F.col("tile") * size)
    hi = F.least(F.col("start") + F.length("seq"), F.col("tile") * size + size + overlap)
    part = F.struct(lo.alias("at"), F.substring("seq", lo - F.col("start") + 1, hi - lo).alias("s")).alias("part")
    met = some.where(hi > lo).select("contig", "tile", part).groupBy("contig", "tile").agg(F.array_sort(F.collect_list("part")).alias("parts"))  # as many as a tile has pieces
    return met.select("contig", "tile", F.array_join(F.col("parts.s"), "").alias("seq"))


def build(reference: DataFrame, k: int = 15, w: int = 10, longest_read: int = 600, tile: int = TILE, most: int = MOST, path: str | None = None) -> Index:
    """Seeds and tiles of a reference (contig, start, seq), written below path (a folder of its own in the shared folder, if none is given)."""
    from ..sources.paths import scratch

    if k % 2 == 0 or not 3 <= k <= 31:
        raise ValueError("k is odd, from 3 to 31, so that no k-mer is its own reverse complement")
    spark = reference.sparkSession
    path = path or scratch(spark, "mapping-index")
    overlap = max(longest_read, k + w)
    tiles(reference.select("contig", F.col("start").cast("long").alias("start"), "seq"), tile, overlap).write.parquet(f"{path}/tiles")
    stored = spark.read.parquet(f"{path}/tiles")

    def scan(batches):
        for batch in batches:
            for contig, t, seq in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                code, at, back = minimizers(seq.encode(), k, w, tile)
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array([contig] * len(code), pa.string()), pa.array(at + t * tile), pa.array(back)], names=["code", "contig", "pos", "back"])

    found = stored.select("contig", "tile", "seq").mapInArrow(scan, "code long, contig string, pos long, back boolean")
    found.write.parquet(f"{path}/found")
    found = spark.read.parquet(f"{path}/found")
    found.groupBy("code").count().where(F.col("count") > most).select("code", F.ceil(F.col("count") / most).cast("int").alias("parts")).write.parquet(f"{path}/frequent")
    frequent = spark.read.parquet(f"{path}/frequent")
    parts = F.coalesce("parts", F.lit(1))
    seeds = _met(found, frequent).select("code", F.pmod(F.xxhash64("contig", "pos"), parts).cast("int").alias("part"), "contig", "pos", "back")
    seeds.sortWithinPartitions("code").write.parquet(f"{path}/seeds")
    spark.createDataFrame([(k, w, overlap, tile)], "k int, w int, overlap int, tile int").coalesce(1).write.parquet(f"{path}/terms")
    return read_index(spark, path)


def _met(df: DataFrame, frequent: DataFrame) -> DataFrame:
    """Frequent codes are at most one in MOST of the seeds; counted before they are broadcast."""
    return df.join(F.broadcast(frequent) if frequent.count() <= SMALL else frequent, "code", "left")


def revcomp(seq):
    return F.reverse(F.translate(F.upper(seq), "ACGT", "TGCA"))


def diagonals(reads: DataFrame, index: Index) -> DataFrame:
    """read_id, contig, strand, diag: where a read's first base (the last one's complement, on -) would stand, each once."""
    k, w = index.k, index.w

    def scan(batches):
        for batch in batches:
            ids, rows = batch.column(0), []
            for i, seq in enumerate(batch.column(1).to_pylist()):
                code, at, back = minimizers(seq.encode("ascii", "replace"), k, w)
                if len(code):
                    rows.append((np.full(len(code), i), code, at, back, np.full(len(code), len(seq))))
            if rows:
                row, code, at, back, size = (np.concatenate(x) for x in zip(*rows))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), pa.array(code), pa.array(at.astype(np.int64)), pa.array(back), pa.array(size.astype(np.int64))], names=["read_id", "code", "at", "mirrored", "size"])

    kind = reads.schema["read_id"].dataType.simpleString()
    asked = reads.where(F.col("seq").isNotNull()).select("read_id", "seq").mapInArrow(scan, f"read_id {kind}, code long, at long, mirrored boolean, size long")
    asked = _met(asked, index.frequent).withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    met = asked.join(index.seeds, ["code", "part"])
    same = F.col("mirrored") == F.col("back")
    diag = F.when(same, F.col("pos") - F.col("at")).otherwise(F.col("pos") - (F.col("size") - k - F.col("at")))
    return met.select("read_id", "contig", F.when(same, "+").otherwise("-").alias("strand"), diag.alias("diag")).where("diag >= 0").distinct()


def _introns(first: np.ndarray, second: np.ndarray, block: int, ref1: bytes, ref2: bytes):
    """(place in the read, mismatches, motif) of the best change from one diagonal to a later one; first and second are counts of mismatches before each base."""
    n = len(first) - 1
    at = np.arange(block, n - block + 1)
    if not len(at):
        return None
    cost = first[at] + second[n] - second[at]
    low = int(cost.min())
    best = at[cost == low].tolist()
    for s in best:
        ends = ref1[s : s + 2] + ref2[s - 2 : s]
        if ends in (b"GTAG", b"CTAC"):
            return s, low, "+" if ends == b"GTAG" else "-"
    return best[0], low, ""


PLACED = "contig string, strand string, pos long, cigar string, mismatches int, cost int, n_best int, motif string"


def placements(read: bytes, found: list[tuple[str, str, int, bytes]], most: int, block: int, min_intron: int, max_intron: int, intron_cost: int) -> list[tuple]:
    """The placements of least cost, ordered: (contig, strand, pos, cigar, mismatches, cost, motif).

    found: (contig, strand, diagonal, the reference's bases there).  read is as sequenced; on - its reverse complement is compared.
    """
    n, out = len(read), []
    other = read[::-1].translate(bytes.maketrans(b"ACGT", b"TGCA"))
    groups: dict[tuple[str, str], list] = {}
    for contig, strand, diag, ref in found:
        mine = np.frombuffer(read if strand == "+" else other, np.uint8)
        theirs = np.frombuffer(ref, np.uint8)
        wrong = np.ones(n, np.int64)
        wrong[: len(theirs)] = (mine[: len(theirs)] != theirs) | (_CODE[mine[: len(theirs)]] > 3)
        count = np.concatenate([[0], np.cumsum(wrong)])
        if count[n] <= most:
            out.append((contig, strand, diag, f"{n}M", int(count[n]), int(count[n]), ""))
        groups.setdefault((contig, strand), []).append((diag, count, ref))
    for (contig, strand), some in groups.items():
        some.sort(key=lambda x: x[0])
        for i, (d1, c1, r1) in enumerate(some):
            if n < 2 * block or c1[block] > most:
                continue
            for d2, c2, r2 in some[i + 1 :]:
                gap = d2 - d1
                if gap > max_intron:
                    break
                if gap < min_intron or c2[n] - c2[n - block] > most:
                    continue
                s, wrong, motif = _introns(c1, c2, block, r1, r2)
                if wrong <= most:
                    out.append((contig, strand, d1, f"{s}M{gap}N{n - s}M", wrong, wrong + intron_cost, motif))
    if not out:
        return []
    low = min(x[5] for x in out)
    return sorted(x for x in out if x[5] == low)


def map_reads(reads: DataFrame, index: Index, max_mismatch: float = 0.05, block: int = 25, min_intron: int = 21, max_intron: int = 500_000, intron_cost: int = 2, all_best: bool = False) -> DataFrame:
    """reads: read_id, seq -> read_id and PLACED: the first of the placements of least cost (all of them with all_best), and their number.

    An intron stands once in a read at most; pos is from 0; motif is the strand that the intron's motif names, or empty.
    """
    # few bytes of reads give many diagonals, so reads are dealt by their number and not by the splits of their files
    reads = reads.select("read_id", F.upper("seq").alias("seq")).where(F.length("seq") <= index.overlap)
    n = reads.count()
    reads = dealt(reads, "read_id", rows=PART, of=n)
    size = F.lit(index.tile).cast("long")
    wanted = diagonals(reads, index).withColumn("tile", F.floor(F.col("diag") / size))
    window = F.substring(F.col("t.seq"), (F.col("diag") - F.col("t.tile") * size + 1).cast("int"), F.lit(index.overlap))
    with_ref = wanted.alias("d").join(index.tiles.alias("t"), ["contig", "tile"]).select("read_id", "contig", "strand", "diag", window.alias("ref"))
    kind = reads.schema["read_id"].dataType.simpleString()
    met = with_ref.join(reads, "read_id").select("read_id", "seq", "contig", "strand", "diag", F.expr("substring(ref, 1, length(seq))").alias("ref"))
    parts = max(int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // PART + 1)

    def run(batches):
        now, seq, found, rows = None, None, [], []

        def done():
            best = placements(seq.encode("ascii", "replace"), found, int(max_mismatch * len(seq) + 1e-9), block, min_intron, max_intron, intron_cost)
            for x in best if all_best else best[:1]:
                rows.append((now, *x[:6], len(best), x[6]))

        def batch_of():
            cols = list(zip(*rows))
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(cols[0], id_type), *[pa.array(c, t) for c, t in zip(cols[1:], (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string()))]], names=["read_id", *[x.split()[0] for x in PLACED.split(", ")]])

        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for i, s, contig, strand, diag, ref in zip(*[batch.column(j).to_pylist() for j in range(6)]):
                if (i, s) != (now, seq):
                    if found:
                        done()
                    now, seq, found = i, s, []
                    if len(rows) >= 5000:
                        yield batch_of()
                found.append((contig, strand, diag, ref.encode("ascii", "replace")))
        if found:
            done()
        if rows:
            yield batch_of()

    return met.repartition(parts, "read_id").sortWithinPartitions("read_id", "seq").mapInArrow(run, f"read_id {kind}, {PLACED}")


def as_alignments(placed: DataFrame) -> DataFrame:
    """Placements in the shape of read files: name, flag, chrom, pos, mapq, cigar, tags.  Qualities follow the number of best placements."""
    n = F.col("n_best")
    mapq = F.when(n == 1, 255).when(n == 2, 3).when(n < 5, 1).otherwise(0)  # fixed values that aligners of this kind write
    tags = F.map_filter(F.create_map(F.lit("NH"), n.cast("string"), F.lit("nM"), F.col("mismatches").cast("string"), F.lit("XS"), F.col("motif")), lambda _, v: v != "")
    return placed.select(F.col("read_id").alias("name"), F.when(F.col("strand") == "-", 16).otherwise(0).alias("flag"), F.col("contig").alias("chrom"), "pos", mapq.alias("mapq"), "cigar", tags.alias("tags"))
