"""Gene of an aligned pair: one lookup in the step function of stacked features, then the first stage that finds anything.

Stages: 1 exons sense, 2 gene bodies sense, 3 gene bodies sense from blocks moved into the 3' flank, 4 exons antisense,
5 gene bodies antisense.  Within the deciding stage a gene that covers every aligned base goes before genes that cover
some; a single one is taken, several are settled by the nearest transcript end.

pairs: the id columns, chrom, strand1, strand2 (as sequenced), start1, end1, start2, blocks1, blocks2 (arrays of start and
end), is_randomn.  Mate 1 is antisense to its gene and is flipped first.

An annotation that may be sent to every task (see steps) is looked up where the pairs are, with no exchange; a larger one meets
the pairs stretch by stretch, with one exchange of them, and pairs that reach over a stretch's margin join it by bins.
Stage and gene are settled in the tasks that look blocks up, a batch at once, so no filter behind takes them apart.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructType

from ..functions.cigar import directional_end, flipped
from .annotation import gene_parts
from .intervals import overlap_join
from .steps import MOST, Lookup, Tiles, extent, steps

FLANK = 1000
NEAR = 100


def _every_block(flank: int = FLANK) -> Column:
    """array<struct<strand, start, end, kind>>: every M block, plain for exons and bodies, and moved for the flank.

    The flank's shift is taken from mate 2 and reduced so that its start stays at 0; mate 1 then starts from the reduced
    shift and may reduce it again.
    """
    s1, s2 = flipped(F.col("strand1")), F.col("strand2")
    d = F.when(s2 == "+", F.lit(-flank)).otherwise(F.lit(flank)).cast("long")
    d2 = F.when((d < 0) & (F.col("start2") <= -d), -F.col("start2")).otherwise(d)
    d1 = F.when((d2 < 0) & (F.col("start1") <= -d2), -F.col("start1")).otherwise(d2)

    def moved(blocks, strand, kind: str, by):
        return F.transform(blocks, lambda x: F.struct(strand.alias("strand"), (x["start"] + by).alias("start"), (x["end"] + by).alias("end"), F.lit(kind).alias("kind")))

    return F.concat(*[moved(F.col(b), s, k, by) for b, s, shift in (("blocks1", s1, d1), ("blocks2", s2, d2)) for k, by in (("plain", F.lit(0).cast("long")), ("flank", shift))])


def stacked_blocks(pairs: DataFrame, ids: list, flank: int = FLANK) -> DataFrame:
    """ids, kind, strand, start, end: a row a block."""
    return pairs.select(*ids, F.explode_outer(_every_block(flank)).alias("__b")).select(*ids, "__b.*")


def _measures() -> dict[str, Column]:
    """Aligned bases, and mate 1's directional end in sense and antisense, null for random primers."""
    aligned = F.aggregate(F.concat("blocks1", "blocks2"), F.lit(0).cast("long"), lambda a, b: a + b["end"] - b["start"])
    at = lambda strand: F.when(~F.col("is_randomn"), directional_end(F.col("start1"), F.col("end1"), strand))
    return {"__aligned": aligned, "__sense": at(flipped(F.col("strand1"))), "__anti": at(F.col("strand1"))}


def _stage(kind: Column, sense: Column, level: Column) -> Column:
    return F.when(kind == "plain", F.when(sense & (level == "exon"), 1).when(sense, 2).when(level == "exon", 4).otherwise(5)).when(sense & (level == "gene"), 3)


def stacked_features(exons: DataFrame, genes: DataFrame, ends: DataFrame) -> DataFrame:
    """chrom, kind, f_strand, start, end, gene_id, level, ends: merged exons (for plain blocks) and gene bodies (for both
    kinds), each with its gene's transcript ends."""
    cols = ["chrom", F.col("strand").alias("f_strand"), "start", "end", "gene_id"]
    parts = gene_parts(exons).select(F.lit("plain").alias("kind"), *cols, F.lit("exon").alias("level"))
    bodies = genes.select(F.explode(F.array(F.lit("plain"), F.lit("flank"))).alias("kind"), *cols, F.lit("gene").alias("level"))
    return parts.unionByName(bodies).join(ends.groupBy("gene_id").agg(F.collect_set("end_d").alias("ends")), "gene_id", "left")


def hits(pairs: DataFrame, ids: list[str], exons: DataFrame, genes: DataFrame, ends: DataFrame, width: int = 1 << 14, keep: tuple[str, ...] = (), dealt: bool = False) -> DataFrame:
    """ids, keep, chrom, stage, gene_id, whole, distance: the genes that each stage finds for a pair; a pair has a row of nulls
    besides, as its blocks are kept where they meet nothing.

    whole: the gene covers every aligned base; distance: of mate 1's directional end to the gene's nearest transcript end,
    null for random primers.  Pairs are dealt by id once, before their blocks are taken apart (dealt: they are already);
    the annotation is broadcast, so all that follows by pair needs no further exchange.
    """
    by_pair = [*ids, *keep, "chrom"]
    mates = (pairs if dealt else pairs.repartition(*ids)).withColumns(_measures())
    blocks = stacked_blocks(mates, [*by_pair, "__aligned", "__sense", "__anti"])
    both = overlap_join(blocks, stacked_features(exons, genes, ends), ["chrom", "kind"], width, how="left")
    stage = _stage(F.col("kind"), F.col("strand") == F.col("f_strand"), F.col("level"))
    own = F.when(F.col("stage") <= 3, F.col("__sense")).otherwise(F.col("__anti"))
    found = both.withColumn("stage", F.when(F.col("overlap").isNotNull(), stage)).withColumns({"gene_id": F.when(F.col("stage").isNotNull(), F.col("gene_id")), "__far": F.when(F.col("stage").isNotNull(), F.array_min(F.transform("ends", lambda e: F.abs(e - own))))})
    per = found.groupBy(*by_pair, "stage", "gene_id").agg(F.sum("overlap").alias("__covered"), F.min("__aligned").alias("__aligned"), F.min("__far").alias("distance"))
    return per.select(*by_pair, "stage", "gene_id", (F.col("__covered") == F.col("__aligned")).alias("whole"), "distance")


def settle(n: int, row: np.ndarray, stage: np.ndarray, gene: np.ndarray, covered: np.ndarray, aligned: np.ndarray, far: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, ...]:
    """stage (0: none), whole, hit (which tells the gene, or -1) and n_candidates of n pairs.

    row, stage (0: no find), gene (a number) and covered bases of all hits; aligned bases of all pairs; far: of
    the asked hits, the gene's distance to the pair's end (infinite where there is none).
    """
    low, whole, chosen = np.full(n, 9), np.zeros(n, bool), np.full(n, -1)
    np.minimum.at(low, row[stage > 0], stage[stage > 0])
    hit = np.flatnonzero(stage == low[row])
    hit = hit[np.lexsort((gene[hit], row[hit]))]
    if len(hit):  # a gene comes twice only where it lies on both strands
        r, g = row[hit], gene[hit]
        new = np.flatnonzero(np.r_[True, (np.diff(r) != 0) | (np.diff(g) != 0)])
        all_bases = np.add.reduceat(covered[hit], new) == aligned[r[new]]
        hit = hit[new]
        whole[row[hit[all_bases]]] = True
        hit = hit[all_bases | ~whole[row[hit]]]
    count = np.bincount(row[hit], minlength=n)
    alone = count[row[hit]] == 1
    chosen[row[hit[alone]]] = hit[alone]
    many = hit[~alone]
    if len(many):
        r, d = row[many], far(many)
        nearest = np.full(n, np.inf)
        np.minimum.at(nearest, r, d)
        near = d < nearest[r] + NEAR
        sole = near & (np.bincount(r[near], minlength=n)[r] == 1)
        chosen[r[sole]] = many[sole]
    return np.where(low < 9, low, 0), whole, chosen, count


SETTLED = StructType().add("stage", IntegerType()).add("whole", BooleanType()).add("gene_id", StringType()).add("n_candidates", IntegerType())


def _columns(stage: np.ndarray, whole: np.ndarray, gene: pa.Array, count: np.ndarray) -> list[pa.Array]:
    return [pa.array(stage, pa.int32(), mask=stage == 0), pa.array(whole), gene, pa.array(count, pa.int32())]


def _by_bins(pairs: DataFrame, ids: list[str], exons: DataFrame, genes: DataFrame, ends: DataFrame, width: int, kept: list[str], dealt: bool) -> DataFrame:
    """ids, kept and SETTLED from a join by bins."""
    per = hits(pairs, ids, exons, genes, ends, width, tuple(c for c in kept if c != "chrom"), dealt)
    found = F.when(F.col("stage").isNotNull(), F.struct("stage", "gene_id", "whole", "distance"))
    per = per.groupBy(*ids).agg(*[F.first(c).alias(c) for c in kept], F.collect_list(found).alias("__h"))
    n, schema = len(ids) + len(kept), StructType([*per.select(*ids, *kept).schema.fields, *SETTLED.fields])

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(n)
            h = lists.flatten()
            row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
            stage, distance = (pc.struct_field(h, c) for c in ("stage", "distance"))
            names = pc.struct_field(h, "gene_id")
            covers = pc.struct_field(h, "whole").fill_null(False).to_numpy(zero_copy_only=False).astype(np.int64)
            far = lambda i: distance.cast(pa.float64()).fill_null(np.inf).to_numpy()[i]  # noqa: E731, B023
            s, whole, chosen, count = settle(len(lists), row, stage.to_numpy(), np.arange(len(h)), covers, np.ones(len(lists), np.int64), far)
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *_columns(s, whole, names.take(pa.array(chosen, mask=chosen < 0)), count)], names=schema.names)

    return per.select(*ids, *kept, "__h").mapInArrow(settled, schema)


def _long(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column, 0).to_numpy().astype(np.int64)


class Blocks:
    """The blocks of a batch of pairs, plain and moved as _every_block() moves them, and the measures of _measures(), as arrays."""

    @staticmethod
    def columns() -> dict[str, Column]:
        """Few bytes a pair: strands and primer in one number, places of both mates' blocks in two lists."""
        bits = F.when(flipped(F.col("strand1")) == "+", 1).otherwise(0) + F.when(F.col("strand2") == "+", 2).otherwise(0) + F.when(~F.col("is_randomn"), 4).otherwise(0)
        every = lambda c: F.concat(F.col("blocks1")[c], F.col("blocks2")[c])
        return {"__bits": bits.cast("int"), **{f"__{c}": F.col(c).cast("long") for c in ("start1", "end1", "start2")}, "__first": F.size("blocks1").cast("int"), "__starts": every("start"), "__ends": every("end")}

    @staticmethod
    def near_columns() -> dict[str, Column]:
        """As columns(), with places from start1 on and lengths of blocks instead of their ends: small numbers, of which an exchange
        takes fewer bytes."""
        base = F.coalesce(F.col("start1").cast("long"), F.lit(0).cast("long"))
        every = F.concat("blocks1", "blocks2")
        return Blocks.columns() | {"__end1": F.col("end1").cast("long") - base, "__start2": F.col("start2").cast("long") - base, "__starts": F.transform(every, lambda b: b["start"] - base), "__ends": F.transform(every, lambda b: b["end"] - b["start"])}

    def __init__(self, columns: list[pa.Array], near: bool = False):
        """near: of near_columns()."""
        bits, start1, end1, start2, first, starts, ends = columns
        self.n = n = len(bits)
        bits = _long(bits)
        self.plus = np.stack([bits & 1, bits >> 1 & 1])  # by mate
        size = pc.fill_null(pc.list_value_length(starts), 0).to_numpy().astype(np.int64)
        self.row = np.repeat(np.arange(n), size)
        self.start, self.end = _long(starts.flatten()), _long(ends.flatten())
        base = _long(start1) if near else np.zeros(n, np.int64)
        if near:
            self.start = self.start + base[self.row]
            self.end = self.end + self.start
        self.mate = (np.arange(len(self.row)) - np.repeat(np.cumsum(size) - size, size) >= _long(first)[self.row]).astype(np.int64)
        self.aligned = np.where(starts.is_valid().to_numpy(zero_copy_only=False), np.bincount(self.row, self.end - self.start, minlength=n).astype(np.int64), -1)
        d = np.where(self.plus[1] == 1, -FLANK, FLANK)
        shift = []
        for at, more in ((start2, base), (start1, 0)):
            known, place = at.is_valid().to_numpy(zero_copy_only=False), _long(at) + more
            d = np.where(known & (d < 0) & (place <= -d), -place, d)
            shift.insert(0, d)
        self.shift = np.stack(shift)
        behind, ahead = (np.where((bits & 4 > 0) & c.is_valid().to_numpy(zero_copy_only=False), _long(c) + more, np.nan) for c, more in ((end1, base), (start1, -1)))
        own = self.plus[0] == 1
        self.sense, self.anti = np.where(own, behind, ahead), np.where(own, ahead, behind)

    def plain(self) -> tuple[np.ndarray, ...]:
        return self.row, self.start, self.end, self.plus[self.mate, self.row]

    def moved(self, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        """The blocks of some pairs, in the flank."""
        i = np.flatnonzero(rows[self.row])
        by = self.shift[self.mate[i], self.row[i]]
        return self.row[i], self.start[i] + by, self.end[i] + by, 2 + self.plus[self.mate[i], self.row[i]]


def _facts(index) -> tuple:
    """A number for each unit's gene, its strand (1: +, 0: -, 2: none) and whether it is an exon; made once for an index, not for each batch."""
    if not hasattr(index, "facts"):
        held = index.payload
        strand = np.where(pc.equal(held["f_strand"], "+").fill_null(False).to_numpy(), 1, np.where(pc.equal(held["f_strand"], "-").fill_null(False).to_numpy(), 0, 2))
        names, ends = (held[c].combine_chunks() for c in ("gene_id", "ends"))
        index.facts = names, ends, pc.fill_null(names.dictionary_encode().indices, -1).to_numpy(), strand, pc.equal(held["level"], "exon").to_numpy()
    return index.facts


def _decided(blocks: Blocks, index, meet) -> tuple[np.ndarray, ...]:
    """stage (0: none), whole, unit of the chosen gene (or -1) and n_candidates of a batch of pairs.  The flank is looked up only
    for pairs that meet no feature in sense, as no later stage decides for the others."""
    _, ends, ids_of, strand, exon = _facts(index)
    row, tag, unit, shared = meet(*blocks.plain())
    none = np.ones(blocks.n, bool)
    none[row[strand[unit] == tag]] = False
    row, tag, unit, shared = (np.concatenate(c) for c in zip((row, tag, unit, shared), meet(*blocks.moved(none))))
    same, of_exon = strand[unit] == tag % 2, exon[unit]
    stage = np.where(tag < 2, np.where(same, np.where(of_exon, 1, 2), np.where(of_exon, 4, 5)), np.where(same & ~of_exon, 3, 0))

    def far(hit: np.ndarray) -> np.ndarray:
        own = np.where(stage[hit] <= 3, blocks.sense[row[hit]], blocks.anti[row[hit]])
        of = ends.take(pa.array(unit[hit]))
        size = pc.fill_null(pc.list_value_length(of), 0).to_numpy()
        at = np.repeat(np.arange(len(hit)), size)
        away = np.abs(pc.fill_null(of.flatten().cast(pa.float64()), np.nan).to_numpy() - own[at])
        least = np.full(len(hit), np.inf)
        np.fmin.at(least, at, away)
        return least

    s, whole, chosen, count = settle(blocks.n, row, stage, ids_of[unit], shared, blocks.aligned, far)
    return s, whole, np.where(chosen < 0, -1, unit[chosen] if len(unit) else -1), count


def _rows(pairs: DataFrame, kept: list[str]) -> DataFrame:
    """What a lookup takes of pairs: few numbers, of which their blocks are made in the task."""
    return pairs.select(*kept, *[c.alias(n) for n, c in Blocks.near_columns().items()], F.col("chrom").alias("__c"), extent("blocks1", "blocks2", beyond=FLANK)[0].alias("__low"))


def _looked_up(pairs: DataFrame, ids: list[str], found: Lookup, kept: list[str]) -> DataFrame:
    """As _by_bins, from a lookup of stacked features."""
    rows = _rows(pairs, [*ids, *kept])
    n = len(ids) + len(kept)

    def settled(columns: list[pa.Array], index, meet) -> list[pa.Array]:
        stage, whole, unit, count = _decided(Blocks(columns[n:], near=True), index, meet)
        return [*columns[:n], *_columns(stage, whole, _facts(index)[0].take(pa.array(unit, mask=unit < 0)), count)]

    return found.each(rows, F.col("__c"), None, settled, StructType([*rows.schema.fields[:n], *SETTLED.fields]), spare=("__c", "__low"))


def assign(pairs: DataFrame, ids: list[str], exons: DataFrame, genes: DataFrame, ends: DataFrame, width: int = 1 << 14, chroms: DataFrame | None = None, keep: tuple[str, ...] = (), dealt: bool = False, most: int = MOST) -> DataFrame:
    """ids, keep and stage, gene_id, region (exon or intron), status (counted, ambiguous, no_feature, unmapped), n_candidates,
    whole (a candidate holds all aligned bases): one row a pair; ids are one pair's each.

    Several candidates are settled by the smallest distance, unless another lies within NEAR of it.  An annotation of more
    than `most` features meets the pairs by stretches (dealt: pairs lie by id already).
    """
    kept = [c for c in dict.fromkeys(("chrom", *keep)) if c not in ids]
    features = stacked_features(exons, genes, ends).where("kind = 'plain'")
    unit, carry = ["gene_id", "f_strand", "level"], ("ends",)
    if found := steps(features, "chrom", unit, carry, width, most):
        out = _looked_up(pairs, ids, found, kept)
    else:
        near = Tiles.near(*extent("blocks1", "blocks2", beyond=FLANK))
        tiles = Tiles(features, "chrom", unit, carry, width, tuple(ids), F.col("__low"))
        out = _looked_up(pairs.where(near), ids, tiles, kept)
        out = out.unionByName(_by_bins(pairs.where(~near), ids, exons, genes, ends, width, kept, dealt))
    status = F.when(F.col("stage").isNull(), "no_feature").when(F.col("gene_id").isNull(), "ambiguous").otherwise("counted")
    if chroms is not None:
        known = chroms.select("chrom", F.lit(True).alias("__known")).distinct()
        out = out.join(F.broadcast(known) if known.limit(100_001).count() <= 100_000 else known, "chrom", "left")
        status = F.when(F.col("__known").isNull(), "unmapped").otherwise(status)
    region = F.when(F.col("stage").isNotNull(), F.when((F.col("stage") == 1) | ((F.col("stage") == 4) & F.col("whole")), "exon").otherwise("intron"))
    return out.select(*ids, *keep, "stage", "gene_id", region.alias("region"), status.alias("status"), "n_candidates", "whole")


def counted(pairs: DataFrame, keep: list[str], exons: DataFrame, genes: DataFrame, ends: DataFrame, beside: DataFrame, make: Callable, fields: StructType, width: int = 1 << 14, most: int = MOST) -> tuple[DataFrame, DataFrame | None]:
    """What `make` gives for pairs that assign() counts, as columns `fields`, in the tasks that settle their genes; and, where an
    annotation is too large to be sent to every task, the few counted pairs that reach over a stretch's margin, as they came,
    with gene_id.

    make(columns of keep, gene_id, blocks, index) of each batch, with blocks as (row, start, end, bases or -1) and beside's rows
    as index.beside (see steps).  keep has chrom.  Pairs need no ids and may come repeatedly; of those over a margin one is given.
    """
    features = stacked_features(exons, genes, ends).where("kind = 'plain'")
    unit, carry, n = ["gene_id", "f_strand", "level"], ("ends",), len(keep)
    found, far = steps(features, "chrom", unit, carry, width, most, beside=beside), None
    if not found:
        near = Tiles.near(*extent("blocks1", "blocks2", beyond=FLANK))
        found = Tiles(features, "chrom", unit, carry, width, tuple(c for c in keep if c != "chrom"), F.col("__low"), beside)
        ids = [*dict.fromkeys([*(c for c in keep if c != "chrom"), "strand1", "strand2", "is_randomn", "start1", "end1", "start2", "blocks1", "blocks2"]), "__chrom"]
        over = pairs.where(~near).withColumn("__chrom", F.col("chrom")).select(*ids, "chrom").distinct()
        far = _by_bins(over, ids, exons, genes, ends, width, ["chrom"], False).where("gene_id IS NOT NULL").drop("__chrom")
        pairs = pairs.where(near)

    def made(columns: list[pa.Array], index, meet) -> list[pa.Array]:
        blocks = Blocks(columns[n:], near=True)
        unit = _decided(blocks, index, meet)[2]
        some = np.flatnonzero(unit >= 0)
        mine = unit[blocks.row] >= 0
        row = (np.cumsum(unit >= 0) - 1)[blocks.row[mine]]
        return make([c.take(pa.array(some)) for c in columns[:n]], _facts(index)[0].take(pa.array(unit[some])), (row, blocks.start[mine], blocks.end[mine], blocks.aligned[some]), index)

    return found.each(_rows(pairs, keep), F.col("__c"), None, made, fields, spare=("__c", "__low")), far
