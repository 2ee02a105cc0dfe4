"""Exons of an aligned pair: four counting policies over one lookup of spans in the step function of exons.

Without gaps one exon interval holds a set of bases just where it holds their span, so the exons of a read (or of an
N-free block of it) are those that contain its span.  The policies are array expressions on those sets:

split_half   a mate counts one half, over its exons of the common gene
pair_once    the pair counts once, over exons that both mates share where there are any
block_once   N-free blocks count one each, blocks that both mates share once
block_half   N-free blocks count one half each

pairs: the id columns, chrom, strand1, strand2, start1, end1, start2, end2, blocks1, blocks2 (start, end, part).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cigar import flipped
from .intervals import containment_join
from .steps import MOST, Lookup, Tiles, extent, steps

SET = "array<struct<gene_id:string,exon_id:string>>"
WEIGHTS = "array<struct<exon_id:string,status:string,weight:double>>"


def _last(blocks: Column, by_part: bool) -> Column:
    return F.coalesce(F.array_max(F.transform(blocks, lambda b: b["part"])), F.lit(0)) if by_part else F.lit(0)


def _spans(mate: int, strand: Column, by_part: bool) -> Column:
    """array<struct<mate, part, strand, start, end>>: the spans of a mate's blocks, or of each N-free part of them."""
    blocks = F.col(f"blocks{mate}")

    def span(p: Column) -> Column:
        own = F.filter(blocks, lambda b: b["part"] == p) if by_part else blocks
        return F.struct(F.lit(mate).alias("mate"), p.alias("part"), strand.alias("strand"), F.array_min(F.transform(own, lambda b: b["start"])).alias("start"), F.array_max(F.transform(own, lambda b: b["end"])).alias("end"))

    return F.filter(F.transform(F.sequence(F.lit(0), _last(blocks, by_part)), span), lambda s: s["start"].isNotNull())


def sets(pairs: DataFrame, ids: list[str], exons: DataFrame, by_part: bool, width: int = 1 << 14, dealt: bool = False, most: int = MOST) -> DataFrame:
    """ids, start1, end1, start2, end2 and x1, x2: arrays over parts of sets of exons; antisense sets only where both mates
    have no sense exon.

    Spans are looked up in the step function of exons where the pairs are, with no exchange.  More than `most` exons meet
    the pairs stretch by stretch, with one exchange of them; those that reach over a stretch's margin meet exons in a join by
    bins and are dealt by id before their spans are taken apart (dealt: they are already).
    """
    places = ["start1", "end1", "start2", "end2"]
    f = exons.select("chrom", F.col("strand").alias("f_strand"), "start", "end", "gene_id", "exon_id")
    lasts = [_last(F.col("blocks1"), by_part).alias("__last1"), _last(F.col("blocks2"), by_part).alias("__last2")]
    spans = F.concat(_spans(1, flipped(F.col("strand1")), by_part), _spans(2, F.col("strand2"), by_part))
    unit = ["f_strand", "gene_id", "exon_id"]

    def met(pairs: DataFrame, found: Lookup) -> DataFrame:
        at = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), (s["part"] * 2 + s["mate"] - 1).cast("int").alias("tag")))
        rows = pairs.select(*ids, *places, "strand2", flipped(F.col("strand1")).alias("__strand1"), *lasts, "chrom", at.alias("__b"), extent("blocks1", "blocks2")[0].alias("__low"))
        rows = found.meet(rows, F.col("chrom"), F.col("__b"), "__h", whole=True, spare=("chrom", "__b", "__low"))

        def told(x: Column) -> Column:
            mate, u = x["tag"] % 2 + 1, x["unit"]
            strand = F.when(mate == 1, F.col("__strand1")).otherwise(F.col("strand2"))
            return F.struct((strand == u["f_strand"]).alias("sense"), mate.alias("mate"), F.floor(x["tag"] / 2).cast("int").alias("part"), F.struct(u["gene_id"].alias("gene_id"), u["exon_id"].alias("exon_id")).alias("e"))

        return rows.select(*ids, *places, "__last1", "__last2", F.transform("__h", told).alias("__h"))

    def joined(pairs: DataFrame) -> DataFrame:
        rows = (pairs if dealt else pairs.repartition(*ids)).select(*ids, "chrom", *places, *lasts, F.explode_outer(spans).alias("__s"))
        both = containment_join(rows.select(*ids, "chrom", *places, "__last1", "__last2", "__s.*"), f, ["chrom"], width, how="left")
        hit = F.when(F.col("f_start").isNotNull(), F.struct((F.col("strand") == F.col("f_strand")).alias("sense"), "mate", "part", F.struct("gene_id", "exon_id").alias("e")))
        return both.groupBy(*ids).agg(*[F.first(c).alias(c) for c in (*places, "__last1", "__last2")], F.collect_set(hit).alias("__h"))

    if found := steps(f, "chrom", unit, width=width, most=most):
        out = met(pairs, found)
    else:
        near = Tiles.near(*extent("blocks1", "blocks2"))
        out = met(pairs.where(near), Tiles(f, "chrom", unit, (), width, tuple(ids), F.col("__low"))).unionByName(joined(pairs.where(~near)))
    used = F.filter("__h", lambda h: h["sense"] == F.exists("__h", lambda g: g["sense"]))

    def of(mate: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col(f"__last{mate}")), lambda p: F.array_sort(F.transform(F.filter("__h", lambda h: (h["mate"] == mate) & (h["part"] == p)), lambda h: h["e"])))

    return out.withColumn("__h", used).withColumns({"x1": of(1), "x2": of(2)}).drop("__h", "__last1", "__last2")


def genes(x: Column) -> Column:
    return F.array_distinct(F.transform(x, lambda e: e["gene_id"]))


def within(x: Column, gene: Column) -> Column:
    return F.filter(x, lambda e: e["gene_id"] == gene)


def even(x: Column, total: float) -> Column:
    return F.transform(x, lambda e: F.struct(e["exon_id"].alias("exon_id"), F.lit(None).cast("string").alias("status"), (F.lit(float(total)) / F.size(x)).alias("weight")))


def note(status: str, weight: float) -> Column:
    return F.array(F.struct(F.lit(None).cast("string").alias("exon_id"), F.lit(status).alias("status"), F.lit(float(weight)).alias("weight")))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value made once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def split_half(x1: Column, x2: Column) -> Column:
    n1, n2 = F.size(x1), F.size(x2)

    def alone(x: Column) -> Column:
        return F.concat(note("no_feature", 0.5), F.when(F.size(genes(x)) == 1, even(x, 0.5)).otherwise(note("ambiguous", 0.5)))

    def mixed(single: Column, many: Column) -> Column:
        g = F.element_at(single, 1)["gene_id"]
        return F.concat(even(single, 0.5), F.when(F.array_contains(genes(many), g), even(within(many, g), 0.5)).otherwise(note("ambiguous", 0.5)))

    same = let(F.array_intersect(genes(x1), genes(x2)), lambda g: F.when(F.size(g) == 1, F.concat(even(within(x1, g[0]), 0.5), even(within(x2, g[0]), 0.5))).otherwise(note("ambiguous", 1)))
    return F.when((n1 == 0) & (n2 == 0), note("no_feature", 1)).when(n2 == 0, alone(x1)).when(n1 == 0, alone(x2)).when((n1 == 1) & (n2 > 1), mixed(x1, x2)).when((n1 > 1) & (n2 == 1), mixed(x2, x1)).otherwise(same)


def pair_once(x1: Column, x2: Column) -> Column:
    n1, n2 = F.size(x1), F.size(x2)

    def alone(x: Column) -> Column:
        return F.concat(note("no_feature", 1), F.when(F.size(genes(x)) == 1, even(x, 1)).otherwise(note("ambiguous", 1)))

    def common(g: Column) -> Column:
        shared = F.array_intersect(within(x1, g[0]), within(x2, g[0]))
        return F.when(F.size(g) != 1, note("ambiguous", 1)).when(F.size(shared) > 0, even(shared, 1)).otherwise(F.concat(even(within(x1, g[0]), 1), even(within(x2, g[0]), 1)))

    return F.when((n1 == 0) & (n2 == 0), note("no_feature", 1)).when(n2 == 0, alone(x1)).when(n1 == 0, alone(x2)).otherwise(let(F.array_intersect(genes(x1), genes(x2)), common))


def _inner(b: Column) -> Column:
    """Genes of all blocks that have any."""
    none = F.array().cast("array<string>")
    shared = lambda full: F.when(F.size(full) > 0, F.aggregate(F.slice(full, 2, F.greatest(F.size(full), F.lit(1))), F.element_at(full, 1), F.array_intersect)).otherwise(none)
    return let(F.transform(F.filter(b, lambda x: F.size(x) > 0), genes), shared)


def _outer(b: Column) -> Column:
    return genes(F.flatten(b))


def _count(blocks: Column, gene: Column, total: float) -> Column:
    found = F.flatten(F.transform(blocks, lambda x: even(within(x, gene), total)))
    return F.when(F.size(found) > 0, found).otherwise(note("ambiguous", 1))


def _ladder(b1: Column, b2: Column, use: Callable[[Column], Column]) -> Column:
    """use(gene) for the first of four gene intersections that holds exactly one."""
    def first(p: Column) -> Column:
        tries = [let(F.array_intersect(p[a], p[b]), lambda t: F.when(F.size(t) == 1, F.element_at(t, 1))) for a in ("in1", "out1") for b in ("in2", "out2")]
        return F.coalesce(*tries)

    gene = let(F.struct(_inner(b1).alias("in1"), _outer(b1).alias("out1"), _inner(b2).alias("in2"), _outer(b2).alias("out2")), first)
    return let(gene, lambda g: F.when(g.isNull(), note("ambiguous", 1)).otherwise(use(g)))


def _empty(b: Column) -> Column:
    return ~F.exists(b, lambda x: F.size(x) > 0)


def block_once(b1: Column, b2: Column, apart: Column) -> Column:
    """b1 is the mate that starts first; apart: it ends before the other begins."""
    edge = F.array_intersect(F.element_at(b1, -1), F.element_at(b2, 1))
    disjoint = let(edge, lambda e: F.when(F.size(e) > 0, F.concat(F.array(e), F.slice(b1, F.lit(1), F.size(b1) - 1), F.slice(b2, F.lit(2), F.size(b2)))).otherwise(F.concat(b1, b2)))
    shared = F.filter(F.flatten(F.transform(b1, lambda x: F.transform(b2, lambda y: F.array_intersect(x, y)))), lambda s: F.size(s) > 0)
    meets = lambda x, other: F.exists(other, lambda y: F.size(F.array_intersect(x, y)) > 0)
    crossing = F.concat(shared, F.filter(b1, lambda x: ~meets(x, b2)), F.filter(b2, lambda y: ~meets(y, b1)))
    return F.when(_empty(b1) & _empty(b2), note("no_feature", 1)).otherwise(_ladder(b1, b2, lambda g: _count(F.when(apart, disjoint).otherwise(crossing), g, 1)))


def block_half(b1: Column, b2: Column) -> Column:
    half = lambda b, g: _count(b, g, 0.5)

    def single(own: Column, other: Column, i_own: Column, i_other: Column) -> Column:
        g = F.element_at(i_own, 1)
        return F.concat(half(own, g), F.when(F.array_contains(i_other, g), half(other, g)).otherwise(note("ambiguous", 1)))

    def by(p: Column) -> Column:
        i1, i2 = p["i1"], p["i2"]
        n1, n2 = F.size(i1), F.size(i2)
        one_one = F.when(F.element_at(i1, 1) == F.element_at(i2, 1), F.concat(half(b1, F.element_at(i1, 1)), half(b2, F.element_at(i1, 1)))).otherwise(note("ambiguous", 1))
        rest = _ladder(b1, b2, lambda g: F.concat(half(b1, g), half(b2, g)))
        return F.when((n1 == 1) & (n2 == 1), one_one).when((n1 == 1) & (n2 > 1), single(b1, b2, i1, i2)).when((n1 > 1) & (n2 == 1), single(b2, b1, i2, i1)).otherwise(rest)

    return F.when(_empty(b1) & _empty(b2), note("no_feature", 1)).otherwise(let(F.struct(_inner(b1).alias("i1"), _inner(b2).alias("i2")), by))


METHODS = ("split_half", "pair_once", "block_once", "block_half")


def assign(pairs: DataFrame, ids: list[str], exons: DataFrame, method: str, width: int = 1 << 14, dealt: bool = False, most: int = MOST) -> DataFrame:
    """ids, exon_id, status, weight: what each pair adds to exons (exon_id) or to no_feature and ambiguous (status)."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    by_part = method.startswith("block")
    x = sets(pairs, ids, exons, by_part, width, dealt, most)
    if by_part:
        swap = F.col("start1") >= F.col("start2")  # of equal starts mate 2 goes first
        first, second = F.when(swap, F.col("x2")).otherwise(F.col("x1")), F.when(swap, F.col("x1")).otherwise(F.col("x2"))
        apart = F.when(swap, F.col("end2") <= F.col("start1")).otherwise(F.col("end1") <= F.col("start2"))
        x = x.withColumn("__b", F.struct(first.alias("a"), second.alias("b"), apart.alias("apart")))
        made = let(F.col("__b"), lambda b: block_once(b["a"], b["b"], b["apart"]) if method == "block_once" else block_half(b["a"], b["b"]))
    else:
        policy = split_half if method == "split_half" else pair_once
        made = let(F.struct(F.element_at("x1", 1).alias("a"), F.element_at("x2", 1).alias("b")), lambda p: policy(p["a"], p["b"]))
    return x.select(*ids, F.explode(made).alias("__w")).select(*ids, "__w.exon_id", "__w.status", "__w.weight")
