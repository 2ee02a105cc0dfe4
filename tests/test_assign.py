"""Golden pairs over a small annotation, and the policies against a plain evaluator."""

from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellspark.functions.cigar import cigar_blocks, reference_end
from cellspark.operators import assign_exon, assign_gene
from cellspark.operators.annotation import distinct_exons, transcript_ends

EXONS = [
    ("geneA", "exon1", "+", 101, 200), ("geneA", "exon2", "+", 151, 200), ("geneA", "exon3", "+", 301, 500),
    ("geneB", "exon4", "-", 301, 400), ("geneB", "exon5", "-", 101, 200),
    ("geneC", "exon6", "+", 601, 800), ("geneC", "exon7", "+", 901, 1000), ("geneC", "exon10", "+", 1051, 1200),
    ("geneD", "exon9", "+", 701, 800), ("geneD", "exon10b", "+", 901, 1050),
]
BODIES = [("geneA", "+", 101, 500), ("geneB", "-", 101, 400), ("geneC", "+", 601, 1000), ("geneD", "+", 701, 1100)]
#: name: mate 1 (on -), mate 2 (on +), as 1-based start and CIGAR
PAIRS = {
    "F1": ((401, "50M"), (301, "50M")), "F2": ((401, "50M"), (226, "50M")), "F3": ((151, "50M"), (101, "50M")),
    "F4": ((176, "25M100N25M"), (126, "50M")), "F5": ((301, "50M"), (151, "50M")),
}
WANT = {
    "split_half": {"F1": {"exon3": 1}, "F2": {"exon3": 0.5, "no_feature": 0.5}, "F3": {"exon1": 0.75, "exon2": 0.25}, "F4": {"exon1": 0.5, "no_feature": 0.5}, "F5": {"exon1": 0.25, "exon2": 0.25, "exon3": 0.5}},
    "pair_once": {"F1": {"exon3": 1}, "F2": {"exon3": 1, "no_feature": 1}, "F3": {"exon1": 1}, "F4": {"exon1": 1, "no_feature": 1}, "F5": {"exon1": 0.5, "exon2": 0.5, "exon3": 1}},
    "block_once": {"F1": {"exon3": 1}, "F2": {"ambiguous": 1}, "F3": {"exon1": 1}, "F4": {"exon1": 1, "exon3": 1}, "F5": {"exon1": 0.5, "exon2": 0.5, "exon3": 1}},
    "block_half": {"F1": {"exon3": 1}, "F2": {"ambiguous": 1}, "F3": {"exon1": 0.75, "exon2": 0.25}, "F4": {"exon1": 0.75, "exon2": 0.25, "exon3": 0.5}, "F5": {"exon1": 0.25, "exon2": 0.25, "exon3": 0.5}},
}


@pytest.fixture(scope="module")
def exons(spark):
    rows = [("chr1", s, a - 1, b, g, e, i) for i, (g, e, s, a, b) in enumerate(EXONS)]
    return spark.createDataFrame(rows, "chrom string, strand string, start long, end long, gene_id string, exon_id string, line long").cache()


@pytest.fixture(scope="module")
def genes(spark):
    return spark.createDataFrame([("chr1", s, a - 1, b, g) for g, s, a, b in BODIES], "chrom string, strand string, start long, end long, gene_id string").cache()


def pairs(spark, rows):
    """rows: name, chrom, (start 1-based, cigar) of mate 1 on -, and of mate 2 on +."""
    flat = spark.createDataFrame([(n, c, m1[0] - 1, m1[1], m2[0] - 1, m2[1]) for n, c, m1, m2 in rows], "pid string, chrom string, start1 long, c1 string, start2 long, c2 string")
    return flat.select("pid", "chrom", F.lit("-").alias("strand1"), F.lit("+").alias("strand2"), "start1", reference_end(F.col("c1"), F.col("start1")).alias("end1"), "start2", reference_end(F.col("c2"), F.col("start2")).alias("end2"), cigar_blocks(F.col("c1"), F.col("start1")).alias("blocks1"), cigar_blocks(F.col("c2"), F.col("start2")).alias("blocks2"), F.lit(False).alias("is_randomn"))


@pytest.mark.parametrize("method", assign_exon.METHODS)
def test_exon_policies_on_golden_pairs(spark, exons, method):
    p = pairs(spark, [(n, "chr1", a, b) for n, (a, b) in PAIRS.items()])
    got = defaultdict(lambda: defaultdict(float))
    for r in assign_exon.assign(p, ["pid"], exons, method, width=256).collect():
        got[r.pid][r.exon_id or r.status] += r.weight
    assert {k: {f: round(w, 6) for f, w in v.items()} for k, v in got.items()} == WANT[method]


def test_junction_pair_over_two_genes(spark, exons):
    p = pairs(spark, [("F6", "chr1", (926, "75M50N25M"), (776, "25M100N75M"))])
    once = {r.exon_id or r.status: r.weight for r in assign_exon.assign(p, ["pid"], exons, "block_once", 256).groupBy("exon_id", "status").agg(F.sum("weight").alias("weight")).collect()}
    half = {r.exon_id or r.status: r.weight for r in assign_exon.assign(p, ["pid"], exons, "block_half", 256).groupBy("exon_id", "status").agg(F.sum("weight").alias("weight")).collect()}
    assert once == {"exon6": 1, "exon7": 1, "exon10": 1} and half == {"exon6": 0.5, "exon7": 1, "exon10": 0.5}
    for method in ("split_half", "pair_once"):
        assert [(r.status, r.weight) for r in assign_exon.assign(p, ["pid"], exons, method, 256).collect()] == [("no_feature", 1.0)]


def test_genes_of_golden_pairs(spark, exons, genes):
    p = pairs(spark, [(n, "chr1", a, b) for n, (a, b) in PAIRS.items()] + [("F6", "chr1", (926, "75M50N25M"), (776, "25M100N75M")), ("far", "chr1", (9000, "50M"), (9100, "50M")), ("lost", "chrX", (1, "5M"), (2, "5M")), ("flank", "chr1", (1700, "50M"), (1600, "50M"))])
    got = {r.pid: (r.stage, r.gene_id, r.region, r.status) for r in assign_gene.assign(p, ["pid"], exons, genes, transcript_ends(exons), 256, chroms=genes.select("chrom").distinct()).collect()}
    assert all(got[k] == (1, "geneA", "exon", "counted") for k in PAIRS)
    assert got["F6"] == (1, "geneC", "exon", "counted")
    assert got["far"] == (None, None, None, "no_feature") and got["lost"][3] == "unmapped"
    assert got["flank"][0] == 3 and got["flank"][2] == "intron"


def test_distinct_exons(spark):
    rows = [("g", "a", 1, 5, 0), ("g", "a", 2, 9, 1), ("g", "b", 1, 5, 2), ("g", "c", 2, 9, 3), ("h", "b", 1, 5, 4)]
    x = spark.createDataFrame(rows, "gene_id string, exon_id string, start long, end long, line long")
    assert sorted(r.line for r in distinct_exons(x).collect()) == [0, 3, 4]


block = st.tuples(st.integers(0, 300), st.integers(1, 60))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ABC"), st.sampled_from("+-"), block), min_size=1, max_size=8), st.lists(st.tuples(block, block, st.sampled_from("+-")), min_size=1, max_size=12))
def test_first_stage_against_sets(spark, features, reads):
    """Sense and antisense exon hits against position sets."""
    strand = {}
    rows = [("c", strand.setdefault(g, s), a, a + n, g, f"e{i}", i) for i, (g, s, (a, n)) in enumerate(features)]
    x = spark.createDataFrame(rows, "chrom string, strand string, start long, end long, gene_id string, exon_id string, line long")
    none = x.where("false").select("chrom", "strand", "start", "end", "gene_id")
    flip = {"+": "-", "-": "+"}
    one = [(str(i), "c", flip[s], s, a, a + n, b, b + m, [(a, a + n, 0)], [(b, b + m, 0)], True) for i, ((a, n), (b, m), s) in enumerate(reads)]
    arr = "array<struct<start:long,end:long,part:int>>"
    p = spark.createDataFrame(one, f"pid string, chrom string, strand1 string, strand2 string, start1 long, end1 long, start2 long, end2 long, blocks1 {arr}, blocks2 {arr}, is_randomn boolean")
    got = {r.pid: (r.stage, r.gene_id, r.status) for r in assign_gene.assign(p, ["pid"], x, none, transcript_ends(x), 64).collect()}
    cover = defaultdict(set)
    for _, s, a, b, g, _, _ in rows:
        cover[g, s] |= set(range(a, b))
    for pid, _, _, s2, a, b, c, d, *_ in one:
        bases = [set(range(a, b)), set(range(c, d))]
        want = (None, None, "no_feature")
        for stage, s in ((1, s2), (4, flip[s2])):
            union = {g for (g, t), v in cover.items() if t == s and any(v & m for m in bases)}
            whole = {g for g in union if all(m <= cover[g, s] for m in bases)}
            if union:
                use = whole or union
                want = (stage, next(iter(use)) if len(use) == 1 else None, "counted" if len(use) == 1 else "ambiguous")
                break
        assert got[pid] == want
