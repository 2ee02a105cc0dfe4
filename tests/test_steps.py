"""The step function of sets against plain Python, its bounds, and both ways of assignment."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellspark.operators import assign_exon, assign_gene, steps
from cellspark.plans.queries import PID, WIDTH
from cellspark.plans.views import ends_view, exon_view, gene_view, pair_view

SF = "/root/testdata/sf0.001"
FEATURE = "chrom string, start long, end long, gene string, part int, w array<long>"
ROW = "rid int, chrom string, at array<struct<start:long,end:long,tag:int>>"


def random_features(n, seed=5):
    r = random.Random(seed)
    out = []
    for i in range(n):
        a = r.randrange(0, 400)
        out.append((r.choice(["a", "b"]), a, a + r.randrange(0, 90), f"g{i % 7}", i % 3, [i % 7, 3]))
    return out


def random_rows(n, seed=6):
    r = random.Random(seed)
    rows = [(i, r.choice(["a", "b", "c"]), [((a := r.randrange(0, 450)), a + r.randrange(0, 60), r.randrange(0, 3)) for _ in range(r.randrange(0, 5))]) for i in range(n)]
    return [*rows, (n, None, [(1, 9, 0)]), (n + 1, "a", None), (n + 2, "a", [None, (0, 400, 1)]), (n + 3, "b", [(5, None, 0)])]


def brute(features, rows, whole):
    out = {}
    for rid, chrom, at in rows:
        got = {}
        for x in at or []:
            if x is None or x[1] is None or x[0] >= x[1]:
                continue
            for c, s, e, g, p, _ in features:
                shared = min(e, x[1]) - max(s, x[0])
                if c == chrom and shared > 0 and (not whole or shared == x[1] - x[0]):
                    got[x[2], g, p] = got.get((x[2], g, p), 0) + shared
        out[rid] = got
    return out


def met(df):
    return {r.rid: {(x.tag, x.unit.gene, x.unit.part): x.overlap for x in r.found} for r in df.collect()}


@pytest.mark.parametrize("whole", [False, True])
@pytest.mark.parametrize("chunk", [1, 40, steps.CHUNK])
def test_lookup_against_brute_force(spark, monkeypatch, whole, chunk):
    features, rows = random_features(120), random_rows(60)
    made = steps.steps(spark.createDataFrame(features, FEATURE), "chrom", ["gene", "part"], ("w",), width=64)
    df = spark.createDataFrame(rows, ROW).coalesce(1)
    if chunk != steps.CHUNK:  # in the driver: what tasks do, with small pieces
        monkeypatch.setattr(steps, "CHUNK", chunk)
        t = df.toArrow().combine_chunks()
        row, tag, unit, shared = made.kept.value.look(t["chrom"].chunk(0), t["at"].chunk(0), whole)
        units = made.kept.value.payload.take(unit.tolist()).to_pylist()
        got = {r[0]: {} for r in rows}
        for i, k, u, n in zip(row.tolist(), tag.tolist(), units, shared.tolist()):
            got[rows[i][0]][k, u["gene"], u["part"]] = n
    else:
        got = met(made.meet(df, F.col("chrom"), F.col("at"), "found", whole))
    assert got == brute(features, rows, whole)


def test_a_crowded_segment_is_looked_up_in_pieces(spark, monkeypatch):
    """3,000 features over one base and 50 intervals there: no piece holds more than one row's entries beyond CHUNK."""
    crowd = spark.range(3000).select(F.lit("a").alias("chrom"), F.lit(10).cast("long").alias("start"), F.lit(20).cast("long").alias("end"), F.col("id").cast("string").alias("gene"))
    made = steps.steps(crowd, "chrom", ["gene"], width=64)
    seen = []
    summed = steps.Segments._summed
    monkeypatch.setattr(steps.Segments, "_summed", staticmethod(lambda row, *rest: seen.append(len(row)) or summed(row, *rest)))
    monkeypatch.setattr(steps, "CHUNK", 7000)
    t = spark.createDataFrame([(i, "a", [(12, 15, 0)]) for i in range(50)], ROW).toArrow().combine_chunks()
    row, _, _, shared = made.kept.value.look(t["chrom"].chunk(0), t["at"].chunk(0), False)
    assert len(row) == 150_000 and set(shared.tolist()) == {3} and max(seen) <= 7000


def test_segments_are_disjoint_and_hold_all_covering_features(spark):
    features = [(c, s, e, str(i)) for i, (c, s, e, *_) in enumerate(random_features(80, 9))]
    got = steps.step_function(spark.createDataFrame(features, "chrom string, start long, end long, id string"), "chrom", 64).collect()
    base = {}
    for r in got:
        for x in range(r.start, r.end):
            assert (r.chrom, x) not in base
            base[r.chrom, x] = set(r.ids)
    want = {}
    for c, s, e, i in features:
        for x in range(s, e):
            want.setdefault((c, x), set()).add(i)
    assert base == want


def test_bounds_and_empty_tables(spark):
    f = spark.createDataFrame(random_features(30), FEATURE)
    assert steps.steps(f, "chrom", ["gene"], most=5) is None and steps.steps(f, "chrom", ["gene"], members=5) is None
    none = steps.steps(f.where("false"), "chrom", ["gene", "part"])
    rows = spark.createDataFrame([(1, "a", [(1, 5, 0)])], ROW)
    assert met(none.meet(rows, F.col("chrom"), F.col("at"), "found")) == {1: {}}
    with pytest.raises(ValueError):
        none.meet(rows, F.col("chrom"), F.col("at"), "at")


def test_both_ways_of_assignment_agree_and_lookups_need_no_exchange(spark):
    x, p = exon_view(spark, SF), pair_view(spark, SF, spliced=True).cache()
    args = (PID, x, gene_view(x), ends_view(x), WIDTH)
    looked, joined = assign_gene.assign(p, *args), assign_gene.assign(p, *args, most=0)
    plan = looked._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan.split("InMemoryRelation")[0] and "Exchange" not in plan.split("InMemoryRelation")[0]
    assert sorted(map(str, looked.collect())) == sorted(map(str, joined.collect()))
    for method in ("pair_once", "block_half"):
        a, b = (assign_exon.assign(p, PID, x, method, WIDTH, most=m) for m in (steps.MOST, 0))
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_a_gene_on_both_strands_counts_once(spark):
    """Antisense and sense exons of one gene id stay one candidate a stage."""
    x = spark.createDataFrame([("c", "+", 0, 50, "g", "e1", 0), ("c", "-", 0, 50, "g", "e2", 1), ("c", "+", 10, 40, "h", "e3", 2)], "chrom string, strand string, start long, end long, gene_id string, exon_id string, line long")
    arr = "array<struct<start:long,end:long,part:int>>"
    p = spark.createDataFrame([("p", "c", "-", "-", 5, 15, 20, 30, [(5, 15, 0)], [(20, 30, 0)], True)], f"pid string, chrom string, strand1 string, strand2 string, start1 long, end1 long, start2 long, end2 long, blocks1 {arr}, blocks2 {arr}, is_randomn boolean")
    none = x.where("false").select("chrom", "strand", "start", "end", "gene_id")
    both = [assign_gene.assign(p, ["pid"], x, none, x.selectExpr("gene_id", "end AS end_d"), 64, most=m).collect() for m in (steps.MOST, 0)]
    assert both[0] == both[1] and both[0][0].gene_id == "g" and both[0][0].whole


def test_genes_of_far_and_near_pairs_by_stretches(spark, monkeypatch):
    """Stretches give what steps give, at their edges, beyond their margins, for null places and for a status that is filtered."""
    from cellspark.operators import assign_exon, assign_gene, steps

    monkeypatch.setattr(steps, "TILE", 4000)
    monkeypatch.setattr(steps, "MARGIN", 2500)
    exons = spark.createDataFrame([("c", "+-"[i % 2], 150 * i, 150 * i + 90 + i % 70, f"g{i // 3}", f"e{i}", i) for i in range(200)], "chrom string, strand string, start long, end long, gene_id string, exon_id string, line long")
    genes = exons.groupBy("chrom", "strand", "gene_id").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("line").alias("line"))
    block = lambda a: [(a, a + 15, 0)]
    rows = [(i, None if i % 50 == 9 else "c", "+-"[i % 2], "-+"[i % 2], i % 3 == 0, 67 * i, 67 * i + 15, 67 * i + d, 67 * i + d + 15, block(67 * i), None if i % 71 == 5 else block(67 * i + d)) for i in range(450) for d in ([0, 12, 40, 9000][i % 4],)]
    blocks = "array<struct<start:bigint,end:bigint,part:int>>"
    pairs = spark.createDataFrame(rows, f"id int, chrom string, strand1 string, strand2 string, is_randomn boolean, start1 long, end1 long, start2 long, end2 long, blocks1 {blocks}, blocks2 {blocks}")
    from cellspark.operators.annotation import transcript_ends

    gene = lambda most: assign_gene.assign(pairs, ["id"], exons, genes, transcript_ends(exons), 64, most=most)
    by_steps, by_stretches = (sorted(map(tuple, gene(m).collect()), key=str) for m in (10_000, 10))
    assert by_steps == by_stretches and len(by_steps) == 450 and len({r[4] for r in by_steps}) == 3
    counted = gene(10_000).where("status = 'counted'")
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert counted.count() == sum(r[4] == "counted" for r in by_steps)
    assert len(plan) < 100_000  # a filter behind does not take the choice of a gene apart
    for method in assign_exon.METHODS:
        a, b = (sorted(map(tuple, assign_exon.assign(pairs, ["id"], exons, method, 64, most=m).collect()), key=str) for m in (10_000, 10))
        assert a == b


def test_cells_of_exon_counts_come_with_the_pairs(spark):
    """The pairs' view, which is distinct over all lines, is made once, and no join brings cells back."""
    from cellspark.plans import exon_queries

    plan = exon_queries.cell_exon_counts(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("lineitem") <= 1


def test_masked_layers_join_no_pairs(spark):
    """Masking takes the places of pairs along, and no join brings them back."""
    from cellspark.plans import queries

    plan = queries.masked_layers(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_the_flank_is_looked_up_only_for_pairs_without_a_feature_in_sense():
    import pyarrow as pa

    p = lambda x: pa.array(x, pa.int64())
    made = assign_gene.Blocks([pa.array([3, 0], pa.int32()), p([100, 5]), p([110, None]), p([2000, 900]), pa.array([1, 1], pa.int32()), pa.array([[100, 2000], [5, 900]]), pa.array([[110, 2010], [15, 905]])])
    assert [x.tolist() for x in made.plain()] == [[0, 0, 1, 1], [100, 2000, 5, 900], [110, 2010, 15, 905], [1, 1, 0, 0]]
    row, start, end, tag = made.moved(np.array([True, False]))
    assert row.tolist() == [0, 0] and start.tolist() == [0, 1000] and end.tolist() == [10, 1010] and tag.tolist() == [3, 3]
    assert made.aligned.tolist() == [20, 15] and np.isnan(made.sense).all()


def test_sums_of_shared_bases_by_one_number_or_by_three():
    rng = np.random.default_rng(3)
    row, tag, unit, shared = rng.integers(0, 40, 3000), rng.integers(0, 4, 3000), rng.integers(0, 9, 3000), rng.integers(1, 30, 3000)
    one, three = steps.Segments._summed(row, tag, unit, shared), steps.Segments._summed(row, tag - 2, unit, shared)
    assert all((a == b).all() for a, b in zip((one[0], one[1] - 2, *one[2:]), three)) and one[3].sum() == shared.sum()
