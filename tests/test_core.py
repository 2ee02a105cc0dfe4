"""Sequences, barcodes, alignments, intervals, sources and statistics."""

import gzip
import io
import random
import struct

import pytest
from pyspark.sql import functions as F

from cellspark.functions import cigar, names, sequences
from cellspark.operators import alignments, barcodes, counts, intervals, reads, splicing, stats
from cellspark.sources import bam, fastq, tables, text


def one(spark, col, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(col.alias("x")).first()["x"]


def test_reverse_complement(spark):
    assert one(spark, sequences.reverse_complement(F.col("s")), s="ACGTN") == "NACGT"


def test_one_mismatch(spark):
    got = one(spark, sequences.one_mismatch(F.col("s")), s="ACGTACGTAC")
    assert len(got) == len(set(got)) == 41 and got[0] == "ACGTACGTAC"
    assert len(one(spark, sequences.one_mismatch(F.col("s"), False), s="ACG")) == 12


@pytest.mark.parametrize("r2,keep,want", [("GGGGTTTTCCCCAAAAGG", "suffix", "TTTTCCCCAAGG"), ("GGGGTTGGGGAATT", "prefix", "GGGGTT"), ("CCCCCCCCTTGGG", "suffix", "CCCCCCCC"), ("CCCCCCCCTTGG", "suffix", "CCCCCCCCTTGG")])
def test_trim_after_primer(spark, r2, keep, want):
    rt = {"GGGGTTTTCCCCAAAAGG": "TTGGGGAAAA", "GGGGTTGGGGAATT": "AATTCCCCAA"}.get(r2, "AATTCCCCAA")
    got = one(spark, sequences.trim_after_primer(F.col("r"), F.col("t"), keep=keep), r=r2, t=rt)
    rc = rt.translate(str.maketrans("ATCG", "TAGC"))[::-1]
    if rc in r2:
        assert got == (r2[r2.index(rc) :] if keep == "suffix" else r2[: r2.index(rc)])
    else:
        assert got == want


def test_cigar(spark):
    got = one(spark, cigar.cigar_blocks(F.col("c"), F.col("p")), c="5S10M2I3M1D4M100N7M2H", p=100)
    assert [tuple(b) for b in got] == [(100, 110, 0), (110, 113, 0), (114, 118, 0), (218, 225, 1)]
    assert one(spark, cigar.reference_end(F.col("c"), F.col("p")), c="5S10M2I3M1D4M100N7M2H", p=100) == 225


@pytest.mark.parametrize("flag,mapq,want", [(99, 30, True), (99, 29, False), (355, 60, False), (1123, 30, True)])
def test_sam_filter(spark, flag, mapq, want):
    assert one(spark, cigar.passes_sam_filter(F.col("f"), F.col("q")), f=flag, q=mapq) is want


def test_natural_order_and_dedup(spark):
    df = spark.createDataFrame([("k", "r10"), ("k", "r9"), ("k", "r9b"), (None, "a")], "key string, name string")
    assert sorted((r.key or "", r.name) for r in alignments.dedup(df, ["key"], "name").collect()) == [("", "a"), ("k", "r9")]


def test_sample_decode(spark):
    d = names.decode_sample(F.col("s"))
    assert [one(spark, d[k], s="P1_1_0_brain_rep1") for k in ("human", "mouse", "sample")] == [True, False, "brain_rep1"]


def test_attach_barcodes(spark):
    lig, rt = "ACGTACGTAC", "TTGGCCAATT"
    wl = lambda b: barcodes.whitelist(spark.createDataFrame([(b,)], "barcode string"))
    r1 = "GATTACAA" + "TTGGCCAATN" + "T" * 15 + "ACGT" * 6
    rows = [("p", 0, "x", r1, "I" * len(r1), lig, "I" * 10, "CAT" * 10, "J" * 30), ("p", 1, "y", r1, "I" * len(r1), "A" * 10, "I" * 10, "CAT" * 10, "J" * 30), ("p", 2, "z", r1, "I" * len(r1), lig, "I" * 10, "CAT", "JJJ")]
    f = spark.createDataFrame(rows, text.FRAGMENTS)
    primers = barcodes.primers(spark.createDataFrame([("s", rt, "CCCCCCCCCC")], "sample string, shortdt string, randomn string"))
    got = {r.name: r for r in reads.tag(f, wl(lig), wl(rt), primers).collect()}
    assert set(got) == {"x", "z"} and got["x"].umi == "GATTACAA" and got["x"].rt == rt and got["x"].ligation == lig
    assert got["x"].r1_seq == "ACGT" * 6 and got["x"].long_enough and not got["z"].long_enough
    check = barcodes.whitelist_check(wl(lig)).first()
    assert check.ratio == 41 and check.is_clean
    with pytest.raises(ValueError):
        reads.Layout(min_rt_trim=11)


def test_overlap_join_is_the_theta_join(spark):
    import random

    rnd = random.Random(1)
    make = lambda n: spark.createDataFrame([(rnd.choice("ab"), s := rnd.randrange(500), s + rnd.randrange(90), i) for i in range(n)], "c string, start long, end long, i long")
    a, b = make(60), make(60).withColumnRenamed("i", "j")
    want = {(x.i, y.j) for x in a.collect() for y in b.collect() if x.c == y.c and x.start < y.end and y.start < x.end and x.start < x.end and y.start < y.end}
    for w in (1, 16, 1000):
        rows = intervals.overlap_join(a, b, ["c"], w).collect()
        assert len(rows) == len(want) and {(r.i, r.j) for r in rows} == want


def test_merge_primers(spark):
    cells = spark.createDataFrame([("b", "t1", 80, 0.2), ("b", "n1", 50, 0.5), ("b", "t2", 10, 1.0)], "unit string, rt string, umi_count long, unmatched_rate double")
    p = spark.createDataFrame([("t1", "t1", False, "s"), ("n1", "t1", True, "s"), ("t2", "t2", False, "q")], "rt string, shortdt string, is_randomn boolean, sample string")
    got = {r.shortdt: r for r in counts.merge_primers(cells, p, ["unit"]).collect()}
    assert round(got["t1"].unmatched_rate, 9) == 0.35 and got["t1"].umi_count == 130 and got["t1"].randomn_umi_count == 50
    assert got["t2"].unmatched_rate == 1.0


def test_stats_pivot(spark):
    log = spark.createDataFrame([("p", "alignments", 5), ("q", "reads_total", 7)], "prefix string, metric string, value long")
    got = {r.prefix: r for r in stats.pivot(log).collect()}
    assert got["p"].alignments == 5 and got["p"].reads_total == -1 and got["q"].reads_total == 7


def test_fastq_round_trip(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    with gzip.open(src / "A_1_R1.fastq.gz", "wt") as f:
        f.write("".join(f"@r{i}\nACGT{'A' * i}\n+\nIIII{'I' * i}\n" for i in range(5)))
    df = fastq.read_fastq(spark, str(src))
    rows = sorted((r.prefix, r.read_no, r.name, r.seq) for r in df.collect())
    assert rows == [("A_1", i, f"r{i}", "ACGT" + "A" * i) for i in range(5)]
    fastq.write_fastq(df, str(tmp_path / "out"))
    back = "".join(gzip.open(p, "rt").read() for p in (tmp_path / "out").rglob("*.gz"))
    assert back.count("@r") == 5 and "@r3\nACGTAAA\n+\nIIIIIII\n" in back


def test_gtf_sam_and_matrix(spark, tmp_path):
    (tmp_path / "a.gtf").write_text('#x\nchr1\ts\texon\t101\t200\t.\t+\t.\tgene_id "g1"; exon_id "e1"; gene_type "t"; gene_name "n"; level 2; tag "a"; tag "b";\n')
    r = text.read_gtf(spark, str(tmp_path / "a.gtf")).first()
    assert (r.start, r.end, r.gene_id, r.exon_id, r.gene_type, r.attrs["level"]) == (100, 200, "g1", "e1", "t", "2")
    (tmp_path / "a.sam").write_text("@HD\tx\nr1\t99\tchr1\t5\t30\t4M\t=\t9\t8\tACGT\tIIII\tNH:i:1\tCB:Z:a:b\n")
    s = text.read_sam(spark, str(tmp_path / "a.sam")).first()
    assert (s.name, s.pos, s.flag, s.tags["CB"]) == ("r1", 4, 99, "a:b")
    t = spark.createDataFrame([(1, 0, 3), (0, 2, 4)], "row long, col long, value long")
    tables.write_matrix_market(t, str(tmp_path / "m.mtx"), 2, 3)
    back = tables.read_matrix_market(spark, str(tmp_path / "m.mtx"))
    assert sorted(map(tuple, back.collect())) == [(0, 2, 4.0), (1, 0, 3.0)]


def test_bam_source(spark, tmp_path):
    head = b"@HD\tVN:1.6\n"
    out = io.BytesIO(b"BAM\1" + struct.pack("<i", len(head)) + head + struct.pack("<i", 1) + struct.pack("<i", 5) + b"chr1\0" + struct.pack("<i", 1000))
    out.seek(0, 2)
    for name, flag, ref, pos in ((b"r1\0", 99, 0, 4), (b"r2\0", 4, -1, -1)):
        ops = struct.pack("<II", 10 << 4 | 0, 5 << 4 | 3) if ref >= 0 else b""
        body = struct.pack("<iiBBHHHiiii", ref, pos, len(name), 30, 0, len(ops) // 4, flag, 0, -1, -1, 0) + name + ops
        out.write(struct.pack("<i", len(body)) + body)
    (tmp_path / "a.bam").write_bytes(gzip.compress(out.getvalue()[:40]) + gzip.compress(out.getvalue()[40:]))
    spark.dataSource.register(bam.BamSource)
    rows = sorted(map(tuple, spark.read.format("bam").load(str(tmp_path / "a.bam")).select("name", "flag", "chrom", "pos", "mapq", "cigar").collect()))
    assert rows == [("r1", 99, "chr1", 4, 30, "10M5N"), ("r2", 4, None, -1, 30, "*")]


def test_adapter_trimming(spark):
    d = spark.createDataFrame([("ACGTAAAAAAAA",), ("ACGTACGAAA",), ("ACGT",), (None,), ("ACGTAAAATAAACC",)], "s string")
    assert [r.s for r in reads.trim_adapter(d, "s", "AAAAAAAA").collect()] == ["ACGT", "ACGTACG", "ACGT", None, "ACGTAAAATAAACC"]


def test_layers(spark):
    rows = [("c", 1, "g", "exon", "counted"), ("c", 1, "g", "exon", "counted"), ("c", 2, "g", "intron", "counted"), ("c", 3, "g", "intron", "counted"), ("c", 3, "g", "exon", "counted"), ("c", 4, None, "exon", "ambiguous")]
    a = spark.createDataFrame(rows, "cell string, umi int, gene_id string, region string, status string")
    got = {r.layer: r["count"] for r in counts.layer_counts(a).collect()}
    assert got == {"spliced": 1, "unspliced": 1, "ambiguous": 1}
    part = spark.createDataFrame([("p:c", "g", "spliced", 1)], "cell string, gene_id string, layer string, count int")
    assert [r.cell for r in counts.combine_layers(part).collect()] == ["c"]


def test_species_and_files(spark):
    g = spark.createDataFrame([("ENSMUSG01", 0), ("ENSG01", 1)], "gene_id string, line int")
    assert counts.species_of(g).first().species == "mouse"
    files = spark.createDataFrame([(f"A_1_{k}.fastq.gz",) for k in ("R1", "R2", "R3")] + [("B_2_R1.fastq.gz",), ("odd.txt",)], "name string")
    assert [r.prefix for r in stats.complete_prefixes(files, ["R1", "R2", "R3"]).collect()] == ["A_1"]


def test_cell_tags_and_mates(spark):
    p = spark.createDataFrame([("t1", "t1"), ("n1", "t1")], "rt string, shortdt string")
    a = spark.createDataFrame([("i", "L", "n1", "U", 65), ("i", "L", "zz", "U", 65)], "i7 string, ligation string, rt string, umi string, flag int")
    assert [(r.CB, r.UB) for r in alignments.cell_tags(a, p).collect()] == [("i.L.t1", "U")]
    m = spark.createDataFrame([("x", 64, 1), ("x", 128, 2), ("y", 64, 1), ("y", 64, 1), ("y", 128, 3), ("z", 64, 1)], "name string, flag int, pos int")
    assert [(r.name, r.mate1.pos, r.mate2.pos) for r in alignments.pair_mates(m, ["name"]).collect()] == [("x", 1, 2)]


def trimmed_at(t, adapter, least, rate):
    """Cells of (edits, beginning), a base of the read at a time."""
    k, best = len(adapter), len(t)
    col = [(j, 0) for j in range(k + 1)]
    for i in range(1, len(t) + 1):
        new = [(0, i)]
        for j in range(1, k + 1):
            a, b, c = col[j - 1], col[j], new[j - 1]
            new.append(min((a[0] + (adapter[j - 1] != t[i - 1]), a[1]), (b[0] + 1, b[1]), (c[0] + 1, c[1])))
        col = new
        if k >= least and col[k][0] <= int(rate * k):
            best = min(best, col[k][1])
    return min([best, *[col[j][1] for j in range(least, k) if t and col[j][0] <= int(rate * j)]])


@pytest.mark.parametrize("size", [1, 8, 13, 33, 63])
def test_adapters_with_gaps(size):
    rnd = random.Random(size)
    dna = lambda n: [rnd.choice("ACGT") for _ in range(n)]
    adapter, texts = "".join(dna(size)), [None, ""]
    for _ in range(300):
        a = list(adapter)
        for _ in range(rnd.randrange(5)):
            at = rnd.randrange(len(a) + 1)
            a[at : at + rnd.randrange(2)] = dna(rnd.randrange(2))
        t = "".join(dna(rnd.randrange(50)) + a + dna(rnd.choice([0, 0, 9])))
        texts.append(t[: len(t) - rnd.randrange(12)] if rnd.random() < 0.4 else t)
    for least, rate in ((3, 0.1), (1, 0.2), (5, 0.3), (size + 1, 0.1)):
        assert reads.adapter_with_gaps(texts, adapter, least, rate) == [None if t is None else trimmed_at(t, adapter, least, rate) for t in texts]


def test_splicing_by_models(spark):
    """Two models: exons 100-200, 300-400, 500-600, and 100-200, 500-600; the second's intron is validated by one read."""
    x = [("g", f"t{k}", "c", "+", a, b) for k, spans in ((1, [(100, 150), (150, 200), (300, 400), (500, 600)]), (2, [(100, 200), (500, 600)])) for a, b in spans]
    exons = spark.createDataFrame(x, "gene_id string, transcript_id string, chrom string, strand string, start long, end long")
    assert sorted((r.transcript_id, r.start, r.end, r.intron) for r in splicing.models(exons).collect()) == [("t1", 100, 200, False), ("t1", 200, 300, True), ("t1", 300, 400, False), ("t1", 400, 500, True), ("t1", 500, 600, False), ("t2", 100, 200, False), ("t2", 200, 500, True), ("t2", 500, 600, False)]
    rows = {
        "exonic": [(110, 140), (120, 150)], "over the middle": [(310, 340), (350, 380)], "ends": [(150, 180), (510, 530)], "edge": [(180, 230), (110, 130)], "inside": [(220, 260), (230, 270)], "four bases over": [(150, 204), (110, 130)],
        "second intron": [(420, 450), (430, 460)], "out": [(590, 620), (520, 540)], "two genes' worth": [(110, 140), (310, 330)],
    }
    pairs = [(n, n, 1, "g", "c", [b[0]], [b[1]]) for n, b in rows.items()] + [(f"mixed {i}", "mixed", 1, "g", "c", [b], [b]) for i, b in enumerate([(110, 140), (220, 260)])]
    p = spark.createDataFrame(pairs, "pid string, cell string, umi int, gene_id string, chrom string, blocks1 array<struct<start:long,end:long>>, blocks2 array<struct<start:long,end:long>>")
    valid = splicing.validated(p, splicing.models(exons), ["pid"])
    assert {tuple(r) for r in valid.collect()} == {("g", 200, 300), ("g", 200, 500)}
    get = lambda permissive: {r.cell: r.state for r in splicing.molecule_states(p, splicing.models(exons), valid, ["pid"], permissive=permissive).collect()}
    want = {"exonic": "spliced", "over the middle": "ambiguous", "ends": "spliced", "edge": "unspliced", "inside": "unspliced", "four bases over": "spliced", "second intron": "unspliced", "two genes' worth": "ambiguous", "mixed": "unspliced"}
    assert get(True) == want
    lone = p.where("cell = 'second intron' or cell = 'exonic'")
    assert splicing.validated(lone, splicing.models(exons), ["pid"]).count() == 0
    some = lambda permissive: {r.cell: r.state for r in splicing.molecule_states(lone, splicing.models(exons), valid.limit(0), ["pid"], permissive=permissive).collect()}
    assert some(True) == {"exonic": "spliced", "second intron": "unspliced"} and some(False) == {"exonic": "spliced"}


def test_counts_are_made_in_parts_that_stay_apart(spark):
    """A task's keys are a part's, as many parts as the rows ask for, and merged primers need no further exchange."""
    from cellspark.operators import counts
    from cellspark.plans import file_queries

    some = counts.dealt(spark.range(5000).selectExpr("id % 50 AS cell", "id AS gene"), "cell", "gene", rows=100)
    one = counts.feature_counts(some, ["cell", "gene"])
    assert one.count() == 5000 and len(one.mapInArrow(lambda b: b, one.schema).rdd.glom().filter(len).collect()) > 30
    plan = file_queries.merged_matrix(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1


def test_layers_by_models_in_every_way(spark, monkeypatch):
    """Pairs whose genes are looked up everywhere, by stretches or beyond their margins, and pairs that come twice, give the same
    layers as gene assignment with molecules of its pairs behind."""
    from cellspark.operators import assign_gene, steps
    from cellspark.operators.annotation import transcript_ends

    monkeypatch.setattr(steps, "TILE", 4000)
    monkeypatch.setattr(steps, "MARGIN", 2500)
    exons = spark.createDataFrame([("c", "+-"[i // 3 % 2], 150 * i, 150 * i + 60 + i % 70, f"g{i // 3}", f"e{i}", i) for i in range(200)], "chrom string, strand string, start long, end long, gene_id string, exon_id string, line long")
    genes = exons.groupBy("chrom", "strand", "gene_id").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    two = exons.withColumn("k", F.explode(F.array(F.lit("a"), F.lit("b")))).where("k = 'a' OR line % 3 <> 1").withColumn("transcript_id", F.concat("gene_id", "k"))
    block = lambda a: [(a, a + 15, 0)]
    at = lambda i: 31 * i % 29_000
    rows = [(i, None if i % 97 == 5 else i % 7, i % 3, None if i % 50 == 9 else "c", "+-"[i % 2], "-+"[i % 2], i % 3 == 0, at(i), at(i) + 15, at(i) + d, at(i) + d + 15, block(at(i)), None if i % 71 == 5 else block(at(i) + d)) for i in range(1500) for d in ([0, 12, 40, 230, 9000][i % 5],)]
    # two pairs of one molecule over the margin, within one gene's only model
    exons = exons.unionByName(spark.createDataFrame([("c", "+", a, a + 40, "long", f"l{a}", 1000) for a in (40_000, 52_000)], "chrom string, strand string, start long, end long, gene_id string, exon_id string, line long"))
    genes = genes.unionByName(spark.createDataFrame([("c", "+", "long", 40_000, 52_040)], "chrom string, strand string, gene_id string, start long, end long"))
    two = two.unionByName(exons.where("gene_id = 'long'").withColumn("transcript_id", F.lit("long")), allowMissingColumns=True)
    rows += [(9000 + i, 1, 1, "c", "-", "+", True, 40_000 + i, 40_015 + i, 52_000 - i, 52_015 - i, block(40_000 + i), block(52_000 - i)) for i in (0, 9)]
    blocks = "array<struct<start:bigint,end:bigint,part:int>>"
    pairs = spark.createDataFrame(rows, f"id int, cell int, umi int, chrom string, strand1 string, strand2 string, is_randomn boolean, start1 long, end1 long, start2 long, end2 long, blocks1 {blocks}, blocks2 {blocks}").cache()
    for permissive, ways in ((False, (("steps", pairs, 10_000), ("stretches, twice", pairs.unionByName(pairs), 10))), (True, (("twice", pairs.unionByName(pairs), 10_000),))):
        got = {}
        for way, some, most in ways:
            out = splicing.layers(some.drop("id"), exons, genes, transcript_ends(exons), two, 64, permissive=permissive, most=most)
            got[way] = sorted(map(tuple, out.select("cell", "gene_id", "layer", "count").collect()))
        a = assign_gene.assign(pairs, ["id"], exons, genes, transcript_ends(exons), 64, keep=("cell", "umi", "chrom", "blocks1", "blocks2")).where("status = 'counted'")
        parts = splicing.models(two)
        states = splicing.molecule_states(a, parts, splicing.validated(a, parts, ["id"]), ["id"], permissive=permissive)
        want = sorted(map(tuple, states.groupBy("cell", "gene_id", "state").count().collect()))
        assert all(x == want for x in got.values()), {k: len(v) for k, v in got.items()}
        assert {r[2] for r in want} == {"spliced", "unspliced", "ambiguous"} and any(r[1] == "long" for r in want)


def test_layers_by_models_write_little(spark):
    """A line costs few bytes of exchanges: pairs are not made distinct, carry no ids, and go once, by cell and gene."""
    from cellspark.plans import queries

    def written():
        return spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()

    at = "/root/testdata/sf0.01"
    before = written()
    rows = queries.transcript_layers(spark, at).collect()
    assert len(rows) == 30_540 and (written() - before) / spark.read.parquet(f"{at}/lineitem.parquet").count() < 200


def test_stretches_send_no_null_lists(spark):
    """Arrow's writer goes over a run of null lists again for each of them; lists are sent empty instead."""
    from cellspark.operators import steps

    f = spark.createDataFrame([("a", 10, 20, "g", [1]), ("a", 30, 40, "h", None)], "chrom string, start long, end long, gene string, w array<long>")
    tiles = steps.Tiles(f, "chrom", ["gene"], ("w",), 64, ("rid",), F.col("low"))
    df = spark.createDataFrame([(1, "a", 12, [7]), (2, "a", 33, None)], "rid int, chrom string, low long, other array<int>")
    sent = []
    seen = type(df).mapInArrow
    try:
        type(df).mapInArrow = lambda self, *a, **k: sent.append(self) or seen(self, *a, **k)
        out = tiles.meet(df, F.col("chrom"), F.array(F.struct(F.col("low").alias("start"), (F.col("low") + 3).alias("end"), F.lit(0).alias("tag"))), "found")
    finally:
        type(df).mapInArrow = seen
    assert sorted((r.rid, r.other, [(x.unit.gene, x.overlap) for x in r.found]) for r in out.collect()) == [(1, [7], [("g", 3)]), (2, None, [("h", 3)])]
    assert sent[0].where("__at IS NULL OR (__feature IS NOT NULL AND other IS NULL)").count() == 0
