"""Read mapping against a search of all places."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellspark.operators import mapping
from cellspark.sources import text

FLIP = str.maketrans("ACGT", "TGCA")


def flipped(s):
    return s[::-1].translate(FLIP)


def brute(read, reference, most, block, low, high, cost):
    """All placements of least cost: (contig, strand, pos, mismatches, cost, gap)."""
    n, found = len(read), {}
    wrong = lambda a, b: sum(x != y or x not in "ACGT" for x, y in zip(a, b))
    for strand, s in (("+", read), ("-", flipped(read))):
        for contig, ref in reference.items():
            for p in range(len(ref)):
                if p + n <= len(ref) and wrong(s, ref[p : p + n]) <= most:
                    found[contig, strand, p, 0] = (wrong(s, ref[p : p + n]), 0)
                if n < 2 * block or wrong(s[:block], ref[p : p + block].ljust(block)) > most:
                    continue
                for d in range(p + low, min(p + high, len(ref) - n) + 1):
                    if wrong(s[n - block :], ref[d + n - block : d + n]) <= most:
                        m = min(wrong(s[:c], ref[p : p + c]) + wrong(s[c:], ref[d + c : d + n]) for c in range(block, n - block + 1))
                        if m <= most:
                            found[contig, strand, p, d - p] = (m, cost)
    best = min((a + b for a, b in found.values()), default=None)
    return {(*k[:3], a, a + b, k[3]) for k, (a, b) in found.items() if a + b == best}


def gap(cigar):
    return int(cigar.split("M")[1].split("N")[0]) if "N" in cigar else 0


@pytest.mark.parametrize("tile,most", [(100, 3), (1 << 16, 1000)])
def test_reads_against_all_places(spark, tile, most):
    rnd = random.Random(tile)
    dna = lambda n: "".join(rnd.choice("ACGT") for _ in range(n))
    unit = dna(60)
    reference = {"a": dna(350), "b": unit * 4 + dna(90), "c": dna(40) + "N" * 20 + dna(150) + "ACAC" * 20, "short": dna(20)}
    reads = {}
    for i in range(160):
        contig = rnd.choice("abc")
        ref = reference[contig]
        p = rnd.randrange(len(ref) - 130)
        c = rnd.randrange(14, 35)
        s = ref[p : p + 48] if i % 3 else ref[p : p + c] + ref[p + c + 45 : p + 45 + 48]
        s = "".join(rnd.choice("ACGT") if rnd.random() < 0.02 else x for x in s)
        reads[f"r{i}"] = (flipped(s) if i % 2 else s).lower() if i % 7 == 0 else flipped(s) if i % 2 else s
    reads |= {"none": None, "empty": "", "tiny": "ACG", "n": "N" * 48, "far": dna(48)}
    pieces = [(k, a, s[a : a + 37]) for k, s in reference.items() for a in range(0, len(s), 37)]
    index = mapping.build(spark.createDataFrame(pieces, "contig string, start long, seq string").repartition(5), k=7, w=2, longest_read=48, tile=tile, most=most)
    assert most > 10 or index.frequent.count() > 0 and index.seeds.groupBy("code", "part").count().agg(F.max("count")).first()[0] < index.seeds.groupBy("code").count().agg(F.max("count")).first()[0]
    d = spark.createDataFrame(list(reads.items()), "read_id string, seq string").repartition(3)
    terms = {"max_mismatch": 1 / 48, "block": 17, "min_intron": 21, "max_intron": 120}
    got = {}
    for r in mapping.map_reads(d, index, all_best=True, **terms).collect():
        got.setdefault(r.read_id, set()).add((r.contig, r.strand, r.pos, r.mismatches, r.cost, gap(r.cigar)))
        assert r.n_best >= 1 and sum(int(x) for x in r.cigar.replace(f"{gap(r.cigar)}N", "").split("M") if x) == 48
    want = {k: brute(s.upper(), reference, 1, 17, 21, 120, 2) for k, s in reads.items() if s and len(s) == 48}
    assert got == {k: v for k, v in want.items() if v}
    one = mapping.map_reads(d, index, **terms)
    assert {r.read_id: r.n_best for r in one.collect()} == {k: len(v) for k, v in got.items()}
    sam = {r.name: r for r in mapping.as_alignments(one).collect()}
    assert all(sam[k].mapq == {1: 255, 2: 3}.get(len(v), 1 if len(v) < 5 else 0) and sam[k].tags["NH"] == str(len(v)) for k, v in got.items())
    assert mapping.map_reads(d.limit(0), index, **terms).count() == 0


def test_reads_of_one_split_are_dealt(spark):
    """Diagonals are made in as many tasks as there are parts of reads, though all reads come in one split."""
    rnd = random.Random(5)
    ref = "".join(rnd.choice("ACGT") for _ in range(300))
    index = mapping.build(spark.createDataFrame([("a", 0, ref)], "contig string, start long, seq string"), k=7, w=2, longest_read=48)
    d = spark.createDataFrame([(i, ref[i : i + 48]) for i in range(200)], "read_id long, seq string").coalesce(1)
    placed = mapping.map_reads(d, index, max_mismatch=1 / 48, block=17)
    assert "REPARTITION_BY_NUM" in placed._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[-1]
    assert {r.read_id: r.pos for r in placed.collect()} == {i: i for i in range(200)}


@pytest.mark.parametrize("k,w", [(5, 1), (7, 4), (15, 10), (31, 3)])
def test_minimizers(k, w):
    rnd = random.Random(k)
    for n in (k, k + w - 1, 60, 300):
        s = "".join(rnd.choice("ACGTN" if rnd.random() < 0.05 else "ACGT") for _ in range(n))
        code, at, back = mapping.minimizers(s.encode(), k, w)
        other, there, mirrored = mapping.minimizers(flipped(s).encode(), k, w)
        # both strands choose the same places
        assert {(c, p, b) for c, p, b in zip(code.tolist(), at.tolist(), back.tolist())} == {(c, n - k - p, not b) for c, p, b in zip(other.tolist(), there.tolist(), mirrored.tolist())}
        # and every window without other letters holds one
        places = set(at.tolist())
        assert all("N" in s[i : i + k + w - 1] or places & set(range(i, i + w)) for i in range(n - k - w + 2))
        assert not any("N" in s[p : p + k] for p in places)


def test_motifs_choose_the_cut():
    #        CCCCCCCCCC GT....AG TTTTTTTTTT, with one base that fits either side
    first = np.concatenate([[0], np.cumsum([0] * 12 + [1] * 8)])
    second = np.concatenate([[0], np.cumsum([1] * 8 + [0] * 12)])
    ref1, ref2 = b"CCCCCCCCCCGTCCCCCCCC", b"TTTTTTTTAGTTTTTTTTTT"
    assert mapping._introns(first, second, 5, ref1, ref2) == (10, 0, "+")
    assert mapping._introns(first, second, 5, ref1.replace(b"GT", b"AA"), ref2) == (8, 0, "")


def test_an_index_is_kept(spark, tmp_path):
    ref = spark.createDataFrame([("c", 0, "ACGTTGCAAGGCTTACGATCGGATCTTAGCGACT" * 3)], "contig string, start int, seq string")
    mapping.build(ref, k=7, w=2, longest_read=40, path=str(tmp_path / "i"))
    index = mapping.read_index(spark, str(tmp_path / "i"))
    (r,) = mapping.map_reads(spark.createDataFrame([(1, "ACGTTGCAAGGCTTACGATCGGATCTTAGCGACTACG")], "read_id int, seq string"), index, max_mismatch=0, block=17).collect()
    assert (r.contig, r.strand, r.pos, r.cigar, r.n_best) == ("c", "+", 0, "37M", 2)
    with pytest.raises(ValueError):
        mapping.build(ref, k=8)


@pytest.mark.parametrize("split", [40, 1 << 20])
def test_fasta(spark, tmp_path, split):
    rnd = random.Random(split)
    want, files = {}, {"a.fa": ["c1", "c2 two words", "empty"], "b.fa": ["c4"]}
    for name, heads in files.items():
        out = []
        for h in heads:
            seq = "" if h == "empty" else "".join(rnd.choice("ACGTN") for _ in range(rnd.choice([7, 60, 61, 500])))
            want[h.split()[0]] = seq
            out += [f">{h}", *[seq[i : i + 10] for i in range(0, len(seq), 10)]]
        (tmp_path / name).write_text("\n".join(out) + "\n")
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        got = {}
        for r in text.read_fasta(spark, str(tmp_path), bin_lines=4).collect():
            got.setdefault(r.contig, {})[r.start] = r.seq
        assert {k: "".join(v[i] for i in sorted(v)) for k, v in got.items()} == {k: v for k, v in want.items() if v}
        assert all(want[k][a : a + len(s)] == s for k, v in got.items() for a, s in v.items())
        (tmp_path / "odd").mkdir()
        (tmp_path / "odd/x.fa").write_text(">x\nACGT\nAC\nACGT\n")
        with pytest.raises(Exception, match="unequal"):
            text.read_fasta(spark, str(tmp_path / "odd")).collect()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
