"""Files: splits of FASTQ, whole BAM records, count tables, logs, matrices, sheets, versions."""

import gzip
import random
import zipfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellspark.operators import alignments, cells, ranks, reads, stats
from cellspark.sources import bam, fastq, genome, layers, lines, paths, statlog, tables, text

RND = random.Random(2)


def record(i):
    seq = "".join(RND.choice("ACGT") for _ in range(RND.randrange(0, 60)))
    qual = "".join(RND.choice("@+!IJ~") for _ in seq)  # qualities may begin like a name or a separator
    return (f"r{i} x", seq, qual)


@pytest.mark.parametrize("size", [70, 333, 5000])
def test_fastq_in_splits(spark, tmp_path, size):
    want = {}
    for name, n in (("A_1", 400), ("B_2", 1), ("C_3", 0), ("D_4", 37)):
        rows = [record(i) for i in range(n)]
        (tmp_path / f"{name}_R1.fastq").write_text("".join(f"@{a}\n{s}\n+\n{q}\n" for a, s, q in rows))
        want |= {(name, i): r for i, r in enumerate(rows)}
    rows = [record(i) for i in range(50)]
    with gzip.open(tmp_path / "E_5_R1.fastq.gz", "wt") as f:
        f.write("".join(f"@{a}\n{s}\n+\n{q}\n" for a, s, q in rows))
    want |= {("E_5", i): r for i, r in enumerate(rows)}
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3 if size < 100 else 50)
        got = fastq.read_fastq(spark, str(tmp_path)).collect()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert len(got) == len(want) and {(r.prefix, r.read_no): (r.name, r.seq, r.qual) for r in got} == want


def test_broken_fastq_raises(spark, tmp_path):
    (tmp_path / "A_1_R1.fastq").write_text("@a\nAC\n+\nII\n@b\nAC\n")
    with pytest.raises(ValueError, match="four"):
        fastq.read_fastq(spark, str(tmp_path))


def test_bam_round_trip(spark, tmp_path):
    spark.dataSource.register(bam.BamSource)
    rows = [(f"r{i}", i % 4096, "chr2" if i % 3 else None, i * 7 if i % 3 else -1, i % 60, f"{i % 90 + 1}M3N2S" if i % 3 else "*", "chr1" if i % 2 else None, i if i % 2 else -1, -i, "ACGTN"[: i % 6] or "*", "IIII!"[: i % 6] if i % 6 else "*", {"CB": f"p.{i}", "UB": "é"} if i % 4 else {}) for i in range(3000)]
    d = spark.createDataFrame(rows, bam.SCHEMA).repartition(3)
    path = str(tmp_path / "out")
    d.write.format("bam").option("references", "chr1:1000,chr2:90000").mode("append").save(path)
    files = sorted((tmp_path / "out").glob("*.bam"))
    assert len(files) == 3 and all(f.read_bytes().endswith(bam.EOF_BLOCK) for f in files)
    back = spark.read.format("bam").load(path)
    norm = lambda r: str([*r[:11], sorted((r[11] or {}).items())])
    assert sorted(map(norm, back.collect())) == sorted(map(norm, rows))
    sam = str(tmp_path / "sam")
    text.write_sam(d.where("flag < 9"), sam, [("chr1", 1000), ("chr2", 90000)])
    lines = [x for f in sorted((tmp_path / "sam").glob("part-*")) for x in f.read_text().splitlines()]
    assert lines[:3] == ["@HD\tVN:1.6", "@SQ\tSN:chr1\tLN:1000", "@SQ\tSN:chr2\tLN:90000"] and text.read_sam(spark, sam).count() == sum(r[1] < 9 for r in rows)


def test_tags_of_all_types():
    import numpy as np

    data = b"NHC\x03" + b"ASi" + (-5).to_bytes(4, "little", signed=True) + b"XAAq" + b"MDZ10A5\0" + b"ZBBs\x02\0\0\0\x01\0\xff\xff" + b"XFf\0\0\x80?"
    want = [("NH", "3"), ("AS", "-5"), ("XA", "q"), ("MD", "10A5"), ("ZB", "s,1,-1"), ("XF", "1.0")]
    both = np.frombuffer(data + b"CBZx\0" + data, np.uint8)
    cut = np.array([0, len(data), len(data) + 5, len(data) + 5])
    assert bam._tags(both, cut, np.array([len(data), len(data) + 5, len(data) + 5, len(both)])).to_pylist() == [want, [("CB", "x")], [], want]


def bam_rows(n, place=False):
    """Rows of all shapes; long names and texts now and then, so that records go over blocks."""
    rows = []
    for i in range(n):
        bases = "".join(RND.choice("ACGTN") for _ in range(RND.choice([0, 1, 2, 75, 150, 151, 3000])))
        chrom = RND.choice(["chr1", "chr2", None])
        rows.append((f"r{i}" + "x" * RND.choice([0, 5, 200]), RND.randrange(4096), chrom, RND.randrange(1 << 28) if chrom else -1, i % 60, f"{i % 90 + 1}M3000N2S" if chrom else "*", "chr1" if i % 2 else None, i if i % 2 else -1, -i, bases or "*", "".join(RND.choice("!5IJ") for _ in bases) if bases and i % 3 else "*", {"CB": f"p.{i}", "UB": "é" * (i % 5)} if i % 4 else {}))
    return sorted(rows, key=lambda r: ({"chr1": 0, "chr2": 1, None: 2}[r[2]], r[3])) if place else rows


def plain(r):
    return str([*r[:11], sorted(dict(r[11] or {}).items())])


def test_bam_in_byte_ranges(spark, tmp_path):
    """One file in any number of tasks gives the same rows; no record twice, none lost."""
    spark.dataSource.register(bam.BamSource)
    rows, path = bam_rows(2500), str(tmp_path / "out")
    spark.createDataFrame(rows, bam.SCHEMA).coalesce(1).write.format("bam").option("references", "chr1:300000000,chr2:300000000").mode("append").save(path)
    (file,) = (tmp_path / "out").glob("*.bam")
    size, want = file.stat().st_size, sorted(map(plain, rows))
    for parts in (1, 2, 7, 50, 400):
        d = spark.read.format("bam").option("split", -(-size // parts)).load(path)
        assert sorted(map(plain, d.collect())) == want
        assert parts == 1 or d.rdd.getNumPartitions() >= parts - 1
    tiny = spark.read.format("bam").option("split", 97).load(str(tmp_path / "few"))
    spark.createDataFrame(rows[:3], bam.SCHEMA).coalesce(1).write.format("bam").option("references", "chr1:300000000,chr2:300000000").mode("append").save(str(tmp_path / "few"))
    assert sorted(map(plain, tiny.collect())) == sorted(map(plain, rows[:3]))


def test_a_region_opens_its_blocks(spark, tmp_path):
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThan

    spark.dataSource.register(bam.BamSource)
    rows, path = bam_rows(6000, place=True), str(tmp_path / "sorted")
    d = alignments.sort_by_place(spark.createDataFrame(rows, bam.SCHEMA), ["chr1", "chr2"])
    d.write.format("bam").option("references", "chr1:300000000,chr2:300000000").option("index", "true").mode("append").save(path)
    files = sorted((tmp_path / "sorted").glob("*.bam"))
    assert all(f.with_name(f.name + ".bai").exists() for f in files)
    assert sorted(map(plain, spark.read.format("bam").load(path).collect())) == sorted(map(plain, rows))
    whole = 0
    for f in files:
        r = bam.BamReader(str(f))
        n = sum(b.num_rows for p in r.partitions() for b in r.read(p))
        whole += r.opened
    for chrom, a, b in (("chr1", 0, 5_000_000), ("chr2", 100_000_000, 101_000_000), ("chr2", 268_000_000, 1 << 31), ("chr1", 7, 7), ("none", 0, 100)):
        r, got = bam.FilteredReader(path), []
        left = list(r.pushFilters([EqualTo(("chrom",), chrom), GreaterThanOrEqual(("pos",), a), LessThan(("pos",), b)]))
        assert len(left) == 3
        for p in r.partitions():
            for batch in r.read(p):
                got += [tuple(x.values()) for x in batch.to_pylist()]
        assert sorted(map(plain, got)) == sorted(plain(x) for x in rows if x[2] == chrom and a <= x[3] < b)
        assert r.opened < whole / 4, (r.opened, whole)
    some = sorted(plain(x) for x in rows if x[2] == "chr2" and 1_000_000 <= x[3] < 90_000_000)
    assert sorted(map(plain, spark.read.format("bam").option("region", "chr2:1000000-90000000").load(path).collect())) == some
    for f in (tmp_path / "sorted").glob("*.bai"):
        f.rename(tmp_path / f.name)
    assert sorted(map(plain, spark.read.format("bam").option("region", "chr2:1000000-90000000").option("split", 5000).load(path).collect())) == some  # without an index all blocks are read
    for f in tmp_path.glob("*.bai"):
        f.rename(tmp_path / "sorted" / f.name)
    keep = spark.conf.get("spark.sql.python.filterPushdown.enabled")
    try:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
        d = spark.read.format("bam").option("pushdown", "true").load(path).where("chrom = 'chr2' AND pos >= 1000000 AND pos <= 90000000")
        assert sorted(map(plain, d.collect())) == sorted(plain(x) for x in rows if x[2] == "chr2" and 1_000_000 <= x[3] <= 90_000_000)
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", keep)


def test_an_index_needs_order():
    maker = bam.IndexMaker(1)
    maker.add(0, 5, 9, 0, 10)
    with pytest.raises(ValueError, match="order"):
        maker.add(0, 4, 9, 10, 20)


def test_rows_are_packed_together():
    """A batch's records, with the format's empty values, and slices of a batch."""
    chroms = {"chr1": 0, "chr2": 1}
    rows = [
        {"name": "a", "flag": 16, "chrom": "chr2", "pos": 16380, "mapq": 9, "cigar": "5S10M100N3I4D2=", "mate_chrom": "chr1", "mate_pos": 7, "length": -5, "seq": "ACGTn", "qual": "IIII!", "tags": [("CB", "a:b"), ("UB", "")]},
        {"name": None, "flag": None, "chrom": "other", "pos": None, "mapq": None, "cigar": None, "mate_chrom": None, "mate_pos": None, "length": None, "seq": "*", "qual": "*", "tags": None},
        {"name": "", "flag": 4, "chrom": None, "pos": 0, "mapq": 255, "cigar": "*", "mate_chrom": "chr2", "mate_pos": 0, "length": 0, "seq": "acg", "qual": None, "tags": []},
    ]
    batch = pa.RecordBatch.from_pylist(rows, schema=bam.ARROW)
    for lo, hi in ((0, 3), (1, 3), (2, 3), (0, 0)):
        data, size, ref, start, end = bam.packed(batch.slice(lo, hi - lo), chroms)
        assert int(size.sum()) == len(data) and ref.tolist() == [1, -1, -1][lo:hi] and start.tolist() == [16380, 0, 0][lo:hi] and end.tolist() == [16496, 1, 1][lo:hi]
        if hi > lo:
            got = bam.decode(data, np.cumsum(size) - size, list(chroms)).to_pylist()
            want = [rows[0] | {"seq": "ACGTN"}, {"name": "*", "flag": 0, "chrom": None, "pos": -1, "mapq": 0, "cigar": "*", "mate_chrom": None, "mate_pos": -1, "length": 0, "seq": "*", "qual": "*", "tags": []}, rows[2] | {"name": "*", "seq": "ACG", "qual": "*"}]
            assert got == want[lo:hi]
    for field, value in (("qual", "II"), ("mapq", 256), ("cigar", "3Q"), ("cigar", f"{1 << 28}M"), ("name", "x" * 255)):
        with pytest.raises(ValueError):
            bam.packed(pa.RecordBatch.from_pylist([rows[0] | {field: value}], schema=bam.ARROW), chroms)


def test_decoded_pieces_are_small(tmp_path):
    """What a task holds of a file is bounded by a piece, whatever the file's size."""
    rows = pa.RecordBatch.from_pylist([{"name": f"read{i}", "pos": i, "seq": "ACGT" * 25} for i in range(60_000)], schema=bam.ARROW)
    data = np.concatenate([bam.packed(rows.slice(i, 5000), {})[0] for i in range(0, 60_000, 5000)]).tobytes()
    head = b"BAM\1" + bytes(8)
    path = tmp_path / "x.bam"
    path.write_bytes(b"".join(bam.block(x) for x in [head, *[data[i : i + bam.BLOCK] for i in range(0, len(data), bam.BLOCK)]]) + bam.EOF_BLOCK)
    reader = bam.BamReader(str(path))
    got = [b for part in reader.partitions() for b in reader.read(part)]
    assert sum(b.num_rows for b in got) == 60_000 and len(data) > 8 << 20 and max(b.nbytes for b in got) < 6 << 20


def test_an_index_of_many_records_at_once():
    rnd, at, rows = random.Random(3), 0, []
    for ref, pos in sorted((rnd.randrange(2), rnd.randrange(1 << 19)) for _ in range(4000)):
        size = rnd.randrange(40, 3000)
        rows.append((ref, pos, pos + rnd.choice([1, 60, 20_000, 300_000]), *[q // 60_000 * 777 << 16 | q % 60_000 for q in (at, at + size)]))
        at += size
    one, all_, bins = bam.IndexMaker(3), bam.IndexMaker(3), [{} for _ in range(3)]
    for row in rows:
        one.add(*row)
        chunks = bins[row[0]].setdefault(bam.bin_of(*row[1:3]), [])
        if chunks and chunks[-1][1] >> 16 == row[3] >> 16:
            chunks[-1][1] = row[4]
        else:
            chunks.append(list(row[3:]))
    for part in (rows[:1], rows[1:1500], rows[1500:]):
        all_.extend(*np.array(part, np.int64).T)
    assert all_.bins == bins and one.bytes() == all_.bytes()


def test_coordinate_order(spark):
    rows = [("b", "chr2", 5), ("a", "chr10", 1), ("c", "chr2", 5), ("d", None, -1), ("e", "chr1", 9), ("f", "odd", 0)]
    d = spark.createDataFrame(rows, "name string, chrom string, pos long")
    assert [r.name for r in alignments.sort_by_place(d, ["chr1", "chr2", "chr10"]).collect()] == ["e", "b", "c", "a", "f", "d"]


def test_count_tables_of_single_files(spark, tmp_path):
    """Files as another program leaves them."""
    with gzip.open(tmp_path / "P_1.count.gz", "wt") as f:
        f.write("gene_index,cell_index,count\n3,0,2\n4,1,0.5\n")
    (tmp_path / "P_2.count").write_text("gene_index,cell_index,count\n1,0,7\n")
    (tmp_path / "P_2_cell_ids.csv").write_text("cell_index,cell_id,unmatched_rate\n0,P_2.A.B,0.25\n")
    (tmp_path / "gene_ids.csv").write_text('gene_index,gene_id,gene_type,gene_name,feature\n0,g,t,"a,b",exon\n')
    assert sorted(map(tuple, tables.read_triplets(spark, str(tmp_path)).collect())) == [("P_1", 3, 0, 2.0), ("P_1", 4, 1, 0.5), ("P_2", 1, 0, 7.0)]
    assert list(map(tuple, tables.read_cell_ids(spark, str(tmp_path)).collect())) == [("P_2", 0, "P_2.A.B", 0.25)]
    assert tables.read_features(spark, str(tmp_path / "gene_ids.csv")).first().gene_name == "a,b"


@pytest.mark.parametrize("zipped", [False, True])
def test_matrix_parts_make_one_file(spark, tmp_path, zipped):
    rows = [(RND.randrange(40), j, RND.randrange(1, 9)) for j in range(300) for _ in range(2)]
    rows = list({(a, b): (a, b, c) for a, b, c in rows}.values())
    d = spark.createDataFrame(rows, "row long, col long, value long").repartition(5)
    tables.write_matrix_market(d, str(tmp_path / "m.mtx"), 40, 300, gzip=zipped)
    raw = b"".join(f.read_bytes() for f in sorted((tmp_path / "m.mtx").glob("part-*")))
    lines = (gzip.decompress(raw) if zipped else raw).decode().splitlines()
    assert lines[0].startswith("%%MatrixMarket") and lines[2] == f"40 300 {len(rows)}"
    assert lines[3:] == [f"{a + 1} {b + 1} {c}" for b, a, c in sorted((b, a, c) for a, b, c in rows)]
    assert sorted(map(tuple, tables.read_matrix_market(spark, str(tmp_path / "m.mtx")).collect())) == sorted((a, b, float(c)) for a, b, c in rows)


@pytest.fixture
def small_splits(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", 64)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def test_lines_in_file_order(spark, tmp_path, small_splits):
    files = {f"part-{k}": [f"{k} {i} " + "x" * RND.randrange(30) for i in range(n)] for k, n in enumerate((3, 90, 0, 41, 1))}
    for name, rows in files.items():
        (tmp_path / name).write_text("".join(f"{r}\n" for r in rows))
    got = lines.numbered_lines(spark, str(tmp_path)).orderBy("line").collect()
    assert [r.value for r in got] == [x for f in sorted(files) for x in files[f]] and [r.line for r in got] == list(range(135))
    assert [r.in_file for r in got if r.file.endswith("part-3")] == list(range(41))


@pytest.mark.parametrize("sizes", [(1, 50, 3, 700), (700, 3, 50, 1), (0, 10)])
def test_matrix_in_unequal_parts(spark, tmp_path, small_splits, sizes):
    """The parts of one file; the first holds the head."""
    n, want = sum(sizes), []
    for k, size in enumerate(sizes):
        rows = [(RND.randrange(40000), RND.randrange(200), RND.randrange(1, 9)) for _ in range(size)]
        want += [(a, b, float(v)) for a, b, v in rows]
        head = f"%%MatrixMarket matrix coordinate integer general\n%\n40000 200 {n}\n" if k == 0 else ""
        (tmp_path / f"part-{k}.txt").write_text(head + "".join(f"{a + 1} {b + 1} {v}\n" for a, b, v in rows))
    assert sorted(map(tuple, tables.read_matrix_market(spark, str(tmp_path)).collect())) == sorted(want)


def test_matrices_of_other_kinds(spark, tmp_path):
    (tmp_path / "p.mtx").write_text("%%MatrixMarket matrix coordinate pattern general\n% a comment\n\n3 3 2\n1 2\n3 3\n")
    (tmp_path / "s.mtx").write_text("%%MatrixMarket matrix coordinate real symmetric\n2 2 2\n1 1 0.5\n2 1 -3\n")
    (tmp_path / "a.mtx").write_text("%%MatrixMarket matrix array real general\n1 1\n5\n")
    (tmp_path / "none.mtx").write_text("1 1 1\n1 1 5\n")
    get = lambda name: sorted(map(tuple, tables.read_matrix_market(spark, str(tmp_path / name)).collect()))
    assert get("p.mtx") == [(0, 1, 1.0), (2, 2, 1.0)] and get("s.mtx") == [(0, 0, 0.5), (0, 1, -3.0), (1, 0, -3.0)]
    for name in ("a.mtx", "none.mtx"):
        with pytest.raises(ValueError):
            get(name)


def test_packed_lines_are_not_sent_to_every_task(spark, tmp_path):
    spark.range(3000).select(F.concat(F.lit("a,"), F.col("id").cast("string")).alias("x")).repartition(3).write.csv(str(tmp_path / "m"), header=True, compression="gzip")
    for df in (lines.numbered_lines(spark, str(tmp_path / "m")), lines.csv_rows(spark, str(tmp_path / "m"), "i")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BuildLeft" not in plan and "SortMergeJoin" not in plan
    assert sorted(r.i for r in lines.csv_rows(spark, str(tmp_path / "m"), "i").collect()) == list(range(3000))
    assert [r[0] for r in lines.numbered_lines(spark, str(tmp_path / "m")).select("nth").distinct().sort("nth").collect()] == [1, 2, 3]
    one = lines.numbered_lines(spark, str(tmp_path / "m")).where("nth = 2").first().file
    assert lines.numbered_lines(spark, str(tmp_path / "m"), only=[one]).agg(F.min("line"), F.countDistinct("file"), F.count("*")).first()[:2] == (0, 1)


def test_names_in_file_order(spark, tmp_path):
    (tmp_path / "expression_matrix.mtx").write_text("%%MatrixMarket matrix coordinate integer general\n2 3 3\n1 1 7\n2 2 9\n2 3 4\n")
    (tmp_path / "cell_annotation.csv").write_text('cell_id,n\nz.1,5\n"a,1",6\n\nm.1,\n')
    (tmp_path / "feature_annotation.csv").write_text("gene_id,gene_name\nG2,b\nG1,a\n")
    got = tables.read_matrix_bundle(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [("a,1", "G1", 9.0), ("m.1", "G1", 4.0), ("z.1", "G2", 7.0)]
    rows = [(f"c{i}", f"g{j}", i + j) for i in range(7) for j in range(5) if (i * j) % 3]
    counts = spark.createDataFrame(rows, "cell_id string, gene_id string, count long")
    some = lambda c: counts.select(c).distinct().withColumn("place", F.md5(c))
    tables.write_matrix_bundle(counts, some("cell_id"), some("gene_id"), str(tmp_path / "own"), cells_by="place", features_by="place")
    cells_ = [r.cell_id for r in lines.csv_rows(spark, str(tmp_path / "own/cell_annotation.csv.gz"), "i").orderBy("i").collect()]
    assert cells_ != sorted(cells_) and sorted(map(tuple, tables.read_matrix_bundle(spark, str(tmp_path / "own")).collect())) == sorted((c, g, float(n)) for c, g, n in rows)


def test_a_log_is_not_written_over(spark, tmp_path):
    log = spark.createDataFrame([("a", "m", 1)], "prefix string, metric string, value long")
    tables.write_stat_logs(log, str(tmp_path / "logs"))
    with pytest.raises(FileExistsError):
        tables.write_stat_logs(log, str(tmp_path / "logs"))
    assert [f.name for f in (tmp_path / "logs").iterdir() if not f.name.startswith(".")] == ["a.log"]
    assert [tuple(r)[:3] for r in tables.read_stat_logs(spark, str(tmp_path / "logs")).collect()] == [("a", "m", 1)]


def test_many_logs_are_a_file_each(spark, tmp_path):
    """A log is one file in the order of its rows, from however many parts its rows come; names are escaped as partitions are."""
    log = spark.range(4000, numPartitions=8).selectExpr("'p' || (id % 1000) AS prefix", "'m' || (id div 1000) AS metric", "id AS value")
    odd = spark.createDataFrame([("a/b=c", "m", 1), ("a/b=c", "m", 2), (None, "m", 3)], "prefix string, metric string, value long").coalesce(1)
    tables.write_stat_logs(log.unionByName(odd), str(tmp_path / "logs"))
    files = [f for f in (tmp_path / "logs").iterdir() if not f.name.startswith(".")]
    assert len(files) == 1002 and all(f.is_file() for f in files)
    assert (tmp_path / "logs/a%2Fb%3Dc.log").read_text() == "1\tm\n2\tm\n" and (tmp_path / "logs/__HIVE_DEFAULT_PARTITION__.log").exists()
    back = {(r.prefix, r.metric): r.value for r in stats.last_values(tables.read_stat_logs(spark, str(tmp_path / "logs")), "place").collect()}
    assert len(back) == 4001 and back["p7", "m3"] == 3007  # readers pass over names that begin with _


def test_appends_are_ordered(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = lambda *r: spark.createDataFrame(r, "prefix string, metric string, value long")
    assert statlog.last_values(spark, path).count() == 0
    assert statlog.append(rows(("a", "x", 1), ("b", "x", 2)), path, "one", "t1") == 1
    assert statlog.append(rows(("a", "y", 5)), path, "two") == 2
    assert statlog.append(rows(("a", "x", 9)), path, "one again", "t2") == 3
    assert statlog.append(rows(("a", "x", 1), ("b", "x", 2)), path, "one", "t1") == 1  # tried again
    rows(("a", "x", 77)).write.parquet(f"{path}/data/never-committed")
    assert statlog._create(spark, f"{path}/commits/{4:012d}.json", b'{"step": "s", "token": "t9", "data": "none"}') and not statlog._create(spark, f"{path}/commits/{4:012d}.json", b"")
    (tmp_path / "log/commits/000000000004.json").unlink()
    with pytest.raises(ValueError, match="more than one"):
        statlog.append(rows(("a", "x", 1), ("a", "x", 2)), path, "twice")
    assert {(r.prefix, r.metric): r.value for r in statlog.last_values(spark, path).collect()} == {("a", "x"): 9, ("b", "x"): 2, ("a", "y"): 5}


def test_layers_of_blocks(spark, tmp_path):
    rows = list({(f"s:c{RND.randrange(40):02d}", f"g{RND.randrange(30)}", RND.choice(["spliced", "unspliced", "ambiguous"])): RND.randrange(1, 9) for _ in range(900)}.items())
    rows = [(*k, n) for k, n in rows]
    counts = spark.createDataFrame(rows, "cell_id string, gene_id string, layer string, count long").repartition(4)
    cells_ = spark.createDataFrame([(f"s:c{i:02d}", i) for i in range(41)], "cell_id string, n int")  # one has no counts
    at = str(tmp_path / "a")
    layers.write_layers(counts, at, cells=cells_, width=7)
    plain_ = lambda df: sorted(map(tuple, df.collect()))
    want = sorted((c, g, layer, float(n)) for c, g, layer, n in rows)
    assert plain_(layers.read_layers(spark, at)) == want
    assert layers.read_cells(spark, at).count() == 41 and all(r.pointers[0] == 0 and len(r.indices) == r.pointers[-1] == len(r["values"]) for r in layers.read_blocks(spark, at).collect())
    some = layers.read_layers(spark, at, layers=["spliced"], cells=["s:c03", "s:c20", "none"])
    assert plain_(some) == [x for x in want if x[2] == "spliced" and x[0] in ("s:c03", "s:c20")]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(layer" in plan or "PartitionFilters: [layer" in plan
    assert "PushedFilters: [In(block" in plan or "In(block, [" in plan
    with pytest.raises(FileExistsError):
        layers.write_layers(counts, at)
    other = spark.createDataFrame([("t:d1", "g7", "spliced", 3), ("t:d1", "new", "spliced", 2), ("t:d2", "g1", "other", 5)], "cell_id string, gene_id string, layer string, count long")
    layers.write_layers(other, str(tmp_path / "b"), features=spark.createDataFrame([("new", 1, "x"), ("g7", 2, "y"), ("g1", 3, "z")], "gene_id string, o int, name string"), features_by="o")
    layers.write_layers(counts.limit(0), str(tmp_path / "none"))
    layers.merge_layers(spark, [at, str(tmp_path / "none"), str(tmp_path / "b")], str(tmp_path / "all"), layers.behind_colon)
    both = want + [("t:d1", "g7", "spliced", 3.0), ("t:d1", "new", "spliced", 2.0), ("t:d2", "g1", "other", 5.0)]
    assert plain_(layers.read_layers(spark, str(tmp_path / "all"))) == sorted((c.split(":")[1], g, layer, n) for c, g, layer, n in both)
    assert layers.read_cells(spark, str(tmp_path / "all")).count() == 43


def test_ranks_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(ranks, "RANGE", 50)
    keys = [f"k{RND.randrange(10**6)}" for _ in range(400)]
    got = ranks.ranked(spark.createDataFrame([(k,) for k in keys], "k string"), "k", "i").collect()
    assert [r.k for r in sorted(got, key=lambda r: r.i)] == sorted(keys) and sorted(r.i for r in got) == list(range(400))


def test_stat_logs(spark, tmp_path):
    (tmp_path / "P_1.log").write_text("10\treads_total\n4\talignments\n5\talignments\n")
    log = stats.last_values(tables.read_stat_logs(spark, str(tmp_path)), "place")
    assert {(r.prefix, r.metric): r.value for r in log.collect()} == {("P_1", "reads_total"): 10, ("P_1", "alignments"): 5}
    tables.write_stats(stats.pivot(log), str(tmp_path / "stats.csv"))
    row = spark.read.csv(str(tmp_path / "stats.csv"), header=True).first()
    assert (row.prefix, row.alignments, row.reads_trimmed) == ("P_1", "5", "-1")


def test_versions_and_checks(spark, tmp_path):
    root = str(tmp_path / "out")
    d = spark.range(3)
    assert paths.write_versioned(d, root).endswith("/v1") and paths.write_versioned(d.limit(1), root).endswith("/v2")
    assert paths.versions(spark, root) == [1, 2] and paths.latest(spark, root).count() == 1
    paths.require(spark, root)
    with pytest.raises(FileNotFoundError):
        paths.require(spark, root, root + "x")
    with pytest.raises(ValueError):
        tables.write_bundle(str(tmp_path / "x.rds"), a=d)


def test_workbook(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="dT" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>Well</t></si><si><r><t>Bar</t></r><r><t>code</t></r></si><si><t>A1</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row><c r="A2" t="s"><v>2</v></c><c r="C2" t="inlineStr"><is><t>ACGT</t></is></c></row><row><c r="C3"><v>7</v></c></row></sheetData></worksheet>')
    got = tables.read_workbook(spark, str(tmp_path / "b.xlsx"))["dT"]
    assert got.columns == ["Well", "Barcode"] and sorted(map(str, got.collect())) == sorted(["Row(Well='A1', Barcode='ACGT')", "Row(Well=None, Barcode='7')"])


def brute_quality(qual, least):
    total = top = cut = 0
    for i, q in enumerate(reversed(qual)):
        total += least - (ord(q) - 33)
        if total < 0:
            break
        if total > top:
            top, cut = total, i + 1
    return len(qual) - cut


def test_quality_and_adapters(spark):
    quals = ["".join(chr(33 + RND.choice([2, 15, 19, 20, 21, 38])) for _ in range(RND.randrange(0, 40))) for _ in range(200)]
    d = spark.createDataFrame([("A" * len(q), q) for q in quals], "s string, q string")
    assert [r.n for r in d.select(reads.trim_quality(F.col("s"), F.col("q")).alias("n")).collect()] == [brute_quality(q, 20) for q in quals]
    adapter = "AGATCGGAAGAGC"
    seqs = ["".join(RND.choice("ACGT") for _ in range(RND.randrange(0, 30))) + adapter[: RND.randrange(14)] for _ in range(200)] + [None, ""]
    want = []
    for s in seqs:
        want.append(None if s is None else next((i for i in range(len(s) - 2) if sum(a != b for a, b in zip(s[i : i + 13], adapter)) <= int(0.1 * len(s[i : i + 13]))), len(s)))
    assert reads.adapter_at(seqs, adapter, 3, 0.1) == want
    rows = [("x", "ACGT" * 6 + adapter, "I" * 37, "CCGT" * 5 + "A" * 9, "I" * 29), ("y", "ACGT" * 9, "I" * 10 + "!" * 26, "CCGT" * 9, "I" * 36)]
    got = reads.trim_pairs(spark.createDataFrame(rows, "name string, r1_seq string, r1_qual string, r2_seq string, r2_qual string")).collect()
    assert [(r.name, r.r1_seq, len(r.r1_qual), r.r2_seq, len(r.r2_qual)) for r in got] == [("x", "ACGT" * 6, 24, "CCGT" * 5, 20)]


def test_final_cells_without_twins(spark):
    c = spark.createDataFrame([("p", "l", "t1", "g1", 3), ("p", "l", "n1", "g1", 2), ("p", "l", "n1", "g2", 0), ("p", "l", "zz", "g1", 9), ("q", "l", "t1", "g2", 0)], "pcr_batch string, ligation_barcodes string, rt_barcodes string, gene_id string, count long")
    rate = spark.createDataFrame([("p", "l", "t1", 0.2), ("p", "l", "n1", 0.5), ("p", "l", "zz", 0.0), ("q", "l", "t1", 1.0)], "pcr_batch string, ligation_barcodes string, rt_barcodes string, unmatched_rate double")
    p = spark.createDataFrame([("t1", "t1", False, "s"), ("n1", "t1", True, "s")], "rt string, shortdt string, is_randomn boolean, sample string")
    got = cells.cell_annotation(c, rate, p).collect()
    assert len(got) == 1 and got[0].asDict() | {"unmatched_rate": 0} == {"cell_id": "p.l.t1", "unmatched_rate": 0, "umi_count": 5, "gene_count": 1, "pcr_batch": "p", "ligation_barcodes": "l", "shortdt_umi_count": 3.0, "randomn_umi_count": 2.0, "rt_barcodes_shortdt": "t1", "sample": "s"}
    assert abs(got[0].unmatched_rate - (0.2 * 3.75 + 0.5 * 4) / 7.75) < 1e-9


def test_genome_files(spark, tmp_path):
    (tmp_path / "r.gtf").write_text('chr1\trmsk\texon\t11\t20\t1\t+\t.\tgene_id "L1"; transcript_id "L1_1";\n')
    assert genome.resolve(spark, str(tmp_path / "r.gtf")) == str(tmp_path / "r.gtf")
    with pytest.raises(FileNotFoundError):
        genome.resolve(spark, str(tmp_path / "no.gtf"))
    (tmp_path / "page.html").write_text("<html></html>")
    with pytest.raises(ValueError):
        genome.fetch((tmp_path / "page.html").as_uri(), str(tmp_path / "x"))
    with pytest.raises(ValueError):
        genome.repeats_form("xx1")
    copied = genome._shared(spark, lambda local: genome.fetch((tmp_path / "r.gtf").as_uri(), local), "r.gtf")
    assert tuple(genome.read_repeats(spark, copied).first()) == ("chr1", 10, 20, "+", "L1")
