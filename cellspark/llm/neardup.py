"""N-gram Jaccard join by a MinHash LSH forest, with exact verification.

Words are `[^\\x20\\x09-\\x0D]+`; a text's set is its five-word shingles (all its words as one where it has fewer).

1. Texts with equal sets form a class; classes, not copies, go on.
2. Forest.  A class has a signature of TREES * DEPTH hashes, DEPTH a tree.  In each tree classes are sorted by signature:
   a prefix trie.  The matched prefix is shortened from DEPTH until the recall 1 - (1 - s^d)^TREES at the threshold s
   reaches TARGET.  All classes that share the prefix are compared, and tied if their signatures agree in 0.6 of all
   places, which two similar sets miss by six standard errors; the ties' components are families.  Equal crowds of
   several trees are compared once, crowds of more than SPAN classes in pairs of tiles; edges are linear in a crowd's classes.
3. Verification.  Sets of a family meet and all its pairs are compared exactly, in tiles: a large family is cut into
   tiles of TILE classes, and each pair of tiles is a group of its own.  Pairs are counted where they meet and never
   become rows; a tile gives each class its number of links and one edge to its local component.

A row's n_links is the number of other documents with similarity 0.8 or more, copies included; class_id is the smallest id
of its connected component.

Cases: a null or empty text has no words, no links, and is its own class (two empty texts are not linked); equal rows are
copies; rows with a null id take part, and are named where they alone make a component by a null class_id; texts of fewer
than five words match texts of the same words; very long texts are taken whole; an empty table gives an empty table;
other columns are not touched.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Rolling, by_key, filled, lean, raw, slices, stored, table, u64_mix, word_spans
from .components import connected_components

WORDS = 5
NUM, DEN = 4, 5  # similarity
TREES, DEPTH = 32, 5
TARGET = 0.999999
AGREE = 0.6
TILE = 1024
_BASE = 0xD6E8FEB86659FD93
SPAN = 8192
#: Buckets of the forest that a partition is read in.
FINE = 3
LEAF = np.dtype([("key", "<u8"), ("hi", "<u8"), ("lo", "<u8")])


def depth_for(threshold: float, trees: int, depth: int, target: float) -> int:
    """The longest prefix that reaches the target recall."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    return depth


def shingles(texts: pa.Array, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of all rows, sorted within a row; row offsets)."""
    data, off = raw(texts)
    starts, ends, first = word_spans(data, off)
    n = np.diff(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(n) + 1, np.int64)
    words = Rolling(data, _BASE, {}).of(starts, ends) ^ (ends - starts).astype(np.uint64)
    row = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(starts)) - first[:-1][row]
    with np.errstate(over="ignore"):
        whole = np.zeros(len(words), np.uint64)
        for i in range(k):
            # a text of fewer than k words is one shingle from its first word on
            here = place + i < n[row]
            w = np.zeros(len(words), np.uint64)
            w[here] = words[np.flatnonzero(here) + i]
            whole = u64_mix(whole * np.uint64(0x9E3779B97F4A7C15) + w + np.uint64(1))
    keep = place < np.maximum(n[row] - k + 1, 1)
    h, r = whole[keep], row[keep]
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (r[1:] != r[:-1])])
    h, r = h[new], r[new]
    return h, np.searchsorted(r, np.arange(len(n) + 1))


def signatures(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(rows, TREES * DEPTH) MinHash values of rows with shingles."""
    full = np.flatnonzero(np.diff(off) > 0)
    out = np.zeros((len(off) - 1, TREES * DEPTH), np.uint32)
    if len(full):
        seeds = u64_mix(np.arange(1, TREES * DEPTH + 1)) | np.uint64(1)
        with np.errstate(over="ignore"):
            for i, a in enumerate(seeds):
                x = (h ^ (a >> np.uint64(7))) * a
                out[full, i] = np.minimum.reduceat(x, off[:-1][full]) >> np.uint64(32)
    return out


def digests(h: np.ndarray, off: np.ndarray) -> list[bytes | None]:
    """128 bits of each set; None for the empty one."""
    with np.errstate(over="ignore"):
        a = np.concatenate([[np.uint64(0)], np.cumsum(u64_mix(h), dtype=np.uint64)])
        b = np.concatenate([[np.uint64(0)], np.cumsum(u64_mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)])
        a, b = a[off[1:]] - a[off[:-1]], b[off[1:]] - b[off[:-1]]
    both = np.stack([a, b], 1).astype(">u8")
    return [x.tobytes() if n else None for x, n in zip(both, np.diff(off).tolist())]


def sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, cid (set digest, null for no words), n (shingles), sig of each row."""

    def run(batches):
        for batch in batches:
            texts = filled(batch, "text")
            for lo, hi in slices(texts, 2 << 20):
                h, off = shingles(texts.slice(lo, hi - lo))
                sig = signatures(h, off)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(digests(h, off), pa.binary()), pa.array(np.diff(off), pa.int64()), pa.array([s.tobytes() for s in sig], pa.binary())], names=["doc", "cid", "n", "sig"])

    return docs.select(docs[id_col].cast("long").alias("doc"), docs[text_col].alias("text")).mapInArrow(lean(run), "doc long, cid binary, n long, sig binary")


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (the smallest place of each component) after a and b are tied."""
    a, b = np.concatenate([np.arange(len(label)), a]), np.concatenate([label, b])
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for at in (a, b, label[a], label[b]):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def tie(start: np.ndarray, side: np.ndarray, low: np.ndarray, block: int = 1024, few: int = 64) -> np.ndarray:
    """For each row the smallest row of its component, where rows of a group are tied if they agree in AGREE of all places.

    start: where each group begins; side: 0 where all pairs of a group count, else 1 and 2, and only pairs across count.
    """
    n = len(low)
    size = np.diff(np.append(start, n))
    group = np.repeat(np.arange(len(start)), size)
    label = np.arange(n)
    at = np.flatnonzero(size[group] <= few)  # all small groups at once, by the distance of two rows
    left, right = [], []
    for k in range(1, few):
        i, j = at[:-k], at[k:]
        i, j = (x[(group[i] == group[j]) & ((side[i] == 0) | (side[i] != side[j]))] for x in (i, j))
        near = (low[i] == low[j]).mean(1) >= AGREE
        left.append(i[near])
        right.append(j[near])
        if not (group[at[:-k]] == group[at[k:]]).any():
            break
    if left:
        label = _merge(label, np.concatenate(left), np.concatenate(right))
    kind = np.uint8 if low.shape[1] < 256 else np.uint16
    for g in np.flatnonzero(size > few).tolist():
        lo, hi = int(start[g]), int(start[g] + size[g])
        cols = np.ascontiguousarray(low[lo:hi].T)
        cut = int((side[lo:hi] < 2).sum())  # rows are sorted by side
        cross = cut < hi - lo
        mine = np.arange(hi - lo)
        for i in range(0, cut, block):
            ii = min(i + block, cut)
            for j in range(cut if cross else i, hi - lo, block):
                jj = min(j + block, hi - lo)
                if (mine[i:ii] == mine[i]).all() and (mine[j:jj] == mine[i]).all():
                    continue  # one component already
                same = np.zeros((ii - i, jj - j), kind)
                for c in cols:
                    same += c[i:ii, None] == c[None, j:jj]
                a, b = np.nonzero(same >= AGREE * len(cols))
                a, b = mine[a + i], mine[b + j]
                if (a != b).any():
                    a, b = np.unique(np.stack([a, b])[:, a != b], axis=1)
                    mine = _merge(mine, a, b)
        label[lo:hi] = mine + lo
    return label


def families(classes: DataFrame, trees: int = TREES, depth: int = DEPTH, span: int = SPAN) -> DataFrame:
    """classes: cid, sig -> node, component: families of classes that may hold similar ones."""
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fine = parts * FINE
    d = depth_for(NUM / DEN, trees, depth, TARGET)

    def leaves(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(batch.num_rows, trees, depth)
            key = np.zeros((batch.num_rows, trees), np.uint64) + np.arange(trees, dtype=np.uint64)
            with np.errstate(over="ignore"):
                for i in range(d):
                    key = u64_mix(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, i].astype(np.uint64) + np.uint64(1))
            rec = np.zeros(key.size, LEAF)
            rec["key"] = key.ravel()
            cid = np.frombuffer(b"".join(batch.column(0).to_pylist()), ">u8").reshape(-1, 2)
            rec["hi"], rec["lo"] = np.repeat(cid[:, 0], trees), np.repeat(cid[:, 1], trees)
            bucket = (rec["key"] % np.uint64(fine)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            rec, bucket = rec[order], bucket[order]
            cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[cut], pa.int32()), pa.array([rec[i:j].tobytes() for i, j in zip(cut, [*cut[1:], len(rec)])], pa.binary())], names=["bucket", "leaves"])

    def crowds(batches):
        for _, blobs in by_key(batches, 0, 1):  # rows come sorted by bucket
            yield from crowds_in(np.frombuffer(b"".join(blobs), LEAF))

    def crowds_in(rec: np.ndarray):
        order = np.argsort(rec["key"], kind="stable")
        same = rec["key"][order][1:] == rec["key"][order][:-1]
        rec = rec[order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]]
        rec = rec[np.lexsort((rec["lo"], rec["hi"], rec["key"]))]
        cells = np.stack([rec["hi"], rec["lo"]], 1).astype(">u8")
        cut = np.flatnonzero(np.concatenate([[True], rec["key"][1:] != rec["key"][:-1]])) if len(rec) else np.zeros(0, np.int64)
        left, right, n = [], [], 0
        for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(rec)]):
            tiles = [cells[i : min(i + span, hi)].tobytes() for i in range(lo, hi, span)]
            for i, x in enumerate(tiles):
                for y in [b"", *tiles[i + 1 :]]:
                    left.append(x)
                    right.append(y)
                    n += len(x) + len(y)
                    if n > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["x", "y"])
                        left, right, n = [], [], 0
        if left:
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["x", "y"])

    def members(batches):
        for batch in batches:
            cells, crowd, side = [], [], []
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                name = blake2b(x + b"|" + y, digest_size=16).digest()
                a, b = len(x) // 16, len(y) // 16
                cells += [x[i : i + 16] for i in range(0, len(x), 16)] + [y[i : i + 16] for i in range(0, len(y), 16)]
                crowd += [name] * (a + b)
                side += [1 if b else 0] * a + [2] * b
                if len(cells) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(cells, pa.binary()), pa.array(crowd, pa.binary()), pa.array(side, pa.int32())], names=["cid", "crowd", "side"])
                    cells, crowd, side = [], [], []
            if cells:
                yield pa.RecordBatch.from_arrays([pa.array(cells, pa.binary()), pa.array(crowd, pa.binary()), pa.array(side, pa.int32())], names=["cid", "crowd", "side"])

    def low_bytes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([np.frombuffer(s, np.uint32).astype(np.uint8).tobytes() for s in batch.column(1).to_pylist()], pa.binary())], names=["cid", "low"])

    def ties(cid, start, side, low):
        label = tie(start, side, low)
        i = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in cid[i]], pa.binary()), pa.array([x.tobytes() for x in cid[label[i]]], pa.binary())], names=["a", "b"])

    def alike(batches):  # rows come sorted by crowd; one that goes on in the next batch waits for it
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            got = [raw(batch.column(c))[0].reshape(batch.num_rows, -1) for c in (0, 1, 3)] + [batch.column(2).to_numpy()]
            if held is not None:
                got = [np.concatenate(x) for x in zip(held, got)]
            cid, crowd, low, side = got
            start = np.flatnonzero(np.concatenate([[True], (crowd[1:] != crowd[:-1]).any(1)]))
            last = int(start[-1])
            if last:
                yield ties(cid[:last], start[:-1], side[:last], low[:last])
            held = [x[last:].copy() for x in got]
        if held is not None:
            yield ties(held[0], np.zeros(1, np.int64), held[3], held[2])

    met = classes.select("cid", "sig").mapInArrow(lean(leaves), "bucket int, leaves binary").repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(lean(crowds), "x binary, y binary").distinct()
    small = classes.select("cid", "sig").mapInArrow(lean(low_bytes), "cid binary, low binary")
    wide = met.mapInArrow(lean(members), "cid binary, crowd binary, side int").join(small.hint("merge"), "cid").select("cid", "crowd", "side", "low")
    return connected_components(wide.repartition(parts, "crowd").sortWithinPartitions("crowd", "side", "cid").mapInArrow(lean(alike), "a binary, b binary"))


def links_in(sets: list[np.ndarray], weight: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each set: the weight of sets linked to it, and the smallest index in its component.

    side: 0 where all pairs count (one tile); else 1 and 2, and only pairs across count.  Intersections come from a
    product of 0/1 matrices over the shingles that two sets share, in blocks of shingles.
    """
    m = len(sets)
    size = np.array([len(s) for s in sets])
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(m), size)
    count = np.bincount(code)
    new = np.where(count > 1, np.cumsum(count > 1) - 1, -1)
    code = new[code]
    row, code = row[code >= 0], code[code >= 0]
    common = np.zeros((m, m), np.float32)
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    width = 4096
    for lo in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        i, j = np.searchsorted(code, [lo, lo + width])
        x = np.zeros((m, width), np.float32)
        x[row[i:j], code[i:j] - lo] = 1
        common += x @ x.T
    near = (NUM + DEN) * common.astype(np.int64) >= NUM * (size[:, None] + size[None, :])
    near[np.arange(m), np.arange(m)] = False
    if side.any():
        near &= side[:, None] != side[None, :]
    label = np.arange(m)
    while True:
        low = np.minimum(label, np.where(near, label[None, :], m).min(1, initial=m))
        low = low[low]
        if (low == label).all():
            return near @ weight, label
        label = low


def verified(docs: DataFrame, members: DataFrame, id_col: str, text_col: str, tile: int = TILE) -> DataFrame:
    """members: cid, rep (a document of the class, or null), copies, family, tiles -> cid, links, peer: a row for each class and tile pair.

    Only the members' texts are shuffled on, as sets.  Classes of rows with null ids have no rep and meet their texts by cid.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(docs[id_col].cast("long").alias("rep"), docs[text_col].alias("text")).where(F.col("text").isNotNull())
    joined = texts.join(members.where("rep IS NOT NULL").hint("merge"), "rep").select("text", "cid", "copies", "family", "tiles")

    def named(batches):
        for batch in batches:
            for lo, hi in slices(batch.column(0), 2 << 20):
                part = batch.column(0).slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part, pa.array(digests(*shingles(part)), pa.binary())], names=["text", "cid"])

    if members.where("rep IS NULL").limit(1).count():
        bare = texts.where("rep IS NULL").select("text").mapInArrow(lean(named), "text string, cid binary").dropDuplicates(["cid"])
        joined = joined.unionByName(bare.join(members.where("rep IS NULL").hint("merge"), "cid").select("text", "cid", "copies", "family", "tiles"))

    def sets(batches):
        for batch in batches:
            out = []
            texts = batch.column(0)
            for lo, hi in slices(texts, 2 << 20):
                h, off = shingles(texts.slice(lo, hi - lo))
                dig = digests(h, off)
                for i in range(hi - lo):
                    cid, copies, family, tiles = (batch.column(c)[lo + i].as_py() for c in (1, 2, 3, 4))
                    if dig[i] != cid:  # another text under the same id
                        continue
                    mine = int.from_bytes(cid[:4], "big") % tiles
                    data = h[off[i] : off[i + 1]].tobytes()
                    for j in range(tiles):
                        a, b = min(mine, j), max(mine, j)
                        key = family + a.to_bytes(4, "big") + b.to_bytes(4, "big")
                        out.append((key, cid, copies, 0 if a == b else 1 if mine == a else 2, data))
                        if len(out) >= 2000:
                            yield _set_batch(out)
                            out = []
            if out:
                yield _set_batch(out)

    def count(batches):
        key, rows = None, []
        for batch in batches:
            for r in zip(*[c.to_pylist() for c in batch.columns]):
                if r[0] != key and rows:
                    yield from _tile(rows)
                    rows = []
                key = r[0]
                rows.append(r)
        if rows:
            yield from _tile(rows)

    dealt = joined.mapInArrow(lean(sets), "key binary, cid binary, copies long, side int, data binary")
    return dealt.repartition(parts, "key").sortWithinPartitions("key", "cid").mapInArrow(lean(count), "cid binary, links long, peer binary")


def _set_batch(out: list) -> pa.RecordBatch:
    cols = list(zip(*out))
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.binary())], names=["key", "cid", "copies", "side", "data"])


def _tile(rows: list):
    rows = [r for i, r in enumerate(rows) if not i or rows[i - 1][1] != r[1]]  # rows are sorted: equal rows of a repeated id go
    if len(rows) < 2:
        return
    links, label = links_in([np.frombuffer(r[4], np.uint64) for r in rows], np.array([r[2] for r in rows]), np.array([r[3] for r in rows]))
    cids = [r[1] for r in rows]
    yield pa.RecordBatch.from_arrays([pa.array(cids, pa.binary()), pa.array(links, pa.int64()), pa.array([cids[i] for i in label], pa.binary())], names=["cid", "links", "peer"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """One row a row of docs: doc_id, class_id, n_links, cid (digest of its set), is_kept.

    is_kept marks one document of each component: the smallest id, and of rows with that id the one of the smallest set
    digest; exact doubles of that row are told apart by their users.
    """
    sketched = stored(sketch(docs, id_col, text_col), "neardup-sketch")
    classes = stored(sketched.where("cid IS NOT NULL").groupBy("cid").agg(F.min("doc").alias("rep"), F.count("*").alias("copies"), F.first("sig").alias("sig")), "neardup-classes")
    family = families(classes)
    size = family.groupBy("component").agg(F.count("*").alias("n")).withColumn("tiles", F.ceil(F.col("n") / tile).cast("int"))
    members = family.join(size, "component").join(classes.select(F.col("cid").alias("node"), "rep", "copies"), "node").select(F.col("node").alias("cid"), "rep", "copies", F.col("component").alias("family"), "tiles")
    tiles = stored(verified(docs, stored(members, "neardup-members"), id_col, text_col, tile), "neardup-links")
    links = tiles.groupBy("cid").agg(F.sum("links").alias("links"))
    comp = connected_components(tiles.select(F.col("cid").alias("a"), F.col("peer").alias("b")))
    root = classes.select("cid", "rep", "copies").join(comp.select(F.col("node").alias("cid"), "component"), "cid", "left").join(links, "cid", "left")
    root = root.select("cid", "rep", "copies", F.coalesce("component", "cid").alias("component"), F.coalesce("links", F.lit(0)).alias("links"))
    low = root.groupBy("component").agg(F.min("rep").alias("class_id"), F.min(F.struct(F.col("rep").isNull().alias("bare"), "rep", "cid")).alias("lead"))
    of_class = root.join(low, "component").select("cid", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links"), F.col("lead.cid").alias("lead"))
    out = sketched.select("doc", "cid").join(of_class.hint("merge"), "cid", "left")  # hot classes are split by the adaptive join
    return out.select(F.col("doc").alias("doc_id"), F.coalesce("class_id", "doc").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "cid", (F.col("cid").isNull() | ((F.col("cid") == F.col("lead")) & F.col("doc").eqNullSafe(F.coalesce("class_id", "doc")))).alias("is_kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each component: that of the smallest id.  Texts without words stay."""
    found = near_duplicates(docs, id_col, text_col).where("is_kept")
    key = lambda i, c: F.sha2(F.concat_ws(":", F.coalesce(i.cast("string"), F.lit("null")), F.coalesce(F.hex(c), F.lit("-"))), 256)
    kept = stored(found.groupBy(key(F.col("doc_id"), F.col("cid")).alias("__key")).agg(F.count("*").alias("__n"), F.first("cid").isNull().alias("__bare")), "neardup-kept")
    at = docs.columns.index(text_col)
    shape = docs.select("*", F.lit(b"").alias("__cid")).schema

    def add(batches):
        for batch in batches:
            texts = batch.column(at)
            texts = texts.fill_null("") if texts.null_count else texts
            cid = []
            for lo, hi in slices(texts, 2 << 20):
                cid += digests(*shingles(texts.slice(lo, hi - lo)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cid, pa.binary())], names=[*batch.schema.names, "__cid"])

    for field in shape:
        field.nullable = True
    marked = docs.mapInArrow(lean(add), shape).withColumn("__key", key(F.col(id_col), F.col("__cid")))
    out = marked.join(kept.hint("merge"), "__key")
    if kept.where("__n > 1 AND NOT __bare").limit(1).count():  # repeated rows of one id
        once = out.where("__n > 1 AND NOT __bare").dropDuplicates(["__key"])
        out = out.where("__n = 1 OR __bare").unionByName(once)
    return out.select(*docs.columns)


def op8_jaccard_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
c AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (
  SELECT x, y FROM p JOIN c a ON x = a.doc_id JOIN c b ON y = b.doc_id WHERE 9 * k >= 4 * (a.n + b.n)),
r(x, y) AS (
  SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
m AS (
  SELECT x, min(y) AS low FROM r GROUP BY x),
k AS (
  SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT doc_id, least(doc_id, coalesce(low, doc_id)) AS class_id, coalesce(k.n, 0)::BIGINT AS n_links
FROM documents LEFT JOIN m ON doc_id = m.x LEFT JOIN k ON doc_id = k.x
"""
