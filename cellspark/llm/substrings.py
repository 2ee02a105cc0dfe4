"""Removal of repeated byte strings across a corpus, from enhanced suffix arrays.

Every byte covered by a string of LENGTH bytes that also starts earlier (smaller id, or same document and earlier start)
goes.  Work follows the repeats, not the pairs:

1. Anchors.  Of the GRAM-byte hashes in each window of LENGTH bytes the smallest (leftmost) is its anchor, so equal
   windows have equal anchors at equal places.  A document's windows fall into runs with one anchor, one record a run.
2. Records meet by anchor, in fine buckets that stream through a task.  An anchor of more than one record is owned by the
   document (and the segment of it) that shows it first, and the owner is told to all documents that show it.
3. Stretches.  A document's neighbouring runs of one owner make one stretch of text, however long; stretches meet by owner.
   As the owner follows from the anchor, equal windows always meet.
4. Suffix array.  Of an owner's stretches those suffixes are sorted that share their first LENGTH bytes with another one
   and, together, do not all follow the same byte: no other suffix begins a maximal repeat, so this test of left
   extension spares the sort of all places inside repeats.  A stack scan of the common prefixes gives the interval tree;
   each interval is a maximal repeat with all its occurrences, and all but the first occurrence go.  Stretches that are
   equal as a whole are one text with several occurrences.
5. Repeats meet their documents, whose bytes are cut.

Texts are shuffled once (the exchange serves steps 3 and 5).  Nothing crosses documents.

Crowds are split and pre-aggregated, with the same removed bytes: where a batch holds more than CROWD equal runs of an
anchor (compared by their bytes), only the first goes on and the others go as repeats; where it holds many different ones,
or all batches together hold more than HOT, the anchor's suffixes are dealt by their first LENGTH bytes (the interval at
that depth, named by 128 bits) instead of by owner, after the first of each batch was kept.

repeats() gives the groups and does none of this: a stretch goes to its owner with the byte before it and with the text
behind it as far as shared anchors go on, so an owner sees every occurrence of the repeats that begin in its text, to
their ends.  How finely owners are cut has no part in the result.

Cases: a null text is empty; texts shorter than LENGTH lose nothing; rows of one id and one text are one document, and
equal; rows of one id and different texts are documents of their own, in order of a text hash; null ids come last; very
long texts are taken whole; an empty table gives an empty table; other columns are not touched.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Rolling, by_key, lean, raw, slices, stored, table, u64_mix
from .suffix import SparseSuffixes

LENGTH = 100
GRAM = 32
CROWD = 64
HOT = 4096
#: (different runs of an anchor up to, bytes of a segment): owners of crowded anchors are cut finer.
SEGMENTS = ((64, 1 << 16), (512, 1 << 12), (HOT, 1 << 10))
#: Stretches whose suffixes are sorted at once, where groups are small.
GROUP_BYTES = 1 << 20
#: Buckets that a partition is read in.
FINE = 3
NULL_ID = 2**63 - 1
_B1, _B2 = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1

#: One run of windows: anchor hash, document (id, text hash), start, a hash of its bytes, bytes; crowd: stands for a batch's crowd.
RECORD = np.dtype([("h", "<u8"), ("doc", "<i8"), ("th", "<i8"), ("a", "<i4"), ("c", "<u4"), ("n", "<i4"), ("crowd", "u1")])
#: What a document learns of a run: a repeat, a run of an owner's stretch, or a run of a hot anchor.
NOTE = np.dtype([("doc", "<i8"), ("th", "<i8"), ("a", "<i4"), ("n", "<i4"), ("kind", "u1"), ("key", "<u8")])
REPEAT, SHARED, CROWDED = 0, 1, 2
SPAN = np.dtype([("a", "<i4"), ("n", "<i4")])
WINDOW = np.dtype([("w", "<u8"), ("v", "<u8"), ("doc", "<i8"), ("th", "<i8"), ("a", "<i4")])


def runs(data: np.ndarray, off: np.ndarray, length: int, gram: int, powers: dict):
    """(start, bytes, anchor hash, hash of bytes) of the runs of windows with one anchor, starts in the whole array."""
    n = len(data)
    empty = np.zeros(0, np.int64)
    starts = np.maximum(off[1:] - length + 1, off[:-1])  # one past the last window of each row
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, off[:-1], 1)
    np.add.at(d, starts, -1)
    valid = np.flatnonzero(np.cumsum(d[:-1]) > 0)
    if not len(valid):
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    roll = Rolling(data, _B1, powers)
    at = np.arange(n - gram + 1)
    with np.errstate(over="ignore"):
        key = u64_mix((roll.sums[gram:] - roll.sums[:-gram]) * roll.up[: n - gram + 1])
    low = (key >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64)
    width, got = length - gram + 1, 1
    while got < width:  # smallest of each window of `width` grams, by doubling
        step = min(got, width - got)
        low = np.minimum(low[:-step], low[step:])
        got += step
    pick = (low[valid] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cut = np.concatenate([[True], (pick[1:] != pick[:-1]) | (valid[1:] != valid[:-1] + 1)])
    a, p = valid[cut], pick[cut]
    last = valid[np.concatenate([np.flatnonzero(cut)[1:] - 1, [len(valid) - 1]])]
    stop = last + length
    whole = Rolling(data, _B2, powers).of(a, stop)
    with np.errstate(over="ignore"):
        whole = u64_mix(whole ^ (((p - a).astype(np.uint64) << np.uint64(32)) | (stop - a).astype(np.uint64)))
    return a, stop - a, key[p], whole


def pieces(data: np.ndarray, off: np.ndarray, length: int, gram: int, powers: dict, most: int = 1 << 22):
    """runs(), for one long row in pieces that share no window; a run at a border is two."""
    if len(off) > 2 or len(data) <= most:
        return runs(data, off, length, gram, powers)
    got = []
    for lo in range(0, len(data) - length + 1, most):
        part = data[lo : lo + most + length - 1]
        a, n, h, c = runs(part, np.array([0, len(part)]), length, gram, powers)
        got.append((a + lo, n, h, c))
    return tuple(np.concatenate(x) for x in zip(*got))


# --- small pieces ---------------------------------------------------------------------------------------------------


def heads(*cols: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    out = np.ones(len(cols[0]), bool)
    if len(out) > 1:
        out[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
    return out


def sizes(head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each row's group, rows of each group)."""
    return np.cumsum(head) - 1, np.diff(np.append(np.flatnonzero(head), len(head)))


def cells(part: np.ndarray, rec: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Records packed by part."""
    order = np.argsort(part, kind="stable")
    part, rec = part[order], rec[order]
    cut = np.flatnonzero(heads(part)).tolist() if len(part) else []
    return part[cut].tolist(), [rec[i:j].tobytes() for i, j in zip(cut, [*cut[1:], len(rec)])]


def spread(doc: np.ndarray, parts: int) -> np.ndarray:
    return (u64_mix(doc) % np.uint64(parts)).astype(np.int64)


def found(doc: np.ndarray, th: np.ndarray, a: np.ndarray, n) -> tuple[list, list, list]:
    """(documents, text hashes, packed spans): one row a document; overlapping spans are joined."""
    if not len(doc):
        return [], [], []
    order = np.lexsort((a, th, doc))
    doc, th, a = doc[order], th[order], a[order].astype(np.int64)
    stop = a + (n[order] if isinstance(n, np.ndarray) else n)
    new = heads(doc, th)
    base = (np.cumsum(new) - 1) << 32  # documents apart, so that one running maximum serves all
    far = np.maximum.accumulate(base + stop) - base
    new[1:] |= a[1:] > far[:-1]
    at = np.flatnonzero(new)
    out = np.zeros(len(at), SPAN)
    out["a"], out["n"] = a[at], far[np.append(at[1:], len(a)) - 1] - a[at]
    doc, th = doc[at], th[at].astype(np.int64)
    cut = np.flatnonzero(heads(doc, th))
    return doc[cut].tolist(), th[cut].tolist(), [out[i:j].tobytes() for i, j in zip(cut.tolist(), [*cut[1:].tolist(), len(out)])]


def _batch(names: list[str], *cols: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(cols), names=names)


# --- 1, 2: anchors --------------------------------------------------------------------------------------------------


def notes_by_document(docs: DataFrame, length: int, gram: int, crowd: int | None, hot: int | None) -> DataFrame:
    """docs: doc, th, text -> doc, th, notes (packed, by start) of the documents that share an anchor."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fine = parts * FINE

    def told(rec: np.ndarray, kind, key=0) -> np.ndarray:
        out = np.zeros(len(rec), NOTE)
        for c in ("doc", "th", "a", "n"):
            out[c] = rec[c]
        out["kind"], out["key"] = kind, key
        return out

    def scan(batches):
        powers: dict = {}
        names = ["bucket", "records", "notes"]
        for batch in batches:
            doc, th, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
            got, rows = [], []
            for lo, hi in slices(texts, 1 << 19):
                data, off = raw(texts.slice(lo, hi - lo))
                if len(data) < length:
                    continue
                a, n, h, c = pieces(data, off, length, gram, powers)
                row = np.searchsorted(off, a, "right") - 1
                rows.append(lo + row)
                rec = np.zeros(len(a), RECORD)
                rec["h"], rec["c"], rec["doc"], rec["th"], rec["a"], rec["n"] = h, c & np.uint64(0xFFFFFFFF), doc[lo:hi][row], th[lo:hi][row], a - off[row], n
                got.append(rec)
            if not got:
                continue
            rec = np.concatenate(got)
            got.clear()
            if crowd is not None:
                rec, known = thinned(rec, np.concatenate(rows), texts)
                if len(known):
                    to, blobs = cells(spread(known["doc"], fine), known)
                    yield _batch(names, pa.array(to, pa.int32()), pa.nulls(len(to), pa.binary()), pa.array(blobs, pa.binary()))
            to, blobs = cells((rec["h"] % np.uint64(fine)).astype(np.int64), rec)
            yield _batch(names, pa.array(to, pa.int32()), pa.array(blobs, pa.binary()), pa.nulls(len(to), pa.binary()))

    def thinned(rec: np.ndarray, row: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """A batch's records without its crowds, and the notes on those.  row: the text that each record is of."""
        group, size = sizes(heads(rec["h"][(order := np.argsort(rec["h"], kind="stable"))]))
        many = np.zeros(len(rec), bool)
        many[order] = size[group] > crowd
        if not many.any():
            return rec, np.zeros(0, NOTE)
        few, rec, row = rec[~many], rec[many], row[many]
        order = np.lexsort((rec["a"], rec["th"], rec["doc"], rec["c"], rec["h"]))
        rec, row = rec[order], row[order]
        new = heads(*[rec[c] for c in ("h", "c", "doc", "th", "a")])
        rec, row = rec[new], row[new]
        head = heads(rec["h"], rec["c"])
        group, size = sizes(head)
        later = ~head & (size[group] > crowd)
        data, off = raw(texts)
        begin, first = off[row] + rec["a"], np.flatnonzero(head)[group]
        of = memoryview(data)
        for i in np.flatnonzero(later).tolist():  # a short hash names candidates, their bytes decide
            j = int(first[i])
            later[i] = of[begin[i] : begin[i] + rec["n"][i]] == of[begin[j] : begin[j] + rec["n"][j]]
        known, rec = told(rec[later], REPEAT), rec[~later]
        head = heads(rec["h"])
        group, size = sizes(head)
        wide = size[group] > 4 * crowd
        known = np.concatenate([known, told(rec[wide], CROWDED)])
        rec["crowd"] = wide
        return np.concatenate([few, rec[~wide | head]]), known

    def owners(rec: np.ndarray) -> np.ndarray:
        """Notes on the records of anchors that stand more than once."""
        rec = rec[np.lexsort((rec["a"], rec["th"], rec["doc"], rec["h"]))]
        rec = rec[heads(*[rec[c] for c in ("h", "doc", "th", "a")])]
        head = heads(rec["h"])
        group, size = sizes(head)
        first = np.flatnonzero(head)
        by = np.lexsort((rec["c"], rec["h"]))
        kinds = np.bincount(group[by][heads(rec["h"][by], rec["c"][by])], minlength=len(first))
        crowded = (kinds > (len(rec) if hot is None else hot)) | (np.maximum.reduceat(rec["crowd"], first) > 0)
        segment = np.full(len(first), SEGMENTS[-1][1])
        for most, width in reversed(SEGMENTS):
            segment[kinds <= most] = width
        own = rec[first]
        with np.errstate(over="ignore"):
            key = u64_mix((u64_mix(own["doc"]) ^ own["th"].astype(np.uint64)) + segment.astype(np.uint64)) + (own["a"] // segment).astype(np.uint64)
        keep = (size[group] > 1) & (rec["crowd"] == 0)
        return told(rec[keep], np.where(crowded, CROWDED, SHARED)[group[keep]], key[group[keep]])

    def meet(batches):
        held: list[np.ndarray] = []

        def flush():
            x = np.concatenate(held)
            held.clear()
            to, blobs = cells(spread(x["doc"], fine), x)
            return _batch(["at", "notes"], pa.array(to, pa.int32()), pa.array(blobs, pa.binary()))

        def records():
            for batch in batches:
                known = batch.column(2).is_valid()
                if known.true_count:
                    held.extend(np.frombuffer(x, NOTE) for x in batch.column(2).filter(known).to_pylist())
                yield batch

        for _, blobs in by_key(records(), 0, 1):
            held.append(owners(np.frombuffer(b"".join(blobs), RECORD)))
            if sum(map(len, held)) > 1_000_000:
                yield flush()
        if sum(map(len, held)):
            yield flush()

    def gather(batches):
        for _, blobs in by_key(batches, 0, 1):
            x = np.frombuffer(b"".join(blobs), NOTE)
            x = x[np.lexsort((x["kind"], x["a"], x["th"], x["doc"]))]
            cut = np.flatnonzero(heads(x["doc"], x["th"]))
            packed = [x[i:j].tobytes() for i, j in zip(cut.tolist(), [*cut[1:].tolist(), len(x)])]
            yield _batch(["doc", "th", "notes"], pa.array(x["doc"][cut]), pa.array(x["th"][cut].astype(np.int64)), pa.array(packed, pa.binary()))

    records = docs.mapInArrow(lean(scan), "bucket int, records binary, notes binary").repartition(parts, "bucket").sortWithinPartitions("bucket")
    cells_ = records.mapInArrow(lean(meet), "at int, notes binary").repartition(parts, "at").sortWithinPartitions("at")
    return cells_.mapInArrow(lean(gather), "doc long, th long, notes binary")


# --- 3, 4: stretches and their suffixes ------------------------------------------------------------------------------

STRETCH = "kind int, key long, sid binary, doc long, th long, a int, data binary, own int, front int"
_STRETCH = [x.split()[0] for x in STRETCH.split(", ")]


def stretches(docs: DataFrame, notes: DataFrame, length: int, once: bool) -> DataFrame:
    """Rows of kind SHARED: a stretch's text under its owner's key; REPEAT: packed spans of a document; CROWDED: packed windows of a bucket.

    once: of equal stretches (and windows) that a task meets, only the first goes on, and the others are repeats.  Else a
    stretch's text goes on as far as shared anchors do; `own` bytes are the stretch itself, `front` is the byte before it.
    """
    fine = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * FINE

    def rows(kind, key, sid, doc, th, a, data, own=None, front=None):
        n = len(key)
        none = lambda t: pa.nulls(n, t)
        return _batch(_STRETCH, pa.array([kind] * n, pa.int32()), pa.array(key, pa.int64()), pa.array(sid, pa.binary()) if sid else none(pa.binary()), pa.array(doc, pa.int64()) if doc else none(pa.int64()), pa.array(th, pa.int64()) if th else none(pa.int64()), pa.array(a, pa.int32()) if a else none(pa.int32()), pa.array(data, pa.binary()), pa.array(own, pa.int32()) if own else none(pa.int32()), pa.array(front, pa.int32()) if front else none(pa.int32()))

    def cut(batches):
        met: dict[bytes, tuple] = {}
        powers: dict = {}
        for batch in batches:
            texts = [x.as_buffer().to_pybytes() for x in batch.column(2)]
            lists = [np.frombuffer(x, NOTE) for x in batch.column(3).to_pylist()]
            row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            x = np.concatenate(lists) if lists else np.zeros(0, NOTE)
            known, shared, crowded = (x["kind"] == k for k in (REPEAT, SHARED, CROWDED))
            gone = [(x["doc"][known], x["th"][known], x["a"][known], x["n"][known].astype(np.int64))]
            # stretches: neighbouring runs of one owner
            s, at = x[shared], row[shared]
            stop = s["a"] + s["n"]
            new = heads(at, s["key"])
            new[1:] |= s["a"][1:] != stop[:-1] - length + 1
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(s))[: len(begin)] - 1
            chain = heads(at)
            chain[1:] |= s["a"][1:] != stop[:-1] - length + 1
            last = np.append(np.flatnonzero(chain)[1:], len(s))[: chain.sum()] - 1
            reach = stop[last][np.cumsum(chain) - 1] if len(s) else stop
            cols = keys, sids, docs_, ths, starts, data, owned, fronts = [[] for _ in range(8)]
            again, size = [], 0
            for r, key, doc, th, a, b, far in zip(at[begin].tolist(), s["key"][begin].view(np.int64).tolist(), s["doc"][begin].tolist(), s["th"][begin].tolist(), s["a"][begin].tolist(), stop[end].tolist(), reach[begin].tolist()):
                text = texts[r][a : b if once else far]
                front = texts[r][a - 1] if a and not once else -1
                sid = hashlib.blake2b(text, digest_size=16, key=key.to_bytes(8, "little", signed=True) + b"%d,%d" % (front, b - a)).digest()
                if once:
                    first = met.get(sid)
                    if first is not None and first <= (doc, th, a):
                        if first != (doc, th, a):
                            again.append((doc, th, a, b - a))
                        continue
                    if len(met) >= 200_000:
                        met.clear()
                    met[sid] = (doc, th, a)
                for col, v in zip(cols, (key, sid, doc, th, a, text, b - a, front)):
                    col.append(v)
                size += len(text)
                if len(data) >= 5_000 or size >= 4 << 20:
                    yield rows(SHARED, *cols)
                    size = 0
                    for col in cols:
                        col.clear()
            if keys:
                yield rows(SHARED, *cols)
            if again:
                gone.append(tuple(np.array(c, np.int64) for c in zip(*again)))
            # windows of crowds
            for lo in range(0, int(crowded.sum()), 20_000):
                c, at = x[crowded][lo : lo + 20_000], row[crowded][lo : lo + 20_000]
                w = windows(c, [texts[r][a : a + n] for r, a, n in zip(at.tolist(), c["a"].tolist(), c["n"].tolist())], length, powers)
                if once:
                    w, later = firsts(w)
                    gone.append((later["doc"], later["th"], later["a"], np.full(len(later), length, np.int64)))
                to, blobs = cells((w["w"] % np.uint64(fine)).astype(np.int64), w)
                yield rows(CROWDED, to, None, None, None, None, blobs)
            d, t, spans = found(*[np.concatenate([g[i].astype(np.int64) for g in gone]) for i in range(4)])
            if d:
                yield rows(REPEAT, d, None, d, t, None, spans)

    return docs.join(notes.hint("merge"), ["doc", "th"]).select("doc", "th", "text", "notes").mapInArrow(lean(cut), STRETCH)


def windows(notes: np.ndarray, texts: list[bytes], length: int, powers: dict) -> np.ndarray:
    """Every window of the runs, named by 128 bits of hash."""
    data, size = np.frombuffer(b"".join(texts), np.uint8), notes["n"].astype(np.int64)
    n = size - length + 1
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = np.repeat(np.cumsum(size) - size, n) + place
    out = np.zeros(len(start), WINDOW)
    out["w"], out["v"] = (Rolling(data, b, powers).of(start, start + length) for b in (_B1, _B2))
    for c in ("doc", "th"):
        out[c] = np.repeat(notes[c], n)
    out["a"] = np.repeat(notes["a"], n) + place
    return out


def firsts(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the first of equal windows, the others), each window once."""
    w = w[np.lexsort((w["a"], w["th"], w["doc"], w["v"], w["w"]))]
    w = w[heads(*[w[c] for c in WINDOW.names])]
    head = heads(w["w"], w["v"])
    return w[head], w[~head]


def compared(rows: DataFrame, length: int, group_bytes: int, table_of_repeats: bool) -> DataFrame:
    """Stretches by owner and crowds by window -> doc, th, spans (packed) of all occurrences but the first; or, as a table of
    repeats, rid, length, and an occurrence's stretch and place in it."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def spans(doc, th, a, n):
        d, t, packed = found(np.asarray(doc, np.int64), np.asarray(th, np.int64), np.asarray(a, np.int64), np.asarray(n, np.int64) if np.ndim(n) else n)
        return _batch(["doc", "th", "spans"], pa.array(d, pa.int64()), pa.array(t, pa.int64()), pa.array(packed, pa.binary()))

    def occurrences(rid, n, sid, at):
        return _batch(["rid", "length", "sid", "at"], pa.array(rid, pa.binary()), pa.array(n, pa.int64()), pa.array(sid, pa.binary()), pa.array(at, pa.int64()))

    def sort(held: list[tuple]):
        """held: (doc, th, a, sid, text, own, front) of whole groups."""
        held.sort(key=lambda x: x[:3])  # so a smaller place is an earlier one
        arr = SparseSuffixes([x[4] for x in held], length, groups=table_of_repeats, own=[x[5] for x in held], fronts=[x[6] for x in held])
        if not table_of_repeats:
            run, at, n = arr.later()
            doc, th, a = (np.array([x[i] for x in held], np.int64)[run] for i in range(3))
            yield spans(doc, th, a + at, n)
            return
        out = []
        for n, places in arr.repeats:
            rid = hashlib.blake2b(arr.data[places[0] : places[0] + n], digest_size=16).digest()
            run, at = arr.place(np.array(places))
            out += [(rid, n, held[r][3], i) for r, i in zip(run.tolist(), at.tolist())]
        if out:
            yield occurrences(*zip(*out))

    def compare(batches):
        held, size, key, kind, last = [], 0, None, None, None
        blobs: list[bytes] = []

        def crowd():
            _, later = firsts(np.frombuffer(b"".join(blobs), WINDOW))
            blobs.clear()
            return spans(later["doc"], later["th"], later["a"], length)

        for batch in batches:
            again, known = [], []
            for k, ky, sid, doc, th, a, data, own, front in zip(*[batch.column(i).to_pylist() for i in range(9)]):
                if (k, ky) != (kind, key):
                    if size >= group_bytes:
                        yield from sort(held)
                        held, size = [], 0
                    if blobs:
                        yield crowd()
                    kind, key = k, ky
                if k == REPEAT:
                    known.append((doc, th, data))
                elif k == CROWDED:
                    blobs.append(data)
                elif last is not None and last[0] == sid:
                    if last[1:4] != (doc, th, a):  # a later occurrence of an equal stretch
                        again.append((doc, th, a, len(data), sid, data, last[4] or front >= 0))  # where a byte stands before all of them, the repeat begins earlier
                        last = (sid, doc, th, a, True)
                else:
                    last = (sid, doc, th, a, False)
                    held.append((doc, th, a, sid, data, own, front))
                    size += len(data)
            if known and not table_of_repeats:
                d, t, packed = zip(*known)
                yield _batch(["doc", "th", "spans"], pa.array(d, pa.int64()), pa.array(t, pa.int64()), pa.array(packed, pa.binary()))
            if again and not table_of_repeats:
                yield spans(*list(zip(*again))[:3], np.array([x[3] for x in again]))
            elif again:
                whole = [(hashlib.blake2b(x[5], digest_size=16).digest(), x[3], x[4], 0) for x in again if not x[6]]
                if whole:
                    yield occurrences(*zip(*whole))
        if held:
            yield from sort(held)
        if blobs:
            yield crowd()

    dealt = rows.repartition(parts, "key").sortWithinPartitions("kind", "key", "sid", "doc", "th", "a")
    return dealt.mapInArrow(lean(compare), "rid binary, length long, sid binary, at long" if table_of_repeats else "doc long, th long, spans binary")

# --- 5: over tables -------------------------------------------------------------------------------------------------


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(NULL_ID)).alias("doc"), F.xxhash64(text).alias("th"), text.alias("text"))


def find_repeats(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD, hot: int = HOT, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """texts: doc, th, text (no nulls) -> doc, th, spans (a list of packed ones) of every occurrence of a repeat but its first."""
    notes = stored(notes_by_document(texts, length, gram, crowd, hot), "substring-notes")
    return compared(stretches(texts, notes, length, True), length, group_bytes, False).groupBy("doc", "th").agg(F.collect_list("spans").alias("spans"))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """The maximal repeats of at least `length` bytes with all their occurrences: rid (hash of the string), length, doc_id, start.

    A repeat is whole however many documents hold it and however long it is.  The different texts around one segment of
    an owner (SEGMENTS) are sorted in one task, so a task's memory follows the different contexts of the most frequent string.
    """
    texts = keyed(docs, id_col, text_col)
    notes = stored(notes_by_document(texts, length, gram, None, None), "substring-notes")
    rows = stored(stretches(texts, notes, length, False), "substring-stretches")
    places = stored(compared(rows, length, group_bytes, True), "substring-repeats")
    who = rows.where(F.col("kind") == SHARED).select("sid", "doc", "th", "a").distinct()
    met = places.join(who, "sid").select("rid", "length", "doc", "th", (F.col("a") + F.col("at")).alias("start"))
    return met.distinct().select("rid", "length", F.when(F.col("doc") != NULL_ID, F.col("doc")).alias("doc_id"), "start")


def spans_to_cut(blobs: list[bytes]) -> list[tuple[int, int]]:
    """Maximal removed runs of a document, ascending."""
    x = np.frombuffer(b"".join(blobs), SPAN)
    if not len(x):
        return []
    _, _, packed = found(np.zeros(len(x), np.int64), np.zeros(len(x), np.int64), x["a"], x["n"].astype(np.int64))
    return [(a, a + n) for a, n in np.frombuffer(packed[0], SPAN).tolist()]


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row a document: doc_id, th (text hash), text, spans array<struct<start, stop>> of bytes to remove."""
    texts = keyed(docs, id_col, text_col)
    joined = texts.join(find_repeats(texts, **how).hint("merge"), ["doc", "th"], "left").select("doc", "th", "text", F.col("spans").alias("blobs"))
    shape = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def spans(batches):
        for batch in batches:
            got = [[{"start": a, "stop": b} for a, b in spans_to_cut(n)] if n else [] for n in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(got, shape)], names=["doc", "th", "text", "spans"])

    out = joined.mapInArrow(lean(spans), "doc long, th long, text string, spans array<struct<start:int,stop:int>>")
    return out.select(F.when(F.col("doc") != NULL_ID, F.col("doc")).alias("doc_id"), "th", "text", "spans")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = None, **how) -> DataFrame:
    """docs with repeats cut from their texts, and size_col set to the code points left.

    A character of which some bytes go is dropped whole.  Rows of one id and one text take the other columns of one of
    them.  Other columns are shuffled without texts and meet them where the repeats do.
    """
    texts = keyed(docs, id_col, text_col)
    others = [c for c in docs.columns if c != text_col]
    text = F.coalesce(docs[text_col], F.lit(""))
    rest = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(NULL_ID)).alias("doc"), F.xxhash64(text).alias("th"), F.struct(*[docs[c] for c in others], docs[text_col].isNull().alias("__no_text")).alias("rest"))
    rest = rest.groupBy("doc", "th").agg(F.first("rest").alias("rest"))
    joined = texts.join(find_repeats(texts, **how).hint("merge"), ["doc", "th"], "left").join(rest.hint("merge"), ["doc", "th"])

    def cut(batches):
        for batch in batches:
            out = []
            for text, blobs in zip(batch.column(0), batch.column(1).to_pylist()):
                spans = spans_to_cut(blobs) if blobs else []
                if not spans:
                    out.append(text.as_py())
                    continue
                data, at, left = text.as_buffer().to_pybytes(), 0, []
                for a, b in spans:
                    left.append(data[at:a])
                    at = b
                # a piece's broken ends are dropped before the pieces meet, so no new character arises
                out.append("".join(x.decode("utf-8", "ignore") for x in [*left, data[at:]]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), batch.column(2)], names=["text", "rest"])

    left = joined.select("text", "spans", "rest").mapInArrow(lean(cut), T.StructType([T.StructField("text", T.StringType()), T.StructField("rest", rest.schema["rest"].dataType)]))
    new = F.when(~F.col("rest.__no_text"), F.col("text"))
    columns = []
    for c in docs.columns:
        kind = docs.schema[c].dataType
        columns.append(new.alias(c) if c == text_col else F.length(new).cast(kind).alias(c) if c == size_col else F.col("rest").getField(c).alias(c))
    return left.select(*columns)


def digest(df: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 from the rows of removed()."""

    def run(batches):
        for batch in batches:
            n, gone, count, sha = [], [], [], []
            for text, spans in zip(batch.column(1), batch.column(2).to_pylist()):
                data = memoryview(text.as_buffer()) if text.as_buffer() is not None else b""
                h, at = hashlib.sha256(), 0
                for s in spans:
                    h.update(data[at : s["start"]])
                    at = s["stop"]
                h.update(data[at:])
                n.append(len(data))
                gone.append(sum(s["stop"] - s["start"] for s in spans))
                count.append(len(spans))
                sha.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(count, pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return df.select("doc_id", "text", "spans").mapInArrow(lean(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(removed(table(spark, sf_dir, "documents")))
