"""BAM files by a Python data source: BGZF blocks are gzip members, records are fixed structs.

    spark.dataSource.register(BamSource)
    spark.read.format("bam").load(path)
    df.write.format("bam").option("references", "chr1:1000,chr2:500").mode("append").save(path)

A file is read in byte ranges, a task each (option `split`, bytes).  A range takes the blocks that begin in it and the records
that begin in those blocks.  Its first block is found by a chain of block heads, its first record by a chain of record heads
that fit the file's references; a last record goes on into the blocks behind the range.  Records become Arrow columns by
NumPy gathers over all records of a piece.  A file of plain gzip members has no such blocks and is one task.

Writing gives one file a task, each a whole BAM with the header.  With option `index` each task's rows must come in order of
place (alignments.sort_by_place); a binning index <file>.bai is written beside each file.  A read with option `region`
(chrom:start-end, from 0, end not included) then opens only the blocks of the region's bins and gives the rows that begin
there; so does one with option `pushdown` and filters on chrom and pos, where spark.sql.python.filterPushdown.enabled is set.
"""

from __future__ import annotations

import gzip
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

SCHEMA = "name string, flag int, chrom string, pos long, mapq int, cigar string, mate_chrom string, mate_pos long, length int, seq string, qual string, tags map<string,string>"
ARROW = pa.schema([
    ("name", pa.string()), ("flag", pa.int32()), ("chrom", pa.string()), ("pos", pa.int64()), ("mapq", pa.int32()), ("cigar", pa.string()), ("mate_chrom", pa.string()), ("mate_pos", pa.int64()), ("length", pa.int32()),
    ("seq", pa.string()), ("qual", pa.string()), ("tags", pa.map_(pa.string(), pa.string())),
])
#: Fixed values of the format: CIGAR operators, bases by code, sizes of tag types, and the end-of-file block.
OPS = "MIDNSHP=X"
BASES = "=ACMGRSVTWYHKDBN"
NUMBERS = {"c": "<i1", "C": "<u1", "s": "<i2", "S": "<u2", "i": "<i4", "I": "<u4", "f": "<f4"}
EOF_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
HEAD = np.dtype([("size", "<i4"), ("ref", "<i4"), ("pos", "<i4"), ("l_name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("n_cigar", "<u2"), ("flag", "<u2"), ("n_seq", "<i4"), ("mate", "<i4"), ("mate_pos", "<i4"), ("length", "<i4")])
BLOCK = 60_000
SPLIT = 64 << 20
#: Decompressed bytes that are decoded at once.
PIECE = 2 << 20
#: Bytes of rows that are packed at once.
SLICE = 2 << 20
#: Heads in a row that make a place the beginning of a block or a record.
CHAIN = 4
WINDOW = 1 << 14


# --- decoding -------------------------------------------------------------------------------------------------------


def _gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of many stretches, end to end."""
    size = size.astype(np.int64)
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    return data[np.repeat(start.astype(np.int64), size) + place]


def _strings(data: np.ndarray, size: np.ndarray) -> pa.Array:
    """Strings of the given sizes that lie end to end."""
    return pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _tags(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.Array:
    """Maps of tag to value: all records' first tags together, then their second ones, and so on."""
    zeros = np.flatnonzero(data == 0)
    at, live = start.astype(np.int64), np.arange(len(start))
    live = live[at[live] < stop[live]]
    owner, keys, values = [], [], []
    while len(live):
        p = at[live]
        kind = data[p + 2]
        size = np.zeros(len(live), np.int64)
        for k in np.unique(kind).tolist():
            c, mine = chr(k), np.flatnonzero(kind == k)
            q = p[mine] + 3
            if c in NUMBERS:
                form = np.dtype(NUMBERS[c])
                n = np.full(len(q), form.itemsize)
                x = _gather(data, q, n).view(form)
                text = pa.array([str(v) for v in x.astype(float).tolist()], pa.string()) if c == "f" else pc.cast(pa.array(x.astype(np.int64)), pa.string())
            elif c == "A":
                n = np.ones(len(q), np.int64)
                text = _strings(data[q], n)
            elif c in "ZH":
                n = zeros[np.searchsorted(zeros, q)] - q + 1
                text = _strings(_gather(data, q, n - 1), n - 1)
            elif c == "B":
                forms = [np.dtype(NUMBERS[chr(data[i])]) for i in q.tolist()]
                counts = _gather(data, q + 1, np.full(len(q), 4)).view("<i4").tolist()
                n = np.array([5 + f.itemsize * m for f, m in zip(forms, counts)], np.int64)
                text = pa.array([chr(data[i]) + "".join(f",{v}" for v in data[i + 5 : i + 5 + f.itemsize * m].view(f).tolist()) for i, f, m in zip(q.tolist(), forms, counts)], pa.string())
            else:
                raise ValueError(f"a tag has the unknown type {c}")
            size[mine] = 3 + n
            owner.append(live[mine])
            keys.append(_strings(_gather(data, p[mine], np.full(len(mine), 2)), np.full(len(mine), 2)))
            values.append(text)
        at[live] += size
        live = live[at[live] < stop[live]]
    n = len(start)
    if not owner:
        return pa.MapArray.from_arrays(pa.array(np.zeros(n + 1, np.int32)), pa.array([], pa.string()), pa.array([], pa.string()))
    who = np.concatenate(owner)
    order = pa.array(np.argsort(who, kind="stable"))
    offsets = np.concatenate([[0], np.cumsum(np.bincount(who, minlength=n))]).astype(np.int32)
    return pa.MapArray.from_arrays(pa.array(offsets), pa.concat_arrays(keys).take(order), pa.concat_arrays(values).take(order))


def decode(data: np.ndarray, at: np.ndarray, chroms: list[str]) -> pa.RecordBatch:
    """Records that begin at the given places of decompressed bytes."""
    n = len(at)
    head = _gather(data, at, np.full(n, HEAD.itemsize)).view(HEAD)
    names = pa.array(chroms, pa.string())
    ref = lambda x: names.take(pa.array(x.astype(np.int64), mask=x < 0)) if len(chroms) else pa.nulls(n, pa.string())
    p = at + HEAD.itemsize
    l_name, n_cigar, n_seq = (head[c].astype(np.int64) for c in ("l_name", "n_cigar", "n_seq"))
    name = _strings(_gather(data, p, l_name - 1), l_name - 1)
    p = p + l_name
    ops = _gather(data, p, 4 * n_cigar).view("<u4")
    letters = pa.array(list(OPS), pa.string()).take(pa.array(ops & 15))
    pieces = pc.binary_join_element_wise(pc.cast(pa.array(ops >> 4), pa.string()), letters, "")
    cigar = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_cigar)]).astype(np.int32)), pieces), "")
    cigar = pc.if_else(pa.array(n_cigar == 0), "*", cigar)
    p = p + 4 * n_cigar
    half = (n_seq + 1) // 2
    packed = _gather(data, p, half)
    base = np.frombuffer(BASES.encode(), np.uint8)
    both = np.stack([base[packed >> 4], base[packed & 15]], 1).ravel()
    odd = np.cumsum(2 * half)[n_seq % 2 == 1] - 1  # the half byte behind an odd number of bases
    seq = _strings(np.delete(both, odd), n_seq)
    p = p + half
    raw, none = _gather(data, p, n_seq), n_seq == 0
    first = np.zeros(n, np.uint8)
    first[~none] = data[p[~none]]
    none |= first == 255
    qual = _strings(raw[np.repeat(~none, n_seq)] + np.uint8(33), np.where(none, 0, n_seq))
    cols = [
        name, pa.array(head["flag"].astype(np.int32)), ref(head["ref"]), pa.array(head["pos"].astype(np.int64)), pa.array(head["mapq"].astype(np.int32)), cigar, ref(head["mate"]), pa.array(head["mate_pos"].astype(np.int64)),
        pa.array(head["length"].astype(np.int32)), pc.if_else(pa.array(n_seq == 0), "*", seq), pc.if_else(pa.array(none), "*", qual), _tags(data, p + n_seq, at + 4 + head["size"]),
    ]
    return pa.RecordBatch.from_arrays([c.cast(t) if c.type != t else c for c, t in zip(cols, ARROW.types)], schema=ARROW)


# --- places in a file -----------------------------------------------------------------------------------------------


def block_size(head: bytes, at: int = 0) -> int:
    """The size of the block whose head stands there, 0 if none does, -1 if too few bytes are there to tell."""
    if len(head) < at + 18:
        return -1 if b"\x1f\x8b\x08\x04".startswith(head[at : at + 4]) or head[at : at + 4] == b"\x1f\x8b\x08\x04" else 0
    if head[at : at + 4] != b"\x1f\x8b\x08\x04":
        return 0
    extra, stop = at + 12, at + 12 + struct.unpack_from("<H", head, at + 10)[0]
    while extra + 6 <= min(stop, len(head)):
        size = struct.unpack_from("<H", head, extra + 2)[0]
        if head[extra : extra + 2] == b"BC" and size == 2:
            return struct.unpack_from("<H", head, extra + 4)[0] + 1
        extra += 4 + size
    return 0


class Blocks:
    """Blocks of an open file, one after another; `opened` counts those that were decompressed."""

    def __init__(self, file, size: int):
        self.file, self.size, self.opened = file, size, 0
        self.held, self.at = b"", 0

    def bytes(self, at: int, n: int) -> bytes:
        if not self.at <= at or at + n > self.at + len(self.held):
            want = min(max(n, 1 << 20), max(0, self.size - at))
            self.file.seek(at)
            self.held, self.at = self.file.read(want), at
        return self.held[at - self.at : at - self.at + n]

    def find(self, at: int) -> int:
        """The first block that begins at or behind a place; the file's end if there is none."""
        while at < self.size:
            some = self.bytes(at, min(1 << 17, self.size - at))
            i = some.find(b"\x1f\x8b\x08\x04")
            if i < 0:
                at += max(1, len(some) - 3)
                continue
            place, good = at + i, True
            for _ in range(CHAIN):
                n = block_size(self.bytes(place, min(1024, self.size - place)))
                if n <= 0 or place + n > self.size:
                    good = False
                    break
                place += n
                if place == self.size:
                    break
            if good:
                return at + i
            at += i + 1
        return self.size

    def read(self, at: int) -> tuple[bytes, int]:
        """(decompressed bytes of the block at a place, the next block's place)."""
        n = block_size(self.bytes(at, min(1024, self.size - at)))
        if n <= 0:
            raise ValueError(f"no block at byte {at}")
        raw = self.bytes(at, n)
        extra = struct.unpack_from("<H", raw, 10)[0]
        self.opened += 1
        return zlib.decompress(raw[12 + extra : -8], -15), at + n


class PlainBlocks(Blocks):
    """A file of plain gzip members, which tell no sizes: one task takes it, in pieces that count as blocks."""

    def __init__(self, file):
        super().__init__(file, 1 << 62)
        self.stream = gzip.GzipFile(fileobj=file)

    def find(self, at: int) -> int:
        return self.size

    def read(self, at: int) -> tuple[bytes, int]:
        self.stream.seek(at << 20)
        data = self.stream.read(1 << 20)
        self.opened += 1
        return data, at + 1 if self.stream.peek(1) else self.size


def header(blocks: Blocks) -> tuple[list[str], int, int]:
    """(references, block and place in it of the first record)."""
    data, begin, at = b"", [], 0  # begin: (place in data, block)

    def need(n: int) -> None:
        nonlocal data, at
        while len(data) < n:
            if at >= blocks.size:
                raise ValueError("a BAM file ends in its header")
            begin.append((len(data), at))
            more, at = blocks.read(at)
            data += more

    need(12)
    if data[:4] != b"BAM\1":
        raise ValueError("not a BAM file")
    p = 8 + struct.unpack_from("<i", data, 4)[0]
    need(p + 4)
    chroms, n = [], struct.unpack_from("<i", data, p)[0]
    p += 4
    for _ in range(n):
        need(p + 4)
        size = struct.unpack_from("<i", data, p)[0]
        need(p + 8 + size)
        chroms.append(data[p + 4 : p + 3 + size].decode())
        p += 8 + size
    if p == len(data):
        return chroms, at, 0
    of, block = [b for b in begin if b[0] <= p][-1]
    return chroms, block, p - of


def _is_record(data: bytes, at: int, n_refs: int) -> int:
    """The size of the record that may begin there, 0 if none can, -1 if its bytes are not there."""
    if len(data) < at + HEAD.itemsize:
        return -1
    size, ref, pos, l_name, _, _, n_cigar, _, n_seq, mate, mate_pos, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
    if not (-1 <= ref < n_refs and -1 <= mate < n_refs and pos >= -1 and mate_pos >= -1 and l_name >= 1 and n_seq >= 0 and size >= 32 + l_name + 4 * n_cigar + (n_seq + 1) // 2 + n_seq):
        return 0
    name = data[at + 36 : at + 36 + l_name]
    if len(name) < l_name:
        return -1
    if name[-1] or not all(33 <= c <= 126 for c in name[:-1]):
        return 0
    ops = data[at + 36 + l_name : at + 36 + l_name + 4 * n_cigar : 4]
    return 0 if any(c & 15 > 8 for c in ops) else 4 + size


def first_record(blocks: Blocks, at: int, n_refs: int) -> tuple[int, int]:
    """(block, place in it) of the first record that begins in or behind the block at a place."""
    data, begin, nxt, p = b"", [], at, 0
    while True:
        q, good = p, bool(data)
        for _ in range(CHAIN) if good else ():
            n = _is_record(data, q, n_refs)
            if n < 0 or q + n > len(data):
                good = None if nxt < blocks.size else False  # more bytes will tell
                break
            if n == 0:
                good = False
                break
            q += n
            if q == len(data) and nxt >= blocks.size:
                break
        if good and p < len(data):
            of, block = [b for b in begin if b[0] <= p][-1]
            return block, p - of
        if good is False and p < len(data):
            p += 1
            continue
        if nxt >= blocks.size:
            return blocks.size, 0
        begin.append((len(data), nxt))
        more, nxt = blocks.read(nxt)
        data += more


def batches(blocks: Blocks, chroms: list[str], at: int, skip: int, stop: int, last: int = 0):
    """Record batches of the records that begin at (at, skip) or behind, and before (stop, last)."""
    if at > stop or (at == stop and skip >= last):
        return
    data, p, nxt = bytearray(), skip, at
    ends = last if nxt == stop else None  # where in data the range is over

    def more() -> None:
        nonlocal nxt, ends
        if nxt >= blocks.size:
            raise ValueError("a BAM file ends within a record")
        some, nxt = blocks.read(nxt)
        data.extend(some)
        if nxt == stop and ends is None:
            ends = len(data) + last

    while True:
        while len(data) - p < PIECE and (ends is None or len(data) < ends):
            more()
        places, piece = [], len(data) if ends is None else ends  # fixed here: a last record's bytes make data longer
        while p < piece:
            while p + 4 > len(data):
                more()
            n = 4 + struct.unpack_from("<i", data, p)[0]
            while p + n > len(data):
                more()
            places.append(p)
            p += n
        if places:
            yield decode(np.frombuffer(bytes(data), np.uint8), np.array(places, np.int64), chroms)
        if ends is not None and p >= ends:
            return
        data, ends, p = data[p:], None if ends is None else ends - p, 0


# --- the index ------------------------------------------------------------------------------------------------------


def bin_of(start: int, end: int) -> int:
    """The smallest bin of the usual index that holds the interval."""
    end -= 1
    for shift, first in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)):
        if start >> shift == end >> shift:
            return first + (start >> shift)
    return 0


def bins_of(start: int, end: int) -> set[int]:
    """All bins that may hold records over an interval."""
    return {0} | {first + i for shift, first in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)) for i in range(start >> shift, (max(end, start + 1) - 1 >> shift) + 1)}


class IndexMaker:
    """Chunks of virtual places by reference and bin, and the first place of each window, of records that come in order."""

    def __init__(self, n_refs: int):
        self.bins: list[dict[int, list[list[int]]]] = [{} for _ in range(n_refs)]
        self.windows: list[dict[int, int]] = [{} for _ in range(n_refs)]
        self.before = (0, -1)

    def add(self, ref: int, pos: int, end: int, start_at: int, end_at: int) -> None:
        self.extend(*(np.array([x], np.int64) for x in (ref, pos, end, start_at, end_at)))

    def extend(self, ref: np.ndarray, pos: np.ndarray, end: np.ndarray, start_at: np.ndarray, end_at: np.ndarray) -> None:
        """Many records: those of one bin that follow one another in a block are one chunk."""
        if not len(ref):
            return
        known = np.where(ref >= 0, ref, len(self.bins))
        if (int(known[0]), int(pos[0])) < self.before or ((known[1:] < known[:-1]) | (known[1:] == known[:-1]) & (pos[1:] < pos[:-1])).any():
            raise ValueError("an index needs rows in order of place")
        self.before = (int(known[-1]), int(pos[-1]))
        mapped = ref >= 0
        ref, pos, end, start_at, end_at = (x[mapped] for x in (ref, pos, end, start_at, end_at))
        if not len(ref):
            return
        bins = _bins(pos, end)
        order = np.lexsort((bins, ref))
        r, b, first, last = ref[order], bins[order], start_at[order], end_at[order]
        cut = np.flatnonzero((r[1:] != r[:-1]) | (b[1:] != b[:-1]) | (last[:-1] >> 16 != first[1:] >> 16)) + 1
        lo, hi = np.concatenate([[0], cut]), np.concatenate([cut - 1, [len(r) - 1]])
        for one, at, x, y in zip(r[lo].tolist(), b[lo].tolist(), first[lo].tolist(), last[hi].tolist()):
            chunks = self.bins[one].setdefault(at, [])
            if chunks and chunks[-1][1] >> 16 == x >> 16:
                chunks[-1][1] = y
            else:
                chunks.append([x, y])
        # the first record of each reference and span of windows
        w, v = pos // WINDOW, (end - 1) // WINDOW
        spans = np.lexsort((np.arange(len(ref)), v, w, ref))
        new = np.concatenate([[True], (np.diff(ref[spans]) != 0) | (np.diff(w[spans]) != 0) | (np.diff(v[spans]) != 0)])
        for i in np.sort(spans[new]).tolist():
            for x in range(int(w[i]), int(v[i]) + 1):
                self.windows[int(ref[i])].setdefault(x, int(start_at[i]))

    def bytes(self) -> bytes:
        out = [b"BAI\1", struct.pack("<i", len(self.bins))]
        for bins, windows in zip(self.bins, self.windows):
            out.append(struct.pack("<i", len(bins)))
            for b, chunks in sorted(bins.items()):
                out.append(struct.pack("<Ii", b, len(chunks)) + b"".join(struct.pack("<QQ", *c) for c in chunks))
            n, held = max(windows, default=-1) + 1, 0
            out.append(struct.pack("<i", n))
            for w in range(n):
                held = windows.get(w, held)
                out.append(struct.pack("<Q", held))
        return b"".join(out)


def chunks_of(index: bytes, ref: int, start: int, end: int) -> list[tuple[int, int]]:
    """Joined chunks (virtual places) that hold all records of a reference that begin in [start, end)."""
    if index[:4] != b"BAI\1":
        raise ValueError("not an index of a BAM file")
    p, wanted, found, low = 8, bins_of(start, min(end, 1 << 29)), [], 0
    for r in range(struct.unpack_from("<i", index, 4)[0]):
        n = struct.unpack_from("<i", index, p)[0]
        p += 4
        for _ in range(n):
            b, k = struct.unpack_from("<Ii", index, p)
            p += 8
            if r == ref and b in wanted:
                found += [struct.unpack_from("<QQ", index, p + 16 * i) for i in range(k)]
            p += 16 * k
        n = struct.unpack_from("<i", index, p)[0]
        if r == ref and n and start >> 14 < n:
            low = struct.unpack_from("<Q", index, p + 4 + 8 * (start >> 14))[0]
        p += 4 + 8 * n
    out: list[list[int]] = []
    for a, b in sorted(c for c in found if c[1] > low):
        if out and a >> 16 <= out[-1][1] >> 16:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(c) for c in out]


# --- the data source ------------------------------------------------------------------------------------------------


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(the bytes of strings end to end, their sizes); a null is empty."""
    column = column.cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    size = np.diff(ends).astype(np.int64)
    if column.null_count:
        none = column.is_null().to_numpy(zero_copy_only=False)
        return (_gather(data, ends[:-1], np.where(none, 0, size)), np.where(none, 0, size)) if size[none].any() else (data[ends[0] : ends[-1]], size)
    return data[ends[0] : ends[-1]], size


def _binary(data: np.ndarray, size: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _ops(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(CIGAR operators of all rows end to end, packed; their number a row)."""
    data, size = _flat(text)
    digit = (data >= 48) & (data <= 57)
    at, owner = np.flatnonzero(~digit), np.repeat(np.arange(len(size)), size)
    letters = np.full(256, 255, np.uint8)
    letters[np.frombuffer(OPS.encode(), np.uint8)] = np.arange(len(OPS))
    kind = letters[data[at]]
    if (kind == 255).any():
        raise ValueError("a CIGAR holds an unknown operator")
    digits = np.flatnonzero(digit)
    of = np.searchsorted(at, digits)  # the operator behind a digit, which may be another row's
    mine = of < len(at)
    mine[mine] = owner[at[of[mine]]] == owner[digits[mine]]
    digits, of = digits[mine], of[mine]
    power = at[of] - digits - 1
    if (power > 11).any():
        raise ValueError("a CIGAR holds a number beyond the format")
    n = np.bincount(of, (data[digits].astype(np.int64) - 48) * 10**power, minlength=len(at)).astype(np.int64)
    if (n >= 1 << 28).any():
        raise ValueError("a CIGAR holds a number beyond the format")
    return (n << 4 | kind).astype(np.uint32), np.bincount(owner[at], minlength=len(size))


def _bins(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """bin_of, for many intervals."""
    end, out = end - 1, np.zeros(len(start), np.int64)
    for shift, first in ((26, 1), (23, 9), (20, 73), (17, 585), (14, 4681)):
        out = np.where(start >> shift == end >> shift, first + (start >> shift), out)
    return out


def packed(batch: pa.RecordBatch, numbers: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rows of SCHEMA as records end to end, their sizes, references, starts and ends); columns that a table lacks take the
    format's empty values, all tags are strings."""
    rows = batch.num_rows

    def of(name: str, kind: pa.DataType) -> pa.Array:
        i = batch.schema.get_field_index(name)
        return batch.column(i).cast(kind) if i >= 0 else pa.nulls(rows, kind)

    def text(name: str) -> pa.Array:
        column = pc.fill_null(of(name, pa.string()), "")
        return pc.if_else(pc.equal(column, "*"), "", column)

    whole = lambda name, other: pc.fill_null(of(name, pa.int64()), other).to_numpy(zero_copy_only=False)
    ref = lambda name: pc.fill_null(pc.index_in(of(name, pa.string()), pa.array(list(numbers), pa.string()), skip_nulls=True), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    name = text("name")
    name = pc.if_else(pc.equal(name, ""), "*", name).cast(pa.binary())
    ops, n_ops = _ops(text("cigar"))
    seq, n_seq = _flat(pc.replace_substring_regex(text("seq"), r"[^\x00-\x7F]", "N"))
    codes = np.full(256, 15, np.uint8)
    codes[np.frombuffer(BASES.encode(), np.uint8)] = codes[np.frombuffer(BASES.lower().encode(), np.uint8)] = np.arange(16)
    half = np.insert(codes[seq], np.cumsum(n_seq)[n_seq % 2 == 1], 0)
    half = half[::2] << 4 | half[1::2]
    raw, n_raw = _flat(text("qual"))
    told = n_raw > 0
    if (n_raw[told] != n_seq[told]).any():
        raise ValueError("a row has more or fewer qualities than bases")
    if ((raw < 33) | (raw > 126)).any():
        raise ValueError("a quality is beyond the format")
    qual = np.full(len(seq), 255, np.uint8)
    qual[np.repeat(told, n_seq)] = raw - np.uint8(33)
    i = batch.schema.get_field_index("tags")
    tags, n_tags = np.zeros(0, np.uint8), np.zeros(rows, np.int64)
    if i >= 0:
        held = batch.column(i)
        held = held.cast(pa.list_(pa.struct([pa.field("key", pa.string(), False), pa.field("value", pa.string())])))
        each = held.flatten()
        key, value = pc.struct_field(each, "key"), pc.struct_field(each, "value")
        if value.null_count:
            raise ValueError("a tag has no value")
        tags, size = _flat(pc.binary_join_element_wise(key, pc.binary_join_element_wise("Z", value, ""), "\0", ""))
        n_tags = pc.fill_null(pc.list_value_length(held), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        n_tags = np.diff(np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(n_tags)])])
    pos = whole("pos", -1)
    kind = ops & 15
    long = np.isin(kind, [OPS.index(c) for c in "MDN=X"])
    length = np.bincount(np.repeat(np.arange(rows), n_ops), (ops >> 4) * long, minlength=rows).astype(np.int64)
    end = pos + np.maximum(length, 1)
    head, n_name = np.zeros(rows, HEAD), pc.binary_length(name).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    fields = {
        "size": 32 + n_name + 4 * n_ops + (n_seq + 1) // 2 + n_seq + n_tags, "ref": ref("chrom"), "pos": pos, "l_name": n_name, "mapq": whole("mapq", 0), "bin": np.where(pos >= 0, _bins(pos, end), 4680), "n_cigar": n_ops,
        "flag": whole("flag", 0), "n_seq": n_seq, "mate": ref("mate_chrom"), "mate_pos": whole("mate_pos", -1), "length": whole("length", 0),
    }
    for field, x in fields.items():
        bounds = np.iinfo(HEAD[field])
        if len(x) and not bounds.min <= x.min() <= x.max() <= bounds.max:
            raise ValueError(f"a row's {field} is beyond the format")
        head[field] = x
    same = np.full(rows, HEAD.itemsize)
    parts = [_binary(head.view(np.uint8), same), pc.binary_join_element_wise(name, b"", b"\0"), _binary(ops.view(np.uint8), 4 * n_ops), _binary(half, (n_seq + 1) // 2), _binary(qual, n_seq), _binary(tags, n_tags)]
    data, size = _flat(pc.binary_join_element_wise(*parts, b""))
    return data, size, fields["ref"], np.maximum(pos, 0), np.maximum(end, 1)


def block(data: bytes) -> bytes:
    """One BGZF block: a gzip member that tells its own size."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    return struct.pack("<4BI2BH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else "file:///" + path.removeprefix("file:").lstrip("/"))


@dataclass
class Range(InputPartition):
    path: str
    lo: int
    hi: int
    size: int
    region: tuple[str, int, int] | None = None
    index: str | None = None


class BamReader(DataSourceReader):
    def __init__(self, path: str, split: int = SPLIT, region: tuple[str, int, int] | None = None):
        self.path, self.split = path, split
        self.chrom, self.start, self.end = region or (None, 0, 1 << 31)
        self.opened = 0

    def partitions(self):
        from pyarrow import fs

        store, root = _open(self.path)
        info = store.get_file_info(root)
        found = [info] if info.is_file else store.get_file_info(fs.FileSelector(root))
        names = {f.path for f in found} if not info.is_file else {f for f in (f"{root}.bai",) if store.get_file_info(f).is_file}
        files = sorted((f for f in found if f.is_file and (f.path.endswith(".bam") or info.is_file)), key=lambda f: f.path)
        region = (self.chrom, self.start, self.end) if self.chrom is not None else None
        some = [Range(f.path, 0, f.size, f.size, region, f"{f.path}.bai") for f in files if region and f"{f.path}.bai" in names]
        rest = [f for f in files if not (region and f"{f.path}.bai" in names)]
        return some + [Range(f.path, lo, min(lo + self.split, f.size), f.size, region) for f in rest for lo in range(0, max(f.size, 1), self.split)]

    def read(self, part):
        store, _ = _open(self.path)
        with store.open_input_file(part.path) as f:
            blocks = Blocks(f, part.size)
            if not block_size(blocks.bytes(0, min(1024, part.size))):
                if part.lo:
                    return
                f.seek(0)
                blocks = PlainBlocks(f)
            try:
                chroms, at, skip = header(blocks)
                chunks = []
                if part.index is not None:
                    chrom, start, end = part.region
                    if chrom in chroms and start < end:
                        with store.open_input_stream(part.index, compression=None) as i:
                            chunks = [(a >> 16, a & 0xFFFF, b >> 16, b & 0xFFFF) for a, b in chunks_of(i.read(), chroms.index(chrom), start, end)]
                elif part.hi > at:
                    if part.lo > at:
                        at, skip = first_record(blocks, blocks.find(part.lo), len(chroms))
                    chunks = [(at, skip, blocks.find(part.hi), 0)]
                for chunk in chunks:
                    for batch in batches(blocks, chroms, *chunk):
                        yield batch if part.region is None else self._within(batch, *part.region)
            finally:
                self.opened += blocks.opened

    @staticmethod
    def _within(batch: pa.RecordBatch, chrom: str, start: int, end: int) -> pa.RecordBatch:
        pos = batch.column(3)
        return batch.filter(pc.fill_null(pc.and_(pc.equal(batch.column(2), chrom), pc.and_(pc.greater_equal(pos, start), pc.less(pos, end))), False))


class FilteredReader(BamReader):
    """Filters on chrom and pos choose the region; Spark tests them on every row as well."""

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("chrom",) and f.value is not None and self.chrom in (None, f.value):
                self.chrom = f.value
            elif isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and f.attribute == ("pos",) and f.value is not None:
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.start = max(self.start, f.value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    self.end = min(self.end, f.value + (not isinstance(f, LessThan)))
            yield f  # Spark tests rows itself


@dataclass
class Written(WriterCommitMessage):
    moves: list[tuple[str, str]]


class BamWriter(DataSourceArrowWriter):
    """One file a task, under a name of its own until the job commits."""

    def __init__(self, path: str, references: list[tuple[str, int]], index: bool = False):
        self.path, self.references, self.index = path, references, index

    def write(self, iterator):
        from pyspark import TaskContext

        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        task = TaskContext.get()
        held, name = f"{root}/.{task.partitionId():05d}-{task.taskAttemptId()}", f"{root}/part-{task.partitionId():05d}.bam"
        numbers = {c: i for i, (c, _) in enumerate(self.references)}
        text = (f"@HD\tVN:1.6\tSO:{'coordinate' if self.index else 'unknown'}\n" + "".join(f"@SQ\tSN:{c}\tLN:{n}\n" for c, n in self.references)).encode()
        head = b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(self.references)) + b"".join(struct.pack("<i", len(c) + 1) + c.encode() + b"\0" + struct.pack("<i", n) for c, n in self.references)
        maker = IndexMaker(len(self.references)) if self.index else None
        with store.open_output_stream(held) as out:
            at = 0  # bytes written
            for i in range(0, len(head), BLOCK):
                at += out.write(block(head[i : i + BLOCK]))
            buffer, size = bytearray(), 0
            starts: list[int] = []  # of the blocks that waiting records lie in, a number a block
            gone = 0  # blocks before those
            waiting: list[list[np.ndarray]] = []  # references, starts, ends, and the records' places and ends in the blocks' bytes

            def flush(everything: bool) -> None:
                nonlocal at, gone
                done = len(buffer) if everything else len(buffer) // BLOCK * BLOCK
                view = memoryview(buffer)
                for i in range(0, done, BLOCK):
                    starts.append(at)
                    at += out.write(block(view[i : min(i + BLOCK, done)]))
                view.release()
                del buffer[:done]
                if everything:
                    starts.append(at)
                if not waiting:
                    del starts[:]
                    return
                rows = [np.concatenate(x) for x in zip(*waiting)]
                known = int(np.searchsorted(rows[4] // BLOCK, gone + len(starts)))
                places = np.array(starts, np.int64) << 16
                virtual = [np.where(everything & (q == size), places[-1], places[np.minimum(q // BLOCK - gone, len(places) - 1)] | q % BLOCK) for q in (x[:known] for x in rows[3:])]
                maker.extend(*(x[:known] for x in rows[:3]), *virtual)
                waiting[:] = [[x[known:] for x in rows]] if known < len(rows[0]) else []
                keep = (int(rows[3][known]) if known < len(rows[0]) else size) // BLOCK
                del starts[: keep - gone]
                gone = max(gone, keep)

            for batch in iterator:
                step = max(1, batch.num_rows * SLICE // max(batch.nbytes, 1))
                for lo in range(0, batch.num_rows, step):
                    data, sizes, *places = packed(batch.slice(lo, step), numbers)
                    buffer += memoryview(data)
                    if maker is not None:
                        ends = size + np.cumsum(sizes)
                        waiting.append([*places, ends - sizes, ends])
                    size += len(data)
                    if len(buffer) >= 16 * BLOCK:
                        flush(False)
            flush(True)
            out.write(EOF_BLOCK)
        moves = [(held, name)]
        if maker is not None:
            with store.open_output_stream(f"{held}.bai") as out:
                out.write(maker.bytes())
            moves.append((f"{held}.bai", f"{name}.bai"))
        return Written(moves)

    def commit(self, messages):
        store, _ = _open(self.path)
        for m in messages:
            for held, name in m.moves if m is not None else ():
                store.move(held, name)

    def abort(self, messages):
        store, _ = _open(self.path)
        for m in messages:
            for held, _ in m.moves if m is not None else ():
                store.delete_file(held)


class BamSource(DataSource):
    @classmethod
    def name(cls):
        return "bam"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        region = self.options.get("region")
        if region:
            chrom, _, span = region.rpartition(":")
            start, _, end = span.partition("-")
            region = chrom, int(start), int(end)
        kind = FilteredReader if self.options.get("pushdown", "false").lower() == "true" else BamReader
        return kind(self.options["path"], int(self.options.get("split", SPLIT)), region)

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("BAM files are added to a folder, not replaced")
        pairs = [x.rpartition(":") for x in self.options.get("references", "").split(",") if x]
        return BamWriter(self.options["path"], [(c, int(n)) for c, _, n in pairs], self.options.get("index", "false").lower() == "true")
