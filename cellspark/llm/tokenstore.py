"""Token-ID output with a minimal perfect hash index, and keyed reading.

A shard holds the ids of a range of documents in ascending order of their keys, as one raw little-endian payload (two
bytes an id where the vocabulary allows, else four), cut in blocks.  Its index is a minimal perfect hash: keys that
collide on one level of a bit array go to the next, and the rank of a key's bit is its slot.  A slot keeps a 32-bit
fingerprint of its key, so that foreign keys are refused, and the key's first row.  Row offsets follow.  A lookup reads
one bit array after another (1.6 levels on average), one slot, one offset: constant time.

Files are Parquet, one row a shard, written and read by Spark on any store it can reach: a row is never split, so a
shard is read in one task without a shuffle.  The number of shards follows the input's bytes (SHARD_BYTES).

Cases: a null text is empty and yields only the end id; null keys come last, under a key of their own; rows with equal
keys stand together in a defined order (by text hash) and share one slot of a shard; a key of very many rows may go on over
several shards, which a lookup all asks; a very long text is one run of a payload; an
empty table makes no shard; other columns are not touched.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_rows, filled, kept_in_worker, lean, raw, scratch, slices, table, u64_mix, word_array, word_spans

NULL_KEY = 2**63 - 1
BLOCK = 8 << 20
#: Bytes of input that a shard is meant for, where the plan tells them.
SHARD_BYTES = 64 << 20
LAYOUT = "shard int, low long, high long, n_ids long, bits array<binary>, prints binary, first binary, offsets binary, keys binary, payload array<binary>"
ARROW = pa.schema([("shard", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("n_ids", pa.int64()), ("bits", pa.list_(pa.binary())), ("prints", pa.binary()), ("first", pa.binary()), ("offsets", pa.binary()), ("keys", pa.binary()), ("payload", pa.list_(pa.binary()))])
GAMMA = 2.0
MAX_CHUNKS = 400_000


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
POINT, PLAIN = np.zeros(256, bool), np.zeros(256, bool)
POINT[[ord("."), ord(",")]] = True
PLAIN[48:58] = PLAIN[65:91] = PLAIN[97:123] = True

# --- encoding -------------------------------------------------------------------------------------------------------


class ChunkEncoder:
    """Encodes texts with the tokenizers library, white-space separated chunk by chunk, remembering frequent chunks.

    Exact for tokenizers whose normaliser and pre-tokeniser neither join nor look across ASCII white space and drop it,
    which is checked on the file's declaration; for others, and for texts with a special token's string, whole texts are
    encoded.  Chunks are told apart in Arrow and ids are gathered in NumPy, so Python sees each chunk once a batch.
    """

    def __init__(self, path: str, dtype: str, most: int = MAX_CHUNKS, plain: bool = False):
        """plain: the strings of special tokens in a text are ordinary text."""
        import json

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.dtype, self.most = Tokenizer.from_file(path), np.dtype(dtype), most
        self.tokenizer.encode_special_tokens = plain
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        normal = (said.get("normalizer") or {}).get("normalizers", [])
        split = ((said.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        self.by_chunk = {x["type"] for x in normal} == {"NFC", "Replace", "Lowercase"} and split.get("type") == "Split" and split.get("invert") and split.get("behavior") == "Removed" and r"[^\s\p{L}\p{N}]+" in split["pattern"].get("Regex", "")
        self.special = [x["content"].encode() for x in said.get("added_tokens", []) if not plain]
        mark = self._ids(["\x01"])[0] if self.by_chunk else []
        self.mark = int(mark[0]) if len(mark) == 1 else None  # only a chunk with this character yields its id
        self.known: dict[bytes, bytes] = {}
        self.missed = 0

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _chunks(self, chunks: list[bytes]) -> list[bytes]:
        """The packed ids of new chunks; many go through the library as one text, told apart by a mark."""
        if self.mark is None or any(b"\x01" in c for c in chunks):
            return [x.tobytes() for x in self._ids([c.decode() for c in chunks])]
        out = []
        for lo in range(0, len(chunks), 500):
            part = chunks[lo : lo + 500]
            ids = self._ids([b" \x01 ".join(part).decode()])[0]
            got = np.split(ids, np.flatnonzero(ids == self.mark))
            out += [got[0].tobytes(), *[x[1:].tobytes() for x in got[1:]]]
        return out

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The packed ids of each text (no nulls)."""
        data, off = raw(texts)
        whole = data.tobytes()
        if not self.by_chunk:
            return [x.tobytes() for x in self._ids(texts.to_pylist())]
        data = LOWER[data]  # the normaliser lowers anyway
        starts, ends, first = word_spans(data, off)
        if not len(starts):
            return [b""] * len(texts)
        # a point or comma that ends a chunk after an ASCII letter or digit is a piece of its own
        tail = (ends - starts > 1) & POINT[data[ends - 1]]
        tail[tail] = PLAIN[data[ends[tail] - 2]]
        at = np.repeat(np.arange(len(starts)), 1 + tail)
        second = np.concatenate([[False], at[1:] == at[:-1]])
        first = first + np.concatenate([[0], np.cumsum(tail)])[first]
        starts, ends = np.where(second, ends[at] - 1, starts[at]), np.where(tail[at] & ~second, ends[at] - 1, ends[at])
        coded = word_array(data, starts, ends).dictionary_encode()
        chunks = coded.dictionary.to_pylist()
        packed = list(map(self.known.get, chunks))
        new = [i for i, x in enumerate(packed) if x is None]
        for i, x in zip(new, self._chunks([chunks[i] for i in new])):
            packed[i] = x
        self.missed += len(new)
        if len(self.known) < self.most:
            self.known.update((chunks[i], packed[i]) for i in new[: self.most - len(self.known)] if len(chunks[i]) <= 64)
        elif self.missed > 4 * self.most:  # the language has changed
            self.known, self.missed = {}, 0
        width = self.dtype.itemsize
        size = np.array([len(x) for x in packed]) // width
        flat, begin = np.frombuffer(b"".join(packed), self.dtype), np.cumsum(size) - size
        index = coded.indices.to_numpy(zero_copy_only=False)
        n = size[index]
        stop = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat(begin[index] - stop[:-1], n) + np.arange(stop[-1])]
        cut = stop[first].tolist()
        out = [ids[i:j].tobytes() for i, j in zip(cut, cut[1:])]
        if any(s in whole for s in self.special):
            for i, text in enumerate(texts.to_pylist()):
                if any(s in text.encode() for s in self.special):
                    out[i] = self._ids([text])[0].tobytes()
        return out


# --- the index ------------------------------------------------------------------------------------------------------


def _hash(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return u64_mix(keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(seed + 1))


def build_index(keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """(bit arrays as bool, slot of each key) of distinct int64 keys; the slots are 0..n-1."""
    levels, slots = [], np.zeros(len(keys), np.int64)
    left, base = np.arange(len(keys)), 0
    while len(left):
        size = max(8, int(GAMMA * len(left)) + 1)
        at = (_hash(keys[left], len(levels)) % np.uint64(size)).astype(np.int64)
        bits = np.bincount(at, minlength=size) == 1
        won = bits[at]
        rank = np.cumsum(bits) - 1
        slots[left[won]] = base + rank[at[won]]
        base += int(bits.sum())
        levels.append(bits)
        left = left[~won]
        if len(levels) > 200:
            raise ValueError("keys are not distinct")
    return levels, slots


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_hash(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


class Shard:
    """One shard in memory: keyed access to its rows."""

    def __init__(self, levels: list[np.ndarray], prints: np.ndarray, first: np.ndarray, offsets: np.ndarray, payload: np.ndarray):
        self.levels, self.prints, self.first, self.offsets, self.payload = levels, prints, first, offsets, payload
        self.ranks, base = [], 0
        for bits in levels:
            r = np.cumsum(bits)
            self.ranks.append(base + r - 1)
            base += int(r[-1]) if len(r) else 0
        self.last = np.empty(len(first), np.int64)  # one past the last row of a slot
        order = np.argsort(first)
        self.last[order] = np.concatenate([first[order][1:], [len(offsets) - 1]]) if len(first) else []

    @staticmethod
    def build(keys: np.ndarray, rows: list[bytes], dtype: str) -> "Shard":
        """keys ascend; equal keys stand together."""
        new = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
        distinct, first = keys[new], np.flatnonzero(new)
        levels, slots = build_index(distinct)
        by_slot, prints = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.uint32)
        by_slot[slots], prints[slots] = first, fingerprint(distinct)
        width = np.dtype(dtype).itemsize
        offsets = np.concatenate([[0], np.cumsum([len(r) // width for r in rows])]).astype(np.int64)
        return Shard(levels, prints, by_slot, offsets, np.frombuffer(b"".join(rows), dtype))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where the shard lacks it."""
        slot = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for i, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            at = (_hash(keys[left], i) % np.uint64(len(bits))).astype(np.int64)
            won = bits[at]
            slot[left[won]] = ranks[at[won]]
            left = left[~won]
            if not len(left):
                break
        good = slot >= 0
        good[good] = self.prints[slot[good]] == fingerprint(keys[good])
        return np.where(good, slot, -1)

    def dump(self) -> dict:
        """The columns of LAYOUT besides shard and low; the payload in blocks."""
        width = self.payload.itemsize
        step = BLOCK // width
        return {
            "n_ids": len(self.payload), "bits": [len(b).to_bytes(8, "little") + np.packbits(b).tobytes() for b in self.levels], "prints": self.prints.astype("<u4").tobytes(),
            "first": self.first.astype("<i8").tobytes(), "offsets": self.offsets.astype("<i8").tobytes(), "payload": [self.payload[at : at + step].tobytes() for at in range(0, len(self.payload), step)],
        }

    @staticmethod
    def load(row: dict, dtype: str) -> "Shard":
        levels = [np.unpackbits(np.frombuffer(b, np.uint8, offset=8), count=int.from_bytes(b[:8], "little")).astype(bool) for b in row["bits"]]
        return Shard(levels, np.frombuffer(row["prints"], "<u4"), np.frombuffer(row["first"], "<i8"), np.frombuffer(row["offsets"], "<i8"), np.frombuffer(b"".join(row["payload"]), dtype))


# --- files ----------------------------------------------------------------------------------------------------------


def shards_for(docs: DataFrame) -> int:
    """One for each SHARD_BYTES that Spark expects the input to hold; 0 where it cannot tell."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return -(-size // SHARD_BYTES) if size < 1 << 60 else 0


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, dtype: str = "<u2", id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> None:
    """Encode every text, append end_id, and write shards of ascending ids to path.

    Ids are encoded where the texts are read; only packed ids are shuffled.  Shards are id ranges from quantiles.
    """
    spark = docs.sparkSession
    text = F.coalesce(docs[text_col], F.lit(""))
    keyed = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(NULL_KEY)).alias("key"), F.crc32(text.cast("binary")).alias("tie"), text.alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = shards or max(4 * parts, shards_for(docs))
    cuts = np.array(cut_rows(keyed, shards), np.int64).reshape(-1, 2)
    split = [k for k, n in Counter(cuts[:, 0].tolist()).items() if n > 1]
    end = np.array([end_id], dtype).tobytes()

    def shard_of(key: np.ndarray, tie: np.ndarray) -> np.ndarray:
        """The range that (key, tie) falls in; only keys of several ranges look at the tie."""
        at = np.searchsorted(cuts[:, 0], key, "right")
        for k in split:
            mine = np.flatnonzero(key == k)
            lo, hi = np.searchsorted(cuts[:, 0], k, "left"), np.searchsorted(cuts[:, 0], k, "right")
            at[mine] = lo + np.searchsorted(cuts[lo:hi, 1], tie[mine], "right")
        return at

    def encode(batches):
        enc = kept_in_worker(("chunks", tokenizer, dtype), lambda: ChunkEncoder(tokenizer, dtype))
        for batch in batches:
            keys, ties, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), filled(batch, "text")
            for lo, hi in slices(texts):
                part, k, tie = texts.slice(lo, hi - lo), keys[lo:hi], ties[lo:hi]
                got = [g + end for g in enc.encode(part)]
                yield pa.RecordBatch.from_arrays([pa.array(shard_of(k, tie), pa.int32()), pa.array(k), pa.array(tie), pa.array(got, pa.binary())], names=["shard", "key", "tie", "ids"])

    def build(batches):
        now, keys, rows = None, [], []

        def flush():
            k = np.concatenate(keys)
            row = {"shard": now, "low": int(k[0]), "high": int(k[-1]), "keys": k[np.concatenate([[True], k[1:] != k[:-1]])].astype("<i8").tobytes()} | Shard.build(k, rows, dtype).dump()
            return pa.RecordBatch.from_pylist([row], schema=ARROW)

        for batch in batches:
            shard = batch.column(0).to_numpy()
            for s in np.unique(shard):
                at = np.flatnonzero(shard == s)
                if now is not None and s != now:
                    yield flush()
                    keys, rows = [], []
                now = int(s)
                keys.append(batch.column(1).to_numpy()[at])
                rows += batch.column(3).take(pa.array(at)).to_pylist()
        if now is not None:
            yield flush()

    packed = keyed.mapInArrow(lean(encode, keeps=True), "shard int, key long, tie long, ids binary")
    dealt = packed.repartitionById(min(parts, shards), F.col("shard") % min(parts, shards)).sortWithinPartitions("shard", "key", "tie", "ids")
    dealt.mapInArrow(lean(build), LAYOUT).write.parquet(path)


def _answers(shard: Shard, before: int, keys: np.ndarray):
    """One row for each row of the keys that the shard holds."""
    out = []
    for key, slot in zip(keys.tolist(), shard.find(keys).tolist()):
        if slot < 0:
            continue
        for row in range(int(shard.first[slot]), int(shard.last[slot])):
            a, b = int(shard.offsets[row]), int(shard.offsets[row + 1])
            out.append((None if key == NULL_KEY else key, before + a, b - a, zlib.crc32(shard.payload[a:b].astype("<u4").tobytes())))
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(4)], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def starts(files: DataFrame) -> dict[int, int]:
    """Ids in all earlier shards, by shard: a running sum over one number a shard."""
    before, total = {}, 0
    for r in files.select("shard", "n_ids").orderBy("shard").collect():
        before[r["shard"]] = total
        total += r["n_ids"]
    return before


ANSWER = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_all(spark: SparkSession, path: str, dtype: str = "<u2") -> DataFrame:
    """doc_id, start (ids before it in the whole store), n_tokens, ids_crc32 of every row, each key looked up in its shard's index."""
    files = spark.read.schema(LAYOUT).parquet(path)
    before = starts(files)

    def answer(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield _answers(Shard.load(row, dtype), before[row["shard"]], np.frombuffer(row["keys"], "<i8"))

    return files.mapInArrow(lean(answer), ANSWER)


def read_keys(spark: SparkSession, path: str, keys: DataFrame, id_col: str = "doc_id", dtype: str = "<u2") -> DataFrame:
    """The same for the distinct keys asked for; keys that the store lacks give no row."""
    files = spark.read.schema(LAYOUT).parquet(path)
    before = starts(files)
    known = sorted((r["shard"], r["low"], r["high"]) for r in files.select("shard", "low", "high").collect())  # two numbers a shard
    if not known:
        return spark.createDataFrame([], ANSWER)
    names, lows, highs = (np.array(x, np.int64) for x in zip(*known))

    def route(batches):
        for batch in batches:
            k = batch.column(0).to_numpy()
            first, n = np.searchsorted(highs, k, "left"), np.searchsorted(lows, k, "right")
            n = np.maximum(n - first, 0)  # shards whose range holds the key
            at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield pa.RecordBatch.from_arrays([pa.array(names[at], pa.int32()), pa.array(np.repeat(k, n))], names=["shard", "key"])

    def answer(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield _answers(Shard.load(row, dtype), before[row["shard"]], np.array(row["asked"], np.int64))

    asked = keys.select(F.coalesce(keys[id_col].cast("long"), F.lit(NULL_KEY)).alias("key")).distinct().mapInArrow(lean(route), "shard int, key long")
    return files.drop("keys").join(asked.groupBy("shard").agg(F.collect_list("key").alias("asked")), "shard").mapInArrow(lean(answer), ANSWER)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = scratch(spark, "token-store")
    write(docs, path, tokenizer_path(), end_id=2)
    return read_all(spark, path)
