"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys
import types
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.paths import scratch

#: ASCII white space: the separators of `[^\x20\x09-\x0D]+`.  UTF-8 never holds these bytes inside a longer character.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
WORD_REGEX = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage is cut by files that outlive any executor."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_mod3(col) -> "F.Column":
    return F.crc32(col.cast("string").cast("binary")) % 3


def bounded_broadcast(df: DataFrame, small: DataFrame, on: str, how: str, rows: int, limit: int = 100_000) -> DataFrame:
    """Join with a side whose row count is known: broadcast up to `limit` rows, beyond that an adaptive shuffle join."""
    return df.join(F.broadcast(small) if rows <= limit else small.hint("merge"), on, how)


def cut_rows(keyed: DataFrame, parts: int) -> list[tuple[int, int]]:
    """At most parts - 1 ascending (key, tie) that cut the rows into ranges of about equal counts.

    A key that several quantiles fall on (one id, or no id, of many rows) is cut again, by quantiles of its ties.
    """
    if parts < 2:
        return []
    probs, accuracy = [i / parts for i in range(1, parts)], max(10_000, 20 * parts)
    many = Counter(keyed.agg(F.percentile_approx("key", probs, accuracy).alias("q")).first()["q"] or [])
    cuts = {(k, 1 - 2**63) for k in many}
    hot = [k for k, n in many.items() if n > 1]  # fewer than parts
    if hot:
        for r in keyed.where(F.col("key").isin(hot)).groupBy("key").agg(F.percentile_approx("tie", probs, accuracy).alias("q")).collect():
            n = many[r["key"]] + 1
            cuts |= {(r["key"], r["q"][i * parts // n - 1]) for i in range(1, n)}
    return sorted(cuts)


def slices(texts: pa.Array, most: int = 4 << 20):
    """(start, stop) runs of rows with at most `most` bytes of text each, or one row."""
    size = np.diff(offsets(texts))
    start, total = 0, 0
    for i, n in enumerate(size.tolist()):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(size):
        yield start, len(size)


def offsets(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    if len(texts) == 0:
        return np.zeros(1, np.int64)
    return np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all rows, row offsets from 0); the array must have no nulls."""
    off = offsets(texts)
    buf = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(buf, np.uint8)[off[0] : off[-1]] if buf is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the white-space separated words in the bytes, and the number of words before each row (len(off))."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    solid = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off[:-1]] = True  # a row starts here
    prev = np.empty(len(data), bool)
    prev[0], prev[1:] = False, solid[:-1]
    starts = np.flatnonzero(solid & (~prev | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, solid[1:]
    edge[:] = False
    edge[off[1:]] = True
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words as one Arrow binary array."""
    solid = ~SPACE[data]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[solid]))])


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal words get equal integers."""
    return word_array(data, starts, ends).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def filled(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A text column with nulls as empty texts."""
    col = batch.column(batch.schema.get_field_index(name))
    return col.fill_null("") if col.null_count else col


def u64_mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers with well spread bits (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.full(n, base, np.uint64)
        up[0] = 1
        down = np.full(n, pow(base, -1, 2**64), np.uint64)
        down[0] = 1
        return np.cumprod(up), np.cumprod(down)


class Rolling:
    """Polynomial hashes modulo 2^64 of any spans of a byte array."""

    def __init__(self, data: np.ndarray, base: int, powers: dict):
        n = len(data) + 1
        if len(powers.get(base, ((),))[0]) < n:
            powers[base] = _powers(base, max(n, 1 << 19))
        self.up, down = powers[base]
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * down[: n - 1])])

    def of(self, start, stop) -> np.ndarray:
        with np.errstate(over="ignore"):
            return u64_mix((self.sums[stop] - self.sums[start]) * self.up[start])


def by_key(batches, key: int, value: int):
    """(key, values) of runs of equal keys in rows that come sorted; rows without a value are left out."""
    now, held = None, []
    for batch in batches:
        for k, v in zip(batch.column(key).to_pylist(), batch.column(value).to_pylist()):
            if v is None:
                continue
            if k != now and held:
                yield now, held
                held = []
            now = k
            held.append(v)
    if held:
        yield now, held


def _home() -> types.ModuleType:
    return sys.modules.setdefault("_cellspark_worker", types.ModuleType("_cellspark_worker"))


def let_go() -> None:
    """What is kept goes; what of it was frozen is searched for circles again."""
    import gc

    _home().held = None
    gc.unfreeze()


def kept_in_worker(key: tuple, make):
    """make() once in a Python worker process, which Spark uses for many tasks; only the last such object is kept."""
    home = _home()
    held = getattr(home, "held", None)
    if held is None or held[0] != key:
        let_go()
        held = home.held = (key, make())
    return held[1]


def lean(run, keeps: bool = False):
    """The function for mapInArrow, in a worker that gives memory back: what an earlier operator kept goes before (unless
    `keeps`), and what this task freed goes back to the system after it, as workers stay while other operators run."""

    def give_back():
        import ctypes
        import gc

        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass

    def wrapped(batches):
        if not keeps:
            let_go()
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped
