"""Periodic runs of words within a text, found by harmonic grid probing.

A run is a stretch of consecutive words with smallest period q, at least max(LEAST, TIMES * q) words long, that no
neighbouring word extends with that period.  For each period p the words at jp and (j+1)p are compared, n / p probes, so a
text of n words takes n log n of them.  A run of TIMES periods holds TIMES - 1 neighbouring probes that agree; where so many
do, the agreement is extended to both sides by comparing chunks of the word array, and the grid points inside it are passed
over.  So are points inside a run already found whose period divides p, as whatever repeats there repeats with that shorter
period.  Periods go up by doublings, so a period's divisors are always done before it.

Cases: a null or empty text has no words and no run; texts are taken whole, however long; rows are measured one by one, so
repeated rows give equal rows; an empty table gives an empty table; other columns are not touched.  In the query a text
without an id is not rewritten.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import filled, lean, raw, slices, table, word_codes, word_spans

LEAST = 6
TIMES = 4
#: Probes that are made at once.
PROBES = 1 << 21

RUNS = "runs array<struct<start:long,length:long,period:long>>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _agree(codes: np.ndarray, at: int, p: int) -> int:
    """The first i >= at with codes[i] != codes[i + p], or the end."""
    stop, step = len(codes) - p, 64
    while at < stop:
        end = min(at + step, stop)
        differ = codes[at:end] != codes[at + p : end + p]
        k = int(differ.argmax())
        if differ[k]:
            return at + k
        at, step = end, min(2 * step, 1 << 16)
    return stop


def _agree_back(codes: np.ndarray, at: int, p: int) -> int:
    """The smallest i with codes[i:at] == codes[i + p:at + p]."""
    step = 64
    while at > 0:
        begin = max(0, at - step)
        differ = codes[begin:at] != codes[begin + p : at + p]
        k = int(differ[::-1].argmax())
        if differ[len(differ) - 1 - k]:
            return at - k
        at, step = begin, min(2 * step, 1 << 16)
    return 0


def _primes(p: int) -> list[int]:
    out, d = [], 2
    while d * d <= p:
        if p % d == 0:
            out.append(d)
            while p % d == 0:
                p //= d
        d += 1
    return out + [p] if p > 1 else out


def find_runs(codes: np.ndarray, least: int = LEAST, times: int = TIMES, probes: int = PROBES) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of an integer sequence, by start, then period; times is at least 2."""
    n = len(codes)
    found: list[tuple[int, int, int]] = []
    if n < least:
        return found
    inside = np.zeros(n, np.int64)  # where the run ends that reaches furthest from here
    period = np.ones(n, np.int64)  # and its period
    lo, top = 1, n // times
    while lo <= top:
        hi = min(2 * lo, lo + max(1, probes * lo // n), top + 1)
        p = np.arange(lo, hi)
        points = (n - 1) // p
        per = np.repeat(p, points)
        at = (np.arange(len(per)) - np.repeat(np.cumsum(points) - points, points)) * per
        hit = codes[at] == codes[at + per]
        near = hit[: len(hit) - times + 2].copy()
        for k in range(1, times - 1):
            near &= hit[k : len(hit) - times + 2 + k]
        s = np.flatnonzero(near)
        s = s[per[s] == per[s + times - 2]]
        a, per = at[s], per[s]
        new = (inside[a] <= a + per) | (per % period[a] != 0)
        now, reach = 0, 0
        for p, a in zip(per[new].tolist(), a[new].tolist()):
            if p == now and a < reach:
                continue
            now, reach = p, _agree(codes, a, p)
            start = _agree_back(codes, a, p)
            length = reach - start + p
            if length < max(least, times * p) or any(np.array_equal(codes[start : start + p], codes[start + p // d : start + p // d + p]) for d in _primes(p)):
                continue
            found.append((start, length, p))
            part = slice(start, start + length)
            further = inside[part] < start + length
            inside[part][further], period[part][further] = start + length, p
        lo = hi
    return sorted(found, key=lambda r: (r[0], r[2]))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length / period; of equal ones the first in the list."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def repeated(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stand in a run behind its first period."""
    d = np.zeros(n + 1, np.int64)
    for start, length, p in runs:
        d[start + p] += 1
        d[start + length] -= 1
    return np.cumsum(d[:-1]) > 0


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, of each run only the first period."""
    if runs:
        words = [words[i] for i in np.flatnonzero(~repeated(len(words), runs)).tolist()]
    return b" ".join(words)


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Places whose words a text of n words shows, where the query rewrites it; else None."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES, rewrite=None) -> DataFrame:
    """One row a document: its id, n_words, runs (by start, then period), collapsed (the words without repeats, one space apart).

    rewrite(id, n), if given, names the places whose words stand for the n words of a text, or None.
    """
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), filled(batch, "text")
            for lo, hi in slices(texts):
                data, off = raw(texts.slice(lo, hi - lo))
                starts, ends, first = word_spans(data, off)
                codes = word_codes(data, starts, ends) if len(starts) else np.zeros(0, np.int64)
                first = first.tolist()
                size, runs, left = [], [], []
                for i in range(hi - lo):
                    c, words = codes[first[i] : first[i + 1]], data[off[i] : off[i + 1]].tobytes().split()  # splits at the same ASCII white space
                    at = rewrite(ids[lo + i], len(c)) if rewrite else None
                    if at is not None:
                        c, words = c[at], [words[k] for k in at.tolist()]
                    r = find_runs(c, least, times)
                    size.append(len(c))
                    runs.append([dict(zip(("start", "length", "period"), x)) for x in r])
                    left.append(collapse(words, r).decode())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(size, pa.int64()), pa.array(runs, _RUNS), pa.array(left, pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(lean(run), f"doc_id {kind}, n_words long, {RUNS}, collapsed string")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the strongest run and digests, from the rows of periodic_runs()."""

    def run(batches):
        for batch in batches:
            out = []
            for runs, left in zip(batch.column(1).to_pylist(), batch.column(2)):
                runs = [(r["start"], r["length"], r["period"]) for r in runs]
                s, n, p = strongest(runs) or (None, None, None)
                text = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
                out.append((len(runs), s, n, p, 1000 * n // p if p else None, hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(memoryview(left.as_buffer() or b"")).hexdigest()))
            cols = list(zip(*out)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64() if i < 5 else pa.string()) for i, c in enumerate(cols)]], names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.select("doc_id", "runs", "collapsed").mapInArrow(lean(run), f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(periodic_runs(table(spark, sf_dir, "documents"), rewrite=planted))


#: Equal words q apart, neighbouring ones taken together: where periods cover the same stretch the smallest is its period.
OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    xor(list_reduce(list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i::BIGINT, 1))::BIGINT),
      lambda c, b: list_reduce(range(8)::BIGINT[], lambda k, u: CASE WHEN k & 1 = 1 THEN xor(k >> 1, 3988292384) ELSE k >> 1 END, xor(c, b)), 4294967295::BIGINT), 4294967295) AS h
  FROM documents),
g AS (
  SELECT *, len(ws) AS n, h % 10 = 0 AND len(ws) > 0 AS hit, h // 10 AS g FROM d),
a AS (
  SELECT *, CASE WHEN hit THEN g % n END AS a, CASE WHEN hit THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM g),
w AS (
  SELECT r, i, ws[1 + CASE WHEN hit AND i >= a THEN a + (i - a) % p ELSE i END] AS word, n FROM (SELECT *, unnest(range(n)) AS i FROM a)),
e AS (
  SELECT x.r, y.i - x.i AS q, x.i, x.n FROM w x JOIN w y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
s AS (
  SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS part FROM e),
t AS (
  SELECT r, q, min(i) AS start, count(*) + q AS length FROM s GROUP BY r, q, part HAVING count(*) + q >= greatest(6, 4 * q)),
u AS (
  SELECT r, start, length, min(q) AS period FROM t GROUP BY r, start, length),
b AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs,
    max(length::DOUBLE / period) AS best FROM u GROUP BY r),
o AS (
  SELECT u.r, u.start, u.length, u.period, row_number() OVER (PARTITION BY u.r ORDER BY u.start, u.period) AS k FROM u JOIN b ON u.r = b.r AND u.length::DOUBLE / u.period = best),
x AS (
  SELECT w.r, string_agg(word, ' ' ORDER BY i) AS kept FROM w WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.r = w.r AND w.i >= u.start + u.period AND w.i < u.start + u.length) GROUP BY w.r)
SELECT d.doc_id, coalesce(b.n_runs, 0)::BIGINT AS n_runs, o.start::BIGINT AS start, o.length::BIGINT AS length, o.period::BIGINT AS period, (1000 * o.length // o.period)::BIGINT AS exponent_milli,
  sha256(coalesce(b.runs, '')) AS runs_sha256, sha256(coalesce(x.kept, '')) AS collapsed_sha256
FROM d LEFT JOIN b USING (r) LEFT JOIN o ON o.r = d.r AND o.k = 1 LEFT JOIN x ON x.r = d.r
"""
