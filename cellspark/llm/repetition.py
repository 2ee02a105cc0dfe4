"""Quality rules: repetition within a text from a suffix array.

The suffix array runs over the words of a text.  The common-prefix intervals of at least MIN_REPEAT words are its maximal
repeated substrings; their spans are united.  A text passes if the united spans hold at most MAX_COVERED of its word
characters and no repeat is longer than MAX_REPEAT words.

Cases: a null or empty text has no words and fails the base rule; a text without any repeat passes the method; equal rows
get equal verdicts; very long texts are processed whole, one at a time; an empty table gives an empty table; other
columns are not touched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import filled, lean, raw, slices, table, word_codes, word_spans
from .suffix import SuffixArray

MIN_REPEAT = 8
MAX_REPEAT = 60
MAX_COVERED = 0.3
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, covered_chars long, longest_repeat long"


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in some [start, start + length)."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, starts + lengths, -1)
    return np.cumsum(d[:-1]) > 0


def repeat_lengths(codes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """For each word: how many words from it on also stand elsewhere in the same row.

    That is the length of the deepest common-prefix interval that holds the suffix: the larger of the common prefixes
    with its two neighbours in the suffix array.
    """
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    arr = SuffixArray(row * (codes.max() + 1) + codes)
    lcp = arr.lcp()
    both = np.maximum(lcp, np.concatenate([lcp[1:], [0]]))
    out = np.empty(n, np.int64)
    out[arr.sa] = both
    return out


def dup_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of SCHEMA for each text."""
    data, off = raw(texts)
    starts, ends, first = word_spans(data, off)
    row = np.repeat(np.arange(len(off) - 1), np.diff(first))
    codes = word_codes(data, starts, ends) if len(starts) else np.zeros(0, np.int64)
    long = repeat_lengths(codes, row)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    size = chars[ends] - chars[starts]
    per_row = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[first])
    at3, at = np.flatnonzero(long >= 3), np.flatnonzero(long >= MIN_REPEAT)
    longest = np.zeros(len(off) - 1, np.int64)
    np.maximum.at(longest, row[at], long[at])
    marks = np.concatenate([[0], np.cumsum(SYMBOLS[data])])
    return {
        "n_words": np.diff(first), "word_chars": per_row(size), "n_symbols": np.diff(marks[off]), "n_dup_lines": np.array([dup_lines(t) for t in texts.to_pylist()], np.int64),
        "n_repeat_words": per_row(covered(at3, np.full(len(at3), 3), len(codes))), "covered_chars": per_row(size * covered(at, long[at], len(codes))), "longest_repeat": longest,
    }


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: its id, the counts, base_failed and kept."""
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))

    def run(batches):
        for batch in batches:
            texts = filled(batch, "text")
            for lo, hi in slices(texts):
                m = measure(texts.slice(lo, hi - lo))
                failed = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
                good = (m["covered_chars"] <= MAX_COVERED * m["word_chars"]) & (m["longest_repeat"] <= MAX_REPEAT)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *[pa.array(v, pa.int64()) for v in m.values()], pa.array(failed), pa.array(good & ~failed)], names=["doc_id", *m, "base_failed", "kept"])

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(lean(run), f"doc_id {kind}, {SCHEMA}, base_failed boolean, kept boolean")


def op3_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "covered_chars")


#: A text has a repeat of more than 60 words just where a window of 61 words stands in it twice.
OP3_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
p AS (
  SELECT r, unnest(range(1, len(ws) + 1)) AS i, ws FROM w),
g AS (
  SELECT r, i, ws[i] AS word,
    CASE WHEN i + 2 <= len(ws) THEN array_to_string(ws[i:i+2], ' ') END AS g3,
    CASE WHEN i + 7 <= len(ws) THEN array_to_string(ws[i:i+7], ' ') END AS g8,
    CASE WHEN i + 60 <= len(ws) THEN md5(array_to_string(ws[i:i+60], ' ')) END AS g61 FROM p),
c AS (
  SELECT r, i, word,
    g3 IS NOT NULL AND count(*) OVER (PARTITION BY r, g3) > 1 AS t3,
    g8 IS NOT NULL AND count(*) OVER (PARTITION BY r, g8) > 1 AS t8,
    g61 IS NOT NULL AND count(*) OVER (PARTITION BY r, g61) > 1 AS t61 FROM g),
m AS (
  SELECT r, word, t61,
    bool_or(t3) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c3,
    bool_or(t8) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS c8 FROM c),
a AS (
  SELECT r, sum(length(word)) AS word_chars, count(*) FILTER (c3) AS n3, coalesce(sum(length(word)) FILTER (c8), 0) AS covered, bool_or(t61) AS over FROM m GROUP BY r),
l AS (
  SELECT r, count(*) - count(DISTINCT line) AS dup FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
f AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(n3, 0)::BIGINT AS n_repeat_words, coalesce(covered, 0)::BIGINT AS covered_chars, coalesce(over, false) AS over
  FROM w LEFT JOIN a USING (r) LEFT JOIN l USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT over AND covered_chars <= 0.3::DOUBLE * word_chars AS kept, covered_chars
FROM f
"""
