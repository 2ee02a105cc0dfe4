"""Spelling variants: words one edit apart, each led to its most frequent neighbour and on to the root of its group.

A word's mask holds the parity of each letter's count, so one inserted or deleted code point flips one bit and a replaced
one two at most.  The mask is cut into BANDS bands of which two flips leave one equal: words that share a band's value and
have equal lengths, or lengths one apart, meet in a bucket, are compared by the bits in which their masks differ, and the
few that are left by their letters.  A pair is taken where its first equal band has it, so it is found once.  Pairs never
become rows: a bucket gives each of its words the number of its neighbours and the best of them.

1. Occurrences are counted in each task, then over all tasks; the vocabulary is written once.
2. A word goes to each band's bucket of its own length, where it meets equal lengths, and to that of one letter less.  A
   bucket of more than TILE words is cut into tiles, and each two tiles meet in a cell of their own, so no task holds more
   than two tiles at once.
3. Counts and bests of a word meet; from form to form the count doubles at least, so a root is reached by pointer doubling
   in a number of joins that is the logarithm of the logarithm of the largest count.

Cases: a null or empty text has no words; in the query an occurrence in a text without an id is never misspelt; texts and
words are taken whole, however long; repeated rows count as often as they stand; ties go to the smallest word in code-point
order; an empty table gives an empty table; other columns are not touched.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_broadcast, filled, lean, stored, table

LETTERS = "[A-Za-zÀ-ÿ]+"
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
MIN_LENGTH = 5
MIN_COUNT = 3
BANDS = 3
TILE = 1 << 14
#: Letters by their frequency in European texts; neighbours go to different bands, so that bands tell words apart about equally well.
ORDER = "entaiorhsulcdgmfbpvwzykqxj"
#: Distinct words that a task counts before it passes them on.
HELD = 200_000


def bit_of() -> np.ndarray:
    """The mask bit of each code point: one a letter; those beyond a-z share the 38 bits behind them, as any of them may."""
    out = 26 + np.arange(1 << 16) % 38
    out[[ord(c) for c in ORDER]] = np.arange(26)
    return out


BIT = bit_of()


def masks(words: list[str]) -> np.ndarray:
    """The letter parities of the words."""
    size = np.array([len(w) for w in words], np.int64)
    out = np.zeros(len(words), np.uint64)
    if not size.sum():
        return out
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    full = np.flatnonzero(size)
    out[full] = np.bitwise_xor.reduceat(np.uint64(1) << BIT[flat & 0xFFFF].astype(np.uint64), (np.cumsum(size) - size)[full])
    return out


def band_bits(bands: int = BANDS) -> list[np.uint64]:
    return [np.uint64(sum(1 << b for b in range(k, 64, bands))) for k in range(bands)]


def letters(words: list[str], length: int) -> np.ndarray:
    """Words of one length as a matrix of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, length)


def close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of two matrices of code points, of equal width or b one wider, are exactly one edit apart."""
    n = a.shape[1]
    if b.shape[1] == n:
        return (a != b).sum(1) == 1
    front = np.logical_and.accumulate(a == b[:, :n], axis=1).sum(1)
    back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return front + back >= n


def neighbours(a: list[str], b: list[str], query: np.ndarray, target: np.ndarray, band: int, bands: list[np.uint64], cells: int = 1 << 16):
    """(places in a, places in a or b, whether in b) of the pairs near each other, by pieces.

    a: words of one length, ascending; b: words of one letter more; all share the band's value.  Of two words of a the
    smaller must be a query and the larger a target; of words of a and b that of a must be a query.
    """
    ma, length = masks(a), len(a[0])
    la, asked = letters(a, length), np.flatnonzero(query)
    for other, longer in ((a, False), (b, True)):
        if not other or not len(asked):
            continue
        mb, lb = (masks(b), letters(b, length + 1)) if longer else (ma, la)
        rows, most = max(1, cells // len(mb)), max(1, (1 << 22) // length)
        for lo in range(0, len(asked), rows):
            q = asked[lo : lo + rows]
            begin = 0 if longer else int(q[0]) + 1
            differ = ma[q][:, None] ^ mb[None, begin:]
            i, j = np.nonzero(np.bitwise_count(differ) <= (1 if longer else 2))
            d = differ[i, j]
            i, j = q[i], j + begin
            ok = np.ones(len(i), bool) if longer else (i < j) & target[j]
            for k in range(band):  # an earlier band has the pair
                ok &= (d & bands[k]) != 0
            i, j = i[ok], j[ok]
            for at in range(0, len(i), most):
                x, y = i[at : at + most], j[at : at + most]
                near = close(la[x], lb[y])
                if near.any():
                    yield x[near], y[near], longer


def best_of(words: list[str], n: np.ndarray, who: np.ndarray, partner: np.ndarray, names: list[str], counts: np.ndarray) -> pa.RecordBatch:
    """For each word that has partners: their number, and the one of largest count (ties: first in code-point order)."""
    order = np.lexsort((partner, -counts[partner], who))  # names ascend
    who, partner = who[order], partner[order]
    head = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
    size = np.diff(np.append(head, len(who)))
    pick = partner[head]
    return pa.RecordBatch.from_arrays([pa.array([words[i] for i in who[head].tolist()], pa.string()), pa.array(n[who[head]], pa.int64()), pa.array(size, pa.int64()), pa.array(counts[pick], pa.int64()), pa.array([names[i] for i in pick.tolist()], pa.string())], names=["word", "n", "n_near", "best_n", "best"])


# --- over tables ----------------------------------------------------------------------------------------------------


def misspelt(doc_id: int | None):
    """Rewrites a few occurrences by a hash of document and word: the query's own misspellings."""
    if doc_id is None:
        return None
    begin = zlib.crc32(f"{doc_id}:".encode())

    def change(word: str) -> str:
        h = zlib.crc32(word.encode(), begin)
        if h % 97:
            return word
        at = h % len(word)
        return word[:at] + word[at + 1 :]

    return change


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite=None, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: the letter runs of all texts, A-Z lowered, of min_length code points and min_count occurrences at least.

    rewrite(id), if given, gives a function of a word that stands for each occurrence in the document, or None.
    """
    find = re.compile(LETTERS)

    def out(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    def count(batches):
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), filled(batch, "text")):
                here = Counter(find.findall((text.as_buffer() or pa.py_buffer(b"")).to_pybytes().translate(LOWER).decode()))
                change = rewrite(doc_id) if rewrite else None
                for word, n in here.items():
                    if change:
                        word = change(word)
                    if len(word) >= min_length:
                        held[word] += n
                if len(held) >= HELD:
                    yield out(held)
                    held = Counter()
        if held:
            yield out(held)

    words = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(lean(count), "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def near_words(words: DataFrame, bands: int = BANDS, tile: int = TILE) -> DataFrame:
    """words: word (distinct, no nulls or empty ones), n; a written table -> word, n, n_near, best_n, best, one row a bucket in which a word has neighbours."""
    spark = words.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = band_bits(bands)

    def keys(batches):
        for batch in batches:
            w = batch.column(0).to_pylist()
            m, size = masks(w), np.array([len(x) for x in w], np.int64)
            for k in range(bands):
                value = pa.array((m & bits[k]).view(np.int64))
                for less in (0, 1):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(w), k, np.int32)), value, pa.array(size - less), pa.array(np.full(len(w), less == 1)), batch.column(0), batch.column(1)], names=["band", "value", "length", "longer", "word", "n"])

    key = ["band", "value", "length"]
    dealt = words.select("word", "n").mapInArrow(keys, "band int, value long, length long, longer boolean, word string, n long")
    hot = stored(dealt.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > tile).select(*key, F.ceil(F.col("rows") / tile).cast("int").alias("tiles")), "spelling-hot")
    tiles = F.coalesce(F.col("tiles"), F.lit(1))
    own = F.pmod(F.xxhash64("word"), tiles).cast("int")
    cell = lambda ask, answer: F.struct(ask.alias("ask"), answer.alias("answer"))
    all_tiles = F.sequence(F.lit(0), tiles - 1)
    answers = F.transform(all_tiles, lambda t: cell(t, own))
    cells = F.when(F.col("longer"), answers).otherwise(F.array_union(answers, F.transform(all_tiles, lambda t: cell(own, t))))
    cut = bounded_broadcast(dealt, hot, key, "left", hot.count()).select(*key, "longer", "word", "n", own.alias("own"), F.explode(cells).alias("cell"))
    rows = cut.select(*key, "cell.ask", "cell.answer", "longer", (F.col("own") == F.col("cell.ask")).alias("query"), (F.col("own") == F.col("cell.answer")).alias("target"), "word", "n")

    def compare(batches):
        now, a, b = None, [], []

        def bucket():
            if not a or now is None:
                return
            wa, wb = [x[0] for x in a], [x[0] for x in b]
            na, nb = np.array([x[1] for x in a], np.int64), np.array([x[1] for x in b], np.int64)
            both = wa + wb
            counts = np.concatenate([na, nb])
            rank = np.empty(len(both), np.int64)  # names in code-point order, for ties
            order = sorted(range(len(both)), key=both.__getitem__)
            rank[order] = np.arange(len(both))
            names, sorted_counts = [both[i] for i in order], counts[order]
            left, right = [], []
            held = 0

            def flush():
                x, y = np.concatenate(left), np.concatenate(right)
                left.clear()
                right.clear()
                return best_of(both, counts, np.concatenate([x, y]), rank[np.concatenate([y, x])], names, sorted_counts)

            for i, j, longer in neighbours(wa, wb, np.array([x[2] for x in a]), np.array([x[3] for x in a]), now[0], bits):
                left.append(i)
                right.append(j + len(wa) if longer else j)
                held += len(i)
                if held >= 1 << 20:
                    yield flush()
                    held = 0
            if held:
                yield flush()

        for batch in batches:
            for *at, longer, query, target, word, n in zip(*[batch.column(i).to_pylist() for i in range(10)]):
                if at != now:
                    yield from bucket()
                    now, a, b = at, [], []
                (b if longer else a).append((word, n, query, target))
        yield from bucket()

    sorted_rows = rows.repartition(parts, *key, "ask", "answer").sortWithinPartitions(*key, "ask", "answer", "word")
    return sorted_rows.mapInArrow(lean(compare), "word string, n long, n_near long, best_n long, best string")


def roots(forms: DataFrame) -> DataFrame:
    """forms: word (distinct), form (no nulls, no cycles) -> word, root: the last word that forms lead to, by pointer doubling."""
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = stored(now.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if not after.where("moved").limit(1).count():
            return after.select("word", "root")
        now = after.select("word", "root")


def variants(words: DataFrame, bands: int = BANDS, tile: int = TILE) -> DataFrame:
    """words: word, n -> word, form, root, n, n_near, form_n for every word."""
    words = stored(words, "spelling-words")
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best"))
    rank = F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("form")))
    met = none.unionByName(near_words(words, bands, tile)).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min(rank).alias("best"))
    good = -F.col("best.less") >= 2 * F.col("n")
    formed = stored(met.select("word", "n", "n_near", F.when(good, F.col("best.form")).alias("form"), F.when(good, -F.col("best.less")).alias("form_n")), "spelling-forms")
    ends = roots(formed.where("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(vocabulary(table(spark, sf_dir, "documents"), rewrite=misspelt))


#: Words are near if one letter less makes them equal at one place, or makes one the other.
OP12_SQL = r"""
WITH RECURSIVE o AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
h AS (
  SELECT *, xor(list_reduce(list_transform(range(1, octet_length(encode(doc_id::VARCHAR || ':' || run)) + 1), lambda i: ('0x' || substr(hex(encode(doc_id::VARCHAR || ':' || run)), (2 * i - 1)::BIGINT, 2))::BIGINT),
      lambda c, b: list_reduce(range(8)::BIGINT[], lambda k, u: CASE WHEN k & 1 = 1 THEN xor(k >> 1, 3988292384) ELSE k >> 1 END, xor(c, b)), 4294967295::BIGINT), 4294967295) AS h FROM o),
m AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run) + 2)::BIGINT) ELSE run END AS word, k FROM h),
v AS (
  SELECT word, sum(k)::BIGINT AS n FROM m WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
c AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM v)),
e AS (
  SELECT x.word, y.word AS other FROM c x JOIN c y ON x.less = y.less AND x.i = y.i AND x.word <> y.word
  UNION SELECT c.word, v.word FROM c JOIN v ON c.less = v.word UNION SELECT v.word, c.word FROM c JOIN v ON c.less = v.word),
r AS (
  SELECT e.word, e.other, v.n AS other_n, count(*) OVER (PARTITION BY e.word) AS n_near, row_number() OVER (PARTITION BY e.word ORDER BY v.n DESC, encode(e.other)) AS place FROM e JOIN v ON v.word = e.other),
f AS (
  SELECT v.word, v.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.other_n >= 2 * v.n THEN r.other END AS form, CASE WHEN r.other_n >= 2 * v.n THEN r.other_n END AS form_n
  FROM v LEFT JOIN r ON r.word = v.word AND r.place = 1),
w AS (
  SELECT word, word AS root, form AS ahead FROM f UNION ALL SELECT w.word, f.word, f.form FROM w JOIN f ON f.word = w.ahead)
SELECT f.word, f.form, w.root, f.n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n FROM f JOIN w ON w.word = f.word AND w.ahead IS NULL
"""
