"""Document fingerprints: Merkle trees over paragraphs and sections, in DataFrame functions only.

A text is cut at newlines into paragraphs and a paragraph after clause and sentence ends into pieces; a leaf is the MD5 of a piece.
A paragraph's digest is over its leaves, a section's (SECTION paragraphs) over its paragraphs, the root (SHA-256) over the
sections and the shape.  Cuts keep every character apart from the one newline or blank cut at, so equal roots mean equal
texts up to hash collisions.  Where two trees differ, the differing sections and then paragraphs locate the edits.

The fingerprint is the root; the likeness of two fingerprints is the Jaccard index of their trees' distinct leaves.

Cases: a null text counts as empty; the empty text is one empty paragraph with one empty leaf, so two empty texts are
alike (1.0); an edit that changes nothing (equal neighbours, texts of one character) has likeness 1.0 and no first place;
repeated rows get equal fingerprints; equal ids follow each other in order of length and hash, null ids last, and either
may be cut over several ranges; a table of one row is followed by itself; an empty table gives an empty table; a very long text is one row, hashed
in one pass; other columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut_rows, table

SECTION = 8
PIECE_END = r"(?<=[.!?,;:|]) "


def tree(text: Column) -> Column:
    """struct<root, sections, paragraphs: array<struct<digest, leaves>>> of a text."""

    def paragraph(p: Column) -> Column:
        return F.transform(F.split(p, PIECE_END, -1), lambda x: F.md5(x.cast("binary")))

    def of(leaves: Column) -> Column:
        digests = F.transform(leaves, lambda l: F.md5(F.array_join(l, ",").cast("binary")))

        def top(d: Column) -> Column:
            n = F.ceil(F.size(d) / F.lit(SECTION)).cast("int")
            sections = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.md5(F.array_join(F.slice(d, i * SECTION + 1, SECTION), ",").cast("binary")))
            return F.element_at(F.transform(F.array(sections), lambda s: F.struct(F.sha2(F.concat(F.array_join(s, ","), F.lit("/"), F.size(d).cast("string")).cast("binary"), 256).alias("root"), s.alias("sections"), d.alias("paragraphs"), F.array_distinct(F.flatten(leaves)).alias("leaves"))), 1)

        return F.element_at(F.transform(F.array(digests), top), 1)

    return F.element_at(F.transform(F.array(F.transform(F.split(text, "\n", -1), paragraph)), of), 1)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two trees' leaves."""
    both = F.size(F.array_intersect(a["leaves"], b["leaves"]))
    return both / (F.size(a["leaves"]) + F.size(b["leaves"]) - both)


def differing(a: Column, b: Column) -> Column:
    """Numbers (from 0) of the paragraphs of b that differ, found by descending only into sections whose digests differ."""
    parts = F.sequence(F.lit(0), F.size(b["sections"]) - 1)
    changed = F.filter(parts, lambda i: F.coalesce(F.get(a["sections"], i) != F.get(b["sections"], i), F.lit(True)))
    inside = F.flatten(F.transform(changed, lambda i: F.sequence(i * SECTION, F.least(i * SECTION + SECTION, F.size(b["paragraphs"])) - 1)))
    return F.filter(inside, lambda j: F.coalesce(F.get(a["paragraphs"], j) != F.get(b["paragraphs"], j), F.lit(True)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the tree's root, sections, paragraphs and distinct leaves of every text."""
    return docs.select(docs[id_col].alias("doc_id"), tree(F.coalesce(docs[text_col], F.lit(""))).alias("tree")).select("doc_id", "tree.*")


def bucket_of(at: Column, cuts: list[tuple[int, int]]) -> Column:
    """The range that a struct<key, tie> falls in: a search in two steps, so its work grows with the root of the number of cuts."""
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    all_cuts, coarse = (F.expr("array(" + ",".join(f"named_struct('key', {k}L, 'tie', {t}L)" for k, t in x) + ")") for x in (cuts, cuts[step - 1 :: step]))
    low = F.size(F.filter(coarse, lambda c: c <= at)) * step
    return low + F.size(F.filter(F.slice(all_cuts, low + 1, step), lambda c: c <= at))


def with_next(docs: DataFrame, id_col: str, text_col: str, parts: int | None = None) -> DataFrame:
    """doc_id, text, next: each row with the text of the row after it in ascending id (after the last: the first).

    Rows are cut into ranges of (id, tie); a window runs in each range.  The first rows of a range are also dealt to the
    range before it, as its end, so texts are shuffled once and nothing is gathered in one place.
    """
    spark = docs.sparkSession
    top = 2**63 - 1
    text = F.coalesce(docs[text_col], F.lit(""))
    tie = F.length(text).cast("long") * F.lit(2**32) + F.xxhash64(text).bitwiseAND(F.lit(2**32 - 1))
    keyed = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(top)).alias("key"), tie.alias("tie"), docs[id_col].isNull().alias("no_id"), text.alias("text"))
    parts = parts or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = F.struct("key", "tie")
    bucket = bucket_of(at, cut_rows(keyed, parts))
    lows = sorted((r["b"], *r["lo"]) for r in keyed.groupBy(bucket.alias("b")).agg(F.min(at).alias("lo")).collect())  # one row a range
    # a range's lowest row, and the range before it (the first follows the last)
    tails = [(k, t, lows[i - 1][0]) for i, (_, k, t) in enumerate(lows)]
    ends = spark.sql("SELECT * FROM VALUES " + ", ".join(f"({k}L, {t}L, {b})" for k, t, b in tails or [(0, 0, 0)]) + " AS t(key, tie, tail)")
    dealt = keyed.join(F.broadcast(ends), ["key", "tie"], "left")  # as many rows as ranges, three numbers each
    own = F.struct(bucket.alias("b"), F.lit(False).alias("tail"))
    both = dealt.select("key", "tie", "no_id", "text", F.explode(F.when(F.col("tail").isNull(), F.array(own)).otherwise(F.array(own, F.struct(F.col("tail").alias("b"), F.lit(True).alias("tail"))))).alias("at")).select("key", "tie", "no_id", "text", "at.b", "at.tail")
    order = Window.partitionBy("b").orderBy("tail", "key", "tie")
    return both.withColumn("next", F.lead("text").over(order)).where(~F.col("tail")).select(F.when(~F.col("no_id"), F.col("key")).alias("doc_id"), "text", F.coalesce("next", "text").alias("next"))


def edited(text: Column, following: Column) -> Column:
    """The last half (rounded down) of the code points replaced by the first as many of the next text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, 1, F.length(text) - half), F.substring(following, F.lit(1), half))


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text's tree against those of its edited text and of the next document.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and first_edit: the number of
    the first paragraph that the edit changed, null where the edited text equals the text.
    """
    wide = with_next(docs, id_col, text_col).withColumn("edited", edited(F.col("text"), F.col("next")))

    def row(e: Column) -> Column:
        return F.struct(
            F.length("text").cast("long").alias("n_chars"), F.sha2(e.cast("binary"), 256).alias("edited_sha256"),
            F.element_at(F.transform(F.array(F.struct(tree(F.col("text")).alias("own"), tree(e).alias("edited"), tree(F.col("next")).alias("next"))), lambda t: F.struct(
                t["own"]["root"].alias("fingerprint"), t["edited"]["root"].alias("edited_fingerprint"), likeness(t["own"], t["edited"]).alias("near_edited"), likeness(t["own"], t["next"]).alias("near_next"),
                F.get(differing(t["own"], t["edited"]), 0).cast("long").alias("first_edit"),
            )), 1).alias("f"),
        )

    out = wide.select("doc_id", F.element_at(F.transform(F.array("edited"), row), 1).alias("r"))
    return out.select("doc_id", "r.n_chars", "r.edited_sha256", "r.f.fingerprint", "r.f.edited_fingerprint", "r.f.near_edited", "r.f.near_next", "r.f.first_edit")


def op6_merkle_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edits(table(spark, sf_dir, "documents"))


def _sql_leaves(x: str) -> str:
    """Lists of leaves by paragraph in DuckDB; a lookbehind is not at hand there, so cut places are marked first."""
    return f"list_transform(string_split({x}, chr(10)), lambda p: list_transform(string_split(regexp_replace(p, '([.!?,;:|]) ', '\\1' || chr(1), 'g'), chr(1)), lambda s: md5(s)))"


OP6_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, t, coalesce(lead(t) OVER o, first_value(t) OVER o) AS nx, length(t) AS c FROM d WINDOW o AS (ORDER BY doc_id NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
e AS (SELECT *, left(t, c - c // 2) || left(nx, c // 2) AS ed FROM n),
l AS (SELECT *, {_sql_leaves('t')} AS lt, {_sql_leaves('ed')} AS le, {_sql_leaves('nx')} AS ln FROM e),
g AS (SELECT *, list_transform(lt, lambda x: md5(array_to_string(x, ','))) AS dt, list_transform(le, lambda x: md5(array_to_string(x, ','))) AS de,
  list_distinct(flatten(lt)) AS st, list_distinct(flatten(le)) AS se, list_distinct(flatten(ln)) AS sn FROM l)
SELECT doc_id, c::BIGINT AS n_chars, sha256(ed) AS edited_sha256,
  sha256(array_to_string(list_transform(range(0, (len(dt) + {SECTION - 1}) // {SECTION}), lambda i: md5(array_to_string(dt[i * {SECTION} + 1 : i * {SECTION} + {SECTION}], ','))), ',') || '/' || len(dt)) AS fingerprint,
  sha256(array_to_string(list_transform(range(0, (len(de) + {SECTION - 1}) // {SECTION}), lambda i: md5(array_to_string(de[i * {SECTION} + 1 : i * {SECTION} + {SECTION}], ','))), ',') || '/' || len(de)) AS edited_fingerprint,
  len(list_intersect(st, se))::DOUBLE / (len(st) + len(se) - len(list_intersect(st, se))) AS near_edited,
  len(list_intersect(st, sn))::DOUBLE / (len(st) + len(sn) - len(list_intersect(st, sn))) AS near_next,
  list_filter(range(0, len(de)), lambda j: de[j + 1] IS DISTINCT FROM dt[j + 1])[1] AS first_edit
FROM g
"""
