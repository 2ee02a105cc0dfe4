"""Main text of HTML pages: a linear-chain conditional random field over the leaf blocks of a page.

Every block is labelled main text or not.  Its features are the elements around it (tags, neighbouring tags, names in
class, id and role) and its text (length, share in links, marks, end); the chain has a transition of its own for blocks of
one box and for blocks of different boxes.  The field is trained on labelled pages by gradient ascent on the likelihood of
their labels, with forward-backward marginals, and pages are decoded by Viterbi.

Labelled pages are written by `pageblocks.Author`: PAGES pages of many layouts, each block's label known as it is written,
with texts from TEXTS pages of the table (in order of a hash of the id), so that the field learns from the table's
languages.  That is the only bound; all pages are decoded whole.

Cases: null or empty html gives an empty text; a page without main text too; markup that never ends, unclosed elements and
stray end tags are read as browsers read them; repeated rows give equal rows; an empty table gives an empty table, from a
field that learned from words of its own; other columns are not touched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lean, table
from .pageblocks import Author, Block, leaf_blocks

PAGES = 500
TEXTS = 60
SEED = 13
EPOCHS = 120
RATE = 0.3
RIDGE = 0.02
#: A feature of fewer training blocks has no weight.
LEAST = 4
MARKS = {"©": "copyright", "@": "at", "·": "dot", "|": "bar", "»": "arrow", "›": "arrow"}


def block_features(b: Block) -> list[str]:
    n = len(b.text)
    size = n.bit_length()
    share = 10 * b.linked // n
    link = "none" if not b.linked else "some" if share < 5 else "most" if share < 9 else "all"
    last = b.text[-1]
    end = "stop" if last in ".!?…。！？" else "mark" if last in ",;:、" else "other"
    tag = b.around[-1]
    return [*b.around, f"size {size}", f"link {link}", f"end {end}", f"{tag} link {link}", f"{tag} size {size}", *[f"mark {MARKS[c]}" for c in MARKS if c in b.text]]


class Field:
    """Weights of features, of a page's first label, and of transitions within and between boxes."""

    def __init__(self, weights: dict[str, float], start: float, trans: np.ndarray):
        self.weights, self.start, self.trans = weights, start, trans  # trans[same box][from][to]

    def gains(self, blocks: list[Block]) -> list[float]:
        get = self.weights.get
        return [get("", 0.0) + sum([get(f, 0.0) for f in block_features(b)]) for b in blocks]

    def decode(self, blocks: list[Block]) -> list[int]:
        """The most likely labels (Viterbi)."""
        if not blocks:
            return []
        gain, back = self.gains(blocks), []
        a, b = 0.0, self.start + gain[0]
        t = self.trans.tolist()
        for before, block, g in zip(blocks, blocks[1:], gain[1:]):
            (s00, s01), (s10, s11) = t[before.box == block.box]
            back.append((a + s00 < b + s10, a + s01 < b + s11))
            a, b = max(a + s00, b + s10), max(a + s01, b + s11) + g
        labels = [int(b > a)]
        for pair in reversed(back):
            labels.append(int(pair[labels[-1]]))
        return labels[::-1]


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum(1, keepdims=True)


def train(pages: list[tuple[list[Block], list[int]]], epochs: int = EPOCHS, rate: float = RATE, ridge: float = RIDGE) -> Field:
    """A field from pages' blocks and labels, by gradient ascent with a step size a weight."""
    pages = sorted((p for p in pages if p[0]), key=lambda p: -len(p[0]))  # longest first, so those that go on are a prefix
    if not pages:
        return Field({}, 0.0, np.zeros((2, 2, 2)))
    names: dict[str, int] = {"": 0}
    lists = [[0, *[names.setdefault(f, len(names)) for f in dict.fromkeys(block_features(b))]] for blocks, _ in pages for b in blocks]
    count = np.bincount([i for x in lists for i in x], minlength=len(names))
    flat = np.array([i for x in lists for i in x])
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    keep = count[flat] >= LEAST
    flat, row = flat[keep], row[keep]
    y = np.array([v for _, labels in pages for v in labels])
    size = np.array([len(b) for b, _ in pages])
    first = np.cumsum(size) - size
    same = np.array([int(i > 0 and b[i - 1].box == b[i].box) for b, _ in pages for i in range(len(b))])
    going = [int((size > t).sum()) for t in range(size[0])]
    truth = np.zeros((2, 2, 2))
    inner = np.ones(len(y), bool)
    inner[first] = False
    at = np.flatnonzero(inner)
    np.add.at(truth, (same[at], y[at - 1], y[at]), 1)
    n = len(names)
    w, start, trans = np.zeros(n), 0.0, np.zeros((2, 2, 2))
    seen_w, seen_s, seen_t = np.full(n, 1e-6), 1e-6, np.full((2, 2, 2), 1e-6)
    goal = np.bincount(flat, weights=y[row], minlength=n)
    for _ in range(epochs):
        gain = np.bincount(row, weights=w[flat], minlength=len(y))
        e, m = np.exp(np.clip(gain, -30, 30)), np.exp(trans)
        alpha, beta = np.zeros((len(y), 2)), np.ones((len(y), 2))
        alpha[first] = _scaled(np.stack([np.ones(len(first)), e[first] * np.exp(start)], 1))
        for t in range(1, size[0]):
            i = first[: going[t]] + t
            x = np.einsum("ps,pst->pt", alpha[i - 1], m[same[i]])
            x[:, 1] *= e[i]
            alpha[i] = _scaled(x)
        pairs = np.zeros((2, 2, 2))
        for t in range(size[0] - 1, 0, -1):
            i = first[: going[t]] + t
            ahead = beta[i] * np.stack([np.ones(len(i)), e[i]], 1)
            both = alpha[i - 1][:, :, None] * m[same[i]] * ahead[:, None, :]
            both /= both.sum((1, 2), keepdims=True)
            np.add.at(pairs, same[i], both)
            beta[i - 1] = _scaled(np.einsum("pst,pt->ps", m[same[i]], ahead))
        p = alpha * beta
        p = p[:, 1] / p.sum(1)
        g = goal - np.bincount(flat, weights=p[row], minlength=n) - ridge * w
        gs, gt = float((y[first] - p[first]).sum()) - ridge * start, truth - pairs - ridge * trans
        seen_w, seen_s, seen_t = seen_w + g * g, seen_s + gs * gs, seen_t + gt * gt
        w, start, trans = w + rate * g / np.sqrt(seen_w), start + rate * gs / seen_s**0.5, trans + rate * gt / np.sqrt(seen_t)
    w[count < LEAST] = 0
    return Field({f: float(w[i]) for f, i in names.items() if w[i]}, float(start), trans)


def labelled(texts: list[str], n: int = PAGES, seed: int = SEED) -> list[tuple[list[Block], list[int]]]:
    """n pages as blocks with their labels."""
    author, out = Author(seed, texts), []
    for _ in range(n):
        html, labels = author.page()
        blocks = leaf_blocks(html)
        if len(blocks) != len(labels):
            raise ValueError("a written page does not read as it was written")
        out.append((blocks, labels))
    return out


def learn(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", n: int = PAGES, texts: int = TEXTS) -> Field:
    """A field from labelled pages with the words of `texts` pages of the table."""
    some = pages.select(pages[id_col].alias("id"), pages[html_col].alias("html")).where("html IS NOT NULL").select(F.xxhash64("id").alias("h"), "id", "html")
    last = some.select("h").orderBy("h").limit(texts).agg(F.max("h")).first()[0]  # so that no task sends more html than is wanted
    rows = some.where(F.col("h") <= F.lit(last)).orderBy("h", "id", F.md5(F.col("html").cast("binary"))).limit(texts).collect()
    return train(labelled([b.text for r in rows for b in leaf_blocks(r["html"])], n))


def main_text(html: str, field: Field) -> str:
    blocks = leaf_blocks(html)
    return "\n".join(b.text for b, label in zip(blocks, field.decode(blocks)) if label)


def extract(pages: DataFrame, field: Field, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row a page: page_id, the kept columns, text, n_chars."""
    narrow = pages.select(pages[id_col].alias("page_id"), *[pages[c] for c in keep], pages[html_col].alias("html"))
    values = field.weights, field.start, field.trans

    def run(batches):
        f = Field(*values)
        for batch in batches:
            out = [main_text(x, f) for x in batch.column(batch.num_columns - 1).fill_null("").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())], names=[*batch.schema.names[:-1], "text", "n_chars"])

    return narrow.mapInArrow(lean(run), T.StructType([*narrow.schema.fields[:-1], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, learn(pages), keep=("url",))


#: What the pages of the tables hold: one article a page, in headings and paragraphs.
OP13_SQL = r"""
WITH a AS (
  SELECT row_number() OVER () AS r, page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)(</article>|$)', 1, 's') AS body FROM pages),
b AS (
  SELECT r, unnest(p) AS part, generate_subscripts(p, 1) AS i FROM (SELECT r, regexp_split_to_array(body, '</?(p|h1)>') AS p FROM a)),
c AS (
  SELECT r, i, regexp_replace(regexp_replace(part, '<br>', ' ', 'g'), '<[^>]*>', '', 'g') AS part FROM b),
d AS (
  SELECT r, i, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(part, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&#(x27|39);?', '''', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS part FROM c),
e AS (
  SELECT r, string_agg(part, chr(10) ORDER BY i) AS text FROM d WHERE part <> '' GROUP BY r)
SELECT page_id, url, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n_chars FROM a LEFT JOIN e USING (r)
"""
