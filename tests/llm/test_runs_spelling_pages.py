"""Periodic runs, spelling variants and page extraction against brute force, SQL and written pages."""

import hashlib
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cellspark.llm import extraction, pageblocks, periodic, registry, spelling

SF = "/root/testdata/sf0.001"
CLASH = ["n", "word", "words", "runs", "start", "text_", "key", "band", "html_", "n_words", "tile"]


def same(df, sql, **tables):
    db = duckdb.connect()
    for name, path in tables.items():
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    cur = db.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    key = lambda r: tuple(map(str, r))
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=key) == sorted(cur.fetchall(), key=key)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name,table", [("op11_periodic_runs", "documents"), ("op12_spelling_variants", "documents"), ("op13_html_extraction", "pages")])
def test_queries_equal_their_sql(spark, name, table):
    assert same(registry.QUERIES[name](spark, SF), registry.ORACLES[name], **{table: f"{SF}/{table}.parquet"})


# --- 11 ---


def brute_runs(c):
    out = {}
    for q in range(1, len(c) // 4 + 1):
        i = 0
        while i + q < len(c):
            if c[i] != c[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(c) and c[i] == c[i + q]:
                i += 1
            if i - s + q >= max(6, 4 * q):
                out.setdefault((s, i - s + q), q)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def test_runs_against_brute_force():
    rnd = random.Random(5)
    for _ in range(1500):
        some = rnd.choice([1, 2, 2, 3, 5])
        c = [rnd.randrange(some) for _ in range(rnd.randrange(0, 70))]
        if c and rnd.random() < 0.7:
            at = rnd.randrange(len(c))
            c[at:at] = [rnd.randrange(some) for _ in range(rnd.randrange(1, 9))] * rnd.randrange(2, 9)
        assert periodic.find_runs(np.array(c, np.int64), probes=rnd.choice([4, 64, 1 << 20])) == brute_runs(c)


@pytest.mark.parametrize("words", [np.zeros(200_000, int), np.arange(200_000) % 7 // 3, np.arange(200_000) % 997])
def test_long_runs_take_time_in_proportion(words):
    (run,) = periodic.find_runs(words)
    assert run[:2] == (0, 200_000)


def expected_runs(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    milli = 1000 * best[1] // best[2] if runs else None
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(runs), *best, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone))


def text_rows():
    rnd = random.Random(2)
    rows = [(None, "a b " * 9), (None, None), (1, None), (2, ""), (3, " \n\t "), (4, "x " * 6), (4, "x " * 6), (5, "x\xa0y " * 5), (6, "é à " * 7 + "ß")]
    return rows + [(i, " ".join(rnd.choice("abcd") for _ in range(rnd.randrange(1, 120)))) for i in range(10, 90)]


@pytest.mark.parametrize("parts", [1, 7])
def test_runs_of_documents(spark, parts):
    docs = spark.createDataFrame(text_rows(), "doc_id long, text string").repartition(parts).select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])
    got = periodic.digest(periodic.periodic_runs(docs, rewrite=periodic.planted)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((i, *expected_runs(i, t))) for i, t in text_rows())
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in text_rows() if i is not None) > 3  # some were rewritten
    assert periodic.periodic_runs(docs.limit(0)).count() == 0
    plain = {r.doc_id: r for r in periodic.periodic_runs(docs.where("doc_id = 4")).collect()}[4]
    assert (plain.n_words, [tuple(r) for r in plain.runs], plain.collapsed) == (6, [(0, 6, 1)], "x")


# --- 12 ---


def near(a, b):
    """Exactly one edit apart."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected_variants(words):
    out = {}
    for w, n in words.items():
        others = [x for x in words if near(w, x)]
        best = min(others, key=lambda x: (-words[x], x), default=None)
        out[w] = (best if best and words[best] >= 2 * n else None, n, len(others))
    rows = set()
    for w, (form, n, k) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, form, root, n, k, words[form] if form else None))
    return rows


@pytest.mark.parametrize("tile", [1 << 14, 25])
def test_variants_against_brute_force(spark, tile):
    rnd = random.Random(tile)
    words = {"".join(rnd.choice("aabcÉé") for _ in range(rnd.choice([5, 5, 6, 7]))): rnd.choice([3, 3, 4, 6, 7, 12, 13, 50, 101]) for _ in range(500)}
    words |= {"z" * 300_000: 9, "z" * 300_001: 4, "z" * 300_002: 19, "ab" * 2000 + "y": 5, "ab" * 2000 + "x": 11}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)
    got = [tuple(r) for r in spelling.variants(df, tile=tile).collect()]
    assert len(got) == len(set(got)) and set(got) == expected_variants(words)


def test_a_pair_is_found_once():
    words = sorted({"".join(p) for p in __import__("itertools").product("abc", repeat=5)})
    bits = spelling.band_bits()
    m = spelling.masks(words)
    seen = []
    for k in range(spelling.BANDS):
        for v in set((m & bits[k]).tolist()):
            here = [w for w, x in zip(words, m) if int(x & bits[k]) == v]
            for i, j, _ in spelling.neighbours(here, [], np.ones(len(here), bool), np.ones(len(here), bool), k, bits, cells=64):
                seen += [(here[a], here[b]) for a, b in zip(i.tolist(), j.tolist())]
    assert sorted(seen) == sorted((a, b) for a in words for b in words if a < b and near(a, b))


def test_vocabulary(spark):
    rows = [(1, "Straße STRASSE straSSe Éclair éclair"), (2, "strasse_x Éclair1éclair"), (2, "strasse_x Éclair1éclair"), (None, "Éclair"), (3, None), (None, None), (4, ""), (5, "abcd " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])
    got = {r.word: r.n for r in spelling.vocabulary(docs).collect()}
    assert got == {"strasse": 4, "Éclair": 4, "éclair": 3}
    assert spelling.variants(spelling.vocabulary(docs.limit(0))).count() == 0
    change = spelling.misspelt(12)
    for w in (f"word{chr(97 + i % 26)}{chr(97 + i // 26)}é" for i in range(600)):
        h = zlib.crc32(f"12:{w}".encode())
        assert change(w) == (w if h % 97 else w[: h % len(w)] + w[h % len(w) + 1 :])


# --- 13 ---

PAGES = [
    (
        """<!doctype html><HTML><head><title>No</title><style>p{}</style></head><body class=home><div id="site-header"><div class=logo><a href=/>The Daily</a></div>
        <ul class="main-menu"><li><a href=/a>Home<li><a href=/b>World<li><a href=/c>Sport</ul></div><div class="cookie-notice">We use cookies. <button>Accept</button></div>
        <div class="post-content"><h1>A title &amp; more</h1><p>First paragraph, which is long enough to be read,<br>on two lines.<p>Second <b>bold</b>&nbsp;one with <a href="/x">a link</a> inside it.
        <div class="ad">Buy this now</div><ul><li>One point of the list that says something<li>Another point, also long</ul><blockquote>A quotation &lt;here&gt;.</blockquote></div>
        <div id="comments"><h3>2 comments</h3><div class="comment"><p>I do not agree with this article at all, it is quite wrong.</p></div></div>
        <form action=/s><label>Search</label><input name=q></form><div class="footer">© 2020 The Daily</div></body></html>""",
        "A title & more\nFirst paragraph, which is long enough to be read, on two lines.\nSecond bold one with a link inside it.\nOne point of the list that says something\nAnother point, also long\nA quotation <here>.",
    ),
    (
        """<body><header><a href="/">Site</a><nav><ul><li><a href="/1">One</a></li><li><a href="/2">Two</a></li></ul></nav></header><main><article><h1>Short</h1><p>Yes.</p><p></p><p>It was &eacute;t&eacute; &#39;now&#39;.</p>
        <aside class="related"><h3>Related</h3><ul><li><a href="/r">Other story</a></li></ul></aside><p>The end of it all came then, and nobody was there to see it.</p></article></main>
        <aside class="sidebar"><h3>Popular</h3><p>Something else that is popular, and rather long too.</p></aside><footer><p>Imprint</p></footer>""",
        "Short\nYes.\nIt was été 'now'.\nThe end of it all came then, and nobody was there to see it.",
    ),
    ("", ""),
    (None, ""),
    ("<nav><a href=/>Home</a></nav><footer>© me</footer>", ""),
    ("<article><p>Open to the end <!-- never closed <p>gone</p>", "Open to the end"),
    ("<article><p>Open tag <a href='x", "Open tag"),
    ("<article><p>a < b and c</p><script>var s = '<p>no</p>'</script ><p>more</p></article><script>never", "a < b and c\nmore"),
]


@pytest.fixture(scope="module")
def field():
    return extraction.train(extraction.labelled([]))


def test_written_pages(field):
    for html, text in PAGES:
        assert extraction.main_text(html or "", field) == text


def test_held_out_layouts(field):
    """Blocks of pages that the field has not seen; pages whose parts bear no names are a part of them."""
    pages = extraction.labelled([], 200, seed=77)
    right = sum(x == y for b, labels in pages for x, y in zip(field.decode(b), labels))
    assert right / sum(len(b) for b, _ in pages) > 0.98


def test_viterbi_and_gradient_are_exact(field):
    import itertools

    blocks = extraction.labelled([], 1, seed=5)[0][0][:9]
    gain = field.gains(blocks)

    def value(labels):
        v = field.start * labels[0] + sum(g for g, y in zip(gain, labels) if y)
        return v + sum(field.trans[int(a.box == b.box)][x][y] for a, b, x, y in zip(blocks, blocks[1:], labels, labels[1:]))

    assert tuple(field.decode(blocks)) == max(itertools.product((0, 1), repeat=len(blocks)), key=value)


def test_pages_table(spark, field):
    rows = [(i, f"u{i}", html) for i, (html, _) in enumerate(PAGES)] + [(0, "u0", PAGES[0][0]), (None, None, PAGES[1][0])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").select("*", *[F.lit(i).alias(c) for i, c in enumerate([*CLASH, "text", "n_chars"])])
    got = sorted(map(str, map(tuple, extraction.extract(pages, field, keep=("url",)).collect())))
    text = [t for _, t in PAGES] + [PAGES[0][1], PAGES[1][1]]
    assert got == sorted(str((i, u, t, len(t))) for (i, u, _), t in zip(rows, text))
    assert extraction.extract(pages.limit(0), extraction.learn(pages.limit(0))).count() == 0
    assert extraction.learn(pages).weights == extraction.learn(pages.repartition(3)).weights


def test_markup_takes_time_in_proportion():
    for piece in ("<!-- ", "<a href='", "<div>", "<b><p>", "</p", "<p>x", '<a x="', "<td><table>", "<li>", "&amp"):
        pageblocks.leaf_blocks(piece * 20_000)
