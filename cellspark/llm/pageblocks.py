"""HTML pages as leaf blocks, and labelled pages to learn from.

A block is the text of one block element that no further block element interrupts, with the open elements around it.
References are decoded, white space is one space (a line break is white space), and empty blocks are none.  The reader
closes what HTML lets authors leave open: paragraphs, list items, table cells, options; markup that never ends takes the
rest of the page, as in browsers.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from dataclasses import dataclass
from html import escape, unescape

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no markup; their text is not part of the page, but for those in SHOWN.
RAW = frozenset("script style xmp iframe noembed noframes title textarea plaintext".split())
SHOWN = frozenset(["textarea"])
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav noscript ol optgroup option p pre search section select summary svg table tbody td textarea tfoot th thead tr ul""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CELLS = frozenset("td th caption".split())
#: What a start tag closes, and the elements that it does not look beyond.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}), "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
}

_TOKEN = re.compile(r"""<!--(?:-?>|.*?--!?>|.*)|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*"|'[^']*')|[="'])*+)(>|\Z)""", re.S)
_NAMES = re.compile(r"""(?:^|[\s"'/])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[A-Z]?[a-zà-ÿ]+|[A-Z]+")


@dataclass(slots=True)
class Block:
    text: str
    around: tuple[str, ...]  # features of the open elements
    box: int  # number of the element around the block's own
    linked: int  # code points in links


class _Reader:
    def __init__(self):
        self.stack: list[tuple[str, tuple[str, ...], int]] = []  # tag, its features, its number
        self.open: Counter = Counter()
        self.out: list[Block] = []
        self.parts: list[str] = []
        self.linked = 0
        self.made = 0
        self.around: tuple[str, ...] | None = None
        self.box = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts = []
        if text:
            if self.around is None:
                self.look()
            self.out.append(Block(text, self.around, self.box, min(self.linked, len(text))))
        self.linked = 0

    def look(self) -> None:
        """Features of the open block elements: each tag and name, each two neighbours, and the innermost."""
        blocks = [(t, f, n) for t, f, n in self.stack if t in BLOCK and t not in ("html", "body")]
        seen = dict.fromkeys(x for _, f, _ in blocks for x in f)
        tags = [t for t, _, _ in blocks]
        seen.update(dict.fromkeys(f"{a}>{b}" for a, b in zip(tags, tags[1:])))
        inner = tags[-1] if tags else "none"
        self.around = (*seen, f"tag {inner}")
        self.box = blocks[-2][2] if len(blocks) > 1 else 0

    def text(self, raw: str) -> None:
        if self.open["head"]:
            if raw.isspace():
                return
            self.cut(self.find("head"))
        s = unescape(raw) if "&" in raw else raw
        self.parts.append(s)
        if self.open["a"]:
            self.linked += len(" ".join(s.split()))

    def find(self, *tags: str) -> int:
        """Place of the innermost of the open elements."""
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in tags:
                return i
        return -1

    def cut(self, i: int) -> None:
        """Close the element at i and all within."""
        if i < 0:
            return
        for tag, _, _ in self.stack[i:]:
            self.open[tag] -= 1
            if tag in BLOCK and self.around is not None:
                self.around = None
        del self.stack[i:]

    def close_open(self, tags, stop) -> None:
        if not any(self.open[t] for t in tags):
            return
        for i in range(len(self.stack) - 1, -1, -1):
            t = self.stack[i][0]
            if t in tags:
                return self.cut(i)
            if t in stop:
                return None

    def start(self, tag: str, attributes: str) -> None:
        if self.open["head"] and tag not in HEAD:
            self.cut(self.find("head"))
        if tag == "br":
            self.parts.append(" ")
        if tag in BLOCK:
            self.flush()
            if tag in CLOSES:
                self.close_open(*CLOSES[tag])
            if tag not in ("button", "option", "optgroup", "noscript", "svg", "textarea", "select"):
                self.close_open(("p",), ("table", "td", "th", "caption", "button"))
            if tag in HEADINGS and self.stack and self.stack[-1][0] in HEADINGS:
                self.cut(len(self.stack) - 1)
        elif tag == "a" and self.open["a"]:
            self.end("a")
        if tag in VOID or tag in ("html", "body") and self.open[tag]:
            return
        names = {p.lower() for m in _NAMES.finditer(attributes) for p in _PART.findall(unescape(m[1] or m[2] or m[3] or ""))} if attributes else ()
        self.made += 1
        self.stack.append((tag, (f"in {tag}", *[f"named {x}" for x in sorted(names)]), self.made))
        self.open[tag] += 1
        if tag in BLOCK:
            self.around = None

    def end(self, tag: str) -> None:
        if tag in BLOCK or tag == "br":
            self.flush()
        if not self.open[tag] or tag in ("html", "body"):
            return
        i = self.find(tag)
        if tag in BLOCK or tag == "head" or tag == "template":
            if tag in CELLS or tag in ("table", "tr", "tbody", "thead", "tfoot") or not any(t in CELLS for t, _, _ in self.stack[i + 1 :]):
                self.cut(i)
        else:  # an inline element ends alone, blocks within stay open
            del self.stack[i]
            self.open[tag] -= 1


def leaf_blocks(html: str) -> list[Block]:
    """The blocks of a page in page order."""
    r, at, n = _Reader(), 0, len(html)
    hidden = 0  # open templates
    while at < n:
        m = _TOKEN.search(html, at)
        stop = m.start() if m else n
        if stop > at and not hidden:
            r.text(html[at:stop])
        if not m:
            break
        at = m.end()
        if m[2] is None or not m[4]:  # a comment, or a tag that never ends
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "template" and hidden:
                hidden -= 1
            elif not hidden:
                r.end(tag)
            continue
        if tag == "template":
            hidden += 1
        elif tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at) if tag != "plaintext" else None
            end = close.start() if close else n
            if tag in SHOWN and not hidden:
                r.start(tag, m[3])
                r.text(html[at:end])
                r.end(tag)
            at = end
        elif not hidden:
            r.start(tag, m[3])
    r.flush()
    return r.out


# --- labelled pages -------------------------------------------------------------------------------------------------

#: Names that authors give to the parts of a page.
MAIN_NAMES = "article article-body article-content content main-content entry entry-content post post-content post-body story story-body text body-text page-content maintext".split()
PART_NAMES = {
    "menu": "nav navigation navbar menu main-menu top-menu site-nav breadcrumb breadcrumbs pagination pager tabs toc".split(),
    "header": "header site-header masthead top topbar branding logo banner-top page-header".split(),
    "footer": "footer site-footer bottom colophon copyright legal foot page-footer".split(),
    "sidebar": "sidebar side aside rail widget widgets secondary related related-posts recommended popular trending tags more".split(),
    "notice": "notice cookie cookies cookie-notice consent gdpr alert warning message popup modal overlay paywall banner".split(),
    "ad": "ad ads advert advertisement adsense sponsor sponsored promo promotion banner-ad".split(),
    "form": "form search search-form login newsletter subscribe signup contact".split(),
    "comments": "comments comment comment-list comment-body responses discussion replies reply disqus reader-comments".split(),
    "share": "share sharing social social-links follow like".split(),
}
WRAPPERS = "wrapper container page site inner outer row col layout grid columns block box section".split()
PLAIN = "the a of and river stone cloud paper light window garden winter to in with over under is was by from house road morning voice".split()


class Author:
    """Writes pages of many layouts, with a label a block, from given texts."""

    def __init__(self, seed: int, texts: list[str]):
        self.rnd = random.Random(seed)
        self.texts = [t for t in texts if t] or [" ".join(self.rnd.choice(PLAIN) for _ in range(n)).capitalize() + "." for n in (1, 2, 3, 5, 8, 12, 20, 30, 40, 60, 90, 120) for _ in range(10)]
        self.words = sorted({w for t in self.texts[:400] for w in t.split()[:60]})
        self.labels: list[int] = []

    def pick(self, options):
        return self.rnd.choice(options)

    def phrase(self, lo: int, hi: int) -> str:
        return " ".join(self.pick(self.words) for _ in range(self.rnd.randint(lo, hi)))

    def leaf(self, tag: str, text: str, label: int, link: float = 0.0, closed: bool = True) -> str:
        if not text.strip():
            return ""
        self.labels.append(label)
        body = escape(text, quote=False)
        if self.rnd.random() < link:
            body = f'<a href="/{self.rnd.randint(0, 999)}">{body}</a>'
        elif label and self.rnd.random() < 0.2:
            words = body.split(" ")
            k = self.rnd.randrange(len(words))
            words[k] = f"<{(t := self.pick(['b', 'em', 'a', 'i', 'span', 'strong']))}>{words[k]}</{t}>"
            body = " ".join(words)
        return f"<{tag}>{body}" + (f"</{tag}>" if closed else "")

    def element(self, tag: str, names: list[str] | None, inner: str) -> str:
        attributes = ""
        if names and self.rnd.random() < 0.85:
            kind = self.pick(["class", "class", "id"])
            name = self.pick(names)
            if self.rnd.random() < 0.3:
                name = self.pick([f"{name}-{self.pick(WRAPPERS)}", f"{self.pick(WRAPPERS)}-{name}", f"{name} {self.pick(WRAPPERS)}", f"{name}_{self.rnd.randint(1, 9)}"])
            attributes = f' {kind}="{name}"'
        return f"<{tag}{attributes}>{inner}</{tag}>"

    def links(self, lo: int, hi: int) -> str:
        return "<ul>" + "".join(self.leaf("li", self.phrase(1, 4), 0, 1.0, self.rnd.random() < 0.8) for _ in range(self.rnd.randint(lo, hi))) + "</ul>"

    def lines(self, lo: int, hi: int, link: float = 0.3) -> str:
        return "".join(self.leaf(self.pick(["p", "div", "h3", "p"]), self.pick([self.phrase(1, 9), self.pick(self.texts)]), 0, link) for _ in range(self.rnd.randint(lo, hi)))

    def part(self, kind: str) -> str:
        r, names = self.rnd, PART_NAMES[kind]
        if kind == "menu":
            return self.element(self.pick(["nav", "nav", "div"]), names, self.links(2, 9))
        if kind == "header":
            return self.element(self.pick(["header", "div"]), names, self.leaf(self.pick(["h1", "div", "p"]), self.phrase(1, 4), 0, 0.6) + (self.leaf("p", self.phrase(3, 9), 0) if r.random() < 0.5 else "") + (self.part("menu") if r.random() < 0.4 else ""))
        if kind == "footer":
            mark = self.pick(["© ", "", "© 2020 "])
            body = self.leaf("p", mark + self.phrase(2, 9) + self.pick(["", " · " + self.phrase(2, 9), ". " + self.pick(self.texts)]), 0)
            if r.random() < 0.3:  # text of the footer itself
                self.labels.append(0)
                body += escape(mark + self.phrase(1, 5) + " · " + self.pick(self.texts))
            return self.element(self.pick(["footer", "footer", "div"]), names, body + (self.links(2, 5) if r.random() < 0.4 else ""))
        if kind == "sidebar":
            return self.element(self.pick(["aside", "div", "section"]), names, self.leaf("h3", self.phrase(1, 3), 0) + self.pick([self.links, self.lines])(1, 5))
        if kind in ("notice", "ad"):
            tag = self.pick(["div", "div", "aside", "section"])
            if r.random() < 0.5:
                self.labels.append(0)
                return self.element(tag, names, escape(self.pick([self.phrase(2, 12), self.pick(self.texts)])))
            return self.element(tag, names, self.lines(1, 3) + (self.leaf("button", self.phrase(1, 2), 0) if kind == "notice" and r.random() < 0.5 else ""))
        if kind == "form":
            inner = self.leaf("p", self.phrase(1, 8), 0) + '<input type="text" name="q">' + self.leaf("button", self.phrase(1, 2), 0)
            if r.random() < 0.4:
                inner += "<select>" + "".join(self.leaf("option", self.phrase(1, 2), 0, 0, r.random() < 0.5) for _ in range(3)) + "</select>"
            return self.element("form", names, inner) if r.random() < 0.8 else self.element("div", names, f"<form>{inner}</form>")
        if kind == "comments":
            one = lambda: self.element(self.pick(["div", "li", "article"]), names, self.leaf(self.pick(["p", "div", "h4"]), self.phrase(1, 3), 0, 0.4) + "".join(self.leaf("p", self.pick(self.texts), 0) for _ in range(r.randint(1, 2))))
            title = self.leaf(self.pick(["h2", "h3"]), self.phrase(1, 3), 0)
            return self.element(self.pick(["section", "div", "div", "ol"]), names, title + "".join(one() for _ in range(r.randint(1, 4))))
        return self.element("div", names, self.links(2, 4))

    def story(self) -> str:
        """The blocks of a main text, with what stands between them."""
        r, out = self.rnd, []
        if r.random() < 0.9:
            head = self.leaf("h1", self.phrase(1, 9), 1)
            out.append(f"<header>{head}</header>" if r.random() < 0.2 else head)
        loose = r.random() < 0.3
        for _ in range(r.choice([1, 2, 3, 4, 6, 8, 12, 16])):
            k = r.random()
            if k < 0.7:
                text = self.pick(self.texts) if r.random() < 0.85 else self.phrase(1, 3) + "."
                if loose and r.random() < 0.3:
                    self.labels.append(1)
                    out.append(f"<p><b>{escape(text, quote=False)}<br>")
                else:
                    out.append(self.leaf("p", text, 1, 0.02, not loose or r.random() < 0.7))
            elif k < 0.78:
                out.append(self.leaf(self.pick(["h2", "h3"]), self.phrase(1, 7), 1))
            elif k < 0.84:
                out.append("<ul>" + "".join(self.leaf("li", self.phrase(2, 20), 1, 0.15) for _ in range(r.randint(2, 5))) + "</ul>")
            elif k < 0.87:
                out.append("<blockquote>" + self.leaf("p", self.pick(self.texts), 1) + "</blockquote>")
            elif k < 0.89:
                out.append(self.leaf("pre", self.phrase(3, 20), 1))
            elif k < 0.91:
                out.append("<table>" + "".join("<tr>" + "".join(self.leaf("td", self.phrase(1, 3), 1) for _ in range(3)) + "</tr>" for _ in range(3)) + "</table>")
            elif k < 0.93:
                out.append('<figure><img src="/x.png">' + self.leaf("figcaption", self.phrase(2, 9), 1) + "</figure>")
            else:
                out.append(self.part(self.pick(["ad", "ad", "sidebar", "share", "form", "notice", "menu"])))
        if r.random() < 0.2:
            out.append(self.part(self.pick(["footer", "share", "comments", "comments", "sidebar"])))
        return "".join(out)

    def page(self) -> tuple[str, list[int]]:
        """A page and the label of each of its blocks: 1 for main text."""
        r = self.rnd
        self.labels = []
        before = "".join(self.part(k) for k in r.sample(["header", "menu", "notice", "ad", "form", "sidebar", "menu", "ad"], r.randint(0, 4)))
        story = self.story()
        kind = self.pick(["article", "article", "article", "main", "both", "div", "div", "section"])
        if kind == "article":
            main = f"<article>{story}</article>" if r.random() < 0.6 else self.element("article", MAIN_NAMES, story)
        elif kind == "main":
            main = f"<main>{story}</main>"
        elif kind == "both":
            main = f"<main><article>{story}</article></main>"
        else:
            main = self.element(kind, MAIN_NAMES, story)
        after = "".join(self.part(k) for k in r.sample(["footer", "comments", "sidebar", "ad", "share", "menu", "form", "footer"], r.randint(0, 4)))
        body = before + main + after
        if r.random() < 0.4:
            body = self.element("div", WRAPPERS, body)
        self.labels = list(self.labels)
        end = "</body></html>" if r.random() < 0.8 else ""
        return f'<!DOCTYPE html><html><head><title>{escape(self.phrase(1, 9))}</title><script>var t="</p>";</script></head><body>{body}{end}', self.labels
