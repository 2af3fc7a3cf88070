"""Main text of a page: gradient-boosted trees over the nodes of its tree.

Every block element is a row of features: its tag, attribute tokens, and those of
its ancestors, depth, place among its siblings, and the size, link share and
density of its subtree. Boosted trees give the probability that the node holds
main text. Decoding is hierarchical: a dropped node drops its whole subtree, so of
all labellings without a kept node below a dropped one the likeliest is taken, by
one pass over the tree from the leaves up.

The trees are trained here, on generated pages of many layouts whose nodes are
labelled by construction (``layouts``); the number of pages and the seed are fixed,
so the model is the same everywhere. Scripts, styles and other parts that are
never shown are not text at all.

Null and empty pages give an empty text. Tag soup is read as browsers do in the
main: unknown end tags are skipped, paragraphs, items and cells end where the next
one starts, a head ends at the first text or tag that cannot be in one, a slash ends
svg and math elements at once, open elements end with the page. Formulas are text of
the line they are in. Pages are read whole and one by one,
so repeated rows give repeated texts.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revcat.llm.common import small_batches

HIDDEN = set("script style head title template noscript iframe object svg canvas audio video select option textarea button".split())
HEAD = set("base basefont bgsound link meta noframes noscript script style template title".split())  # what may be in a head
FOREIGN = {"svg", "math"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var "
    "math semantics annotation annotation-xml maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom "
    "mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover".split()
)
#: Start tags that end an open element of the second set, unless one of the third lies between.
_PARAGRAPH_END = set(
    "address article aside blockquote details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr li main menu nav ol p pre section table ul".split()
)
_SCOPE = set("table ul ol dl div section article main body td th".split())
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_SAME_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}
_TOKEN = re.compile(r"[a-z]+")
#: What a page may end in the middle of: a comment or declaration, or a tag.
_UNFINISHED = re.compile(r"<(?:([!?])|/?[a-zA-Z])")


class Page(HTMLParser):
    """The block elements of a page (parent, tag, tokens) and its blocks of text (element, text, characters in links)."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.parents, self.tags, self.tokens = [-1], ["html"], [[]]
        self.blocks: list[tuple[int, str, int]] = []
        self.links = [0]  # elements in links, by element
        self._open = [("html", 0)]  # inline elements have the number of the block they are in
        self._count = Counter({"html": 1})  # of open elements, by tag
        self._text: list[str] = []
        self._linked = self._hidden = self._in_link = 0
        self.feed(html)
        while unfinished := _UNFINISHED.match(self.rawdata):
            # As in a browser, a comment without end reaches to the end; a tag's quote without end, to the next bracket.
            end = -1 if unfinished[1] else self.rawdata.find(">")
            self.rawdata = self.rawdata[end + 1 :] if end >= 0 else ""
            self.goahead(0)
        self.close()
        self._end_block()

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """``<![name[`` is a comment up to the next bracket, in pages that are not XML."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def _enter(self, tag: str, node: int) -> None:
        self._open.append((tag, node))
        self._count[tag] += 1

    def updatepos(self, i: int, j: int) -> int:
        return j  # line numbers are not asked for

    def _end_block(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                self.blocks.append((self._open[-1][1], text, min(self._linked, len(text))))
        self._text, self._linked = [], 0

    def _pop_to(self, depth: int) -> None:
        if any(tag not in INLINE for tag, _ in self._open[depth:]):
            self._end_block()
        for tag, _ in self._open[depth:]:
            self._hidden -= tag in HIDDEN
            self._in_link -= tag == "a"
            self._count[tag] -= 1
        del self._open[depth:]

    def _close_open(self, wanted: set[str], scope: set[str]) -> None:
        if not any(self._count[tag] for tag in wanted):
            return
        for depth in range(len(self._open) - 1, 0, -1):
            tag = self._open[depth][0]
            if tag in wanted:
                return self._pop_to(depth)
            if tag in scope:
                return None

    def _end_head(self) -> None:
        if self._open[-1][0] == "head":
            self._pop_to(len(self._open) - 1)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("html", "body") and self._count[tag]:
            return
        if tag not in HEAD:
            self._end_head()
        if tag in VOID:
            if tag == "hr":
                self._end_block()
            elif tag != "wbr":
                self._text.append(" ")
            return
        if tag in _PARAGRAPH_END:
            self._close_open({"p"}, _SCOPE)
        if tag in _SAME:
            self._close_open(_SAME[tag], _SAME_SCOPE[tag])
        if tag == "body":
            self._close_open({"head"}, set())  # also with an open element in it
        if tag == "a":
            self._close_open({"a"}, _SCOPE)
        if tag in INLINE:
            self._enter(tag, self._open[-1][1])
            self._in_link += tag == "a"
            self.links[self._open[-1][1]] += tag == "a"
            return
        self._end_block()
        values = " ".join(v or "" for k, v in attrs if k in ("class", "id", "role", "itemprop", "aria-label"))
        self.parents.append(self._open[-1][1])
        self.tags.append(tag)
        # A token is read letter by letter groups, in camel case too: "postBody" is post, body.
        spaced = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", values)
        self.tokens.append(_TOKEN.findall(spaced.lower()))
        self.links.append(0)
        self._enter(tag, len(self.tags) - 1)
        self._hidden += tag in HIDDEN

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        # The slash means nothing in HTML; svg, math and what is in them end with it.
        ends = tag in FOREIGN or any(self._count[t] for t in FOREIGN)
        self.handle_starttag(tag, attrs)
        if ends and tag not in VOID and self._open[-1][0] == tag:
            self._pop_to(len(self._open) - 1)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag == "br":
            self._text.append(" ")
        if not self._count[tag]:
            return
        for depth in range(len(self._open) - 1, 0, -1):
            if self._open[depth][0] == tag:
                return self._pop_to(depth)
            if tag in INLINE and self._open[depth][0] not in INLINE:
                return None

    def handle_data(self, data: str) -> None:
        if data.strip():
            self._end_head()
        if not self._hidden:
            self._text.append(data)
            self._linked += len(data) * bool(self._in_link)


TAGS = (
    "body main article section div p h1 h2 h3 h4 ul ol li dl dt dd table tr td th blockquote pre figure figcaption nav header "
    "footer aside form fieldset details address"
).split()
#: What attribute tokens are features: those of the generated layouts.
BODY_TOKENS = "article content main post entry story body text page primary blog news copy paragraph read detail document lead prose".split()
MENU_TOKENS = "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc links toolbar tabs".split()
EDGE_TOKENS = "header masthead topbar banner footer bottom copyright legal colophon brand logo site".split()
SIDE_TOKENS = "sidebar aside side rail widget related recommended recommendations trending popular tags meta share social author bio".split()
NOTICE_TOKENS = "notice cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription paywall message promo".split()
AD_TOKENS = "ad ads advert advertisement adsense advertorial sponsor sponsored sponsors dfp adbox adslot".split()
FORM_TOKENS = "form search login signup signin register contact field input".split()
COMMENT_TOKENS = "comment comments commentlist reply replies respond discussion disqus responses reader readers feedback thread".split()
FAMILIES = [BODY_TOKENS, MENU_TOKENS, EDGE_TOKENS, SIDE_TOKENS, NOTICE_TOKENS, AD_TOKENS, FORM_TOKENS, COMMENT_TOKENS]
_FAMILY = {t: k for k, family in enumerate(FAMILIES) for t in family}
_TAG = {t: k for k, t in enumerate(TAGS)}
_MARKED = {"nav": 1, "menu": 1, "header": 2, "footer": 2, "aside": 3, "form": 6, "fieldset": 6, "dialog": 4, "article": 0, "main": 0}
N_FEATURES = len(TAGS) + 3 * len(FAMILIES) + 14


def features(page: Page) -> np.ndarray:
    """One row per block element."""
    n = len(page.tags)
    parents = page.parents
    text, linked, blocks, nodes, links = (np.zeros(n) for _ in range(5))
    nodes += 1
    links += np.array(page.links)
    for at, content, in_links in page.blocks:
        text[at] += len(content)
        linked[at] += in_links
        blocks[at] += 1
    own = text.copy()
    depth, index, same, children = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    seen: dict[tuple[int, str], int] = {}
    for i in range(1, n):
        depth[i] = depth[parents[i]] + 1
        index[i] = children[parents[i]]
        children[parents[i]] += 1
        seen[parents[i], page.tags[i]] = seen.get((parents[i], page.tags[i]), 0) + 1
    for i in range(n - 1, 0, -1):
        for total in (text, linked, blocks, nodes, links):
            total[parents[i]] += total[i]
    out = np.zeros((n, N_FEATURES), np.float32)
    families = np.zeros((n, len(FAMILIES)), np.float32)
    above = np.zeros((n, len(FAMILIES)), np.float32)
    tagged = np.zeros((n, len(FAMILIES)), np.float32)
    for i in range(n):
        k = _TAG.get(page.tags[i])
        if k is not None:
            out[i, k] = 1
        for token in page.tokens[i]:
            family = _FAMILY.get(token)
            if family is not None:
                families[i, family] = 1
        marked = _MARKED.get(page.tags[i])
        if i:
            above[i] = np.maximum(above[parents[i]], families[parents[i]])
            tagged[i] = tagged[parents[i]]
            if marked is not None:
                # A header in an article belongs to it; elsewhere it is the page's.
                tagged[i, marked] = 1
            same[i] = seen[parents[i], page.tags[i]]
    parent = np.array([0, *parents[1:]])
    siblings = children[parent]
    total = max(1.0, text[0])
    out[:, len(TAGS) : len(TAGS) + 3 * len(FAMILIES)] = np.concatenate([families, above, tagged], axis=1)
    out[:, len(TAGS) + 3 * len(FAMILIES) :] = np.stack([
        depth, np.log1p(text), text / total, linked / np.maximum(text, 1), np.log1p(text / nodes), text / np.maximum(blocks, 1),
        links / np.maximum(text, 1), np.log1p(nodes), np.log1p(children), index, siblings, same,
        text[parent] / np.maximum(siblings, 1), np.log1p(own),
    ], axis=1)
    return out


def _words(r: random.Random, low: int, high: int) -> str:
    words = ["".join(r.choice("aeioulnrst") for _ in range(r.randint(2, 9))) for _ in range(r.randint(low, high))]
    return (" ".join(words)).capitalize() + r.choice([".", ".", "", "!"])


def _attributes(r: random.Random, family: list[str]) -> str:
    if r.random() < 0.1:
        return ""
    name = r.choice(family)
    if r.random() < 0.4:
        name += r.choice(["-", "_", " "]) + r.choice([*family, "box", "inner", "wrap", "area", "list", "item", "container", "block"])
    return f' {r.choice(["class", "class", "id"])}="{name}"'


def _boilerplate(r: random.Random, kind: str) -> str:
    """A subtree to drop; its outermost element says what it is, by tag or token."""

    def list_of(low: int, high: int) -> str:
        tag = r.choice(["ul", "ol", "div"])
        item = "li" if tag != "div" else r.choice(["div", "p"])
        return f"<{tag}>" + "".join(f'<{item}><a href="/x">{_words(r, 1, 4)}</a></{item}>' for _ in range(r.randint(low, high))) + f"</{tag}>"

    def paragraphs(low: int, high: int, words: int) -> str:
        return "".join(f"<p>{_words(r, 2, words)}</p>" for _ in range(r.randint(low, high)))

    plain = r.choice(["div", "div", "section"])
    if kind == "menu":
        tag, body, family = r.choice(["nav", "nav", plain]), list_of(2, 9), MENU_TOKENS
    elif kind == "edge":
        tag, family = r.choice(["header", "footer", plain]), EDGE_TOKENS
        body = r.choice([_words(r, 1, 25), f"<p>{_words(r, 2, 30)}</p>", f"<h1>{_words(r, 1, 4)}</h1>" + list_of(0, 4), "&copy; " + _words(r, 2, 20)])
    elif kind == "side":
        tag, family = r.choice(["aside", "aside", plain]), SIDE_TOKENS
        body = r.choice([f"<h3>{_words(r, 1, 4)}</h3>" + list_of(2, 6), paragraphs(1, 4, 50), f"<h2>{_words(r, 1, 4)}</h2>" + paragraphs(1, 3, 60)])
    elif kind == "notice":
        tag, body, family = plain, r.choice([paragraphs(1, 2, 40), _words(r, 3, 40) + "<button>ok</button>"]), NOTICE_TOKENS
    elif kind == "ad":
        tag, body, family = r.choice([plain, "aside"]), r.choice([_words(r, 2, 40), paragraphs(1, 2, 40), f'<a href="/x">{_words(r, 2, 12)}</a>']), AD_TOKENS
    elif kind == "form":
        fields = "".join(f"<p><label>{_words(r, 1, 4)}</label><input></p>" for _ in range(r.randint(1, 4)))
        tag, body, family = r.choice(["form", "form", plain]), f"<h3>{_words(r, 1, 5)}</h3>{fields}" * r.randint(0, 1) + f"<label>{_words(r, 1, 6)}</label><input>" + paragraphs(0, 1, 20), FORM_TOKENS
    else:
        one = r.choice(["div", "li", "article", "section"])
        body = f"<h2>{_words(r, 1, 3)}</h2>" * r.randint(0, 1) + "".join(
            f"<{one}{_attributes(r, COMMENT_TOKENS) if r.random() < 0.6 else ''}>" + f"<h4>{_words(r, 1, 3)}</h4>" * r.randint(0, 1) + paragraphs(1, 3, 90) + f"</{one}>"
            for _ in range(r.randint(1, 6))
        )
        tag, family = r.choice(["section", "div", "div", "ol"]), COMMENT_TOKENS
    attributes = _attributes(r, family)
    if tag in ("div", "section", "ol") and not attributes:
        attributes = f' class="{r.choice(family)}"'
    return f'<{tag} data-drop="1"{attributes}>{body}</{tag}>'


KINDS = ["menu", "edge", "side", "notice", "ad", "form", "comment"]


def layouts(pages: int, seed: int) -> Iterator[str]:
    """Pages of many layouts; elements that start a subtree to drop have the attribute data-drop."""
    for number in range(pages):
        r = random.Random(seed * 1_000_003 + number)

        def some(kinds: list[str], chance: float, r=r) -> str:
            return "".join(_boilerplate(r, k) for k in kinds if r.random() < chance)

        def block(r=r) -> str:
            kind = r.random()
            if kind < 0.68:
                return f"<p>{_words(r, 1, 120)}" + r.choice(["</p>", "</p>", "</p>", ""])
            if kind < 0.78:
                return f"<h{(k := r.randint(2, 4))}>{_words(r, 1, 8)}</h{k}>"
            if kind < 0.85:
                return "<ul>" + "".join(f"<li>{_words(r, 2, 20)}</li>" for _ in range(r.randint(1, 5))) + "</ul>"
            if kind < 0.9:
                return f"<blockquote><p>{_words(r, 4, 60)}</p></blockquote>"
            if kind < 0.94:
                return f"<table><tr><td>{_words(r, 1, 5)}</td><td>{_words(r, 1, 5)}</td></tr></table>"
            if kind < 0.97:
                return f"<pre>{_words(r, 3, 30)}</pre>"
            return f'<p>{_words(r, 2, 30)} <a href="/x">{_words(r, 1, 5)}</a></p>'

        title = f"<h1>{_words(r, 2, 12)}</h1>" if r.random() < 0.8 else ""
        title = f"<header>{title}</header>" if title and r.random() < 0.15 else title
        inside = [block() for _ in range(r.choice([1, 1, 2, 3, 5, 8, 14, 30]))]
        for kind in KINDS[2:]:
            if r.random() < 0.12:
                inside.insert(r.randint(0, len(inside)), _boilerplate(r, kind))
        body = title + "".join(inside)
        shape = r.random()
        if shape < 0.45:
            body = f"<article{_attributes(r, BODY_TOKENS) if r.random() < 0.4 else ''}>{body}</article>"
        elif shape < 0.6:
            body = f"<main>{body}</main>"
        elif shape < 0.9:
            body = f'<div class="{r.choice(BODY_TOKENS)}">{body}</div>'
        if r.random() < 0.4:
            around = some(["side", "ad"], 0.4)
            body = f'<div class="{r.choice(["container", "wrapper", "row", "layout", "page"])}">' + (body + around if r.random() < 0.6 else around + body) + "</div>"
        before = some(["menu", "edge", "menu", "notice", "ad", "form"], 0.45)
        after = some(["comment", "side", "ad", "notice", "form", "menu", "edge"], 0.4)
        yield f"<html><head><title>x</title></head><body>{before}{body}{after}</body></html>"


class _Labelled(Page):
    """A generated page, with what each block element was made as."""

    def __init__(self, html: str):
        self.dropped = [False]
        super().__init__(html)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        known = len(self.tags)
        super().handle_starttag(tag, attrs)
        if len(self.tags) > known:
            self.dropped.append(self.dropped[self.parents[-1]] or ("data-drop", "1") in attrs)


TRAIN_PAGES, SEED = 600, 11
TREES, LEVELS, RATE, BINS, LEAST = 30, 4, 0.4, 32, 8


class Trees:
    """Gradient-boosted trees of one depth on binned features, logistic loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        every = np.linspace(0, 1, BINS + 1)[1:-1]
        self.cuts = [np.unique(np.quantile(x[:, k], every)) for k in range(x.shape[1])]
        binned = self._binned(x)
        offsets = np.arange(x.shape[1]) * BINS
        self.base = float(np.log(y.mean() / (1 - y.mean())))
        self.splits: list[tuple[np.ndarray, np.ndarray]] = []
        self.leaves: list[np.ndarray] = []
        score = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            gradient, weight = y - p, p * (1 - p)
            node = np.zeros(len(y), np.int64)
            feature, cut = np.zeros(2**LEVELS - 1, np.int64), np.full(2**LEVELS - 1, BINS)
            for level in range(LEVELS):
                for at in range(2**level - 1, 2 ** (level + 1) - 1):
                    rows = np.flatnonzero(node == at)
                    if len(rows) < 2 * LEAST:
                        continue
                    slot = (binned[rows] + offsets).ravel()
                    size = x.shape[1] * BINS
                    many = [
                        np.bincount(slot, np.repeat(v[rows], x.shape[1]), size).reshape(-1, BINS).cumsum(axis=1)
                        for v in (gradient, weight, np.ones(len(y)))
                    ]
                    g, h, c = (m[:, :-1] for m in many)
                    all_g, all_h, all_c = (m[0, -1] for m in many)
                    gain = g**2 / (h + 1) + (all_g - g) ** 2 / (all_h - h + 1) - all_g**2 / (all_h + 1)
                    gain[(c < LEAST) | (all_c - c < LEAST)] = 0
                    best = int(gain.argmax())
                    if gain.flat[best] > 1e-6:
                        feature[at], cut[at] = divmod(best, BINS - 1)
                node = 2 * node + 1 + (binned[np.arange(len(y)), feature[node]] > cut[node])
            leaf = node - (2**LEVELS - 1)
            sums = [np.bincount(leaf, v, 2**LEVELS) for v in (gradient, weight)]
            value = RATE * sums[0] / (sums[1] + 1)
            score += value[leaf]
            self.splits.append((feature, cut))
            self.leaves.append(value)

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(self.cuts)], axis=1)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        binned, score, every = self._binned(x), np.full(len(x), self.base), np.arange(len(x))
        for (feature, cut), value in zip(self.splits, self.leaves):
            node = np.zeros(len(x), np.int64)
            for _ in range(LEVELS):
                node = 2 * node + 1 + (binned[every, feature[node]] > cut[node])
            score += value[node - (2**LEVELS - 1)]
        return score


@lru_cache(maxsize=1)
def trained() -> Trees:
    pages = [_Labelled(html) for html in layouts(TRAIN_PAGES, SEED)]
    x = np.concatenate([features(p) for p in pages])
    return Trees(x, np.concatenate([~np.array(p.dropped) for p in pages]).astype(np.float64))


def kept_nodes(parents: list[int], log_odds: np.ndarray) -> np.ndarray:
    """The likeliest labelling in which a kept node has a kept parent; the root is kept."""
    keep, drop = -np.logaddexp(0, -log_odds), -np.logaddexp(0, log_odds)
    keep_best, drop_all = keep.copy(), drop.copy()
    for i in range(len(parents) - 1, 0, -1):
        keep_best[parents[i]] += max(keep_best[i], drop_all[i])
        drop_all[parents[i]] += drop_all[i]
    kept = np.ones(len(parents), bool)
    for i in range(1, len(parents)):
        kept[i] = kept[parents[i]] and keep_best[i] >= drop_all[i]
    return kept


def main_texts(pages: list[str], trees: Trees) -> list[str]:
    parsed = [Page(html) for html in pages]
    if not parsed:
        return []
    odds = trees.log_odds(np.concatenate([features(p) for p in parsed]))
    out, at = [], 0
    for page in parsed:
        kept = kept_nodes(page.parents, odds[at : at + len(page.tags)])
        at += len(page.tags)
        out.append("\n\n".join(text for node, text, _ in page.blocks if kept[node]))
    return out


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    spark = pages.sparkSession
    small_batches(spark, rows=500)
    trees = spark.sparkContext.broadcast(trained())

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = main_texts([h or "" for h in batch.column(2).to_pylist()], trees.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(extract, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
