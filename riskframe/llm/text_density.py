"""Main text of HTML pages by composite text density.

A page becomes a tree of elements. Elements that are never article text (by tag, role, class or
id, or hidden) are left out. A class, id or role counts if its first or last word is boilerplate and
none says that something is there or not (``has-sidebar``, ``no-comments``). Headings and paragraphs
are never left out by name, nor are sections, or parts of an article, by an id that may be a topic's
anchor. A form or named element stays if it holds most of the body's characters outside links and no
``article`` or ``main`` with text lies outside it, nor an ``h1`` if it is named after readers' comments.
For every other node the composite density is

    C / T * log(C / LC * T / LT) / log(ln(C / (C - LC) * LC + LCb / Cb * C + e))

with C characters, T tags, LC link characters, LT link tags below it (1 where a divisor is 0) and
the body's LCb, Cb: characters per tag, less the more of them are links. The node with the largest
sum of its children's densities holds the article. The smallest density on the path from it to the
body is the threshold: headings and text blocks beside that path join the article from it upwards.
Where the node lies in an ``article`` or ``main`` element, that element is the article. Lists of links
in it are menus and go, unless their heading names them as references. Formulas are part of their line.

Text: character references decoded, white space in a block turned into one space, trimmed, blocks
joined in page order by a line feed. ``br`` is white space.

Defined cases: null, empty and text-free pages give the empty text; markup that is broken, cut off
or unclosed is read as far as it goes; ties go to the first node; repeated rows are rows of their
own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import small_batches

# HTML vocabulary.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("script style noscript template iframe object svg annotation canvas audio video map button select textarea input label fieldset nav aside footer menu dialog head title frameset noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
                   "math semantics annotation mrow mi mn mo ms mtext mspace mfrac msqrt mroot msup msub msubsup mover munder munderover mfenced menclose mpadded mstyle mmultiscripts mtable mtr mtd".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset figure figcaption footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SIBLING_TEXT = HEADINGS | frozenset("p blockquote pre ul ol dl table figure section".split())
IMPLIED_END = {"li": ("li", frozenset(("ul", "ol", "menu"))), "dt": ("dt dd", frozenset(("dl",))), "dd": ("dt dd", frozenset(("dl",))), "tr": ("tr td th", frozenset(("table",))),
               "td": ("td th", frozenset(("tr", "table"))), "th": ("td th", frozenset(("tr", "table"))), "option": ("option", frozenset(("select",)))}
BOILERPLATE = frozenset((
    "ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion promoted banner sidebar sidenav menu navbar nav navigation breadcrumb breadcrumbs masthead "
    "footer topbar toolbar cookie cookies consent gdpr notice notices notification alert popup modal overlay paywall newsletter subscribe subscription signup login comment comments commentlist "
    "respond disqus discussion replies reply share sharing social related recommended recommendations widget widgets pagination pager skip copyright legal disclaimer search searchbox "
    "complementary contentinfo search form").split())
REPLIES = frozenset("comment comments commentlist respond disqus discussion replies reply".split())
STATES = frozenset("has have no not non without with is show hide hidden allow enable enabled disable disabled".split())
# As an id these may name a topic of the text; as whole values the others hardly do.
TOPICS = frozenset("discussion related legal notice notices disclaimer copyright search share sharing social promotion banner menu navigation alert notification subscription consent cookies recommendations recommended reply replies form skip widgets advertising advertisement gdpr".split())
# Headings of reference lists.
REFERENCES = frozenset("references reference sources bibliography citations cited footnotes endnotes quellen literatur literaturverzeichnis einzelnachweise nachweise références bibliographie referencias fuentes bibliografía".split())
_WORD = re.compile(r"\w+")
_TOKEN = re.compile(r"[a-z0-9]+")
_SPACE = re.compile(r"\s+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class _Tree(HTMLParser):
    """Elements and texts as flat lists: parent, tag, dropped flag, boilerplate words; texts carry their node and order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.dropped, self.named, self.items = ["#page"], [-1], [False], [frozenset()], []
        self.stack = [0]

    def _open(self, tag, attrs):
        up = self.stack[-1]
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(up)
        self.dropped.append(self.dropped[up] or self._never(tag, attrs))
        self.named.append(frozenset() if self.dropped[node] else self._names(tag, attrs))
        self.items.append((node, None))
        return node

    def _never(self, tag, attrs):
        if tag in NEVER:
            return True
        if tag in ("html", "body", "#page"):
            return False
        if tag == "header":  # a page's header goes; an article's own keeps its headings (see article_text)
            return not any(self.tag[n] in ("article", "main") for n in self.stack)
        for key, value in attrs:
            if key == "hidden" or key == "style" and value and _HIDDEN.search(value) or key == "aria-hidden" and value == "true":
                return True
        return False

    def _names(self, tag, attrs):
        """The boilerplate words by which an element goes, unless it holds most of the page (see article_text)."""
        if tag == "form":
            return frozenset(("form",))
        if tag in ("html", "body", "header", "p") or tag in HEADINGS:
            return frozenset()
        anchors = tag == "section" or any(self.tag[n] in ("article", "main") for n in self.stack)
        hit = set()
        for key, value in attrs:
            if not value or key not in ("class", "id", "role"):
                continue
            for name in value.lower().split():
                words = _TOKEN.findall(name)
                if not words or STATES.intersection(words):
                    continue
                if key == "id" and anchors:
                    hit.update(BOILERPLATE.difference(TOPICS).intersection(words) if BOILERPLATE.issuperset(words) else ())
                else:
                    hit.update(BOILERPLATE.intersection((words[0], words[-1])))
        if tag in ("article", "main"):
            hit &= {"comment", "comments", "ad", "ads", "advert", "related", "promo", "sponsored"}
        return frozenset(hit)

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body") and tag in (self.tag[n] for n in self.stack):
            return
        if tag in CLOSES_P:
            self._close("p", frozenset(("article", "section", "div", "td", "th", "li", "body", "table", "button")))
        if tag in IMPLIED_END:
            ends, scope = IMPLIED_END[tag]
            for e in ends.split():
                self._close(e, scope)
        node = self._open(tag, attrs)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.tag[self.stack[-1]] == tag and tag not in ("p", "div", "span", "a", "b", "i", "script", "style"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._close(tag, frozenset() if tag not in INLINE else frozenset(("td", "th", "table", "article", "section", "div", "body")))

    def _close(self, tag, scope):
        for at in range(len(self.stack) - 1, 0, -1):
            name = self.tag[self.stack[at]]
            if name == tag:
                del self.stack[at:]
                if tag not in INLINE:
                    self.items.append((self.stack[-1], None))
                return
            if name in scope:
                return

    def handle_data(self, data):
        node = self.stack[-1]
        if not self.dropped[node]:
            self.items.append((node, data))


def _drop_named(tree: _Tree) -> None:
    """Drop the elements named as boilerplate, but for those which hold most of the page."""
    tag, parent, n = tree.tag, tree.parent, len(tree.tag)
    if any(tree.named):
        in_link, plain, homes, titles = [False] * n, [0] * n, [0] * n, [0] * n
        for i in range(1, n):
            in_link[i] = in_link[parent[i]] or tag[i] == "a"
        for node, text in tree.items:
            if text is not None and not in_link[node]:
                plain[node] += len(_SPACE.sub("", text))
        for i in range(n - 1, 0, -1):
            homes[i] += plain[i] > 0 and tag[i] in ("article", "main")
            titles[i] += plain[i] > 0 and tag[i] == "h1"
            for count in (plain, homes, titles):
                count[parent[i]] += count[i]
        for i in range(1, n):
            most = 2 * plain[i] > plain[0] and homes[i] == homes[0] and (titles[i] == titles[0] or not tree.named[i] & REPLIES)
            tree.dropped[i] = tree.dropped[i] or tree.dropped[parent[i]] or bool(tree.named[i]) and not most


def _lists_references(tree: _Tree, heading: int) -> bool:
    end = next((i for i in range(heading + 1, len(tree.tag)) if tree.parent[i] < heading), len(tree.tag))
    title = " ".join(text for node, text in tree.items if text is not None and heading <= node < end)
    return not REFERENCES.isdisjoint(_WORD.findall(title.lower()))


def article_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    tag, parent, dropped, n = tree.tag, tree.parent, tree.dropped, len(tree.tag)
    _drop_named(tree)
    in_link, in_header = [False] * n, [False] * n
    for i in range(1, n):
        in_link[i] = in_link[parent[i]] or tag[i] == "a"
        in_header[i] = (in_header[parent[i]] or tag[i] == "header") and tag[i] not in HEADINGS
    chars, link_chars, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for node, text in tree.items:
        if text is not None and not in_header[node] and not dropped[node]:
            size = len(_SPACE.sub("", text))
            chars[node] += size
            link_chars[node] += size * in_link[node]
    for i in range(n - 1, 0, -1):
        up = parent[i]
        if dropped[i]:
            continue
        chars[up] += chars[i]
        link_chars[up] += link_chars[i]
        tags[up] += tags[i] + 1
        link_tags[up] += link_tags[i] + (tag[i] == "a")
    body = next((i for i in range(n) if tag[i] == "body"), 0)
    if not chars[body]:
        body = 0
    if not chars[body]:
        return ""
    share = link_chars[body] / chars[body]
    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if dropped[i] or not chars[i]:
            continue
        c, t, lc, lt = chars[i], tags[i] or 1, link_chars[i], link_tags[i]
        base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
        density[i] = c / t * math.log(max(1.0, c / (lc or 1) * t / (lt or 1))) / math.log(base + 1e-9) if base > 1 + 1e-9 else c / t * math.log(max(1.0, c / (lc or 1) * t / (lt or 1)))
        if i:
            total[parent[i]] += density[i]
    below = [False] * n
    for i in range(body, n):
        below[i] = i == body or (parent[i] >= 0 and below[parent[i]])
    best = max((i for i in range(n) if below[i] and not dropped[i]), key=lambda i: (total[i], -i))
    if not total[best]:
        best = body
    path, at = [], best
    while at > body:
        path.append(at)
        at = parent[at]
    threshold = min((density[i] for i in [*path, body]), default=0.0)
    keep = [False] * n
    home = next((i for i in path if tag[i] in ("article", "main")), None)
    if home is not None:
        keep[home] = True
    else:
        keep[best] = True
        on_path = {*path, body}
        for i in range(n):
            if not dropped[i] and parent[i] in on_path and i not in on_path and parent[i] != best and tag[i] in SIBLING_TEXT and density[i] >= threshold > 0:
                keep[i] = True
    last: dict[int, int] = {}  # the element before, of the same parent
    for i in range(1, n):
        before, last[parent[i]] = last.get(parent[i]), i
        keep[i] = (keep[i] or keep[parent[i]]) and not dropped[i]
        if keep[i] and tag[i] in ("ul", "ol", "div", "section") and link_tags[i] >= 3 and link_chars[i] >= 0.8 * chars[i]:
            # A list of links inside the article is a menu, unless a heading says that it is the article's references.
            keep[i] = tag[i] in ("ul", "ol") and before is not None and keep[before] and tag[before] in HEADINGS and _lists_references(tree, before)
    blocks, open_block = [], []

    def flush():
        line = _SPACE.sub(" ", "".join(open_block)).strip()
        if line:
            blocks.append(line)
        open_block.clear()

    for node, text in tree.items:
        if text is None:
            if tag[node] == "br":
                open_block.append(" ")
            elif tag[node] not in INLINE:
                flush()
        elif keep[node] and not in_header[node]:
            open_block.append(text)
    flush()
    return "\n".join(blocks)


def main_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    small_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def extract(html: pd.Series) -> pd.Series:
        return html.map(article_text, na_action=None)

    return pages.select("page_id", "url", extract("html").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
