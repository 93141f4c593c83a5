"""Main text of web pages by tree scoring (operator 7).

Paragraphs pass points for their length and commas to their ancestors, less
with each level; a container's points are discounted by its link density. The
best container and those of its siblings that look like parts of the article
are kept. Parts that are never article text (menus, page headers, footers,
sidebars, notices, adverts, forms, scripts, reader comments) are cut first, by
element and by the words in their class, id and role.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigcast.llm.common import small_batches, table
from rigcast.llm.textnum import chunks

_MARKUP = re.compile(r"""<(?:!--.*?(?:--!?>|\Z)|(/?)([a-zA-Z][^\s/>]*+)((?>[^>"']+|"[^"]*"|'[^']*')*+)>|[!?/][^>]*(?:>|\Z))""", re.S)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)()[^>]*(?:>|\Z)")
_ATTR = re.compile(r"""(class|id|role|style|hidden|aria-hidden|itemprop)(?![\w-])\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "noembed", "noframes", "xmp"}
CUT = {"nav", "footer", "aside", "form", "button", "select", "input", "svg", "object", "embed", "canvas", "audio", "video",
       "head", "menu", "dialog", "fieldset", "option", "datalist", "map"} | RAW
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset",
         "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li",
         "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "caption"}
PARAGRAPH = {"p", "pre", "blockquote", "td", "dd", "li", "figcaption"}
CONTAINER = {"article": 25, "main": 20, "section": 5, "div": 5, "td": 3, "blockquote": 2, "body": 0}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
FENCE = {"ul", "ol", "table", "dl", "div", "section", "article", "select", "body", "html"}

COMMENT = {"comment", "comments", "disqus", "replies", "respond", "discussion"}
UNLIKELY = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "adbox", "sponsor", "sponsored", "sponsors",
            "promo", "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "popup", "modal", "overlay", "newsletter",
            "subscribe", "subscription", "signup", "login", "share", "sharing", "social", "related", "recommended",
            "recommendations", "sidebar", "widget", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "pagination",
            "pager", "footer", "masthead", "topbar", "notice", "notices", "alert", "toolbar", "search", "contentinfo",
            "complementary", "skip", "copyright", "outbrain", "taboola"} | COMMENT
LIKELY = {"article", "body", "content", "entry", "main", "post", "story", "text"}
# A name says what its element is by its last word, or by its first where the last only says "box"
BOX = {"area", "bar", "block", "body", "box", "container", "content", "form", "group", "header", "heading", "holder", "icons", "inner",
       "item", "items", "label", "layer", "link", "links", "list", "message", "messages", "module", "outer", "panel", "posts", "row",
       "section", "slot", "text", "thread", "title", "unit", "wrap", "wrapper", "zone", "articles", "stories", "card", "cards", "to"}
# A first word that files its element or tells its state
ABOUT = {"category", "tag", "topic", "subject", "author", "format", "type", "status", "has", "no", "not", "with", "without", "is"}
NO_CUT, HARD, HIDDEN, SOFT, READERS = range(5)
LEVELS = 16           # ancestors that a paragraph passes points to; the next would get a forty-eighth


def named(value: str) -> tuple[int, bool]:
    """What the names in a class, id or role say: a kind of cut, and whether it looks like the article."""
    kind, likely = NO_CUT, False
    for name in value.split():
        words = [w.lower() for w in _TOKEN.findall(name)]
        words = [w for w in words if not w.isdigit()]
        if not words:
            continue
        if LIKELY.intersection(words):
            likely = True
        if words[0] in ABOUT:
            continue
        head = words[-1] if words[-1] in UNLIKELY else words[0] if all(w in BOX or w in UNLIKELY for w in words[1:]) else None
        if head in COMMENT:
            kind = READERS
        elif head in UNLIKELY:
            kind = max(kind, SOFT)
    return kind, likely


class Page:
    """Flat tree of a page; element 0 is the root."""

    def __init__(self, source: str):
        self.tag, self.parent, self.cut, self.own = ["#root"], [-1], [NO_CUT], [0]
        self.texts: list[tuple[int, str | None]] = []       # (element, text); None is a block boundary
        self.stack: list[int] = [0]
        self.open: dict[str, list[int]] = {}                # places in the stack by tag
        self.walls: list[int] = [-1]                        # places of open blocks other than p
        self._parse(source)

    def _parse(self, s: str) -> None:
        at, n = 0, len(s)
        while at < n:
            lt = s.find("<", at)
            if lt < 0:
                self._text(s[at:])
                break
            m = _MARKUP.match(s, lt) or _LOOSE.match(s, lt)
            if m is None:                                    # a "<" that opens nothing is text
                self._text(s[at:lt + 1])
                at = lt + 1
                continue
            if lt > at:
                self._text(s[at:lt])
            at = m.end()
            name = m.group(2)
            if name is None:
                continue
            name = name.lower()
            if m.group(1):
                self._close(name)
            else:
                at = self._open(name, m.group(3) or "", s, at)

    def _text(self, raw: str) -> None:
        self.texts.append((self.stack[-1], html.unescape(raw) if "&" in raw else raw))

    def _top(self, names) -> int:
        """The highest place of an open element of these names (-1: none)."""
        return max((self.open[t][-1] for t in names if self.open.get(t)), default=-1)

    def _push(self, name: str, e: int) -> None:
        place = len(self.stack)
        self.open.setdefault(name, []).append(place)
        if name in BLOCK and name != "p":
            self.walls.append(place)
        self.stack.append(e)

    def _pop_to(self, place: int) -> None:
        while len(self.stack) > place:
            self.open[self.tag[self.stack.pop()]].pop()
            if self.walls[-1] == len(self.stack):
                self.walls.pop()

    def _open(self, name: str, attrs: str, s: str, at: int) -> int:
        if name in BLOCK:
            self._close("p", quiet=True)
            self.texts.append((self.stack[-1], None))
        if name in CLOSES:
            place = self._top(CLOSES[name])
            fence = FENCE - {"div", "section"} if name in ("td", "th", "tr", "tbody") else FENCE
            if place > self._top(fence):
                self._pop_to(place)
        cut, likely = HARD if name in CUT else NO_CUT, 0
        if attrs:
            found, likely = self._attributes(attrs)
            if cut == NO_CUT and name not in ("html", "body", "main"):
                cut = found
        if name == "header" and not self.open.get("article"):
            cut = HARD
        e = len(self.tag)
        self.tag.append(name)
        self.parent.append(self.stack[-1])
        self.cut.append(cut)
        self.own.append(likely)
        if name in RAW:
            m = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(s, at)
            return m.end() if m else len(s)
        if name == "br":
            self.texts.append((e, " "))
        if name not in VOID and not attrs.endswith("/") or name in BLOCK and name not in VOID:
            self._push(name, e)
        return at

    @staticmethod
    def _attributes(attrs: str) -> tuple[int, int]:
        cut, likely = NO_CUT, 0
        for m in _ATTR.finditer(attrs):
            key, value = m.group(1).lower(), next((v for v in m.groups()[1:] if v is not None), "")
            if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                cut = max(cut, HIDDEN)
            elif key == "style":
                if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    cut = max(cut, HIDDEN)
            elif key in ("class", "id", "role", "itemprop"):
                kind, good = named(value)
                cut = max(cut, kind)
                likely = 25 if good else likely
        return cut, likely

    def _close(self, name: str, quiet: bool = False) -> None:
        places = self.open.get(name)
        if not places or (quiet or name not in BLOCK) and places[-1] < self.walls[-1]:
            return
        if name in BLOCK:
            self.texts.append((self.stack[places[-1]], None))
        self._pop_to(places[-1])

    # ------------------------------------------------------------- scoring

    def _under(self, gone: list[bool]) -> None:
        """Text length, commas and text in links below every element that is not gone."""
        n = len(self.tag)
        self.length, self.commas, self.links = [0] * n, [0] * n, [0] * n
        self.direct = [0] * n                                # texts standing directly in a block
        for e, t in self.texts:
            if t is None or gone[e]:
                continue
            size = len(" ".join(t.split()))
            if size:
                self.length[e] += size
                self.commas[e] += t.count(",") + t.count("、") + t.count("，")
                self.direct[self.block[e]] += 1
        for e in range(n - 1, 0, -1):
            if self.tag[e] == "a":
                self.links[e] = self.length[e]
            p = self.parent[e]
            self.length[p] += self.length[e]
            self.links[p] += self.links[e]
            self.commas[p] += self.commas[e]

    def _worth(self, e: int) -> float:
        """Points of a paragraph (0: not one). Text directly in a container makes it a paragraph of its own."""
        if not self.length[e] or not (self.tag[e] in PARAGRAPH or self.direct[e] and self.tag[e] not in (
                "h1", "h2", "h3", "h4", "h5", "h6", "body", "html", "#root")):
            return 0.0
        return (1 + self.commas[e] + min(self.length[e] / 100, 3)) * (1 - self.links[e] / self.length[e])

    def _gone(self) -> list[bool]:
        """Elements that are cut. A cut around the article itself (a wrapper named
        after its sidebar, say) does not count, nor does one by name alone of the
        element that holds most of the paragraph points."""
        n = len(self.tag)
        holds = [False] * n
        for e in range(n - 1, 0, -1):
            if self.tag[e] in ("article", "main") and self.cut[e] == NO_CUT:
                holds[e] = True
            if holds[e]:
                holds[self.parent[e]] = True
        most = [False] * n
        if SOFT in self.cut:
            hard = [False] * n
            for e in range(1, n):
                hard[e] = hard[self.parent[e]] or self.cut[e] == HARD or self.cut[e] in (HIDDEN, READERS) and not holds[e]
            self._under(hard)
            points = [0.0 if hard[e] else self._worth(e) for e in range(n)]
            for e in range(n - 1, 0, -1):
                points[self.parent[e]] += points[e]
            most = [p > points[0] / 2 for p in points]
        gone = [False] * n
        for e in range(1, n):
            kind = self.cut[e]
            gone[e] = gone[self.parent[e]] or kind == HARD or kind in (HIDDEN, READERS) and not holds[e] \
                or kind == SOFT and not holds[e] and not most[e]
        return gone

    def main_text(self) -> str:
        n = len(self.tag)
        self.block = [0] * n                                 # the block that an element stands in, itself included
        for e in range(1, n):
            self.block[e] = e if self.tag[e] in BLOCK else self.block[self.parent[e]]
        gone = self._gone()
        self._under(gone)
        length, links = self.length, self.links
        points = [0.0] * n
        touched = [False] * n
        for e in range(1, n):
            worth = 0.0 if gone[e] else self._worth(e)
            if gone[e] or not length[e] or not (self.tag[e] in PARAGRAPH or self.direct[e] and self.tag[e] not in (
                    "h1", "h2", "h3", "h4", "h5", "h6", "body", "html")):
                continue
            up, level = self.parent[e] if self.tag[e] in PARAGRAPH else e, 0
            while up >= 0 and level < LEVELS:
                points[up] += worth / (1 if level == 0 else 2 if level == 1 else 3 * level)
                touched[up] = True
                up, level = self.parent[up], level + 1
        best, top = 0, -1.0
        for e in range(n):
            if touched[e] and not gone[e] and self.tag[e] not in ("p", "ul", "ol", "tr", "table", "html", "#root"):
                points[e] += CONTAINER.get(self.tag[e], 0) + self.own[e]
                points[e] *= 1 - links[e] / max(length[e], 1)
                if points[e] > top:
                    best, top = e, points[e]
        keep = {best}
        home = best
        while home > 0 and self.tag[home] not in ("article", "main"):
            home = self.parent[home]
        if home > 0:
            best = home
            keep = {home}
        elif best > 0:
            for e in range(1, n):
                if self.parent[e] == self.parent[best] and not gone[e] and length[e]:
                    density = links[e] / length[e]
                    if points[e] >= max(5.0, 0.2 * top) or self.tag[e] in ("p", "h1", "h2", "h3") and density < 0.25:
                        keep.add(e)
        inside = [False] * n
        for e in range(n):
            inside[e] = e in keep or e > 0 and inside[self.parent[e]]
        blocks, now = [], []
        for e, t in self.texts:
            if t is None:
                if now:
                    blocks.append("".join(now))
                    now = []
            elif inside[e] and not gone[e]:
                now.append(t)
        if now:
            blocks.append("".join(now))
        return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def main_text(source: str | None) -> str:
    return Page(source).main_text() if source else ""


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``.

    Null and empty pages, and pages without any text, give the empty text.
    Character references are decoded; white space inside a block becomes one
    space and ends are trimmed; blocks follow in page order with one line feed
    between them. Null ids and urls and repeated rows stay; extra columns are
    ignored; pages are read whole and need not be well-formed.
    """
    small_batches(pages.sparkSession)

    def run(batches):
        for b in chunks(batches, "html"):
            text = [main_text(h) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(text, pa.string()),
                                              pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html")) \
        .mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op7_html_extraction(spark, sf_dir):
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
