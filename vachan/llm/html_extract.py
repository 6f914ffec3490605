"""Main text of web pages by tag-path ratios (op 4).

A page is cut into blocks of text, each with its root-to-leaf tag path (names of
elements with their first class or id, which here only tells paths apart).

1. Per path, text length, punctuation and link text of its blocks are aggregated
   and give a ratio: how much running text a node of this path holds.  A path
   with mostly links has ratio 0.
2. Ratios are smoothed: every prefix of a path has the ratio of all that is below
   it, weighed by text.
3. Both are fused: a path has the best of its own ratio and its containers'
   smoothed ones, which weigh less with distance (``NEAR`` a level, ``FAR`` at
   least), times the share of the page's text that its part of the page holds
   (to the power ``MASS``; parts are what structural elements divide a page into).
4. Names are a prior.  A path through an element that is boilerplate by name, role
   or class words counts ``BOILER`` times, one inside article or main counts more
   the more of the text that element holds (``INSIDE``).
5. Paths below ``THRESHOLD`` of the best are dropped, with all their blocks.

White space inside a block becomes one space, blocks are joined by one space
in page order.  A page is one row's work, linear in its length: labels of a path
are cut in the middle beyond ``LABELS``, elements are all kept.

Defined results: null or empty html gives an empty text, as does a page that has
nothing but elements that are boilerplate by name; a page without an end,
unclosed tags and cut-off character references are read as browsers read
them; rows that repeat an id are extracted each; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import html as htmllib
import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vachan.llm.common import modest_batches

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*+)(?:>|\Z)|<[!?][^>]*+(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
PUNCTUATION = re.compile(r"[.,;:!?…。、，！？]")

# Names of elements and of classes.
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "canvas", "object", "audio", "video", "select", "title", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt",
          "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "nobr"}
CLOSES_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
            "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}
SIBLING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
DROP_NAMES = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "fieldset", "head"}
DROP_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar", "status"}
DROP_WORDS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent",
              "cookie", "cookies", "copyright", "disqus", "footer", "foot", "gdpr", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
              "notification", "pagination", "pager", "popup", "promo", "promotion", "recommended", "related", "replies", "reply", "respond", "share", "sharing", "sidebar",
              "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "widget", "widgets", "disclaimer", "alert", "login", "search"}
TOP_WORDS = {"header"}
MODIFIERS = {"has", "with", "without", "no", "is", "js"}
CONTENT_NAMES = {"article", "main"}
STRUCTURE = {"div", "section", "table", "td", "center", "article", "main", "aside", "header", "footer", "nav", "form", "fieldset"}
# End of fixed values.

LINK_SHARE = 0.6  # a path with more of its text in links is a menu
THRESHOLD = 0.25  # share of the best fused ratio
NEAR, FAR = 0.9, 0.6  # what a container's ratio is worth a level below it, and at least
MASS = 0.3
BOILER = 0.02
INSIDE = 60.0  # an article that holds all of the text counts 1 + INSIDE times, half of it 1 + INSIDE / 4
LABELS = 32  # names kept at either end of a path


@dataclass(slots=True)
class Node:
    name: str
    label: str
    drop: bool
    content: bool  # inside an article or main element


@dataclass(slots=True)
class Block:
    path: tuple[str, ...]
    drop: bool
    content: bool
    text: list[str] = field(default_factory=list)
    linked: int = 0


def node(name: str, attrs: str, parent: Node | None) -> Node:
    drop = name in DROP_NAMES or (parent is not None and parent.drop)
    inside = parent is not None and parent.content
    words: set[str] = set()
    role = first = ""
    if attrs and not attrs.isspace():
        for m in ATTRIBUTE.finditer(attrs):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key in ("class", "id"):
                first = first or value.split(None, 1)[0] if value.strip() else first
                for token in value.split():
                    parts = [w.lower() for w in WORD.findall(token)]
                    if parts and parts[0] not in MODIFIERS:  # has-sidebar says what stands beside the element
                        words.update(parts)
            elif key == "role":
                role = value.lower()
            elif key == "hidden" and value in ("", "hidden") or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                drop = True
    is_content = name in CONTENT_NAMES or role in CONTENT_NAMES
    if name not in ("html", "body") and not is_content:
        if words & DROP_WORDS or role in DROP_ROLES:
            drop = True
        if not inside and (name == "header" or words & TOP_WORDS):
            drop = True
    elif is_content and parent is not None and parent.content and words & DROP_WORDS:
        drop = True  # an article inside the article: a comment
    return Node(name, f"{name}.{first}" if first else name, drop, inside or is_content)


def path(stack: list[Node]) -> tuple[str, ...]:
    """Labels from the root to the innermost block element; of a very deep path those at its ends."""
    ends = stack if len(stack) <= 4 * LABELS else [*stack[:2 * LABELS], *stack[-2 * LABELS:]]
    names = [n.label for n in ends if n.name not in INLINE and n.name not in ("html", "body")]
    return tuple(names if len(names) <= 2 * LABELS else [*names[:LABELS], *names[-LABELS:]])


def blocks(page: str) -> list[Block]:
    """Blocks of text in page order, with their paths."""
    out: list[Block] = []
    stack: list[Node] = []
    opened: Counter[str] = Counter()  # names on the stack
    fresh = True

    def text(s: str) -> None:
        nonlocal fresh
        if not s:
            return
        s = htmllib.unescape(s) if "&" in s else s
        top = stack[-1] if stack else None
        if fresh or not out:
            if s.isspace():
                return
            out.append(Block(path(stack), top is not None and top.drop, top is not None and top.content))
            fresh = False
        elif top is not None and top.drop and not out[-1].drop:
            return  # a dropped inline element inside a block
        elif out[-1].drop and not (top is not None and top.drop):
            # running text after a dropped inline element
            out.append(Block(path(stack), False, top is not None and top.content))
        out[-1].text.append(s)
        if opened["a"]:
            out[-1].linked += len(s)

    def leave(i: int) -> None:
        opened.subtract(n.name for n in stack[i:])
        del stack[i:]

    def close(names: set[str], until: set[str]) -> None:
        nonlocal fresh
        if not any(opened[n] for n in names):
            return
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].name in names:
                leave(i)
                fresh = True
                return
            if stack[i].name in until:
                return

    at = 0
    for m in iter(lambda: TAG.search(page, at), None):
        text(page[at:m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing = m[1] or m[4]
        if closing:
            if name not in INLINE:
                fresh = True
            for i in range(len(stack) - 1, -1, -1) if opened[name] else ():
                if stack[i].name == name:
                    leave(i)
                    break
                if name in INLINE and stack[i].name not in INLINE:
                    break
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in VOID:
            fresh = fresh or name not in INLINE
            continue
        if name in CLOSES_P:
            close({"p"}, {"article", "div", "section", "td", "th", "li", "body", "blockquote"})
        if name in SIBLING:
            close(SIBLING[name], SCOPE[name])
        if name not in INLINE:
            fresh = True
        attrs = m[3] if m[2] else m[6]
        if attrs and attrs.rstrip().endswith("/") and name not in INLINE:
            continue
        stack.append(node(name, attrs or "", stack[-1] if stack else None))
        opened[name] += 1
    text(page[at:])
    return out


def ratios(found: list[Block]) -> dict[tuple, float]:
    """Smoothed, fused and weighed text ratio by (path, drop, content)."""
    stats: dict[tuple, list[float]] = defaultdict(lambda: [0.0, 0.0, 0.0, 0.0])
    for b in found:
        s = "".join(b.text)
        x = stats[b.path, b.drop, b.content]
        x[0] += 1
        x[1] += len(s)
        x[2] += len(PUNCTUATION.findall(s))
        x[3] += b.linked
    raw = {}
    for k, (n, chars, marks, linked) in stats.items():
        link = linked / chars if chars else 0.0
        raw[k] = 0.0 if link > LINK_SHARE else math.log1p(chars / n) * (1.0 + math.log1p(marks / n)) * (1.0 - link)

    plain = [k for k in raw if not k[1]]
    prefix: dict[tuple, list[float]] = defaultdict(lambda: [0.0, 0.0])
    for k in plain:
        for d in range(1, len(k[0]) + 1):
            p = prefix[k[0][:d]]
            p[0] += raw[k] * stats[k][1]
            p[1] += stats[k][1]
    # parts of the page: the first structural element in which the paths differ
    frame = {k: tuple(x for x in k[0] if x.split(".", 1)[0] in STRUCTURE) for k in plain}
    common = 0
    if plain:
        least, most = min(frame.values()), max(frame.values())
        while common < min(len(least), len(most)) and least[common] == most[common]:
            common += 1
    part: dict[tuple, float] = defaultdict(float)
    for k in plain:
        part[frame[k][:common + 1]] += stats[k][1]
    largest = max(part.values(), default=1.0) or 1.0
    total = sum(stats[k][1] for k in plain) or 1.0
    inside = 1.0 + INSIDE * (sum(stats[k][1] for k in plain if k[2]) / total) ** 2

    fused = {}
    for k, r in raw.items():
        path, drop, content = k
        if drop:
            fused[k] = BOILER * r
            continue
        f = r
        if r > 0 or content:  # a menu outside an article has nothing to inherit
            for d in range(1, len(path)):
                s, chars = prefix[path[:d]]
                f = max(f, max(FAR, NEAR ** (len(path) - d)) * s / max(chars, 1.0))
        fused[k] = f * inside if content else f * (part[frame[k][:common + 1]] / largest) ** MASS
    return fused


def extract(page: str) -> str:
    """Main text of one page."""
    found = blocks(page)
    if all(b.drop for b in found):
        return ""
    fused = ratios(found)
    least = max(THRESHOLD * max(fused.values()), 1e-9)
    kept = (" ".join("".join(b.text).split()) for b in found if fused[b.path, b.drop, b.content] >= least)
    return " ".join(t for t in kept if t)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text) of every page."""

    def run(batches):
        for b in batches:
            out = [extract(h.as_py() or "") for h in b.column("html")]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("url"), pa.array(out, pa.string())], names=["id", "url", "text"])

    d = modest_batches(pages).select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return d.mapInArrow(run, "id long, url string, text string")
