"""HTML extraction by line-block distribution.

A small helper strips the markup of a page into lines, one for each block element, and says of
each which article it stands in and whether an element around it (menu, header, footer, sidebar,
notice, advert, form, comments) is no main text; lines of such elements count as empty. Weights
are summed over sliding windows of all other lines; a line where the sum surges over the threshold
opens main text, one where it dives below closes it, and everything between stays. A line weighs
its length. As far as articles hold the page's text, a line of an article weighs more, so that
short ones stay, and one outside weighs less; a page without an article needs lines of some length.

Defined cases: null or empty html gives empty text; markup that is cut off or never closed ends
with the page; equal pages give equal text; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import html
import itertools
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines in a sliding window, and the weight that a window of main text has at least.
WINDOW, SURGE = 3, 86

# Fixed values of HTML: elements by what they mean for the text.
_BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead title tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NO_TEXT = frozenset("aside audio button canvas datalist dialog footer form head iframe menu nav noscript object search select svg template video".split())
#: Those of them that are boilerplate by what they hold, so that they may turn out to hold the main text.
_SOFT = frozenset("aside dialog footer form menu nav search".split())
_RAW = "script|style|textarea|title|xmp|noembed|noframes"
_ARTICLE = frozenset(("article", "main"))
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
# A class or id token is boilerplate if each of its words says so or only says what kind of box it is.
_NAME = r"(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|sidebars?|side|comments?|commentlist|disqus|replies|cookies?|consent|gdpr|notices?|alerts?|banners?|popups?|modals?|overlay|shar(?:e|ing)|social|breadcrumbs?|related|recommended|newsletter|subscri\w*|login|signup|menus?|nav(?:bar|igation)?|footer|masthead|toolbar|widgets?|pagination|pager|copyright|disclaimer|skip)"
_BOX = r"(?:area|bar|block|bottom|box|buttons?|col(?:umn)?|container|content|form|global|group|header|inner|items?|left|links?|list|outer|panel|primary|right|secondary|section|site|slot|sticky|top|unit|wrap(?:per)?|\d+)"
_NAMES = re.compile(rf"(?=.*(?:^|[_-]){_NAME}(?:$|[_-]))(?:{_NAME}|{_BOX})(?:[_-]+(?:{_NAME}|{_BOX}))*", re.I)
# Optional end tags: what an element's start ends, and what such an end does not reach across.
_SIBLINGS = {"li": (("li",), ("ul", "ol", "menu", "dir", "table"))} | {t: (("dd", "dt"), ("dl", "table")) for t in ("dd", "dt")} | {t: (("td", "th"), ("tr", "table")) for t in ("td", "th")} | {"tr": (("tr",), ("table",))} | {t: (("tbody", "thead", "tfoot"), ("table",)) for t in ("tbody", "thead", "tfoot")}
_SCOPE = frozenset("caption table td th".split())
# A quote opens a value only right behind the equals sign; inside an unquoted value it is a letter like any other.
_ATTRIBUTES = r"(?:[^>\"'=]|=\s*\"[^\"]*(?:\"|$)|=\s*'[^']*(?:'|$)|=\s*[^\s\"'>][^\s>]*|[\"'=])*"
_TOKEN = re.compile(rf"<!--.*?(?:-->|$)|<(?P<raw>{_RAW})\b{_ATTRIBUTES}>.*?(?:</(?P=raw)\s*>|$)|<!\[CDATA\[|<[!?][^>]*(?:>|$)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<more>{_ATTRIBUTES})(?:>|$)", re.S | re.I)
# One attribute: its whole name, and its value where it has one.
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|$)|'([^']*)(?:'|$)|([^\s\"'>][^\s>]*)))?")


def _boilerplate(tag: str, more: str, inside: bool) -> str:
    """What speaks against an element: "never" shown as text, its "kind", its "name", or nothing."""
    if tag in _NO_TEXT and tag not in _SOFT:
        return "never"
    kind = "kind" if tag in _SOFT or tag == "header" and not inside else ""
    if tag in _ARTICLE or tag in ("html", "body") or not more.strip():
        return kind
    for name, *values in _ATTRIBUTE.findall(more):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return "never"
        if name == "role" and value.lower() in _ROLES:
            kind = "kind"
        elif name in ("class", "id") and not kind and any(map(_NAMES.fullmatch, value.split())):
            kind = "name"
    return "name" if kind and tag == "form" else kind


def page_lines(page: str) -> list[dict]:
    """The page's blocks as {text, article, plain}: the outermost article around it (-1 for none);
    plain: not boilerplate. An element that its kind or name marks as boilerplate counts as none if
    it holds main or the longest article, one that its name marks also if it holds most of the
    text of a page that has no article outside it."""
    lines: list[list[tuple[str, int]]] = []  # stretches of text, each with the innermost marked element around it
    marks: list[tuple[str, str, int]] = []  # tag, what speaks against it, the marked element around it
    stack: list[tuple[str, int]] = []  # open elements, and the innermost marked element from there
    count: dict[str, int] = {}
    parts: list[tuple[str, int]] = []
    at = depth = 0

    def add(text: str) -> None:
        if text:
            parts.append((text, stack[-1][1] if stack else -1))

    def flush() -> None:
        line = [(html.unescape("".join(t for t, _ in some)), mark) for mark, some in itertools.groupby(parts, lambda x: x[1])]
        parts.clear()
        if any(t and not t.isspace() for t, _ in line):
            lines.append(line)

    def end(tags: tuple[str, ...], stops: frozenset[str] | tuple[str, ...]) -> None:
        """Ends the innermost open element of tags, with all in it, unless one of stops is around first."""
        nonlocal depth
        if not any(count.get(t) for t in tags):
            return
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in tags:
                for t, _ in stack[k:]:
                    count[t] -= 1
                    depth -= t in _ARTICLE
                del stack[k:]
                return
            if stack[k][0] in stops:
                return

    for m in _TOKEN.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag == "br":
            add(" ")
            continue
        block = tag in _BLOCKS
        if block:
            flush()
        if m["end"]:
            end((tag,), _SIBLINGS[tag][1] if tag in _SIBLINGS else ("table",) if tag in ("table", "caption") else _SCOPE if block else _BLOCKS)
            continue
        if tag in _BLOCKS:  # a paragraph ends where the next block begins
            end(("p",), _SCOPE)
        if tag in _SIBLINGS:
            end(*_SIBLINGS[tag])
        if tag in _VOID or m["more"].endswith("/") and tag not in _BLOCKS:
            continue
        against, above = _boilerplate(tag, m["more"], depth > 0), stack[-1][1] if stack else -1
        if against or tag in _ARTICLE:
            marks.append((tag, against, above))
            above = len(marks) - 1
        stack.append((tag, above))
        count[tag] = count.get(tag, 0) + 1
        depth += tag in _ARTICLE
    add(page[at:])
    flush()
    return _judged(lines, marks)


def _judged(lines: list[list[tuple[str, int]]], marks: list[tuple[str, str, int]]) -> list[dict]:
    size, never = [0] * len(marks), []
    for _, against, above in marks:
        never.append(against == "never" or above >= 0 and never[above])
    total = 0
    for line in lines:
        for text, k in line:
            if k < 0 or not never[k]:
                n = len(" ".join(text.split()))
                total += n
                if k >= 0:
                    size[k] += n
    for k in range(len(marks) - 1, -1, -1):
        if marks[k][2] >= 0:
            size[marks[k][2]] += size[k]
    articles = [k for k, (tag, _, _) in enumerate(marks) if tag in _ARTICLE and size[k] and not never[k]]
    longest = max((size[k] for k in articles), default=0)
    holds, inner = [0] * len(marks), [False] * len(marks)  # articles in an element, and whether the chief one is
    for k in articles:
        holds[k], inner[k] = 1, marks[k][0] == "main" or size[k] == longest
    for k in range(len(marks) - 1, -1, -1):
        if (above := marks[k][2]) >= 0:
            holds[above] += holds[k]
            inner[above] |= inner[k]
    skipped, article = [], []
    for k, (tag, against, above) in enumerate(marks):
        kept = not against or against != "never" and (inner[k] or against == "name" and 2 * size[k] > total and holds[k] == len(articles))
        skipped.append(not kept or above >= 0 and skipped[above])
        around = article[above] if above >= 0 else -1
        article.append(k if around < 0 and tag in _ARTICLE else around)
    out = []
    for line in lines:
        kept = [(text, k) for text, k in line if k < 0 or not skipped[k]]
        text = " ".join("".join(t for t, _ in kept).split())
        k = next((k for t, k in kept or line if t and not t.isspace()), -1)
        out.append({"text": text or " ".join("".join(t for t, _ in line).split()), "article": article[k] if k >= 0 else -1, "plain": bool(text)})
    return out


def between_surge_and_dive(lines: list[dict], window: int = WINDOW, surge: int = SURGE) -> list[str]:
    """The plain lines in a window whose weights sum to the threshold. A line weighs its length; the
    larger the articles' share of the text, the more a line of an article weighs and the less one
    outside. An article much shorter than the longest counts as outside in that measure."""
    if not lines:
        return []
    plain = np.array([x["plain"] for x in lines])
    lengths = np.where(plain, [len(x["text"]) for x in lines], 0).astype(float)
    place = np.array([x["article"] for x in lines]) + 1
    size = np.bincount(place, lengths)
    size[0] = 0
    share = size.sum() / max(1.0, lengths.sum())
    likely = (size / max(1.0, size.max()))[place]
    weights = np.where(plain, lengths * (1 - share * (1 - likely)) + surge * share * likely, 0)
    # no window reaches across an article's border
    at = np.arange(len(lines)) + (window - 1) * np.concatenate([[0], np.cumsum(np.diff(place) != 0)])
    spread = np.zeros(at[-1] + 1)
    spread[at] = weights
    sums = np.convolve(spread, np.ones(window))  # sums[i]: of the window that ends at place i
    high = sums >= surge - 1e-6
    between = np.convolve(high, np.ones(window, np.int64))[window - 1 : window - 1 + len(spread)] > 0
    return [x["text"] for x, b, n in zip(lines, between[at], plain, strict=True) if b and n]


def extract(pages: DataFrame, html_col: str = "html", window: int = WINDOW, surge: int = SURGE) -> DataFrame:
    """pages without html_col, with text (the main text's blocks, joined by a blank line) and n_chars
    (its code points)."""

    def texts(column: pd.Series) -> pd.Series:
        return column.map(lambda page: "\n\n".join(between_surge_and_dive(page_lines(page), window, surge)))

    others = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    page = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    return pages.select(*others, F.pandas_udf(texts, "string")(page).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
