"""Main text of web pages by line-block distribution.

Markup is stripped to one line for each block element; lines of menus, headers, footers, forms, adverts and comments go. The
text lengths of the others, without link text, are summed over a sliding window of lines. A stretch begins where the sum
surges and ends where it dives to nothing, and the weightiest stretch is the core of the page, whatever the page marks;
characters in a marked article merely weigh more. The element that holds the core then bounds the text: all its lines are kept,
however short, and none outside it. Where no element holds the core but the page itself, the text is what lies between surge and dive
points, and the running text beside it.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.base import prepare

#: Lines of a window, and the text length at which the sum over it surges on a page that marks no article.
WINDOW, SURGE = 3, 80
#: How much more a character in a marked article weighs than one outside.
MARKED = 4
#: Share of the core that an element must hold to bound the text, and share of a page that no boilerplate holds.
HOLDS, TOO_MUCH = 0.8, 0.5

# Element names of HTML by their part in a page, and words in class, id or role of boilerplate.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "aside audio button canvas datalist dialog embed footer form head header iframe input label map math menu nav noscript "
    "object select svg template textarea title video".split()
)
RAW = "script|style|noscript|template|textarea|title|iframe|xmp|noembed|noframes"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset(
    "ad ads advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments cookie cookies "
    "consent disqus disclaimer footer gdpr header hidden masthead menu modal nav navbar navigation newsletter notice "
    "pagination popup promo promotion related replies reply search share sharing sidebar skip social sponsor sponsored "
    "subscribe subscription toolbar widget".split()
)
#: Words that say nothing beside those of boilerplate, as in "site-footer".
NEUTRAL = frozenset("area bar block bottom box container content global inner item items left list main outer page panel right section site top wrap wrapper".split())
ARTICLE = frozenset(("article", "main"))
#: Words that make boilerplate of a container as the first or last part of a name, as in "comment-body" or "post-comments".
AFFIXES = frozenset(
    "ad ads advert adverts advertisement advertisements breadcrumb breadcrumbs comment comments cookie cookies disqus menu nav navbar "
    "navigation newsletter promo related replies share sharing sidebar social sponsor sponsored subscribe".split()
)
#: Elements that may bound the text.
CONTAINERS = frozenset("article body center div main section td".split())
#: Elements of running text: their names are about what they say, not what they are for.
RUNNING = frozenset("h1 h2 h3 h4 h5 h6 p".split())

_RAW = re.compile(rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
_TAG = re.compile(r"""<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?/][^>]*>""")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)
_PARTS = re.compile(r"[a-z]+")


def _is_boilerplate(name: str, attributes: str, in_article: bool) -> str:
    """"sure" for what is never text, "likely" for names that only begin or end like boilerplate, else ""."""
    if name in DROPPED and not (name == "header" and in_article):
        return "sure"
    if not attributes or name in ("body", "html", "main"):
        return ""
    likely = ""
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" and value != "false" or key == "aria-hidden" and value == "true" or key == "style" and _UNSEEN.search(value):
            return "sure"
        if name in RUNNING or key not in ("class", "id", "role", "aria-label"):
            continue
        for whole in value.split() if key in ("class", "role") else [value]:
            parts = _PARTS.findall(whole)
            if BOILERPLATE.intersection(parts) and BOILERPLATE.union(NEUTRAL).issuperset(parts):
                return "sure"
            named = [x for x in parts if x not in NEUTRAL]
            if name != "article" and key in ("class", "id") and AFFIXES.intersection(named[:1] + named[-1:]):
                likely = "likely"
    return likely


@dataclass
class Element:
    name: str
    likely: bool


@dataclass
class Line:
    text: str
    #: Characters outside links.
    plain: int
    #: Numbers of the open elements that may bound the text or are likely boilerplate, outermost first.
    path: tuple[int, ...]
    running: bool


def lines_of(page: str) -> tuple[list[Line], list[Element]]:
    """The blocks of a page that are not surely boilerplate, and the elements their paths name."""
    page = _RAW.sub(" ", page)
    lines: list[Line] = []
    elements: list[Element] = []
    text: list[str] = []
    opened: list[int] = []
    links = 0
    skip, depth = "", 0  # the boilerplate element that is open, and how many of its name
    in_link, block = 0, ""

    def flush() -> None:
        nonlocal links
        joined = " ".join(html.unescape("".join(text)).split())
        if joined:
            lines.append(Line(joined, max(0, len(joined) - links), tuple(opened), block in RUNNING))
        text.clear()
        links = 0

    def add(part: str) -> None:
        nonlocal links
        if part and not skip:
            text.append(part)
            if in_link:
                links += len(" ".join(part.split()))

    at = 0
    for tag in _TAG.finditer(page):
        add(page[at : tag.start()])
        at = tag.end()
        if not tag[2]:
            continue
        name, closing = tag[2].lower(), tag[1] == "/"
        alone = name in VOID or tag[3].endswith("/")
        if skip:
            if name == skip and not alone:
                depth += -1 if closing else 1
                if depth == 0:
                    skip = ""
            elif closing and name in ("body", "html"):
                skip = ""
            continue
        if name in BLOCKS or name in DROPPED:
            flush()
            block = "" if closing else name
        elif name in ("br", "wbr"):
            add(" " if name == "br" else "")
        if name == "a":
            in_link = 0 if closing else 1
        if closing:
            # Closes the innermost open element of that name, and those left open within it.
            found = next((k for k in range(len(opened) - 1, -1, -1) if elements[opened[k]].name == name), None)
            if found is not None:
                del opened[found:]
        elif not alone:
            kind = _is_boilerplate(name, tag[3], any(elements[k].name in ARTICLE for k in opened))
            if kind == "sure":
                skip, depth = name, 1
            elif kind or name in CONTAINERS:
                opened.append(len(elements))
                elements.append(Element(name, bool(kind)))
    add(page[at:])
    flush()
    return lines, elements


def stretches(weights: list[int], surge: int) -> list[tuple[int, int]]:
    """(surge point, dive point) of the stretches whose windowed sums reach ``surge``; the dive point is exclusive."""
    found, begin, top = [], None, 0
    for k, weight in enumerate([*weights, *[0] * WINDOW]):
        ahead = sum(weights[k : k + WINDOW])
        if begin is None:
            if weight and ahead:
                begin, top = k, ahead
        elif ahead == 0:
            if top >= surge:
                found.append((begin, k))
            begin = None
        else:
            top = max(top, ahead)
    return found


def held_by(lines: list[Line], weights: list[int]) -> Counter:
    """The weight of the lines within each element."""
    held: Counter = Counter()
    for line, weight in zip(lines, weights):
        for k in line.path:
            held[k] += weight
    return held


def bounds_of(core: Counter, total: int, lines: list[Line], elements: list[Element]) -> int | None:
    """The element that bounds the text: the innermost that holds the core, or the outermost article around that one."""
    holding = [k for k, weight in core.items() if weight >= HOLDS * total and elements[k].name != "body"]
    if not holding:
        return None
    inner = max(holding)  # elements are numbered as they open
    path = next(line.path for line in lines if inner in line.path)
    marked = [k for k in path[: path.index(inner) + 1] if elements[k].name in ARTICLE]
    return marked[0] if marked else inner


def without_cards(lines: list[Line], outer: int, elements: list[Element]) -> list[Line]:
    """Lines of an element without the small articles inside it, such as teasers, if most of its text is not in those."""
    weights = [len(line.text) for line in lines]
    held = held_by(lines, weights)
    small = {k for k, weight in held.items() if k != outer and elements[k].name == "article" and weight < sum(weights) / 4}
    rest = [line for line in lines if not small.intersection(line.path)]
    return rest if 2 * sum(len(line.text) for line in rest) >= sum(weights) else lines


def main_text(page: str | None) -> str:
    """The blocks of the article in page order, one a line; empty if there is none."""
    lines, elements = lines_of(page or "")
    held = held_by(lines, [line.plain for line in lines])
    limit = TOO_MUCH * sum(line.plain for line in lines)
    unlikely = {k for k, e in enumerate(elements) if e.likely and held[k] <= limit}
    lines = [line for line in lines if not unlikely.intersection(line.path)]

    # Within a marked article a line that is all link is still text of the article.
    marked = [any(elements[k].name in ARTICLE for k in line.path) for line in lines]
    weights = [MARKED * len(line.text) if own else line.plain for line, own in zip(lines, marked)]
    found = stretches(weights, SURGE) or stretches(weights, 1)
    if not found:
        return ""
    low, high = max(found, key=lambda s: sum(weights[s[0] : s[1]]))
    core = held_by(lines[low:high], weights[low:high])
    outer = bounds_of(core, sum(weights[low:high]), lines, elements)
    if outer is not None:
        return "\n".join(line.text for line in without_cards([x for x in lines if outer in x.path], outer, elements))
    if sum(weights[low:high]) < SURGE:
        found = [(low, high)]
    between = {k for first, last in found for k in range(first, last)}
    parents = Counter(line.path for line in lines[low:high])
    beside = parents.most_common(1)[0][0]
    return "\n".join(line.text for k, line in enumerate(lines) if k in between or line.running and line.plain and line.path == beside)


def main_text_column(page: Column) -> Column:
    """The main text of each page (see ``main_text``); null pages count as empty and give an empty string."""

    @F.arrow_udf("string")
    def of(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p) for p in pages.to_pylist()], pa.string())

    return of(page)


def with_main_text(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with the main text and its length in code points, n_chars; older columns of these names are replaced.

    Every row stays, repeated rows and null ids too. Broken markup (unclosed elements, comments or scripts) is read as
    far as it goes, and pages of any length are read whole.
    """
    prepare(pages.sparkSession)
    made = pages.withColumn(text_col, main_text_column(F.col(html_col)))
    return made.withColumn("n_chars", F.char_length(text_col).cast("long"))
