"""Main text of web pages by line-block distribution.

Markup is stripped into lines: a block-level tag ends a line, an inline tag
leaves no trace, and end tags that HTML lets a page leave out are put in.  A line
counts unless it stands in an element that is no article text (menu, header,
footer, sidebar, notice, advert, form, comments) or, outside an article element,
in a row of lines that are mostly links.  Lines that do not count, and those
outside the article element where a page has one, keep their place but have
length zero.  Text lengths are summed over sliding windows of ``window`` lines;
the distribution surges where a sum passes ``surge`` (the first line of text where
the page has an article element) and dives where it falls to zero.  The text
between is kept.

An element is no article text by its name or role, or by a class or id whose
head word says so (``site-footer``, ``share-buttons``; not ``has-sidebar`` or
``search-results-explained``).  A class, an id or a form does not count for an
element that holds an article element or most of the page's text.

Without an article element the runs between surge and dive that hold at least
``share`` of the heaviest run's text (of all runs, where none surges) tell the
container: the innermost element around them that does not merely set text, such
as a paragraph, a list or a section.  All lines that count in it are kept.

Time is in proportion to the page, whatever is nested or left open in it.

Defined cases: a null or empty page, or one without text, gives an empty text;
pages cut off in the middle of an element or a tag are read to their end; a
page may be of any length, repeated rows are rows of their own; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import byte_rows, map_arrow

WINDOW, SURGE, SHARE = 3, 60, 0.05

#: Element names by their role in a page.
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt s
    samp small span strike strong sub sup time tt u var wbr math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover
    munderover mmultiscripts mtable mtr mtd mstyle mpadded mphantom mspace merror menclose semantics""".split())
RAW = frozenset("script style noscript template textarea title iframe object svg annotation annotation-xml select option canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
APART = frozenset("nav footer aside button menu dialog".split())
ARTICLE = frozenset("article main".split())
#: Elements that set a text's parts and are no container of an article.
SETTING = frozenset("""p h1 h2 h3 h4 h5 h6 hgroup ul ol li dl dt dd blockquote pre figure figcaption table thead tbody tfoot tr
    section address details summary""".split())
_APART_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
_APART_WORDS = frozenset("""ad ads adbox advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner
    nav navbar navigation menu menubar breadcrumb breadcrumbs footer sidebar aside widget notice cookie cookies consent
    gdpr popup modal overlay alert newsletter subscribe subscription signup login share sharing social related recommended
    recommendations comment comments commentlist disqus reply replies respond pagination pager toolbar masthead copyright
    skip form search""".split())

#: Words that turn a class into a statement about something else, and words behind a class's head that only say it is a box or a list.
_TURNING = frozenset("has no not with without hide show".split())
_BOXES = frozenset("""area bar block box button buttons card cards column container content group holder icon icons inner item items link links list
    panel posts row section slot unit widgets wrap wrapper left right top bottom primary secondary global mobile desktop""".split())
#: Start tags that close an open p, and elements that a closed one does not reach across (fixed values of HTML).
_CLOSE_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
    header hgroup hr main menu nav ol p pre search section summary table ul""".split())
_SCOPE = ("table", "td", "th", "caption", "button")
#: Elements whose start closes the open one of the first list, unless one of the second was opened within it.
_CLOSES = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), ("table",)),
           "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "thead": (("thead", "tbody", "tfoot"), ("table",)),
           "tbody": (("thead", "tbody", "tfoot"), ("table",)), "tfoot": (("thead", "tbody", "tfoot"), ("table",))}
_TABLE = frozenset("table thead tbody tfoot tr td th caption".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)|<[/a-zA-Z][^>]*(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_MAIN = re.compile(r"""role\s*=\s*["']?main|itemprop\s*=\s*["']?articleBody""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def names_apart(token: str) -> bool:
    """True for a class or id whose head is a word for what is no article text."""
    words = [w.lower() for w in _WORD.findall(token)]
    if not words or not _TURNING.isdisjoint(words[:-1]):
        return False
    while len(words) > 1 and words[-1] in _BOXES:
        words.pop()
    return words[-1] in _APART_WORDS


def _apart(name: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element's text is no article text by its nature, and by what it is called."""
    if name in APART or name == "header" and not in_article:
        return True, True
    called = name == "form"
    if not attributes.strip():
        return False, called
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key in ("class", "id") and name not in ("html", "body", *ARTICLE):
            called = called or any(map(names_apart, value.split()))
        value = value.lower()
        if key == "role" and value in _APART_ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True, True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, True
    return False, called


class _Element:
    __slots__ = ("name", "around", "first", "behind", "apart", "called", "article")

    def __init__(self, name, around, first, apart, called, article):
        self.name, self.around, self.first, self.behind = name, around, first, None
        self.apart, self.called, self.article = apart, called, article


def lines(page: str) -> tuple[list[tuple[str, bool, int]], list[_Element]]:
    """(text, mostly links, element or -1) of each line; the elements in the order of their start tags, with the line each begins at
    and the one behind it."""
    found: list[tuple[str, bool, int]] = []
    elements: list[_Element] = []
    stack: list[int] = []
    places: dict[str, list[int]] = {}  # where on the stack elements of a name are open
    pieces: list[str] = []
    linked, links, articles = 0, 0, 0

    def end_line():
        nonlocal pieces, linked
        text = " ".join(html.unescape("".join(pieces)).split()) if pieces else ""
        found.append((text, linked > 0.5 * len(text), stack[-1] if stack else -1))
        pieces, linked = [], 0

    def last(*names) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=-1)

    def close(depth: int):
        nonlocal articles
        while len(stack) > depth:
            element = elements[stack.pop()]
            element.behind = len(found)
            places[element.name].pop()
            articles -= element.article

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        stop = m.start() if m else n
        if stop > at:
            pieces.append(page[at:stop])
            if links:
                linked += len(page[at:stop].strip())
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        closes = m[1] == "/"
        if name == "br":
            pieces.append(" ")
            continue
        if name in RAW and not closes:
            if not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else n
            if name not in INLINE and not name.startswith("annotation"):
                end_line()
            continue
        if name == "a":
            links = 0 if closes else 1
        if name in INLINE or name.startswith("annotation"):
            continue
        end_line()
        links = 0
        if name in RAW:
            continue
        if closes:
            place = last(name)
            if place >= 0 and (name in _TABLE or place >= last(*_SCOPE)):
                close(place)
            continue
        if name in _CLOSE_P and (place := last("p")) > last(*_SCOPE):
            close(place)
        if name in _CLOSES:
            ends, within = _CLOSES[name]
            if (place := last(*ends)) > last(*within):
                close(place)
        if name in VOID or m[3].rstrip().endswith("/"):
            continue
        article = name in ARTICLE or bool(_MAIN.search(m[3]))
        elements.append(_Element(name, stack[-1] if stack else -1, len(found), *_apart(name, m[3], articles > 0), article))
        places.setdefault(name, []).append(len(stack))
        stack.append(len(elements) - 1)
        articles += article
    end_line()
    close(0)
    return found, elements


def _judged(found: list[tuple[str, bool, int]], elements: list[_Element]) -> tuple[list[int], list[bool], bool]:
    """Characters that count and whether it is in an article element, for each line, and whether the page has such an element."""
    before = [0, *accumulate(len(text) for text, _, _ in found)]
    holds = [False] * len(elements)  # an article element within
    for k in range(len(elements) - 1, -1, -1):
        e = elements[k]
        if e.around >= 0 and (holds[k] or e.article and not e.apart):
            holds[e.around] = True
    apart, inside = [False] * len(elements), [False] * len(elements)
    for k, e in enumerate(elements):  # an element comes behind the one around it
        most = 2 * (before[e.behind] - before[e.first]) > before[-1]
        out, inn = (apart[e.around], inside[e.around]) if e.around >= 0 else (False, False)
        apart[k] = out or e.apart or e.called and not holds[k] and not most
        inside[k] = inn or e.article
    has_article = any(e.article and not apart[k] for k, e in enumerate(elements))
    counts, in_article = [], []
    for text, _, element in found:
        counts.append(0 if element >= 0 and apart[element] else len(text))
        in_article.append(element >= 0 and inside[element])
    # A menu without a name is a row of links; a single line of links belongs to the text around it.
    row: list[int] = []
    for k, (text, linked, _) in enumerate([*found, ("end", False, -1)]):
        if text and linked and not in_article[k]:
            row.append(k)
        elif text:
            if len(row) > 1:
                for r in row:
                    counts[r] = 0
            row = []
    return counts, in_article, has_article


def _container(found: list[tuple[str, bool, int]], elements: list[_Element], first: int, last: int) -> tuple[int, int]:
    """First line, and the one behind the last, of the innermost container around the lines from ``first`` to ``last``."""
    texts = [0, *accumulate(1 if text else 0 for text, _, _ in found)]
    element = found[first][2]
    while element >= 0:
        e = elements[element]
        if e.name not in SETTING and e.behind > last and (last > first or texts[e.behind] - texts[e.first] > 1):
            return e.first, e.behind
        element = e.around
    return 0, len(found)


def main_text(page: str, window: int = WINDOW, surge: int = SURGE, share: float = SHARE) -> str:
    """The article's blocks in page order, joined by a space."""
    if not page:
        return ""
    found, elements = lines(page)
    counted, in_article, has_article = _judged(found, elements)
    # Empty lines come from markup alone; a line of boilerplate leaves a gap as wide as the window.
    kept: list[tuple[str, int, int]] = []
    for k, (text, _, _) in enumerate(found):
        counts = counted[k] if in_article[k] or not has_article else 0
        if counts:
            kept.append((text, counts, k))
        elif text:
            kept.extend([("", 0, k)] * window)
    lengths = [c for _, c, _ in kept] + [0] * window
    sums, total = [], sum(lengths[:window])
    for k in range(len(kept)):
        sums.append(total)
        total += lengths[k + window] - lengths[k] if k + window < len(lengths) else -lengths[k]
    runs, start, risen = [], None, False
    for k, s in enumerate([*sums, 0]):
        if s and lengths[k] and start is None:
            start, risen = k, False
        if start is not None:
            risen |= s >= (1 if has_article else surge)
            if s == 0:
                runs.append((start, k, risen))
                start = None
    if has_article:
        return " ".join(t for a, b, risen in runs if risen for t, c, _ in kept[a:b] if c)
    if not runs:
        return ""
    runs = [r for r in runs if r[2]] or runs
    weight = [sum(lengths[a:b]) for a, b, _ in runs]
    least = share * max(weight)
    told = [k for (a, b, _), w in zip(runs, weight) if w >= least for _, c, k in kept[a:b] if c]
    first, behind = _container(found, elements, told[0], told[-1])
    return " ".join(t for t, c, k in kept if c and first <= k < behind)


def _extract(window: int, surge: int, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(t.decode("utf-8", "replace"), window, surge, share) for t in byte_rows(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])
    return run


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", window: int = WINDOW,
            surge: int = SURGE, share: float = SHARE) -> DataFrame:
    """One row per input row: page_id, url, text, n_chars.  No shuffle."""
    return map_arrow(pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")),
                     _extract(window, surge, share), "page_id long, url string, text string, n_chars long")
