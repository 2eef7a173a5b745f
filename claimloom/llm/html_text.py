"""Main text of web pages by the distribution of text over line blocks."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A comment, CDATA, a declaration, or a tag (quoted attributes may hold ">").
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"""
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"<]*"|'[^'<]*')*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>]*)>""",
    re.DOTALL,
)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)

#: Elements whose content is no text of the page.
_RAW = frozenset({"script", "style", "noscript", "template", "textarea", "svg", "iframe", "object", "canvas", "title", "annotation", "annotation-xml"})
#: Elements that hold navigation, notices and the like.
_CHROME = frozenset({"head", "nav", "header", "footer", "aside", "menu", "dialog", "button", "select", "label"})
#: Elements that may hold a whole page as well.
_FORM = frozenset({"form", "fieldset"})
_STYLE = re.compile(r"""\bstyle\s*=\s*(?:"[^"]*?display\s*:\s*none|'[^']*?display\s*:\s*none)""", re.IGNORECASE)
_QUOTED = re.compile(r"""=\s*(?:"[^"]*"|'[^']*')""")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)", re.IGNORECASE)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data dfn em font i img ins del kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr"
    " math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder mover munderover semantics annotation annotation-xml".split()
)
#: Words in a class, id or role that mark chrome inside a page.
_CHROME_WORDS = frozenset(
    """ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments cookie cookies consent
    disqus footer gdpr header masthead menu menubar modal nav navbar navigation newsletter notice notices notification pager
    pagination popup promo promoted promotion related reply replies respond search share sharing sidebar sidebars signup skip
    social sponsor sponsored subscribe subscription toolbar widget widgets contentinfo complementary login alert
    commentlist commentform cookiebar cookiebanner topnav sidenav navlinks sitenav adbox adslot adunit adbanner""".split()
)
#: "has-sidebar" and the like say what is elsewhere on the page.
_FLAG = frozenset({"has", "no", "with", "without"})
#: Elements around everything; their class says nothing about what is inside.
_OUTER = frozenset({"html", "body", "main"})

WINDOW = 3  # lines
SURGE = 12  # characters in a window that may open a text
LINK_SHARE = 0.6  # a line with more of its characters in links holds no text of its own
PRIOR = 4  # a character in an article or main counts as so many
_HEADING = frozenset({"h1", "h2", "h3", "h4", "h5", "h6"})


class _Line:
    __slots__ = ("linked", "parts", "scope", "text")

    def __init__(self, scope: int) -> None:
        self.parts: list[tuple[str, int, bool]] = []  # (text, suspect around it, in a link)
        self.linked = 0
        self.scope = scope
        self.text = ""


class _Suspect:
    """An element that its name calls chrome; what is in it decides at the end of the page. The first stands for the page."""

    __slots__ = ("around", "articles", "direct", "linked", "marked", "own", "sure", "within")

    def __init__(self, around: int, sure: bool, marked: bool, within: int) -> None:
        self.around = around  # the suspect around it
        self.sure = sure  # its name has no other words
        self.marked = marked  # is or holds an article or main
        self.within = within  # the free article around it
        self.own = self.linked = self.direct = 0  # characters: its text, that in links, that in no inner suspect


TAG, NAME, MIXED = 1, 2, 3


def _chrome(name: str, attributes: str, inside_article: bool) -> int:
    """0, or TAG: chrome; NAME: chrome by a name of no other words; MIXED: by a name with others, a form, hidden."""
    if name == "header":
        return 0 if inside_article else TAG  # an article's own header has its title
    if name in _CHROME:
        return TAG
    if name in _FORM:
        return MIXED
    if name in _OUTER or not attributes:
        return 0
    kind = 0
    for found in _NAMED.finditer(attributes):
        for value in (found[1] or found[2] or found[3] or "").split():
            words = re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())
            words = [w for i, w in enumerate(words) if w and not (i and words[i - 1] in _FLAG)]
            if name == "article":
                words = words[:1]  # "comment" marks one, "has-comments" does not
            if inside_article:
                words = [w for w in words if w != "header"]
            if not _CHROME_WORDS.isdisjoint(words):
                if _CHROME_WORDS.issuperset(words):
                    return NAME
                kind = MIXED
    return kind or (MIXED if _HIDDEN.search(_QUOTED.sub("=", attributes)) or _STYLE.search(attributes) else 0)


def _judge(suspects: list[_Suspect], free: list[list[int]]) -> list[bool]:
    """Which suspects are chrome: all but those around an article, or most of the text, of a page with no other article.

    ``free`` has the articles outside all suspects as [article around it, whether it has text].
    """
    for f in reversed(free[1:]):
        free[f[0]][1] |= f[1]
    with_text = [0] * len(free)  # articles with text from each one outwards
    for i, f in enumerate(free[1:], 1):
        with_text[i] = with_text[f[0]] + f[1]
    total = sum(f[1] for f in free[1:])
    outside = [0] * len(suspects)  # text around each one that is in no other suspect
    for i, s in enumerate(suspects[1:], 1):
        outside[i] = outside[s.around] + suspects[s.around].direct
    chrome = [False] * len(suspects)
    for i in range(len(suspects) - 1, 0, -1):
        s = suspects[i]
        most = s.own > outside[i]
        if s.sure:
            holds = s.marked and most
        else:
            holds = s.marked or (most and s.own >= s.linked)
        chrome[i] = not (holds and s.own + s.linked and total == with_text[s.within])
        if not chrome[i]:
            around = suspects[s.around]
            around.own += s.own
            around.linked += s.linked
            around.marked |= s.marked
    for i, s in enumerate(suspects[1:], 1):
        chrome[i] |= chrome[s.around]
    return chrome


def strip_markup(page: str) -> list[_Line]:
    """One line per block, in page order; chrome gives lines without text. scope: article or main elements around it."""
    lines = [_Line(0)]
    stack: list[tuple[str, bool, int, int]] = []  # (name, chrome, suspect around it, free article around it)
    suspects = [_Suspect(0, False, False, 0)]
    free = [[0, 0]]
    never_closed: set[str] = set()
    chrome = links = headings = scope = at = suspect = article = 0

    def add(text: str) -> None:
        if text and not chrome:
            text = entities.unescape(text)
            linked = links > 0 and not headings  # a linked title is a title
            lines[-1].parts.append((text, suspect, linked))
            n = sum(map(len, text.split()))
            if linked:
                suspects[suspect].linked += n
            else:
                suspects[suspect].own += n
                suspects[suspect].direct += n
                if n and not suspect:
                    free[article][1] = 1

    def end(depth: int) -> None:
        nonlocal chrome, links, headings, scope, suspect, article
        if depth < len(stack):
            _, _, suspect, article = stack[depth]
        for name, hidden, _, _ in stack[depth:]:
            chrome -= hidden
            links -= name == "a"
            headings -= name in _HEADING
            scope -= name in ("article", "main")
        del stack[depth:]

    while token := _TOKEN.search(page, at):
        add(page[at : token.start()])
        at = token.end()
        closing, name, attributes = token[1] or token[4], (token[2] or token[5] or "").lower(), token[3] or token[6] or ""
        if token[0].startswith("<![CDATA["):
            add(entities.escape(token[0][9:-3]))
        if not name:
            continue
        if name == "br":
            add("\n")
            continue
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                end(depth)
        elif name in _RAW and not attributes.endswith("/"):
            close = None if name in never_closed else re.compile(rf"</{name}[^>]*>", re.IGNORECASE).search(page, at)
            if close:
                at = close.end()
            elif name in ("script", "style"):
                at = len(page)
            else:
                never_closed.add(name)
        elif name == "body" or (stack and stack[-1][0] == "head" and name not in _VOID):
            end(0)  # the head ended without a tag
        if name not in _INLINE:
            if lines[-1].parts or chrome or suspect:
                lines.append(_Line(scope))
            else:
                lines[-1].scope = scope
        if closing or name in _RAW or name in _VOID or attributes.endswith("/"):
            continue
        if name not in _INLINE and stack and stack[-1][0] == "p":
            end(len(stack) - 1)  # a block ends an open paragraph
        kind, marked = _chrome(name, attributes, scope > 0), name in ("article", "main")
        stack.append((name, kind == TAG, suspect, article))
        chrome += kind == TAG
        links += name == "a"
        headings += name in _HEADING
        scope += marked
        if kind > TAG and not chrome:
            suspects.append(_Suspect(suspect, kind == NAME, marked, article))
            suspect = len(suspects) - 1
        elif marked and suspect:
            suspects[suspect].marked = True
        elif marked and not chrome:
            free.append([article, 0])
            article = len(free) - 1
        lines[-1].scope = scope
    add(page[at:])
    blank = _judge(suspects, free)
    for line in lines:
        line.parts = [p for p in line.parts if not blank[p[1]]]
        line.linked = sum(len(text) for text, _, linked in line.parts if linked)
        line.text = " ".join("".join(text for text, _, _ in line.parts).split())
    return lines


def text_span(lengths: np.ndarray, surge: int = SURGE) -> list[tuple[int, int]]:
    """Runs of lines between a surge of the windows' text and its next dive to nothing.

    The window sums are taken over ``WINDOW`` lines from each line on. A run
    starts at a line with text whose window reaches the surge, and ends before
    the first window without any text.
    """
    if not len(lengths):
        return []
    padded = np.concatenate([lengths, np.zeros(WINDOW, dtype=np.int64)])
    sums = np.convolve(padded, np.ones(WINDOW, dtype=np.int64))[WINDOW - 1 :][: len(lengths)]
    runs, start = [], -1
    for i, s in enumerate(sums):
        if start < 0:
            if lengths[i] and s >= surge:
                start = i
        elif s == 0:
            runs.append((start, i))
            start = -1
    if start >= 0:
        runs.append((start, len(lengths)))
    return runs


def main_text(page: str | None) -> str:
    """The page's main text: blocks joined by an empty line; empty if there is none.

    Lines of links count nothing, lines in an article or main element ``PRIOR``
    times their length; where those outweigh the rest, the rest counts nothing.
    The surges and dives of what counts choose the text. Lines of links inside
    a run of an article belong to it. A page without a run, as its lines are
    short, gives what its article or main elements hold, or else its lines that count.
    """
    lines = strip_markup(page or "")
    lengths = np.array([len(x.text) for x in lines], dtype=np.int64)
    scoped = np.array([x.scope > 0 for x in lines])
    linked = np.array([x.linked > LINK_SHARE * sum(len(text) for text, _, _ in x.parts) for x in lines])
    weights = np.where(linked, 0, lengths) * np.where(scoped, PRIOR, 1)
    if weights[scoped].sum() and weights[scoped].sum() >= weights[~scoped].sum():
        weights[~scoped] = 0
    runs = text_span(weights)
    if not runs:
        short = scoped if lengths[scoped].any() else weights > 0
        return "\n\n".join(x.text for x, s in zip(lines, short) if s and x.text)
    taken = (weights > 0) | (scoped & linked & (lengths > 0))
    return "\n\n".join(lines[i].text for a, b in runs for i in range(a, b) if taken[i])


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with the column text (replacing one of that name): the main text of each page.

    Null and empty pages, and pages with nothing but chrome, give an empty text.
    Rows are worked on one by one, so repeated rows and ties need no rule; every
    other column passes through. No part of a page is cut off for its length.
    """

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(main_text, na_action=None) if len(batch) else batch

    return pages.withColumn("text", texts(F.col(html_col)))
