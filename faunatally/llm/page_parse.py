"""Blocks of text in a web page: what stands in the article, what may be main text, and what its markup rules out.

The reader forgives what browsers forgive: unclosed and crossed elements, unquoted attributes, character references
without a semicolon, pages cut off anywhere, upper-case names. It reads a page once, in time linear in its length.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

_TAG = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*+>?"""
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")

# Element names of the HTML standard by what they mean here.
RAW = frozenset({"script", "style", "textarea", "title", "noframes", "noembed", "xmp", "iframe"})
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
RULED_OUT = frozenset(
    "head nav header footer aside form script style textarea title noframes noembed xmp iframe noscript template object"
    " applet svg math canvas audio video button select option optgroup datalist menu dialog input legend".split()
)
MAIN_ROLES = frozenset({"main", "article"})
RULED_OUT_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split()
)
# Names of classes and ids that templates give to what is not the article.
RULED_OUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu"
    " sidebar header masthead footer breadcrumb breadcrumbs pagination pager cookie cookies consent gdpr notice disclaimer"
    " newsletter subscribe subscription signup login share sharing social comment comments commentlist reply replies respond"
    " disqus related recommended recommendations popup modal overlay toolbar widget widgets copyright skip".split()
)
CONTENT_NAMES = frozenset(
    {"article", "articlebody", "article-body", "article-content", "post-content", "post-body", "entry-content", "story-body",
     "main-content", "maincontent", "page-content"}
)
_NEGATED = re.compile(r"^(?:has|with|without|no|is|js|show|hide)-")
_SEPARATED = re.compile(r"[-_]+")
# An element whose start ends an open one of these names without a container in between.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
         "option": ("option",)}
_LISTS = frozenset({"ul", "ol", "dl", "table", "menu", "select"})

#: Zones, from what is surely the article to what may be.
ARTICLE, MAIN, CONTENT, BODY = 0, 1, 2, 3


class Block(NamedTuple):
    """A block's words, with the places where inline markup begins or ends."""

    zone: int
    words: list[str]
    edges: list[int]


class _Open(NamedTuple):
    name: str
    zone: int
    out: bool


def _ruled_out_name(value: str) -> bool:
    for name in value.lower().split():
        if name in RULED_OUT_NAMES:
            return True
        if _NEGATED.match(name):
            continue
        parts = _SEPARATED.split(name)
        if len(parts) > 1 and (parts[0] in RULED_OUT_NAMES or parts[-1] in RULED_OUT_NAMES):
            return True
    return False


def _entered(name: str, rest: str, above: _Open) -> _Open:
    zone, out = above.zone, above.out or name in RULED_OUT
    if name == "article":
        zone = ARTICLE
    elif name == "main":
        zone = min(zone, MAIN)
    if rest and not rest.isspace():
        for key, *values in _ATTRIBUTE.findall(rest):
            key, value = key.lower(), html.unescape("".join(values))
            if key == "role":
                role = value.strip().lower()
                if role in MAIN_ROLES:
                    zone = min(zone, ARTICLE if role == "article" else MAIN)
                out = out or role in RULED_OUT_ROLES
            elif key in ("class", "id"):
                # the page as a whole is never ruled out by a name
                if name not in ("html", "body", "main") and _ruled_out_name(value):
                    out = True
                elif not CONTENT_NAMES.isdisjoint(value.lower().split()):
                    zone = min(zone, CONTENT)
            elif key == "itemprop" and "articleBody" in value.split():
                zone = ARTICLE
            elif key == "hidden" and name not in ("html", "body"):
                out = True
            elif key == "aria-hidden" and value.strip().lower() == "true":
                out = True
            elif key == "style" and "display:none" in value.lower().replace(" ", ""):
                out = True
    return _Open(name, zone, out)


def _named(match: re.Match) -> tuple[str, str, str]:
    if match["name"] is not None:
        return match["end"], match["name"].lower(), match["rest"]
    return match["end2"], match["name2"].lower(), match["rest2"]


def blocks(page: str | None) -> list[Block]:
    """Blocks with text that markup does not rule out, in page order. NULL and empty pages have none.

    Of a page with articles these are its articles' blocks; else those of its main part, of an element named as its
    content, or of the whole body, whichever comes first.
    """
    if not page:
        return []
    found: list[Block] = []
    stack = [_Open("", BODY, False)]
    open_names: Counter[str] = Counter()
    words: list[str] = []
    edges: list[int] = []
    glued = False  # does the next text continue the last word?

    def add(text: str) -> None:
        nonlocal glued
        if not text or stack[-1].out:
            return
        text = html.unescape(text)
        more = text.split()
        if not more:
            glued = False
            return
        if glued and words and not text[0].isspace():
            words[-1] += more[0]
            more = more[1:]
        words.extend(more)
        glued = not text[-1].isspace()

    def flush() -> None:
        nonlocal words, edges, glued
        if words:
            found.append(Block(stack[-1].zone, words, edges))
            words, edges = [], []
        glued = False

    def close(name: str) -> None:
        while True:
            gone = stack.pop()
            open_names[gone.name] -= 1
            if gone.name == name:
                return

    def close_implied(names: tuple[str, ...], barriers: frozenset[str]) -> None:
        """End the innermost open element of these names that no barrier shields, and all within it."""
        if not any(open_names[n] for n in names):
            return
        for entry in reversed(stack):
            if entry.name in names:
                close(entry.name)
                return
            if entry.name in barriers or not entry.name:
                return

    at = 0
    while at < len(page):
        match = _TAG.search(page, at)
        if match is None:
            add(page[at:])
            break
        add(page[at : match.start()])
        at = match.end()
        if match["cdata"] is not None:
            add(match["cdata"])
        if match["name"] is None and match["name2"] is None:
            continue
        end, name, rest = _named(match)
        if name in INLINE:
            if words and not stack[-1].out:
                edges.append(len(words))
            if name == "br":
                glued = False
        else:
            flush()
        if end:
            if name not in VOID and open_names[name]:
                close(name)
            continue
        if name in RAW:
            closing = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = closing.end() if closing else len(page)
            continue
        if name not in INLINE:
            close_implied(("p",), _BARRIERS)
            if name in _ENDS:
                close_implied(_ENDS[name], _LISTS)
        if name in VOID or rest.endswith("/") and name not in _BARRIERS and name != "p":
            continue
        stack.append(_entered(name, rest, stack[-1]))
        open_names[name] += 1
    flush()
    if not found:
        return []
    best = min(b.zone for b in found)
    return [b for b in found if b.zone == best]


_BARRIERS = frozenset(
    "html body article main section div nav header footer aside form table td th ul ol dl li dd dt blockquote figure"
    " fieldset details template object button".split()
)
