"""Blocks of text of a web page, each with the part of the page it stands in."""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

# Names of HTML elements by what they do, and words in attributes that tell parts of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup: it ends at their own end tag only.
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
UNSEEN = frozenset("head script style title template textarea iframe noembed noframes noscript object svg math canvas audio video select datalist button".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
ASIDE = frozenset("nav footer aside form dialog menu search".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense alert banner promo promotion sponsor sponsored cookie cookies consent copyright disclaimer form gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup login share sharing social nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar sidebars rail widget widgets related recommended recommendations footer masthead search toolbar skip".split()
)
REMARK_WORDS = frozenset("comment comments disqus reply replies respond".split())
ARTICLE_WORDS = frozenset(("articlebody", "article-body", "article-content", "article-text", "entry-content", "post-content", "post-body", "page-content", "main-content", "story-body"))
ARTICLE_NAMES = frozenset("article content main post entry story".split())

#: Where a block stands: in the article, in a part that is none of it, or where the markup doesn't say.
ARTICLE, BESIDE, OPEN = 1, 2, 0

#: Elements that end an open one of the given names, unless one of the fences was opened since.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")}
FENCES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr")}

_TAG = re.compile(r"<!--(?:>|->)?|<!\[CDATA\[|<[!?]|</?([A-Za-z][^\s/>]*)")
_REST = re.compile(r"""(?:[^>"']|"[^"]*"|'[^']*')*+>""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.I)
_WORD = re.compile(r"[a-z0-9]+")


class _Open(NamedTuple):
    """An open element: its part, whether it stands in an article's header, and where in the stack the block around it
    and the outermost element beside the article are (0: none)."""

    name: str
    part: int
    header: bool
    block: int
    beside: int


def _tokens(html: str):
    """(kind, name, text) from left to right: text, start and end tags. Linear: no place is looked at again and again."""
    at, end = 0, len(html)
    while at < end:
        m = _TAG.search(html, at)
        if m is None:
            yield "text", "", html[at:]
            return
        if m.start() > at:
            yield "text", "", html[at : m.start()]
        at, said = m.end(), m.group()
        if said.startswith("<!--"):
            close = html.find("-->", at) if said == "<!--" else at - 3
            at = end if close < 0 else close + 3
        elif said == "<![CDATA[":
            close = html.find("]]>", at)
            yield "text", "", html[at : close if close >= 0 else end]
            at = end if close < 0 else close + 3
        elif said in ("<!", "<?"):
            close = html.find(">", at)
            at = end if close < 0 else close + 1
        else:
            name, rest = m.group(1).lower(), _REST.match(html, at)
            close = rest.end() if rest else html.find(">", at) + 1  # a quote that never ends: the first bracket counts
            if not close:
                return  # the page ends inside a tag
            inside, at = html[at : close - 1], close
            if said.startswith("</"):
                yield "end", name, ""
            else:
                yield "start", name, inside
                if name in RAW:
                    done = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(html, at) if name != "plaintext" else None
                    at = done.start() if done else end


def _part(name: str, attributes: str, inside: int) -> int:
    """The part of the page that an element opens, given the one it stands in."""
    if name in UNSEEN:
        return BESIDE
    found = {k.lower(): (a or b or c).lower() for k, a, b, c in _ATTRIBUTE.findall(attributes)} if attributes else {}
    names = f"{found.get('class', '')} {found.get('id', '')}"
    words = set(_WORD.findall(names))
    role = found.get("role", "")
    if words & REMARK_WORDS and name not in ("body", "html", "main"):
        return BESIDE
    if name == "main" or role == "main" or name == "article" or role == "article" or found.get("itemprop") == "articlebody":
        return ARTICLE
    if name in ASIDE or role in ASIDE_ROLES or ((name == "header" or "header" in words) and name not in ("body", "html") and inside != ARTICLE):
        return BESIDE
    if name in ("body", "html"):
        return inside
    if words & ASIDE_WORDS:
        return BESIDE
    if inside == OPEN and (set(names.split()) & (ARTICLE_WORDS | ARTICLE_NAMES)) and name in ("div", "section", "td"):
        return ARTICLE
    return inside


def blocks(html: str) -> list[tuple[int, str]]:
    """(part, text) of a page's blocks in order: character references decoded, white space made single, none empty.

    A block ends where an element of ``BLOCKS`` starts or ends. Unclosed elements end where HTML ends them: a paragraph at
    the next block, a list item at the next one, anything at the end tag of what holds it; an end tag of nothing open is
    skipped. In a header inside the article only headings belong to it. An article or main that starts in a nav, header,
    footer or form which nothing has closed ends that.
    """
    out: list[tuple[int, str]] = []
    pieces: dict[int, list[str]] = {}
    stack = [_Open("", OPEN, False, 0, 0)]
    places: dict[str, list[int]] = {}  # where in the stack elements of a name are open

    def flush() -> None:
        for part, said in pieces.items():
            text = " ".join("".join(said).split())
            if text:
                out.append((part, text))
        pieces.clear()

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            places[stack.pop().name].pop()

    def last(*names: str) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    for kind, name, text in _tokens(html):
        if kind == "text":
            if stack[-1].name not in UNSEEN:
                pieces.setdefault(stack[-1].part, []).append(unescape(text))
            continue
        block = name in BLOCKS
        if block:
            flush()
        elif name == "br":
            pieces.setdefault(stack[-1].part, []).append(" ")
        if kind == "end":
            k = last(name)
            if k and (block or k > stack[-1].block):  # an inline end tag doesn't reach out of its block
                pop_to(k)
            continue
        if name in VOID:
            continue
        if block and last("head"):
            pop_to(last("head"))
        if block and last("p") and last("p") == stack[-1].block:
            pop_to(last("p"))
        if name in ENDS:
            k = last(*ENDS[name])
            if k > last(*FENCES[name]):
                pop_to(k)
        if name in ("article", "main") and stack[stack[-1].beside].name in ("nav", "header", "footer", "form") and not last("aside", "dialog"):
            pop_to(stack[-1].beside)
        top = stack[-1]
        header = top.header
        if top.part == BESIDE:
            part = ARTICLE if header and name in HEADINGS else BESIDE
        else:
            part = _part(name, text, top.part)
            if name == "header" and part == top.part == ARTICLE:
                part, header = BESIDE, True
        at = len(stack)
        stack.append(_Open(name, part, header, at if block else top.block, (top.beside or at) if part == BESIDE else 0))
        places.setdefault(name, []).append(at)
    flush()
    return out
