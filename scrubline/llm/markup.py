"""Reading one web page into the tokens and text blocks of its markup."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from dataclasses import dataclass, replace

import xxhash

# A comment, a declaration, or a tag with its attributes; a tag with an unclosed quote ends at ">".
_TAG = re.compile(
    r"<!--|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>?"
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# Elements whose content is not markup.
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that run within a block of text.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var".split()
)
# Elements that are never main text.
_CHROME = frozenset(
    "head nav footer aside form menu dialog noscript template select button svg math object canvas"
    " audio video map datalist fieldset".split()
)
# Class names, ids and roles that mark such elements, unless they hold the page's article.
_CHROME_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav"
    " navbar navigation menu breadcrumb breadcrumbs sidebar aside footer masthead comment comments disqus"
    " replies cookie cookies consent gdpr notice notices notification alert newsletter subscribe subscription"
    " signup login popup modal overlay share sharing social related recommended recommendations widget"
    " pagination pager toolbar search form complementary contentinfo".split()
)
# Those that also mark an element as part of a longer name (ad-slot, top_banner), but not behind a word
# like "with" or "no", which says what an element has.
_CHROME_PARTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav"
    " navbar menu breadcrumb breadcrumbs sidebar footer masthead comment comments disqus cookie cookies consent"
    " gdpr newsletter subscribe popup modal overlay share sharing related recommended recommendations widget"
    " pagination".split()
)
_SAYING = frozenset("no not non has have with without is".split())
_COMMENT_WORDS = frozenset("comment comments reply replies disqus".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that end an open paragraph, or an open element of their own kind.
_ENDS_OWN = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
_LISTS = frozenset("ul ol dl table".split())

CHROME, IN_ARTICLE, IN_MAIN = 1, 2, 4


@dataclass(frozen=True)
class Token:
    """A tag or a block of text: ``key`` is a hash of its place in the page, and of its text.

    ``name`` is the element that a tag opens, or that a text is in.
    """

    key: int
    name: str
    text: str | None
    flags: int
    link_chars: int = 0


@dataclass
class _Open:
    name: str
    path: int
    flags: int
    header: bool
    # The innermost marked element around it, by its number; 0 for none.
    mark: int = 0


@dataclass
class _Mark:
    """An element marked by a class name alone; ``kind`` is ``header``, ``comment`` or empty."""

    parent: int
    kind: str


def _names(attributes: str) -> list[str]:
    """Class names, ids and roles, each whole."""
    found = []
    for _, one, two, three in _ATTRIBUTE.findall(attributes):
        found += (one or two or three).lower().split()
    return found


def _linked(path: int, sign: str) -> int:
    """The hash of a place below another one. Places are chained by hashes, so deep pages stay small."""
    return xxhash.xxh3_64_intdigest(sign.encode("utf-8", "surrogatepass"), path)


# Names that a task has judged; a decorator's cache would not travel with the job.
_judged: dict[str, bool] = {}


def _is_chrome(name: str) -> bool:
    """Whether a class name, id or role marks an element as something else than text."""
    found = _judged.get(name)
    if found is None:
        parts = [part for part in re.split("[^a-z0-9]+", name) if part]
        longer = len(parts) > 1 and parts[0] not in _SAYING and not _CHROME_PARTS.isdisjoint(parts)
        if len(_judged) >= 4096:
            _judged.clear()
        found = _judged[name] = longer or name in _CHROME_WORDS
    return found


def _opened(name: str, names: list[str], above: _Open, marks: list[_Mark]) -> _Open:
    flags, header, mark = above.flags, above.header, above.mark
    if name == "body":
        flags, header, mark = flags & ~CHROME, False, 0
    marked = set(names)
    if name == "article":
        if any(re.split("[^a-z0-9]", n)[0] in _COMMENT_WORDS for n in names):
            flags |= CHROME
    elif name in _CHROME:
        flags |= CHROME
    elif name not in ("html", "body", "main") and ("header" in marked or any(map(_is_chrome, names))):
        of_comments = any(not _COMMENT_WORDS.isdisjoint(re.split("[^a-z0-9]+", n)) for n in names if _is_chrome(n))
        kind = "comment" if of_comments else "" if any(map(_is_chrome, names)) else "header"
        marks.append(_Mark(mark, kind))
        mark = len(marks) - 1
    if name == "header":
        header = True
    if name == "article":
        flags |= IN_ARTICLE
    if name == "main" or "main" in marked and "role" in marked:
        flags |= IN_MAIN
    words = [w for n in names for w in re.split(r"[^a-z0-9]+", n) if w]
    sign = ".".join([name, *words[:3]])
    return _Open(name, _linked(above.path, sign), flags, header, mark)


def _settled(tokens: list[Token], around: list[int], marks: list[_Mark]) -> list[Token]:
    """Tokens with CHROME in elements that a class name marks, but for those that hold the page's text.

    Without unmarked text in an article or main element, marked elements are freed from the outside
    in: those with a main element, with one article, or with more than half of the text. Comments
    are only freed for an article that is most of the text.
    """
    chars, articles, mains = ([0] * len(marks) for _ in range(3))
    framed = [False] * len(marks)
    for token, mark in zip(tokens, around, strict=True):
        if token.flags & CHROME:
            continue
        if token.text is not None:
            chars[mark] += len(token.text)
            framed[mark] |= bool(token.flags & (IN_ARTICLE | IN_MAIN))
        else:
            articles[mark] += token.name == "article"
            mains[mark] += token.name == "main"
    inner = defaultdict(list)
    held = framed.copy()
    for mark in range(len(marks) - 1, 0, -1):
        above = marks[mark].parent
        inner[above].append(mark)
        for sums in (chars, articles, mains):
            sums[above] += sums[mark]
        held[above] |= held[mark]
    freed, level = {0}, [0]
    while level and not any(framed[mark] for mark in level):
        found = []
        for mark in (m for above in level for m in inner[above]):
            most = 2 * chars[mark] > chars[0]
            if marks[mark].kind == "comment":
                good = most and held[mark]
            else:
                good = held[mark] and (mains[mark] or articles[mark] == 1) or most
            if good and (held[mark] or not held[0]):
                found.append(mark)
        freed.update(found)
        level = found
    settled = []
    for token, mark in zip(tokens, around, strict=True):
        if token.flags & IN_ARTICLE and token.text is not None:
            # Headings of an article's own header stay.
            while marks[mark].kind == "header" and token.name in _HEADINGS:
                mark = marks[mark].parent
        if mark not in freed:
            token = replace(token, flags=token.flags | CHROME)
        settled.append(token)
    return settled


def read(page: str | None) -> list[Token]:
    """Tags and text blocks in page order.

    Unclosed elements are closed as browsers do; scripts, styles and comments leave nothing. Block
    text has its character references decoded and white space runs made one blank.
    """
    page = page or ""
    tokens: list[Token] = []
    around: list[int] = []
    marks = [_Mark(0, "")]
    stack = [_Open("", 0, 0, False)]
    pieces: list[str] = []
    links, link_chars, pos = 0, 0, 0

    def flush() -> None:
        nonlocal link_chars
        text = "".join(pieces)
        pieces.clear()
        text = " ".join((html.unescape(text) if "&" in text else text).split())
        if text:
            top = stack[-1]
            flags = top.flags
            if top.header and not (flags & IN_ARTICLE and top.name in _HEADINGS):
                flags |= CHROME
            tokens.append(Token(_linked(top.path, f'"{text}'), top.name, text, flags, min(link_chars, len(text))))
            around.append(top.mark)
        link_chars = 0

    def close(names: tuple[str, ...]) -> None:
        while len(stack) > 1 and stack[-1].name in names:
            stack.pop()

    while True:
        match = _TAG.search(page, pos)
        if not match:
            pieces.append(page[pos:])
            break
        if match.start() > pos:
            pieces.append(page[pos : match.start()])
            if links:
                link_chars += match.start() - pos
        pos = match.end()
        if match[0] == "<!--":
            end = page.find("-->", pos)
            pos = len(page) if end < 0 else end + 3
            continue
        name = (match[2] or match[5] or "").lower()
        if not name:
            continue
        ending, attributes = match[1] or match[4], match[3] or match[6] or ""
        if not ending and name in _RAW:
            end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, pos)
            if not end:
                break
            pos = page.find(">", end.start())
            pos = len(page) if pos < 0 else pos + 1
            flush()
            continue
        if name == "a":
            links = 0 if ending else 1
        if name in _VOID:
            if name in ("br", "wbr"):
                pieces.append(" " if name == "br" else "")
            elif name == "hr":
                flush()
            continue
        if ending:
            if name in _INLINE and name not in {o.name for o in stack}:
                continue
            flush()
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if depth:
                del stack[depth:]
            continue
        names = _names(attributes) if "=" in attributes else []
        if name in _INLINE and not any(map(_is_chrome, names)):
            continue
        flush()
        if name not in _INLINE:
            close(("p",))
        if name in _ENDS_OWN:
            own = _ENDS_OWN[name]
            inner = len(stack) - 1
            while inner and stack[inner].name not in own and stack[inner].name not in _LISTS:
                inner -= 1
            if inner and stack[inner].name in own:
                del stack[inner:]
        if name == "body":
            del stack[1 if stack[1:2] and stack[1].name != "html" else 2 :]
        if name in ("article", "main") and "=" not in attributes:
            # An element of the page's frame that was never closed does not swallow the article.
            body = next((i for i, o in enumerate(stack) if o.name == "body"), 0)
            if any(o.name in ("nav", "footer", "header", "head") for o in stack[body:]):
                del stack[body + 1 :]
        opened = _opened(name, names, stack[-1], marks)
        if not attributes.rstrip().endswith("/"):
            stack.append(opened)
        tokens.append(Token(opened.path, name, None, opened.flags))
        around.append(opened.mark)
    flush()
    return _settled(tokens, around, marks) if len(marks) > 1 else tokens
