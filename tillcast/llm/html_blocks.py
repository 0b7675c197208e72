"""Web pages as sequences of text blocks with their place in the markup."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs2>[^>]*)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)|</(?:\Z|[^>]*>)|[^<]+|<", re.S)
NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
PART = re.compile(r"[a-z]+")

#: Fixed values of HTML: elements whose content is no text of the page, elements that never hold
#: content, and elements inside a line; every other element begins and ends a block.
HIDDEN = frozenset("script style head title noscript template svg iframe object select textarea datalist".split())
RAW = frozenset("script style textarea title template svg noscript iframe object select datalist".split())
#: Of these, the ones that take the rest of the page if they are never closed, as browsers read it;
#: an open one of the others hides nothing.
TO_THE_END = frozenset("script style textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
#: Elements that end an open one of the same kind.
ENDS_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
               "th": {"td", "th"}, "option": {"option"}}


@dataclass
class Block:
    path: tuple          # (tag, names) of the open elements, outermost first
    text: str
    linked: int          # characters of it inside links


def _names(attrs: str) -> tuple:
    if "=" not in attrs:
        return ()
    return tuple(p for m in NAMES.finditer(attrs) for p in PART.findall((m[1] or m[2] or m[3] or "").lower()))


def blocks(page: str) -> list[Block]:
    """The visible text blocks in page order: references decoded, white space inside a block one
    space, empty blocks left out.  Broken markup is read as far as it goes."""
    out: list[Block] = []
    stack: list[tuple] = []
    text: list[str] = []
    path: tuple = ()
    linked, links, at, n = 0, 0, 0, len(page)
    blank = True            # no text yet since the last block ended

    def flush():
        nonlocal linked, blank
        if text:
            t = " ".join("".join(text).split())
            if t:
                out.append(Block(path, t, min(linked, len(t))))
            text.clear()
        linked, blank = 0, True

    while at < n:
        m = TOKEN.match(page, at)
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if tag is None:
            token = m[0]
            if token[0] != "<" or token == "<":
                piece = html.unescape(token)
                if blank and piece.strip():
                    path, blank = tuple(x for x in stack if x[0] not in INLINE), False
                text.append(piece)
                if links:
                    linked += len(piece.strip())
            continue
        tag = tag.lower()
        inline = tag in INLINE
        if not inline:
            flush()
        elif tag == "br":
            text.append(" ")
            continue
        if m["close"] or m["close2"]:
            kinds = [x[0] for x in stack]
            if tag in kinds:
                k = len(kinds) - 1 - kinds[::-1].index(tag)
                # a stray end of a line element does not close the block around it
                if not inline or all(x in INLINE for x in kinds[k + 1:]):
                    links -= sum(x == "a" for x in kinds[k:])
                    del stack[k:]
            continue
        if tag in VOID:
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        if tag in RAW and not attrs.endswith("/"):
            end = re.compile(rf"</{tag}\b", re.I).search(page, at)
            at = end.start() if end else n if tag in TO_THE_END else at
            continue
        if tag == "head":
            end = re.compile(r"</head\b|<body\b", re.I).search(page, at)
            at = end.start() if end else at
            continue
        if not inline:
            kinds = [x[0] for x in stack]
            ends = {"p", *ENDS_ITSELF.get(tag, ())}
            k = len(kinds) - 1
            while k >= 0 and (kinds[k] in INLINE or kinds[k] in ends):
                k -= 1
            cut = next((i for i in range(k + 1, len(kinds)) if kinds[i] in ends), None)
            if cut is not None:
                links -= sum(x == "a" for x in kinds[cut:])
                del stack[cut:]
        if attrs.endswith("/") and not inline:
            continue
        stack.append((tag, _names(attrs)))
        links += tag == "a"
    flush()
    return out
