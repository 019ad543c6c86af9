"""An HTML page as its sequence of text blocks, each with the path of tags above it."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from typing import NamedTuple

# How HTML groups its elements.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s "
    "samp small span strike strong sub sup time tt u var wbr "
    # A formula is part of its sentence.
    "math annotation maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom "
    "mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder "
    "munderover semantics".split()
)
# Their content is no text of the page, up to the end of the page if nothing closes them.
RAW = frozenset(("script", "style"))
# Nor is theirs, but what nothing closes hides nothing.
HIDDEN = frozenset("template svg iframe noembed noframes".split())
# An opening tag of the first kind ends the open element of the second.
_SELF_CLOSING = frozenset("li dt dd tr td th option p".split())
_ENDS_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main nav ol p pre section table ul".split()
)

# A ">" within quotes ends no tag, unless a quote is never closed.
_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)>""",
    re.S,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[a-z]+|\d+")


# A path holds so many of the innermost elements; what lies further out says no more.
DEEPEST = 24


class Block(NamedTuple):
    text: str
    path: tuple[str, ...]  # tag names, and the words of class, id and role after a dot
    link_share: float


def _names(name: str, attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return (name,)
    words = (x for found in _NAMES.findall(attributes) for x in found if x)
    return (name, *("." + part for word in words for part in _PART.findall(word.lower())))


def _hidden(html: str, name: str, end: int) -> dict[int, int]:
    """Where the content of each element of this name begins and where its closing tag ends."""
    tags = re.compile(
        r"<!--.*?(?:-->|\Z)|<script(?=[\s/>]).*?(?:</script\b|\Z)|<style(?=[\s/>]).*?(?:</style\b|\Z)|"
        rf"""<(/?){name}(?=[\s/>])((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)>""",
        re.S | re.I,
    )
    found, opened = {}, []
    for tag in tags.finditer(html, 0, end):
        if tag[1]:
            if opened:
                found[opened.pop()] = tag.end()
        elif tag[1] is not None and not (name == "svg" and tag[2].endswith("/")):
            opened.append(tag.end())
    return found


def blocks(html: str | None) -> list[Block]:
    """The blocks of a page in order, those without text left out.

    Character references are decoded and white space within a block is one space. An element
    left open ends with the one around it, and a closing tag that nothing opened is ignored.
    Scripts, styles, comments, drawings, templates and frames are no text; all else is.
    """
    html = html or ""
    out: list[Block] = []
    open_names: list[str] = []
    open_paths: list[tuple[str, ...]] = []
    times: Counter[str] = Counter()
    pieces: list[str] = []
    linked = links = 0
    hidden: dict[str, dict[int, int]] = {}

    def end_block() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(pieces)).split())
        if text:
            path = tuple(name for names in open_paths[-DEEPEST:] for name in names)
            out.append(Block(text, path, min(1.0, linked / len(text))))
        pieces.clear()
        linked = 0

    def close(name: str) -> None:
        nonlocal links
        while open_names:
            last = open_names.pop()
            open_paths.pop()
            times[last] -= 1
            links -= last == "a"
            if last == name:
                break

    at, last = 0, html.rfind(">")
    while at <= last and (found := _TAG.search(html, at)):
        if found.start() > at:
            piece = html[at:found.start()]
            pieces.append(piece)
            if links:
                linked += len(piece)
        at = found.end()
        name = found[2]
        if not name:
            continue
        name = name.lower()
        if found[1]:
            if name not in INLINE:
                end_block()
            if times[name]:
                close(name)
            continue
        if name in HIDDEN:
            if name not in hidden:
                hidden[name] = _hidden(html, name, last + 1)
            at = hidden[name].get(at, at)
            continue
        if name in RAW:
            closing = re.compile(rf"</{name}\b[^>]*>", re.I).search(html, at)
            at = closing.end() if closing else len(html)
            continue
        if name not in INLINE:
            end_block()
            if name in _ENDS_P and times["p"]:
                close("p")
            elif name in _SELF_CLOSING and open_names and open_names[-1] == name:
                close(name)
        if name not in VOID and not found[3].endswith("/"):
            open_names.append(name)
            open_paths.append(_names(name, found[3]))
            times[name] += 1
            links += name == "a"
    pieces.append(html[at:])
    if links:
        linked += len(html) - at
    end_block()
    return out
