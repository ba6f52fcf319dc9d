"""Blocks of a web page: leaf texts with the path of tags above them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# Tags that start a block of their own, and tags without an end.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody "
    "td tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Content that is never text and never markup; left open, it takes the rest of the page.
_RAW = "script|style|template|textarea"
#: Elements whose content is not shown: everywhere, and within drawings and formulas.
_HIDDEN = frozenset(["iframe"])
_HIDDEN_IN = {"svg": frozenset(["title", "desc", "metadata"]), "math": frozenset(["annotation", "annotation-xml"])}
_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b(?:"[^"]*"|'[^']*'|[^>"'])*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:"[^"]*"|'[^']*'|[^>"'])*)>""",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[a-z]+")
_SPACE = re.compile(r"[ \t\n\r\f\v]+")
#: An open element of the key is ended by a new one of the values.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}


@dataclass
class Block:
    """``path``: names on the way down, each a tag or a word of its class, id or role."""

    text: str
    path: tuple[str, ...]
    linked: float


def blocks(page: str) -> list[Block]:
    """All blocks with text, in page order; broken markup never fails.

    Formulas, drawings, embedded objects and what stands in for scripts are
    inline text of their block.  An element left open ends with its parent; a
    block inside a drawing or formula ends that.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    text: list[str] = []
    linked, links, hidden = 0, 0, 0

    def conceals(tag: str) -> bool:
        return tag in _HIDDEN or any(tag in inner and any(t == outer for t, _ in stack) for outer, inner in _HIDDEN_IN.items())

    def flush() -> None:
        nonlocal linked
        if text:
            plain = _SPACE.sub(" ", html.unescape("".join(text))).strip(" ")
            if plain:
                out.append(Block(plain, tuple(n for _, names in stack for n in names), min(1.0, linked / len(plain))))
            text.clear()
        linked = 0

    def pop_to(at: int) -> None:
        nonlocal links, hidden
        links -= sum(t == "a" for t, _ in stack[at:])
        hidden -= sum(bool(names) and names[0] == "" for _, names in stack[at:])
        del stack[at:]

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at and not hidden:
            piece = page[at : m.start()]
            text.append(piece)
            linked += len(piece) if links else 0
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            text.append(" ")
            continue
        concealed = conceals(tag)
        boundary = tag in BLOCK_TAGS and not concealed
        if boundary:
            flush()
        if m["close"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    pop_to(i)
                    break
            continue
        if boundary:
            for i, (open_, _) in enumerate(stack):
                if open_ in _HIDDEN_IN:
                    pop_to(i)
                    break
            for i in range(len(stack) - 1, -1, -1):
                open_ = stack[i][0]
                if open_ == "p" or tag in _ENDS.get(open_, ()):
                    pop_to(i)
                    break
                if open_ in BLOCK_TAGS:
                    break
        if tag in VOID_TAGS or m["attrs"].endswith("/") and tag not in BLOCK_TAGS:
            continue
        names = [tag]
        if "=" in m["attrs"]:
            for values in _NAMES.findall(m["attrs"]):
                names += _PART.findall("".join(values).lower())
        links += tag == "a"
        hidden += concealed
        stack.append((tag, ("", *names) if concealed else tuple(names)))
    if at < len(page) and not hidden:
        text.append(page[at:])
    flush()
    return out
