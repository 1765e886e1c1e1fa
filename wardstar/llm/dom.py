"""Leaf blocks of HTML: runs of text between block-level tags, with the tags and names above them.

A quote opens a value only after ``=`` and only where it is closed later; else
it is an ordinary character and the tag ends at the next ``>``.  Blocks share
the places they have in common, so time and memory grow with the page and not
with its depth (but for names that are new at every level).
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass
from typing import NamedTuple

#: Tags of HTML by how they take part in the text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label map mark nobr output picture q rp rt ruby s samp small source span strike "
    "strong sub sup time tt u var wbr noscript object "
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder mover munderover mmultiscripts "
    "mprescripts none mtable mtr mlabeledtr mtd maction semantics annotation annotation-xml".split()
)
RAW = frozenset("script style title textarea".split())  # text up to their end tag, without one to the end of the page
NESTED = frozenset("template iframe svg canvas audio video select".split())  # without an end tag ordinary content
DROPPED = RAW | NESTED | {"head"}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag ends an open element of these (a paragraph ends at any block).
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"), "option": ("option",),
}
#: An element of these is a boundary for what an opening tag may end.
SCOPES = frozenset("ul ol dl table body html article section div nav aside footer header main form".split())

# searched up to the last ">" only, so that what begins like a tag is one; never tries a character twice
_TAG = re.compile(r"""<(?:!--(?:.*?-->|.*)|[!?][^>]*>|(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:"[^"]*"|'[^']*')|[^>=]++|=)*+)>)""", re.DOTALL)
_NAME = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
_TOKEN = re.compile(r"[a-z]+")
_ENDS = {t: re.compile(rf"</{t}\s*>", re.IGNORECASE) for t in RAW}
_HEAD_END = re.compile(r"</head\s*>|(?=<body[\s>])", re.IGNORECASE)
_UNENDED = re.compile(r"<[a-zA-Z/!]")  # what begins a tag


@dataclass(slots=True, eq=False)
class Place:
    """An open element: its tag and names, the place above, and all tags and names from the root down to it."""

    tag: str
    words: tuple[str, ...]
    above: Place | None
    all_tags: frozenset[str]
    all_words: frozenset[str]

    @classmethod
    def below(cls, above: Place | None, tag: str, words: tuple[str, ...]) -> Place:
        tags, named = (above.all_tags, above.all_words) if above else (frozenset(), frozenset())
        return cls(tag, words, above, tags if tag in tags else tags | {tag}, named if named.issuperset(words) else named.union(words))


class Block(NamedTuple):
    text: str
    place: Place | None
    linked: int  # characters inside links

    def _places(self) -> list[Place]:
        out, place = [], self.place
        while place:
            out.append(place)
            place = place.above
        return out[::-1]

    @property
    def path(self) -> tuple[str, ...]:
        """Tags from the root down."""
        return tuple(p.tag for p in self._places())

    @property
    def names(self) -> tuple[str, ...]:
        """Words of classes, ids and roles on the path."""
        return tuple(n for p in self._places() for n in p.words)


def _next_tag(page: str, at: int, last: int) -> tuple[re.Match | None, int]:
    """The next tag or comment and where it ends; ``last`` is where the last ``>`` ends."""
    match = _TAG.search(page, at, last)
    if match and match[0].startswith("<!--") and not match[0].endswith("-->"):
        return match, len(page)  # a comment without its end
    return match, match.end() if match else at


def _ends(page: str) -> dict[int, int]:
    """Where the elements of ``NESTED`` that have an end tag end, by the place after their opening tag."""
    out: dict[int, int] = {}
    opened: dict[str, list[int]] = {t: [] for t in NESTED}
    at, last = 0, page.rfind(">") + 1
    while (found := _next_tag(page, at, last))[0]:
        match, at = found
        tag = (match[2] or "").lower()
        if tag in RAW and not match[1] and not match[3].rstrip().endswith("/"):
            end = _ENDS[tag].search(page, at)
            at = end.end() if end else len(page)
        elif tag in NESTED:
            if match[1]:
                if opened[tag]:
                    out[opened[tag].pop()] = at
            elif not match[3].rstrip().endswith("/"):
                opened[tag].append(at)
    return out


def leaf_blocks(page: str | None) -> list[Block]:
    """Blocks with text, in page order; malformed markup is read as far as it goes."""
    out: list[Block] = []
    if not page:
        return out
    stack: list[Place] = []
    opened: Counter[str] = Counter()  # of the stack
    parts: list[str] = []
    linked, in_link, at, last = 0, False, 0, page.rfind(">") + 1
    no_head_end = False
    ends: dict[int, int] | None = None

    def flush() -> None:
        nonlocal linked, in_link
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, stack[-1] if stack else None, linked))
            parts.clear()
        linked, in_link = 0, False

    def say(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if in_link:
                linked += len(text.strip())

    def leave(i: int) -> None:
        opened.subtract(p.tag for p in stack[i:])
        del stack[i:]

    while (found := _next_tag(page, at, last))[0]:
        say(page[at : found[0].start()])
        match, at = found
        tag = (match[2] or "").lower()
        if not tag:
            continue
        closing = bool(match[1])
        if tag in INLINE:
            if tag == "a":
                in_link = not closing
            elif tag == "br":
                parts.append(" ")
            continue
        if tag in DROPPED:
            if not closing and not match[3].rstrip().endswith("/"):
                if tag == "head":  # a head without its end lasts until the body
                    end = None if no_head_end else _HEAD_END.search(page, at)
                    no_head_end = end is None
                    at = end.end() if end else at
                elif tag in RAW:
                    end = _ENDS[tag].search(page, at)
                    at = end.end() if end else len(page)
                else:
                    ends = _ends(page) if ends is None else ends
                    at = ends.get(at, at)
            continue
        flush()
        if closing:
            if opened[tag] > 0:
                leave(next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag))
            continue
        ended = CLOSES.get(tag, ())
        if opened["p"] > 0 or any(opened[t] > 0 for t in ended):
            for i in range(len(stack) - 1, -1, -1):
                open_ = stack[i].tag
                if open_ == "p" or open_ in ended:
                    leave(i)
                elif open_ in SCOPES:
                    break
        if tag not in VOID and not match[3].rstrip().endswith("/"):
            names: tuple[str, ...] = ()
            if match[3]:
                words = []
                for name, *values in _NAME.findall(match[3]):
                    value = "".join(values).lower()
                    name = name.lower()
                    if name in ("class", "id", "role"):
                        words += _TOKEN.findall(value)
                    elif name in ("hidden", "aria-hidden") and value != "false" or "display:none" in value.replace(" ", ""):
                        words.append("hidden")
                names = tuple(words)
            stack.append(Place.below(stack[-1] if stack else None, tag, names))
            opened[tag] += 1
    cut = _UNENDED.search(page, at)
    say(page[at : cut.start()] if cut else page[at:])
    flush()
    return out
