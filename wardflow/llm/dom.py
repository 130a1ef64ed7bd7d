"""Leaf blocks of HTML pages.

A leaf block is the text between two tags that start or end a block, with the elements
around it. Elements are followed on a stack with the usual implied ends (a paragraph ends
where a block starts, a list item at the next one); end tags without a start are ignored.
What no reader sees as text (scripts, styles, titles, form controls' values, graphics,
comments, declarations) makes no block.

The elements around a block are kept as a set of cues: tags, and the words of class, id and
role attributes. Sets are numbered and shared between blocks and pages, so elements
nested any number of times cost no more than one.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from typing import NamedTuple

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|</(?![A-Za-z]|\Z)[^>]*+(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(
    r"(?:^|[\s/\"'])(class|id|role|style)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Elements of HTML, by what they do to text.
BLOCKS = frozenset((
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html label legend li main "
    "menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul"
).split())
ENDS_PARAGRAPH = BLOCKS - frozenset("button caption label legend option optgroup td th tr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset((
    "audio canvas datalist head iframe math noembed noframes noscript object script select style svg "
    "template textarea title video xmp"
).split())
# Unseen elements whose end may not be left out; without it the rest of the page is theirs.
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
# An element of the key ends an open one of the first set, if none of the second is in between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"datalist", "select"}),
}
LATER_SETS = 100_000


class Block(NamedTuple):
    text: str
    linked: int
    tag: str
    cues: int


class Cues:
    """Numbered sets of cues; with ``known`` only those matter."""

    def __init__(self, known=None):
        self.known = known
        self.clear()

    def clear(self) -> None:
        self.sets: list[frozenset[str]] = [frozenset()]
        self.numbers: dict[frozenset[str], int] = {frozenset(): 0}
        self.steps: dict[tuple[int, str, str], int] = {}

    def below(self, outer: int, tag: str, attributes: str) -> int:
        """Number of the set inside an element."""
        found = self.steps.get((outer, tag, attributes))
        if found is None:
            new = {f"t:{tag}"}
            hidden = False
            for name, *values in ATTRIBUTE.findall(attributes):
                value = unescape("".join(values))
                if name.lower() == "style":
                    hidden = hidden or HIDDEN.search(value)
                else:
                    new.update(f"k:{w.lower()}" for w in WORD.findall(value))
            if hidden or re.search(r"\shidden(?![\w-])", attributes, re.I):
                new.add("k:hidden")
            if self.known is not None:
                new &= self.known
            whole = self.sets[outer] | new
            found = self.numbers.get(whole)
            if found is None:
                found = self.numbers[whole] = len(self.sets)
                self.sets.append(whole)
            self.steps[outer, tag, attributes] = found
        return found


def skip(html: str, at: int, tag: str) -> int:
    """Where the contents and end tag of an unseen element are over."""
    end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I).search(html, at)
    return end.end() if end else len(html) if tag in RAW else at


def blocks_of(html: str, cues: Cues) -> list[Block]:
    """Leaf blocks of a page that have a text, in order."""
    out: list[Block] = []
    # Open elements: name, cues, and the place of the block around it.
    stack: list[tuple[str, int, int]] = [("html", 0, 0)]
    opened: Counter = Counter()
    runs: list[str] = []
    linked, link_from = 0, 0
    missing: set[str] = set()

    def flush() -> None:
        nonlocal linked
        if runs:
            text = " ".join("".join(runs).split())
            if text:
                tag, inside, _ = stack[stack[-1][2]]
                out.append(Block(text, min(linked, len(text)), tag, inside))
            runs.clear()
            linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        text = unescape(raw) if "&" in raw else raw
        runs.append(text)
        if link_from:
            linked += len(text)

    def close(place: int) -> None:
        nonlocal link_from
        for name, _, _ in stack[place:]:
            opened[name] -= 1
        del stack[place:]
        if link_from > len(stack):
            link_from = 0

    at = 0
    while True:
        token = TOKEN.search(html, at)
        if token is None:
            say(html[at:])
            break
        if token.start() > at:
            say(html[at:token.start()])
        at = token.end()
        name = token[2] or token[5]
        if name is None:
            continue
        name = name.lower()
        attributes = token[3] or token[6] or ""
        if token[1] or token[4]:
            if name in BLOCKS:
                flush()
            if name == "a":
                link_from = 0
            if opened[name] <= 0:
                continue
            # An inline element does not end a block that began in it.
            least = stack[-1][2] + 1 if name not in BLOCKS else 1
            place = len(stack) - 1
            while place >= least and stack[place][0] != name:
                place -= 1
            if place >= least:
                close(place)
            continue
        if name in UNSEEN and not attributes.rstrip().endswith("/") and name not in missing:
            after = skip(html, at, name)
            if after == at:
                missing.add(name)
            if name == "noscript" or name in RAW or after > at:
                at = after
                continue
        if name == "br":
            runs.append(" ")
            continue
        if name in BLOCKS:
            flush()
            around = stack[-1][2]
            if name in ENDS_PARAGRAPH and stack[around][0] == "p":
                close(around)
            elif name in ENDS:
                ends, limits = ENDS[name]
                while around and stack[around][0] not in ends and stack[around][0] not in limits:
                    around = stack[around - 1][2]
                if around and stack[around][0] in ends:
                    close(around)
        if name in VOID or name in UNSEEN:
            continue
        place = len(stack)
        # Links differ in their targets only, and say nothing about what is around them.
        inside = cues.below(stack[-1][1], name, "" if name == "a" else attributes)
        stack.append((name, inside, place if name in BLOCKS else stack[-1][2]))
        opened[name] += 1
        if name == "a":
            link_from = place + 1
    flush()
    return out
