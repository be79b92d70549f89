"""A page as a sequence of leaf blocks: the text between two borders of block elements, and the path of open tags around it."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# Elements that begin and end a block.
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
 h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul""".split())
# Elements without content; elements whose content is no markup; elements whose text is not read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript".split())
UNREAD = frozenset("button select option datalist template svg math canvas audio video object head".split())
# An element that begins ends an open one of these, if no element of the second kind lies between.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "body": ({"head"}, set()), "tbody": ({"thead", "tbody"}, {"table"}), "tfoot": ({"thead", "tbody"}, {"table"})}
# A tag with a quote left open is read on to the closing quote, within so many characters.
MAX_ATTRIBUTE = 4_000
# Open elements that are kept; what is nested deeper counts as text of the last of them.
MAX_DEPTH = 400

TAG = re.compile(r"<(?:!--|(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[!?/][^>]*>)")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""")
NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]  # features of the open elements, outermost first
    linked: int            # letters of the text within links
    label: str | None      # for training pages: what data-keep of the nearest element says


def _features(name: str, attributes: str) -> tuple[tuple[str, ...], str | None]:
    """What is known of an element: its tag, and the words of its class, id, role and itemprop."""
    out, keep = [f"t:{name}"], None
    if "=" in attributes:
        for key, value in ATTRIBUTE.findall(attributes):
            key = key.lower()
            if key in ("class", "id", "role", "itemprop"):
                out.extend(f"c:{w.lower()}" for w in NAMES.findall(value)[:12])
            elif key == "data-keep":
                keep = value.strip("\"'")
    return tuple(out), keep


def _tag_end(page: str, start: int, end: int) -> int:
    """Where a tag ends that holds a quote: after the ``>`` behind its closing quote, if that is near."""
    quote = before = ""
    for at in range(start, min(len(page), start + MAX_ATTRIBUTE)):
        ch = page[at]
        if quote:
            quote = "" if ch == quote else quote
        elif ch in "\"'" and before == "=":
            quote = ch
        elif ch == ">":
            return at + 1
        before = before if ch.isspace() else ch
    return end


class _Reader:
    def __init__(self):
        self.open: list[tuple[str, tuple[str, ...], str | None]] = []
        self.blocks: list[Block] = []
        self.runs: list[str] = []
        self.linked = 0
        self.unread = self.links = 0

    def text(self, run: str) -> None:
        if self.unread or not run:
            return
        if "&" in run:
            run = html.unescape(run)
        self.runs.append(run)
        if self.links:
            self.linked += len(run)

    def border(self) -> None:
        """End the block that is being read."""
        if self.runs:
            text = " ".join("".join(self.runs).split())
            if text:
                keep = next((k for _, _, k in reversed(self.open) if k is not None), None)
                self.blocks.append(Block(text, tuple(f for _, own, _ in self.open for f in own), min(self.linked, len(text)), keep))
            self.runs, self.linked = [], 0

    def pop(self) -> None:
        name = self.open.pop()[0]
        self.unread -= name in UNREAD
        self.links -= name == "a"

    def close_to(self, place: int) -> None:
        while len(self.open) > place:
            self.pop()

    def start(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self.border()
            for place in range(len(self.open) - 1, -1, -1):  # a paragraph ends where a block begins
                if self.open[place][0] in BLOCKS:
                    if self.open[place][0] == "p":
                        self.close_to(place)
                    break
        elif name == "a" and self.links:  # a link does not hold another one
            self.end("a")
        if name in ENDS:
            ended, within = ENDS[name]
            for place in range(len(self.open) - 1, -1, -1):
                if self.open[place][0] in ended:
                    self.close_to(place)
                    break
                if self.open[place][0] in within:
                    break
        if name == "br":
            self.text(" ")
        if name in VOID or len(self.open) >= MAX_DEPTH:
            return
        self.open.append((name, *_features(name, attributes)))
        self.unread += name in UNREAD
        self.links += name == "a"

    def end(self, name: str) -> None:
        block = name in BLOCKS
        if block:
            self.border()
        for place in range(len(self.open) - 1, -1, -1):
            if self.open[place][0] == name:
                self.close_to(place)
                return
            if not block and self.open[place][0] in BLOCKS:
                return


def read_blocks(page: str | None) -> list[Block]:
    """All blocks with text, in page order. Broken markup is read as far as it goes; a null page has none."""
    page = page or ""
    reader, at, last = _Reader(), 0, page.rfind(">") + 1
    ended: set[str] = set()  # raw elements that are not closed any more: looked for once only
    while at < last:
        tag = TAG.search(page, at, last)
        if not tag:
            break
        reader.text(page[at:tag.start()])
        at = tag.end()
        if tag[0] == "<!--":
            stop = page.find("-->", at)
            at = stop + 3 if stop >= 0 else len(page)
            continue
        if not tag[2]:
            continue
        name, attributes = tag[2].lower(), tag[3]
        if tag[1]:
            reader.end(name)
            continue
        if attributes.count('"') % 2 or attributes.count("'") % 2:
            at = _tag_end(page, tag.start(3), at)
            attributes = page[tag.start(3):at - 1]
        if name in RAW and not attributes.endswith("/"):
            stop = None if name in ended else re.compile(rf"</{name}\b", re.I).search(page, at)
            if stop is None:
                ended.add(name)
                if name in ("script", "style", "textarea", "xmp", "iframe"):
                    at = len(page)
            else:
                at = stop.start()
            continue
        reader.start(name, attributes)
    if at < len(page):
        # What follows the last tag is text, but for a tag that was cut off.
        rest = page[at:]
        cut = re.search(r"<[a-zA-Z/!]", rest)
        reader.text(rest[:cut.start()] if cut else rest)
    reader.border()
    return reader.blocks
