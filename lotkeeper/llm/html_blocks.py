"""Pages as sequences of leaf blocks: text with the path of elements around it.

A forgiving reader: unknown tags, unclosed elements and cut-off pages are read as far as they go. Elements
that lay out text in lines end a block; inline ones do not. Scripts, styles, comments and the head have no text.
A head ends where something starts that cannot stand in it. Formulas and the content for readers without scripts,
plug-ins or drawing are text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

SKIPPED = {"script", "style", "template", "svg", "iframe", "head", "title"}
RAW = {"script", "style", "title", "iframe", "template", "textarea"}
#: What may start inside a head without ending it.
IN_HEAD = {"title", "meta", "link", "base", "script", "style", "noscript", "template", "html", "head"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr", "mspace"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong",
          "sub", "sup", "time", "tt", "u", "var", "img", "input", "wbr", "object", "canvas", "math", "mi", "mn", "mo", "ms",
          "mtext", "mrow", "mfrac", "msup", "msub", "msubsup", "msqrt", "mroot", "mstyle", "mover", "munder", "munderover",
          "mpadded", "mphantom", "menclose", "mtable", "mtr", "mtd", "semantics", "annotation", "mspace"}
#: Elements that end an open one of the same kind, and the elements this does not reach beyond.
ENDED = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}, "option": {"option"}}
FENCES = {"table", "ul", "ol", "dl", "select", "td", "th", "button", "article", "section", "div", "body", "form"}
_PARTS = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|[^<]+|<", re.S)
#: A tag whose quotes never end goes to the next bracket; where no bracket follows, no tag does.
_OPEN_QUOTE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_TEXT = re.compile(r"[^<]+|<")
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]  # tags and their class, id and role words, outermost first
    linked: int  # characters inside links


def _comment_or_text(source: str, at: int) -> re.Match | None:
    return _PARTS.match(source, at) if source.startswith(("<!", "<?"), at) else _TEXT.match(source, at)


def read_blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page in order; none for null. Text keeps one space for any run of blanks."""
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    held: Counter[str] = Counter()  # open elements by tag
    text: list[str] = []
    state = {"linked": 0, "link": 0, "skip": 0}

    def end_block():
        words = " ".join("".join(text).split())
        text.clear()
        if words:
            blocks.append(Block(words, tuple(x for tag, own in stack if tag not in INLINE for x in own), state["linked"]))
        state["linked"] = 0

    def pop():
        tag, _ = stack.pop()
        held[tag] -= 1
        state["link"] -= tag == "a"
        state["skip"] -= tag in SKIPPED

    def end_head():
        while held["head"]:
            pop()

    source, at = page or "", 0
    closes = source.rfind(">")
    while True:
        found = _PARTS.match(source, at) if at <= closes else _comment_or_text(source, at)
        if not found:
            break
        if found.end() == at + 1 and at < closes and source[at] == "<":
            found = _OPEN_QUOTE.match(source, at) or found
        at = found.end()
        closing, tag, rest = found.groups() if found.re.groups else (None, None, None)
        if tag is None:
            part = found.group()
            if part[0] != "<" or part == "<":
                if stack and stack[-1][0] in ("head", "noscript") and part.strip():
                    end_head()
                if not state["skip"]:
                    piece = html.unescape(part)
                    text.append(piece)
                    state["linked"] += len(piece) if state["link"] else 0
            continue
        tag = tag.lower()
        if closing:
            if held[tag]:
                if tag not in INLINE:
                    end_block()
                while True:
                    last = stack[-1][0]
                    pop()
                    if last == tag:
                        break
            continue
        if tag not in IN_HEAD:
            end_head()
        if tag in VOID:
            if tag in ("br", "hr"):
                end_block()
            continue
        if tag not in INLINE:
            end_block()
            ends = ENDED.get(tag, {"p"} if tag not in ("body", "html") else set())
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ends:
                    while len(stack) > i:
                        pop()
                    break
                if stack[i][0] in FENCES:
                    break
        names = []
        if rest and "=" in rest:
            for kind, *values in _NAMED.findall(rest):
                names += [f"{kind[0].lower()}:{w}" for w in _WORDS.findall("".join(values).lower())]
        if rest.rstrip().endswith("/") and tag in ("svg", "path"):
            continue
        stack.append((tag, (tag, *names)))
        held[tag] += 1
        state["link"] += tag == "a"
        state["skip"] += tag in SKIPPED
        if tag in RAW:
            # its content is not markup
            stop = re.compile(rf"</{re.escape(tag)}\s*>?", re.I).search(source, at)
            inside = source[at:stop.start()] if stop else source[at:]
            if not state["skip"]:
                text.append(html.unescape(inside))
            at = stop.end() if stop else len(source)
            pop()
    end_block()
    return blocks
