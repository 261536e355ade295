"""HTML to markdown in one pass over the tags of a text.

Tags are read one after another with a stack of open lists, links and emphasis.
Column expressions alone would copy what was written so far at every tag; the
pass runs on Arrow batches instead, and holds a slice of texts and their markdown.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.columns import as_col, text_slices

# Comments, hidden elements as a whole, tags with quoted attributes, what is cut off at the end, text.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<hidden>script|style|template|noscript|head|title|textarea)\b.*?(?:</(?P=hidden)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/a-z][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
HREF = re.compile(r"""\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
# Element names by what they stand for in markdown.
MARKS = {"b": "**", "strong": "**", "i": "_", "em": "_", "code": "`"}
HEADINGS = {"h1": "# ", "h2": "## ", "h3": "### ", "h4": "#### ", "h5": "#### ", "h6": "#### "}
BLOCKS = frozenset(
    "address article aside blockquote body details dialog div dl dd dt fieldset figcaption figure footer form header hgroup "
    "html legend main nav ol p pre section summary table tbody tfoot thead ul".split()
)


class MarkdownWriter:
    """Markdown so far, the breaks and the blank still owed, and what is open. Every step is of bounded cost."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.tail = "\n"  # the last character
        self.written = 0  # pieces that are not empty
        self.lines = 0  # line breaks owed before the next text
        self.blank = False
        self.lists: list[list] = []  # sign or next number of each open list
        # name, place of its sign, pieces before it and target of what this block opened, and how many of each name
        self.open: list[tuple[str, int, int, str]] = []
        self.named: Counter[str] = Counter()

    def write(self, text: str) -> None:
        self.out.append(text)
        if text:
            self.tail = text[-1]
            self.written += 1

    def put(self, text: str) -> None:
        if self.written and self.lines:
            self.write("\n" * self.lines)
        elif self.blank and not self.tail.isspace():
            self.write(" ")
        self.lines, self.blank = 0, False
        self.write(text)

    def text(self, text: str) -> None:
        words = entities.unescape(text).split()
        if text[:1].isspace() or not words:
            if self.open and self.open[-1][1] == len(self.out) - 1 and not self.tail.isspace():
                # a blank after a sign goes before it
                self.out[-2], self.tail = " ", " "
            else:
                self.blank = self.blank or bool(text)
        if words:
            self.put(" ".join(words))
            self.blank = text[-1:].isspace()

    def break_lines(self, n: int) -> None:
        self.lines = max(self.lines, n)
        if n > 1:
            self.open.clear()
            self.named.clear()

    def begin(self, name: str, target: str = "") -> None:
        """Leaves a place for a sign that is only written if the element ends within its block."""
        self.put("")
        self.write("")
        self.open.append((name, len(self.out) - 1, self.written, target))
        self.named[name] += 1

    def end(self, name: str) -> None:
        while self.named[name]:
            last, place, before, target = self.open.pop()
            self.named[last] -= 1
            if last == name:
                if self.written > before:
                    self.out[place] = MARKS.get(name, "[")
                    self.write(MARKS.get(name, f"]({target})"))
                return

    def item(self) -> None:
        self.break_lines(1)
        sign = self.lists[-1][0] if self.lists else "- "
        if isinstance(sign, int):
            self.lists[-1][0], sign = sign + 1, f"{sign}. "
        self.put("  " * max(0, len(self.lists) - 1) + sign)

    def tag(self, name: str, close: bool, rest: str) -> None:
        if name in MARKS:
            self.end(name) if close else self.begin(name)
        elif name == "a":
            found = HREF.search(rest)
            if close:
                self.end(name)
            elif found:
                self.begin(name, entities.unescape(next(g for g in found.groups() if g is not None)))
        elif name in HEADINGS:
            self.break_lines(2)
            if not close:
                self.put(HEADINGS[name])
        elif name in ("ul", "ol"):
            if close and self.lists:
                self.lists.pop()
            self.break_lines(1 if self.lists else 2)
            if not close:
                self.lists.append(["- " if name == "ul" else 1])
        elif name == "li" and not close:
            self.item()
        elif name in ("br", "hr"):
            self.lines = min(2, self.lines + 1)
        elif name == "tr":
            self.break_lines(1)
        elif name in ("td", "th") and close:
            self.put(" |")
            self.blank = True
        elif name in BLOCKS:
            self.break_lines(2)


def to_markdown(text: str) -> str:
    """Markdown of one HTML text: headings, nested lists, closed emphasis and links, tables' cells, all entities."""
    writer = MarkdownWriter()
    for token in TOKEN.finditer(text):
        if token["text"]:
            writer.text(token["text"])
        elif token["name"]:
            writer.tag(token["name"].lower(), bool(token["close"]), token["rest"])
    return "".join(writer.out).strip()


def html_to_markdown(html) -> Column:
    """Markdown of an HTML text; NULL stays NULL."""

    @F.arrow_udf("string")
    def converted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in text_slices(batches):
            yield pa.array((None if t is None else to_markdown(t) for t in texts.to_pylist()), pa.string())

    return converted(as_col(html))


def html_title(html) -> Column:
    return F.regexp_extract(as_col(html), r"(?is)<title[^>]*>(.*?)</title", 1)
