"""Markdown of a raw HTML page.

The page's tags are folded over a stack of open blocks in one pass: headings,
paragraphs, nested lists, quotes, code, tables, links, images and emphasis.
Entities are decoded; scripts, styles, navigation and the head are left out.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

SKIPPED = {"script", "style", "nav", "head", "template", "noscript"}
BLOCKS = {"p", "div", "section", "article", "header", "footer", "main", "aside", "figure", "figcaption", "table", "body", "html",
          "form", "dl", "dt", "dd", "address", "fieldset"}
HEADINGS = {f"h{i}": "#" * i for i in range(1, 7)}
MARKS = {"strong": "**", "b": "**", "em": "*", "i": "*", "code": "`", "del": "~~", "s": "~~"}
VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "source", "area", "base", "col", "embed", "track"}


class _Fold(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[str] = []   # finished blocks
        self.line: list[str] = []     # pieces of the block that is open
        self.prefix = ""              # what its first line starts with
        self.lists: list[list] = []   # [kind, items so far] of the open lists
        self.quotes = 0
        self.skipped: list[str] = []
        self.pre = 0
        self.links: list[str | None] = []
        self.marks: list[str] = []    # open emphasis; a block's end closes it

    def flush(self) -> None:
        text = "".join(self.line + self.marks[::-1])
        self.marks = []
        if self.pre:
            body = text.strip("\n")
            text = f"```\n{body}\n```" if body.strip() else ""
        else:
            text = "\n".join(re.sub(r"[ \t\r\n\f]+", " ", part).strip() for part in text.split("\x00"))
            text = re.sub(r"\n{2,}", "\n", text).strip("\n")
        if text:
            inner = " " * len(self.prefix) if self.lists else ""
            text = (self.prefix + text).replace("\n", "\n" + inner)
            if self.quotes:
                text = "\n".join("> " * self.quotes + x for x in text.split("\n"))
            self.blocks.append(text)
            self.prefix = " " * len(self.prefix) if self.lists else ""
        self.line = []

    def handle_starttag(self, tag, attrs):
        if self.skipped or tag in SKIPPED:
            if tag not in VOID:
                self.skipped.append(tag)
            return
        values = dict(attrs)
        if tag in HEADINGS:
            self.flush()
            self.prefix = HEADINGS[tag] + " "
        elif tag in ("ul", "ol"):
            self.flush()
            self.lists.append([tag, 0])
        elif tag == "li":
            self.flush()
            kind = self.lists[-1] if self.lists else ["ul", 0]
            kind[1] += 1
            depth = "  " * max(len(self.lists) - 1, 0)
            self.prefix = depth + (f"{kind[1]}. " if kind[0] == "ol" else "- ")
        elif tag == "blockquote":
            self.flush()
            self.quotes += 1
        elif tag == "pre":
            self.flush()
            self.pre += 1
        elif tag == "tr":
            self.flush()
        elif tag in ("td", "th"):
            self.line.append(" | " if "".join(self.line).strip() else "")
        elif tag == "br":
            self.line.append("\n" if self.pre else "\x00")
        elif tag == "hr":
            self.flush()
            self.blocks.append("---")
        elif tag == "img":
            if values.get("src"):
                self.line.append(f"![{(values.get('alt') or '').strip()}]({values['src']})")
        elif tag == "a":
            self.links.append(values.get("href"))
            self.line.append("[" if values.get("href") else "")
        elif tag in MARKS and not self.pre:
            self.marks.append(MARKS[tag])
            self.line.append(MARKS[tag])
        elif tag in BLOCKS:
            self.flush()

    def handle_endtag(self, tag):
        if self.skipped:
            if tag in self.skipped:  # an element closes those left open inside it
                del self.skipped[len(self.skipped) - 1 - self.skipped[::-1].index(tag):]
            return
        if tag in HEADINGS or tag in ("li", "tr") or tag in BLOCKS:
            self.flush()
            if tag in HEADINGS or tag == "li":
                self.prefix = ""
        elif tag in ("ul", "ol"):
            self.flush()
            if self.lists:
                self.lists.pop()
            self.prefix = ""
        elif tag == "blockquote":
            self.flush()
            self.quotes = max(0, self.quotes - 1)
        elif tag == "pre":
            self.flush()
            self.pre = max(0, self.pre - 1)
        elif tag == "a" and self.links:
            href = self.links.pop()
            if href:
                self.line.append(f"]({href})")
        elif MARKS.get(tag) in self.marks:
            self.marks.reverse()
            self.marks.remove(MARKS[tag])
            self.marks.reverse()
            self.line.append(MARKS[tag])

    def handle_data(self, data):
        if not self.skipped:
            self.line.append(data.replace("\x00", ""))


def to_markdown(html: str | None) -> str | None:
    """Markdown of a page; blocks are parted by an empty line, list items by a line end. Null gives null."""
    if html is None:
        return None
    fold = _Fold()
    fold.feed(html)
    fold.close()
    fold.flush()
    out: list[str] = []
    for block in fold.blocks:
        both_items = out and _item(out[-1]) and _item(block)
        out.append(("\n" if both_items else "\n\n") + block if out else block)
    return "".join(out)


def _item(block: str) -> bool:
    return re.match(r"\s*(- |\d+\. )", block.lstrip("\n")) is not None
