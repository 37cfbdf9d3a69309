"""Blocks of an HTML page, on the standard library's parser."""

from __future__ import annotations

from html.parser import HTMLParser

_FURNITURE = {"nav": "header", "header": "header", "footer": "footer"}
_BLOCKS = {"p": "paragraph", "li": "list_item", "blockquote": "quote", "pre": "paragraph", "figcaption": "figure_caption", "td": "cell", "th": "cell"}
_HEADINGS = {f"h{i}": i for i in range(1, 7)}
_SILENT = {"script", "style", "template", "noscript", "head"}


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[tuple[str, int | None, str]] = []
        self.buffer: list[str] = []
        self.kind: tuple[str, int | None] = ("paragraph", None)
        self.silent = 0
        self.inside: list[str] = []
        self.row: list[str] = []
        self.table: list[list[str]] = []

    def flush(self, kind: tuple[str, int | None] = ("paragraph", None)) -> None:
        text = " ".join("".join(self.buffer).split())
        self.buffer = []
        if text:
            name = self.kind[0]
            if name == "cell":
                self.row.append(text)
            else:
                self.out.append((self.inside[-1] if self.inside and name in ("paragraph", "list_item") else name, self.kind[1], text))
        self.kind = kind

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _SILENT:
            self.silent += 1
        elif tag in _HEADINGS:
            self.flush(("heading", _HEADINGS[tag]))
        elif tag in _BLOCKS:
            self.flush((_BLOCKS[tag], None))
        elif tag in _FURNITURE:
            self.flush()
            self.inside.append(_FURNITURE[tag])
        elif tag == "table":
            self.flush()
            self.table = []
        elif tag in ("div", "section", "ul", "ol", "tr", "br", "hr"):
            if tag == "br":
                self.buffer.append(" ")
            else:
                self.flush()

    def handle_endtag(self, tag: str) -> None:
        if tag in _SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag in _FURNITURE and self.inside:
            self.flush()
            self.inside.pop()
        elif tag == "tr":
            self.flush()
            if self.row:
                self.table.append(self.row)
            self.row = []
        elif tag == "table":
            self.flush()
            if self.table:
                self.out.append(("table", None, "\n".join("| " + " | ".join(r) + " |" for r in self.table)))
            self.table = []
        elif tag in _HEADINGS or tag in _BLOCKS or tag in ("div", "section", "ul", "ol"):
            self.flush()

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.buffer.append(data)


def blocks(html: str) -> list[tuple[str, int | None, str]]:
    """(type, level, text) of each block in order."""
    reader = _Reader()
    reader.feed(html)
    reader.close()
    reader.flush()
    return reader.out
