"""The one Python step: markup to document nodes, in Arrow batches.

Everything after it is a Spark expression. The module is shipped to the workers by value, so
that a job needs no package on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa

# Elements that never have content.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link "
    "menuitem meta nextid param source spacer track wbr".split()
)
OPAQUE = frozenset(("script", "style"))
VERBATIM = frozenset(("pre", "textarea"))

# Markup is turned into nodes so many characters, and so many pages, at a time.
PIECE = 1 << 20
PIECE_PAGES = 1000

COLUMNS = (
    ("ix", pa.int32()),
    ("last", pa.int32()),
    ("pos", pa.int32()),
    ("end_pos", pa.int32()),
    ("kind", pa.string()),
    ("tag", pa.string()),
    ("class_attr", pa.string()),
    ("attrs", pa.map_(pa.string(), pa.string())),
    ("text", pa.string()),
    ("start", pa.int32()),
    ("stop", pa.int32()),
)
NODE_DDL = (
    "struct<ix:int,last:int,pos:int,end_pos:int,kind:string,tag:string,class_attr:string,"
    "attrs:map<string,string>,text:string,start:int,stop:int>"
)


class NodeReader(HTMLParser):
    """Numbers every node in document order; writes out the wanted ones.

    Void elements close at once, an end tag closes back to the nearest open element of its name
    or is ignored, and what is left open ends with the element around it.
    """

    def __init__(self, out: dict[str, list], tags, text_tags):
        super().__init__(convert_charrefs=True)
        self.out, self.tags, self.text_tags = out, tags, text_tags

    def read(self, html: str) -> int:
        self.first = len(self.out["ix"])
        self.html, self.pos, self.stack, self.open = html, -1, [], {}
        self.reading, self.pieces, self.piece_at = 0, [], 0
        self.lines = [0]
        at = html.find("\n")
        while at >= 0:
            self.lines.append(at + 1)
            at = html.find("\n", at + 1)
        self.reset()
        self.feed(html)
        self.close()
        self._end_text(len(html))
        self._close_to(0, len(html), len(html))
        return len(self.out["ix"]) - self.first

    def _at(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def _write(self, kind, tag, attrs, text, start, stop) -> int:
        out, row = self.out, len(self.out["ix"])
        ix = row - self.first + 1
        classes = None
        for key, value in attrs:
            if key == "class":
                classes = " ".join((value or "").split())
        values = (ix, ix, self.pos, self.pos, kind, tag, classes, attrs, text, start, stop)
        for (name, _), value in zip(COLUMNS, values):
            out[name].append(value)
        return row

    def _close_to(self, depth: int, inner_stop: int, stop: int) -> None:
        """Close open elements down to ``depth``; only the outermost includes the end tag."""
        while len(self.stack) > depth:
            tag, row, is_text = self.stack.pop()
            self.open[tag] -= 1
            self.reading -= is_text
            if row is not None:
                self.out["end_pos"][row] = self.pos
                self.out["last"][row] = len(self.out["ix"]) - self.first
                self.out["stop"][row] = stop if len(self.stack) == depth else inner_stop

    def _end_text(self, stop: int) -> None:
        if not self.pieces:
            return
        text, self.pieces = "".join(self.pieces), []
        self.pos += 1
        if self.tags is not None and not self.reading:
            return
        inside = self.stack[-1][0] if self.stack else ""
        if text.isspace() and text.isascii() and not any(self.open.get(t) for t in VERBATIM):
            text = "\n" if "\n" in text else " "
        self._write("raw" if inside in OPAQUE else "text", None, (), text, self.piece_at, stop)

    def handle_data(self, data):
        if not self.pieces:
            self.piece_at = self._at()
        self.pieces.append(data)

    def handle_starttag(self, tag, attrs):
        at = self._at()
        self._end_text(at)
        self.pos += 1
        stop = at + len(self.get_starttag_text())
        row = None
        if self.tags is None or tag in self.tags:
            last_wins = {key: value or "" for key, value in attrs}
            row = self._write("element", tag, list(last_wins.items()), None, at, stop)
        if tag not in VOID:
            is_text = 1 if self.text_tags is not None and tag in self.text_tags else 0
            self.stack.append((tag, row, is_text))
            self.open[tag] = self.open.get(tag, 0) + 1
            self.reading += is_text

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            stop = self._at() + len(self.get_starttag_text())
            self._close_to(len(self.stack) - 1, stop, stop)

    def handle_endtag(self, tag):
        at = self._at()
        self._end_text(at)
        if not self.open.get(tag):
            return
        depth = len(self.stack) - 1
        while self.stack[depth][0] != tag:
            depth -= 1
        self._close_to(depth, at, self.html.find(">", at) + 1 or len(self.html))

    def _aside(self, data):
        at = self._at()
        self._end_text(at)
        self.pos += 1
        if self.tags is None:
            self._write("comment", None, (), data, at, self.html.find(">", at + len(data)) + 1 or len(self.html))

    handle_comment = handle_decl = handle_pi = unknown_decl = _aside


def read_pages(pages: list[str | None], tags, text_tags) -> pa.Array:
    """A list of node structs per page."""
    out = {name: [] for name, _ in COLUMNS}
    offsets = [0]
    reader = NodeReader(out, tags, text_tags)
    for html in pages:
        offsets.append(offsets[-1] + (reader.read(html) if html else 0))
    fields = [pa.field(name, kind) for name, kind in COLUMNS]
    nodes = pa.StructArray.from_arrays([pa.array(out[f.name], f.type) for f in fields], fields=fields)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), nodes)


def read_batches(batches: Iterator[pa.Array], tags, text_tags) -> Iterator[pa.Array]:
    """The node lists of all pages, given out piece by piece: nodes take many times the room of their markup,
    so a worker never holds those of a whole Arrow batch."""
    for batch in batches:
        piece, characters = [], 0
        for page in batch:
            html = page.as_py()
            piece.append(html)
            characters += len(html or "")
            if characters >= PIECE or len(piece) >= PIECE_PAGES:
                yield read_pages(piece, tags, text_tags)
                piece, characters = [], 0
        if piece:
            yield read_pages(piece, tags, text_tags)
