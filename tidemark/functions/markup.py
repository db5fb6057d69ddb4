"""One pass over an HTML page: the rows of its injury grid.

Text, tags and attributes are read in the order they stand. Open tables, rows,
cells and divisions are kept on a stack, as a browser does it: names in any
case, attributes quoted either way or bare, a new cell or row ends the one
before, the end of a table ends what it holds, scripts and comments are no
text. Spark maps this over pages (``operators.extract``); a page is one task's
small work. Tags outside the grid are passed over in runs, those of the grid's
own cells are handled in the loop that finds them; nested tables, comments,
scripts and odd quoting take the general way.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

# A comment, a declaration, or a tag; a quote counts only after an equals sign.
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*(?:"[^"]*"|'[^']*')?+)*+)>?""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s]+))""")
_RAW_TEXT = ("script", "style")
# What may stand before the grid: text and tags other than tables, scripts, comments.
_OUTSIDE = re.compile(
    r"""(?:[^<]++|<(?![a-zA-Z/!?])|<(?![!?]|(?i:table|script|style))(?:/?[a-zA-Z][^\s/>]*(?:[^>=]++|=\s*(?:"[^"]*"|'[^']*')?+)*+>?|/(?![a-zA-Z])))*+"""
)
# The inside of a tag that ends at its first ``>``: quotes stand after an equals sign and are closed.
_PLAIN = re.compile(r"""(/?)([a-zA-Z][\w:-]*)((?:(?=[\s/])(?:[^>="']++|=\s*"[^">]*"|=\s*'[^'>]*'|=(?!\s*["']))*+)?)""")
# A cell's beginning: its text, or text around one plain division, and the cell's end if it stands there.
_INSIDE = r"""(?:\s(?:[^>="']++|=\s*"[^">]*"|=\s*'[^'>]*'|=(?!\s*["']))*+)?"""
_CELL_TEXT = rf"""<(?i:td){_INSIDE}>([^<]*+)(?:<((?i:div){_INSIDE})>([^<]*+)</(?i:div)>([^<]*+))?+(</(?i:td)>)?"""
_CELL = re.compile(_CELL_TEXT)
_CELLS = re.compile(f"(?:{_CELL_TEXT})++")
# What a tag does to the open row of the grid: nothing, or one of these; the others go the general way.
_NOTHING, _GENERAL, _TD, _TD_END, _DIV, _DIV_END = range(6)
#: Tags a worker remembers.
_TAGS_KEPT = 50_000

#: Cells of a player row that hold the grid's columns, the place of the status and of the tracking link.
COLUMNS, STATUS, LINK = 6, 5, 6


def attributes(text: str) -> dict[str, str]:
    """Attributes of a tag; of a repeated one the first counts."""
    out: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), unescape(double or single or bare))
    return out


@lru_cache(maxsize=10_000)
def _classes(text: str) -> tuple[str, ...]:
    return tuple(attributes(text).get("class", "").split()) if text else ()


class _Tags(dict):
    """Inside of a tag -> what it does, for a division with its classes' bearing (team, title)."""

    def __missing__(self, tag: str) -> tuple[int, bool, bool]:
        plain = _PLAIN.fullmatch(tag)
        what, team, title = _GENERAL, False, False
        if plain is not None:
            name = plain[2].lower()
            if name == "td":
                what = _TD_END if plain[1] else _TD
            elif name == "div":
                what = _DIV_END if plain[1] else _DIV
                classes = () if plain[1] else _classes(plain[3])
                team, title = "injury-team" in classes, "mob-title" in classes
            elif name not in ("table", "tr", "th", *_RAW_TEXT) and (plain[1] or name != "a"):
                what = _NOTHING
        if len(self) >= _TAGS_KEPT:
            self.clear()
        if len(tag) <= 64 and not (what == _GENERAL and tag[:1] in "aA"):  # links differ from row to row
            self[tag] = what, team, title
        return what, team, title


_TAGS = _Tags()


class _Capture:
    """Text inside a division, until the division ends."""

    __slots__ = ("parts", "depth")

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.depth = 1


class _Cell:
    __slots__ = ("parts", "title", "rest", "link", "data_id")

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.title: _Capture | None = None  # the cell's mobile title, which its status leaves out
        self.rest: list[str] = []
        self.link = False
        self.data_id: str | None = None


class _Row:
    __slots__ = ("heading", "player", "team", "cells", "cell")

    def __init__(self, classes: tuple[str, ...]) -> None:
        self.heading = "heading" in classes
        self.player = "player-row" in classes
        self.team: _Capture | None = None
        self.cells: list[_Cell] = []
        self.cell: _Cell | None = None


class GridReader:
    """Rows of the first table of class ``injury-table``; ``found`` tells whether there is one.

    A row: (section, place in the section, team, texts of its first six cells,
    number of cells, whether the seventh holds a tracking link, the link's id,
    status without the mobile title). A section starts with a heading row
    that names a team. A row's cells are its own: those of a table nested in a
    cell are part of that cell's text.
    """

    def __init__(self) -> None:
        self.found = False
        self.rows: list[tuple] = []
        self.tables: list[_Row | None] = []  # the open row of every open table
        self.section, self.place, self.team = 0, 0, None

    def read(self, page: str) -> GridReader:
        at, tables = 0, self.tables
        while True:
            if not tables:
                at = _OUTSIDE.match(page, at).end()
            elif len(tables) == 1:
                at = self._cells(page, at)
            if (tag := _TAG.search(page, at)) is None:
                break
            if tables and tag.start() > at:
                self._text(page[at : tag.start()])
            at = tag.end()
            if tag[2] is None:
                continue
            name = tag[2].lower()
            if tag[1]:
                if name == "table" and tables:
                    self._end_table()
                    if not tables:
                        return self
                elif tables:
                    self._end(name)
            else:
                self._start(name, tag[3])
                if name in _RAW_TEXT:
                    end = re.compile(f"</{name}", re.I).search(page, at)
                    at = end.start() if end else len(page)
        if tables and at < len(page):
            self._text(page[at:])
        while tables:
            self._end_table()
        return self

    def _cells(self, page: str, at: int) -> int:
        """Reads on in the grid's open row up to a tag that needs the general way; where that is, with the text before it."""
        row = self.tables[-1]
        if row is None:
            return at
        find, tags = page.find, _TAGS
        cell, team = row.cell, row.team
        while (start := find("<", at)) >= 0 and (end := find(">", start)) >= 0:
            what, of_team, of_title = tags[page[start + 1 : end]]
            if what == _GENERAL:
                break
            if start > at:
                text = page[at:start]
                if "&" in text:
                    text = unescape(text)
                if cell is not None:
                    cell.parts.append(text)
                    if cell.title is None or not cell.title.depth:
                        cell.rest.append(text)
                if team is not None and team.depth:
                    team.parts.append(text)
            at = end + 1
            if what == _TD:
                if (team is None or not team.depth) and (run := _CELLS.match(page, start)) is not None:
                    at = run.end()
                    for before, division, inner, after, closed in _CELL.findall(page, start, at):
                        cell = _Cell()
                        row.cells.append(cell)
                        self._plain(row, cell, before, division, inner, after)
                        if closed:
                            cell = None
                    row.cell, team = cell, row.team
                else:
                    cell = row.cell = _Cell()
                    row.cells.append(cell)
            elif what == _TD_END:
                cell = row.cell = None
            elif what != _NOTHING:
                step = 1 if what == _DIV else -1
                if team is not None and team.depth:
                    team.depth += step
                if cell is not None and (title := cell.title) is not None and title.depth:
                    title.depth += step
                if of_team and row.heading and team is None:
                    team = row.team = _Capture()
                if of_title and cell is not None and cell.title is None:
                    cell.title = _Capture()
        return at

    @staticmethod
    def _plain(row: _Row, cell: _Cell, before: str, division: str, inner: str, after: str) -> None:
        """A cell of text, or of text around one division that has ended."""
        if "&" in before:
            before = unescape(before)
        if not division:
            if before:
                cell.parts.append(before)
                cell.rest.append(before)
            return
        if "&" in inner:
            inner = unescape(inner)
        if "&" in after:
            after = unescape(after)
        _, of_team, of_title = _TAGS[division]
        cell.parts += (before, inner, after)
        cell.rest += (before, after) if of_title else (before, inner, after)
        if of_title:
            cell.title = _Capture()
            cell.title.depth = 0
        if of_team and row.heading and row.team is None:
            row.team = _Capture()
            row.team.parts.append(inner)
            row.team.depth = 0

    def _text(self, text: str) -> None:
        if "&" in text:
            text = unescape(text)
        for row in self.tables:
            if row is not None:
                if (cell := row.cell) is not None:
                    cell.parts.append(text)
                    if cell.title is None or not cell.title.depth:
                        cell.rest.append(text)
                if row.team is not None and row.team.depth:
                    row.team.parts.append(text)

    def _start(self, name: str, rest: str) -> None:
        if not self.tables:
            if name == "table" and "injury-table" in _classes(rest):
                self.found = True
                self.tables.append(None)
            return
        row = self.tables[-1]
        if name == "table":
            self.tables.append(None)
        elif name == "tr":
            self._end_row()
            self.tables[-1] = _Row(_classes(rest))
        elif name in ("td", "th"):
            if row is None:
                row = self.tables[-1] = _Row(())
            row.cell = None
            if name == "td":
                row.cell = _Cell()
                row.cells.append(row.cell)
        elif name == "div":
            self._division(_classes(rest))
        elif name == "a":
            given = attributes(rest)
            if "track" in given.get("class", "").split():
                for cell in [r.cell for r in self.tables if r is not None]:
                    if cell is not None and not cell.link:
                        cell.link, cell.data_id = True, given.get("data-id")

    def _deepen(self, step: int) -> None:
        """A division begins or ends inside the open captures."""
        for row in self.tables:
            if row is not None:
                if row.team is not None and row.team.depth:
                    row.team.depth += step
                if row.cell is not None and (title := row.cell.title) is not None and title.depth:
                    title.depth += step

    def _division(self, classes: tuple[str, ...]) -> None:
        self._deepen(1)
        team, title = "injury-team" in classes, "mob-title" in classes
        for row in self.tables if team or title else ():
            if row is not None:
                if team and row.heading and row.team is None:
                    row.team = _Capture()
                if title and row.cell is not None and row.cell.title is None:
                    row.cell.title = _Capture()

    def _end(self, name: str) -> None:
        row = self.tables[-1]
        if name == "div":
            self._deepen(-1)
        elif name == "tr":
            self._end_row()
        elif name in ("td", "th") and row is not None:
            row.cell = None

    def _end_table(self) -> None:
        self._end_row()
        self.tables.pop()

    def _end_row(self) -> None:
        row, self.tables[-1] = self.tables[-1], None
        if row is None:
            return
        if row.heading and row.team is not None:
            self.section, self.place, self.team = self.section + 1, 0, "".join(row.team.parts)
        elif row.player:
            cells = row.cells
            texts = ["".join(c.parts) for c in cells[:COLUMNS]]
            link = cells[LINK] if len(cells) > LINK else _Cell()
            status = "".join(cells[STATUS].rest) if len(cells) > STATUS else None
            self.rows.append((self.section, self.place, self.team, texts, len(cells), link.link, link.data_id, status))
            self.place += 1
