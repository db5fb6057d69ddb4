"""The injury grids of many pages at once.

``markup.GridReader`` says what a grid's rows are, tag by tag. Here the same is
told of all tags of a run of pages together: numpy finds the tags, knows the
frequent ones by their bytes, and follows tables, rows, cells and divisions by
running sums over them; texts are cut out by their places. A page whose grid
holds something else (a comment, a script, odd quoting, grid rows in a table of
their own, no end) is read by ``GridReader``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa

from tidemark.functions.markup import _OUTSIDE, _PLAIN, _RAW_TEXT, _TAG, COLUMNS, LINK, STATUS, GridReader, _classes, attributes

#: Bytes of pages read together, tags a worker remembers, and their longest, in eights.
RUN_BYTES = 2 << 20
_TAGS_KEPT, _TAG_BYTES_KEPT = 50_000, 64

GRID_ROW = pa.struct(
    [
        ("section_pos", pa.int32()),
        ("row_pos", pa.int32()),
        ("team", pa.string()),
        ("cells", pa.list_(pa.string())),
        ("n_cells", pa.int32()),
        ("link", pa.bool_()),
        ("data_id", pa.string()),
        ("status", pa.string()),
    ]
)

# What a tag is; ``_ODD`` leaves its page to the general reader.
_NOTHING, _ODD, _TABLE, _TABLE_END, _TR, _TR_HEADING, _TR_PLAYER, _TR_END, _TD, _TH, _CELL_END = range(11)
_DIV, _DIV_TEAM, _DIV_TITLE, _DIV_BOTH, _DIV_END, _A, _GRID, _UNKNOWN = range(11, 19)
_BARE = {
    b"table": _TABLE, b"/table": _TABLE_END, b"tr": _TR, b"/tr": _TR_END, b"td": _TD, b"/td": _CELL_END,
    b"th": _TH, b"/th": _CELL_END, b"div": _DIV, b"/div": _DIV_END,
}

# The general patterns on bytes: these take ASCII white space only, so tags with other white space are left to the general reader.
_OUTSIDE_BYTES, _TAG_BYTES = re.compile(_OUTSIDE.pattern.encode()), re.compile(_TAG.pattern.encode(), re.S)
_OTHER_SPACE = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xc5\xbf|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
# Of eight bytes the first none, one, ... eight.
_LEADING = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
# A character reference; its names are ASCII.
_ENTITY = re.compile(rb"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;\x80-\xff]{1,32};?)")


@lru_cache(maxsize=10_000)
def _decoded(entity: bytes) -> bytes:
    return unescape(entity.decode("ascii")).encode()


# Digits decide nothing about a tag, but in a character reference.
_DIGITS = bytes.maketrans(b"123456789", b"000000000")


class _Codes(dict):
    """Inside of a tag -> what it is."""

    def __missing__(self, inside: bytes) -> int:
        code = self._read(inside)
        if len(self) >= _TAGS_KEPT:
            self.clear()
        if len(inside) <= _TAG_BYTES_KEPT:
            self[inside] = code
        return code

    @staticmethod
    def _read(inside: bytes) -> int:
        plain = _PLAIN.fullmatch(inside.decode())
        code = _ODD
        if plain is not None:
            end, name = bool(plain[1]), plain[2].lower()
            classes = () if end or name not in ("table", "tr", "div") else _classes(plain[3])
            if name == "table":
                code = _TABLE_END if end else _GRID if "injury-table" in classes else _TABLE
            elif name == "tr":
                heading, player = "heading" in classes, "player-row" in classes
                code = _TR_END if end else _ODD if heading and player else _TR_HEADING if heading else _TR_PLAYER if player else _TR
            elif name in ("td", "th"):
                code = _CELL_END if end else _TD if name == "td" else _TH
            elif name == "div":
                code = _DIV_END if end else _DIV + ("injury-team" in classes) + 2 * ("mob-title" in classes)
            elif name not in _RAW_TEXT:
                code = _A if name == "a" and not end else _NOTHING
        return code


_CODES = _Codes()


def _open_grid(text: bytes, at: int, end: int) -> int:
    """Where the page's grid begins, behind its tag; -1 when the page has none."""
    while True:
        at = _OUTSIDE_BYTES.match(text, at, end).end()
        tag = _TAG_BYTES.search(text, at, end)
        if tag is None:
            return -1
        at = tag.end()
        if tag[2] is None or tag[1]:
            continue
        name = tag[2].lower().decode()
        if name == "table" and "injury-table" in _classes(tag[3].decode()):
            return at
        if name in _RAW_TEXT:
            close = re.compile(f"</{name}".encode(), re.I).search(text, at, end)
            at = close.start() if close else end


def _first(of: np.ndarray) -> np.ndarray:
    """Of an ascending array, whether a value stands there for the first time."""
    out = np.ones(len(of), bool)
    out[1:] = of[1:] != of[:-1]
    return out


class _Run:
    """Tags of the grids of a run of pages, up to each grid's end; ``general`` marks the pages not read here."""

    def __init__(self, text: bytes, pages: np.ndarray) -> None:
        self.text, self.shape, self.bytes = text, text.translate(_DIGITS), np.frombuffer(text, np.uint8)
        self.signs = np.flatnonzero(self.bytes == 38)  # &
        self.semicolons = np.append(np.flatnonzero(self.bytes == 59), len(text))
        n = len(pages) - 1
        marks = np.flatnonzero((self.bytes | 2) == 62)  # < and >
        page = np.repeat(np.arange(n), np.diff(np.searchsorted(marks, pages)))
        opens = self.bytes[marks] == 60
        at = np.flatnonzero(opens)
        after = np.minimum(at + 1, len(marks) - 1)
        closed = ~opens[after] & (page[after] == page[at])
        page, start, end = page[at], marks[at], np.where(closed, marks[after], marks[at])
        code = self._codes(start, end, closed)

        grid, odd = self._first_of(code == _GRID, page, n), self._first_of(code == _ODD, page, n)
        begins = np.where(grid < len(code), end[np.minimum(grid, len(code) - 1)] + 1, -1) if len(code) else np.full(n, -1)
        self.general = np.zeros(n, bool)
        for i in np.flatnonzero(odd < grid).tolist():  # what is odd stands before the grid
            a, b = int(pages[i]), int(pages[i + 1])
            begins[i] = _open_grid(text, a, b)
            self.general[i] = _OTHER_SPACE.search(text, a, begins[i] if begins[i] >= 0 else b) is not None
        self.found = begins >= 0
        inside = (start >= begins[page]) & (self.found & ~self.general)[page]
        page, start, end, code = page[inside], start[inside], end[inside], code[inside]

        step = ((code == _TABLE) | (code == _GRID)).astype(np.int64) - (code == _TABLE_END)
        depth = np.cumsum(step)
        first = np.flatnonzero(_first(page)) if len(page) else np.zeros(0, np.int64)
        base = np.zeros(n, np.int64)
        base[page[first]] = depth[first] - step[first]
        depth += 1 - base[page]
        last = np.full(n, -1)
        done = np.flatnonzero((depth == 0) & (step == -1))[::-1]
        last[page[done]] = done  # of several the first counts
        before = depth - step
        odd = (code == _ODD) | ((before > 1) & ((code == _TR_HEADING) | (code == _TR_PLAYER)))
        here = np.arange(len(page)) <= last[page]
        self.general |= self.found & (last < 0)
        self.general[page[odd & here]] = True

        keep = here & ~self.general[page]
        code[(before > 1) & (code >= _TR) & (code <= _CELL_END)] = _NOTHING
        self.page, self.start, self.end, self.code = page[keep], start[keep], end[keep], code[keep]
        close = np.zeros(len(page), bool)
        close[last[last >= 0]] = True
        self.close = close[keep]

    @staticmethod
    def _first_of(hit: np.ndarray, page: np.ndarray, n: int) -> np.ndarray:
        """The first hit of every page, beyond all tags where there is none."""
        out = np.full(n, len(hit))
        at = np.flatnonzero(hit)[::-1]
        out[page[at]] = at
        return out

    def _codes(self, start: np.ndarray, end: np.ndarray, closed: np.ndarray) -> np.ndarray:
        """What the tags are: names without attributes by their bytes, others by the tags remembered."""
        size = end - start - 1
        word = self._words(self.text)[start + 1]
        code = np.where(closed, _UNKNOWN, _ODD).astype(np.uint8)
        for length in {len(name) for name in _BARE}:
            some = np.flatnonzero(size == length)
            found = word[some]
            for name, what in _BARE.items():
                if len(name) == length:
                    mask = int.from_bytes(bytes(0xDF if c > 64 else 0xFF for c in name), "little")
                    code[some[(found & np.uint64(mask)) == np.uint64(int.from_bytes(name.upper(), "little"))]] = what
        rest = np.flatnonzero(code == _UNKNOWN)
        start, size = start[rest] + 1, size[rest]
        short = np.flatnonzero(size <= _TAG_BYTES_KEPT)
        alike, number = self._alike(start[short], size[short])
        told, one_by_one = np.full(len(alike), _UNKNOWN, np.uint8), np.ones(len(rest), bool)
        for k, i in enumerate(short[alike].tolist()):
            inside = self.shape[int(start[i]) : int(start[i] + size[i])]
            if b"&" not in inside:
                told[k] = _CODES[inside]
        code[rest[short]] = told[number]
        one_by_one[short] = told[number] == _UNKNOWN
        for i in np.flatnonzero(one_by_one).tolist():
            code[rest[i]] = _CODES[self.text[int(start[i]) : int(start[i] + size[i])]]
        return code

    @staticmethod
    def _words(text: bytes) -> np.ndarray:
        """The eight bytes from every place on."""
        return np.ndarray((len(text) - 7,), "<u8", text, strides=(1,))

    def _alike(self, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first of all that are alike but for digits, and for each its place among those firsts."""
        words = self._words(self.shape)
        parts, mixed = [], size.astype(np.uint64)
        for k in range(_TAG_BYTES_KEPT // 8):
            longer = np.flatnonzero(size > 8 * k)
            if not len(longer):
                break
            part = np.zeros(len(start), np.uint64)
            part[longer] = words[start[longer] + 8 * k] & _LEADING[np.minimum(size[longer] - 8 * k, 8)]
            parts.append(part)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + part
        _, first, number = np.unique(mixed, return_index=True, return_inverse=True)
        own = first[number]
        if not all((part == part[own]).all() for part in [size, *parts]):  # two of one sum
            first = number = np.arange(len(start))
        return first, number

    def captured(self, begins: np.ndarray, scope: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every tag the number of the last of the divisions ``begins``, and whether it stands in that one, within the same ``scope``."""
        depth = np.cumsum((self.code >= _DIV) & (self.code <= _DIV_BOTH), dtype=np.int64) - np.cumsum(self.code == _DIV_END)
        starts = np.zeros(len(self.code), bool)
        starts[begins] = True
        number = np.cumsum(starts) - 1
        if not len(begins):
            return number, starts
        wide = 2 * len(depth) + 2
        least = np.minimum.accumulate(depth - wide * number) + wide * number
        own = begins[np.maximum(number, 0)]
        return number, (number >= 0) & (scope == scope[own]) & (least >= depth[own])

    def _entities(self, sign: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """The references that begin at ``sign``: their lengths (0: there is none), texts, and the text of each."""
        text, width = self.text, np.zeros(len(sign), np.int64)
        which, found, known = np.zeros(len(sign), np.int64), [], {}
        size = self.semicolons[np.searchsorted(self.semicolons, sign)] + 1 - sign
        short = (size <= 8) & (sign + size <= stop)
        # Short ones up to a semicolon are told by their bytes, each once.
        words = self._words(text)[sign[short]] & _LEADING[size[short]]
        unique, first, same = np.unique(words, return_index=True, return_inverse=True)
        alike = np.flatnonzero(short)
        lengths = np.zeros(len(unique), np.int64)
        for k, i in enumerate(alike[first].tolist()):
            entity = text[int(sign[i]) : int(sign[i] + size[i])]
            if _ENTITY.fullmatch(entity):
                lengths[k] = len(entity)
                found.append(_decoded(entity))
            else:
                found.append(b"")
        width[alike], which[alike] = lengths[same], same
        for i in np.flatnonzero(width == 0).tolist():
            entity = _ENTITY.match(text, int(sign[i]), int(stop[i]))
            if entity:
                width[i] = len(entity[0])
                if entity[0] not in known:
                    known[entity[0]] = len(found)
                    found.append(_decoded(entity[0]))
                which[i] = known[entity[0]]
        return width, found, which

    def texts(self, tags: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
        """For each of ``n`` owners the texts that follow its tags, entities decoded; both arrays ascend."""
        begin, stop = self.end[tags] + 1, self.start[tags + 1]
        some = stop > begin
        begin, stop, owner = begin[some], stop[some], owner[some]
        source, sign = self.bytes, self.signs
        at = np.searchsorted(begin, sign, "right") - 1
        held = (at >= 0) & (sign < stop[at]) if len(begin) else np.zeros(len(sign), bool)
        sign, at = sign[held], at[held]
        if len(sign):
            width, found, which = self._entities(sign, stop[at])
            some = width > 0
            sign, at, width, which = sign[some], at[some], width[some], which[some]
        if len(sign):
            # Each entity ends the text before it; its own text and the text behind it follow.
            more = b"".join(found)
            sizes = np.array([len(x) for x in found])
            places = len(source) + np.cumsum(sizes) - sizes
            source = np.concatenate([source, np.frombuffer(more, np.uint8)])
            k = np.arange(len(sign))
            old = np.arange(len(begin)) + 2 * np.searchsorted(at, np.arange(len(begin)))
            new = at + 2 * k + 1
            follows = np.zeros(len(at), bool)
            follows[:-1] = at[1:] == at[:-1]
            a, b, o = (np.empty(len(begin) + 2 * len(sign), np.int64) for _ in range(3))
            a[old], b[old], o[old] = begin, stop, owner
            own = np.flatnonzero(_first(at))
            b[old[at[own]]] = sign[own]
            a[new] = places[which]
            b[new] = places[which] + sizes[which]
            a[new + 1] = sign + width
            b[new + 1] = np.where(follows, np.append(sign[1:], 0), stop[at])
            o[new] = o[new + 1] = owner[at]
            begin, stop, owner = a, b, o
        size = stop - begin
        ends = np.concatenate([[0], np.cumsum(size)])
        data = source[np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])]
        offsets = ends[np.searchsorted(owner, np.arange(n + 1))].astype(np.int32)
        return pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(data))

    def rows(self, links: bool) -> tuple[np.ndarray, pa.StructArray]:
        """Page numbers and rows of the players."""
        code, page = self.code, self.page
        ends_row = ((code >= _TR) & (code <= _TR_END)) | self.close
        event = np.flatnonzero(ends_row)
        scope = np.cumsum(ends_row) - 1  # the last row event
        what = np.append(code[event], _NOTHING)  # before the first: none
        heading, player = what[scope] == _TR_HEADING, what[scope] == _TR_PLAYER

        team = np.flatnonzero(heading & ((code == _DIV_TEAM) | (code == _DIV_BOTH)))
        team = team[_first(scope[team])]
        number, within = self.captured(team, scope)
        named = np.flatnonzero(within)
        teams = self.texts(named, number[named], len(team))

        cell = np.flatnonzero(player & (code == _TD))
        fresh = np.flatnonzero(_first(scope[cell]))
        rank = np.arange(len(cell)) - np.repeat(fresh, np.diff(np.append(fresh, len(cell))))
        ends_cell = ends_row | ((code >= _TD) & (code <= _CELL_END))
        place = np.cumsum(ends_cell) - 1  # the last cell event
        kept = cell[rank < COLUMNS]
        of = np.full(len(code) + 1, -1)
        of[place[kept]] = np.arange(len(kept))
        own = of[place]
        tags = np.flatnonzero(own >= 0)
        texts = self.texts(tags, own[tags], len(kept))

        rows = np.flatnonzero(what[:-1] == _TR_PLAYER)
        n_cells = np.bincount(scope[cell], minlength=len(event))[rows]
        is_team = np.zeros(len(event), np.int64)
        is_team[scope[team]] = 1
        teams_so_far, players_so_far = np.cumsum(is_team), np.cumsum(what[:-1] == _TR_PLAYER)
        first = np.flatnonzero(_first(page[event])) if len(event) else event
        event_first = np.zeros(len(self.found), np.int64)
        event_first[page[event[first]]] = first
        head = event_first[page[event[rows]]]
        section = teams_so_far[rows] - teams_so_far[head] + is_team[head]
        begin = np.zeros(len(event), np.int64)
        begin[first] = first
        begin[is_team > 0] = np.flatnonzero(is_team)
        begin = np.maximum.accumulate(begin)[rows] if len(event) else begin
        place_in = players_so_far[rows] - players_so_far[begin] + (what[begin] == _TR_PLAYER) - 1
        team_of = pa.array(teams_so_far[rows] - 1, mask=section == 0)
        offsets = np.concatenate([[0], np.cumsum(np.minimum(n_cells, COLUMNS))]).astype(np.int32)
        link, data_id, status = self._links(scope, place, cell, rank, rows) if links else [pa.nulls(len(rows), f.type) for f in list(GRID_ROW)[5:]]
        columns = [
            pa.array(section.astype(np.int32)),
            pa.array(place_in.astype(np.int32)),
            teams.take(team_of),
            pa.ListArray.from_arrays(pa.array(offsets), texts),
            pa.array(n_cells.astype(np.int32)),
            link,
            data_id,
            status,
        ]
        return page[event[rows]], pa.StructArray.from_arrays(columns, fields=list(GRID_ROW))

    def _links(self, scope, place, cell, rank, rows) -> list[pa.Array]:
        """Whether a row's seventh cell holds a tracking link, the link's id, and the status."""
        code = self.code
        row_of = np.full(len(code) + 1, -1)  # row event -> row
        row_of[rows] = np.arange(len(rows))

        def cells_of(k: int) -> np.ndarray:
            of = np.full(len(code) + 1, -1)
            mine = cell[rank == k]
            of[place[mine]] = row_of[scope[mine]]
            return of[place]

        linked, ids = [False] * len(rows), [None] * len(rows)
        seventh = cells_of(LINK)
        some = np.flatnonzero((seventh >= 0) & (code == _A))
        for row, a, b in zip(seventh[some].tolist(), self.start[some].tolist(), self.end[some].tolist()):
            if not linked[row]:
                given = attributes(_PLAIN.fullmatch(self.text[a + 1 : b].decode())[3])
                if "track" in given.get("class", "").split():
                    linked[row], ids[row] = True, given.get("data-id")

        sixth = cells_of(STATUS)
        title = np.flatnonzero((sixth >= 0) & ((code == _DIV_TITLE) | (code == _DIV_BOTH)))
        title = title[_first(sixth[title])]
        _, within = self.captured(title, place)
        tags = np.flatnonzero((sixth >= 0) & ~within)
        there = np.zeros(len(rows), bool)
        there[row_of[scope[cell[rank == STATUS]]]] = True
        status = self.texts(tags, sixth[tags], len(rows)).take(pa.array(np.arange(len(rows)), mask=~there))
        return [pa.array(linked, pa.bool_()), pa.array(ids, pa.string()), status]


def _general(grids: list[GridReader], links: bool) -> pa.StructArray:
    columns = list(zip(*(row if links else (*row[:5], None, None, None) for g in grids for row in g.rows))) or [()] * len(GRID_ROW)
    return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, GRID_ROW)], fields=list(GRID_ROW))


def read_grids(pages: pa.Array, links: bool = True) -> Iterator[tuple[int, int, pa.Array, pa.ListArray]]:
    """Runs of pages: from, up to, which have a grid, and the rows of each as ``GridReader`` tells them.

    Without ``links`` the rows' link, data_id and status are left NULL.
    """
    pages = pages.cast(pa.large_string()).fill_null("")
    if not len(pages):
        return
    offsets = np.frombuffer(pages.buffers()[1], np.int64)[pages.offset : pages.offset + len(pages) + 1]
    data = pages.buffers()[2] or pa.py_buffer(b"")
    at = 0
    while at < len(pages):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + RUN_BYTES, "right")) - 1)
        bounds = offsets[at : to + 1] - offsets[at]
        run = _Run(data.slice(int(offsets[at]), int(bounds[-1])).to_pybytes() + bytes(8), bounds)
        page, rows = run.rows(links)
        found, others = run.found, np.flatnonzero(run.general)
        if len(others):
            grids = [GridReader().read(pages[at + i].as_py()) for i in others.tolist()]
            found = found.copy()
            found[others] = [g.found for g in grids]
            page = np.concatenate([page, np.repeat(others, [len(g.rows) for g in grids])])
            order = np.argsort(page, kind="stable")
            page, rows = page[order], pa.concat_arrays([rows, _general(grids, links)]).take(pa.array(order))
        ends = np.concatenate([[0], np.cumsum(np.bincount(page, minlength=to - at))]).astype(np.int32)
        yield at, to, pa.array(found), pa.ListArray.from_arrays(pa.array(ends), rows)
        at = to
