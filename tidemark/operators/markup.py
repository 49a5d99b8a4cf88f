"""One linear scan of a page's tags: its links, options, table cells, images and title as rows."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html import unescape
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame

_NAME = re.compile(r"/?[A-Za-z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=\"']+|[=\"'])")  # a name; stray signs are names of their own
_BARE = re.compile(r"[^\s>]*")
_TAG = re.compile(r"""(/?[A-Za-z][^\s/>]*+)((?:\s++[^\s/>="']++(?:=(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+))?+)*+)[\s/]*+>""")  # a whole tag, all of it well-formed
_PAIR = re.compile(r"""\s++([^\s/>="']++)(?:=(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+)))?+""")
_PLAIN = re.compile(r"(/?)(?:[\w%+~-][\w.%+~-]*+/)*+[\w%+~-][\w.%+~-]*+(?:\?[!-\"$-\[\]-~]++)?+", re.A)  # an address of plain path parts, with or without a query
_RAW = {n: re.compile(f"</{n}(?=[\\s/>])", re.I) for n in ("script", "style")}


def tags(html: str) -> Iterator[tuple[str, str | dict]]:
    """("text", text), ("open", {"": name, attributes}) and ("close", name) in page order; scripts, styles and comments are left out.

    A quoted value goes to its closing quote, whatever is in it; without one it ends at white space or the tag's end. A "<"
    that begins no tag is text. Every character is looked at a bounded number of times.
    """
    at, n, none_left = 0, len(html), set()

    def find(sign: str, start: int) -> int:
        if sign in none_left:
            return -1
        found = html.find(sign, start)
        if found < 0:
            none_left.add(sign)
        return found

    text_from = 0
    while (lt := html.find("<", at)) >= 0:
        if html.startswith("<!--", lt):
            yield "text", html[text_from:lt]
            end = find("-->", lt + 4)
            at = text_from = n if end < 0 else end + 3
            continue
        whole = _TAG.match(html, lt + 1)
        name = whole or _NAME.match(html, lt + 1)
        if not name:
            if html.startswith(("<!", "<?"), lt):
                yield "text", html[text_from:lt]
                end = find(">", lt)
                at = text_from = n if end < 0 else end + 1
            else:
                at = lt + 1
            continue
        yield "text", html[text_from:lt]
        found, at = {"": name[0].lower()}, name.end()
        if whole:
            found, at = {"": whole[1].lower()}, at - 1
            if whole[2]:
                for key, *values in _PAIR.findall(whole[2]):
                    found.setdefault(key.lower(), unescape("".join(values)))
        while at < n and html[at] != ">":
            key = _ATTRIBUTE.match(html, at)
            if not key:
                at += 1
                continue
            at, value = key.end(), ""
            while at < n and html[at].isspace():
                at += 1
            if at < n and html[at] == "=" and key[1] != "=":
                at += 1
                while at < n and html[at].isspace():
                    at += 1
                quote = html[at : at + 1]
                end = find(quote, at + 1) if quote in ('"', "'") else -1
                if end >= 0:
                    value, at = html[at + 1 : end], end + 1
                else:
                    bare = _BARE.match(html, at)
                    value, at = bare[0], bare.end()
            found.setdefault(key[1].lower(), unescape(value))
        at = text_from = min(n, at + 1)
        if found[""].startswith("/"):
            yield "close", found[""][1:]
            continue
        yield "open", found
        if found[""] in _RAW:
            end = None if found[""] in none_left else _RAW[found[""]].search(html, at)
            if end is None:
                none_left.add(found[""])
            at = text_from = n if end is None else end.start()
    yield "text", html[text_from:]


class _Text:
    """Stripped text pieces inside an element, joined by spaces; direct: only those right inside it."""

    def __init__(self, direct: bool = False):
        self.parts, self.direct, self.depth = [], direct, 0

    def add(self, piece: str) -> None:
        if not (self.direct and self.depth):
            self.parts.append(piece)

    def __str__(self) -> str:
        return " ".join(self.parts)


def absolute(base: str | None, href: str) -> str:
    """href against base, backslashes as slashes; an address that cannot be read stays as it is."""
    try:
        return urljoin(base or "", href.strip().replace("\\", "/"))
    except ValueError:
        return href


class Against:
    """absolute(base, href) of one page: the base is taken apart once, and plain addresses are put behind its folder or root."""

    def __init__(self, base: str | None):
        self.base, self.folder, self.root = base, None, None

    def __call__(self, href: str) -> str:
        plain = _PLAIN.fullmatch(href) if self.base else None
        if not plain:
            return absolute(self.base, href)
        if self.folder is None:
            try:
                self.folder, self.root = urljoin(self.base, "x")[:-1], urljoin(self.base, "/x")[:-2]
            except ValueError:
                self.base, self.folder = None, ""
                return href
        return (self.root if plain[1] else self.folder) + href


def elements(html: str) -> list[tuple]:
    """(kind, position, line, name, address, label, title, shown, images) of what a page holds, in page order.

    title: the first title's text in label. link: address, label, title attribute, text right inside a dark red font in shown.
    option: name of its select, value in address, text in label. cell: a td, once for each table row around it, whose number
    is line; images: addresses in it. Cells and rows end where the next begins in the same table.
    """
    out: list[list] = []
    link = option = title = None
    select, rows, line, seen_title = None, [], 0, False
    fonts: list[_Text] = []
    tables: list[list] = [[]]  # open cells of each open table, the innermost last

    def row(kind: str, *rest) -> list:
        out.append([kind, len(out), *rest])
        return out[-1]

    def close_cell() -> None:
        tables[-1].clear()

    for kind, what in tags(html):
        if kind == "text":
            piece = unescape(what).strip()
            if piece:
                if link:
                    link[1].add(piece)
                if option:
                    option[1].add(piece)
                if title is not None:
                    title.add(piece)
                for holder in fonts:
                    holder.add(piece)
                for cells in tables:
                    for holder, _ in cells:
                        holder.add(piece)
            continue
        name = what[""] if kind == "open" else what
        for font in fonts:
            if kind == "open" and name not in ("br", "img", "input", "hr", "meta", "link"):
                font.depth += 1
            elif kind == "close" and font.depth:
                font.depth -= 1
            elif kind == "close" and name == "font":
                font.depth = -1
        if fonts and fonts[-1].depth < 0:
            fonts.pop()
        if name == "a":
            if link:
                link[0][5], link[0][7] = str(link[1]), str(link[2]) if link[2] else ""
                link, fonts = None, []
            if kind == "open" and "href" in what:
                link = [row("link", None, None, what["href"], "", what.get("title", ""), "", None), _Text(), None]
        elif name == "font" and kind == "open" and link and link[2] is None and what.get("color", "").lower() == "darkred":
            link[2] = _Text(direct=True)
            fonts.append(link[2])
        elif name == "title" and not seen_title:
            if kind == "open":
                title = _Text()
            elif title is not None:
                row("title", None, None, None, str(title), None, None, None)
                title, seen_title = None, True
        elif name == "select":
            if option:
                option[0][5], option = str(option[1]), None
            select = what.get("name", "") if kind == "open" else None
        elif name == "option":
            if option:
                option[0][5], option = str(option[1]), None
            if kind == "open" and select is not None:
                option = [row("option", None, select, what.get("value", ""), "", None, None, None), _Text()]
        elif name == "table":
            if kind == "open":
                tables.append([])
                rows.append(None)
            elif len(tables) > 1:
                tables.pop()
                rows.pop()
        elif name == "tr":
            close_cell()
            line += kind == "open"
            if rows:
                rows[-1] = line if kind == "open" else None
            elif kind == "open":
                rows.append(line)
            else:
                rows = []
        elif name in ("td", "th"):
            close_cell()
            if kind == "open" and name == "td":
                text, images = _Text(), []
                for around in (r for r in rows if r is not None):
                    row("cell", around, None, None, text, None, None, images)
                tables[-1].append((text, images))
        elif name == "img" and kind == "open" and what.get("src", "").strip():
            for _, images in (c for t in tables for c in t):
                images.append(what["src"])
    if link:
        link[0][5], link[0][7] = str(link[1]), str(link[2]) if link[2] else ""
    if option:
        option[0][5] = str(option[1])
    if title is not None and not seen_title:
        row("title", None, None, None, str(title), None, None, None)
    return [tuple(str(x) if isinstance(x, _Text) else x for x in r) for r in out]


_FIELDS = [("kind", pa.string()), ("position", pa.int32()), ("line", pa.int32()), ("name", pa.string()), ("address", pa.string()), ("label", pa.string()), ("title", pa.string()), ("shown", pa.string()), ("images", pa.list_(pa.string())), ("target", pa.string())]


def page_elements(pages: DataFrame, kinds: Sequence[str] = (), rows: int = 8192) -> DataFrame:
    """page_id, url, elements() and, of links, the absolute target of each stored page (page_id, url, html), by one scan; a null page has none. kinds: only these, if any are named. Batches of about `rows` elements leave a task."""
    id_type, kinds = pages.schema["page_id"].dataType.simpleString(), frozenset(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []

            def full() -> pa.RecordBatch:
                again = pa.array(at, pa.int32())
                columns = [pa.array(c, t) for c, (_, t) in zip(zip(*found, strict=True), _FIELDS, strict=True)]
                return pa.RecordBatch.from_arrays([batch.column(0).take(again), batch.column(1).take(again), *columns], ["page_id", "url", *[n for n, _ in _FIELDS]])

            for i, (base, html) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                target = Against(base)
                for x in elements(html or ""):
                    if not kinds or x[0] in kinds:
                        at.append(i)
                        found.append((*x, target(x[4]) if x[0] == "link" else None))
                if len(at) >= rows:
                    yield full()
                    at, found = [], []
            if at:
                yield full()

    schema = f"page_id {id_type}, url string, kind string, position int, line int, name string, address string, label string, title string, shown string, images array<string>, target string"
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
