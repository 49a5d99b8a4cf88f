"""Main text of web pages by consensus host paths (operator 8).

Every page scores its containers by the text outside links that is left without page furniture, and votes for the
generalised tag-class path of the deepest container that holds nearly all of it. Spark counts the votes of each host; the
host's winning path then extracts its pages again. A page without that path falls back to its own best container.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small, stage

#: Where markup can begin; and, inside a tag, what can end it or open a quoted value.
_MARK = re.compile(r"<(?=[A-Za-z/!?])")
_NAME = re.compile(r"/?[A-Za-z][^\s/>]*+")
_IN_TAG = re.compile(r"[>\"']")
_ATTR = re.compile(r"(?<![^\s\"'])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/>\"']|$)", re.I)
#: Elements without content; elements whose content is not markup; blocks, which part words; blocks that end an open paragraph.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = {t: re.compile(rf"</{t}\s*[^>]*>", re.I) for t in "script style textarea title xmp iframe noembed noframes".split()}
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html"
    " li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
_CLOSES = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "option": ("option",)}
#: Elements that can be the container of a main text.
_CONTAINERS = frozenset("article section main div td body blockquote center table tbody tr".split())
#: Elements and names of page furniture.
_JUNK_TAGS = frozenset(
    "head nav header footer aside form script style noscript template menu button select textarea iframe svg canvas object dialog datalist label input title xmp noembed noframes".split()
)
_JUNK_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|adsense|sponsor(?:ed|s)?|promos?|promotions?|banners?|cookies?|consent|gdpr|notices?|notifications?|alerts?|disclaimers?"
    r"|sidebars?|rail|menus?|nav|navbar|navigation|breadcrumbs?|footer|header|masthead|topbar|comments?|commentlist|disqus|replies|respond|responses|discussion|share|sharing|social"
    r"|subscribe|subscription|newsletter|signup|login|popup|modal|overlay|related|recommend(?:ed|ations?)?|widgets?|toolbar|pagination|pager|skip|paywall|search|complementary|contentinfo"
    r"|banner)(?:$|[\s_-])|(?:^|[\s_-])side[_-]bar",
    re.I,
)
#: Names of the element that holds a main text.
_MAIN_NAMES = re.compile(r"(?:^|[\s_-])(?:article|articlebody|entry|post|posts?-(?:body|content|text)|content|contents|main|maincontent|story|body|text)(?:$|[\s_-])", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_SEEN = re.compile(r"\S+")


def tags(html: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, name, attributes) of each piece of markup: the name in lower case, with a slash for an end tag, empty for comments and declarations, "![CDATA[" with its content.

    Linear: where nothing closes a tag or a quoted value, this is found once and holds for the rest of the page.
    """
    at, size = 0, len(html)
    last = {q: html.rfind(q) for q in (">", '"', "'")}
    while m := _MARK.search(html, at):
        start = m.start()
        if html.startswith("<!--", start):
            stop = html.find("-->", start + 4)
            at = size if stop < 0 else stop + 3
            yield start, at, "", ""
        elif html.startswith("<![CDATA[", start):
            stop = html.find("]]>", start + 9)
            at = size if stop < 0 else stop + 3
            yield start, at, "![CDATA[", html[start + 9 : size if stop < 0 else stop]
        elif html[start + 1] in "!?":
            stop = html.find(">", start)
            at = size if stop < 0 else stop + 1
            yield start, at, "", ""
        elif name := _NAME.match(html, start + 1):
            k = name.end()
            while k <= last[">"]:
                found = _IN_TAG.search(html, k)
                q = found.group()
                if q == ">":
                    break
                before = html[found.start() - 1]
                close = html.find(q, found.end()) if (before == "=" or before.isspace()) and found.end() <= last[q] else -1
                k = found.end() if close < 0 else close + 1
            else:  # no end: the rest is no tag
                at = start + 1
                if last[">"] < start:
                    return
                continue
            at = found.start() + 1
            yield start, at, name.group().lower(), html[name.end() : found.start()]
        else:
            at = start + 1


class Page:
    """Containers of a page in document order (parent, path, tag, junk) and its text runs (container, text, inside a link)."""

    def __init__(self, html: str):
        # the root stands for a body whose tag is left out
        self.parent, self.tag, self.names, self.named, self.hidden = [-1], ["body"], [""], [False], [False]
        self.runs: list[tuple[int, str, bool]] = []
        self._read(html)
        self._judge()

    def _open(self, tag: str, attrs: str, top: int) -> int:
        names, named, hidden = "", False, tag in _JUNK_TAGS
        if attrs and not attrs.isspace():
            for m in _ATTR.finditer(attrs):
                key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if key == "class":
                    names = value
                if key in ("class", "id", "role"):
                    named = named or bool(_JUNK_NAMES.search(value))
                elif key == "style":
                    hidden = hidden or bool(_HIDDEN.search(value))
                else:
                    hidden = hidden or key == "hidden" or value.lower() == "true"
        plain = tag in ("html", "body")
        self.parent.append(top)
        self.names.append("." + ".".join(sorted(set(re.sub(r"\d+", "#", names.lower()).split()))) if names.strip() else "")
        self.tag.append(tag)
        self.named.append(named and not plain)
        self.hidden.append(hidden and not plain)
        return len(self.parent) - 1

    def _judge(self) -> None:
        """Which containers are furniture. A name does not decide for an article, or so named, with a fifth of the page's text
        outside hidden elements and links; nor for an element with half of it where hardly any stands outside elements with
        such names: then the main part has an odd name. Elements that are mostly links go by their names."""
        many = len(self.parent)
        self.own, self.linked = [0] * many, [0] * many
        hidden = [False] * many
        for k in range(1, many):
            hidden[k] = hidden[self.parent[k]] or self.hidden[k]
        for k, s, link in self.runs:
            if not hidden[k]:
                n = sum(map(len, _SEEN.findall(s)))
                self.own[k] += n
                self.linked[k] += n * link
        total, linked = self.own[:], self.linked[:]
        for k in range(many - 1, 0, -1):
            total[self.parent[k]] += total[k]
            linked[self.parent[k]] += linked[k]
        page = total[0] - linked[0]
        under = [False] * many  # a furniture's name, here or above
        for k in range(1, many):
            under[k] = under[self.parent[k]] or self.named[k]
        free = sum(self.own[k] - self.linked[k] for k in range(many) if not under[k])
        self.junk = hidden
        for k in range(1, many):
            if self.named[k] and not hidden[k]:
                text = total[k] - linked[k]
                main = 5 * text >= page and (self.tag[k] in ("article", "main") or _MAIN_NAMES.search(self.names[k].replace(".", " ")))
                hidden[k] = not (page > 0 and total[k] >= 2 * linked[k] and (main or (2 * text >= page and 10 * free < page)))
            hidden[k] = hidden[k] or hidden[self.parent[k]]
        # names of the path from the top, hashed step by step: any depth, in little room
        self.path = [b""] * many
        for k in range(1, many):
            self.path[k] = xxhash.xxh3_128_digest(self.path[self.parent[k]] + b">" + (self.tag[k] + self.names[k]).encode("utf-8", "surrogatepass"))

    def _read(self, html: str) -> None:
        stack, open_tags, links, at = [0], Counter(), 0, 0
        blocks: list[int] = []  # places in the stack of open blocks

        def pop() -> None:
            nonlocal links
            tag = self.tag[stack.pop()]
            open_tags[tag] -= 1
            links -= tag == "a"
            if blocks and blocks[-1] >= len(stack):
                blocks.pop()

        def text(s: str) -> None:
            if s:
                self.runs.append((stack[-1], s, links > 0 and not open_tags["p"]))  # a link in a paragraph is its text

        for start, stop, tag, attrs in tags(html):
            if start < at:  # inside a script or the like
                continue
            text(unescape(html[at:start]))
            at = stop
            if tag == "![CDATA[":
                text(attrs)
            elif tag[:1] == "/":
                end = tag[1:]
                if open_tags[end] > 0:
                    if end in _BLOCK:
                        text(" ")
                    while self.tag[stack[-1]] != end:
                        pop()
                    pop()
                elif end in _BLOCK:
                    text(" ")
            elif tag:
                if tag in _BLOCK:
                    text(" ")
                    if open_tags["p"] and tag != "br" and blocks and self.tag[stack[blocks[-1]]] == "p":  # a block ends an open paragraph; what hangs in it goes too
                        for _ in range(len(stack) - blocks[-1]):
                            pop()
                    if tag in _CLOSES and self.tag[stack[-1]] in _CLOSES[tag]:
                        pop()
                if tag in _VOID:
                    continue
                if tag == "body" and open_tags["head"]:
                    while open_tags["head"]:
                        pop()
                if tag in _RAW:
                    close = _RAW[tag].search(html, at)
                    at = close.end() if close else len(html)
                    continue
                if attrs.endswith("/") and tag not in _BLOCK:
                    continue
                if tag in _BLOCK:
                    blocks.append(len(stack))
                stack.append(self._open(tag, attrs, stack[-1]))
                open_tags[tag] += 1
                links += tag == "a"
        text(unescape(html[at:]))

    def _scores(self) -> list[int]:
        """Letters outside furniture and links in each container, less those in links."""
        own, linked = [0] * len(self.parent), [0] * len(self.parent)
        for k in range(len(own) - 1, 0, -1):
            if not self.junk[k]:
                own[k] += self.own[k]
                linked[k] += self.linked[k]
            own[self.parent[k]] += own[k]
            linked[self.parent[k]] += linked[k]
        own[0], linked[0] = own[0] + self.own[0], linked[0] + self.linked[0]
        found = [max(a - 2 * b, 0) for a, b in zip(own, linked, strict=True)]
        return found if any(found) else [a - b for a, b in zip(own, linked, strict=True)]

    def best(self, score: list[int] | None = None) -> int | None:
        """Deepest container with nearly all the text outside furniture and links; None if there is no such text.

        From it, up through containers that have more such text, as far as the body; then up to the nearest ancestor that is an
        article, main or so named and has more: there stand title, lead and the blocks beside the longest.
        """
        score = score or self._scores()
        top = max(score)
        if top <= 0:
            return None
        k = max(k for k in range(len(score)) if score[k] >= 0.9 * top and (self.tag[k] in _CONTAINERS or not k))
        while k and self.tag[up := self.parent[k]] in _CONTAINERS and self.tag[up] != "body" and self.tag[k] not in ("article", "main") and score[up] > score[k]:
            k = up
        up, main = self.parent[k] if k else -1, k
        while up > 0 and not (self.tag[k] in ("article", "main")):
            if (self.tag[up] in ("article", "main") or _MAIN_NAMES.search(self.names[up].replace(".", " "))) and score[up] > score[main]:
                main = up
            if self.tag[up] in ("article", "main"):
                break
            up = self.parent[up]
        return main

    def text(self, path: bytes | None, node: int = 0) -> str | None:
        """Text of the containers with the path (None if there are none), else of node; furniture left out, white space as one space."""
        inside = [False] * len(self.parent)
        for k in range(len(inside)):
            inside[k] = (k > 0 and inside[self.parent[k]]) or (self.path[k] == path if path is not None else k == node)
        if not any(inside):
            return None
        return " ".join("".join(s for k, s, _ in self.runs if inside[k] and not self.junk[k]).split())

    def extract(self, path: bytes | None) -> tuple[str, bool]:
        """Text by the host's path; by the page's own best container where that path holds less than half of its text. The mark tells which."""
        score = self._scores()
        k = self.best(score)
        if path is not None:
            held = [i for i in range(len(score)) if self.path[i] == path]
            if held and k is not None and 2 * sum(score[i] for i in held) >= score[k]:
                return self.text(path), True
        return ("" if k is None else self.text(None, k)), False


def _host(pages: DataFrame) -> DataFrame:
    return pages.withColumn("__host", F.coalesce(F.lower(F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1)), F.lit("")))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, votes): the winning path (hashed) of each host; ties go to the path that sorts last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes: Counter = Counter()
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                page = Page(html or "")
                if (k := page.best()) is not None:
                    votes[host, page.path[k]] += 1
            keys = list(votes)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary()), pa.array([votes[k] for k in keys], pa.int64())], ["host", "path", "n"]
            )

    votes = _host(pages).select("__host", "html").mapInArrow(run, "host string, path binary, n long").groupBy("host", "path").agg(F.sum("n").alias("votes"))
    best = F.max(F.struct("votes", "path"))
    return votes.groupBy("host").agg(best.alias("b")).select("host", "b.path", "b.votes")


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, by_host (the host's path was used) for every row. Null or empty html gives an empty text.

    Rows that repeat a page are pages of their own and vote each; pages without a host (null or odd url) vote together. Needs
    page_id, url and html; other columns are not looked at, whatever their names. The winners join the pages by broadcast if
    they are few, else through a shuffle that Spark splits where a host has many pages.
    """
    winners = stage(host_paths(pages), "paths").select(F.col("host").alias("__of"), F.col("path").alias("__path"))
    rows = _host(pages).join(small(winners), F.col("__host") == F.col("__of"), "left").select("page_id", "url", "html", "__path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, by_host = [], []
            for html, path in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                found, host = Page(html or "").extract(path)
                texts.append(found)
                by_host.append(host)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(by_host)], ["page_id", "url", "text", "by_host"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, by_host boolean").select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "by_host")
