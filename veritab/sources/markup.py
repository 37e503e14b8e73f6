"""Links of raw HTML by a token machine: one pass over a page's tags, with state for open elements.

Tags are read with their quoted attributes, so signs inside quotes end nothing; comments and the content of scripts and
styles hold no links; elements nest, and a link's text is what stands inside its own element.  Pages run in Arrow batches.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from html import unescape
from urllib.parse import parse_qsl, unquote, urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.functions import urls
from veritab.sources.files import few_at_once

EXTRACTORS = ("anchor", "embed", "download_manager", "meta_refresh", "select_option", "form_action", "data_attribute", "onclick", "input_control")
# Attributes that scripts read addresses from, the first of which counts, and elements that bear them.
DATA_ATTRIBUTES = ("data-downloadurl", "data-href", "data-url", "data-file", "data-pdf", "data-src")
DATA_ELEMENTS = ("a", "button", "span", "div")
EMBEDS = ("embed", "object", "iframe")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = ("script", "style")
NEVER_NESTED = ("a", "option")
DOCUMENT = ".pdf"

_TOKEN = re.compile(r"""<!--|<(/?)([A-Za-z][\w:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_QUOTED = re.compile(r"""(["'])([^"']+)\1""")
_REFRESH = re.compile(r"""^\s*[\d.]*\s*[;,]\s*url\s*=\s*["']?([^"']+?)["']?\s*$""", re.IGNORECASE)


def attributes(block: str) -> dict[str, str]:
    """An element's attributes, names lowered and values unescaped; of equal names the first counts."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(block):
        found.setdefault(name.lower(), unescape("".join(values)).strip())
    return found


def joined(base: str, address: str) -> str:
    """The address as seen from base; one that can't be read stays as it is."""
    try:
        return urljoin(base, address)
    except ValueError:
        return address


class Links:
    """The links of one page, (source, address as written, text), in the order of their elements."""

    def __init__(self, html: str, base: str, wanted: Sequence[str], documents: bool) -> None:
        self.base, self.wanted, self.documents = base, set(wanted), documents
        self.rows: list[list] = []
        self.pieces: list[str] = []
        #: open elements: (name, place of the text, links), and how many of each name there are
        self.open: list[tuple[str, int, list[list]]] = []
        self.count: Counter[str] = Counter()
        self.title_rows: list[list] = []
        self.title = ""
        self._run(html)

    def _run(self, html: str) -> None:
        at, end, title_at = 0, len(html), None
        while at < end:
            m = _TOKEN.search(html, at)
            if m is None:
                break
            if m.start() > at:
                self.pieces.append(unescape(html[at : m.start()]))
            at = m.end()
            if m[2] is None:
                close = html.find("-->", at)
                at = end if close < 0 else close + 3
                continue
            name = m[2].lower()
            self.pieces.append(" ")
            if m[1]:
                if name == "title" and title_at is not None:
                    self.title, title_at = self._text(title_at), None
                self._close(name)
                continue
            if name in RAW:
                close = re.compile(f"</{name}", re.IGNORECASE).search(html, at)
                at = end if close is None else close.start()
                continue
            if name == "title":
                title_at = len(self.pieces)
            self._start(name, attributes(m[3]))
        if at < end:
            self.pieces.append(unescape(html[at:]))
        while self.open:
            self._end()
        for row in self.title_rows:
            row[2] = self.title

    def _text(self, place: int) -> str:
        return " ".join("".join(self.pieces[place:]).split())

    def _start(self, name: str, held: dict[str, str]) -> None:
        if name in NEVER_NESTED:
            self._close(name)
        if name == "base" and held.get("href"):
            self.base = joined(self.base, held["href"])
        found = self._found(name, held)
        if name == "input":
            said = held.get("value") or held.get("aria-label") or held.get("title") or ""
            self.pieces.append(f" {said} ")
            for row in found:
                row[2] = " ".join(said.split())
        if name == "meta":
            self.title_rows += found
        if name not in VOID:
            self.open.append((name, len(self.pieces), found))
            self.count[name] += 1

    def _found(self, name: str, held: dict[str, str]) -> list[list]:
        out = []

        def add(source: str, address: str | None, free: bool = False) -> bool:
            if not address or source not in self.wanted or (self.documents and not free and DOCUMENT not in unquote(address).lower()):
                return False
            out.append([source, joined(self.base, address), "", address])
            return True

        def scripted(source: str) -> None:
            for _, address in _QUOTED.findall(held.get("onclick", "")):
                if DOCUMENT in address.lower():
                    add(source, address)

        data = next((held[a] for a in DATA_ATTRIBUTES if held.get(a) and (not self.documents or DOCUMENT in unquote(held[a]).lower())), None)
        if name == "a":
            add("anchor", held.get("href"))
            managed = held.get("data-downloadurl") or held.get("href")
            if managed and self._is_managed(joined(self.base, managed)):
                add("download_manager", managed, True)
        elif name in EMBEDS:
            add("embed", held.get("src")) or add("embed", held.get("data"))
        elif name == "meta" and held.get("http-equiv", "").lower() == "refresh":
            m = _REFRESH.match(held.get("content", ""))
            add("meta_refresh", m and m[1])
        elif name == "option":
            add("select_option", held.get("value"))
        elif name == "form":
            add("form_action", held.get("action"))
        elif name == "input":
            add("input_control", data)
            scripted("input_control")
        if name in DATA_ELEMENTS:
            add("data_attribute", data)
            scripted("onclick")
        self.rows += out
        return out

    def _is_managed(self, address: str) -> bool:
        """An address of the page's host whose query names a managed download."""
        try:
            there, here = urlsplit(address), urlsplit(self.base)
        except ValueError:
            return False
        return there.scheme in ("http", "https") and there.netloc == here.netloc and any(k.lower() == "wpdmdl" and v.strip() for k, v in parse_qsl(there.query))

    def _end(self) -> None:
        name, place, rows = self.open.pop()
        self.count[name] -= 1
        if rows:
            text = self._text(place)
            for row in rows:
                row[2] = text

    def _close(self, name: str) -> None:
        """An end tag ends what was left open inside its element; one that ends nothing is passed over."""
        while self.count[name]:
            last = self.open[-1][0]
            self._end()
            if last == name:
                break


def markup_links(pages: DataFrame, extractors: Sequence[str] = EXTRACTORS, documents: bool = False) -> DataFrame:
    """SRC-25, URL-07: (page_id, position, source, href, text, pattern) of (page_id, url, html).

    extractors: which sources of links are read.  documents: only addresses that lead to documents, and managed downloads.
    A null page has no links; a null url leaves relative addresses as they are; repeated pages give repeated rows.
    """
    unknown = set(extractors) - set(EXTRACTORS)
    if unknown:
        raise ValueError(f"no such extractors: {sorted(unknown)}")
    kind = pages.schema["page_id"].dataType.simpleString()
    wanted = tuple(extractors)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, rows = [], []
            for i, (url, html) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                found = Links(html or "", url or "", wanted, documents).rows
                place += [i] * len(found)
                rows += [(n, *row) for n, row in enumerate(found)]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(place, pa.int64())), pa.array(columns[0], pa.int32()), *[pa.array(c, pa.string()) for c in columns[1:]]], ["page_id", "position", "source", "href", "text", "raw"]
            )

    found = few_at_once(pages).select("page_id", "url", "html").mapInArrow(work, f"page_id {kind}, position int, source string, href string, text string, raw string")
    prefix = F.when(~F.col("source").isin("anchor", "download_manager"), F.col("source"))
    pattern = F.when(F.col("source") == "download_manager", "wordpress_download_manager").otherwise(urls.delivery_pattern(F.col("href"), F.col("raw"), prefix))
    return found.select("page_id", "position", "source", "href", "text", pattern.alias("pattern"))
