"""Per-page HTML helpers run inside Arrow-batched Python UDFs.

Only the standard-library ``html.parser`` is used. Each helper works on one
page; Spark partitions the pages and moves Arrow batches. A batch becomes
Python objects a slice at a time (``held_slices``), so what a worker holds of
them is bounded however many pages a batch has.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from webkb.schema import PARSED_PAGE

_HTML5_WS = " \t\n\r\x0c"

#: A slice of a batch has at most so many rows and, unless it is one row, bytes.
SLICE_ROWS = 256
SLICE_BYTES = 1 << 20

#: ``PARSED_PAGE`` and the converter's result as they leave Python.
_ITEM = pa.struct([("kind", pa.string()), ("pos", pa.int32()), ("value", pa.string()), ("abs_url", pa.string()),
                   ("link_url", pa.string()), ("nofollow", pa.bool_())])
_PARSED = pa.struct([("items", pa.list_(_ITEM)), ("error", pa.string())])
_CONVERTED = pa.struct([("markdown", pa.string()), ("error", pa.string())])


def held_slices(content: pa.Array) -> Iterator[tuple[int, int]]:
    """``(start, rows)`` of the slices in which a batch is made into Python
    objects, by the size of its texts or files."""
    start = size = 0
    for i, n in enumerate(pc.binary_length(content).to_pylist()):
        if i > start and (i - start == SLICE_ROWS or size + (n or 0) > SLICE_BYTES):
            yield start, i - start
            start, size = i, 0
        size += n or 0
    if len(content) > start:
        yield start, len(content) - start


def _first_attr(attrs, name):
    for k, v in attrs:
        if k == name:
            return v
    return None


class _LinkScan(HTMLParser):
    """Collects <base>, <a>/<area> hrefs and <img> srcs in document order.

    Script and style bodies are raw text for the parser and comments are
    skipped, so nothing inside them is picked up."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.base = None
        self.items = []  # (kind, value, nofollow)

    def handle_starttag(self, tag, attrs):
        if tag == "base" and self.base is None:
            href = _first_attr(attrs, "href")
            if href:
                self.base = href
        elif tag in ("a", "area"):
            href = _first_attr(attrs, "href")
            if href is not None:
                rel = _first_attr(attrs, "rel") or ""
                self.items.append((tag, href, "nofollow" in rel.lower().split()))
        elif tag == "img":
            self.items.append(("img", _first_attr(attrs, "src"), False))


def scan_page(url: str | None, html: str | None) -> tuple[list[dict], str | None]:
    """Links, areas and images of one page, and why the page could not be
    read to its end (None when it was).

    ``abs_url`` joins the attribute value with the page URL (how PDF and
    image elements are resolved); ``link_url`` strips HTML whitespace and
    joins with the ``<base>`` href when present (how followed links are
    resolved). A reference that cannot be joined has NULL there. ``pos``
    counts links (a, area) and images separately."""
    if html is None:
        return [], "html is null"
    url = url or ""
    p, error = _LinkScan(), None
    try:
        p.feed(html)
        p.close()
    except Exception as e:  # noqa: BLE001 - what was read is kept, the failure is reported
        error = f"{type(e).__name__}: {e}"
    base = _join(url, p.base.strip(_HTML5_WS)) or url if p.base else url
    out = []
    n_link = n_img = 0
    for kind, value, nofollow in p.items:
        if kind == "img":
            pos, n_img = n_img, n_img + 1
        else:
            pos, n_link = n_link, n_link + 1
        abs_url = link_url = None
        if value is not None:
            abs_url, link_url = _join(url, value), _join(base, value.strip(_HTML5_WS))
        out.append(
            {"kind": kind, "pos": pos, "value": value, "abs_url": abs_url, "link_url": link_url, "nofollow": nofollow}
        )
    return out, error


def _join(base: str, ref: str) -> str | None:
    try:
        return urljoin(base, ref)
    except ValueError:
        return None


def parse_page(url: str | None, html: str | None) -> list[dict]:
    return scan_page(url, html)[0]


@F.arrow_udf(PARSED_PAGE)
def parse_html_udf(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for url, html in batches:
        for start, n in held_slices(html):
            pages = zip(url.slice(start, n).to_pylist(), html.slice(start, n).to_pylist())
            yield pa.array([dict(zip(("items", "error"), scan_page(u, h))) for u, h in pages], _PARSED)


# ---------------------------------------------------------------------------
# HTML -> Markdown
# ---------------------------------------------------------------------------

_DROP_ALWAYS = {"script", "style", "head", "template", "noscript", "svg", "iframe", "object"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BLOCK = {
    "p", "div", "article", "section", "main", "aside", "nav", "ul", "ol", "table", "blockquote",
    "figure", "figcaption", "form", "dl", "dt", "dd", "address", "details", "summary", "body", "html",
}
_WS_RE = re.compile(r"[ \t\r\n\x0c]+")
_HEAD_CONTENT = {"title", "meta", "link", "base", "script", "style", "noscript", "template"}
# elements whose end tag may be left out: the start tags that end them
_ENDED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "p": _BLOCK | {"pre", "hr", "h1", "h2", "h3", "h4", "h5", "h6"},
    "option": {"option", "optgroup"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
    "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"},
}
# ... and the end tags of the elements that hold them
_HELD_BY = {
    "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "p": _BLOCK - {"p"}, "option": {"select", "datalist"},
    "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table", "tbody"}, "th": {"tr", "table", "tbody"},
    "thead": {"table"}, "tbody": {"table"},
}


def _ends(skipped: str, tag: str) -> bool:
    """Whether a start tag ends the dropped element whose end tag is missing."""
    if skipped == "head":
        return tag not in _HEAD_CONTENT and tag != "head"
    return tag in _ENDED_BY.get(skipped, ())


def _selector_matches(sel: str, tag: str, attrs) -> bool:
    sel = sel.strip()
    if not sel:
        return False
    if sel.startswith("."):
        classes = (_first_attr(attrs, "class") or "").split()
        return sel[1:] in classes
    if sel.startswith("#"):
        return (_first_attr(attrs, "id") or "") == sel[1:]
    if "." in sel:
        t, cls = sel.split(".", 1)
        return tag == t.lower() and cls in (_first_attr(attrs, "class") or "").split()
    return tag == sel.lower()


class _Markdown(HTMLParser):
    def __init__(self, base_url, remove, retain_images):
        super().__init__(convert_charrefs=True)
        self.base_url = base_url or ""
        self.remove = [s for s in remove if s and s.strip()]
        self.retain_images = retain_images
        self.out: list[str] = []
        self.skip: list[list] = []  # [tag, nesting, containers open inside]
        self.lists: list[list] = []  # [kind, counter]
        self.links: list[tuple[int, str]] = []
        self.pre = 0
        self.inline: list[str] = []  # open ** / * marks, closed at block ends
        self.table_rows: list[list[str]] | None = None
        self.cell: list[str] | None = None
        self.row: list[str] | None = None

    # -- output helpers ------------------------------------------------
    def _emit(self, s):
        if self.cell is not None:
            self.cell.append(s)
        else:
            self.out.append(s)

    def _close_inline(self):
        """Close open ** / * marks (unclosed tags end with their block),
        placing them before trailing whitespace."""
        if not self.inline:
            return
        sink = self.cell if self.cell is not None else self.out
        tail = []
        while sink and sink[-1].strip() == "":
            tail.append(sink.pop())
        if sink:
            stripped = sink[-1].rstrip()
            if len(stripped) < len(sink[-1]):
                tail.append(sink[-1][len(stripped):])
                sink[-1] = stripped
        while self.inline:
            sink.append(self.inline.pop())
        sink.extend(reversed(tail))

    def _block(self):
        self._close_inline()
        if self.cell is None:
            self.out.append("\n\n")

    def _line(self):
        if self.cell is not None:
            self.cell.append(" ")
        else:
            self.out.append("\n")

    # -- parser callbacks ----------------------------------------------
    def handle_starttag(self, tag, attrs):
        if self.skip:
            top = self.skip[-1]
            if top[1] == 1 and not top[2] and _ends(top[0], tag):
                self.skip.pop()
                return self.handle_starttag(tag, attrs)
            if tag == top[0] and tag not in _ENDED_BY:
                top[1] += 1
            elif tag in _HELD_BY.get(top[0], ()):
                top[2] += 1
            return
        if tag in _DROP_ALWAYS or any(_selector_matches(s, tag, attrs) for s in self.remove):
            if tag not in _VOID:
                self.skip.append([tag, 1, 0])
            return
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self._block()
            self._emit("#" * int(tag[1]) + " ")
        elif tag == "br":
            self._line()
        elif tag == "hr":
            self._block()
            self._emit("---")
            self._block()
        elif tag == "li":
            self.out.append("\n")
            depth = max(len(self.lists) - 1, 0)
            if self.lists and self.lists[-1][0] == "ol":
                self.lists[-1][1] += 1
                self._emit("  " * depth + f"{self.lists[-1][1]}. ")
            else:
                self._emit("  " * depth + "- ")
        elif tag in ("ul", "ol"):
            self.lists.append([tag, 0])
            self._block()
        elif tag in ("b", "strong"):
            self._emit("**")
            self.inline.append("**")
        elif tag in ("i", "em"):
            self._emit("*")
            self.inline.append("*")
        elif tag == "code" and not self.pre:
            self._emit("`")
        elif tag == "pre":
            self._block()
            self._emit("```\n")
            self.pre += 1
        elif tag == "a":
            href = _first_attr(attrs, "href")
            try:
                target = urljoin(self.base_url, href.strip(_HTML5_WS)) if href else ""
            except ValueError:
                target = href or ""
            sink = self.cell if self.cell is not None else self.out
            self.links.append((len(sink), target))
        elif tag == "img":
            if self.retain_images:
                src = _first_attr(attrs, "src")
                if src:
                    alt = _first_attr(attrs, "alt") or ""
                    try:
                        src = urljoin(self.base_url, src)
                    except ValueError:
                        pass
                    self._emit(f"![{alt}]({src})")
        elif tag == "table":
            self._block()
            self.table_rows = []
        elif tag == "tr":
            self._close_row()
            self.row = []
        elif tag in ("td", "th"):
            self._close_cell()
            self.cell = []
        elif tag in _BLOCK:
            self._block()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.skip:
            top = self.skip[-1]
            if tag == top[0]:
                if not top[2]:  # else it ends an element of an inner container
                    top[1] -= 1
                if top[1] == 0:
                    self.skip.pop()
                return
            if tag not in _HELD_BY.get(top[0], ()):
                return
            if top[2]:
                top[2] -= 1
                return
            self.skip.pop()  # its container ends: its own end tag was left out
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self._block()
        elif tag in ("b", "strong", "i", "em"):
            mark = "**" if tag in ("b", "strong") else "*"
            if mark in self.inline:
                while self.inline:
                    m = self.inline.pop()
                    self._emit(m)
                    if m == mark:
                        break
        elif tag == "code" and not self.pre:
            self._emit("`")
        elif tag == "pre":
            if self.pre:
                self.pre -= 1
                self._emit("\n```")
                self._block()
        elif tag in ("ul", "ol"):
            if self.lists:
                self.lists.pop()
            self._block()
        elif tag == "a":
            if self.links:
                start, target = self.links.pop()
                sink = self.cell if self.cell is not None else self.out
                text = _WS_RE.sub(" ", "".join(sink[start:])).strip()
                del sink[start:]
                sink.append(f"[{text}]({target})" if target else text)
        elif tag in ("td", "th"):
            self._close_cell()
        elif tag == "tr":
            self._close_row()
        elif tag == "table":
            self._close_table()
        elif tag in _BLOCK or tag == "li":
            if tag != "li":
                self._block()

    def _close_cell(self):
        if self.cell is not None:
            text = _WS_RE.sub(" ", "".join(self.cell)).strip().replace("|", "\\|")
            self.cell = None
            if self.row is None:
                self.row = []
            self.row.append(text)

    def _close_row(self):
        self._close_cell()
        if self.row is not None:
            if self.table_rows is None:
                self.table_rows = []
            self.table_rows.append(self.row)
            self.row = None

    def _close_table(self):
        self._close_row()
        rows = self.table_rows or []
        self.table_rows = None
        if not rows:
            return
        width = max(len(r) for r in rows)
        lines = []
        for i, r in enumerate(rows):
            r = r + [""] * (width - len(r))
            lines.append("| " + " | ".join(r) + " |")
            if i == 0:
                lines.append("|" + "|".join([" --- "] * width) + "|")
        self.out.append("\n\n" + "\n".join(lines) + "\n\n")

    def handle_data(self, data):
        if self.skip:
            return
        if self.pre:
            self._emit(data)
        else:
            self._emit(_WS_RE.sub(" ", data))

    def result(self) -> str:
        while self.links:
            self.handle_endtag("a")
        if self.table_rows is not None:
            self._close_table()
        self._close_inline()
        text = "".join(self.out)
        lines, fenced = [], False
        for ln in text.split("\n"):
            if ln.strip().startswith("```"):
                fenced = not fenced
                lines.append(ln.strip())
            else:
                lines.append(ln.rstrip() if fenced else ln.strip())
        text = "\n".join(lines)
        text = re.sub(r"\n{3,}", "\n\n", text)
        return text.strip()


def convert_page(html: str | None, base_url: str | None = None, remove=("footer", "header"),
                 retain_images: bool = False) -> tuple[str | None, str | None]:
    """Markdown of one page and, where there is none, the reason."""
    if html is None:
        return None, "html is null"
    try:
        p = _Markdown(base_url, remove, retain_images)
        p.feed(html)
        p.close()
        return p.result(), None
    except Exception as e:  # noqa: BLE001 - failure is a row, never a task error
        return None, f"{type(e).__name__}: {e}"


def html_to_markdown_text(html: str | None, base_url: str | None = None, remove=("footer", "header"),
                          retain_images: bool = False) -> str | None:
    return convert_page(html, base_url, remove, retain_images)[0]


def markdown_udf(remove=("footer", "header"), retain_images: bool = False):
    """Arrow-batched UDF ``(url, html) -> struct<markdown, error>`` with fixed options."""
    remove = tuple(remove)

    @F.arrow_udf("markdown string, error string")
    def _md(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for url, html in batches:
            for start, n in held_slices(html):
                pages = zip(url.slice(start, n).to_pylist(), html.slice(start, n).to_pylist())
                yield pa.array([dict(zip(("markdown", "error"), convert_page(h, u, remove, retain_images)))
                                for u, h in pages], _CONVERTED)

    return _md
