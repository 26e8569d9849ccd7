"""HTML pages to Markdown-like text."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
import html as entities
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.functions import text as X
from gleanery.operators.chunking import portions

# Elements removed with their content, in document order of
# preference the elements taken as the root, and how elements are written.
BOILERPLATE = ("script", "style", "nav", "header", "footer", "noscript")
ROOTS = ("main", "article", "body")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body dd div dl dt fieldset figure form h1 h2 h3 h4 h5 h6 "
    "head header hr html li main nav ol p pre section table tbody td tfoot th thead tr ul".split()
)
MARKS = {"b": "**", "strong": "**", "em": "*", "i": "*", "del": "~~", "s": "~~",
         "code": "`", "kbd": "`", "samp": "`"}
CLOSED_BY_SIBLING = {"li": ("li",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"),
                     "dt": ("dt", "dd"), "dd": ("dt", "dd")}
BULLETS = "*+-"
SCOPES = frozenset("ul ol dl table".split())
MAX_DEPTH = 512  # below this only roots and boilerplate keep their tags


_NAME = re.compile(r"[^\t\n\r\f />\x00]*+")
_GAP = re.compile(r"[\s/]*+")
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/=>]*+)(\s*+=\s*+)?")
_BARE = re.compile(r"[^\s>]*+")
_COMMENT_END = re.compile("--!?>")
_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_RAW_END = {tag: re.compile(rf"(?i)</{tag}(?=[\s/>])") for tag in ("script", "style")}


class _Page:
    """Keeps a stack of open elements; a closed one is written to its parent.

    ``feed`` goes over the markup once: what a tag, comment or quote without an end has
    swallowed is not gone over again. A tag with an open quote ends at the next ``>``, as
    does a comment without an end; behind the last ``>`` all is text.
    """

    def __init__(self, escape: str):
        self.escape = sorted(escape, key=lambda c: c != "\\")  # a backslash first
        self.stack = [("", {}, [], 0)]
        self.open: Counter[str] = Counter()
        self.lists: list[list] = []  # tag and next number of each open list
        self.tables: list[list[int]] = []  # rows written, cells of the row at hand
        self.roots: dict[str, tuple[int, str]] = {}
        self.seen = 0

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._close_while_open("p", BLOCKS - {"p"})
        for open_tag in CLOSED_BY_SIBLING.get(tag, ()):
            self._close_while_open(open_tag, SCOPES)
        self.seen += 1
        frame = (tag, dict(attrs), [], self.seen)
        if tag in VOID:
            self._emit(self._render(frame))
        elif len(self.stack) < MAX_DEPTH or tag in BOILERPLATE or tag in ROOTS and not self.open[tag]:
            self.stack.append(frame)
            self.open[tag] += 1
            if tag in ("ul", "ol"):
                start = frame[1].get("start") or ""
                self.lists.append([tag, int(start[:9]) if start.isascii() and start.isdigit() else 1])
            elif tag == "table":
                self.tables.append([0, 0])

    def handle_endtag(self, tag):
        if self.open[tag]:
            while self._pop() != tag:
                pass

    def handle_data(self, data):
        if self.open["pre"]:
            self._emit(data)
            return
        # Most text holds none of what follows, and a look is cheaper than a rewrite.
        if "\n" in data or "\r" in data:
            data = re.sub(r"[ \t\r\n\f]*[\r\n][ \t\r\n\f]*", "\n", data)
        if "  " in data or "\t" in data or "\f" in data:
            data = re.sub(r"[ \t\f]+", " ", data)
        for c in self.escape:
            if c in data and not any(self.open[t] for t in ("code", "kbd", "samp")):
                data = data.replace(c, "\\" + c)
        self._emit(data)

    def feed(self, html: str) -> None:
        at, last = 0, html.rfind(">")
        self.loose = 0  # before this place quotes do not hide a ``>``
        last_comment = max(html.rfind("-->"), html.rfind("--!>"))
        while at < len(html):
            i = html.find("<", at)
            if i < 0 or i > last:
                self.handle_data(entities.unescape(html[at:]))
                return
            first = html[i + 1]
            if first not in _LETTERS and first not in "/!?":
                self.handle_data(entities.unescape(html[at : i + 1]))
                at = i + 1
                continue
            if i > at:
                self.handle_data(entities.unescape(html[at:i]))
            if first in _LETTERS:
                name = _NAME.match(html, i + 1)
                tag = name[0].lower()
                attributes, at = self._attributes(html, i, name.end())
                self.handle_starttag(tag, attributes)
                if tag in _RAW_END:
                    end = _RAW_END[tag].search(html, at)
                    at = end.start() if end else len(html)
            elif first == "/" and html[i + 2 : i + 3] in _LETTERS:
                name = _NAME.match(html, i + 2)
                at = self._attributes(html, i, name.end())[1]
                self.handle_endtag(name[0].lower())
            elif html.startswith("<!--", i) and i + 2 <= last_comment:
                at = _COMMENT_END.search(html, i + 2).end()
            else:
                at = html.index(">", i) + 1

    def _attributes(self, html: str, i: int, at: int) -> tuple[list[tuple[str, str | None]], int]:
        """The attributes of the tag at ``i`` and where it ends."""
        found, stop = [], html.index(">", i) if i < self.loose else len(html)
        while True:
            at = _GAP.match(html, at).end()
            if at >= stop:
                break
            if html[at] == ">":
                return found, at + 1
            name = _ATTRIBUTE.match(html, at)
            at, value = name.end(), None
            if name[2]:
                quote = html[at : at + 1]
                if quote in ("'", '"'):
                    end = html.find(quote, at + 1, stop)
                    if end < 0:
                        self.loose = max(self.loose, at)
                        break
                    value, at = html[at + 1 : end], end + 1
                else:
                    end = _BARE.match(html, at).end()
                    value, at = html[at:end], end
            found.append((name[1].lower(), value and entities.unescape(value)))
        if at >= len(html):
            self.loose = len(html)
        return found, html.index(">", i) + 1

    def text(self) -> str:
        while len(self.stack) > 1:
            tag, _, parts, _ = self.stack[-1]
            if tag in BOILERPLATE and tag not in ("script", "style"):
                self.stack[-2][2].extend(parts)  # never closed: keep what it swallowed
                self.stack.pop()
                self.open[tag] -= 1
            else:
                self._pop()
        for root in ROOTS:
            if root in self.roots:
                return self.roots[root][1]
        return "".join(self.stack[0][2])

    def _emit(self, piece: str) -> None:
        self.stack[-1][2].append(piece)

    def _close_while_open(self, tag: str, barrier) -> None:
        if not self.open[tag]:
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth][0] == tag:
                while len(self.stack) > depth:
                    self._pop()
                return
            if self.stack[depth][0] in barrier:
                return

    def _pop(self) -> str:
        frame = self.stack.pop()
        tag, _, parts, start = frame
        self.open[tag] -= 1
        # A root inside a dropped element is dropped with it.
        if tag in ROOTS and not any(self.open[t] for t in BOILERPLATE):
            if tag not in self.roots or start < self.roots[tag][0]:
                self.roots[tag] = (start, "".join(parts))
        self._emit(self._render(frame))
        if tag in ("ul", "ol"):
            self.lists.pop()
        elif tag == "table":
            self.tables.pop()
        return tag

    def _render(self, frame) -> str:
        tag, attrs, parts, _ = frame
        body = "".join(parts)
        bare = body.strip()
        if tag in BOILERPLATE or tag in ("head", "title"):
            return ""
        if re.fullmatch("h[1-6]", tag):
            return f"\n\n{'#' * int(tag[1])} {' '.join(bare.split())}\n\n" if bare else ""
        if tag in MARKS and self.open["pre"]:
            return body
        if tag in MARKS or tag == "a":
            if not bare:
                return body
            lead, tail = body[: len(body) - len(body.lstrip())], body[len(body.rstrip()):]
            if tag == "a":
                target = attrs.get("href")
                if target == bare and not attrs.get("title"):
                    bare = f"<{target}>"
                elif target:
                    title = f' "{attrs["title"]}"' if attrs.get("title") else ""
                    bare = f"[{bare}]({target}{title})"
                return lead + bare + tail
            return lead + MARKS[tag] + bare + MARKS[tag] + tail
        if tag == "img":
            return f"![{attrs.get('alt') or ''}]({attrs.get('src') or ''})"
        if tag == "br":
            return "\n"
        if tag == "hr":
            return "\n\n---\n\n"
        if tag == "pre":
            return f"\n\n```\n{body.strip(chr(10))}\n```\n\n" if bare else ""
        if tag == "li":
            if not bare:
                return ""
            mark = "*"
            if self.lists and self.lists[-1][0] == "ol":
                mark = f"{self.lists[-1][1]}."
                self.lists[-1][1] += 1
            elif self.lists:
                mark = BULLETS[(self.open["ul"] - 1) % len(BULLETS)]
            return "\n" + "\t" * max(len(self.lists) - 1, 0) + f"{mark} {bare}"
        if tag in ("ul", "ol"):
            return f"{body.rstrip()}\n" if self.open["li"] else f"\n\n{body}\n\n"
        if tag == "blockquote":
            return "\n\n" + "\n".join("> " + line for line in bare.split("\n")) + "\n\n" if bare else ""
        if tag in ("td", "th"):
            if self.tables:
                self.tables[-1][1] += 1
            return f" {' '.join(bare.split())} |"
        if tag == "tr" and self.tables:
            rows, cells = self.tables[-1]
            self.tables[-1] = [rows + 1, 0]
            return f"\n|{body.rstrip()}" + ("" if rows else "\n|" + " --- |" * cells)
        return f"\n\n{body}\n\n" if tag in BLOCKS else body


def page_text(html: str, escape: str = "*_") -> str:
    """Readable text of one page, before its lines are tidied."""
    page = _Page(escape)
    page.feed(html)
    return page.text()


def html_to_markdown(
    pages: DataFrame, html: str = "html", output: str = "content", escape: str = "*_",
    only_if: str | None = None, error: str | None = None,
) -> DataFrame:
    """The cleaned text of each page in place of its markup; other columns pass through.

    ``escape`` lists the characters that get a backslash outside code.
    ``only_if`` names a boolean column; where it is false the input is kept as
    it is. ``error`` names a column that says what went wrong with a page, whose text is
    then null; without it such a page fails the job. Markup is read in Python on Arrow batches; lines are
    tidied in the JVM.
    """
    # The markup goes to Python only; sending it back would double the traffic.
    fields = [f for f in pages.schema if f.name not in (html, output, error)]
    made = [output, error] if error else [output]
    schema = T.StructType([*fields, *[T.StructField(n, T.StringType(), True) for n in made]])
    names = [f.name for f in fields]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            raw = batch.column(batch.schema.get_field_index(html)).to_pylist()
            flags = (
                batch.column(batch.schema.get_field_index(only_if)).to_pylist()
                if only_if else [True] * len(raw)
            )
            texts, errors = [], []
            for page, wanted in zip(raw, flags, strict=True):
                failure = None
                try:
                    text = page_text(page, escape) if wanted and page else page
                except Exception as e:  # one page must not stop the others
                    if not error:
                        raise
                    text, failure = None, f"{type(e).__name__}: {e}"
                texts.append(text)
                errors.append(failure)
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, *[pa.array(c, pa.string()) for c in (texts, errors)[: len(made)]]], [*names, *made]
            )

    read_pages = pages.select(*names, html).mapInArrow(read, schema)
    tidy = X.tidy_lines(output)
    if only_if:
        tidy = F.when(F.col(only_if), tidy).otherwise(F.col(output))
    return read_pages.withColumn(output, tidy)


# --- the same idea in expressions only, for pages without nested markup --------


def drop_boilerplate(html: Column) -> Column:
    """Remove the boilerplate elements and their content by pattern."""
    for tag in BOILERPLATE:
        html = F.regexp_replace(html, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "")
    return html


def content_root(html: Column) -> Column:
    """Inner markup of the first main, else article, else body, else all."""
    found = [
        F.nullif(F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)(?:</{tag}\s*>|\z)", 1), F.lit(""))
        for tag in ROOTS
    ]
    return F.coalesce(*found, html)


def page_text_by_pattern(html: Column | str) -> Column:
    """Plain text of a page without leaving the JVM."""
    raw = F.col(html) if isinstance(html, str) else html
    kept = content_root(drop_boilerplate(F.regexp_replace(raw, r"(?s)<!--.*?-->", "")))
    lines = F.regexp_replace(kept, r"(?i)</?(p|div|br|li|ul|ol|h[1-6]|tr|table)\b[^>]*>", "\n")
    plain = F.regexp_replace(lines, r"<[^>]*>", "")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    return X.tidy_lines(plain)
